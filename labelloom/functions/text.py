"""Text functions: Column -> Column, built-in expressions only (no Python per row)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .draws import draw, pick, pick_index, pick_literal, unit


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda evaluates everything it mentions for each element, so values from outside
    are bound first.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def words(text: Column) -> Column:
    """Split on runs of white space, no empty words."""
    return F.array_remove(F.split(text, fv.SPACE + "+"), "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{fv.SPACE}+|{fv.SPACE}+\z", "")


def token_count(text: Column) -> Column:
    return F.size(words(text))


def first_words(text: Column, k: int) -> Column:
    return F.array_join(F.slice(words(text), 1, k), " ")


def replace_marker(text: Column, marker: str, value: Column) -> Column:
    return F.replace(text, F.lit(marker), value)


def fill_slots(text: Column, slots: Column, seed, key: Column, name: str = "slot") -> Column:
    """Replace every ``{word}`` by an independent pick from ``slots[word]``.

    ``slots`` is MAP<STRING, ARRAY<STRING>>; unknown words and empty lists stay as they are.
    """
    parts = F.split(text, fv.SLOT, -1)

    def filled(names: Column) -> Column:
        def piece(part: Column, i: Column) -> Column:
            number = draw(seed, key, F.concat(F.lit(name + "#"), i.cast("string")))

            def value(slot: Column) -> Column:
                chosen = pick(F.element_at(slots, slot), number)
                return F.coalesce(chosen, F.concat(F.lit("{"), slot, F.lit("}")))

            return F.concat(part, F.coalesce(let(F.get(names, i), value), F.lit("")))

        return F.array_join(F.transform(parts, piece), "")

    names = F.regexp_extract_all(text, F.lit(fv.SLOT), 1)
    return F.when(text.rlike(fv.SLOT) & slots.isNotNull(), let(names, filled)).otherwise(text)


# --- rewrites ---------------------------------------------------------------


def to_question(text: Column, seed, key: Column, name: str = "question") -> Column:
    prefix = pick_literal(fv.QUESTION_PREFIXES, draw(seed, key, name))
    return F.concat(prefix, F.regexp_replace(text, r"[?.,! ]+\z", ""), F.lit("?"))


def to_passive(text: Column, seed, key: Column, name: str = "passive") -> Column:
    return F.when(
        unit(seed, key, name) < F.lit(0.5), F.concat(F.lit(fv.PASSIVE_BEFORE), text)
    ).otherwise(F.concat(text, F.lit(fv.PASSIVE_AFTER)))


def filler_prefix(text: Column, filler: Column) -> Column:
    """``filler`` is the chosen filler word; NULL leaves the text unchanged."""
    return F.when(filler.isNull(), text).otherwise(F.concat(filler, F.lit(" "), text))


def add_suffix(text: Column, seed, key: Column, name: str = "suffix") -> Column:
    return F.concat(text, F.lit(" "), pick_literal(fv.SUFFIXES, draw(seed, key, name)))


def to_formal(text: Column, seed, key: Column, name: str = "formal") -> Column:
    return F.concat(pick_literal(fv.FORMAL_PREFIXES, draw(seed, key, name)), text)


# --- noise ------------------------------------------------------------------


def abbreviate(text: Column, abbreviations: Column, seed, key: Column, name: str = "abbr") -> Column:
    """Each word found in the map is replaced with probability 0.05."""

    def one(word: Column, i: Column) -> Column:
        index = i.cast("string")
        hit = unit(seed, key, F.concat(F.lit(name + "#"), index)) < F.lit(fv.ABBREVIATE_PROB)
        number = draw(seed, key, F.concat(F.lit(name + "_pick#"), index))
        chosen = pick(F.element_at(abbreviations, F.lower(word)), number)
        known = F.map_contains_key(abbreviations, F.lower(word))
        return F.when(known & hit, F.coalesce(chosen, word)).otherwise(word)

    return F.array_join(F.transform(words(text), one), " ")


def typo(text: Column, seed, key: Column, name: str = "typo") -> Column:
    """Swap one adjacent pair of characters in one word of at least four."""

    def swapped(word: Column) -> Column:
        pos = pick_index(draw(seed, key, name + "_pos"), F.length(word) - 1)
        return let(
            pos,
            lambda p: F.concat(
                F.substr(word, F.lit(1), p),
                F.substr(word, p + 2, F.lit(1)),
                F.substr(word, p + 1, F.lit(1)),
                F.substr(word, p + 3),
            ),
        )

    def changed(ws: Column) -> Column:
        long_words = F.filter(
            F.transform(ws, lambda w, i: F.when(F.length(w) >= 4, i)), lambda i: i.isNotNull()
        )
        target = let(
            long_words, lambda c: F.get(c, pick_index(draw(seed, key, name + "_word"), F.size(c)))
        )
        return let(
            target,
            lambda t: F.when(t.isNull(), text).otherwise(
                F.array_join(
                    F.concat(
                        F.slice(ws, F.lit(1), t),
                        F.array(let(F.get(ws, t), swapped)),
                        F.slice(ws, t + 2, F.size(ws)),
                    ),
                    " ",
                )
            ),
        )

    return let(words(text), changed)


def filler_insert(text: Column, filler: Column, seed, key: Column, name: str = "insert") -> Column:
    """Insert the chosen filler word before a uniform position 0..n."""
    ws = words(text)
    pos = pick_index(draw(seed, key, name), F.size(ws) + 1)
    return F.when(filler.isNull(), text).otherwise(
        F.array_join(F.array_insert(ws, pos + 1, filler), " ")
    )


# --- model replies ------------------------------------------------------------


def reply_lines(text: Column) -> Column:
    """Array of cleaned lines: list markers removed, empty lines dropped."""

    def clean(line: Column) -> Column:
        numbered = F.regexp_replace(strip(line), rf"^\p{{Nd}}+\.{fv.SPACE}+", "")
        return F.regexp_replace(numbered, rf"^[-*]{fv.SPACE}+", "")

    cleaned = F.transform(F.split(text, fv.LINE_BREAK), clean)
    return F.filter(cleaned, lambda line: line != F.lit(""))


def strip_fence(text: Column) -> Column:
    """Body of a fenced reply; other replies are only stripped."""

    def body(rest: Column) -> Column:
        end = F.array_position(F.transform(rest, strip), fv.FENCE).cast("int")
        inner = let(
            end, lambda e: F.when(e > 0, F.slice(rest, F.lit(1), F.greatest(e - 1, F.lit(0)))).otherwise(rest)
        )
        return F.array_join(inner, "\n")

    raw = strip(text)
    lines = F.split(raw, fv.LINE_BREAK)
    rest = F.slice(lines, F.lit(2), F.size(lines))
    return F.when(F.startswith(raw, F.lit(fv.FENCE)), let(rest, body)).otherwise(raw)


# --- encoding -------------------------------------------------------------------


def byte_values(text: Column, max_bytes: int | None = None) -> Column:
    """ARRAY<BIGINT> of the UTF-8 bytes, of the first ``max_bytes`` if that is given."""
    data = F.encode(text, "UTF-8")
    one_char_per_byte = F.decode(data if max_bytes is None else F.substring(data, 1, max_bytes), "ISO-8859-1")
    chars = F.array_remove(F.split(one_char_per_byte, ""), "")
    return F.transform(chars, lambda c: F.ascii(c).cast("bigint"))


def byte_encode(text: Column, max_bytes: int = fv.MAX_BYTES) -> Column:
    """ARRAY<INT> of ``max_bytes`` byte values, zero padded."""

    def padded(values: Column) -> Column:
        return F.concat(values, F.array_repeat(F.lit(0), F.lit(max_bytes) - F.size(values)))

    return let(byte_values(text, max_bytes).cast("array<int>"), padded)


def ngram_buckets(
    text: Column, sizes: list[int] | None = None, buckets: int = 65_536, max_bytes: int | None = None
) -> Column:
    """Distinct hash buckets (ARRAY<BIGINT>) of the byte n-grams that occur in the whole text.

    An n-gram is the big-endian number of its bytes (at most 6 bytes), its bucket that
    number modulo ``buckets``; the i-th size uses the range starting at ``i * buckets``.
    """
    sizes = list(sizes or fv.NGRAM_SIZES)

    def grow(values: Column, data: Column, length: int, parts: list[Column]) -> Column:
        """``values`` are the numbers of the n-grams of ``length``; collect the sizes on the way."""
        if length in sizes:
            base = sizes.index(length) * buckets
            parts = [*parts, F.transform(values, lambda v: v % buckets + base)]
        if length == max(sizes):
            return F.array_distinct(F.concat(*parts))
        longer = F.zip_with(
            F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0))),
            F.slice(data, F.lit(length + 1), F.size(data)),
            lambda v, byte: v * 256 + byte,
        )
        return let(longer, lambda wider: grow(wider, data, length + 1, parts))

    return let(byte_values(text, max_bytes), lambda data: grow(data, data, 1, []))


# --- score arrays -----------------------------------------------------------------


def argmax(scores: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def softmax(scores: Column) -> Column:
    def weights(top: Column) -> Column:
        return F.transform(scores, lambda x: F.exp(x - top))

    def shares(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(values, lambda x: x / t))

    return let(let(F.array_max(scores), weights), shares)


def log_sum_exp(scores: Column) -> Column:
    def from_top(top: Column) -> Column:
        return top + F.log(F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))

    return let(F.array_max(scores), from_top)
