"""Line dedup: drop every line that repeats an earlier one, or is one word edit away from an earlier one.

Lines are sequences of words (white space between them, A-Z as a-z); lines without words are left alone. Two lines
are duplicates when they are equal, or when both have ``min_words`` words or more and one inserted, deleted or replaced word
or any change of white space makes them equal. Of duplicates the earliest by (doc_id, line number) stays: a line goes when there is an earlier duplicate,
whether that one stays or not.

Method: deletion neighbourhoods. A line's variants are the line without one of its words, as hashed keys with the place of
the word, and the line without its white space. Equal variants of one place: a word is replaced, or words are joined or parted; a
variant that equals a whole line: a word is deleted or inserted. Minima per key find each line's earliest neighbour, so no pairs are listed and a key with many
lines is an aggregate; a task emits the variants of equal lines once, unless it comes upon an earlier one. The edit distance of every line and its neighbour is then verified on the words.
An edit of a word leaves one half of a line alone: only lines that share a half, or their letters, with another line emit variants.
Halves are of the same length and kind for 4 consecutive numbers of words, so a line has two, and four where its shorter partner is of another kind.
Keys travel back to the texts as bitmaps of bounded size; a wrong bit costs work, not results. So do the places of the lines that go: a second
bitmap takes back the wrong bits of the first. Only texts of which it takes back a right one meet their line numbers in a join.

Nulls and ties: a null text stays null; rows with a null id stay as they are and count for nobody. Rows with equal ids are one
place in the order, so repeated rows keep the same lines. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .bitmaps import bitmap, bits_for, holds
from .scratch import materialize
from .wordhash import LOWER, MASK, SPACE, chunks, mix, text_bytes, word_hashes
from .workers import task

MIN_WORDS = 8  # of lines that near copies are sought of, where nothing else is asked for
SQUEEZED = -2  # place of the variant without white space
SEEN = 100_000  # lines whose places a task keeps, to emit them once
_P = 0xC6BC279692B5C323
_P_BACK = pow(_P, -1, 2**64)
_LETTER = 0x9FB21C651E98DF25
_LETTER_BACK = pow(_LETTER, -1, 2**64)
_RISING, _FALLING = [np.ones(1, np.uint64)], [np.ones(1, np.uint64)]
_BYTE = np.random.default_rng(20_012).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for k in range(1, n):
        out[k] = (int(out[k - 1]) * base) & MASK
    return out


class Lines:
    """All lines of a chunk of texts: text row, number in the text, byte range, and words."""

    powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        breaks = np.flatnonzero(data == 10)
        texts = np.searchsorted(ends, breaks, "right") - 1
        per = np.bincount(texts, minlength=len(ends) - 1) + 1
        self.row = np.repeat(np.arange(len(ends) - 1), per)
        self.number = np.arange(len(self.row)) - np.repeat(np.cumsum(per) - per, per)
        self.start = np.where(self.number == 0, ends[self.row], 0)
        self.start[self.number > 0] = breaks + 1
        last = np.append(self.number[1:] == 0, True) if len(self.row) else np.zeros(0, bool)
        self.end = np.where(last, ends[self.row + 1], 0)
        self.end[~last] = breaks
        edges = np.append(self.start, len(data))
        self.words, bounds = word_hashes(data, edges)
        self.first, self.n = bounds[:-1], np.diff(bounds)
        longest = int(self.n.max(initial=0)) + 1
        if len(self.powers[0]) < longest:
            self.powers[:] = [_powers(_P, 2 * longest), _powers(_P_BACK, 2 * longest)]
        self.at = np.arange(len(self.words)) - np.repeat(self.first, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * self.powers[0][self.at], dtype=np.uint64)])
        self.whole = self._span(self.first, self.first + self.n)
        self.key = self._key(self.whole, self.n)
        self.squeezed = self._letters(data, edges)

    @staticmethod
    def _letters(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Hash of each line's bytes without white space."""
        solid = np.flatnonzero(~SPACE[data])
        at = np.searchsorted(solid, edges)
        while len(_RISING[0]) < len(solid):  # powers by place in the chunk; those before a line are divided out
            for table, base in ((_RISING, _LETTER), (_FALLING, _LETTER_BACK)):
                table[0] = np.concatenate([table[0], table[0] * np.uint64(pow(base, len(table[0]), 2**64))])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[LOWER[data[solid]]] * _RISING[0][: len(solid)], dtype=np.uint64)])
        first, last = at[:-1], at[1:]
        own = (sums[last] - sums[first]) * _FALLING[0][np.minimum(first, len(_FALLING[0]) - 1)]
        return mix(own + (last - first).astype(np.uint64) * np.uint64(0xB5297A4D3F84D5A5))

    def _span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sum over words a to b, weighted by their places in the line."""
        return self.sums[b] - self.sums[a]

    @staticmethod
    def _key(total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mix(total + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def halves(self, kind: np.ndarray) -> list[np.ndarray]:
        """Keys of the first and the last words, so many for all lines of a ``kind`` (see ``_kind``); half a line at most."""
        k = np.minimum(np.maximum(2 * kind, 1), self.n)
        back = self.n - k
        head = self._span(self.first, self.first + k)
        tail = self._span(self.first + back, self.first + self.n) * self.powers[1][back]
        tag = kind.astype(np.uint64)
        return [mix(head + tag * np.uint64(0xD1342543DE82EF95)), mix(tail + tag * np.uint64(0xAF251AF3B0F025B5))]

    def shared_keys(self, min_words: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(keys, lines that have them): lines one edit apart have one of these keys in common."""
        long, kind, shorter = self.n >= min_words, _kind(self.n), _kind(np.maximum(self.n - 1, 0))
        other = (self.n > min_words) & (shorter != kind)
        return [(key, long) for key in (*self.halves(kind), self.squeezed)] + [(key, other) for key in self.halves(shorter)]

    def variants(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, key) of the lines without one word, of the whole lines at place -1, and without white space at ``SQUEEZED``."""
        n = self.n[lines]
        word = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[lines], n)
        line = np.repeat(lines, n)
        before = self._span(self.first[line], word)
        after = self._span(word + 1, self.first[line] + self.n[line]) * np.uint64(_P_BACK)
        rest = self._key(before + after, self.n[line] - 1)
        return (
            np.concatenate([lines, lines, line]),
            np.concatenate([np.full(len(lines), -1), np.full(len(lines), SQUEEZED), self.at[word]]),
            np.concatenate([self.key[lines], self.squeezed[lines], rest]),
        )


def _kind(n: np.ndarray) -> np.ndarray:
    return n // 4


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, Lines]]:
    data, ends = text_bytes(batch.column(1))
    for lo, hi in chunks(ends):
        part = data[ends[lo] : ends[hi]]
        yield lo, hi, part, Lines(part, ends[lo : hi + 1] - ends[lo])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _occurrences(min_words: int):
    """Key and place of every line with words; the keys it shares with near copies, once for the equal lines of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, _, lines in _chunks(batch):
                keep = lines.n > 0
                once = np.zeros(len(keep), bool)
                once[np.unique(lines.key, return_index=True)[1]] = True
                columns = [_signed(lines.key[keep]), pa.array(ids[lo + lines.row[keep]]), pa.array(lines.number[keep].astype(np.int32))]
                for key, real in lines.shared_keys(min_words):
                    columns.append(pa.array(key[keep].view(np.int64), mask=~(real & once)[keep]))
                yield pa.RecordBatch.from_arrays(columns, ["line", "doc_id", "number", "h0", "h1", "h2", "h3", "h4"])

    return task(run)


def _earlier(seen: dict[int, tuple[int, int]], lines: Lines, chosen: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Those of the ``chosen`` lines of which the task has not yet seen an equal one at the same or an earlier place."""
    out = []
    for i, key, place in zip(
        chosen.tolist(), lines.key[chosen].tolist(), zip(docs.tolist(), lines.number[chosen].tolist(), strict=True), strict=True
    ):
        known = seen.get(key)
        if known is None or place < known:
            if len(seen) >= SEEN:
                seen.clear()
            seen[key] = place
            out.append(i)
    return np.array(out, np.int64)


def _variants(half_table, key_table, min_words: int):
    """Variants of lines that share a half; with a table of keys, only variants in it, and the texts of their lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = half_table.value
        wanted = key_table.value if key_table is not None else None
        seen: dict[int, tuple[int, int]] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, data, lines in _chunks(batch):
                hit = np.zeros(len(lines.n), bool)
                for keys, real in lines.shared_keys(min_words):
                    hit |= holds(halves, keys) & real
                chosen = np.flatnonzero(hit)
                _, once = np.unique(lines.key[chosen], return_index=True)  # the earlier of equal lines of a text
                order = np.lexsort((lines.number[chosen], ids[lo + lines.row[chosen]], lines.key[chosen]))
                once = order[np.concatenate([[True], np.diff(lines.key[chosen][order]) != 0])] if len(order) else once
                own = chosen[once]
                line, place, key = lines.variants(_earlier(seen, lines, own, ids[lo + lines.row[own]]))
                real = (place < 0) | (lines.n[line] >= min_words)
                if wanted is not None:
                    real &= holds(wanted, key)
                line, place, key = line[real], place[real], key[real]
                doc, number = ids[lo + lines.row[line]], lines.number[line]
                columns = [_signed(key), pa.array(place.astype(np.int32)), _signed(lines.key[line]), pa.array(doc),
                           pa.array(number.astype(np.int32)), pa.nulls(len(key), pa.binary())]
                names = ["key", "place", "line", "doc_id", "number", "words"]
                for a in range(0, len(key), 50_000):
                    yield pa.RecordBatch.from_arrays([c.slice(a, 50_000) for c in columns], names)
                if wanted is not None:
                    used = np.unique(line)
                    texts = [data[lines.start[i] : lines.end[i]].tobytes() for i in used]
                    n = len(used)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), _signed(lines.key[used]), pa.nulls(n, pa.int64()),
                         pa.nulls(n, pa.int32()), pa.array(texts, pa.binary())], names)

    return task(run)


_VARIANT = "key long, place int, line long, doc_id long, number int, words binary"


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one inserted, deleted or replaced word at most, or other white space, makes the word lists equal."""
    if b"".join(a) == b"".join(b):
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [
            within_one_edit(a.lower().split(), b.lower().split())
            for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_()))], ["line"])


def _without(text: str, gone) -> tuple[str, bool]:
    """The text without the lines of these numbers, and whether a word is left."""
    gone = set(gone)
    text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
    return text, any(not SPACE[b] for b in text.encode())


def _replaced(batch: pa.RecordBatch, text: int, texts: list, left: list[bool]) -> pa.RecordBatch:
    columns = [*batch.columns[:text], pa.array(texts, pa.string()), *batch.columns[text + 1 :], pa.array(left, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__left"])


def _rewrite(text: int, drops: int):
    """Texts without the lines whose numbers are in column ``drops``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, 200) for b in batches for a in range(0, b.num_rows, 200)):
            texts, left = batch.column(text).to_pylist(), [True] * batch.num_rows
            for i, gone in enumerate(batch.column(drops).to_pylist()):
                if texts[i] is not None and gone:
                    texts[i], left[i] = _without(texts[i], gone)
            yield _replaced(batch, text, texts, left)

    return run


# --- places of lines as bitmaps ------------------------------------------------------------


def _place_keys(docs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The lower half is for the bitmap of lines that go, the upper for that of lines that stay: lines that share a bit in one do not in the other."""
    return mix(mix(docs.astype(np.int64).view(np.uint64)) + numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _places(ids: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, key) of every line of the texts; rows without an id or a text have none."""
    per = pc.add(pc.count_substring(texts, "\n"), 1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    per[ids.is_null().to_numpy(zero_copy_only=False)] = 0
    row = np.repeat(np.arange(len(per)), per)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return row, number, _place_keys(ids.fill_null(0).to_numpy()[row], number)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _place_keys(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _signed(keys)], ["doc_id", "number", "key"])


def _hits(table):
    """Places of all lines whose bits are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, key = _places(batch.column(0), batch.column(1))
            hit = holds(table.value, key)
            ids = batch.column(0).fill_null(0).to_numpy()[row[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(number[hit].astype(np.int32)), _signed(key[hit])], ["doc_id", "number", "key"])

    return task(run)


def _holding(table):
    """Documents of the lines whose bits are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array(holds(table.value, batch.column(1).to_numpy().view(np.uint64) >> np.uint64(32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(hit)], ["doc_id"])

    return task(run)


def _rewrite_sure(at: int, text: int, doubt, go, stay):
    """Documents without a bit in ``doubt``, without their lines whose bits are set in ``go`` and not in ``stay``; the last column is the document's mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, 200) for b in batches for a in range(0, b.num_rows, 200)):
            batch = batch.filter(pa.array(~_marked(batch, doubt)))
            batch = batch.select(batch.schema.names[:-1])
            row, number, key = _places(batch.column(at), batch.column(text))
            gone = holds(go.value, key)
            gone[gone] = ~holds(stay.value, key[gone] >> np.uint64(32))
            texts, left = batch.column(text).to_pylist(), [True] * batch.num_rows
            rows, first = np.unique(row[gone], return_index=True)
            for i, numbers in zip(rows.tolist(), np.split(number[gone], first)[1:], strict=True):
                texts[i], left[i] = _without(texts[i], numbers.tolist())
            yield _replaced(batch, text, texts, left)

    return task(run)


def _marked(batch: pa.RecordBatch, doubt) -> np.ndarray:
    mark = batch.column(batch.num_columns - 1)
    return holds(doubt.value, mark.fill_null(0).to_numpy()) & ~mark.is_null().to_numpy(zero_copy_only=False)


def _doubtful(doubt):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(batch, doubt)))

    return task(run)


def _table(keys: DataFrame, key: Column) -> np.ndarray:
    """Bitmap of a written table's keys, of a size that follows their number."""
    return bitmap(keys, key, bits_for(keys.count()))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, number, near) of every line that goes. ``near``: an earlier line is one edit away.

    Edits are sought in lines of ``min_words`` words or more; lines with fewer go when they are equal.
    """
    if min_words < 2:
        raise ValueError("min_words: 2 or more, as half a line must be left by an edit")
    usable = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    found = materialize(
        usable.mapInArrow(_occurrences(min_words), "line long, doc_id long, number int, h0 long, h1 long, h2 long, h3 long, h4 long"),
        "lines",
    )
    place = F.struct("doc_id", "number")
    sc = docs.sparkSession.sparkContext

    halves = found.select("line", F.explode(F.array("h0", "h1", "h2", "h3", "h4")).alias("half")).filter("half IS NOT NULL")
    shared = halves.groupBy("half").agg(F.min("line").alias("a"), F.max("line").alias("b")).filter("a <> b").select("half")
    half_table = sc.broadcast(_table(materialize(shared, "halves"), F.col("half")))

    # earliest line per key and place, per key over all places, and of whole lines
    variants = usable.mapInArrow(_variants(half_table, None, min_words), _VARIANT).repartition("key")
    whole, cut = F.col("place") == -1, F.col("place") != -1
    least = F.min(F.struct("doc_id", "number", "line")).alias("least")
    by_place = variants.groupBy("key", "place").agg(least, F.max("line").alias("top"), F.min("line").alias("low"))
    by_place = by_place.withColumn("several", F.col("top") != F.col("low"))
    by_key = by_place.groupBy("key").agg(
        F.collect_list(F.when(cut & F.col("several"), F.struct("place", "least"))).alias("places"),
        F.min(F.when(whole, F.col("least"))).alias("whole"),
        F.min(F.when(cut, F.col("least"))).alias("cut"),
    )
    useful = by_key.filter((F.size("places") > 0) | (F.col("whole").isNotNull() & F.col("cut").isNotNull()))
    useful = materialize(useful, "keys")
    key_table = sc.broadcast(_table(useful, F.col("key")))

    again = materialize(usable.mapInArrow(_variants(half_table, key_table, min_words), _VARIANT), "variants")
    own = again.filter("key IS NOT NULL").select("key", "place", "line", "doc_id", "number").join(useful, "key")
    same_place = F.filter("places", lambda p: p["place"] == F.col("place"))
    beside = F.when(cut, F.least(F.try_element_at(same_place, F.lit(1))["least"], F.col("whole"))).otherwise(F.col("cut"))
    near = own.withColumn("beside", beside).groupBy("line").agg(
        F.min("beside").alias("beside"), F.min(place).alias("first")
    )
    near = near.filter(F.struct("beside.doc_id", "beside.number") < F.col("first"))
    near = near.select("line", F.col("beside.line").alias("other"))
    words = again.filter("key IS NULL").groupBy("line").agg(F.first("words").alias("words"))
    pairs = near.join(words, "line").join(words.select(F.col("line").alias("other"), F.col("words").alias("others")), "other")
    checked = pairs.select("line", "words", "others").mapInArrow(task(_verified), "line long").select("line", F.lit(True).alias("near"))

    firsts = found.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    fate = firsts.join(checked, "line", "left").filter("near OR times > 1")
    lines = found.select("line", "doc_id", "number").join(fate, "line")
    gone = lines.filter(F.col("near").isNotNull() | (place > F.col("first")))
    return gone.select("doc_id", "number", F.coalesce("near", F.lit(False)).alias("near")).distinct()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the repeated lines.

    Documents that had words and lose all of them go; documents that were blank before stay.
    """
    sc = docs.sparkSession.sparkContext
    kind = "doc_id long, number int, key long"
    gone = repeated_lines(docs, min_words).select("doc_id", "number")
    gone = materialize(gone.mapInArrow(task(_keyed), kind), "gone")
    go = sc.broadcast(_table(gone, F.col("key")))

    # lines that stay and share a bit with one that goes; then documents with lines that go and share a bit with those
    hits = docs.select("doc_id", "text").mapInArrow(_hits(go), kind)
    wrong = materialize(hits.join(gone, ["doc_id", "number"], "left_anti"), "wrong")
    stay = sc.broadcast(_table(wrong, F.shiftrightunsigned("key", 32)))
    doubtful = materialize(gone.select("doc_id", "key").mapInArrow(_holding(stay), "doc_id long"), "doubtful")
    doubt = sc.broadcast(_table(doubtful, F.xxhash64("doc_id")))

    # only doubtful documents, and few that share a bit with them, meet their line numbers
    marked = docs.withColumn("__mark", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")))
    left = StructField("__left", BooleanType())
    at, text = docs.columns.index("doc_id"), docs.columns.index("text")
    sure = marked.mapInArrow(_rewrite_sure(at, text, doubt, go, stay), StructType([*docs.schema.fields, left]))
    asked = marked.mapInArrow(_doubtful(doubt), marked.schema).drop("__mark")
    numbers = gone.select(F.col("doc_id").alias("__doc"), "number", F.xxhash64("doc_id").alias("__mark")).mapInArrow(
        _doubtful(doubt), "__doc long, number int, __mark long"
    )
    numbers = numbers.groupBy("__doc").agg(F.collect_list("number").alias("__gone"))
    asked = asked.join(numbers, F.col("doc_id") == F.col("__doc"), "left").drop("__doc")
    asked = asked.mapInArrow(task(_rewrite(text, len(docs.columns))), StructType([*asked.schema.fields, left])).drop("__gone")
    return sure.unionByName(asked).filter("__left").drop("__left")
