"""Byte-pair encoding with word ends, and decoding.

Encoding does not merge. An Aho-Corasick automaton over the vocabulary gives the longest token at each place
of a word; a token is taken when it may follow the previous one, else the next shorter token is tried and at last
the previous token is given up (backtracking). Two tokens may follow each other when no merge across
their border would have come before the merges inside them; answers are kept in a pair table. Each place is
given up once at most, so a word takes time in proportion to its length, and the tokens are the ones the
merges in their order give. Decoding copies token texts by a table of offsets.

A text is taken apart at ASCII white space first; a part's tokens do not depend on its neighbours. The tokens of parts and words
seen before are kept in tables of bounded size, for as long as a worker goes on encoding. Equal texts of a batch are encoded once.

Nulls: a null text is encoded as an empty one, which has no token. A row with a null id is encoded like any
other; repeated rows are returned as often as given; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .workers import kept, task

END = "Ā"  # stands for the end of a word; other letters of a word are its UTF-8 bytes
KEPT_PARTS = 100_000  # parts of texts in each of two generations whose tokens a worker keeps (17 MB each)
KEPT_WORDS = 120_000  # words, in the same way (23 MB each)
KEPT_PAIRS = 200_000  # answers of the pair table (25 MB)
KEPT_BYTES = 40  # no longer parts are kept
#: Fixed values of the format: white space and the pieces between which no merge happens.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
MARKS = ".,;:!?"  # the commonest ends of a part; a mark alone is a piece
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + BLANK + r"\p{L}\p{N}]+"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes that do not print as letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Generations:
    """Values of keys used lately: when the young generation is full it becomes the old one, and the old one goes."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def older(self, key):
        """The value of a key that is not young; it is young from now on."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Bpe:
    """Encoder and decoder of one vocabulary file (JSON of the ``tokenizers`` library). ``kept``: times the usual size of its tables."""

    def __init__(self, source: bytes, kept: int = 1):
        spec = json.loads(source)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        suffix, letters = spec["model"]["end_of_word_suffix"], _byte_letters()

        def inner(token: str) -> str:
            body = token.removesuffix(suffix) if token != suffix else token
            return "".join(chr(letters[c]) for c in body) + (END if body != token else "")

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.shown = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.ids = {inner(t): i for t, i in vocab.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair = (vocab[a], vocab[b])
            self.joined[pair] = made = vocab[a + b]
            self.split.setdefault(made, pair)
        top = max(*vocab.values(), *self.special.values()) + 1
        self.size = [0] * top
        for t, i in self.ids.items():
            self.size[i] = len(t)
        self.packed = [i.to_bytes(4, "little") for i in range(top)]
        self.pairs: dict[int, bool] = {}
        self._usable_tokens()
        self.pieces = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        texts = [self.shown.get(i, "").encode() for i in range(max(self.shown) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.letters = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
        self.parts, self.words = Generations(KEPT_PARTS * kept), Generations(KEPT_WORDS * kept)

    def _usable_tokens(self) -> None:
        """The automaton, and each token's longest proper prefix that is a token.

        A token that its own merges do not yield cannot come out of the encoding: it is left out.
        """
        usable = {}
        for text, i in sorted(self.ids.items(), key=lambda x: x[1]):  # parts come before the whole
            parts = self.split.get(i)
            if parts is None or self.may_follow(*parts, below=i):
                usable[text] = i
        self.usable = usable
        self.machine = ahocorasick.Automaton()
        for text, i in usable.items():
            self.machine.add_word(text, i)
        self.machine.make_automaton()
        self.shorter: dict[int, int] = {}
        for text, i in usable.items():
            for n in range(len(text) - 1, 0, -1):
                if (j := usable.get(text[:n])) is not None:
                    self.shorter[i] = j
                    break

    def may_follow(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether ``right`` may stand after ``left``. ``below``: only merges before this one count."""
        known = (left << 32) | right
        if below is None and (answer := self.pairs.get(known)) is not None:
            return answer
        limit = 1 << 62 if below is None else below
        answer = None
        a, b = left, right
        while answer is None:
            if self.joined.get((a, b), limit) < limit:
                answer = False  # this merge would have come first
                break
            inside_a, inside_b = self.split.get(a), self.split.get(b)
            if inside_a is None and inside_b is None:
                answer = True
            elif inside_b is None or (inside_a is not None and a > b):
                limit, a = a, inside_a[1]  # undo the later of the two merges
            else:
                limit, b = b + 1, inside_b[0]
        if below is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[known] = answer
        return answer

    def word(self, text: str) -> bytes:
        """Tokens of one word, given as letters of its UTF-8 bytes without the end."""
        text += END
        if (whole := self.usable.get(text)) is not None:
            return self.packed[whole]
        n, at, previous = len(text), 0, -1
        size, shorter, pairs, follows = self.size, self.shorter, self.pairs, self.may_follow
        out: list[int] = []
        dead: set[int] = set()  # places from which no encoding goes on
        while True:
            token = None
            for end, longest in self.machine.iter_long(text, at):  # the longest tokens one after the other, as long as they fit
                after = at + size[longest]
                if end + 1 != after:
                    break  # no token starts here
                if previous >= 0:
                    fits = pairs.get((previous << 32) | longest)
                    if after in dead or not (follows(previous, longest) if fits is None else fits):
                        token = longest
                        break
                elif after in dead:
                    token = longest
                    break
                out.append(longest)
                previous, at = longest, after
            if at == n:
                packed = self.packed
                return b"".join([packed[i] for i in out])
            while True:  # a shorter token here, or else in the place of the previous one
                token = None if token is None else shorter.get(token)
                if token is None:
                    dead.add(at)
                    token = out.pop()
                    at -= size[token]
                    previous = out[-1] if out else -1
                    continue
                after = at + size[token]
                if after not in dead:
                    if previous < 0:
                        break
                    fits = pairs.get((previous << 32) | token)
                    if follows(previous, token) if fits is None else fits:
                        break
            out.append(token)
            previous, at = token, after

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isalpha():  # letters only: one piece
            words = (text,)
        elif text[-1:] in MARKS and text[:-1].isalpha():  # and a mark: two
            words = (text[:-1], text[-1])
        else:
            words = self.pieces.findall(text)
        out = []
        for piece in words:
            got = self.words.young.get(piece)
            if got is None and (got := self.words.older(piece)) is None:
                got = self.word(piece if piece.isascii() else piece.encode().decode("latin-1"))
                if len(piece) <= KEPT_BYTES:
                    self.words.put(piece, got)
            out.append(got)
        return b"".join(out)

    def part(self, raw: bytes) -> bytes:
        """Tokens of a part of a text without ASCII white space, as little-endian unsigned 32-bit ids."""
        if (got := self.parts.older(raw)) is not None:
            return got
        text = raw.decode()
        if self.cut is not None and "<" in text and (found := self.cut.split(text)):
            got = b"".join(
                self.packed[self.special[x]] if k % 2 else self._plain(x) for k, x in enumerate(found)
            )
        else:
            got = self._plain(text)
        if len(raw) <= KEPT_BYTES:
            self.parts.put(raw, got)
        return got

    def encode(self, raw: bytes) -> bytes:
        """Tokens of a UTF-8 text as little-endian unsigned 32-bit ids."""
        parts, part = self.parts, self.part
        return b"".join([got if (got := parts.young.get(x)) is not None else part(x) for x in raw.split()])

    def encode_all(self, raws: Iterator[bytes]) -> Iterator[bytes]:
        """Tokens of the texts of a batch; equal texts are encoded once."""
        known: dict[bytes, bytes] = {}
        for raw in raws:
            if (got := known.get(raw)) is None:
                got = known[raw] = self.encode(raw)
            yield got

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts with a space between each two, as UTF-8."""
        if not len(ids):
            return b""
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.offsets[ids] - before, lengths) + np.arange(int(lengths.sum()))
        return self.letters[at].tobytes()[:-1]


def encoder(source: bytes, tables: int = 1) -> Bpe:
    """The encoder of a vocabulary file; a worker builds each once."""
    return kept(f"bpe_{tables}_" + hashlib.sha256(source).hexdigest(), lambda: Bpe(source, tables))


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; nulls are empty."""
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def _encode(source, with_text: bool, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(source.value, tables)
        names = ["doc_id", "ids", "decoded"] if with_text else ["doc_id", "ids"]
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                ids = list(bpe.encode_all(raw_texts(part.column(1))))
                columns = [part.column(0), pa.array(ids, pa.binary())]
                if with_text:
                    columns.append(pa.array([bpe.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return task(run, f"bpe_{tables}_")


def encode(docs: DataFrame, tokenizer_path: str, decoded: bool = False, tables: int = 1) -> DataFrame:
    """(doc_id, ids) of each row: ids as little-endian unsigned 32-bit integers in a binary.

    ``decoded`` adds the decoded text as UTF-8. The vocabulary file is read by the driver
    (its size does not depend on the input) and sent to the executors. ``tables``: times the usual size (100 MB in a worker)
    of the tables of words seen before; larger ones save time where there is memory.
    """
    with open(tokenizer_path, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, ids binary" + (", decoded binary" if decoded else "")
    return docs.select("doc_id", "text").mapInArrow(_encode(source, decoded, tables), schema)
