"""N-gram Jaccard join: documents whose sets of word n-grams overlap by a share or more.

Method: a sparse product of the document by n-gram incidence matrix with its transpose, in blocks.

1. ``profiles``  set size and set fingerprint of every document; counts of all n-grams in a sketch of
   fixed size, which orders the n-grams from rare to frequent.
2. ``postings``  a document emits its rarest n-grams only: two sets over the bound must share one of the
   first ``size - ceil(share * size) + 1``. N-grams of a single set are left out.
3. ``families``  the set that fits an n-gram's other sets best becomes its pivot; all sets that share an
   n-gram with the same pivot form a family, so every pair in question is inside a family.
4. ``survivors``  a family is cut in blocks of bounded size. The product of short count vectors (n-grams by
   hash bucket) bounds the overlaps from above; sets whose every cell is below the bound from the two sizes leave.
5. ``_tile_links``  for the rest the product of whole n-gram sets accumulates overlap counts; cells below the bound are
   discarded, and of the others a spanning forest is emitted.
6. Sets of a family that are still apart meet in tiles of two blocks. Links join to components.

Equal sets are one row throughout, whatever their number of copies.

Nulls and ties: a null or blank text has no n-gram, is linked with nothing and is its own class; a row with a
null id is returned with a null class. Repeated rows are returned as often as given. A text with fewer
words than ``words`` has one n-gram. Other columns are ignored. Hashes have 64 bits.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import materialize
from .wordhash import mix, text_shingles
from .workers import task

CELLS = 1 << 22  # cells of the count sketch
SKETCH_BLOCK = 1 << 16  # cells summed and sent together
HOT = 60_000  # postings of one n-gram that a bucket may hold
BUCKET_POSTINGS = 1_500_000
TILE_TOKENS = 300_000  # n-grams of the sets of one block
DENSE_CELLS = 4_000_000  # of a dense slice of the incidence matrix
WANTED_BITS = 1 << 24  # of the bitmap that tells whose sets are read again; more bits only save work


def set_fingerprint(tokens: np.ndarray) -> int:
    total = int(mix(tokens).sum(dtype=np.uint64)) + len(tokens) * 0x9E3779B97F4A7C15
    return int(mix(np.array([total & (2**64 - 1)], np.uint64)).view(np.int64)[0])


def prefix_length(size: int, percent: int) -> int:
    """So many of the first n-grams, in any common order, two linked sets share at least one of."""
    return size - -(-percent * size // 100) + 1


def bucket_counts(tokens: np.ndarray) -> bytes:
    """Numbers of n-grams by hash bucket, 255 at most; a quarter to a half as many buckets as n-grams."""
    buckets = max(16, 1 << max(0, len(tokens).bit_length() - 2))
    return np.minimum(np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


# --- 1. profiles ---------------------------------------------------------------------------


def _profiles(words: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(cells, np.uint32), set()
        for batch in batches:
            out = ([], [], [], [])
            ids = batch.column(0).to_pylist()
            for row, tokens in text_shingles(batch.column(1), words):
                mark = set_fingerprint(tokens)
                out[0].append(ids[row])
                out[1].append(len(tokens))
                out[2].append(mark)
                out[3].append(bucket_counts(tokens) if mark not in seen else None)
                if mark not in seen:  # copies in one task count once
                    seen.add(mark)
                    np.add.at(counts, (tokens & np.uint64(cells - 1)).astype(np.int64), 1)
            n = len(out[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                ["doc_id", "n", "mark", "shape", "block", "counts"],
            )
        blocks = [b for b in range(0, cells, SKETCH_BLOCK) if counts[b : b + SKETCH_BLOCK].any()]
        packed = [
            zlib.compress(np.minimum(counts[b : b + SKETCH_BLOCK], 65_535).astype(np.uint16).tobytes(), 1) for b in blocks
        ]
        n = len(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
             pa.array([b // SKETCH_BLOCK for b in blocks], pa.int32()), pa.array(packed, pa.binary())],
            ["doc_id", "n", "mark", "shape", "block", "counts"],
        )

    return run


def profiles(docs: DataFrame, words: int, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, mark, shape) of every document, and the sketch as (block, counts) per task.

    ``shape`` (bucket counts) is there once for each set and task.
    """
    made = docs.select("doc_id", "text").mapInArrow(
        task(_profiles(words, cells)), "doc_id long, n long, mark long, shape binary, block int, counts binary"
    )
    made = materialize(made, "profiles")
    return (
        made.filter("block IS NULL").select("doc_id", "n", "mark", "shape"),
        made.filter("block IS NOT NULL").select("block", "counts"),
    )


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one = np.frombuffer(zlib.decompress(packed), np.uint16)
            sums[block] = sums.get(block, 0) + one.astype(np.int64)
    level = [np.where(s >= HOT, 31, np.log2(s + 1).astype(np.int64)).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())], ["block", "level"]
    )


def frequency_levels(sketch: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Level per cell of the sketch: log2 of the count, 31 from ``HOT`` on. ``cells`` bytes, for any input."""
    blocks = cells // SKETCH_BLOCK
    rows = sketch.repartition(max(1, blocks // 4), "block").mapInArrow(task(_sum_blocks), "block int, level binary").collect()
    levels = np.zeros(cells, np.uint8)
    for row in rows:  # at most cells / SKETCH_BLOCK rows
        levels[row.block * SKETCH_BLOCK : (row.block + 1) * SKETCH_BLOCK] = np.frombuffer(row.level, np.uint8)
    return levels


# --- 2. postings ---------------------------------------------------------------------------


def _ordered(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The n-grams as sortable keys: rare ones first, then by hash."""
    level = levels[(tokens & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(58)) | (tokens >> np.uint64(6)))


def _prefixes(words: int, percent: int, levels, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        held, count, seen = [], 0, set()

        def flush():
            keys = np.concatenate([k for k, _, _ in held])
            marks = np.concatenate([np.full(len(k), m, np.int64) for k, m, _ in held])
            sizes = np.concatenate([np.full(len(k), n, np.int32) for k, _, n in held])
            bucket = (mix(keys) % np.uint64(buckets)).astype(np.int32)
            hot = (keys >> np.uint64(58)) == 31  # may be long: dealt out by set, not by n-gram
            bucket[hot] = buckets + (mix(marks[hot].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            keys, marks, sizes, bucket = keys[order], marks[order], sizes[order], bucket[order]
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = [*at[1:], len(bucket)]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[at], pa.int32())]
                + [pa.array([x[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()) for x in (keys, marks, sizes)],
                ["bucket", "keys", "marks", "sizes"],
            )

        for batch in batches:
            for _, tokens in text_shingles(batch.column(0), words):
                if not len(tokens):
                    continue
                mark = set_fingerprint(tokens)
                if mark in seen:
                    continue
                seen.add(mark)
                keys = _ordered(tokens, table)[: prefix_length(len(tokens), percent)]
                held.append((keys, mark, len(tokens)))
                count += len(keys)
                if count >= 1_000_000:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    return run


def _repeated(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_bucket, parts = None, []

        def close():
            keys = np.concatenate([np.frombuffer(k, np.int64) for k, _, _ in parts])
            marks = np.concatenate([np.frombuffer(m, np.int64) for _, m, _ in parts])
            sizes = np.concatenate([np.frombuffer(n, np.int32) for _, _, n in parts])
            order = np.lexsort((marks, keys))
            keys, marks, sizes = keys[order], marks[order], sizes[order]
            new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
            keep = new_key | np.concatenate([[True], marks[1:] != marks[:-1]])
            keys, marks, sizes, new_key = keys[keep], marks[keep], sizes[keep], new_key[keep]
            if open_bucket < buckets:
                alone = new_key & np.concatenate([new_key[1:], [True]])
                keys, marks, sizes = keys[~alone], marks[~alone], sizes[~alone]
            for a in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[a : a + 100_000]) for x in (keys, marks, sizes)], ["token", "node", "n"]
                )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for bucket, *rest in zip(*columns, strict=True):
                if bucket != open_bucket and parts:
                    yield from close()
                    parts = []
                open_bucket = bucket
                parts.append(rest)
        if parts:
            yield from close()

    return run


def postings(docs: DataFrame, words: int, percent: int, levels: np.ndarray, expected: int) -> DataFrame:
    """(token, node, n): rare n-grams that more than one set has. ``node`` is the set's fingerprint."""
    spark = docs.sparkSession
    buckets = max(8, math.ceil(expected / BUCKET_POSTINGS))
    shared = spark.sparkContext.broadcast(levels)
    made = docs.select("text").mapInArrow(
        task(_prefixes(words, percent, shared, buckets)), "bucket int, keys binary, marks binary, sizes binary"
    )
    dealt = made.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket")
    return materialize(dealt.mapInArrow(task(_repeated(buckets)), "token long, node long, n int"), "postings")


# --- 3. families ---------------------------------------------------------------------------


def families(post: DataFrame, percent: int) -> DataFrame:
    """(pivot, node, n): each set with the pivots of its n-grams, pivots included."""
    share = post.groupBy("node").agg(F.count("*").alias("shared"), F.first("n").alias("n"))
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    share = share.select("node", (F.col("shared") * 1000 / prefix).cast("int").alias("fit"))
    rated = post.join(share, "node")
    best = rated.groupBy("token").agg(
        F.max(F.struct("fit", "node")).getField("node").alias("pivot"), F.count("*").alias("sets")
    )
    best = best.filter("sets > 1").drop("sets")
    return post.join(best, "token").select("pivot", "node", "n").distinct()


# --- 4. tiles ------------------------------------------------------------------------------


def _sets(words: int, wanted, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = wanted.value, set()
        for batch in batches:
            places = batch.column(0).to_numpy()
            batch = batch.filter(pa.array((table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1))
            out = []
            for _, tokens in text_shingles(batch.column(1), words):
                if len(tokens) and (mark := set_fingerprint(tokens)) not in seen:
                    seen.add(mark)
                    out.append((mark, tokens.tobytes()))
            for a in range(0, len(out), 500):
                part = out[a : a + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m for m, _ in part], pa.int64()), pa.array([t for _, t in part], pa.binary())],
                    ["node", "tokens"],
                )

    return run


def _place(bits: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(bits))


def read_sets(docs: DataFrame, wanted: DataFrame, words: int, bits: int = WANTED_BITS) -> DataFrame:
    """(node, tokens) of the documents in ``wanted`` (doc_id), and of few others.

    A bitmap of fixed size picks the documents, so no text is shuffled. A node comes once for each task at most.
    """
    place = _place(bits)
    rows = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    table = np.zeros(bits // 8 + 8192, np.uint8)
    for row in rows.collect():  # bits / 32768 + 1 rows of 4 KB at most
        table[row.part * 4096 : (row.part + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    position = F.bitmap_bucket_number(place) * 32768 + F.bitmap_bit_position(place)
    return docs.select(position.alias("place"), "text").mapInArrow(task(_sets(words, shared, bits)), "node long, tokens binary")


def overlap_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common n-grams, all of ``left`` by all of ``right``: a product in dense slices."""
    sizes = [len(t) for t in (*left, *right)]
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    column = column.ravel()
    keep = times[column] > 1
    rows, column = rows[keep], column[keep]
    used = np.flatnonzero(times > 1)
    column = np.searchsorted(used, column)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = max(1, DENSE_CELLS // max(1, len(sizes)))
    for start in range(0, len(used), width):
        a, b = np.searchsorted(column, (start, start + width))
        slab = np.zeros((len(sizes), min(width, len(used) - start)), np.float32)
        slab[rows[a:b], column[a:b] - start] = 1
        out += slab[: len(left)] @ slab[len(left) :].T
    return out.astype(np.int64)


def linked(overlap: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, from the overlap and the two sizes."""
    return 100 * overlap >= percent * (left[:, None] + right[None, :] - overlap)


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a symmetric link matrix."""
    left, out = np.ones(len(link), bool), []
    for root in range(len(link)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            for other in np.flatnonzero(link[at] & left):
                left[other] = False
                out.append((at, int(other)))
                queue.append(int(other))
    return out


def _tiles(percent: int):
    """Links of each tile; rows arrive sorted by tile. side 0: rows, 1: columns, null: both."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        rows = list({(r[0], r[1]): r for r in rows}.values())  # a set may come from several tasks
        if len(rows) < 2:
            return []
        sides = [[r for r in rows if r[0] in (None, s)] for s in (0, 1)]
        if not sides[0] or not sides[1]:
            return []
        nodes = [np.array([r[1] for r in s], np.int64) for s in sides]
        tokens = [[np.frombuffer(r[3], np.uint64) for r in s] for s in sides]
        sizes = [np.array([len(t) for t in s]) for s in tokens]
        if rows[0][0] is None:
            link = linked(overlap_counts(tokens[0], tokens[0]), sizes[0], sizes[0], percent)
            return [(int(nodes[0][a]), int(nodes[0][b])) for a, b in _forest(link)]
        groups = [np.array([r[2] for r in s], np.int64) for s in sides]
        link = linked(overlap_counts(*tokens), *sizes, percent) & (groups[0][:, None] != groups[1][None, :])
        out = {}
        for a, b in np.argwhere(link):  # one link per row and component on the other side is enough
            out.setdefault((a, groups[1][b]), (int(nodes[0][a]), int(nodes[1][b])))
        return list(out.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows, found = None, [], []

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"]
            )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, side, node, group, tokens in zip(*columns, strict=True):
                if key != tile:
                    found += links(rows)
                    tile, rows = key, []
                rows.append((side, node, group, tokens))
            if len(found) > 10_000:
                yield made()
                found = []
        found += links(rows)
        yield made()

    return run


def overlap_bounds(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sums of the smaller counts over the buckets, all rows by all rows: at least the numbers of common n-grams."""
    out, level = np.zeros((len(left), len(right)), np.float32), 1
    full = (left == 255).any() or (right == 255).any()  # such a count may stand for more
    while True:
        used = (left >= level).any(0) & (right >= level).any(0)
        if not used.any():
            break
        out += (left[:, used] >= level).astype(np.float32) @ (right[:, used] >= level).astype(np.float32).T
        level += 1
    return np.where(full, np.inf, out)


def _fold(shapes: list[np.ndarray], buckets: int) -> np.ndarray:
    return np.stack([s.reshape(-1, buckets).sum(0, dtype=np.int32) for s in shapes])


def _survivors(percent: int):
    """Rows of each tile that some row of the other side may be linked with."""
    steps = 1  # between the widths, powers of two, of linked sets
    while steps * percent < 100:
        steps *= 2

    def keep(rows: list[tuple]) -> list[tuple]:
        both = rows[0][3] is None
        shapes = [np.frombuffer(r[6], np.uint8) for r in rows]
        size = np.array([r[5] for r in rows])
        width = np.array([len(s) for s in shapes])
        side = np.array([0 if both else r[3] for r in rows])
        alive = np.zeros(len(rows), bool)
        for w in np.unique(width):  # the larger of two linked sets has 100 / percent times as many n-grams at most
            mine, near = np.flatnonzero(width == w), np.flatnonzero((width >= w) & (width <= w * steps))
            if not both:
                pairs = [(mine[side[mine] == s], near[side[near] == 1 - s]) for s in (0, 1)]
            else:
                pairs = [(mine, near)]
            for a, b in pairs:
                for c in range(0, len(b), 2_000 if w < 1_000 else 100):
                    part = b[c : c + (2_000 if w < 1_000 else 100)]
                    for d in range(0, len(a), 500):
                        own = a[d : d + 500]
                        bound = overlap_bounds(_fold([shapes[i] for i in own], w), _fold([shapes[i] for i in part], w))
                        bound = np.minimum(bound, np.minimum(size[own][:, None], size[part][None, :]))
                        ok = linked(bound, size[own], size[part], percent) & (own[:, None] != part[None, :])
                        alive[own] |= ok.any(1)
                        alive[part] |= ok.any(0)
        return [rows[i] for i in np.flatnonzero(alive)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows, found = None, [], []

        def made():
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            names = [*_TILE, "side", "node", "group"]
            columns = [pa.array([r[k] for r in found], kind) for k, kind in zip((0, 1, 2, 3, 4, 7), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        def close():
            distinct = list({(r[3], r[4]): r for r in rows}.values())
            return keep(distinct) if len(distinct) > 1 else []

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[:3] != tile:
                    found += close()
                    tile, rows = row[:3], []
                rows.append(row)
            if len(found) > 10_000:
                yield made()
                found = []
        found += close()
        yield made()

    return run


_TILE = ["pivot", "row_block", "column_block"]
_MEMBER = ", ".join(["pivot long, row_block int, column_block int, side int, node long, group long"])


def survivors(members: DataFrame, shapes: DataFrame, percent: int, label: str) -> DataFrame:
    rows = members.join(shapes, "node").select(*_TILE, "side", "node", "n", "shape", "group")
    dealt = rows.repartition(*_TILE).sortWithinPartitions(*_TILE)
    return materialize(dealt.mapInArrow(task(_survivors(percent)), _MEMBER), label)




def _tile_links(members: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    rows = members.join(sets, "node").select(*_TILE, "side", "node", "group", "tokens")
    dealt = rows.repartition(*_TILE).sortWithinPartitions(*_TILE)
    return materialize(dealt.mapInArrow(task(_tiles(percent)), "a long, b long"), label)


def _blocks(count: str, node: str = "node"):
    return F.pmod(F.xxhash64(node), F.col(count)).cast("int")


# --- the operator --------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 75, cells: int = CELLS) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable over links) of every row of ``docs``."""
    profile, sketch = profiles(docs, words, cells)
    levels = frequency_levels(sketch, cells)
    distinct = profile.filter("n > 0 AND doc_id IS NOT NULL").groupBy("mark").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n")
    )
    distinct = materialize(distinct, "distinct")
    expected = distinct.agg(F.coalesce(F.sum(F.col("n")), F.lit(0))).first()[0] * (100 - percent) // 100
    usable = docs.filter("doc_id IS NOT NULL")
    post = postings(usable, words, percent, levels, expected)
    family = materialize(families(post, percent), "families")
    sizes = family.groupBy("pivot").agg(F.ceil(F.sum("n") / TILE_TOKENS).cast("int").alias("blocks"))
    family = family.join(sizes, "pivot")
    shapes = profile.filter("shape IS NOT NULL").select(F.col("mark").alias("node"), "n", "shape")
    shapes = materialize(shapes.join(family.select("node").distinct(), "node", "left_semi"), "shapes")

    # all pairs inside a block, and the pivot with every block
    turn = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pivots = family.filter("node = pivot").select("*", turn.alias("row_block"))
    others = family.filter("node <> pivot").withColumn("row_block", _blocks("blocks"))
    inside = pivots.unionByName(others).select(
        "pivot", "row_block", F.lit(0).alias("column_block"), F.lit(None).cast("int").alias("side"),
        "node", F.lit(None).cast("long").alias("group"),
    )
    inside = survivors(inside, shapes, percent, "inside")
    wanted = distinct.withColumnRenamed("mark", "node")
    sets = materialize(read_sets(usable, wanted.join(inside.select("node").distinct(), "node"), words), "sets")
    links = _tile_links(inside, sets, percent, "links")

    # sets that are not yet with their pivot, with the other blocks of their family
    many = family.filter("blocks > 1")
    if not many.isEmpty():
        group = materialize(components(links, "near"), "groups")
        named = many.join(group.withColumnRenamed("component", "group"), "node", "left")
        named = named.withColumn("group", F.coalesce("group", "node")).withColumn("own", _blocks("blocks"))
        heart = named.filter("node = pivot").select("pivot", F.col("group").alias("heart"))
        named = materialize(named.join(heart, "pivot"), "named")
        rows = named.filter("group <> heart").select(
            "pivot", F.col("own").alias("row_block"), turn.alias("column_block"), F.lit(0).alias("side"), "node", "group"
        )
        open_blocks = rows.select("pivot", "row_block").distinct()
        columns = named.join(open_blocks, "pivot").select(
            "pivot", "row_block", F.col("own").alias("column_block"), F.lit(1).alias("side"), "node", "group"
        )
        apart = rows.filter("row_block <> column_block").unionByName(columns.filter("row_block <> column_block"))
        apart = survivors(apart, shapes, percent, "apart")
        more = wanted.join(apart.select("node").distinct(), "node").join(inside.select("node"), "node", "left_anti")
        sets = sets.unionAll(materialize(read_sets(usable, more, words), "sets"))
        links = links.unionAll(_tile_links(apart, sets, percent, "far"))

    # classes carry the least doc_id of their sets
    group = components(links)
    joined = distinct.join(group.withColumnRenamed("node", "mark"), "mark", "left")
    joined = joined.withColumn("component", F.coalesce("component", "mark"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    classes = joined.join(least, "component").select("mark", "component_id")
    return profile.join(classes, "mark", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id")).alias("component_id"),
    )
