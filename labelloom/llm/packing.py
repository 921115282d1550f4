"""Best-fit packing of token sequences by linear grouping.

1. Sequences longer than a bin are cut into full bins and a rest (``cut``).
2. The rests are counted by length: at most ``capacity`` counts, whatever the number of documents.
3. ``plan_packing`` works on these counts. Linear grouping: the large lengths are put into groups of equal numbers of
   pieces, and every piece counts as long as its group's longest. For these few sizes, fillings of a bin
   are optimised one after the other: the fullest filling, that uses up the scarce large sizes first, is repeated as
   often as the counts allow.
4. Actual lengths replace the sizes, which leaves some room more; small pieces go where they fit best: longest first, into
   the bin with the least room that holds them; what is left opens new bins.
   Bins that are alike are one entry with a number throughout.
5. Every piece gets its rank among those of its length, and the plan's runs of ranks say where it goes. Ranks are counted
   in two levels (per slice of ids, then inside a slice), so no task sees all pieces of a length.

Nulls: a null text is empty and packs as a piece of length 0 at offset 0 of a sequence of its own kind. Rows with equal ids
are packed each; a null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder, raw_texts
from .scratch import materialize
from .workers import task

CAPACITY = 2048
#: (groups, divisor): sizes that large lengths are rounded up to, and lengths up to capacity / divisor are small.
TRIES = ((24, 2), (24, 3), (64, 3), (24, 4))
SLICES = 4096  # slices of the ids for ranks


# --- pieces ----------------------------------------------------------------------------------


def _pieces(source, capacity: int, end_id: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(source.value, tables)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = ([], [], [], [], [])
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode_all(raw_texts(batch.column(1))), strict=True):
                ids += end
                for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                    one = ids[start : start + 4 * capacity]
                    for column, value in zip(out, (doc, k, start // 4, len(one) // 4, zlib.crc32(one)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return task(run, f"bpe_{tables}_")


def cut(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, tables: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the tokens of each text and ``end_id``, cut into pieces."""
    with open(tokenizer_path, "rb") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(source, capacity, end_id, tables), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# --- plan ------------------------------------------------------------------------------------


def linear_groups(counts: dict[int, int], groups: int) -> dict[int, int]:
    """Rounded-up length of every length: groups with about equal numbers of pieces, cut between lengths."""
    total, out = sum(counts.values()), {}
    done, held, number = 0, [], 1
    for length in sorted(counts):
        held.append(length)
        done += counts[length]
        if done * groups >= number * total:
            out.update(dict.fromkeys(held, length))
            held, number = [], done * groups // total + 1
    return out


def _fullest(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """Sizes, largest first, with repetition, whose sum is as near below ``room`` as the counts allow."""
    best: dict[int, list[int]] = {0: []}
    for size in sorted(sizes, reverse=True):
        for total, items in list(best.items()):
            for k in range(1, min(left[size], (room - total) // size) + 1):
                best.setdefault(total + k * size, items + [size] * k)
    return best[max(best)]


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(filling, times): fills bins from the largest size down, each with the fullest filling of what is left."""
    left, out = dict(counts), []
    while left:
        top = max(left)
        left[top] -= 1
        filling = (top, *_fullest([s for s in left if left[s]], left, capacity - top))
        left[top] += 1
        used = Counter(filling)
        times = min(left[s] // k for s, k in used.items())
        out.append((filling, times))
        for s, k in used.items():
            left[s] -= k * times
        left = {s: n for s, n in left.items() if n}
    return out


def _place_best(bins: dict[tuple[int, ...], int], counts: dict[int, int], capacity: int) -> None:
    """Best fit, longest first: each piece to a bin with the least room that holds it. ``bins`` counts like bins."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for content, n in bins.items():
        by_room[capacity - sum(content)][content] = n
    rooms = sorted(by_room)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # no bin holds it: open bins
                per = capacity // length
                full, rest = divmod(left, per)
                for content, n in (((length,) * per, full), ((length,) * rest, 1 if rest else 0)):
                    if n:
                        room = capacity - sum(content)
                        if room not in by_room or not by_room[room]:
                            bisect.insort(rooms, room)
                        by_room[room][content] = by_room[room].get(content, 0) + n
                left = 0
                break
            room = rooms[at]
            content, n = by_room[room].popitem()
            per = min(room // length, left)
            used = min(n, left // per)
            if used < n:
                by_room[room][content] = n - used
            if not by_room[room]:
                rooms.pop(at)
            filled = content + (length,) * per
            rest = room - per * length
            if rest not in by_room or not by_room[rest]:
                bisect.insort(rooms, rest)
            by_room[rest][filled] = by_room[rest].get(filled, 0) + used
            left -= used * per
    bins.clear()
    for inner in by_room.values():
        for content, n in inner.items():
            bins[content] = bins.get(content, 0) + n


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, tries=TRIES) -> list:
    """(content, times) of all bins: ``content`` are lengths that fit one bin. ``counts``: pieces by length.

    Of the plans for the given numbers of groups and bounds of smallness the one with the fewest bins is taken.
    """
    plans = [_plan(counts, capacity, groups, small) for groups, small in tries]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> list:
    counts = {length: n for length, n in counts.items() if length > 0}
    large = {length: n for length, n in counts.items() if length > capacity // small}
    bins: dict[tuple[int, ...], int] = {}
    if large:
        rounded = linear_groups(large, groups)
        sizes: dict[int, int] = Counter()
        stock: dict[int, list[list[int]]] = defaultdict(list)
        for length in sorted(large, reverse=True):
            sizes[rounded[length]] += large[length]
            stock[rounded[length]].append([length, large[length]])
        for filling, times in configurations(sizes, capacity):
            while times:  # actual lengths take the places of the sizes, in runs
                need = Counter(filling)
                take = times
                picks: dict[int, list[int]] = {}
                for size, k in need.items():
                    # k places of this size: take them from the first length that lasts, else piece by piece
                    own, picked = stock[size], []
                    if own[-1][1] >= k:
                        picked = [own[-1][0]] * k
                        take = min(take, own[-1][1] // k)
                    else:
                        take, rest, at = 1, k, len(own) - 1
                        while rest:
                            got = min(rest, own[at][1])
                            picked += [own[at][0]] * got
                            rest -= got
                            at -= 1
                    picks[size] = picked
                for size, picked in picks.items():
                    for length, k in Counter(picked).items():
                        entry = next(e for e in reversed(stock[size]) if e[0] == length)
                        entry[1] -= k * take
                    stock[size] = [e for e in stock[size] if e[1]]
                key = tuple(sorted((x for p in picks.values() for x in p), reverse=True))
                bins[key] = bins.get(key, 0) + take
                times -= take
    _place_best(bins, {length: n for length, n in counts.items() if length not in large}, capacity)
    return sorted(bins.items())


def runs_of(plan: list) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, places, offset) of the plan, for each length.

    The piece of rank r goes to sequence ``first + (r - first_rank) // places`` and there to
    ``offset + (r - first_rank) % places * length``.
    """
    given: dict[int, int] = Counter()
    out, sequence = [], 0
    for content, times in plan:
        offset = 0
        for length, places in sorted(Counter(content).items(), reverse=True):
            start = given[length]
            given[length] += places * times
            out.append((length, start, given[length] - 1, sequence, places, offset))
            offset += places * length
        sequence += times
    return out


# --- the operator ------------------------------------------------------------------------------


def with_rank(pieces: DataFrame) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0; counted per slice of ids first."""
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)).cast("int"))
    sizes = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece")
    ranked = sliced.withColumn("at", F.row_number().over(inside) - 1)
    return ranked.join(starts, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("at")).drop("slice", "at", "before")


def pack(pieces: DataFrame, capacity: int = CAPACITY, tries=TRIES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces (with doc_id, piece and length of at most ``capacity``).

    The driver gets one count per length, at most ``capacity + 1`` rows.
    """
    spark = pieces.sparkSession
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, capacity, tries)
    runs = runs_of(plan)
    last = sum(n for _, n in plan)
    if counts.get(0):
        runs.append((0, 0, counts[0] - 1, last, counts[0], 0))
    names = ("length", "first", "last", "sequence", "places", "place")
    # an Arrow table stays in the driver, where a list would go through Python workers of a second kind, which then stay
    table = spark.createDataFrame(pa.table({name: pa.array([run[k] for run in runs], pa.int64()) for k, name in enumerate(names)}))
    ranked = with_rank(pieces)
    starts = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "places", "place"))).alias("runs"))
    found = ranked.join(F.broadcast(starts), "length")
    run = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    placed = found.withColumn("run", run).withColumn("step", F.col("rank") - F.col("run.first"))
    return placed.select(
        *pieces.columns,
        (F.col("run.sequence") + F.floor(F.col("step") / F.col("run.places"))).cast("long").alias("sequence_id"),
        (F.col("run.place") + F.pmod(F.col("step"), F.col("run.places")) * F.col("length")).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, tries=TRIES, tables: int = 1
) -> DataFrame:
    """Pieces of all documents with their sequence and place there: tokenized once (``tables``: see ``bpe.encode``), packed by length counts."""
    return pack(materialize(cut(docs, tokenizer_path, capacity, end_id, tables), "pieces"), capacity, tries)
