"""Early stopping as an associative summary of blocks of epochs.

A run stops at the first epoch that comes ``patience`` epochs after its best one. What a block does to a run depends on the best loss
so far and on the epochs since then (the streak), and only in its first ``patience`` epochs: if none of them improves in time the run stops
there, and once one has, the rest of the block goes its own way. So a block is summed up by its first epochs, its
improvements among them, the first stop after these, and its best epoch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module

SUMMARY = [
    "run_id", "block", "n", "epochs", "places", "losses", "stop_at", "stop_epoch", "stop_best_epoch", "stop_best_loss",
    "best_at", "best_epoch", "best_loss", "last_epoch",
]
END = ["run_id", "best_epoch", "best_val_loss", "last_epoch", "epochs_run", "stopped_early"]


def summary(epochs: np.ndarray, losses: np.ndarray, patience: int) -> tuple:
    """The columns of ``SUMMARY`` from ``n`` on, of one block; an unknown loss (nan) improves nothing."""
    n = len(epochs)
    known = np.where(np.isnan(losses), np.inf, losses)
    before = np.concatenate([[np.inf], np.minimum.accumulate(known)[:-1]])
    better = np.flatnonzero(known < before)  # improvements on the block's own epochs
    first = better[better < patience]
    stop = (None,) * 4
    if len(first):
        later = better[better >= first[-1]]
        wide = np.flatnonzero(np.diff(np.append(later, n)) > patience)  # an improvement right at the stop would come in time
        if len(wide):
            best = later[wide[0]]
            at = best + patience
            stop = (int(at), int(epochs[at]), int(epochs[best]), float(losses[best]))
    end = (int(better[-1]), int(epochs[better[-1]]), float(losses[better[-1]])) if len(better) else (None,) * 3
    return (n, epochs[:patience].tolist(), first.tolist(), losses[first].tolist(), *stop, *end, int(epochs[-1]))


def combined(blocks: Iterator[tuple], patience: int) -> tuple:
    """The columns of ``END`` after the run's id, from the summaries of a run in order."""
    best_epoch = best_loss = last = None
    level, streak, count = np.inf, 0, 0
    for n, epochs, places, losses, at, epoch, stop_best_epoch, stop_best_loss, best_at, block_epoch, block_loss, last in blocks:
        entry = next((k for k, (place, loss) in enumerate(zip(places, losses, strict=True)) if loss < level), None)
        if entry is None or places[entry] > patience - streak - 1:
            if n >= patience - streak:
                place = patience - streak - 1
                return best_epoch, best_loss, epochs[place], count + place + 1, True
            streak += n
        elif at is not None:
            return stop_best_epoch, stop_best_loss, epoch, count + at + 1, True
        else:
            best_epoch, best_loss, level = block_epoch, block_loss, block_loss
            streak = n - 1 - best_at
        count += n
    return best_epoch, best_loss, last, count, False


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches(rows: Iterator[tuple], names: list[str], first: Callable[[], pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = {"run_id": first(), "epochs": pa.list_(pa.int64()), "places": pa.list_(pa.int64()), "losses": pa.list_(pa.float64()), "stopped_early": pa.bool_()}
        columns = [
            pa.array(c, kinds.get(name, pa.float64() if name.endswith("loss") else pa.int64()))
            for name, c in zip(names, zip(*held, strict=True), strict=True)
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    for row in rows:
        held.append(row)
        if len(held) == 1_000:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _typed(batches: Iterator[pa.RecordBatch], kind: list) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind[:] = [batch.schema.field(0).type]
        yield batch


def blocks(patience: int):
    """Summaries of rows (run_id, block, epoch, loss) that come in this order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def made() -> Iterator[tuple]:
            for key, rows in groupby(_rows(_typed(batches, kind)), key=lambda r: r[:2]):
                own = [r[2:] for r in rows]  # the rows of a block at most
                losses = np.array([np.nan if x is None else x for _, x in own], np.float64)
                yield (*key, *summary(np.array([e for e, _ in own], np.int64), losses, patience))

        yield from _batches(made(), SUMMARY, lambda: kind[0])

    return run


def runs(patience: int):
    """Ends of runs, from summaries that come in the order of their runs and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list = []

        def made() -> Iterator[tuple]:
            for key, rows in groupby(_rows(_typed(batches, kind)), key=lambda r: r[0]):
                end = combined((r[2:] for r in rows), patience)
                for _ in rows:  # what comes after the stop
                    pass
                yield (key, *end)

        yield from _batches(made(), END, lambda: kind[0])

    return run
