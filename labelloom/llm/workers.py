"""Memory of Python workers, which Spark keeps between tasks and stages.

What a task has freed mostly stays with its worker, and an executor has several: ``task`` gives it back to the system at a task's end. Tables that
are dear to build stay for the next task of the same kind (``kept``); a task of another kind drops them first.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa

_NAME = "labelloom_worker_tables"


def _tables() -> dict:
    return sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__


def kept(name: str, build: Callable):
    """The worker's table of this name; built when it is missing."""
    held = _tables()
    if "kept_" + name not in held:
        held["kept_" + name] = build()
    return held["kept_" + name]


def drop_tables(but: str | None = None) -> None:
    """Drop all tables whose names do not start with ``but``."""
    held = _tables()
    for name in [n for n in held if n.startswith("kept_") and not (but and n.startswith("kept_" + but))]:
        del held[name]


def give_back() -> None:
    """Return freed memory to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def task(run: Callable[[Iterator], Iterator], tables: str | None = None) -> Callable[[Iterator], Iterator]:
    """``run``, a function for ``mapInArrow``, for workers that hold memory only while they need it."""

    def bounded(batches: Iterator) -> Iterator:
        drop_tables(tables)
        try:
            yield from run(batches)
        finally:
            give_back()

    return bounded
