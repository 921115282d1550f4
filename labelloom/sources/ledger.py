"""Ledger of calls: replies of a user's function, committed one by one under the digest of what was asked.

A task that is tried again, a speculative copy of it, or a later run reads what has been answered instead of asking again. The folder must be one that all
executors share, as a path or URI of any file system that pyarrow opens (a mount, hdfs, object stores).
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Callable

import pyarrow.fs as fs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # a cluster needs no copy of this module


class Ledger:
    """``name`` tells apart what different functions say to the same question."""

    def __init__(self, folder: str, name: str = "replies"):
        self.folder, self.name = folder, name

    def _place(self, asked: str) -> tuple[fs.FileSystem, str]:
        digest = hashlib.sha256(asked.encode("utf-8", "surrogatepass")).hexdigest()
        system, root = fs.FileSystem.from_uri(self.folder)
        return system, f"{root.rstrip('/')}/{self.name}/{digest[:2]}/{digest}"

    def get(self, asked: str) -> str | None:
        system, path = self._place(asked)
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as f:
            return f.read().decode()

    def put(self, asked: str, reply: str) -> None:
        """Commit a reply whole or not at all; of two at once the later stays."""
        system, path = self._place(asked)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(reply.encode())
        system.move(part, path)

    def through(self, fn: Callable[[str], str | None]) -> Callable[[str], str | None]:
        """``fn`` that asks only what the ledger has no reply to. Errors and empty replies are not committed."""

        def asked_once(asked: str) -> str | None:
            known = self.get(asked)
            if known is not None:
                return known
            reply = fn(asked)
            if reply:
                self.put(asked, reply)
            return reply

        return asked_once
