"""Python workers live on after a task; what it has freed goes back to the system."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Hand free pages of Arrow and the C library back; where that cannot be done, nothing."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Run) -> Run:
    """The same function over batches, which ends with `release`."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied
