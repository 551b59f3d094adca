"""Memory of Python workers."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def handed_back() -> None:
    """Give what Arrow and the C library hold but do not use back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Run) -> Run:
    """``run`` as a task's function that hands memory back when its rows are done.

    Workers live on after a task.  While later stages fill the executor's heap, idle ones would keep the most that
    their own stage once took.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            handed_back()

    return task
