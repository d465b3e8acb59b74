"""Memory that a task has freed goes back to the system: Spark keeps its Python workers for later tasks and stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Give back what Arrow and the C library hold without using it (glibc; others keep it)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lean(task: Task) -> Task:
    """The task of a ``mapInArrow``, with ``release`` before it and when it has ended."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return run
