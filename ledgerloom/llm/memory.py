"""Memory of Python workers, which outlive their tasks: what a task held is given back when it ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def trim() -> None:
    """Hand memory that is free in the Arrow pool and the C library back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # A C library without such a call keeps what it has.
        pass


def released(run: Callable[[Batches], Batches], forget: Callable[[], None] | None = None) -> Callable[[Batches], Batches]:
    """``run`` over a partition; at its end ``forget`` is called and free memory is handed back."""

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            trim()

    return whole
