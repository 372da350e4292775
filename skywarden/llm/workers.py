"""Memory of Python workers: a worker serves the tasks of later stages too, and keeps what an earlier one had taken."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def free() -> None:
    """Hand what is no longer used back to the system: Python's objects, Arrow's pool, and the C library's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches, freeing memory at the end of a task."""
    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        work = run(batches)
        try:
            yield from work
        finally:
            # What the generator holds goes with it.
            work.close()
            del work
            free()
    return whole
