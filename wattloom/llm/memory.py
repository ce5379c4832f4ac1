"""Memory of long-lived Python workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library keeps its own counsel
    _trim = None


def give_back() -> None:
    """Return freed memory to the system; allocators keep it for a worker's next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def frugal(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that gives memory back when it is done."""

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
