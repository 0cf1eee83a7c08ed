"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """The object under ``key``, made once for each worker process.

    Spark uses a worker for one stage after the other. It keeps the tables of one operator at a
    time: asking for another key lets go of what was held, so stages do not add up their memory.
    """
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]  # type: ignore[return-value]


def release() -> None:
    """Let go of what an earlier stage has left; operators without tables of their own begin with this."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":  # what Python has freed goes back to the machine, where the C library can do that
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def slices(batch: pa.Array, rows: int) -> Iterator[pa.Array]:
    """A batch in parts of so many rows, without copying; an empty one as it is."""
    return (batch.slice(i, rows) for i in range(0, max(1, len(batch)), rows))
