"""What a Python worker keeps from task to task, and what it gives back after each."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """The one table of this worker that outlives a task. A table under another key is dropped first."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drop what earlier tasks of this worker have kept."""
    _kept.clear()


def give_back() -> None:
    """Memory that Arrow and the C library hold unused goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator], *, keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """A function over batches that leaves its worker small.

    Spark uses a worker again for other stages, so what one operator left would lie beside the next one's tables.
    With ``keeps`` the table of an earlier task of the same operator stays for this one.
    """

    @wraps(run)
    def whole(batches):
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole
