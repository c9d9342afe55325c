"""What a Python worker keeps between tasks.

Workers are reused by later stages, so only the cache of the operator at work
is kept: asking for another one, or a ``released`` function, lets the old one
go, and gives the memory that is free in the process back to the system.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_kept: dict[Hashable, object] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def _let_go() -> None:
    _kept.clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """The object under ``key``, made once; any other one is dropped."""
    if key not in _kept:
        _let_go()
        _kept[key] = make()
    return _kept[key]  # type: ignore[return-value]


def release() -> None:
    _let_go()


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, without the cache of another
    operator, and without leaving its own scratch to an idle worker."""

    def task(batches: Iterator) -> Iterator:
        release()
        yield from run(batches)
        release()

    return task
