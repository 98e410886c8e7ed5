"""Python workers outlive their tasks and are used again, by other stages too: what they keep is held all along."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_drops: list[Callable[[], None]] = []


def at_end_of_task(drop: Callable[[], None]) -> None:
    """Have ``drop`` called whenever a function of :func:`released` is through with a task."""
    _drops.append(drop)


def release() -> None:
    """Forget what was remembered for speed, and give free memory back to the system."""
    for drop in _drops:
        drop()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # Another C library: nothing to give back by hand.


def released(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over the batches of a task, with :func:`release` at its end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return run
