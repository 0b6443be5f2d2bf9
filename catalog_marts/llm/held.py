"""What Python workers keep from task to task: the tables of one operator at a time.

Workers live on between jobs, so without this a worker of a pipeline would hold the vocabulary and
caches of every operator that it has worked for.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps
from typing import Any

import pyarrow as pa

_held: dict[tuple, Any] = {}


def _give_back() -> None:
    """Memory that is free goes back to the system: idle workers would keep some 100 MB of it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def held(key: tuple, build: Callable[[], Any]) -> Any:
    """What was built for ``key``, kept until another key is asked for."""
    pa.default_memory_pool().release_unused()  # what earlier tasks' batches took: hundreds of MB
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def release() -> None:
    """Called by tasks that need their memory for other things."""
    _held.clear()
    _give_back()


def tidied(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task that gives back at its end what its batches took, as its worker may then be idle."""

    @wraps(run)
    def task(*args, **options) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(*args, **options)
        finally:
            _give_back()

    return task
