"""Memory of Python workers, which Spark reuses from task to task and from operator to operator."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

#: Encoders of this process, by kind and vocabulary file.
_encoders: dict[tuple, object] = {}


def shared_encoder(kind: type, path: str):
    """The encoder of this process; it stays until a task runs that does not encode."""
    if (kind, path) not in _encoders:
        _encoders.clear()
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]


def give_back() -> None:
    """Return what is free to the system: else a worker stays as large as its largest task."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def encoding_task(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of Arrow batches that gives back memory at its end and keeps its encoder."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def plain_task(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same for one that needs no encoder, and so drops what earlier ones left."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        _encoders.clear()
        yield from encoding_task(run)(batches)

    return task
