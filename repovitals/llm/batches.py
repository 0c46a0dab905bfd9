"""Arrow batches in tasks: small slices, and memory handed back when a task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Bytes of a slice, about; a batch of 10,000 long texts would make lists of many times as much.
SLICE_BYTES = 4 << 20

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Return freed memory to the system: Spark keeps Python workers, and stages share the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has no such call
        pass


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def sliced(run: Run) -> Run:
    """The same function of batches, fed with slices of them. Empty batches are left out."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(_slices(batches))
        finally:
            release()

    return wrapped
