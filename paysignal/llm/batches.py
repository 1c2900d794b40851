"""Arrow batches inside tasks: columns by name, in slices of bounded text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once in a Python worker; a longer text is a slice alone.
SLICE_BYTES = 2 << 20


def released(run: Callable) -> Callable:
    """``run`` of ``mapInArrow``, which at its end gives the memory it has freed back to the
    system: Spark keeps Python workers for later tasks, beside those of other stages."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return work


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose text together stays under ``limit`` bytes."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as str; null is empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length-1 of each run, one run after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
