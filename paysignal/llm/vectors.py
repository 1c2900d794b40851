"""Vectors in Arrow batches: array columns as numpy matrices, packed rows, and best-of merging."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable(batch: pa.RecordBatch, name: str, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold a vector without null or non-finite components, their
    matrix in double precision); shorter vectors end in zeros."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(lengths)) > 0
    ok = pc.is_valid(column).to_numpy(zero_copy_only=False) & ~bad
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    full = np.zeros((len(lengths), dims))
    inside = ok[row]
    full[row[inside], place[inside]] = values[inside]
    rows = np.flatnonzero(ok)
    return rows, full[rows]


def dimensions(df: DataFrame, vector: str) -> int:
    return max(0, df.agg(F.max(F.size(vector))).first()[0] or 0)


def pack(matrix: np.ndarray) -> pa.Array:
    """One binary value per row."""
    width = matrix.shape[1] * matrix.itemsize
    data = pa.py_buffer(np.ascontiguousarray(matrix))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(max(width, 1)), len(matrix), [None, data]).cast(pa.binary()) if width else pa.array([b""] * len(matrix), type=pa.binary())


def unpack(column: pa.ChunkedArray | pa.Array, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dims)


def best(found: DataFrame, k: int) -> DataFrame:
    """Of ``query_id, vec_id, score`` each query's k highest scores, ties to the smaller vec_id, with ``rank`` from 1."""
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
