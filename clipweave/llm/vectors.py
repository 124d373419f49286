"""Embedding columns as matrices, and coarse cells fitted on a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unit vectors travel as 16-bit integers: half the bytes, and cosines right to about 0.00001.
SCALE = 32767.0


def unit_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the usable rows, their vectors at unit length): of `dims` finite values, not null and not all zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    lengths[np.asarray(column.is_null())] = -1
    at = np.flatnonzero(lengths == dims)
    values = column.values.to_numpy(zero_copy_only=False)
    x = values[offsets[at][:, None] + np.arange(dims)].astype(np.float32) if len(at) else np.zeros((0, dims), np.float32)
    # Scaled by the largest value first, so that neither tiny nor huge vectors lose their length.
    with np.errstate(invalid="ignore", over="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
    ok = np.isfinite(top) & (top > 0)
    if not ok.all():
        at, x, top = at[ok], x[ok], top[ok]
    x = x / top[:, None]
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return at, x


def pack(x: np.ndarray) -> pa.Array:
    """Unit rows as binary values of 16-bit integers."""
    return rows_as_binary(np.rint(x * SCALE).astype(np.int16))


def rows_as_binary(rows: np.ndarray) -> pa.Array:
    """The rows of a contiguous array as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    fixed = pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows)])
    return fixed.cast(pa.binary())


def binary_rows(column: pa.Array | pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    """Binary values of equal length as the rows of an array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), width)


def unpack(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Unit rows from their binary values."""
    x = binary_rows(column, np.int16, dims).astype(np.float32)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def sample(vectors: DataFrame, key: str, column: str, dims: int, rows: int, seed: int = 0) -> np.ndarray:
    """About `rows` usable unit vectors (all of them if there are fewer), picked by a hash of the key: the same on every run.

    Copies of a vector count once, so that a vector many records share can't crowd out the rest. The bound is `rows`
    plus a tenth; what the hash picks beyond it is left.
    """
    total = vectors.count()
    every = max(1, total // max(rows, 1))
    picked = vectors.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(every)) == 0).select(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = unit_rows(batch.column(0), dims)
            yield pa.RecordBatch.from_arrays([pack(np.unique(x, axis=0)) if len(x) else pa.array([], pa.binary())], names=["v"])

    got = picked.mapInArrow(run, "v binary").limit(rows + rows // 10).toArrow()["v"]
    x = unpack(got, dims)
    return np.unique(x, axis=0) if len(x) else x


def fit_cells(x: np.ndarray, cells: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Unit centroids of spherical k-means: started from random rows, empty cells moved to the rows served worst."""
    rng = np.random.default_rng(seed)
    cells = max(1, min(cells, len(x)))
    c = x[rng.choice(len(x), cells, replace=False)].copy()
    for _ in range(rounds):
        best, sim = nearest(x, c)
        sums = group_sums(x, best, cells)
        length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        empty = np.flatnonzero(length < 1e-6)
        if len(empty):
            sums[empty] = x[np.argsort(sim)[: len(empty)]]
            length[empty] = 1
        c = sums / length[:, None]
    return c.astype(np.float32)


def group_sums(x: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the rows of each group."""
    order = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[order], np.arange(groups))
    count = np.diff(np.append(begin, len(x)))
    sums = np.add.reduceat(np.concatenate([x[order], np.zeros((1, x.shape[1]), x.dtype)]), begin, axis=0)
    sums[count == 0] = 0
    return sums


def nearest(x: np.ndarray, c: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and its cosine."""
    best, sim = np.empty(len(x), np.int64), np.empty(len(x), np.float32)
    for s in range(0, len(x), block):
        g = x[s : s + block] @ c.T
        best[s : s + block] = g.argmax(axis=1)
        sim[s : s + block] = g[np.arange(len(g)), best[s : s + block]]
    return best, sim


def top_cells(x: np.ndarray, c: np.ndarray, m: int, block: int = 4096) -> np.ndarray:
    """The m nearest centroids of each row, the nearest first."""
    m = min(m, len(c))
    out = np.empty((len(x), m), np.int32)
    for s in range(0, len(x), block):
        g = x[s : s + block] @ c.T
        if m == 1:
            out[s : s + block, 0] = g.argmax(axis=1)
            continue
        part = np.argpartition(-g, m - 1, axis=1)[:, :m]
        order = np.argsort(-np.take_along_axis(g, part, 1), axis=1, kind="stable")
        out[s : s + block] = np.take_along_axis(part, order, 1)
    return out
