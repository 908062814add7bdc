"""Exact scatter of embeddings from bit planes, and their projection on whitened principal components."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import matrix, stored
from surveyloom.llm.topk import usable

SCALE, SHIFT = 1024, 100_000
#: Rows whose bit planes a task holds at a time.
BLOCK_ROWS = 1 << 14
#: Whole numbers stop here on both sides, so that their differences fit machine words.
END = 1 << 61
LIMBS, LIMB_BITS = 6, 32
WORD_BITS = 62


class Scatter(NamedTuple):
    """Row count, sums and cross-products of whole vectors, as exact integers."""

    n: int
    sums: list[int]
    cross: list[list[int]]


class Components(NamedTuple):
    """Leading unit eigenvectors (columns), their eigenvalues and share of the variance; null variance is NaN."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) + SHIFT of each component, as longs that stop at END."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * matrix(vectors, dims)), -END, END).astype(np.int64) + SHIFT


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (planes, ceil(rows / 64)) of the bits that some row has, with the dimension and bit of each plane.

    Row r of a plane is bit r of its words. Planes come by dimension, then bit; `shifted` is not negative.
    """
    rows, dims = shifted.shape
    bits = int(shifted.max(initial=0)).bit_length()
    words = -(-rows // 64)
    planes = np.zeros((dims, bits, words * 8), np.uint8)
    columns = np.ascontiguousarray(shifted.T)
    for bit in range(bits):
        planes[:, bit, : -(-rows // 8)] = np.packbits((columns >> bit & 1).astype(np.uint8), axis=1, bitorder="little")
    planes = planes.reshape(dims * bits, words * 8).view("<u8")
    there = np.flatnonzero(planes.any(axis=1))
    return planes[there], there // max(bits, 1), there % max(bits, 1)


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products of the rows of `x` (longs), as arrays of Python integers.

    Each dimension is shifted by its least value. The cross-product of two dimensions is the sum over their bit planes
    of 2 ** (both bits) times the number of rows that have both, which is a popcount of an AND of words; the shift is
    taken back in whole numbers.
    """
    rows, dims = x.shape
    low = x.min(axis=0)
    planes, dim, bit = bit_planes(x - low)
    top = int(bit.max(initial=0)) + 1
    kind = np.int64 if 2 * top + rows.bit_length() <= WORD_BITS else object
    weight = np.array([1 << int(b) for b in bit], kind)
    inner = np.zeros((dims, dims), kind)
    sums = np.zeros(dims, kind)
    present, starts = np.unique(dim, return_index=True)
    for p in range(len(planes)):
        own = np.searchsorted(present, dim[p])
        first = starts[own]
        both = np.bitwise_count(planes[p] & planes[first:]).sum(axis=1, dtype=np.int64)
        inner[dim[p], present[own:]] += np.add.reduceat(both.astype(kind) * weight[first:], starts[own:] - first) * weight[p]
        sums[dim[p]] += int(both[p - first]) * weight[p]
    inner = inner + np.triu(inner, 1).T
    low, sums, inner = low.astype(object), sums.astype(object), inner.astype(object)
    moved = np.multiply.outer(low, sums)
    return sums + rows * low, inner + moved + moved.T + rows * np.multiply.outer(low, low)


def limbs(values: list[int]) -> list[pa.Array]:
    """Whole numbers as columns of 32-bit limbs, of which the last has the sign: sums of limbs give exact sums."""
    last = LIMB_BITS * (LIMBS - 1)
    return [pa.array([v >> last if k == LIMBS - 1 else v >> LIMB_BITS * k & (1 << LIMB_BITS) - 1 for v in values],
                     pa.int64()) for k in range(LIMBS)]


def scatter(vectors: DataFrame, dims: int, block_rows: int = BLOCK_ROWS) -> Scatter:
    """Exact count, sums and cross-products of all rows of `vectors` (embedding), as whole numbers.

    A task adds up blocks of rows and puts out dims * (dims + 1) / 2 cross-products; these are added by (i, j) in
    limbs, so the driver gets one row for each, however many vectors there are.
    """
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        held: list[np.ndarray] = []

        def add() -> None:
            nonlocal sums, cross
            s, c = cross_products(np.concatenate(held))
            sums, cross = sums + s, cross + c
            held.clear()

        for batch in batches:
            x = whole(batch.column(0), dims)
            for low in range(0, len(x), block_rows):
                held.append(x[low: low + block_rows])
                n += len(held[-1])
                if sum(map(len, held)) >= block_rows:
                    add()
        if held:
            add()
        if n:
            i = np.concatenate([[-1], np.full(dims, -1), upper[0]])
            j = np.concatenate([[-1], np.arange(dims), upper[1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), *limbs([n, *sums, *cross[upper]])], names=["i", "j", *names])

    names = [f"l{k}" for k in range(LIMBS)]
    parts = vectors.select("embedding").mapInArrow(run, "i long, j long, " + ", ".join(f"{c} long" for c in names))
    added = parts.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in names)).collect()
    exact = {(r["i"], r["j"]): sum(r[c] << LIMB_BITS * k for k, c in enumerate(names)) for r in added}
    return Scatter(exact.get((-1, -1), 0), [exact.get((-1, j), 0) for j in range(dims)], [
        [exact.get((min(i, j), max(i, j)), 0) for j in range(dims)] for i in range(dims)])


def components(found: Scatter, most: int = 8) -> Components:
    """Eigenvectors of the covariance, by falling eigenvalue; the largest entry of each is positive.

    Centring is done in whole numbers: an entry is (n * cross - sum * sum) / n ** 2, rounded once. Directions whose
    variance is nothing but rounding have NaN as eigenvalue.
    """
    n, dims = found.n, len(found.sums)
    if not n or not dims:
        return Components(np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    v = np.array([[(n * found.cross[i][j] - found.sums[i] * found.sums[j]) / (n * n) for j in range(dims)]
                  for i in range(dims)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)
    real = values > max(values[0], 0.0) * dims * np.finfo(float).eps
    trace = np.trace(v)
    share = np.maximum(values, 0.0) / trace if trace > 0 else np.full(len(values), np.nan)
    return Components(vectors, np.where(real, values, np.nan), share)


def whiten(vectors: DataFrame, most: int = 8, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A component c of an embedding becomes x = floor(1024 * c) + 100000 (beyond 2^61 it stops there). All vectors are
    fitted but those that are null or hold a null or a non-finite component, which take no part; missing trailing
    components count as 0, equal rows count each, and a null vec_id stays null. deviation is the sum of
    (n * x - sum)^2, exact; past a long it stops at its end. whitened is (x - mean) on the component over the root of
    its eigenvalue, null for a direction without variance; explained is null if nothing varies. identity_error is
    measured on the whitened rows: the largest entry of their covariance, less the identity, over components with
    variance (0 if none has). No vectors, or only empty ones: no rows.

    Three scans of the vectors: their longest, their scatter and their projection, which is stored (at most 8 numbers
    a row) for the covariance and the result.
    """
    rows = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    found = scatter(rows, dims, block_rows)
    axes = components(found, most)
    n, sums, top = found.n, found.sums, len(axes.values)
    scale = axes.vectors / np.sqrt(axes.values)
    high = max((abs(s) for s in sums), default=0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch.column(1), dims)
            small = n * int(np.abs(x).max(initial=0)) + high < 1 << WORD_BITS
            centred = n * (x if small else x.astype(object)) - np.array(sums, np.int64 if small else object)
            fits = small and dims * int(np.abs(centred).max(initial=0)) ** 2 < 1 << WORD_BITS
            wide = centred if fits else centred.astype(object)
            deviation = np.minimum((wide * wide).sum(axis=1), (1 << 63) - 1).astype(np.int64)
            out = (centred.astype(np.float64) / n) @ scale
            flat = pa.array(out.ravel(), mask=np.isnan(out).ravel())
            ends = pa.array(np.arange(0, out.size + 1, max(top, 1))[: len(out) + 1].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation), pa.ListArray.from_arrays(ends, flat)],
                names=["vec_id", "deviation", "whitened"])

    kind = "vec_id long, deviation long, whitened array<double>"
    if not top:
        projected = rows.limit(0).select("vec_id", F.lit(0).cast("long").alias("deviation"),
                                         F.array().cast("array<double>").alias("whitened"))
    else:
        projected = stored(rows.mapInArrow(project, kind), "whitened")
    real = [c for c in range(top) if np.isfinite(axes.values[c])]
    error = _identity_error(projected, real) if real else 0.0
    explained = F.array(*(F.lit(float(x)) if np.isfinite(x) else F.lit(None).cast("double") for x in axes.explained))
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", (F.get(explained, F.col("place")) if top else F.lit(None).cast("double")).alias("explained"),
        F.lit(error).alias("identity_error"))


def _identity_error(projected: DataFrame, real: list[int]) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity, centred before multiplying."""
    means = projected.agg(*(F.avg(F.col("whitened")[c]).alias(f"m{c}") for c in real)).first()
    off = {c: F.col("whitened")[c] - F.lit(means[f"m{c}"]) for c in real}
    pairs = [(a, b) for a in real for b in real if a <= b]
    cov = projected.agg(*(F.avg(off[a] * off[b]).alias(f"c{a}_{b}") for a, b in pairs)).first()
    return max(abs(cov[f"c{a}_{b}"] - (a == b)) for a, b in pairs)
