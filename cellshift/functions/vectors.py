"""Vector measures over array columns.

A 64-wide cosine as array lambdas ran five times slower than handing the
column's Arrow buffers to numpy, so these are Arrow UDFs: no per-row Python.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's functions with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPS = 1e-8  # fixed value: smallest denominator of a cosine


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The non-null rows of a list column as one float64 matrix of equal width."""
    widths = np.diff(vectors.offsets.to_numpy())
    if vectors.null_count:
        widths = widths[vectors.is_valid().to_numpy(zero_copy_only=False)]
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors of one column must share one width")
    width = int(widths[0]) if len(widths) else 0
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(widths), width)


@F.arrow_udf(T.DoubleType())
def cosine_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """1 - cosine, clipped; a zero vector is at distance 1 from everything."""
    both = pa.compute.and_(a.is_valid(), b.is_valid())
    x, y = _matrix(a.filter(both)), _matrix(b.filter(both))
    if x.shape != y.shape:
        raise ValueError(f"vector widths differ: {x.shape[1]} and {y.shape[1]}")
    out = np.full(len(a), np.nan)
    valid = both.to_numpy(zero_copy_only=False)
    out[valid] = _cosine_distances(x, y)
    return pa.array(out, mask=~valid)


def _cosine_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
    cosine = np.einsum("ij,ij->i", x, y) / np.maximum(norms, EPS)
    return 1.0 - np.clip(cosine, -1.0, 1.0)


@F.arrow_udf(T.DoubleType())
def l2_norm(a: pa.Array) -> pa.Array:
    x = _matrix(a.drop_null())
    out = np.full(len(a), np.nan)
    valid = a.is_valid().to_numpy(zero_copy_only=False)
    out[valid] = np.sqrt(np.einsum("ij,ij->i", x, x))
    return pa.array(out, mask=~valid)


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


AT_ONCE = 4096  # entries weighted in one step


def _add_weighted(out: np.ndarray, codes: pa.ListArray, amounts: pa.ListArray, modulus: int, steps: np.ndarray) -> None:
    """Adds to each row of ``out`` its entries' amounts times weights, a bounded number of entries at a time."""
    sizes = np.diff(codes.offsets.to_numpy())
    row = np.repeat(np.arange(len(out)), sizes)
    code = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    _add_entries(out, row, code, amounts.flatten().to_numpy(zero_copy_only=False), modulus, steps)


def _add_entries(out: np.ndarray, row: np.ndarray, code: np.ndarray, amount: np.ndarray, modulus: int, steps: np.ndarray) -> None:
    for first in range(0, len(row), AT_ONCE):
        part = slice(first, first + AT_ONCE)
        at = code[part, None] + steps  # below twice the modulus
        at -= modulus * (at >= modulus).astype(np.int32)
        weights = at / modulus
        weights -= 0.5
        weights *= amount[part, None]
        rows = row[part]
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[starts]] += np.add.reduceat(weights, starts)


def _steps(dim: int, modulus: int, step: int) -> np.ndarray:
    return (np.arange(dim, dtype=np.int64) * step % modulus).astype(np.int32)


def moved_by(dim: int, modulus: int, step: int):
    """A column function: a vector plus, for each of a row's entries, its amount times its weights.

    An entry has a code from 0 to below ``modulus``, which is below 2**30; its weight at
    position ``d`` is the fraction ``(code + d * step) % modulus / modulus`` less a half.
    """
    steps = _steps(dim, modulus, step)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def moved(before: pa.Array, codes: pa.Array, amounts: pa.Array) -> pa.Array:
        out = _matrix(before).copy()
        if not len(out):
            return pa.array([], pa.list_(pa.float64()))
        _add_weighted(out, codes, amounts, modulus, steps)
        return _lists(out)

    return moved


def moved_distance(dim: int, modulus: int, step: int):
    """A column function: the cosine distance of a vector and what ``moved_by`` makes of it."""
    steps = _steps(dim, modulus, step)

    @F.arrow_udf(T.DoubleType())
    def measured(before: pa.Array, codes: pa.Array, amounts: pa.Array) -> pa.Array:
        base = _matrix(before)
        out = base.copy()
        if len(out):
            _add_weighted(out, codes, amounts, modulus, steps)
        return pa.array(_cosine_distances(out, base))

    return measured


def _single(before: np.ndarray, codes: pa.ListArray, amounts: pa.ListArray, modulus: int, step: int) -> np.ndarray:
    """What ``moved_by`` makes of the rows, rounded to single precision as vectors are stored."""
    out = before.copy()
    if len(out):
        _add_weighted(out, codes, amounts, modulus, _steps(out.shape[1], modulus, step))
    return out.astype(np.float32)


def moved_single(modulus: int, step: int):
    """A column function: ``moved_by`` in single precision; null where a row lacks the vector or the entries."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def moved(before: pa.Array, codes: pa.Array, amounts: pa.Array) -> pa.Array:
        listed = pa.compute.and_(before.is_valid(), codes.is_valid())
        out = _single(_matrix(before.filter(listed)), codes.filter(listed), amounts.filter(listed), modulus, step)
        ends = np.cumsum(listed.to_numpy(zero_copy_only=False)) * out.shape[1]
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel()), mask=pa.compute.invert(listed))

    return moved


MADE = 256  # vectors made and measured in one step, few enough to stay in a core's cache


def kept_distances(modulus: int, step: int, foreign: bool):
    """A column function: the cosine distances of a cell's changed vectors to ``before`` or, if ``foreign``, another.

    ``changes`` has a list of entries for each vector; the vector is what ``moved_single``
    makes of ``before``, made here and measured without being sent out and back in.
    """

    def distances(before: pa.Array, changes: pa.Array, against: pa.Array) -> pa.Array:
        base = _matrix(before)
        y = base if against is before else _matrix(against)
        if y.shape != base.shape:
            raise ValueError(f"vector widths differ: {base.shape[1]} and {y.shape[1]}")
        lists = changes.flatten()
        if lists.null_count:
            raise ValueError("a stored vector is kept neither whole nor as entries")
        sizes = np.diff(changes.offsets.to_numpy())
        cell, starts = np.repeat(np.arange(len(base)), sizes), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        entries, steps = lists.flatten(), _steps(base.shape[1], modulus, step)
        code, amount = (entries.field(n).to_numpy(zero_copy_only=False) for n in ("code", "amount"))
        out = np.empty(len(cell))
        for first in range(0, len(cell), MADE):
            of, part = cell[first : first + MADE], slice(starts[first], starts[min(first + MADE, len(cell))])
            made = base[of]
            row = np.repeat(np.arange(len(of)), np.diff(starts[first : first + len(of) + 1]))
            _add_entries(made, row, code[part], amount[part], modulus, steps)
            out[first : first + MADE] = _cosine_distances(made.astype(np.float32).astype(np.float64), y[of])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(out))

    if foreign:

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def measured(before: pa.Array, changes: pa.Array, against: pa.Array) -> pa.Array:
            return distances(before, changes, against)

    else:

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def measured(before: pa.Array, changes: pa.Array) -> pa.Array:
            return distances(before, changes, before)

    return measured


def weighted_sum(dim: int, modulus: int, step: int):
    """A column function: the sum of a row's entries, weighted as in ``moved_by``; of no entries, zeros."""
    steps = _steps(dim, modulus, step)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def summed(codes: pa.Array, amounts: pa.Array) -> pa.Array:
        out = np.zeros((len(codes), dim))
        _add_weighted(out, codes, amounts, modulus, steps)
        return _lists(out)

    return summed
