"""Vectors of whole numbers: reading them from a column, and exact arithmetic with them by numpy.

A component ``x`` becomes ``floor(scale * x)`` in double precision.  Whole numbers are held in 64 bits and saturate at
``MOST`` either way; where a result could leave 64 bits, the same arithmetic runs on Python's whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Largest magnitude of a component.
MOST = 1 << 62
#: Largest value of a 64-bit result.
TOP = (1 << 63) - 1


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of components of every row (-1: unusable), all components end to end, and where each row begins.

    A row is unusable if it is null or holds a null or a component that is not finite.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    fine = (bad[ends] == bad[ends - lengths]) & ~column.is_null().to_numpy(zero_copy_only=False)
    return np.where(fine, lengths, -1), flat, ends - lengths


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as 64-bit numbers, saturated at ``MOST``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    return np.where(scaled >= MOST, MOST, np.where(scaled <= -MOST, -MOST, np.clip(scaled, -MOST, MOST).astype(np.int64)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` whole numbers each, without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def most(*tables: np.ndarray) -> int:
    """Largest magnitude in any of the tables."""
    return max((max(abs(int(t.min())), abs(int(t.max()))) for t in tables if t.size), default=0)


def exact(bits: int, *tables: np.ndarray) -> list[np.ndarray]:
    """The tables as a type in which numbers below ``2**bits`` are exact: doubles, 64 bits or Python's numbers."""
    kind = np.float64 if bits <= 53 else np.int64 if bits <= 62 else object
    return [t.astype(kind) for t in tables]
