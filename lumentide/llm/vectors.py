"""Integer vectors and exact sums of products, for the operators on embeddings."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Components are stored in units of 1 / SCALE.
SCALE = 256
#: Sums beyond a decimal's 38 digits are kept as two, of these low bits and of the rest.
LOW_BITS = 64


def is_valid(vector: str) -> Column:
    """The vector has components, and all of them are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (
        F.abs(c) < F.lit(float("inf"))))
    return (F.size(vector) > 0) & finite


def to_integers(vector: str) -> Column:
    """`floor(SCALE * component)` of every component, as long; beyond a long its nearest one."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))


def matrix(lists, dim: int, dtype=np.int64) -> np.ndarray:
    """An Arrow array of lists of `dim` numbers as rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dim)


def magnitude(x: np.ndarray) -> int:
    """The largest absolute value; of the least long, too."""
    return max(-int(x.min()), int(x.max()), 0) if x.size else 0


def exact_gram(x: np.ndarray) -> np.ndarray:
    """`x.T @ x` of an integer matrix as Python integers, by floating-point products.

    Numbers are cut into limbs so short that sums of products over all rows stay below
    2 ** 53, where floating-point numbers are exact. Ordinary embeddings need one limb.
    """
    width = (53 - int(len(x)).bit_length()) // 2
    limbs, rest = [], x
    while magnitude(rest) >> width:
        limbs.append((rest & ((1 << width) - 1)).astype(np.float64))
        rest = rest >> width
    limbs.append(rest.astype(np.float64))
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (width * (i + j))
    return total


def split_decimal(value: int) -> tuple[Decimal, Decimal]:
    """High and low part of an integer; sums of either are exact in Spark's decimals."""
    high, low = divmod(value, 1 << LOW_BITS)
    return Decimal(high), Decimal(low)


def join_decimal(high: Decimal, low: Decimal) -> int:
    return (int(high) << LOW_BITS) + int(low)


def most_common_size(vectors: DataFrame, size_col: str) -> int | None:
    """The length that most vectors have, the greater of two; None without vectors."""
    found = vectors.groupBy(size_col).count().orderBy(
        F.desc("count"), F.desc(size_col)).first()
    return found[size_col] if found else None
