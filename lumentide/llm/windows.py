"""Hashes of word windows as arrays, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def _pairs(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def without_head(array: Column, start: int) -> Column:
    """The array without its first `start` elements."""
    return F.slice(array, F.lit(start + 1), F.greatest(F.size(array) - start, F.lit(0)))


def _without_tail(hashes: Column, words: Column, n: int) -> Column:
    """The hashes of full windows only (`zip_with` pads the shorter side with NULL)."""
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def with_windows(
    df: DataFrame, words: str, n: int, name: str, form: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add the 64-bit hashes of all windows of `n` words.

    Hashes of 1, 2, 4 … words are combined pairwise, each in one pass over the array, so
    a window costs a few hashes rather than a copy of its words. `form` is applied to each
    word first.
    """
    df = df.withColumn("_w1", F.transform(words, lambda w: F.xxhash64(form(w) if form else w)))
    made, size, rest = None, 1, n
    while rest:
        if rest & 1:
            at = F.col(f"_w{size}")
            if made is None:
                df = df.withColumn("_made", at)
            else:
                df = df.withColumn("_made", _pairs(F.col("_made"), without_head(at, made)))
            made = (made or 0) + size
        rest >>= 1
        if rest:
            at = F.col(f"_w{size}")
            df = df.withColumn(f"_w{2 * size}", _pairs(at, without_head(at, size)))
            size *= 2
    return df.withColumn(name, _without_tail(F.col("_made"), F.col(words), n)).drop(
        "_made", *[f"_w{1 << k}" for k in range(n.bit_length())])
