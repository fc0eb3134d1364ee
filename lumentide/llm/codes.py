"""Vector codes: each part of a vector as the nearest entry of a learned codebook.

Every round assigns all parts to entries, then moves the entries to their parts' means. A
pass after the first does not compare a part with all entries again. For each group of
entries a row remembers a lower bound of the distance to them and the round in which
it was measured (its stamp). The codebooks of all rounds are kept, so that the bound can be
corrected by how far the group's entries truly are from where they stood in that round, the
norm of the sum of their moves, which is never more than the sum of the norms. Only groups
whose corrected bound doesn't exceed the distance to the present entry are searched.

Comparisons are between exact integers; bounds are floating-point numbers made safe by a
margin, and an entry as near as the present one is always searched, so ties are exact too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lumentide.llm.common import with_arrow_columns, written
from lumentide.llm.vectors import is_valid, magnitude, matrix, to_integers
from lumentide.session import remove_dir, shared_dir

#: Bounds are rounded to 32 bits (a relative error below 6e-8): measured distances are
#: lowered by this share before they are stored, moves raised by it before they are used.
MARGIN = 1e-6
#: A codebook of every part: [part][entry, component].
Books = list[np.ndarray]


@dataclass(frozen=True)
class Codebooks:
    """The books of all rounds, the final ones last; `dim` components of a vector, padded."""

    dim: int
    history: tuple[Books, ...]

    def digest(self) -> str:
        """SHA-256 of the final entries' components by part, entry and place, comma-joined."""
        final = self.history[-1] if self.history else []
        return hashlib.sha256(",".join(
            str(int(v)) for book in final for entry in book for v in entry).encode()).hexdigest()


def _exact(width: int, *arrays: np.ndarray) -> np.dtype:
    """A type in which squared distances of rows of these numbers are exact."""
    reach = width * 4 * max(map(magnitude, arrays)) ** 2
    return np.dtype(np.float64 if reach >> 52 == 0 else np.int64 if reach >> 62 == 0 else object)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    kind = _exact(x.shape[1], x, entries)
    a, b = x.astype(kind), entries.astype(kind)
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)


def _to(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the entry beside it."""
    kind = _exact(x.shape[1], x, entries)
    return ((x.astype(kind) - entries.astype(kind)) ** 2).sum(axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _moves(history: tuple[Books, ...], part: int, members: list[np.ndarray]) -> np.ndarray:
    """How far, at most, entries of each group are from where they stood in each round."""
    now = history[-1][part]
    return np.array([
        [_root(_to(now[own], then[part][own])).max() for own in members]
        for then in history]) * (1 + MARGIN)


def _members(entries: int, groups: int) -> list[np.ndarray]:
    return [g for g in np.array_split(np.arange(entries), groups) if len(g)]


def assign_part(
    x: np.ndarray, history: tuple[Books, ...], part: int, members: list[np.ndarray],
    code: np.ndarray | None, bounds: np.ndarray | None, stamps: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entries of a part of some vectors, the lower of two as near.

    Returns entries, exact squared distances, bounds and stamps by row and group, and the
    number of rows searched, summed over groups. Without a `code` everything is searched.
    """
    entries, now = history[-1][part], len(history) - 1
    n = len(x)
    if code is None:
        best = np.zeros(n, np.int64)
        squares = _to(x, entries[best])
        searched = [np.arange(n)] * len(members)
        bounds, stamps = np.empty((n, len(members)), np.float32), np.empty((n, len(members)), np.uint8)
    else:
        best = code.astype(np.int64)
        squares = _to(x, entries[best])
        corrected = bounds - _moves(history, part, members)[stamps, np.arange(len(members))]
        near = corrected <= _root(squares)[:, None] * (1 + MARGIN)
        searched = [np.flatnonzero(near[:, g]) for g in range(len(members))]
        bounds, stamps = bounds.copy(), stamps.copy()
    before = best.copy()
    found = []
    for own, rows in zip(members, searched):
        distances = squared_distances(x[rows], entries[own])
        found.append(distances)
        at = distances.argmin(axis=1) if len(rows) else np.zeros(0, np.int64)
        least, entry = distances[np.arange(len(rows)), at], own[at]
        better = (least < squares[rows]) | (least == squares[rows]) & (entry < best[rows])
        best[rows[better]], squares[rows[better]] = entry[better], least[better]
    group_of = np.concatenate([np.full(len(own), g) for g, own in enumerate(members)])
    for g, (own, rows) in enumerate(zip(members, searched)):
        # A group's bound leaves out the entry a part is assigned to. One that is no longer
        # assigned comes back into its group's, which is measured again, if it wasn't yet.
        done = np.zeros(n, bool)
        done[rows] = True
        back = np.flatnonzero((best != before) & (group_of[before] == g) & ~done)
        for rows, distances in ((rows, found[g]), (back, squared_distances(x[back], entries[own]))):
            if len(rows):
                others = _root(distances) * (1 - MARGIN)
                others[best[rows][:, None] == own] = np.inf
                bounds[rows, g], stamps[rows, g] = others.min(axis=1), now
    return best, squares, bounds, stamps, sum(map(len, searched))


class _Pass:
    """Assignment of batches: what a task needs to know."""

    def __init__(self, books: Codebooks, groups: int):
        self.books = books
        self.parts = len(books.history[-1])
        self.width = books.dim // self.parts
        self.members = _members(len(books.history[-1][0]), groups)

    def assign(
        self, lists: pa.Array, state: tuple[pa.Array, ...] = (),
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Codes, bounds, stamps and exact errors of a batch's rows."""
        n, g = len(lists), len(self.members)
        x = matrix(lists, self.books.dim)
        before: list[np.ndarray] = [
            np.frombuffer(b"".join(a.to_pylist()), kind).reshape(n, self.parts, *shape)
            for a, kind, shape in zip(state, ("<u2", "<f4", "u1"), ((), (g,), (g,)))]
        code = np.empty((n, self.parts), "<u2")
        bounds, stamps = np.empty((n, self.parts, g), "<f4"), np.empty((n, self.parts, g), "u1")
        error = np.zeros(n, object)
        for p in range(self.parts):
            own = x[:, p * self.width:(p + 1) * self.width]
            remembered = [a[:, p] for a in before] or [None] * 3
            code[:, p], squares, bounds[:, p], stamps[:, p], _ = assign_part(
                own, self.books.history, p, self.members, *remembered)
            error += squares if squares.dtype == object else squares.astype(np.int64).astype(object)
        return code, bounds, stamps, error.tolist()


_STATE = ("_code", "_bounds", "_stamps")


def _as_binary(a: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(a)], pa.binary())


def _assigned(df: DataFrame, books: Codebooks, groups: int) -> DataFrame:
    """A pass over the rows, with their new state."""
    shared = df.sparkSession.sparkContext.broadcast(_Pass(books, groups))

    def run(lists: pa.Array, *state: pa.Array) -> list[pa.Array]:
        return list(map(_as_binary, shared.value.assign(lists, state)[:3]))

    return with_arrow_columns(
        df, run, ["_x", *(c for c in _STATE if c in df.columns)],
        [T.StructField(c, T.BinaryType()) for c in _STATE])


def _finished(df: DataFrame, books: Codebooks, groups: int) -> DataFrame:
    """The last pass: codes and errors instead of the state."""
    shared = df.sparkSession.sparkContext.broadcast(_Pass(books, groups))

    def run(lists: pa.Array, *state: pa.Array) -> list[pa.Array]:
        code, _, _, error = shared.value.assign(lists, state)
        return [pa.array(code.tolist(), pa.list_(pa.int32())),
                pa.array([e if e < 1 << 63 else None for e in error], pa.int64())]

    held = [c for c in _STATE if c in df.columns]
    return with_arrow_columns(
        df, run, ["_x", *held],
        [T.StructField("code", T.ArrayType(T.IntegerType())),
         T.StructField("error", T.LongType())], drop=["_x", *held])


def _means(df: DataFrame, books: Codebooks) -> Books:
    """The entries at the floors of their parts' means; an entry without parts stays.

    Each task sends a sum for each component of each entry it has seen, whatever its rows.
    """
    last = books.history[-1]
    parts, entries = len(last), len(last[0])
    width = books.dim // parts
    arrow = pa.schema([("at", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(parts * entries * (width + 1), object)  # sums, then the count
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0), books.dim)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, parts)
            exact = (magnitude(x) * len(x)) >> 53 == 0
            for p in range(parts):
                cell = (p * entries + codes[:, p].astype(np.int64)) * (width + 1)
                for i in range(width + 1):
                    values = x[:, p * width + i] if i < width else np.ones(len(x), np.int64)
                    if exact:
                        total += np.bincount(
                            cell + i, values, len(total)).astype(np.int64).astype(object)
                    else:
                        np.add.at(total, cell + i, values.astype(object))
        seen = np.flatnonzero(total != 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()),
             pa.array([Decimal(int(v)) for v in total[seen]], pa.decimal128(38, 0))], schema=arrow)

    sums = df.select("_x", "_code").mapInArrow(run, "at long, total decimal(38,0)").groupBy(
        "at").agg(F.sum("total").alias("total"))
    total = {r["at"]: int(r["total"]) for r in sums.collect()}
    moved = []
    for p in range(parts):
        book = last[p].copy()
        for e in range(entries):
            cell = (p * entries + e) * (width + 1)
            if count := total.get(cell + width, 0):
                book[e] = [total.get(cell + i, 0) // count for i in range(width)]
        moved.append(book)
    return moved


def _first_vectors(df: DataFrame, id_col: str, n: int) -> list[list[int]]:
    """The first vectors by id, as long as the very first.

    NULL ids come last, rows of an id in the order of their vectors.
    """
    def smallest(rows: DataFrame) -> list[list[int]]:
        ordered = rows.select(id_col, "_x").orderBy(F.col(id_col).asc_nulls_last(), "_x")
        return [r["_x"] for r in ordered.limit(n).collect()]

    first = smallest(df)
    if len({len(x) for x in first}) > 1:
        first = smallest(df.filter(F.size("_x") == len(first[0])))
    return first


def compress_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", parts: int = 16,
    entries: int = 64, rounds: int = 2, groups: int = 4,
) -> tuple[DataFrame, Codebooks]:
    """Codes and errors of all vectors, and the codebooks of all rounds.

    Adds `code` (array of entries by part) and `error` (the squared distances, summed over
    parts; NULL beyond a long) to rows whose vector counts, and drops the others: vectors that
    are NULL, have no components, a NULL or a component not finite, or another length
    than the first one by id. A vector whose length isn't a multiple of `parts` is filled up
    with zeros at its end. Fewer vectors than `entries` make smaller books. Rows with NULL
    ids or labels and repeated rows count and stay. An empty table gives no rows and no
    books. Columns named like the two are replaced, all others are kept.

    Each pass reads what the one before wrote to shared storage (a row's integers, code,
    `parts` x `groups` bounds of 4 bytes and stamps of 1), which is removed when the next is
    complete. No row is ever shuffled: passes are narrow, and of the means each task sends
    one number per component of the books. Books and sums are all that reaches the driver.
    """
    if not 0 < entries <= 1 << 16 or not 0 <= rounds < 1 << 8:
        raise ValueError("at most 65,536 entries and 255 rounds")
    spark = df.sparkSession
    names = {c: f"_column_{i}" for i, c in enumerate(df.columns)}
    own = df.toDF(*names.values())
    x = own.filter(is_valid(names[vec_col])).withColumn(
        "_x", to_integers(names[vec_col])).drop(names[vec_col])
    books, path, done = Codebooks(0, ()), None, shared_dir(spark, "codes")
    if first := _first_vectors(x, names[id_col], entries):
        dim = len(first[0])
        width = -(-dim // parts)
        start = np.zeros((len(first), width * parts), np.int64)
        start[:, :dim] = first
        books = Codebooks(width * parts, (np.split(start, parts, axis=1),))
        x = x.filter(F.size("_x") == dim)
        if dim < books.dim:
            x = x.withColumn("_x", F.concat(
                "_x", F.array_repeat(F.lit(0).cast("bigint"), books.dim - dim)))
        for _ in range(rounds):
            before, path = path, shared_dir(spark, "code-state")
            x = written(_assigned(x, books, groups), path=path)
            if before:
                remove_dir(spark, before)
            books = Codebooks(books.dim, (*books.history, _means(x, books)))
        coded = written(_finished(x, books, groups), path=done)
        if path:
            remove_dir(spark, path)
    else:
        coded = x.drop("_x").withColumns({
            "code": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("bigint")})
    kept = [c for c in df.columns if c not in (vec_col, "code", "error")]
    return coded.select(*[F.col(names[c]).alias(c) for c in kept], "code", "error"), books


def with_total_error(coded: DataFrame, by: str) -> DataFrame:
    """Add `total_error`: the errors of all rows of equal `by`, NULL being a value like others.

    The totals are stored before they meet the rows, so that Spark knows their size: it
    broadcasts few of them and else splits the rows of a frequent value over tasks. NULL if
    an error is, or beyond a long.
    """
    totals = written(coded.groupBy(F.col(by).alias("_by")).agg(
        F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("total_error")), "totals")
    return coded.drop("total_error").join(totals, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
