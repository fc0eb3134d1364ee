"""Vector codes against a plain computation, whitening against exact fractions."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentide.llm import codes, queries, spectrum
from lumentide.llm.vectors import exact_gram
from lumentide.llm.whitening import Whitening, fit_whitening, whiten


def kept(rows):
    return [(i, [math.floor(256 * float(c)) for c in v], label) for i, v, label in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def brute_codes(rows, parts=16, entries=64, rounds=2):
    rows = kept(rows)
    width = len(rows[0][1]) // parts
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    def all_nearest():
        return [[nearest(r[1][p * width:(p + 1) * width], books[p]) for p in range(parts)]
                for r in rows]

    for _ in range(rounds):
        found = all_nearest()
        for p in range(parts):
            for j in range(len(first)):
                own = [r[1][p * width:(p + 1) * width] for r, f in zip(rows, found) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    found = all_nearest()
    totals = {}
    for r, f in zip(rows, found):
        totals[r[2]] = totals.get(r[2], 0) + sum(d for d, _ in f)
    flat = ",".join(str(c) for book in books for e in book for c in e)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), totals[r[2]], digest)
                  for r, f in zip(rows, found)), key=str)


def test_codes_query_equals_plain_computation(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()
    got = queries.QUERIES["op12_vector_codes"](spark, sf_dir).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute_codes(rows)


@pytest.mark.parametrize("spread, groups", [(3, 4), (200, 1), (200, 64), (10 ** 6, 5)])
def test_bounds_give_the_nearest_entry_in_every_round(spread, groups):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread, (3000, 3))
    history = (x[:20].copy(),)
    members = codes._members(20, groups)
    state, searched = (None, None, None), []
    for _ in range(8):
        books = tuple([h] for h in history)
        code, squares, bounds, stamps, n = codes.assign_part(x, books, 0, members, *state)
        distances = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert (code == distances.argmin(axis=1)).all() and (squares == distances.min(axis=1)).all()
        state, searched = (code, bounds, stamps), [*searched, n]
        history = (*history, np.array([
            x[code == j].sum(axis=0) // max((code == j).sum(), 1) if (code == j).any()
            else history[-1][j] for j in range(20)]))
    if spread > 3 and groups > 1:
        assert searched[-1] < 0.7 * searched[0]


def test_true_moves_are_tighter_than_summed_ones():
    there_and_back = [np.array([[0, 0]]), np.array([[9, 0]]), np.array([[1, 0]])]
    moves = codes._moves(tuple([b] for b in there_and_back), 0, [np.array([0])])
    assert moves[:, 0] == pytest.approx([1, 8, 0], rel=1e-5)


def test_distances_of_huge_components_are_exact():
    x = np.array([[1 << 62, -(1 << 62)], [3, 4]])
    got = codes.squared_distances(x, np.array([[-(1 << 62), 1 << 62], [0, 0]]))
    assert got.tolist() == [[(1 << 126) * 2, (1 << 124) * 2],
                            [((1 << 62) + 3) ** 2 + ((1 << 62) - 4) ** 2, 25]]


ODD = [(1, [0.5, -0.25, 1.0], 0), (1, [0.5, -0.25, 1.0], 0), (2, None, 1), (3, [0.1, None, 0.2], 1),
       (4, [float("nan"), 0.0, 0.0], None), (5, [float("inf"), 0.0, 0.0], None), (6, [], 2),
       (7, [0.5, 0.5], 2), (None, [-0.5, -0.001, 0.25], None), (8, [0.0, 0.75, -1.0], None)]
SCHEMA = "vec_id long, embedding array<float>, label int"


def test_codes_of_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns(
        {"_x": F.lit("a"), "_code": F.lit(1), "error": F.lit("gone"), "total_error": F.lit(0)})
    coded, books = codes.compress_vectors(odd, parts=2, entries=3)
    assert set(coded.columns) == {"vec_id", "label", "_x", "_code", "total_error", "code", "error"}
    # The rows that count, filled up with zeros to two parts of two.
    rows = [(i, [*v, 0.0], label) for i, v, label in ODD if v is not None and len(v) == 3]
    expected = brute_codes(rows, parts=2, entries=3)
    got = codes.with_total_error(coded, "label").collect()
    assert sorted(((r["vec_id"], "".join(f"{j:02x}" for j in r["code"]), r["error"], r["total_error"],
                    books.digest()) for r in got), key=str) == expected
    coded, books = codes.compress_vectors(odd.filter("vec_id = 2"))
    assert coded.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()


def test_exact_gram_of_large_and_small_numbers():
    rng = np.random.default_rng(1)
    for top in (5, 1 << 30, (1 << 63) - 1):
        x = rng.integers(-top - 1 if top > 5 else -5, top, (200, 3), dtype=np.int64)
        assert (exact_gram(x) == x.astype(object).T @ x.astype(object)).all()


def scatter(x):
    n, x = len(x), np.array(x, object)
    s = x.sum(axis=0)
    return (n * (x.T @ x) - np.multiply.outer(s, s)).tolist()


def test_polynomial_equals_exact_elimination():
    rng = np.random.default_rng(2)
    for d in (1, 2, 5, 9):
        x = rng.integers(-50, 50, (30, d))
        x[:, d // 2] = x[:, 0]
        a = scatter(x)
        primes = spectrum.enough_primes(spectrum.coefficient_bound(a))
        poly = spectrum.from_residues(primes, spectrum.polynomial_modulo(a, primes).tolist())
        for at in (-3, 0, 7, 10 ** 6):  # det(at - a) by elimination in fractions
            m = [[Fraction((at if i == j else 0) - a[i][j]) for j in range(d)] for i in range(d)]
            value = Fraction(1)
            for k in range(d):
                row = next((r for r in range(k, d) if m[r][k]), None)
                if row is None:
                    value = Fraction(0)
                    break
                if row != k:
                    m[k], m[row], value = m[row], m[k], -value
                value *= m[k][k]
                for r in range(k + 1, d):
                    f = m[r][k] / m[k][k]
                    m[r] = [p - f * q for p, q in zip(m[r], m[k])]
            assert value == sum(c * at ** i for i, c in enumerate(poly))


def test_roots_are_counted_and_isolated_exactly():
    roots = [0, 0, 3, 3, 3, 10, 11, 11, 4096]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    for at in range(14):
        assert spectrum.roots_above(poly, at, 0) == sum(r > at for r in roots)
        assert spectrum.roots_above(poly, 2 * at + 1, 1) == sum(2 * r > 2 * at + 1 for r in roots)
    found = spectrum.largest_roots(poly, 9)
    assert [(round(r), m) for r, m in found] == [(4096, 1), (11, 2), (10, 1), (3, 3)]
    assert all(abs(r - round(r)) < Fraction(1, 1 << 100) for r, _ in found)
    assert [m for _, m in spectrum.largest_roots(poly, 2)] == [1, 2]


def test_vectors_of_close_and_equal_roots():
    a = [[10 ** 12, 1, 0, 0], [1, 10 ** 12, 0, 0], [0, 0, 7, 0], [0, 0, 0, 7]]
    primes = spectrum.enough_primes(spectrum.coefficient_bound(a))
    poly = spectrum.from_residues(primes, spectrum.polynomial_modulo(a, primes).tolist())
    found = spectrum.largest_roots(poly, 4)
    assert [(round(r), m) for r, m in found] == [(10 ** 12 + 1, 1), (10 ** 12 - 1, 1), (7, 2)]
    vectors = np.array([v for r, m in found for v in spectrum.eigenvectors(a, r, m)])
    assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-15
    assert np.abs(vectors[:2, :2]) == pytest.approx(math.sqrt(0.5), abs=1e-15)


def brute_whitening(rows, components=4):
    rows = kept(rows)
    sample = np.array(sorted({tuple(x) for _, x, _ in rows}), object)
    n, s = len(sample), sample.sum(axis=0)
    centred = (n * sample - s).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x, _ in rows:
        y = n * np.array(x, object) - s
        w = (y.astype(float) / n) @ vectors[:, :components] / np.sqrt(values[:components])
        out[i] = (int((y * y).sum()), w)
    return n, out, values[:components] / values.sum()


def test_whitening_query_equals_plain_computation(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()
    n, expected, explained = brute_whitening(rows)
    got = queries.QUERIES["op13_whitening"](spark, sf_dir).collect()
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        deviation, w = expected[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-9
        c = r["component"] - 1
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        sign = signs.setdefault(c, np.sign(r["whitened"] * w[c]))
        assert r["whitened"] == pytest.approx(sign * w[c], rel=1e-6, abs=1e-8)


def test_whitening_of_odd_rows(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({"_x": F.lit(1), "whitened": F.lit("gone")})
    model = fit_whitening(odd)
    assert (model.dim, model.n) == (3, 3) and model.varying == 2  # three points span a plane
    got = whiten(odd, model)
    assert got.columns == ["vec_id", "embedding", "label", "_x", "whitened", "deviation"]
    rows = got.collect()
    assert sorted(str(r["vec_id"]) for r in rows) == ["1", "1", "8", "None"]
    assert all(len(r["whitened"]) == 3 and r["whitened"][2] is None for r in rows)
    first, second = (r for r in rows if r["vec_id"] == 1)
    assert first == second
    assert model.identity_error < 1e-12 and sum(model.explained) == pytest.approx(1)


def test_whitening_of_one_vector_and_of_none(spark):
    one = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    model = fit_whitening(one)
    assert model.n == 1 and model.identity_error is None and model.explained == (None, None)
    assert {(tuple(r["whitened"]), r["deviation"]) for r in whiten(one, model).collect()} == {
        ((None, None), 0)}
    none = one.filter("vec_id > 2")
    assert fit_whitening(none) is None and whiten(none, None).count() == 0


def test_deviations_beyond_a_long_are_exact_or_null():
    model = Whitening(2, 10 ** 6, (10 ** 7, -5), ((1.0, 0.0),), (1.0,), (1.0,))
    x = np.array([[1000, -2000], [1 << 40, 3], [-(1 << 63), 0]])
    y = model.deviations(x)
    exact = [sum((10 ** 6 * int(a) - s) ** 2 for a, s in zip(row, model.sums)) for row in x]
    assert model.squared(y) == [e if e < 1 << 63 else None for e in exact]
    assert model.squared(model.deviations(x[:1])) == [exact[0]]
    big = model.deviations(np.array([[2200, 1]]))
    assert model.squared(big) == [(10 ** 6 * 2200 - 10 ** 7) ** 2 + (10 ** 6 + 5) ** 2]
