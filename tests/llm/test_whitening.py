import numpy as np
import pytest

from bidlens.llm.queries import QUERIES
from bidlens.llm.whitening import shifted_factor, solved, whitened_rows

SCHEMA = "vec_id long, embedding array<float>, label int, n string, whitened string, at string"


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, 0, "own", "own", "own") for i, v in vectors], SCHEMA.replace("array<float>", f"array<{kind}>"))


def brute(vectors):
    """Rows by (vec_id, component) up to sign: n, deviation, whitened, explained."""
    x = np.floor(1024 * np.array([v for _, v in vectors], np.float64)).astype(np.int64) + 100000
    n, sums = len(x), [int(s) for s in x.astype(object).sum(axis=0)]
    centred = np.array([[float(n * int(e) - s) / n for e, s in zip(row, sums)] for row in x])
    _, sigma, v = np.linalg.svd(centred)
    e, v = np.zeros(len(v)), v.T
    e[:len(sigma)] = sigma ** 2 / n
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, centred @ v[:, :8] / np.sqrt(np.maximum(e[:8], 1e-300)), e[:8] / e.sum()


def check(rows, vectors, rank=8):
    n, deviation, white, explained = brute(vectors)
    width = min(8, len(vectors[0][1]))
    assert len(rows) == width * len(vectors)
    place = {i: k for k, (i, _) in enumerate(vectors)}
    signs = {}
    for r in sorted(rows, key=lambda r: -abs(r.whitened or 0)):
        k, c = place[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviation[k])
        assert r.explained == pytest.approx(explained[c], rel=1e-9, abs=1e-14)
        if c >= rank:
            assert r.whitened is None
            continue
        sign = signs.setdefault(c, np.sign(r.whitened * white[k, c]))
        assert r.whitened * sign == pytest.approx(white[k, c], rel=1e-6, abs=1e-8)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-10


def test_given_table_equals_a_decomposition_of_all_rows(spark):
    folder = "/root/testdata/sf0.001"
    vectors = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op11_embedding_whitening"](spark, folder).collect(), vectors)


def test_badly_scaled_dimensions(spark):
    draw = np.random.default_rng(1)
    mixing = np.linalg.qr(draw.normal(size=(12, 12)))[0] * (10.0 ** -np.linspace(0, 3, 12))[:, None]
    data = (draw.normal(size=(400, 12)) * 10.0 ** np.linspace(3, -1, 12)) @ mixing
    vectors = [(i, [float(e) for e in row]) for i, row in enumerate(data)]
    check(whitened_rows(frame(spark, vectors, "double").repartition(5)).collect(), vectors)


def test_unusable_vectors_are_dropped_and_repeats_stay(spark):
    draw = np.random.default_rng(2)
    good = [(i, [float(e) for e in row]) for i, row in enumerate(np.float32(draw.normal(size=(40, 9))))]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [None] * 9), (102, [nan] + [0.0] * 8), (103, [0.0] * 8 + [-inf]), (104, [1.0] * 8), (105, []),
           (106, [1e30] + [0.0] * 8)]
    check(whitened_rows(frame(spark, good + bad).repartition(3)).collect(), good)
    again = good + [(50 + i, good[0][1]) for i in range(20)]
    check(whitened_rows(frame(spark, again)).collect(), again)
    rows = whitened_rows(frame(spark, good + [(None, good[3][1])])).filter("vec_id is null").collect()
    assert len(rows) == 8 and rows[0].n == 41


def test_directions_without_variance(spark):
    draw = np.random.default_rng(3)
    flat = draw.normal(size=(60, 3)).round(3)
    vectors = [(i, [float(a), float(b), 5.0, float(c), float(a), float(b), -3.0, 0.0, 1.0, 2.0]) for i, (a, b, c) in enumerate(flat)]
    check(whitened_rows(frame(spark, vectors, "double")).collect(), vectors, rank=3)
    same = whitened_rows(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert len(same) == 10 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)
    one = whitened_rows(frame(spark, [(1, [0.5])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in one] == [(1, 1, 0, None)]


def test_no_rows(spark):
    assert whitened_rows(frame(spark, [])).collect() == []
    assert whitened_rows(frame(spark, [(1, None), (2, [])])).collect() == []


def test_deviations_beyond_double_precision_are_exact(spark):
    vectors = [(0, [0.0, 0.0]), (1, [float(1 << 20), 1.0]), (2, [float(1 << 19), -1.0])]
    check(whitened_rows(frame(spark, vectors)).collect(), vectors)


def test_triangular_solve_and_shift():
    draw = np.random.default_rng(4)
    upper = np.triu(draw.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = draw.normal(size=(20, 6))
    assert np.allclose(solved(rows, upper) @ upper, rows)
    singular = np.ones((3, 3))
    factor = shifted_factor(singular, 10, always=True)
    assert np.allclose(factor.T @ factor, singular, atol=1e-6)
