import itertools
import math
import random

import numpy as np
import pytest

from bidlens.operators.select import best_lines, free_line_scores, mic_scores


def information(groups, bins, n):
    """Mutual information of two labellings."""
    joint = {}
    for g, b in zip(groups, bins):
        joint[g, b] = joint.get((g, b), 0) + 1
    of = lambda k: {v: sum(c for key, c in joint.items() if key[k] == v) for v in {key[k] for key in joint}}
    left, right = of(0), of(1)
    return sum(c / n * math.log(c * n / (left[g] * right[b])) for (g, b), c in joint.items())


def equal_bins(values, count):
    return [sum(w < v for w in values) * count // len(values) for v in values]


def brute(x, y, power=0.6):
    """All placements of lines between values, against equal-frequency bins of the other axis, both ways round."""
    n = len(x)
    cells, best = max(n ** power, 4.0), 0.0
    for free, other in ((x, y), (y, x)):
        for b in (1 << i for i in range(1, 10) if 2 << i <= cells):
            bins = equal_bins(other, b)
            kinds = len(set(bins))
            values = sorted(set(free))
            for lines in range(2, int(cells // b) + 1):
                for cuts in itertools.combinations(values[1:], lines - 1):
                    groups = [sum(c <= v for c in cuts) for v in free]
                    if kinds > 1:
                        best = max(best, information(groups, bins, n) / math.log(min(lines, kinds)))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_scores_equal_all_placements(spark, seed):
    draw = random.Random(seed)
    x = [draw.choice([draw.randrange(8), draw.random() * 8]) for _ in range(30)]
    y = [abs(v - 4) + draw.random() * seed for v in x]
    z = [float(draw.randrange(3)) for _ in x]
    rows = spark.createDataFrame(list(zip(map(float, x), z, map(float, y))), "x double, z double, y double")
    free = {r.feature: r.score for r in free_line_scores(rows, ["x", "z"], "y").collect()}
    grid = {r.feature: r.score for r in mic_scores(rows, ["x", "z"], "y").collect()}
    for name, values in (("x", x), ("z", z)):
        assert free[name] == pytest.approx(max(min(brute(values, y), 1.0), grid[name]))
        assert free[name] >= grid[name]


def test_lines_are_placed_best():
    draw = np.random.default_rng(1)
    for _ in range(20):
        table = draw.integers(0, 5, (7, 3)) + (draw.random((7, 3)) < 0.2) * 20
        want = 0.0
        for lines in (2, 3, 4):
            for cuts in itertools.combinations(range(1, 7), lines - 1):
                joined = np.add.reduceat(table, [0, *cuts], axis=0)
                n = joined.sum()
                share = joined / n
                both = share * np.log(np.where(share > 0, share, 1) / (share.sum(1, keepdims=True) * share.sum(0, keepdims=True) + 1e-300))
                want = max(want, both.sum() / np.log(min(lines, 3)))
        assert best_lines(table, 4) == pytest.approx(want)
    assert best_lines(np.array([[3], [4]]), 2) == best_lines(np.array([[3, 4]]), 2) == 0.0


def test_uneven_steps_and_empty_tables(spark):
    rows = spark.range(3000).selectExpr("cast(id as double) x", "cast(case when id < 70 then 0 when id < 2900 then 1 else 0 end as double) y",
                                        "cast(pmod(xxhash64(id), 1000) as double) noise")
    free = {r.feature: r.score for r in free_line_scores(rows, ["x", "noise"], "y").collect()}
    grid = {r.feature: r.score for r in mic_scores(rows, ["x", "noise"], "y").collect()}
    assert all(free[f] >= grid[f] for f in grid) and free["noise"] < 0.25 < free["x"]
    assert free_line_scores(rows.limit(0), ["x"], "y").collect() == []
