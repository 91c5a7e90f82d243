from collections import Counter

import pytest
from pyspark.sql import functions as F

from bidlens.functions.scalar import spread
from bidlens.operators import factorize, sampling


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with null keys, null labels and keys beyond 2^31."""
    rows = [(i, "ab"[i % 2] if i % 5 else None) for i in range(60)] + [((1 << 31) * i + 7, "a") for i in range(1, 40)]
    return spark.createDataFrame(rows + [(None, "a"), (None, None), (None, "b")], "key long, label string")


@pytest.mark.parametrize("limit", [5, 1_000_000])
@pytest.mark.parametrize("how", ["hash", "contiguous", "stratified"])
def test_folds_keep_all_rows(odd, how, limit):
    rows = sampling.assign_folds(odd, "key", 4, how, "label", limit=limit).collect()
    assert len(rows) == odd.count() and Counter((r.key, r.label) for r in rows) == Counter(map(tuple, odd.collect()))
    assert all((r.fold is None) == (r.key is None) for r in rows)
    if how == "contiguous":
        assert max(Counter(r.fold for r in rows if r.key is not None).values()) == 25
    if how == "stratified":
        of_null = Counter(r.fold for r in rows if r.label is None and r.key is not None)
        assert sum(of_null.values()) == 12 and set(of_null.values()) == {3}


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_every_key_has_a_place_of_its_own(spark, odd, limit):
    rows = sampling.shuffled_places(odd, "key", 3, limit=limit).collect()
    assert len(rows) == odd.count()
    assert sorted(r.place for r in rows if r.key is not None) == list(range(99))
    assert all(r.place is None for r in rows if r.key is None)
    wide = spark.range(1 << 18).select(F.xxhash64("id").alias("key"))
    hashes = wide.select(spread("key").alias("h"))
    assert hashes.distinct().count() < hashes.count()  # some share a hash
    assert sampling.shuffled_places(wide, "key").select("place").distinct().count() == 1 << 18


def test_more_factors_than_columns(spark, monkeypatch):
    rows = spark.createDataFrame([(r, f, float(r * f % 5)) for r in range(6) for f in range(4)] + [(9, 77, 2.0)], "row int, feature int, x double")
    factors = spark.createDataFrame([(f, k, (f * 7 + k * 3) % 11 / 10) for f in range(4) for k in range(12)], "feature int, k int, v double")
    linear = spark.createDataFrame([(f, f / 3) for f in range(3)], "feature int, w double")
    sides = [factorize.fm_score(rows, factors, w, 0.5) for w in (None, linear)]
    wide = [{r.row: r.score for r in s.collect()} for s in sides]
    own = {(r.row, f"bi_{k}"): r[f"bi_{k}"] for r in factorize.bi_interaction(rows, factors).collect() for k in range(12)}
    monkeypatch.setattr(factorize, "MAX_FACTORS", 5)
    for w, want in zip((None, linear), wide):
        assert {r.row: pytest.approx(r.score) for r in factorize.fm_score(rows, factors, w, 0.5).collect()} == want
    long = {(r.row, f"bi_{r.k}"): r.bi for r in factorize.interactions(rows, factors).collect()}
    assert len(long) == 72 and all(own[k] == pytest.approx(v) for k, v in long.items())
    with pytest.raises(ValueError, match="interactions"):
        factorize.bi_interaction(rows, factors)
