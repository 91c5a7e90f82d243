"""The split ways must give what the whole-group ways give."""

import pytest
from pyspark.sql import functions as F

from bidlens import session
from bidlens.operators import answer, encode, ranking, sampling
from bidlens.session import pin_small

ROWS = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one key, half of its values equal."""
    hashed = F.pmod(F.col("id") * 2654435761, F.lit(4294967296))
    return spark.range(ROWS).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("key"),
        F.when(F.col("id") % 6 == 0, F.lit(7.0)).otherwise((hashed % 1000) / 8.0).alias("x"))


def same(a, b, *, digits=9):
    def rows(df):
        return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in
                      df.select(*sorted(df.columns)).collect())
    return rows(a) == rows(b)


@pytest.mark.parametrize("keys", [["key"], []])
def test_quantiles(skewed, keys):
    probs = [0.0, 0.05, 0.5, 0.731, 0.95, 1.0]
    split = ranking.exact_quantiles(skewed, ["x", "id"], probs, keys, limit=20)
    whole = ranking.exact_quantiles(skewed, ["x", "id"], probs, keys)
    assert same(split, whole)


@pytest.mark.parametrize("keys", [["key"], []])
def test_positions(skewed, keys):
    assert same(ranking.value_positions(skewed, keys, "x", limit=20), ranking.value_positions(skewed, keys, "x"))


def test_ranks(skewed):
    assert same(ranking.average_rank(skewed, "key", "x", "r", limit=20), ranking.average_rank(skewed, "key", "x", "r"))


def test_exact_sampling(skewed):
    labelled = skewed.withColumn("label", (F.col("id") % 2).cast("int"))
    split = sampling.downsample_zero(labelled, "label", "id", exact=True, limit=20)
    whole = sampling.downsample_zero(labelled, "label", "id", exact=True)
    assert same(split, whole)
    assert split.filter("label = 0").count() == round(0.4 * ROWS / 2)


@pytest.mark.parametrize("how", ["contiguous", "stratified"])
def test_folds(skewed, how):
    split = sampling.assign_folds(skewed, "id", how=how, label="key", limit=20)
    assert same(split, sampling.assign_folds(skewed, "id", how=how, label="key"))
    if how == "contiguous":
        sizes = [r["count"] for r in split.groupBy("fold").count().collect()]
        assert sizes == [ROWS // 5] * 5


def test_auc(skewed):
    labelled = skewed.withColumn("y", (F.col("id") % 2).cast("int"))
    assert same(answer.auc_score(labelled, "y", "x", limit=20), answer.auc_score(labelled, "y", "x"))


def test_large_lookup_is_not_broadcast(spark, skewed):
    table = skewed.groupBy("key").count()
    small, large = pin_small(table, 100), pin_small(table, 10)
    assert large is table
    assert small.count() == table.count()


def test_lookup_beyond_the_limit(skewed, monkeypatch):
    expected = encode.frequency_encode(skewed, encode.fit_frequency([skewed], ["key"]))
    monkeypatch.setattr(encode, "pin_small", lambda df: session.pin_small(df, 5))
    assert same(encode.frequency_encode(skewed, encode.fit_frequency([skewed], ["key"])), expected)


def test_written_stage_survives_its_source(spark, skewed):
    cut = session.cut_lineage(skewed)
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert same(cut, skewed)


@pytest.mark.parametrize("rows", [101, 1001, 4321])
def test_quantiles_of_split_groups_agree_to_the_bit(spark, rows):
    values = spark.range(rows).select((F.pmod(F.col("id") * 7919, F.lit(100003)) * F.lit(12.34567)).alias("x"), F.lit(1).alias("k"))
    probs = [i / 100 for i in range(1, 100)]
    whole = ranking.exact_quantiles(values, ["x"], probs, ["k"]).head()
    assert ranking.exact_quantiles(values, ["x"], probs, ["k"], limit=50).head() == whole
    assert ranking.fit_quantiles(values, ["x"], probs)["x"] == [whole[f"q{i}"] for i in range(99)]
    assert ranking.fit_quantiles(values, ["x"], probs, ranges=3)["x"] == [whole[f"q{i}"] for i in range(99)]


def test_quantiles_of_odd_columns(spark):
    rows = spark.createDataFrame([(None, float("nan"), 1.0), (None, float("inf"), 1.0), (None, 2.0, 1.0)], "a double, b double, c double")
    found = ranking.fit_quantiles(rows, ["a", "b", "c"], [0.0, 0.5])
    assert found["a"] == [None, None] and found["b"][0] == 2.0 and found["c"] == [1.0, 1.0]


def plans(spark, monkeypatch, run):
    """The plans of all counts and results that ``run`` asks for."""
    seen = []
    kind = type(spark.range(0))
    for name in ("count", "collect", "head", "isEmpty"):
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, *a, real=real, **b: seen.append(
            self._jdf.queryExecution().optimizedPlan().toString()) or real(self, *a, **b))
    run().collect()
    return seen


@pytest.mark.parametrize("name", ["auc_score", "assign_folds", "index_encode", "downsample_zero_exact", "quantile_bin"])
def test_size_checks_do_not_gather_rows(spark, monkeypatch, name):
    from bidlens.catalog import QUERIES
    found = plans(spark, monkeypatch, lambda: QUERIES[name](spark, "/root/testdata/sf0.001"))
    # Lookup tables of at most PIN_ROWS rows are read by a limit at the top, which stops early.
    assert found and not any("GlobalLimit" in p and "Aggregate" in p.split("GlobalLimit")[0] for p in found)


def crossed(rows, a, b):
    return {(r[0], r[1]): r["count"] for r in rows.groupBy(a, b).count().collect()}


def test_salts_are_independent(spark):
    rows = spark.range(60_000).select("id", *[sampling.fold_by_hash("id", 5, s).alias(f"s{s}") for s in (0, 1, 7, 777)],
                                      sampling.fold_by_hash(F.col("id") * 512 + 104, 5, 1).alias("spaced"),
                                      (sampling.spread(F.col("id") * 512 + 104) < int(0.4 * sampling.SPREAD_RANGE)).cast("int").alias("kept"))
    for a, b in (("s0", "s1"), ("s0", "s777"), ("s1", "s7"), ("s7", "s777")):
        cells = crossed(rows, a, b)
        assert len(cells) == 25 and all(abs(n - 2400) < 5 * 2400 ** 0.5 for n in cells.values())
    cells = crossed(rows.filter("kept = 1"), "spaced", "kept")
    assert len(cells) == 5 and all(abs(n - 4800) < 5 * 4800 ** 0.5 for n in cells.values())
    assert rows.select(sampling.spread("id", 3)).distinct().count() == 60_000
    assert sampling.downsample_zero(rows.withColumn("y", F.lit(0)), "y", "id", exact=True).count() == 24_000


def test_top_folds_cut_across_base_folds(spark):
    rows = spark.range(6000).withColumn("y", (F.col("id") % 2).cast("int"))
    base = sampling.assign_folds(rows, "id", how="stratified", label="y")
    both = sampling.assign_folds(base, "id", how="stratified", label="y", salt=777, into="top")
    cells = crossed(both, "fold", "top")
    assert len(cells) == 25 and all(abs(n - 240) < 5 * 240 ** 0.5 for n in cells.values())


def test_blends_tried_in_several_passes(skewed, monkeypatch):
    from bidlens.functions.metrics import mean_absolute_error
    from bidlens.operators import blend
    rows = skewed.select("x", (F.col("x") + 1).alias("m0"), (F.col("x") - 2).alias("m1"), (F.col("x") * 1.1).alias("m2"))
    whole = blend.blend_grid(rows, ["m0", "m1", "m2"], "x", 5, mean_absolute_error)
    monkeypatch.setattr(blend, "WEIGHTINGS_PER_PASS", 4)
    assert same(blend.blend_grid(rows, ["m0", "m1", "m2"], "x", 5, mean_absolute_error), whole) and whole.count() == 21


@pytest.mark.parametrize("ranges", [40, 2000])
@pytest.mark.parametrize("few", [100, 20_000])
def test_brackets_give_exact_quantiles(spark, ranges, few):
    n = 5003
    rows = spark.range(n).select(
        (F.pmod(F.col("id") * 7919, F.lit(100003)) * F.lit(12.34567)).alias("spread"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pmod(F.col("id") * 31, F.lit(40)).cast("double")).alias("ties"),
        F.lit(2.5).alias("flat"), F.when(F.col("id") < 2, F.col("id").cast("double")).alias("two"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(-F.col("id") ** 3).alias("gone"),
        F.when(F.col("id") % 5 == 0, F.lit(float("inf"))).when(F.col("id") % 5 == 1, F.lit(float("-inf")))
        .otherwise(F.col("id") % 7).alias("ends"), F.lit(None).cast("double").alias("none"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.731, 0.9, 0.95, 1.0]
    cols = rows.columns
    found = ranking.fit_quantiles(rows, cols, probs, ranges, few)
    whole = {r["stat"]: [r[f"q{i}"] for i in range(len(probs))] for r in ranking.exact_quantiles(rows, cols, probs).collect()}
    assert found["none"] == [None] * len(probs)
    assert {c: found[c] for c in whole if c != "ends"} == {c: v for c, v in whole.items() if c != "ends"}
    assert list(map(str, found["ends"])) == list(map(str, whole["ends"]))


def test_brackets_of_many_columns(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BRACKETS_PER_PASS", 7)
    rows = spark.range(500).select(*[(F.col("id") * (i + 1) % 101).alias(f"x{i}") for i in range(9)])
    probs = [0.1, 0.5, 0.9]
    whole = {r["stat"]: [r["q0"], r["q1"], r["q2"]] for r in ranking.exact_quantiles(rows, rows.columns, probs).collect()}
    assert ranking.fit_quantiles(rows, rows.columns, probs, few=20) == whole
    assert ranking.fit_quantiles(rows, rows.columns, []) == {c: [] for c in rows.columns}
