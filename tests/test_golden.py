"""Hand-computed results on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bidlens.functions import metrics, scalar
from bidlens.operators import (answer, asof, blend, days, encode, factorize, graph, history, queue, ranking, requests,
                               sampling)
from bidlens.schemas import SETTINGS
from bidlens.sources import readers

DAY = dt.date(2019, 4, 11)
QUEUES = [
    (1, 1, "10,9,0.1,5,50,0,1;20,9,0.2,7,30,1,0"),
    (2, 2, "10,9,0.3,1,10,0,0;30,9,0.1,2,20,0,1"),
    (3, 1, "10,9,0.2,3,40,0,1"),
]


def log_of(spark, rows):
    return spark.createDataFrame(rows, "request_id int, user_id int, ad_info string").withColumn("days", F.lit(DAY))


def approx(rows, names):
    return {row[names[0]]: pytest.approx(tuple(row[n] for n in names[1:])) for row in rows}


def test_queue_statistics(spark):
    rows = queue.ad_day_request_stats(log_of(spark, QUEUES)).collect()
    got = {r["ad_id"]: [r[c] for c in queue.STAT_COLUMNS] for r in rows}
    # requestion, users, filter, total, q, pctr, rival: epcm, pctr, q, filter, max, num
    assert got[10] == pytest.approx([3, 2, 0, 100 / 3, 3, 0.2, 95 / 3, 0.55 / 3, 3.5, 1 / 6, 110 / 3, 5 / 3])
    assert got[20] == pytest.approx([1, 1, 1, 30, 7, 0.2, 40, 0.15, 6, 0.5, 50, 2])
    assert got[30] == pytest.approx([1, 1, 0, 20, 2, 0.1, 15, 0.2, 1.5, 0, 20, 2])


def test_labels_count_exposures(spark):
    log = log_of(spark, QUEUES)
    joined = queue.label_join(queue.ad_day_request_stats(log), queue.label_counts(queue.exposed_ad(log)))
    assert {r["ad_id"]: r["Y"] for r in joined.collect()} == {10: 2, 20: 0, 30: 1}


def test_same_ad_twice_in_a_queue(spark):
    row = queue.ad_day_request_stats(log_of(spark, [(1, 1, "5,0,0.1,1,10,0,1;5,0,0.3,1,30,0,0")])).head()
    assert (row["requestion_num"], row["user_num"], row["total_ecpm"], row["rival_num"]) == (2, 1, 20, 2)


def test_negative_maximum_has_a_floor_in_training_only(spark):
    train = queue.ad_day_request_stats(log_of(spark, [(1, 1, "5,0,0.1,1,-10,0,1")])).head()
    assert train["rival_max_epcm"] == 0
    test = requests.request_queue_profile(
        spark.createDataFrame([(1, 1, "5,0,0.1,1,-10,0")], "request_id int, user_id int, ad_info string")).head()
    assert test["rival_max_epcm"] == -10


@pytest.mark.parametrize("packed, reason", [
    ("1,0,x,1,10,0,1", "bad number"), ("1,0", "bad number"), ("1,0,0.1,1,10,0,0", "no exposed entry"),
    ("1,0,0.1,1,10,0,1", None)])
def test_quarantine_and_strict_failure(spark, packed, reason):
    log = log_of(spark, [(1, 1, packed)])
    assert queue.quarantine_log(log).head()["reason"] == reason
    if reason == "bad number":
        with pytest.raises(Exception):
            queue.ad_day_request_stats(log).collect()
    if reason == "no exposed entry":
        with pytest.raises(Exception):
            queue.exposed_ad(log).collect()


def test_malformed_file_raises(spark, tmp_path):
    (tmp_path / "log.out").write_text("1\t1554825600\t7\t2\t5,0,0.1,1,10,0,1\nx\t1554825600\t7\t2\t5,0,0.1,1,10,0,1\n")
    with pytest.raises(Exception):
        readers.scan_log(spark, str(tmp_path / "log.out")).collect()


def test_static_needs_every_value(spark, tmp_path):
    (tmp_path / "static.out").write_text("1\t-1\t1\t2\t3\t4\t5\n")
    assert readers.scan_static(spark, str(tmp_path / "static.out")).head()["create_time"] is None
    (tmp_path / "gap.out").write_text("1\t-1\t\t2\t3\t4\t5\n")
    with pytest.raises(Exception):
        readers.scan_static(spark, str(tmp_path / "gap.out")).collect()


def test_file_label_and_row_label(spark):
    rows = [("a", dt.datetime(2019, 4, 10)), ("a", dt.datetime(2019, 4, 10, 0, 0, 1))]
    df = spark.createDataFrame(rows, "file string, exposure_time timestamp_ntz")
    by_row = {r["exposure_time"]: r["days"] for r in days.row_day_label(df).collect()}
    assert by_row == {rows[0][1]: dt.date(2019, 4, 10), rows[1][1]: DAY}
    assert {r["days"] for r in days.file_day_label(df).collect()} == {DAY}


def test_settings_before_the_day(spark):
    ops = spark.createDataFrame([
        (1, dt.datetime(2019, 4, 10, 23, 59, 59), 0, 0, 5.0), (1, dt.datetime(2019, 4, 11), 0, 0, 6.0),
        (1, None, 0, 0, 7.0), (3, dt.datetime(2019, 4, 1), 1, 1, 1.0)],
        "ad_id int, time timestamp_ntz, object int, cost_mode int, bid double")
    spine = spark.createDataFrame([(1, DAY), (1, dt.date(2019, 4, 12)), (2, DAY), (3, DAY), (3, DAY)],
                                  "ad_id int, days date")
    rows = asof.asof_settings(spine, ops, SETTINGS).collect()
    assert sorted((r["ad_id"], r["days"].day, r["bid"]) for r in rows if r["bid"]) == [
        (1, 11, 5.0), (1, 12, 6.0), (3, 11, 1.0), (3, 11, 1.0)]
    assert [r["bid"] for r in rows if r["ad_id"] == 2] == [None]
    assert days.drop_incomplete(asof.asof_settings(spine, ops, SETTINGS)).count() == 4


def test_listed_requests(spark):
    select = spark.createDataFrame([(7, "1,0|2,0|99,0"), (8, "98,0")], "ad_id int, requestion_list string")
    log = spark.createDataFrame([(1, 1, "5,0,0.1,1,50,0;6,0,0.1,1,30,0"), (2, 2, "5,0,0.1,1,10,0;6,0,0.1,1,20,0")],
                                "request_id int, user_id int, ad_info string")
    rows = {r["ad_id"]: r for r in requests.test_request_stats(select, log).collect()}
    assert (rows[7]["requestion_num"], rows[7]["user_num"], rows[7]["rival_epcm"]) == (3, 2, 27.5)
    assert (rows[8]["requestion_num"], rows[8]["user_num"], rows[8]["rival_epcm"]) == (1, 0, None)


def test_lagged_median_and_spread(spark):
    daily = spark.createDataFrame([(1, DAY, 4), (2, DAY, 6)], "ad_id int, days date, exposure bigint")
    static = spark.createDataFrame([(1, 100), (2, 100)], "ad_id int, ad_account_id int")
    spine = spark.createDataFrame([(1, dt.date(2019, 4, 13), 100), (1, dt.date(2019, 4, 12), 100)],
                                  "ad_id int, days date, ad_account_id int")
    rows = history.group_exposure_median_lags(spine, daily, static, ["ad_account_id"], [2]).collect()
    assert {r["days"].day: r["ad_account_id_exposure_2day"] for r in rows} == {13: 5.0, 12: 0.0}
    stats = daily.join(static, "ad_id").withColumn("user_num", F.col("exposure").cast("double"))
    alone = history.group_stat_std_lags(spine, stats.filter("ad_id = 1"), lags=[1], cols=["user_num"]).collect()
    assert {r["ad_account_id_user_num_std_1day"] for r in alone} == {-1.0}


BIDS = [(1, 1, 5, 100), (2, 1, 7, 200), (3, 1, 9, 300), (4, 2, 4, 50), (5, 2, 4, 60), (6, 3, 6, 0.3),
        (7, 4, 5, 10), (8, 4, 5, 20), (9, 4, 5, 30)]


def bids(spark):
    return spark.createDataFrame([(a, b, float(c), float(d)) for a, b, c, d in BIDS],
                                 "test_id int, ad_id int, bid double, predict_val double")


def test_bid_ranks(spark):
    rows = ranking.average_rank(bids(spark), "ad_id", "bid", "rank").collect()
    assert {r["test_id"]: r["rank"] for r in rows} == {1: 1, 2: 2, 3: 3, 4: 1.5, 5: 1.5, 6: 1, 7: 2, 8: 2, 9: 2}


def test_answer_by_bid(spark):
    got = {}
    for r in answer.answer_by_bid(bids(spark)).collect():
        got.setdefault(r["test_id"], []).append(r["predict_val"])
    assert [got[i][0] for i in (1, 2, 3)] == pytest.approx([199.9999, 200, 200.0001])
    assert got[6] == [1.0]
    assert len(got) == 9 and all(len(v) == 1 for v in got.values())
    strict = answer.answer_by_bid(bids(spark), strict=True).collect()
    assert [r["predict_val"] for r in strict if r["test_id"] == 4] == [None]
    assert sum(r["test_id"] in (7, 8, 9) for r in strict) == 9


def one_value(spark, rows, column):
    return spark.createDataFrame([(float(a), float(b)) for a, b in rows], "y double, p double").agg(column.alias("v")).head()["v"]


def test_exposure_score(spark):
    assert one_value(spark, [(0, 1), (10, 30)], metrics.exposure_score("y", "p")) == pytest.approx(80)
    assert one_value(spark, [(3, 3), (0, 0)], metrics.exposure_score("y", "p")) == pytest.approx(90)
    assert one_value(spark, [(4, 0), (4, 0)], metrics.exposure_score("y", 4)) == pytest.approx(90)


def test_losses(spark):
    assert one_value(spark, [(0, -4)], metrics.smape_loss("y", "p")) == 0
    assert one_value(spark, [(0, -4)], metrics.leaky_smape_loss("y", "p")) == pytest.approx(0.05 / 1.95)


def test_objective(spark):
    grad, hess = metrics.relative_gradients("y", "p")
    df = spark.createDataFrame([(2.0, 1.0), (100.0, 300.0), (0.0, 0.1)], "y double, p double")
    assert [tuple(r) for r in df.select(grad, hess).collect()] == [(-1, 1), (1.5, 0), (0, 20)]


def test_upsampling(spark):
    def labels(zeros, ones):
        return spark.createDataFrame([(0,)] * zeros + [(1,)] * ones, "label int")
    assert sampling.upsample_minority(labels(7, 3), "label").count() == 13
    assert sampling.upsample_minority(labels(5, 5), "label").count() == 10
    with pytest.raises(ValueError):
        sampling.upsample_minority(labels(5, 0), "label")


def test_quantiles_and_scale(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0), (10.0, 4.0)], "x double, flat double")
    assert ranking.fit_quantiles(df, ["x"], [0.5, 0.95])["x"] == pytest.approx([2.5, 8.95])
    fitted = encode.fit_percentile_scale(df, ["x", "flat"], 95)
    assert list(fitted) == ["x"]
    first = encode.percentile_scale(df, fitted).orderBy("flat", "x").head()["x"]
    assert first == pytest.approx(-3 / 7.95)


def test_rounding(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert [r[0] for r in df.select(scalar.round_half_even("x")).collect()] == [2.0, 4.0]


def test_quantile_bins_start_at_zero(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    got = sorted(r["x"] for r in encode.quantile_bin(df, encode.fit_quantile_bins(df, ["x"])).collect())
    assert got[:6] == [0] * 6 and got[-1] == 4


def test_factorization(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0)], "row int, feature int, x double")
    factors = spark.createDataFrame([(0, 0, 0.5), (1, 0, -1.0)], "feature int, k int, v double")
    assert factorize.fm_score(rows, factors).head()["score"] == pytest.approx(-1)
    assert factorize.bi_interaction(rows, factors).head()["bi_0"] == pytest.approx(-1)


def test_blend_order_and_ties(spark):
    assert blend.weight_grid(2, 2) == [[2, 0], [1, 1], [0, 2]]
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "y double, a double, b double")
    best = blend.best_blend(blend.blend_grid(df, ["a", "b"], "y", 2, metrics.exposure_score)).head()
    assert (best["w0"], best["w1"]) == (2, 0)


def test_diffusion(spark):
    edges = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 0), (2, 0)], "src int, dst int")
    nodes = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 4.0)], "node int, x double")
    rows = graph.diffusion_features(edges, nodes, ["x"], 3).orderBy("hop", "node").collect()
    assert [r["x"] for r in rows] == [1, 2, 4, 3, 1, 1, 1, 3, 3]
    sink = graph.diffusion_features(edges.filter("src <> 2"), nodes, ["x"], 2).filter("hop = 1 and node = 2").head()
    assert sink["x"] is None


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.2,), (5.0,)], "x double")
    got = [r[0] for r in df.select(scalar.clip_low("x")).collect()]
    assert got[0] is None and got[1] != got[1] and got[2:] == [1.0, 5.0]


def test_unseen_category_raises(spark):
    known = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "c string, at int")
    fitted = encode.fit_index(known, ["c"], "at")
    got = encode.index_encode(known, fitted).orderBy("at").collect()
    assert [r["c"] for r in got] == [0, 1, 0, 2]
    with pytest.raises(Exception):
        encode.index_encode(spark.createDataFrame([("z", 1)], "c string, at int"), fitted).collect()


def test_one_hot_order_and_custom_rules(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "c string, at int")
    hot = encode.one_hot(df, "c", encode.fit_categories(df, "c", "at"))
    assert hot.columns == ["at", "c_b", "c_a"]
    assert encode.drop_uninformative(df, lambda d: d.drop("c")).columns == ["at"]
    assert encode.impute_with_flag(df, rule=lambda d: d.na.fill(0)).columns == ["c", "at"]


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1)], "y int, s double")
    assert answer.auc_score(df, "y", "s").head()["auc"] == pytest.approx((1.5 + 1) / 4)


def test_arriving_files_give_the_same_statistics(spark, tmp_path):
    from bidlens.streaming.daily import keep_daily_stats, stream_logs

    def put(day, at):
        lines = [f"{r}\t{1554825600 + at}\t{u}\t1\t{q}" for r, u, q in QUEUES]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"track_log_201904{day}.out").write_text("\n".join(lines) + "\n")

    def catch_up():
        keep_daily_stats(stream_logs(spark, str(tmp_path / "in")), str(tmp_path / "out"),
                         str(tmp_path / "state")).awaitTermination()

    put(10, 100)
    catch_up()
    put(11, 100 + 86400)
    catch_up()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 6 and got.select("days").distinct().count() == 2
    assert {r["requestion_num"] for r in got.filter("ad_id = 10").collect()} == {3}


def test_parsed_queues_give_what_packed_ones_give(spark):
    rows = [(1, 1, "5,0,0.1,1,10,0,0;7,0,0.2,2,20,1,1"), (2, 2, "7,0,0.3,3,30,0,1;7,0,0.1,1,5,0,0"), (3, 1, "5,0,0.1,1,-10,0,1")]
    log = spark.createDataFrame(rows, "request_id int, user_id int, ad_info string").withColumn("days", F.lit(DAY))
    parsed = queue.parse_queue(log)
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for use in (queue.ad_day_request_stats, queue.ad_day_users, queue.exposed_ad):
        assert key(use(parsed)) == key(use(log))
    users = queue.ad_day_users(parsed.repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert "ad_id" in users


def test_statistics_read_only_their_fields(spark, tmp_path):
    log = spark.createDataFrame([(1, 1, "5,0,0.1,1,10,0,1")], "request_id int, user_id int, ad_info string").withColumn("days", F.lit(DAY))
    queue.parse_queue(log).write.parquet(str(tmp_path / "log"))
    staged = spark.read.parquet(str(tmp_path / "log"))
    schema = lambda df: df._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert schema(queue.ad_day_users(staged)) == "struct<user_id:int,days:date,queue:array<struct<ad_id:bigint>>>"
    assert schema(queue.exposed_ad(staged).select("exposed_ad_id")) == "struct<queue:array<struct<ad_id:bigint,exposed:int>>>"
