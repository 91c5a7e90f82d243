"""Queries over the auction log: scans, parsing, day labels, statistics, settings, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded, rs
from bidlens.catalog.tables import Tables
from bidlens.functions import scalar as S
from bidlens.operators import asof, days, queue, requests
from bidlens.schemas import SETTINGS
from bidlens.session import cut_lineage, stage_path
from bidlens.sources import readers, writers

NUMBERS = ["pctr", "q_ecpm", "total_ecpm", "filter_flag"]
STATS = queue.STAT_COLUMNS
COUNTS = ["requestion_num", "user_num"]
DOUBLES = [c for c in STATS if c not in COUNTS]
MEANS = requests.QUEUE_MEANS


def written_logs(t: Tables) -> str:
    """The packed log as thirteen headerless daily folders."""
    root = stage_path(t.spark, "daily-logs")
    stamp = F.date_format(F.date_add(F.lit("2019-04-10").cast("date"), F.col("day_idx").cast("int")), "yyyyMMdd")
    log = t.track_log().select("request_id", "exposure_epoch", "user_id", "position_id", "ad_info",
                               stamp.alias("day_file"))
    log.write.mode("overwrite").partitionBy("day_file").option("sep", "\t").csv(root)
    return root


def log_paths(root: str) -> list[str]:
    return readers.daily_paths(root, name="day_file={:%Y%m%d}")


@query("scan_log", """
select cast(request_id as int) as request_id, exposure_epoch, cast(user_id as int) as user_id,
       cast(position_id as smallint) as position_id, cast(count(*) as int) as entries
from auction_entries group by request_id, exposure_epoch, user_id, position_id""", ["auction_entries"])
def scan_log(spark, folder):
    path = stage_path(spark, "whole-log")
    log = Tables(spark, folder).track_log().select("request_id", "exposure_epoch", "user_id", "position_id", "ad_info")
    log.write.option("sep", "\t").csv(path)
    return readers.scan_log(spark, path).withColumn("entries", F.size(queue.raw_entries())).drop("ad_info")


@query("scan_daily_logs", """
select cast(request_id as int) as request_id, cast(user_id as int) as user_id,
       cast(position_id as smallint) as position_id, exposure_time,
       strftime(days - 1, '%Y%m%d') as file, cast(count(*) as int) as entries
from entry_times group by request_id, user_id, position_id, exposure_time, days""", ["entry_times"])
def scan_daily_logs(spark, folder):
    log = readers.scan_daily_logs(spark, log_paths(written_logs(Tables(spark, folder))))
    return log.withColumn("entries", F.size(queue.raw_entries())).drop("ad_info")


@query("scan_static", """
select cast(ad_id as int) as ad_id,
       make_timestamp((nullif(create_time, -1) + 28800) * 1000000) as create_time,
       cast(ad_account_id as int) as ad_account_id, cast(item_id as int) as item_id,
       cast(item_category as int) as item_category, cast(industry_id as int) as industry_id,
       cast(ad_size_id as int) as ad_size_id from ad_static""", ["ad_static"])
def scan_static(spark, folder):
    t = Tables(spark, folder)
    path = stage_path(spark, "static")
    t.view("ad_static").write.option("sep", "\t").csv(path)
    return readers.scan_static(spark, path)


@query("write_stage", """
select request_id, user_id, ad_id as exposed_ad_id, exposure_time, file_days as days from exposures""",
       ["exposures"])
def write_stage(spark, folder):
    exposure = queue.exposed_ad(Tables(spark, folder).timed_log()).drop("position_id")
    path = stage_path(spark, "exposure")
    writers.write_stage(exposure, path)
    return readers.read_stage(spark, path, exposure.schema)


@query("write_predictions", f"select test_id, {r('predict_val', 'model_predict')} from test_sample",
       ["test_sample"])
def write_predictions(spark, folder):
    path = stage_path(spark, "predictions")
    rows = Tables(spark, folder).view("test_sample").withColumnRenamed("predict_val", "model_predict")
    writers.write_predictions(rows, path)
    return rounded(readers.read_stage(spark, path))


@query("write_submission", f"select test_id, {r('predict_val', 'predict_val')} from test_sample",
       ["test_sample"])
def write_submission(spark, folder):
    path = stage_path(spark, "submission")
    writers.write_submission(Tables(spark, folder).view("test_sample"), path)
    return rounded(spark.read.schema("test_id bigint, predict_val double").csv(path))


@query("parse_queue", f"""
select request_id, cast(count(*) as int) as entries, min(ad_id) as min_ad, max(ad_id) as max_ad,
       max(exposed) as exposed, {', '.join(r(f'sum({c})', c) for c in NUMBERS)}
from auction_entries group by request_id""", ["auction_entries"])
def parse_queue(spark, folder):
    parsed = queue.parse_queue(Tables(spark, folder).track_log())
    ads = F.col("queue.ad_id")
    total = lambda c: F.aggregate(F.col(f"queue.{c}"), F.lit(0.0), lambda a, x: a + x).alias(c)
    return rounded(parsed.select(
        "request_id", F.size("queue").alias("entries"), F.array_min(ads).alias("min_ad"),
        F.array_max(ads).alias("max_ad"), F.array_max("queue.exposed").alias("exposed"),
        *[total(c) for c in NUMBERS]))


@query("explode_queue", f"""
select request_id, user_id, ad_id, exposed, {', '.join(r(f'cast({c} as double)', c) for c in NUMBERS)}
from auction_entries""", ["auction_entries"])
def explode_queue(spark, folder):
    parsed = queue.parse_queue(Tables(spark, folder).track_log().select("request_id", "user_id", "ad_info"))
    return rounded(queue.explode_queue(parsed))


@query("explode_requests", "select ad_id, request_id from test_requests", ["test_requests"])
def explode_requests(spark, folder):
    return requests.explode_requests(Tables(spark, folder).test_select())


@query("file_day_label", """
select request_id, cast(max(exposure_time) over (partition by day_idx) - interval 1 microsecond as date) + 1 as days
from (select distinct request_id, day_idx, exposure_time from entry_times)""", ["entry_times"])
def file_day_label(spark, folder):
    t = Tables(spark, folder)
    log = t.entries().select("request_id", F.col("day_idx").alias("file"),
                             S.epoch_local("exposure_epoch").alias("exposure_time")).distinct()
    return days.file_day_label(log).select("request_id", "days")


@query("row_day_label", """
select distinct request_id, cast(exposure_time - interval 1 microsecond as date) + 1 as days
from entry_times""", ["entry_times"])
def row_day_label(spark, folder):
    log = Tables(spark, folder).timed_log().select("request_id", "exposure_time")
    return days.row_day_label(log).drop("exposure_time")


@query("exposed_ad", "select request_id, ad_id as exposed_ad_id from auction_entries where exposed = 1",
       ["auction_entries"])
def exposed_ad(spark, folder):
    return queue.exposed_ad(Tables(spark, folder).track_log()).select("request_id", "exposed_ad_id")


@query("temporal_split", """
select ad_id, days, case when days < date '2019-04-22' then 'train' else 'valid' end as part
from day_labels""", ["day_labels"])
def temporal_split(spark, folder):
    labels = queue.label_counts(queue.exposed_ad(Tables(spark, folder).timed_log())).drop("Y")
    train, valid = days.temporal_split(labels)
    return train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))


@query("warmup_trim", "select ad_id, days from day_labels where days > date '2019-04-13'", ["day_labels"])
def warmup_trim(spark, folder):
    labels = queue.label_counts(queue.exposed_ad(Tables(spark, folder).timed_log())).drop("Y")
    return days.warmup_trim(labels)


@query("drop_incomplete", """
select ad_id, time, bid from (select ad_id, time, case when bid < 3 then null else bid end as bid
from operation_times) where time is not null and bid is not null""", ["operation_times"])
def drop_incomplete(spark, folder):
    ops = Tables(spark, folder).operations().select("ad_id", "time", F.when(F.col("bid") >= 3, F.col("bid")).alias("bid"))
    return days.drop_incomplete(ops)


@query("fill_missing", """
select ad_id, coalesce(nullif(create_time, -1), 0) as create_time from ad_static""", ["ad_static"])
def fill_missing(spark, folder):
    static = Tables(spark, folder).view("ad_static").select(
        "ad_id", S.sentinel_null("create_time").alias("create_time"))
    return days.fill_missing(static, 0)


@query("sentinel_null", "select ad_id, nullif(create_time, -1) as create_time from ad_static", ["ad_static"])
def sentinel_null(spark, folder):
    return Tables(spark, folder).view("ad_static").select(
        "ad_id", S.sentinel_null("create_time").alias("create_time"))


@query("epoch_local", """
select ad_id, make_timestamp((nullif(create_time, -1) + 28800) * 1000000) as create_time from ad_static""",
       ["ad_static"])
def epoch_local(spark, folder):
    return Tables(spark, folder).static().select("ad_id", "create_time")


@query("safe_time_parse", "select ad_id, time, bid from operation_times", ["operation_times"])
def safe_time_parse(spark, folder):
    return Tables(spark, folder).operations().select("ad_id", "time", "bid")


@query("existing_time", f"""
select l.ad_id, l.days, {r("cast(date_diff('second', make_timestamp((nullif(s.create_time, -1) + 28800) * 1000000), cast(l.days as timestamp)) as double)", 'existingTime')}
from day_labels l left join ad_static s on l.ad_id = s.ad_id""", ["day_labels", "ad_static"])
def existing_time(spark, folder):
    t = Tables(spark, folder)
    labels = queue.label_counts(queue.exposed_ad(t.timed_log()))
    joined = labels.join(t.static(), "ad_id", "left")
    return rounded(joined.select("ad_id", "days", S.existing_time("days", "create_time").alias("existingTime")))


@query("split_fields", """
select request_id, cast(count(*) as int) as entries, cast(count(*) * 6 as int) as commas,
       cast(max(case when rn = 1 then ad_id end) as bigint) as first_ad,
       cast(max(case when rn = 1 then exposed end) as int) as first_exposed
from (select *, row_number() over (partition by request_id order by concat_ws(',', ad_id, filler, pctr, q_ecpm, total_ecpm, filter_flag, exposed)) as rn
      from auction_entries) group by request_id having min(total_ecpm) > -1""", ["auction_entries"])
def split_fields(spark, folder):
    log = Tables(spark, folder).track_log()
    entries = queue.raw_entries()
    first = F.element_at(entries, 1)
    return log.select(
        "request_id", F.size(entries).alias("entries"),
        (F.size(F.split("ad_info", ",", -1)) - 1).alias("commas"),
        queue.entry_ad(first).cast("bigint").alias("first_ad"),
        F.element_at(F.split(first, ","), -1).cast("int").alias("first_exposed"))


def damaged_log(t: Tables):
    """The packed log with some unusable rows."""
    log = t.track_log()
    bad_number = F.regexp_replace("ad_info", r"^([^,]+,[^,]+),", "$1,x")
    no_winner = F.regexp_replace("ad_info", r",1(;|$)", ",0$1")
    return log.withColumn("ad_info", F.when(F.col("request_id") % 97 == 3, bad_number)
                          .when(F.col("request_id") % 89 == 5, no_winner).otherwise(F.col("ad_info")))


@query("quarantine_log", """
select distinct request_id, case when request_id % 97 = 3 then 'bad number' when request_id % 89 = 5
       then 'no exposed entry' end as reason from auction_entries""", ["auction_entries"])
def quarantine_log(spark, folder):
    return queue.quarantine_log(damaged_log(Tables(spark, folder))).select("request_id", "reason")


@query("safe_cast", """
select ad_id, time, try_cast(substr(time, 9, 2) as int) as hour from ad_operation""", ["ad_operation"])
def safe_cast(spark, folder):
    hour = F.substring("time", 9, 2).try_cast("int")
    return Tables(spark, folder).view("ad_operation").select("ad_id", "time", hour.alias("hour"))


@query("safe_ratio", f"""
select request_id, {r('sum(total_ecpm) / nullif(sum(filter_flag), 0)', 'ratio')}
from auction_entries group by request_id""", ["auction_entries"])
def safe_ratio(spark, folder):
    sums = Tables(spark, folder).entries().groupBy("request_id").agg(
        F.sum("total_ecpm").alias("a"), F.sum("filter_flag").cast("double").alias("b"))
    return rounded(sums.select("request_id", S.safe_ratio("a", "b").alias("ratio")))


@query("ad_day_request_stats", f"select ad_id, days, {', '.join(COUNTS)}, {rs(DOUBLES)} from ad_days",
       ["ad_days"])
def ad_day_request_stats(spark, folder):
    return rounded(queue.ad_day_request_stats(Tables(spark, folder).staged_log()))


@query("label_counts", 'select ad_id, days, y as "Y" from day_labels', ["day_labels"])
def label_counts(spark, folder):
    return queue.label_counts(queue.exposed_ad(Tables(spark, folder).timed_log()))


@query("label_join", """
select d.ad_id, d.days, d.requestion_num, coalesce(l.y, 0) as "Y"
from ad_days d left join day_labels l on d.ad_id = l.ad_id and d.days = l.days""", ["ad_days", "day_labels"])
def label_join(spark, folder):
    log = Tables(spark, folder).staged_log()
    stats = queue.ad_day_request_stats(log).select("ad_id", "days", "requestion_num")
    return queue.label_join(stats, queue.label_counts(queue.exposed_ad(log)))


@query("stats_join", f"""
select ad_id, days, {', '.join(COUNTS)}, {r('rival_max_epcm - rival_epcm', 'head_room')} from ad_days""",
       ["ad_days"])
def stats_join(spark, folder):
    stats = queue.ad_day_request_stats(Tables(spark, folder).timed_log())
    return rounded(stats.select("ad_id", "days", *COUNTS,
                                (F.col("rival_max_epcm") - F.col("rival_epcm")).alias("head_room")))


@query("static_join", """
select d.ad_id, d.days, s.ad_account_id, s.item_id, s.item_category, s.industry_id, s.ad_size_id
from day_labels d left join ad_static s on d.ad_id = s.ad_id""", ["day_labels", "ad_static"])
def static_join(spark, folder):
    t = Tables(spark, folder)
    labels = queue.label_counts(queue.exposed_ad(t.timed_log())).drop("Y")
    return labels.join(t.static().drop("create_time"), "ad_id", "left")


ASOF_SQL = """
select l.ad_id, l.days, o.object, o.cost_mode, o.bid
from day_labels l left join (
  select l.ad_id, l.days, max_by(o.object, o.time) as object, max_by(o.cost_mode, o.time) as cost_mode,
         max_by(o.bid, o.time) as bid
  from day_labels l join operation_times o on o.ad_id = l.ad_id and o.time < l.days
  group by l.ad_id, l.days) o on l.ad_id = o.ad_id and l.days = o.days"""


@query("asof_settings", ASOF_SQL, ["day_labels", "operation_times"])
def asof_settings(spark, folder):
    t = Tables(spark, folder)
    spine = cut_lineage(queue.label_counts(queue.exposed_ad(t.timed_log())).drop("Y"), "spine")
    return asof.asof_settings(spine, t.operations(), SETTINGS)


USER_SQL = """
select q.ad_id, count(distinct e.user_id) as user_num from test_requests q
left join (select distinct request_id, user_id from auction_entries where request_id % 7 <> 0) e
on q.request_id = e.request_id group by q.ad_id"""


@query("request_user_count", USER_SQL, ["test_requests"])
def request_user_count(spark, folder):
    t = Tables(spark, folder)
    return requests.request_user_count(t.test_select(), t.test_log())


REQUEST_SQL = f"""
with profile as (
  select request_id, max(user_id) as user_id, avg(total_ecpm) as rival_epcm, max(total_ecpm) as rival_max_epcm,
         avg(filter_flag) as rival_filter_rate, avg(q_ecpm) as rival_q_epcm, avg(pctr) as rival_pctr,
         cast(count(*) as double) as rival_num
  from auction_entries where day_idx = 12 and request_id % 7 <> 0 group by request_id)
select q.ad_id, COUNTS {', '.join(r(f'avg({c})', c) for c in MEANS)}
from test_requests q left join profile p on q.request_id = p.request_id group by q.ad_id"""


@query("request_queue_mean", REQUEST_SQL.replace("COUNTS", ""), ["test_requests"])
def request_queue_mean(spark, folder):
    t = Tables(spark, folder)
    return rounded(requests.request_queue_mean(t.test_select(), t.test_log()))


@query("test_request_stats", REQUEST_SQL.replace(
    "COUNTS", "count(*) as requestion_num, count(distinct p.user_id) as user_num,"), ["test_requests"])
def test_request_stats(spark, folder):
    t = Tables(spark, folder)
    return rounded(requests.test_request_stats(t.test_select(), t.test_log()))


@query("test_enrichment", f"""
with listed as (select ad_id, count(*) as requestion_num from test_requests group by ad_id)
select t.test_id, t.ad_id, {r('t.bid', 'bid')}, s.ad_account_id, l.requestion_num
from test_sample t left join ad_static s on t.ad_id = s.ad_id left join listed l on t.ad_id = l.ad_id""",
       ["test_sample", "test_requests", "ad_static"])
def test_enrichment(spark, folder):
    t = Tables(spark, folder)
    listed = requests.explode_requests(t.test_select()).groupBy("ad_id").agg(F.count(F.lit(1)).alias("requestion_num"))
    rows = requests.test_rows(t.view("test_sample"), t.static().select("ad_id", "ad_account_id"), listed)
    return rounded(rows.select("test_id", "ad_id", "bid", "ad_account_id", "requestion_num"))
