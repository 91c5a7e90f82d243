"""Queries over lagged history features."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidlens.catalog.base import query, r, rounded
from bidlens.catalog.tables import Tables
from bidlens.operators import days, history, queue
from bidlens.operators.history import HISTORY_STATS, SPREAD_STATS, TRAIN_LAGS
from bidlens.session import cut_lineage

GROUP_KEYS = ["ad_account_id", "item_id", "ad_size_id"]


def exposures(log):
    """Winners with the label of their own time, as history wants it."""
    exposure = queue.exposed_ad(log.drop("days"))
    return days.row_day_label(exposure).withColumnRenamed("exposed_ad_id", "ad_id")


def daily_counts(log):
    return cut_lineage(history.daily_exposure(exposures(log)), "daily")


def spine(t: Tables, log):
    """Labelled ad days with the grouping attributes."""
    labels = queue.label_counts(queue.exposed_ad(log)).drop("Y")
    return labels.join(t.static().select("ad_id", *GROUP_KEYS), "ad_id", "left")


def stats_with_static(t: Tables, log):
    stats = queue.ad_day_request_stats(log)
    return cut_lineage(stats.join(t.static().select("ad_id", *GROUP_KEYS), "ad_id", "left"), "stats")


SPINE = """spine as (select l.ad_id, l.days, s.ad_account_id, s.item_id, s.ad_size_id
from day_labels l left join ad_static s on l.ad_id = s.ad_id),
shown as (select e.ad_id, e.days, count(user_id) as exposure from exposures e group by e.ad_id, e.days)"""


def lagged(base: str, key: str, pairs: list[tuple[str, str]], fill: int,
           lags: tuple[int, ...] = TRAIN_LAGS) -> tuple[str, str]:
    """Columns and joins that look up ``base`` (key, days, stat…) at each lag."""
    columns = ", ".join(r(f"coalesce({base}{i}.{stat}, {fill})", f"{name}_{i}day")
                        for stat, name in pairs for i in lags)
    joins = " ".join(f"left join {base} {base}{i} on {base}{i}.{key} = spine.{key} and {base}{i}.days + {i} = spine.days"
                     for i in lags)
    return columns, joins


_cols, _joins = lagged("shown", "ad_id", [("exposure", "ad_id_exposure")], 0)


@query("ad_exposure_lags", f"""
with {SPINE}
select spine.ad_id, spine.days, {_cols.replace('round((', 'cast(round((').replace(', 6) as', ', 6) as bigint) as')}
from spine {_joins}""", ["day_labels", "ad_static"])
def ad_exposure_lags(spark, folder):
    t = Tables(spark, folder)
    log = t.staged_log()
    daily = daily_counts(log)
    return history.ad_exposure_lags(spine(t, log).select("ad_id", "days"), daily)


_parts = {k: lagged(f"by_{k}", k, [("exposure", f"{k}_exposure")], 0) for k in GROUP_KEYS}
_medians = ",\n".join(
    f"by_{k} as (select s.{k}, w.days, median(w.exposure) as exposure from shown w "
    f"join ad_static s on w.ad_id = s.ad_id group by s.{k}, w.days)" for k in GROUP_KEYS)


@query("group_exposure_median_lags", f"""
with {SPINE}, {_medians}
select spine.ad_id, spine.days, {', '.join(p[0] for p in _parts.values())}
from spine {' '.join(p[1] for p in _parts.values())}""", ["day_labels", "ad_static"])
def group_exposure_median_lags(spark, folder):
    t = Tables(spark, folder)
    log = t.staged_log()
    daily = daily_counts(log)
    return rounded(history.group_exposure_median_lags(spine(t, log), daily, t.static()).drop(*GROUP_KEYS))


_cols, _joins = lagged("ad_days", "ad_id", [(s, f"ad_id_{s}") for s in HISTORY_STATS], -1)


@query("ad_stat_lags", f"""
with {SPINE} select spine.ad_id, spine.days, {_cols} from spine {_joins}""",
       ["day_labels", "ad_static", "ad_days"])
def ad_stat_lags(spark, folder):
    t = Tables(spark, folder)
    log = t.staged_log()
    stats = queue.ad_day_request_stats(log).withColumn("user_num", F.col("user_num").cast("double"))
    return rounded(history.ad_stat_lags(spine(t, log).select("ad_id", "days"), stats))


_keys = GROUP_KEYS[:2]
_parts = {k: lagged(f"by_{k}", k, [(s, f"{k}_{s}") for s in HISTORY_STATS], -1) for k in _keys}
_medians = ",\n".join(
    f"by_{k} as (select {k}, days, {', '.join(f'median({s}) as {s}' for s in HISTORY_STATS)} "
    f"from ad_days_static group by {k}, days)" for k in _keys)


@query("group_stat_median_lags", f"""
with {SPINE}, {_medians}
select spine.ad_id, spine.days, {', '.join(p[0] for p in _parts.values())}
from spine {' '.join(p[1] for p in _parts.values())}""", ["day_labels", "ad_days_static"])
def group_stat_median_lags(spark, folder):
    t = Tables(spark, folder)
    log = t.staged_log()
    return rounded(history.group_stat_median_lags(spine(t, log), stats_with_static(t, log)).drop(*GROUP_KEYS))


_cols, _joins = lagged("spread", "ad_account_id", [(s, f"ad_account_id_{s}_std") for s in SPREAD_STATS], -1)


@query("group_stat_std_lags", f"""
with {SPINE}, spread as (select ad_account_id, days, {', '.join(f'stddev_samp({s}) as {s}' for s in SPREAD_STATS)}
from ad_days_static group by ad_account_id, days)
select spine.ad_id, spine.days, {_cols} from spine {_joins}""", ["day_labels", "ad_days_static"])
def group_stat_std_lags(spark, folder):
    t = Tables(spark, folder)
    log = t.staged_log()
    return rounded(history.group_stat_std_lags(spine(t, log), stats_with_static(t, log)).drop(*GROUP_KEYS))


@query("lag_join", f"""
with {SPINE}
select a.ad_id, a.days, {r('coalesce(b.exposure, 0)', 'two_days_ago')}
from shown a left join shown b on a.ad_id = b.ad_id and b.days + 2 = a.days""", ["day_labels", "ad_static"])
def lag_join(spark, folder):
    daily = daily_counts(Tables(spark, folder).timed_log())
    out = history.lag_join(daily.drop("exposure"), daily, ["ad_id"], ["exposure"], [2], 0)
    return rounded(out.select("ad_id", "days", F.col("exposure_2day").cast("double").alias("two_days_ago")))
