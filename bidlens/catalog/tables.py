"""Auction-shaped views over the given TPC-H-like tables.

The SQL runs unchanged on Spark and on the checking engine, except for the
packing of entries into text, which only Spark does.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.functions.scalar import epoch_local, safe_time
from bidlens.operators.queue import parse_queue
from bidlens.session import cut_lineage, size_shuffles, sorted_groups
from bidlens.sources.readers import clean_static

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "labels"]

VIEWS = {
    "auction_entries": """
select l_orderkey as request_id, o_custkey as user_id, l_orderkey % 5 as position_id,
       l_orderkey % 13 as day_idx,
       1554825600 + (l_orderkey % 13) * 86400 + (l_orderkey * 37) % 86400 as exposure_epoch,
       l_partkey as ad_id, l_quantity as filler, l_discount as pctr, l_tax as q_ecpm,
       l_extendedprice as total_ecpm,
       case when l_returnflag = 'R' then 1 else 0 end as filter_flag,
       case when row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey,
            l_linenumber, l_suppkey, l_quantity, l_discount, l_tax) = 1 then 1 else 0 end as exposed
from lineitem join orders on l_orderkey = o_orderkey""",
    "ad_static": """
select p_partkey as ad_id,
       case when p_partkey % 10 = 0 then -1 else 1546300800 + p_partkey * 3600 end as create_time,
       p_partkey % 100 as ad_account_id, p_partkey % 37 as item_id, p_size % 6 as item_category,
       p_partkey % 9 as industry_id, p_size % 7 as ad_size_id
from part""",
    "ad_operation": """
select (event_id * 7) % 499 as ad_id,
       case when event_id % 50 = 0 then '0' else concat('201904',
            lpad(cast(1 + event_id % 25 as string), 2, '0'), lpad(cast(event_id % 24 as string), 2, '0'),
            lpad(cast(event_id % 60 as string), 2, '0'), lpad(cast((event_id * 7) % 60 as string), 2, '0')) end as time,
       event_id % 2 as operation, event_id % 3 as object, event_id % 4 as cost_mode, value as bid
from events""",
    "test_sample": """
select o_orderkey as test_id, o_custkey as ad_id, o_orderkey % 3 as object, o_orderkey % 4 as cost_mode,
       o_totalprice as bid, cast(substr(o_orderpriority, 1, 1) as int) as tied_bid,
       ((o_orderkey * 13) % 1000) / cast(10 as double) as predict_val
from orders""",
    "test_requests": """
select ad_id, request_id, min(position_id) as position_id from auction_entries
where day_idx = 12 group by ad_id, request_id""",
    "scored": """
select l_orderkey as k1, l_linenumber as k2, l_suppkey as k3, l_quantity as y,
       l_linenumber * cast(7 as double) as p1, cast(l_partkey % 50 as double) as p2,
       cast(l_suppkey % 40 as double) as p3
from lineitem""",
    "graph_edges": """
select l_suppkey as src, (l_suppkey * 31 + (l_partkey % 4) * 17 + l_linenumber) % (select count(*) from supplier) as dst
from lineitem""",
    "fm_factors": """
select f.l_linenumber as feature, k.r_regionkey as k,
       ((f.l_linenumber * 7 + k.r_regionkey * 3) % 11 - 5) / cast(10 as double) as v
from (select distinct l_linenumber from lineitem) f cross join region k""",
    "fm_input": """
select l_orderkey as row, l_linenumber as feature, sum(l_quantity) / cast(50 as double) as x
from lineitem group by l_orderkey, l_linenumber""",
    # One row per labelled document, for the two-class operators.
    "labelled": """
select d.doc_id, cast(d.n_chars as double) as n_chars, d.lang, d.source,
       cast(d.doc_id % 7 as double) as f7, cast(d.doc_id % 11 as double) as f11, l.quality, l.toxic
from documents d join labels l on d.doc_id = l.doc_id""",
    # Checking side only: the training tables in relational form.
    "entry_times": """
select *, cast(make_timestamp(cast(exposure_epoch + 28800 as bigint) * 1000000) as timestamp) as exposure_time,
       date '2019-04-11' + cast(day_idx as int) as days
from auction_entries""",
    "queue_stats": """
select *, avg(total_ecpm) over q as rival_epcm, avg(pctr) over q as rival_pctr,
       avg(q_ecpm) over q as rival_q_epcm, avg(filter_flag) over q as rival_filter_rate,
       greatest(max(total_ecpm) over q, 0) as rival_max_epcm, count(*) over q as rival_num
from entry_times window q as (partition by request_id)""",
    "ad_days": """
select ad_id, days, count(*) as requestion_num, count(distinct user_id) as user_num,
       avg(filter_flag) as filter_rate, avg(total_ecpm) as total_ecpm, avg(q_ecpm) as q_ecpm,
       avg(pctr) as pctr, avg(rival_epcm) as rival_epcm, avg(rival_pctr) as rival_pctr,
       avg(rival_q_epcm) as rival_q_epcm, avg(rival_filter_rate) as rival_filter_rate,
       avg(rival_max_epcm) as rival_max_epcm, avg(rival_num) as rival_num
from queue_stats group by ad_id, days""",
    "exposures": """
select request_id, user_id, ad_id, days as file_days, exposure_time,
       cast(exposure_time - interval 1 microsecond as date) + 1 as days
from entry_times where exposed = 1""",
    "day_labels": """
select ad_id, file_days as days, count(user_id) as y from exposures group by ad_id, file_days""",
    "operation_times": """
select ad_id, try_strptime(time, '%Y%m%d%H%M%S') as time, object, cost_mode, bid from ad_operation""",
    "ad_days_static": """
select d.*, s.ad_account_id, s.item_id, s.ad_size_id from ad_days d left join ad_static s on d.ad_id = s.ad_id""",
}

# Views a view is built on, in order.
NEEDS = {
    "test_requests": ["auction_entries"],
    "entry_times": ["auction_entries"],
    "queue_stats": ["entry_times"],
    "ad_days": ["queue_stats"],
    "exposures": ["entry_times"],
    "day_labels": ["exposures"],
    "operation_times": ["ad_operation"],
    "ad_days_static": ["ad_days", "ad_static"],
}


def with_views(sql: str, views: Sequence[str]) -> str:
    """Put the named views, and those they need, in front of a statement."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        add(name)
    body = sql.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ordered)
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class Tables:
    """The given tables of one folder and the auction-shaped views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        size_shuffles(spark, folder)

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        sql = with_views(f"select * from {name}", [name])
        words = set(re.findall(r"[a-z]+", sql))
        for base in words.intersection(BASE):
            self.base(base).createOrReplaceTempView(base)
        return self.spark.sql(sql)

    def entries(self) -> DataFrame:
        return self.view("auction_entries")

    def _packed(self, entries: DataFrame, fields: list[str], ordered: bool = False) -> DataFrame:
        keys = ["request_id", "exposure_epoch", "user_id", "position_id", "day_idx"]
        entry = F.concat_ws(",", *[F.col(f).cast("string") for f in fields])
        if ordered:
            entries = entries.select(*keys, entry.alias("_entry")).sortWithinPartitions(*keys)
            entry = F.col("_entry")
        return entries.groupBy(*keys).agg(F.concat_ws(";", F.sort_array(F.collect_list(entry))).alias("ad_info"))

    def track_log(self, ordered: bool = False) -> DataFrame:
        """Packed training log; ``day_idx`` tells the daily file. ``ordered``: for use in ``sorted_groups``."""
        return self._packed(self.entries(), ["ad_id", "filler", "pctr", "q_ecpm", "total_ecpm",
                                             "filter_flag", "exposed"], ordered)

    def staged_log(self) -> DataFrame:
        """The timed log with parsed queues as a written table, for queries that read it several times.

        A queue lies in one partition, as its request does, so its entries are collected once, from sorted rows.
        """
        with sorted_groups(self.spark):
            return cut_lineage(parse_queue(self.timed_log(ordered=True)), "log")

    def timed_log(self, ordered: bool = False) -> DataFrame:
        """Packed training log with local time and the label of its daily file."""
        return (self.track_log(ordered)
                .withColumn("exposure_time", epoch_local("exposure_epoch"))
                .withColumn("days", F.date_add(F.lit("2019-04-11").cast("date"), F.col("day_idx").cast("int")))
                .drop("exposure_epoch", "day_idx"))

    def test_log(self) -> DataFrame:
        kept = self.entries().filter("day_idx = 12 and request_id % 7 <> 0")
        return self._packed(kept, ["ad_id", "filler", "pctr", "q_ecpm", "total_ecpm", "filter_flag"])

    def test_select(self) -> DataFrame:
        item = F.concat_ws(",", F.col("request_id").cast("string"), F.col("position_id").cast("string"))
        return self.view("test_requests").groupBy("ad_id").agg(
            F.concat_ws("|", F.collect_list(item)).alias("requestion_list"))

    def static(self) -> DataFrame:
        return clean_static(self.view("ad_static"))

    def operations(self) -> DataFrame:
        return self.view("ad_operation").withColumn("time", safe_time("time"))
