"""Daily statistics as daily files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bidlens import schemas
from bidlens.functions.scalar import epoch_local
from bidlens.operators.days import file_day_label
from bidlens.operators.queue import AVERAGED, STAT_COLUMNS, ad_day_request_stats, ad_day_sums, averaged, user_rows
from bidlens.sources.readers import DAY_STAMP
from bidlens.sources.writers import write_stage


def stream_logs(spark: SparkSession, folder: str, stamp: str = DAY_STAMP) -> DataFrame:
    """New daily files under ``folder``, with the day stamp of each row's file."""
    log = (spark.readStream.schema(schemas.TRACK_LOG).option("sep", "\t").option("mode", "FAILFAST")
           .option("recursiveFileLookup", "true").csv(folder))
    return (log.withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), stamp, 1))
            .withColumn("exposure_time", epoch_local("exposure_epoch")).drop("exposure_epoch"))


def keep_daily_stats(log: DataFrame, out: str, state: str,
                     stats: Callable[[DataFrame], DataFrame] = ad_day_request_stats) -> StreamingQuery:
    """Write the statistics of each arriving batch of closed daily files and stop when caught up.

    A day's file is closed when it arrives, so a batch holds whole days and their exact
    distinct users; a replayed batch overwrites its own folder.
    """
    def save(batch: DataFrame, number: int) -> None:
        write_stage(stats(file_day_label(batch)), f"{out}/batch={number}")

    return (log.writeStream.foreachBatch(save).option("checkpointLocation", state)
            .trigger(availableNow=True).start())


def keep_daily_parts(log: DataFrame, out: str, state: str) -> StreamingQuery:
    """Write what each arriving batch adds to its days, and stop when caught up; a day may come in any number of parts.

    A batch leaves its sums per (ad, day) and its distinct users of them, in folders of
    its own, which a replayed batch overwrites. Both add up, unlike averages and counts of users.
    A part gets the day of its own latest row.
    """
    def save(batch: DataFrame, number: int) -> None:
        days = file_day_label(batch)
        write_stage(ad_day_sums(days), f"{out}/sums/batch={number}")
        write_stage(user_rows(days).distinct(), f"{out}/users/batch={number}")

    return (log.writeStream.foreachBatch(save).option("checkpointLocation", state)
            .trigger(availableNow=True).start())


def daily_stats(spark: SparkSession, out: str) -> DataFrame:
    """The statistics of all days as far as their parts have come; a filter on ``days`` reads only these."""
    parts = spark.read.parquet(f"{out}/sums").groupBy("ad_id", "days").agg(
        *[F.sum(c).alias(c) for c in ("requestion_num", *AVERAGED)])
    users = spark.read.parquet(f"{out}/users").groupBy("ad_id", "days").agg(F.countDistinct("user_id").alias("user_num"))
    return averaged(parts).join(users, ["ad_id", "days"]).select("ad_id", "days", *STAT_COLUMNS)
