"""Typed readers of the headerless input files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens import schemas
from bidlens.functions.scalar import epoch_local, safe_time, sentinel_null

# Day stamp in the path of a daily log, whether a file or a folder of parts.
DAY_STAMP = r"(?:track_log_|day_file=)(\d{8})"
FIRST_LOG_DAY, LAST_LOG_DAY = dt.date(2019, 4, 10), dt.date(2019, 4, 22)


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Headerless tab-separated text, typed by position; a malformed value raises."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("sep", "\t").option("mode", "FAILFAST").csv(paths)


def require_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Raise on a null in ``cols`` while the rows stream by; no extra pass."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"missing value in {c}")).cast(df.schema[c].dataType))
        for c in cols})


def scan_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_tsv(spark, path, schemas.TRACK_LOG)


def daily_paths(root: str, first: dt.date = FIRST_LOG_DAY, last: dt.date = LAST_LOG_DAY,
                name: str = "track_log_{:%Y%m%d}.out") -> list[str]:
    """Paths of the daily logs from ``first`` to ``last``, both included."""
    days = (last - first).days + 1
    return [f"{root}/" + name.format(first + dt.timedelta(days=i)) for i in range(days)]


def scan_daily_logs(spark: SparkSession, paths: Sequence[str], stamp: str = DAY_STAMP) -> DataFrame:
    """All daily logs in one scan, with ``file`` telling the day stamp of the source file."""
    log = scan_log(spark, paths)
    return (log.withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), stamp, 1))
            .withColumn("exposure_time", epoch_local("exposure_epoch")).drop("exposure_epoch"))


def clean_static(static: DataFrame) -> DataFrame:
    """Creation time from epoch seconds, -1 meaning unknown."""
    return static.withColumn("create_time", epoch_local(sentinel_null("create_time")))


def scan_static(spark: SparkSession, path: str) -> DataFrame:
    """Static ad attributes; every column must be filled."""
    raw = read_tsv(spark, path, schemas.AD_STATIC)
    return clean_static(require_values(raw, raw.columns))


def scan_operations(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.AD_OPERATION).withColumn("time", safe_time("time"))


def scan_test_sample(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.TEST_SAMPLE)


def scan_test_select(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.TEST_SELECT)


def read_stage(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stage table; types come from the file, partition columns from ``schema``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
