"""Stage tables, prediction tables and submission files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_stage(df: DataFrame, path: str, partition: str | None = "days") -> None:
    """Overwrite a stage table, one folder per day so later reads prune.

    Rows of a day are spread over as many tasks as they came in: a large day is
    not gathered into one writer.
    """
    writer = df.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def write_predictions(df: DataFrame, path: str, key: str = "test_id", value: str = "model_predict") -> None:
    df.select(key, value).write.mode("overwrite").parquet(path)


def write_submission(df: DataFrame, path: str, key: str = "test_id", value: str = "predict_val") -> None:
    """Two comma-separated columns without a header."""
    df.select(key, value).write.mode("overwrite").option("header", False).csv(path)
