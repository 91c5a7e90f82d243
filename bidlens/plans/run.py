"""The whole job, from the raw files to the submission.

    spark-submit bidlens/plans/run.py RAW_FOLDER OUT_FOLDER
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from bidlens.operators.days import file_day_label
from bidlens.operators.queue import parse_queue
from bidlens.plans.feature_tables import feature_tables
from bidlens.plans.forecast import ForecastParams, forecast
from bidlens.plans.training_set import exposure_table, require_unique, test_set, training_set
from bidlens.session import build_session, drop_stages
from bidlens.sources import readers, writers


# Names of the input files.
STATIC_FILE, OPERATION_FILE = "total_data/map_ad_static.out", "total_data/final_map_bid_opt.out"
TEST_SAMPLE_FILE = "BTest/Btest_sample_bid.out"
TEST_SELECT_FILE = "BTest/Btest_select_request_20190424.out"
TEST_LOG_FILE = "BTest/BTest_tracklog_20190424.txt"


def run(spark: SparkSession, raw: str, out: str, params: ForecastParams | None = None) -> None:
    """Every stage is a written table in ``out``, read by the stages after it."""
    static = require_unique(readers.scan_static(spark, f"{raw}/{STATIC_FILE}"), "ad_id")
    operations = readers.scan_operations(spark, f"{raw}/{OPERATION_FILE}")
    paths = readers.daily_paths(f"{raw}/total_data/track_log")
    # The text is parsed once; winners, users and statistics then read only their fields.
    writers.write_stage(parse_queue(readers.scan_daily_logs(spark, paths)), f"{out}/log", partition="file")
    log = file_day_label(readers.read_stage(spark, f"{out}/log"))

    writers.write_stage(exposure_table(log), f"{out}/exposure")
    exposure = readers.read_stage(spark, f"{out}/exposure")
    writers.write_stage(training_set(log, exposure, static, operations), f"{out}/trainset")
    tests = test_set(readers.scan_test_sample(spark, f"{raw}/{TEST_SAMPLE_FILE}"),
                     readers.scan_test_select(spark, f"{raw}/{TEST_SELECT_FILE}"),
                     readers.scan_log(spark, f"{raw}/{TEST_LOG_FILE}"), static)
    writers.write_stage(tests, f"{out}/testset", partition=None)

    tables = feature_tables(readers.read_stage(spark, f"{out}/trainset"),
                            readers.read_stage(spark, f"{out}/testset"), exposure, static)
    for name, table in zip(("train", "valid", "test"), tables):
        writers.write_stage(table, f"{out}/{name}", partition=None if name == "test" else "days")

    def save(name: str, predictions: DataFrame) -> DataFrame:
        writers.write_predictions(predictions, f"{out}/predictions/{name}")
        return readers.read_stage(spark, f"{out}/predictions/{name}")

    found = forecast(*[readers.read_stage(spark, f"{out}/{n}") for n in ("train", "valid", "test")], params, save)
    writers.write_stage(found.scores, f"{out}/scores", partition=None)
    writers.write_submission(found.answer, f"{out}/submission")
    drop_stages(spark)


if __name__ == "__main__":
    run(build_session("bidlens"), *sys.argv[1:3])
