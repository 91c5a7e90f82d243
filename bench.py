"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bidlens.catalog import QUERIES  # noqa: E402
from bidlens.session import build_session, drop_stages  # noqa: E402

HEADLINE = [
    "scan_daily_logs", "parse_queue", "explode_queue", "ad_day_request_stats", "label_join", "asof_settings",
    "test_request_stats", "training_set", "ad_exposure_lags", "group_exposure_median_lags", "ad_stat_lags",
    "group_stat_median_lags", "group_stat_std_lags", "exact_percentile", "percentile_scale", "quantile_bin",
    "frequency_encode", "index_encode", "assign_folds", "blend_grid", "answer_by_bid", "auc_score",
    "mic_scores", "fm_score", "diffusion_features", "kfold_oof",
    "gbt_kfold", "custom_objective_boost", "leaf_fm_kfold", "mixed_regressor_kfold", "best_first_folds", "free_line_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    picked = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["group_size"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in picked:
        start = time.time()
        try:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        finally:
            drop_stages(spark)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
