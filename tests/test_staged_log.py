"""The staged log collects a request's entries in one step, from sorted rows."""

from bidlens.catalog.tables import Tables
from bidlens.operators.queue import parse_queue
from bidlens.session import sorted_groups

FOLDER = "/root/testdata/sf0.001"
KEY = "spark.sql.execution.replaceHashWithSortAgg"


def test_entries_are_collected_once(spark):
    t = Tables(spark, FOLDER)
    before, joins = spark.conf.get(KEY), "spark.sql.autoBroadcastJoinThreshold"
    limit = spark.conf.get(joins)
    try:
        spark.conf.set(joins, "-1")  # as large tables are joined
        with sorted_groups(spark):
            plan = t.track_log(ordered=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(joins, limit)
    assert spark.conf.get(KEY) == before
    assert plan.count("SortAggregate(") == 1 and "ObjectHashAggregate" not in plan and "partial_collect_list" not in plan, plan


def test_staged_log_is_the_parsed_log(spark):
    t = Tables(spark, FOLDER)
    staged, plain = t.staged_log(), parse_queue(t.timed_log())
    assert staged.dtypes == plain.dtypes
    want = plain.collect()
    assert len(want) > 1000 and sorted(map(str, staged.collect())) == sorted(map(str, want))
