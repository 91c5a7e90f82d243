import pytest
from pyspark.sql import functions as F

from bidlens.operators.queue import ad_day_request_stats
from bidlens.streaming.daily import daily_stats, keep_daily_parts, stream_logs

QUEUES = [(1, 1, "5,0,0.1,1,10,0,0;7,0,0.2,2,20,1,1"), (2, 2, "7,0,0.3,3,30,0,1;7,0,0.1,1,5,0,0"), (3, 1, "5,0,0.1,1,-10,0,1"),
          (4, 1, "7,0,0.4,4,40,0,1"), (5, 3, "7,0,0.4,4,40,1,0;5,0,0.5,1,7,0,1;9,0,0.1,1,1,0,0")]


def test_days_in_parts_equal_whole_days(spark, tmp_path):
    def put(name, rows, at=100):
        lines = [f"{r}\t{1554825600 + at}\t{u}\t1\t{q}" for r, u, q in rows]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

    def catch_up():
        keep_daily_parts(stream_logs(spark, str(tmp_path / "in"), r"(2019\d{4})"), str(tmp_path / "out"),
                         str(tmp_path / "state")).awaitTermination()

    put("track_log_20190410.out", QUEUES[:2])
    catch_up()
    put("track_log_20190410.late.out", QUEUES[2:])
    put("track_log_20190411.out", QUEUES[1:3], 100 + 86400)
    catch_up()
    put("track_log_20190411.late.out", QUEUES[:1], 100 + 86400)
    catch_up()
    got = daily_stats(spark, str(tmp_path / "out"))
    log = spark.createDataFrame(
        [(r, u, q, "2019-04-11") for r, u, q in QUEUES] + [(r, u, q, "2019-04-12") for r, u, q in QUEUES[:3]],
        "request_id int, user_id int, ad_info string, day string")
    want = ad_day_request_stats(log.withColumn("days", F.col("day").cast("date")))
    assert got.columns == want.columns
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])
    rows, expected = order(got), order(want)
    assert [r[:4] for r in rows] == [r[:4] for r in expected] and len(rows) == 5
    assert all(a[2:] == pytest.approx(b[2:]) for a, b in zip(rows, expected))
    assert spark.read.parquet(f"{tmp_path}/out/sums").filter((F.col("ad_id") == 7)).count() == 4
