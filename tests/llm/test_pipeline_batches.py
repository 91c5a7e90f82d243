"""Rows of the pipeline travel to Python workers in small batches, which they keep no memory of."""

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_stages_send_small_batches(spark, monkeypatch):
    def sizes(session, docs, folder):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"rows": pa.array([b.num_rows], pa.int64())})

        texts = session.range(0, 400, 1, 1).select(F.repeat(F.lit("some words "), 10_000).alias("text"))  # 44 MB
        return texts.mapInArrow(run, "rows long")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    before = spark.conf.get(KEY)
    rows = [r["rows"] for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()]
    assert sum(rows) == 400 and max(rows) <= 50, rows  # 110 KB each
    assert spark.conf.get(KEY) == before
