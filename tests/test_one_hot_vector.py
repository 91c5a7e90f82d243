"""One-hot vectors are read by their entries: no row may hold as many values as there are categories."""

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidlens.catalog import QUERIES
from bidlens.operators import encode


def test_entries_of_a_long_vector(spark):
    size = 2_000_000_000  # a dense form would take 16 GB
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())])
    rows = spark.createDataFrame([(1, SparseVector(size, [7, size - 1], [1.0, 0.5])), (2, SparseVector(size, [], [])), (3, None)], schema)
    found = {r["id"]: r["e"] for r in rows.select("id", encode.vector_entries("v").alias("e")).collect()}
    assert found[1]["at"] == [7, size - 1] and found[1]["values"] == [1.0, 0.5]
    assert found[2]["at"] == [] == found[2]["values"] and found[3] is None


def test_query_of_many_categories(spark, tmp_path):
    count = 60_000  # dense rows would hold 3.6e9 values in all
    orders = spark.range(count).select(F.col("id").alias("o_orderkey"), (F.lit(count) - F.col("id")).alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["one_hot_vector"](spark, str(tmp_path))
    assert "vector_to_array" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == count
    assert found.filter("place = o_orderkey and ones = 1").count() == count
