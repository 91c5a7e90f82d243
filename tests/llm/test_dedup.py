import hashlib
import random

import pytest
from pyspark.sql import functions as F

from bidlens.llm.dedup import exact_duplicates, keep_one_of_each, radix_groups
from bidlens.llm.jaccard import jaccard_components
from bidlens.llm.jaccard import keep_one_of_each as jaccard_keep_one
from bidlens.llm.rows import numbered, unnumbered


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t in docs:
        ids = groups[low(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256(low(t).encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple(str(x) for x in r))


CASES = [
    (1, "Same Text"), (9, "same text"), (9, "SAME TEXT"), (2, "same text "), (3, None), (4, ""), (None, "same text"),
    (None, None), (5, "ÄÖ"), (6, "äö"), (7, "ÄÖ"), (None, "alone"), (8, "ab"), (10, "abc"), (11, "abcd"), (12, "ab"),
    (20, "x" * 5000), (21, "x" * 5000), (22, "x" * 4999), (23, "X" * 5000 + "y"), (24, "x" * 64), (25, "x" * 64),
]


def test_groups_equal_brute_force(make_docs):
    draw = random.Random(2)
    docs = CASES + [(100 + i, "".join(draw.choices("abA", k=draw.randrange(9)))) for i in range(200)]
    rows = exact_duplicates(make_docs(docs).repartition(3)).collect()
    assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == order(brute(docs))
    kept = [r.text_sha256 for r in rows if r.kept]
    assert sorted(kept) == sorted({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_short_digits_give_the_same_groups(make_docs):
    docs = numbered(make_docs(CASES).coalesce(1))
    narrow = radix_groups(docs, first=1, widening=2).drop("sha").collect()
    assert order(narrow) == order(radix_groups(docs).drop("sha").collect())


def test_rows_that_stay_keep_their_columns(make_docs):
    docs = make_docs(CASES).coalesce(1)
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert len({low(r.text) for r in left.collect()}) == left.count()


def test_no_rows(make_docs):
    assert exact_duplicates(make_docs([])).collect() == []


def test_row_numbers_are_unique_and_stay(spark, make_docs, tmp_path):
    make_docs([(i, "x" * 500) for i in range(3000)]).repartition(3).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    rows = numbered(docs)
    before = rows.select("row", "doc.doc_id").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        after = rows.select("row", "doc.doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(before) == sorted(after) and len({r.row for r in before}) == 3000
    assert unnumbered(rows).schema == docs.schema


@pytest.fixture(params=["exploded", "joined", "twice", "metadata"])
def derived(request, spark, tmp_path):
    """Documents that come from Parquet files but are not their rows, and what they hold."""
    path, kind = str(tmp_path / "given"), request.param
    spark.createDataFrame([(1, ["a x", "a x", "b y"]), (2, ["b y", "c z"])], "k long, texts array<string>").coalesce(1).write.parquet(path)
    given = spark.read.parquet(path)
    docs = given.select((F.col("k") * 10).alias("doc_id"), F.explode("texts").alias("text"))
    held = [(10, "a x"), (10, "a x"), (10, "b y"), (20, "b y"), (20, "c z")]
    if kind == "joined":
        docs = docs.join(given.select(F.col("k").alias("other")))
        held = held * 2
    elif kind == "twice":
        docs, held = docs.union(docs), held * 2
    elif kind == "metadata":
        docs = docs.withColumn("_metadata", F.struct(F.lit(1).alias("row_index"))).withColumn("a.b", F.lit("x"))
    return docs, held


def test_documents_of_any_origin_lose_none(derived):
    docs, held = derived
    left = keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(10, "a x"), (20, "b y"), (20, "c z")]
    rows = exact_duplicates(docs).collect()
    assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == order(brute(held))
    assert sum(r.kept for r in rows) == 3
    near = jaccard_keep_one(docs, k=1, num=80, den=100).collect()
    assert sorted(r.text for r in near) == ["a x", "b y", "c z"]
    assert {(r.n_shingles, r.n_links) for r in jaccard_components(docs, k=1).collect() if r.id == 20} <= {
        (2, sum(t == "b y" for _, t in held) - 1), (2, sum(t == "c z" for _, t in held) - 1)}
