import zlib

import corpus_pipeline
import numpy as np
import pytest
from test_dedup import low
from test_jaccard import shingles
from test_quality import brute as quality

from bidlens.llm.secret_scan import redact_text, scan_text
from bidlens.llm.tokens import encoder


def by_hand(docs):
    """Documents left by the first four stages, worked out row by row; ``docs`` are (doc_id, text) in table order."""
    docs = [(i, t) for i, t in docs if quality(t)[6]]
    last = {}
    for i, t in docs:
        last[low(t)] = max(last.get(low(t), i), i)
    docs = [(i, t) for i, t in docs if last[low(t)] == i]
    sets = [shingles(t, 5) for _, t in docs]
    head = list(range(len(docs)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                head[b] = a
    docs = [d for i, d in enumerate(docs) if find(i) == i]
    return [(i, redact_text(t, scan_text(t))) for i, t in docs]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Short documents of the smallest table and near copies of some, as one file."""
    target = tmp_path_factory.mktemp("given")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 900")
    rows = docs.collect()
    extra = [(1000 + r.doc_id, r.text + " tail", r.lang, r.source, r.n_chars + 5) for r in rows if r.doc_id % 3 == 0]
    extra += [(2000 + r.doc_id, r.text.upper(), r.lang, r.source, r.n_chars) for r in rows if r.doc_id % 4 == 0]
    extra += [(3000, "Word " * 3 + " ".join(f"k{i}" for i in range(40)) + " password=abc123xyz", "en", "s", 1)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).coalesce(1).write.parquet(f"{target}/documents.parquet")
    return str(target)


def test_run_equals_the_stages_by_hand(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    want = by_hand([(r.doc_id, r.text) for r in table.collect()])
    rows = corpus_pipeline.run(spark, folder).collect()
    pieces = {}
    for r in sorted(rows, key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).append(r)
    assert sorted(pieces) == sorted(i for i, _ in want)
    assert any("[SECRET]" in t for _, t in want) and len(want) < table.count()
    tokenizer = encoder().tokenizer
    for i, text in want:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert sum(r.length for r in pieces[i]) == pieces[i][0].doc_tokens == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in pieces[i])


def test_stages_return_documents(spark, make_docs):
    docs = make_docs([(1, None), (1, None), (None, " ".join(f"w{i}" for i in range(50)))]).coalesce(1)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").schema == docs.schema
        assert stage(spark, docs.limit(0), "").count() == 0
