import numpy as np
import pytest

from bidlens.llm.separators import SEPARATOR, count_tokens, document_tokens, write_tokens
from bidlens.llm.tokens import encoder


def size(text):
    return len(encoder(special=False).tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_tokenizer_s(make_docs):
    docs = [(1, "The cat, sat."), (2, None), (3, ""), (4, "<|endoftext|> inside"), (1, "The cat, sat."), (None, "é ü x"),
            *[(10 + i, "word " * i) for i in range(50)]]
    rows = document_tokens(make_docs(docs).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted((str(i), size(t)) for i, t in docs)
    assert document_tokens(make_docs([])).collect() == []


def test_documents_across_blocks_files_and_open_ends(spark, tmp_path):
    draw = np.random.default_rng(5)
    want = []
    for name, n, rate in (("a", 1000, 0.1), ("b", 1, 1.0), ("c", 500, 0.0), ("d", 0, 0), ("e", 300, 1.0), ("f", 777, 0.01)):
        ids = np.where(draw.random(n) < rate, SEPARATOR, draw.integers(0, 100, n)).astype("<u2")
        (tmp_path / f"{name}.tokens").write_bytes(ids.tobytes() + b"\1" * (name == "f"))
        start = k = 0
        for i in np.flatnonzero(ids == SEPARATOR).tolist():
            want.append((f"{name}.tokens", k, start, i - start, True))
            start, k = i + 1, k + 1
        if start < n:
            want.append((f"{name}.tokens", k, start, n - start, False))
    for block in (2, 14, 1 << 20):
        got = count_tokens(spark, str(tmp_path), block_bytes=block).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_files_hold_ids_and_separators_alone(make_docs, tmp_path):
    folder, manifest = write_tokens(make_docs([(1, "a b"), (2, "c")]).coalesce(1), str(tmp_path / "x"), width=4)
    raw = b"".join(p.read_bytes() for p in (tmp_path / "x").iterdir())
    ids = np.frombuffer(raw, "<u4")
    own = encoder(special=False).tokenizer
    assert ids.tolist() == [*own.encode("a b", add_special_tokens=False).ids, SEPARATOR,
                            *own.encode("c", add_special_tokens=False).ids, SEPARATOR]
    assert [(r.ordinal, r.doc_id) for r in manifest.orderBy("ordinal").collect()] == [(0, 1), (1, 2)]


def test_files_of_attempts_that_did_not_count_are_not_read(spark, make_docs, tmp_path):
    folder, manifest = write_tokens(make_docs([(1, "a b"), (2, "c")]).coalesce(1), str(tmp_path / "x"))
    written, = (tmp_path / "x").iterdir()
    (tmp_path / "x" / "part-000000-other.tokens").write_bytes(written.read_bytes())
    assert count_tokens(spark, folder).count() == 4
    rows = count_tokens(spark, folder, files=manifest).collect()
    assert sorted((r.file, r.ordinal, r.tokens) for r in rows) == [(written.name, 0, 2), (written.name, 1, 1)]


@pytest.mark.parametrize("options", [{"width": 1}, {"separator": 70000}, {"separator": 320}])
def test_ids_that_don_t_fit_and_separators_of_texts_are_refused(make_docs, tmp_path, options):
    with pytest.raises(Exception, match="need more than|texts can yield"):
        write_tokens(make_docs([(1, "a b")]), str(tmp_path / "x"), **options)
    write_tokens(make_docs([(1, "a b")]), str(tmp_path / "y"), separator=70000, width=4)
