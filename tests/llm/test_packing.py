import itertools
import random
import zlib

import numpy as np
import pytest

from bidlens.llm import packing
from bidlens.llm.packing import best_windows, cut_positions, pack
from bidlens.llm.tokens import encoder

WORDS = ["Alpha", "beta", "it's", "x1y22", "Éa", "ÀÉß×÷", "don't!'s", "<|endoftext|>", "ΑΣ", "中文", "áb",
         "''re", "3.14", "end.", "why?", "\x85z", "#"]


def texts(seed, n):
    draw = random.Random(seed)
    return [" \n\t"[draw.randrange(3)].join(draw.choices(WORDS, k=draw.choice((0, 1, 5, 40, 300)))) for _ in range(n)]


def check(rows, docs, window):
    tokenizer = encoder().tokenizer
    want = sorted((i if i is not None else -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in docs)
    parts = {}
    for r in rows:
        parts.setdefault((r.doc_id if r.doc_id is not None else -1), []).append(r)
    got = []
    for key, pieces in parts.items():
        pieces.sort(key=lambda r: (r.sequence_id, r.offset))
        whole = []
        for r in pieces:
            if r.start == 0 and whole:
                got.append((key, whole))
                whole = []
            assert r.start == len(whole) and r.length == len(r.ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            whole = whole + r.ids
            assert len(whole) <= r.doc_tokens
        got.append((key, whole))
    assert sorted(got) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length, total in sorted(pieces):
            assert offset == at
            at += length
        assert at == total <= window


@pytest.mark.parametrize("window", [16, 2048])
def test_every_id_in_one_piece(make_docs, monkeypatch, window):
    monkeypatch.setattr(packing, "STRETCH", 3000)
    docs = [*enumerate(texts(1, 60)), (7, "again"), (7, "again"), (None, "no id"), (100, None), (101, ""), (102, " \n")]
    rows = pack(make_docs(docs).coalesce(2), window, with_ids=True).collect()
    check(rows, docs, window)
    assert pack(make_docs([])).collect() == []
    assert [tuple(r)[:5] for r in pack(make_docs([(5, None)])).collect()] == [(5, 0, 1, zlib.crc32(b"\x01\0\0\0"), 1)]


def test_windows_are_the_cheapest():
    draw = random.Random(3)
    for _ in range(60):
        cuts = np.array([0, *sorted(draw.sample(range(1, 40), 9)), 40])
        if np.diff(cuts).max() > 16:
            continue
        penalty = np.array([0, *[draw.choice((0, 1, 5)) for _ in range(9)], 0])

        def price(path):
            size = np.diff(cuts[path])
            if size.max() > 16:
                return 10**6
            padding = np.where((size & (size - 1)) == 0, 0, 16 - size).sum()
            return padding + sum(penalty[i] + packing.PER_WINDOW for i in path[1:])

        paths = [[0, *inner, 10] for k in range(10) for inner in itertools.combinations(range(1, 10), k)]
        best = np.searchsorted(cuts, best_windows(cuts, penalty, 16)).tolist()
        assert price(best) == min(map(price, paths))


def test_little_padding(spark):
    rows = pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)).select(
        "sequence_id", "sequence_tokens").distinct().collect()
    lengths = [r.sequence_tokens for r in rows]
    padding = sum(2048 - n for n in lengths if n & (n - 1))
    assert padding < 0.02 * sum(lengths)


def test_cuts_close_every_gap():
    ids = np.zeros(1000, np.uint32)
    cuts, _ = cut_positions(ids, np.array([1000]), np.zeros(5, bool), False)
    assert np.diff(cuts).max() <= packing.FORCED


def test_every_sentence_end_is_a_cut():
    draw = np.random.default_rng(5)
    closing = np.array([False, False, True])
    ids = np.where(draw.random(5000) < 0.2, 2, 0)
    ends = np.array([1000, 1003, 5000])
    ids[ends - 1] = 1
    cuts, penalty = cut_positions(ids, ends, closing, False, 16)
    price = dict(zip(cuts.tolist(), penalty.tolist()))
    assert all(price[i + 1] == packing.SENTENCE_PENALTY for i in np.flatnonzero(ids == 2).tolist())
    assert all(price[i] == 0 for i in ends.tolist())
    # Sentence ends at 9 and 11: the second leaves exactly a window behind it.
    ids = np.array([0] * 8 + [2, 0, 2] + [0] * 16)
    cuts, penalty = cut_positions(ids, np.array([27]), closing, False, 16)
    assert cuts.tolist() == [0, 9, 11, 27] and best_windows(cuts, penalty, 16).tolist() == [0, 11, 27]


def test_workers_get_the_package(tmp_path):
    """A session whose workers can't find the repository on their own path."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (f"import sys; sys.path.insert(0, {repo!r})\nfrom bidlens.session import build_session\n"
            "from bidlens.llm.packing import pack\nspark = build_session('t', 'local[2]')\n"
            "print('rows', pack(spark.createDataFrame([(1, 'a b')], 'doc_id long, text string')).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize(("window", "stretch"), [(64, 1), (1 << 16, 1 << 19)])
def test_windows_wider_than_a_stretch(make_docs, monkeypatch, window, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    count = 30 if window < 1000 else 120
    docs = [(i, "word. " * (40 * window // 64 if i % 2 else 3)) for i in range(count)]
    rows = pack(make_docs(docs).coalesce(1), window, with_ids=window < 1000).collect()
    if window < 1000:
        check(rows, docs, window)
    total = sum(r.length for r in rows)
    assert total == sum(2 * t.count("word") + 1 for _, t in docs) and max(r.offset + r.length for r in rows) <= window
    sizes = {r.sequence_id: r.sequence_tokens for r in rows}.values()
    assert sum(window - n for n in sizes if n & (n - 1)) < 0.1 * total
