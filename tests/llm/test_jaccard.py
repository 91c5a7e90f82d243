import random
import re

import numpy as np
import pyarrow as pa
import pytest

from bidlens.llm import jaccard
from bidlens.llm.graph import components
from bidlens.llm.jaccard import (_sets_of, _values_of, dealt_by_set, dealt_by_value, dealt_shingles, jaccard_components,
                                 keep_one_of_each, linked, part_of_sets, part_of_values, set_hashes, size_bands)
from bidlens.llm.words import shingle_sets, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(docs, k, num, den):
    sets = [shingles(t, k) for _, t in docs]
    reach = list(range(len(docs)))
    links = [0] * len(docs)

    def find(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                reach[find(i)] = find(j)
    lowest = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            lowest[find(i)] = min(lowest.get(find(i), name), name)
    return sorted((str(n), len(sets[i]), str(lowest.get(find(i))), links[i]) for i, (n, _) in enumerate(docs))


def near_copies(seed, clusters, size, length, vocabulary=5000):
    """Documents in clusters around a base text, each with some words changed, dropped or added."""
    draw = random.Random(seed)
    docs = []
    for _ in range(clusters):
        base = [f"w{draw.randrange(vocabulary)}" for _ in range(draw.choice(length))]
        for _ in range(draw.randrange(1, size)):
            words = list(base)
            for _ in range(draw.choice((0, 1, 1, 2, 3, 6))):
                at = draw.randrange(len(words) + 1)
                words[at:at + draw.randrange(2)] = [f"x{draw.randrange(10**6)}"] * draw.randrange(2)
            docs.append((len(docs) + 1, " ".join(words).title() if draw.random() < 0.3 else " ".join(words)))
    return docs


ODD = [(None, None), (None, "a b"), (900, ""), (901, " \n"), (902, "A B"), (903, "a b"), (904, "a b c"), (905, "a  b\nc"), (906, "one"),
       (907, "ſ K"), (907, "ſ k"), (908, "x " * 5000)]


def frame(spark, docs):
    rows = [(i, t, "own", "own", "own") for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, set_id string, family string").repartition(3).cache()


@pytest.mark.parametrize("k, num, den, limit, fanout", [
    (3, 90, 100, None, 1024), (3, 90, 100, 300, 4), (5, 80, 100, None, 5), (5, 80, 100, 500, 1024), (1, 50, 100, 300, 3)])
def test_equals_brute_force(spark, monkeypatch, k, num, den, limit, fanout):
    monkeypatch.setattr(jaccard, "FANOUT", fanout)
    monkeypatch.setattr(jaccard, "MIN_WEIGHT", 8)
    monkeypatch.setattr(jaccard, "LOCAL_FREQUENT", 4)
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 6 if limit else 1000)
    docs = near_copies(k, 12, 9, (2, 4, 9, 30, 120)) + near_copies(7, 1, 60, (60,)) + ODD
    docs = [(i if i is None or i >= 900 else n, t) for n, (i, t) in enumerate(docs)]
    found = jaccard_components(frame(spark, docs), k, num, den, limit or jaccard.GROUP_TOKENS).collect()
    got = sorted((str(r.id), r.n_shingles, str(r.component_id), r.n_links) for r in found)
    assert got == brute(docs, k, num, den)


def first_ones(doc, values, size, frequent, num, den):
    """The first shingles of every set in the one order of all shingles."""
    _, _, need, _ = dealt_shingles(doc, values, size, frequent, num, den)
    share = 2 * (den - num) * 2**32 // den
    having = dict(zip(*np.unique(values, return_counts=True)))

    def place(v):
        if v in frequent:
            return (2, 0, v)
        return (0, having[v], v) if int(v) >> 32 < share else (1, 0, v)

    return [set(sorted(values[doc == i].tolist(), key=lambda v: place(np.uint64(v)))[:need[i]]) for i in range(size)]


@pytest.mark.parametrize("num, den, k, often", [(90, 100, 3, 10**9), (80, 100, 5, 3), (50, 100, 2, 2), (80, 100, 1, 5)])
def test_first_shingles_of_linked_sets_meet(num, den, k, often):
    docs = near_copies(num, 40, 6, (1, 3, 6, 12, 40, 200), 300)
    piece = next(slices(pa.array([t for _, t in docs]), 1 << 30))
    doc, values = shingle_sets(piece, k)
    value, count = np.unique(values, return_counts=True)
    frequent = value[count >= often]
    firsts = first_ones(doc, values, piece.size, frequent, num, den)
    sets = [values[doc == i] for i in range(piece.size)]
    links = linked(sets, num, den)
    want = [[len(np.intersect1d(a, b)) * den >= num * len(np.union1d(a, b)) and i != j for j, b in enumerate(sets)]
            for i, a in enumerate(sets)]
    assert links.tolist() == want
    counted, last, need, _ = dealt_shingles(doc, values, piece.size, frequent, num, den)
    for i in range(piece.size):
        assert firsts[i] <= set(values[(doc == i) & (counted | last)].tolist())
    for i, j in zip(*np.nonzero(links)):
        assert firsts[i] & firsts[j] or not len(sets[i])
    ids, _ = set_hashes(doc, values, piece.size)
    assert all((ids[i] == ids[j]) == (sets[i].tolist() == sets[j].tolist()) for i in range(40) for j in range(40))


def test_bands_hold_all_partners():
    for num, den in ((90, 100), (80, 100), (99, 100), (50, 100)):
        band = np.searchsorted(size_bands(4000, num, den), np.arange(4000), "right") - 1
        for n in range(1, 3000):
            assert band[min(n * den // num, 3999)] <= band[n] + 1


def test_components_of_paths_and_hubs(spark):
    draw = random.Random(2)
    path = list(range(100, 180))
    draw.shuffle(path)
    edges = [*zip(path, path[1:]), *((0, i) for i in range(1, 50)), (7, 7), (60, 50), (60, 50), (-5, 60)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len(set(rows))
    label = {r.node: r.component for r in rows}
    assert all(label[i] == 100 for i in path) and all(label[i] == 0 for i in range(50)) and label[50] == label[60] == -5
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_stays(make_docs, spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = make_docs([(5, text), (6, text + " more"), (7, "other words entirely " + text[:50]), (8, None), (9, None), (10, text)]).coalesce(1).cache()
    left = keep_one_of_each(docs)
    assert left.schema == docs.schema and sorted(r.doc_id for r in left.collect()) == [5, 7, 8, 9]
    assert keep_one_of_each(make_docs([])).collect() == []


@pytest.mark.parametrize("parts", [64, 4096])
def test_packets_do_not_grow_with_tokens_times_parts(parts):
    draw = np.random.default_rng(parts)
    value, owner = draw.integers(0, 2**63, 200_000, dtype=np.uint64) * 2, np.sort(draw.integers(0, 2000, 200_000))
    own = np.unique(owner)
    needs, last = np.stack([own, own, own], 1), np.zeros((0, 2), np.int64)
    span = -(-parts // jaccard.FANOUT)
    runs = dealt_by_value(value, owner, needs, last, parts, span)
    assert runs.num_rows <= jaccard.FANOUT
    fine = [dealt_by_value(*_values_of(runs.slice(r, 1)), parts, 1) for r in range(runs.num_rows)]
    assert sum(x.num_rows for x in fine) <= parts
    back = [_values_of(x) for x in fine]
    assert sorted(np.concatenate([x[0] for x in back]).tolist()) == sorted(value.tolist())
    assert sorted(np.concatenate([x[2][:, 0] for x in back]).tolist()) == own.tolist()
    for packet in fine:
        for r in range(packet.num_rows):
            assert (part_of_values(_values_of(packet.slice(r, 1))[0], parts) == packet.column("part")[r].as_py()).all()
    having = np.full(len(owner), 2, np.uint32)
    runs = dealt_by_set(owner, value, having, needs, last, parts, span)
    assert runs.num_rows <= jaccard.FANOUT
    fine = [dealt_by_set(*_sets_of(runs.slice(r, 1)), parts, 1) for r in range(runs.num_rows)]
    assert sum(x.num_rows for x in fine) <= min(parts, len(own))
    for packet in fine:
        for r in range(packet.num_rows):
            sets, _, _, info, _ = _sets_of(packet.slice(r, 1))
            assert (part_of_sets(sets, parts) == packet.column("part")[r].as_py()).all() and set(sets) <= set(info[:, 0])
    few = dealt_by_value(value[:0], owner[:0], needs[:1], last, parts, span)
    assert few.num_rows == 1 and len(_values_of(few)[2]) == 1


def test_a_giant_family_of_unlinked_sets_opens_no_group(spark, monkeypatch):
    """Every text shares a passage with each of its neighbours, too little for a link."""
    monkeypatch.setattr(jaccard, "MIN_WEIGHT", 8)
    seen = []
    keep = jaccard.cut_lineage
    monkeypatch.setattr(jaccard, "cut_lineage", lambda df, label="stage": (t := keep(df, label), seen.append((label, t.cache())), t.count())[0])
    passage = [[f"p{i}w{j}" for j in range(40)] for i in range(301)]
    docs = [(i, " ".join(passage[i] + [f"own{i}x{j}" for j in range(12)] + passage[i + 1])) for i in range(300)]
    rows = jaccard_components(frame(spark, docs), 3, 90, 100, 400).collect()
    assert all(r.n_links == 0 and r.component_id == r.id for r in rows)
    tables = dict(seen)
    assert tables["members"].select("group").distinct().count() > 30
    assert tables["members"].select("group.family").distinct().count() <= 6
    assert tables["queries"].count() == 0 if "queries" in tables else tables["pairs"].count() == 0
    # A set asks only the groups of its neighbours, not all groups of its family.
    assert tables["asking"].count() <= 2 * len(docs)
