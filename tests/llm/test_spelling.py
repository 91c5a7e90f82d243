import random
import re
import zlib
from collections import Counter

import pytest

from bidlens.llm import spelling
from bidlens.llm.spelling import FIRST, LEFT_OUT, changed_places, signatures, spelling_variants

SCHEMA = "doc_id long, text string, word string, n string, key string, form string"


def brute_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if v != w and brute_near(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def answer(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, "own", "own", "own", "own") for i, t in docs], SCHEMA)
    return sorted(tuple(r) for r in spelling_variants(frame, **options).collect())


def damaged(draw, word):
    at = draw.randrange(len(word))
    return draw.choice([word[:at] + word[at + 1:], word[:at] + draw.choice("aeiéxÿ") + word[at:],
                        word[:at] + draw.choice("aeiéxÿ") + word[at + 1:]])


def make_docs(seed, count):
    draw = random.Random(seed)
    roots = ["".join(draw.choices("aeinrst", k=draw.randrange(7, 11))) for _ in range(12)] + ["ÉCOLEécole", "aaaaaaa", "aaaaaaaa", "x" * 90]
    ids = [*range(count), None, 3]
    docs = []
    for i in ids:
        words = []
        for _ in range(40):
            word = draw.choice(roots[:draw.randrange(1, len(roots) + 1)])
            for _ in range(draw.choice([0, 0, 0, 0, 0, 0, 0, 1, 1, 2])):
                word = damaged(draw, word)
            words.append(word if draw.random() < 0.8 else word.upper())
        docs.append((i, draw.choice([" ", "-", "1", "\n"]).join(words)))
    return docs + [(1000, None), (1001, ""), (1002, "short 12 ×÷×÷×÷×÷ ×÷×÷×÷×÷"), (1002, "straße Straße"), (1003, "y" * 3000), (1004, "y" * 3000),
                   (1005, "y" * 2999), (1006, "y" * 2999 + " " + "y" * 3001)]


@pytest.mark.parametrize("block", [spelling.BLOCK_ROWS, 4])
def test_variants_equal_brute_force(spark, block):
    docs = make_docs(1, 250)
    expected = brute(docs)
    assert sum(row[1] is not None for row in expected) > 30 and sum(row[1] not in (None, row[2]) for row in expected) > 0
    assert answer(spark, docs, block=block) == expected


def test_no_rows(spark):
    assert answer(spark, []) == []


def test_query_equals_brute_force(spark):
    from bidlens.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op12_spelling_variants"](spark, folder).collect()
    counts = {r.word: r for r in rows}
    expected = brute(docs)
    assert len(counts) == len(expected)
    assert sorted(tuple(r) for r in rows) == expected


def test_near_words_share_their_first_signature():
    draw = random.Random(4)
    for _ in range(3000):
        a = "".join(draw.choices("abcé", k=draw.randrange(1, 12)))
        b = damaged(draw, a)
        if a == b:
            continue
        assert brute_near(a, b)
        keys, _ = signatures([a, b])
        shared = [number for number in range(len(LEFT_OUT)) if keys[0, number] == keys[1, number]]
        places = changed_places(*sorted((a, b), key=len))
        one, other = ((p[0] + 3 * p[1]) % spelling.PARTS for p in places)
        assert FIRST[one, other] == shared[0]
