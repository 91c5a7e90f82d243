import random

import pytest
import xxhash

from bidlens.llm import simhash
from bidlens.llm.simhash import chain_masks, fingerprint, hex_digits, key_masks, linked_classes, near_duplicates

SCHEMA = "doc_id long, text string, fp string, component string, first string, key string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, distance=4):
    """Component (as the set of positions) of each position."""
    low = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for a in range(len(values)):
            for b in range(len(values)):
                if (values[a] ^ values[b]).bit_count() <= distance and low[b] < low[a]:
                    low[a], changed = low[b], True
    return low


def brute(docs):
    values = [brute_fingerprint(t) for _, t in docs]
    low = brute_components(values)
    least = {}
    for (i, _), c in zip(docs, low):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, f"{v:016x}", least.get(c)) for (i, _), v, c in zip(docs, values, low)), key=str)


def answer(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, "own", "own", "own", "own") for i, t in docs], SCHEMA)
    rows = near_duplicates(frame, **options).select("doc_id", hex_digits().alias("f"), "component_id").collect()
    return sorted((tuple(r) for r in rows), key=str)


def near_copies(draw, count):
    base = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randrange(1, 4)):
            words[draw.randrange(400)] = f"x{draw.randrange(10**6)}"
        yield " ".join(words)


def test_documents_equal_brute_force(spark):
    draw = random.Random(3)
    texts = [None, "", " \t\n", "One", "one", "one two three", "ONE  two\tthree", "one two three four", "Ä b c d e", "ä b c d e",
             "a b c d " * 50, "\x0bq\x0cr\x1cs t u v", "word " * 3000]
    texts += list(near_copies(draw, 60)) + [" ".join(draw.choices("abcdef", k=6)) for _ in range(40)]
    docs = [(100 + i, t) for i, t in enumerate(texts)] + [(7, texts[20]), (100, texts[20]), (None, texts[21]), (None, "alone here")]
    assert answer(spark, docs) == brute(docs)
    assert answer(spark, docs, block=3) == brute(docs)


def test_no_rows(spark):
    assert answer(spark, []) == []


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(draw.choices(["a", "bb", "ccc", "Ddd", "  "], k=n)) for n in (0, 1, 3, 4, 5, 300, 1500)]
    for piece in (1, 7, 64):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert [fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_a_very_long_text_is_one_document():
    words = [str(i) for i in range(300_000)]
    assert fingerprint(" ".join(words)) == fingerprint("\n".join(words)) != fingerprint(" ".join(words[::-1]))


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 6])
def test_every_link_has_a_chain_within_its_budgets_and_a_key(distance):
    draw, chains, keys = random.Random(1), chain_masks(distance), key_masks(distance)
    for _ in range(3000):
        differ = sum(1 << b for b in draw.sample(range(64), draw.randrange(distance + 1)))
        within = [s for s in range(distance + 1)
                  if all((differ & int(m)).bit_count() <= n for n, m in enumerate(chains[s]))]
        assert within
        for s in within:
            assert any(start == s and not differ & bits for start, bits in keys)


@pytest.mark.parametrize(("distance", "block"), [(4, 2048), (4, 5), (2, 4), (0, 2048)])
def test_crowded_fingerprints_equal_brute_force(spark, distance, block):
    draw = random.Random(distance)
    centres = [draw.getrandbits(64) for _ in range(4)]
    values = list({draw.choice(centres) ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(7))) for _ in range(220)})
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    low = list(range(len(values)))
    at = {v: k for k, v in enumerate(values)}
    edges = [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in linked_classes(frame, distance, block).collect()]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    assert low == brute_components(values, distance)


def test_query_equals_brute_force(spark):
    from bidlens.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op13_simhash_dedup"](spark, folder).collect()
    assert sorted((tuple(r) for r in rows), key=str) == brute(docs)
