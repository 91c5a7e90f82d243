import random
import re

import pyarrow as pa
import pytest

from bidlens.llm.quality import MAX_COVERED, MAX_LONGEST, MAX_REPEAT_PERCENT, assess, keep_good, measures
from bidlens.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = {}
    for i in range(n - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    marked = {i + j for starts in windows.values() if len(starts) > 1 for i in starts for j in range(8)}
    longest = 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = n < 20 or 100 * len(marked) > 30 * n
    longest = longest if longest >= 8 else 0
    kept = not failed and len(marked) / max(n, 1) <= MAX_COVERED and longest <= MAX_LONGEST
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked),
            failed, kept, longest)


def texts(seed, count):
    draw = random.Random(seed)
    out = []
    for _ in range(count):
        vocabulary = [draw.choice(["a", "bé", "Z#", "中", "x<y>"]) + str(k) for k in range(draw.choice((1, 2, 5, 400)))]
        parts = []
        for _ in range(draw.randrange(1, 6)):
            line = " ".join(draw.choices(vocabulary, k=draw.choice((0, 3, 12, 30))))
            parts += [line] * draw.choice((1, 1, 1, 2, 3))
        draw.shuffle(parts)
        out.append(draw.choice(("\n", "\n\n", " \n", " ")).join(parts))
    return out


@pytest.mark.parametrize("limit", [50, 1 << 20])
def test_measures_equal_brute_force(limit):
    rows = [None, "", "\n", " \n \n", "a", "\n\na\na\nb", *texts(5, 250)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "longest_repeat")
    for piece in slices(pa.array(rows), limit):
        found = measures(piece)
        for i in range(piece.size):
            assert tuple(found[k][i] for k in names) == brute(rows[piece.first + i]), rows[piece.first + i]


def test_covered_limit_is_the_base_limit_and_the_longest_repeat_adds_to_it():
    assert all((c / n > MAX_COVERED) == (100 * c > MAX_REPEAT_PERCENT * n) for n in range(1, 1500) for c in range(n + 1))
    long, rest = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 101), ("b", 600)))
    found = measures(next(slices(pa.array([f"{long} {rest} {long}"]))))
    assert not found["base_failed"][0] and found["covered_share"][0] < MAX_COVERED and not found["kept"][0]


def test_whole_frames(make_docs):
    clean = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(1, clean), (1, clean), (None, None), (3, "too short"), (4, f"{clean} {clean}"), (5, "é " * 200000)])
    rows = {(r.doc_id, r.n_words): r.kept for r in assess(docs).collect()}
    assert rows == {(1, 60): True, (None, 0): False, (3, 2): False, (4, 120): False, (5, 200000): False}
    left = keep_good(docs)
    assert left.schema == docs.schema and [r.doc_id for r in left.collect()] == [1, 1]
    assert assess(make_docs([])).collect() == [] and keep_good(make_docs([])).collect() == []
