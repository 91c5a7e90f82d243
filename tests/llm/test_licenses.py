import random
import re

import pytest

from bidlens.llm.licenses import TEMPLATES, Template, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text):
    words = words_of(text)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_phrases_equal_brute_force(make_docs):
    draw = random.Random(6)
    parts = ["cc", "BY", "by", "CC-BY", "General", "public License", "license", "all rights", "RESERVED", "é", "x", "cc@by", ".", "\n"]
    docs = [(i, draw.choice((" ", "-", ", ")).join(draw.choices(parts, k=draw.randrange(25)))) for i in range(300)]
    docs += [(None, None), (1, docs[1][1]), (2, ""), (3, "..."), (4, "cc by " * 30000), (5, "ſ cc by \x00cc\x7fby"), (6, "by")]
    rows = scan(make_docs(docs)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in sorted((str(i), *brute(t)) for i, t in docs)]
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in rows if r.base_labels)
    assert all(r.score == 1.0 for r in rows if r.n_base)


@pytest.mark.parametrize("text, labels", [
    ("... Released under the MIT License.", "mit"), ("released under the mit licence", ""),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"), ("the mit license was under review", ""),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining one copy of this software and the "
     "associated documentation files", "mit"),
    ("software copy obtaining person any to charge of free granted hereby is permission", ""),
    ("Licensed under the Apache License, Version 2.0 (the text). Licensed under the Apache License, Version 2.0", "apache-2.0"),
])
def test_changed_templates(make_docs, text, labels):
    row = scan(make_docs([(1, f"a word before {text} and after")])).first()
    assert row.labels == labels and 0 <= row.score <= 1


def test_own_templates_and_no_rows(make_docs):
    docs = make_docs([(1, "my own words here")])
    assert scan(docs, [Template("own", "own words", True)]).first().labels == "own"
    assert scan(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        scan(docs, [*TEMPLATES, Template("x", "one")])


MIT = "Released under the MIT License"


@pytest.mark.parametrize("text, labels, score", [
    *[(f"{MIT}. " * n, "mit", 1.0) for n in (1, 2, 3, 4, 7, 500)],
    *[("Released under the v the MIT License\n" * n, "mit", 1.0) for n in (1, 2, 3, 9)],
    ("Released under the v w x y the MIT License", "mit", 1.0),
    *[("released under the " * n, "", 0.0) for n in (2, 3, 9)],
    *[("MIT license released under the " * n, "mit" if n > 1 else "", float(n > 1)) for n in (1, 2, 5)],
    (f"{MIT} " * 3 + "Licensed under CC BY-NC 4.0 " * 3, "cc-by,cc-by-nc-4.0,mit", 1.0),
])
def test_copies_in_a_row(make_docs, text, labels, score):
    row = scan(make_docs([(1, text)])).first()
    assert (row.labels, row.score) == (labels, score)


@pytest.mark.parametrize("words", [2, 3, 4, 5, 6])
def test_short_own_templates_in_a_row(make_docs, words):
    phrase = " ".join(f"w{i}" for i in range(words))
    docs = [(n, f"{phrase} " * n) for n in range(1, 8)] + [(8, " ".join(phrase.split()[::-1]))]
    rows = scan(make_docs(docs), [Template("own", phrase)]).collect()
    assert {r.doc_id: r.labels for r in rows} == {n: "own" if n < 8 else "" for n in range(1, 9)}
