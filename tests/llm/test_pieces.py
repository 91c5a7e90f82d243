import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from bidlens.llm.pieces import MARK, PieceCoder, PieceModel, StreamingViterbi, coder, decode, encode
from bidlens.llm.tokens import tokenizer_path

PARTS = ["the", "representation", " ", "  ", "\n", "\t", "é", "中文", "x", "==", "----", "12", "ing", "\U0001f600", "q", "zx", ".", "\x00", "́"]


def texts(seed, n, parts=PARTS):
    draw = random.Random(seed)
    return ["".join(draw.choices(parts, k=draw.choice((0, 1, 4, 30, 200)))) for _ in range(n)]


def best_score(model, marked):
    best = [0] + [None] * len(marked)
    for j in range(1, len(marked) + 1):
        options = [best[i] + model.scores[marked[i:j]][0] for i in range(max(0, j - model.longest), j) if marked[i:j] in model.scores]
        if marked[j - 1] not in model.scores:
            options.append(best[j - 1] + model.unknown_score)
        best[j] = max(options)
    return best[-1]


def score_of(model, ids):
    by_id = {i: s for s, i in model.scores.values()}
    total, raw = 0, b""
    back = {i: b for b, i in enumerate(model.bytes)}
    for i in [*ids, None]:
        if i in back:
            raw += bytes([back[i]])
            continue
        total += model.unknown_score * len(raw.decode())
        raw = b""
        if i is not None:
            total += by_id[i]
    return total


def marked(text):
    return (MARK + text.replace(" ", MARK)) if text else ""


@pytest.fixture(scope="module")
def model():
    return PieceModel()


def test_stream_is_best_whatever_the_feeding(model):
    draw = random.Random(1)
    for text in texts(2, 60):
        whole = StreamingViterbi(model)
        ids = whole.feed(marked(text)) + whole.finish()
        assert score_of(model, ids) == best_score(model, marked(text))
        bits, rest = StreamingViterbi(model), marked(text)
        got = []
        while rest:
            k = draw.randrange(1, 40)
            got += bits.feed(rest[:k])
            rest = rest[k:]
        assert got + bits.finish() == ids


def test_window_stays_bounded(model):
    stream = StreamingViterbi(model)
    n = sum(len(stream.feed("representationofthe" * 50)) for _ in range(200)) + len(stream.finish())
    assert n > 5000 and stream.widest <= 12 * model.longest


def test_same_ids_as_the_library_s_viterbi():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    # The library adds scores in single precision; the whitespace runs' huge penalties would swallow the others.
    for p in proto.pieces:
        p.score = max(p.score, -40000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    own = coder()
    cases = [t for t in texts(3, 400, ["the", "ing", "tion", "a", "b", " ", "re", "é", "Zu", "k", "-", "ou"]) if "  " not in t and len(t) < 150]
    ids, borders = own.encode(pa.array(cases, pa.string()))
    for i, t in enumerate(cases):
        assert ids[borders[i]:borders[i + 1]].tolist() == library.encode(t), t


def test_parts_equal_one_stream_and_round_trip(model, monkeypatch):
    cases = [None, "", " ", "  a", "a ", *texts(4, 200), "x" * 3000]
    own = PieceCoder()
    ids, borders = own.encode(pa.array(cases, pa.string()))
    for i, t in enumerate(cases):
        stream = StreamingViterbi(model)
        assert ids[borders[i]:borders[i + 1]].tolist() == stream.feed(marked(t or "")) + stream.finish(), t
    assert own.decode(ids, borders) == [t or "" for t in cases]
    monkeypatch.setattr("bidlens.llm.pieces.MEMO_PARTS", 10)
    small = PieceCoder()
    again, same = small.encode(pa.array(cases, pa.string()))
    assert (again == ids).all() and (same == borders).all()


def test_frames(make_docs):
    docs = make_docs([(1, "the cat"), (None, None), (2, ""), (2, "a▁b"), (3, "the cat")])
    coded = encode(docs)
    rows = decode(coded).collect()
    assert coded.columns == [*docs.columns, "ids", "ids_crc32"]
    assert [r.decoded for r in rows] == ["the cat", "", "", "a b", "the cat"]
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert decode(encode(make_docs([]))).collect() == []
    odd = docs.sparkSession.createDataFrame([([5, 99999999, 130],), (None,)], "ids array<int>")
    assert [r.decoded for r in decode(odd).collect()] == ["\x02 ⁇ \x7f", ""]
