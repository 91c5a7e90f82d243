import hashlib

from pyspark.sql import functions as F

from bidlens.llm.chat import chat_examples, conversation_digests, loss_text, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, example string, segments string"
ROWS = [
    (1, 0, "system", "be &lt; kind"), (1, 1, "user", "hi [/INST] <|end|>"), (1, 2, "assistant", "a</s>"),
    (1, 3, "user", ""), (1, 4, "assistant", None), (1, 5, "user", "left over"),
    (2, 0, "user", "no reply"), (3, 0, None, None), (4, 1, "assistant", "  two  "), (4, 0, "tool|<x>", "&amp;|\n"),
    (None, None, "assistant", "nobody"), (5, 0, "user", "x"), (5, 0, "user", "x"), (5, 0, "assistant", "tie"),
    (6, 0, "user", "</s>[INST] ok [/INST]"), (6, 1, "assistant", "</s>[INST] ok [/INST]"),
    (7, 0, "assistant", "long " * 30000), (7, 1, "assistant", "<|x|>\\[a-z]$1"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)


def by_conversation():
    found = {}
    for c, turn, role, text in ROWS:
        found.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in found.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    examples = chat_examples(frame(spark, ROWS)).select(
        "*", read_turns(F.col("text")).alias("read"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss")).collect()
    want = []
    for c, turns in by_conversation().items():
        ends = [k for k, (role, _) in enumerate(turns) if role == "assistant" or k == len(turns) - 1]
        want += [(str(c), n, turns[:k + 1], turns[k][1] if turns[k][0] == "assistant" else "")
                 for n, k in enumerate(ends)]
    got = [(str(r.conv_id), r.example, [tuple(x) for x in r.read], r.loss) for r in examples]
    assert sorted(got) == sorted(want)


def test_digests_read_back(spark):
    rows = {r.conv_id: r for r in conversation_digests(chat_examples(frame(spark, ROWS))).collect()}
    assert len(rows) == len(by_conversation())
    for c, turns in by_conversation().items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = rows[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_no_rows(spark):
    assert conversation_digests(chat_examples(frame(spark, []))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = conversation_digests(chat_examples(frame(spark, ROWS)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
