"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every turn becomes a segment between control strings. Control characters inside
texts and role names are escaped as entities, so no text can look like a control
string and the original comes back exactly. Every assistant turn then becomes an
example of its own: all segments before it are its context and only its reply,
a span of code points without control strings, is trainable. Turns after the last
reply, or a conversation without one, form a last example without a trainable span,
so that the examples hold every turn.

An example holds its context in full, as the method asks, so a conversation has to
fit one row. Conversations are independent; no other group is gathered.

Defined cases: a null text or role is empty; turns are ordered by turn (null first),
then role and text, so ties and repeated rows have one order and all stay; a null
conversation id is a conversation; extra columns are not read; no rows, no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("|", "&vert;"))
USER = ("<s>[INST] ", " [/INST]")
ASSISTANT = (" ", "</s>")
OTHER = ("<|", "|>", "<|end|>")  # around the name of any other role, and after its text
_PLAIN = r"[^<\[|]*"
SEGMENT = rf"<s>\[INST\] ({_PLAIN}) \[/INST\]| ({_PLAIN})</s>|<\|({_PLAIN})\|>({_PLAIN})<\|end\|>"


def escape(text: Column) -> Column:
    for plain, entity in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def segment(role: Column, text: Column) -> Column:
    text = escape(text)
    return (F.when(role == "user", F.concat(F.lit(USER[0]), text, F.lit(USER[1])))
            .when(role == "assistant", F.concat(F.lit(ASSISTANT[0]), text, F.lit(ASSISTANT[1])))
            .otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), text, F.lit(OTHER[2]))))


def chat_examples(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text).

    Columns: conv_id, example (from 0), turns (how many it holds), text, and the
    trainable span loss_start (code points, from 0) and loss_length; loss_start is
    null in an example without reply.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                        text.alias("text"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text", segment(F.col("role"), F.col("text"))
                                                   .alias("segment"))))
    whole = rows.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.expr("transform(turns, t -> t.segment)").alias("segments"),
        F.expr("transform(turns, t -> t.role = 'assistant')").alias("replies"))
    ends = whole.select("conv_id", "segments", "replies", F.expr(
        "filter(sequence(1, size(segments)), k -> replies[k - 1] or k = size(segments))").alias("ends"))
    return (ends.select("conv_id", "segments", "replies", F.posexplode("ends").alias("example", "turns"))
            .select("conv_id", "example", "turns", F.expr("replies[turns - 1]").alias("trained"),
                    F.expr("segments[turns - 1]").alias("last"),
                    F.expr("concat_ws('', slice(segments, 1, turns))").alias("text"))
            .select("conv_id", "example", "turns", "text",
                    F.when(F.col("trained"), F.length("text") - F.length("last") + len(ASSISTANT[0])).alias("loss_start"),
                    F.when(F.col("trained"), F.length("last") - len(ASSISTANT[0]) - len(ASSISTANT[1]))
                    .otherwise(0).alias("loss_length")))


def read_turns(text: Column) -> Column:
    """The turns of an example's text, as an array of (role, text) with escapes undone."""
    segments = F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(0))

    def one(s: Column) -> Column:
        user, reply = s.startswith(USER[0]), s.startswith(ASSISTANT[0])
        body = (F.when(user, F.substring(s, F.lit(1 + len(USER[0])), F.length(s) - len("".join(USER))))
                .when(reply, F.substring(s, F.lit(1 + len(ASSISTANT[0])), F.length(s) - len("".join(ASSISTANT))))
                .otherwise(F.regexp_extract(s, SEGMENT, 4)))
        name = (F.when(user, "user").when(reply, "assistant").otherwise(unescape(F.regexp_extract(s, SEGMENT, 3))))
        return F.struct(name.alias("role"), unescape(body).alias("text"))

    return F.transform(segments, one)


def loss_text(text: Column, start: Column, length: Column) -> Column:
    """The trainable text of an example with escapes undone; empty without a reply."""
    return F.coalesce(unescape(F.substring(text, start + 1, length)), F.lit(""))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, replies and formatted length."""
    one = examples.select(
        "conv_id", "example", "turns", F.length("text").cast("long").alias("chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss"), "text")
    merged = one.groupBy("conv_id").agg(
        F.max(F.struct("example", "text")).alias("last"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"))
    return (merged.select("conv_id", "formatted_chars", read_turns(F.col("last.text")).alias("turns"),
                          F.expr("array_join(transform(losses, x -> x.loss), '')").alias("loss"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.expr("array_join(transform(turns, t -> t.role || '\n' || t.text || '\n'), '')"), 256)
                    .alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    "formatted_chars"))
