"""Exact duplicates by distributed most-significant-byte radix partitioning.

All texts start in one group. A round cuts the next digit, a run of bytes, off the
rest of every open text and splits each group by the digit's value and by whether
the text ended with it. A group of one row is closed, and so is a group whose texts
have ended: its texts have agreed byte for byte, so no digest decides. The others go
on with the bytes that follow. Digits widen eightfold per round, so a round's bytes
are read once and the number of rounds is the logarithm of the longest shared prefix.

Groups are counted with partial sums before the shuffle and only groups of several
rows are joined back, so a hot group is a skewed join that adaptive execution splits.
Every round is a written table, which a lost executor can read again.

Defined cases: a null text is empty; texts are equal when the same after lower-casing
A-Z; the largest id stays, a null id is below all, and of rows that tie on it the
one of the lowest row number stays; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.rows import numbered, unnumbered
from bidlens.session import cut_lineage, settled

FIRST_DIGIT = 64
WIDENING = 8
LARGEST_DIGIT = 1 << 20


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _split(level: DataFrame, width: int) -> DataFrame:
    """One round: rows with their group's size, its largest (id, row), and the rest of the text where it stays open."""
    size = F.octet_length("rest")
    rows = level.withColumns({"digit": F.expr(f"substring(rest, 1, {width})"), "ended": size <= width})
    cells = (rows.groupBy("cell", "digit", "ended")
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", (-F.col("row")).alias("last"))).alias("top"),
                  F.min("row").alias("next_cell"))
             .filter("n > 1"))
    joined = rows.join(cells, ["cell", "digit", "ended"], "left")
    closed = F.col("n").isNull() | F.col("ended")
    return joined.select(
        "row", "doc_id", "sha", closed.alias("closed"), F.coalesce("n", F.lit(1)).alias("group_size"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.when(F.col("n").isNull(), F.col("row")).otherwise(-F.col("top.last")).alias("keep_row"),
        F.when(~closed, F.col("next_cell")).alias("cell"),
        F.when(~closed, F.expr(f"substring(rest, {width + 1})")).alias("rest"))


def radix_groups(rows: DataFrame, first: int = FIRST_DIGIT, widening: int = WIDENING) -> DataFrame:
    """Rows (row, doc_id, sha, group_size, keep_id, keep_row) for ``rows.numbered`` documents (doc_id, text).

    ``row`` is the row's number; ``keep_row`` is that of the row which stays.
    """
    text = lower_ascii(F.col("doc.text"))
    level = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "row", "doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.lit(0).cast("long").alias("cell"),
        F.encode("text", "UTF-8").alias("rest"))
    done, width = None, first
    while True:
        stage = cut_lineage(_split(level, width), "radix")
        closed = stage.filter("closed").select("row", "doc_id", "sha", "group_size", "keep_id", "keep_row")
        done = closed if done is None else done.unionByName(closed)
        level = stage.filter("not closed").select("row", "doc_id", "sha", "cell", "rest")
        if level.isEmpty():
            return done
        width = min(width * widening, LARGEST_DIGIT)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: the id that stays, the group's size, whether this row stays, and the text's SHA-256."""
    groups = settled(docs.sparkSession, lambda: radix_groups(numbered(docs, ["doc_id", "text"])), "duplicates")
    return groups.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that equal another one which stays; all columns are kept."""
    rows = numbered(docs)
    dropped = settled(docs.sparkSession, lambda: radix_groups(rows).filter("row <> keep_row").select("row"), "dropped")
    return unnumbered(rows.join(dropped, "row", "left_anti"))
