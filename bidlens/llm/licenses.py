"""License scan by diagonal voting.

Every window of two consecutive words of every text is joined to the windows of the
license templates. A match at text word p and template word t votes for the diagonal
p - t, the place where the template would start. On one diagonal the votes are
distinct template windows, so a diagonal with all of a phrase's votes is the phrase
standing there word by word. Longer templates may differ by a few words: diagonals
with enough votes that lie next to each other form a run, words put in or left out
shift a match to a neighbour. Copies that follow each other share a run, so every
stretch of neighbours in it is a span of its own, from a single diagonal up to the
longest a copy can take, and is verified by the share of the template's windows it
holds, each counted once, and by its length.

The templates are a fixed list of a few hundred windows, so they are broadcast; the
votes of a text meet in the task that read it, before anything is shuffled. Windows
are compared by 64-bit hashes of their words.

Defined cases: a null or empty text has no words; places of a phrase may overlap and
all count; repeated rows are scanned alike, each on its own; extra columns are not
read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.llm.words import ALNUM, Slice, find_words, grams, slices

GRAM = 2
MIN_COVERED = 0.8  # share of a template's windows a verified span holds
MIN_SHARE = 0.1  # share of them a diagonal needs to take part, at least two
NEIGHBOURS = 5  # words by which merged diagonals may differ from one to the next
SCHEMA = "row long, doc_id long, n_words int, pos int, gram long"


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


TEMPLATES = (
    Template("cc-by", "cc by", True), Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                    "published by the Free Software Foundation"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"), Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _whole(text: str) -> Slice:
    data = np.frombuffer(text.encode(), np.uint8)
    return Slice(0, data, np.array([0, len(data)]))


def template_windows(spark, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, at, label, base, windows): one row per window of every template."""
    rows = []
    for number, t in enumerate(templates):
        at, values = grams(find_words(_whole(t.text), ALNUM, True), GRAM)
        if not len(at):
            raise ValueError(f"a template needs at least {GRAM} words: {t.text!r}")
        rows += [(int(v), number, int(i), t.label, t.base, len(at)) for i, v in zip(at, values.view(np.int64))]
    return spark.createDataFrame(rows, "gram long, template int, at int, label string, base boolean, windows int")


def text_windows(docs: DataFrame) -> DataFrame:
    """A row without window per document, and one per window of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for piece in slices(batch.column(2)):
                words = find_words(piece, ALNUM, True)
                at, values = grams(words, GRAM)
                doc, n = words.doc[at], piece.size
                nothing = pa.nulls(len(at), pa.int64())
                own = rows[piece.first:piece.first + n]
                yield pa.RecordBatch.from_pydict({
                    "row": own, "doc_id": batch.column(1).slice(piece.first, n),
                    "n_words": pa.array(np.diff(words.firsts).astype(np.int32)),
                    "pos": pa.nulls(n, pa.int32()), "gram": pa.nulls(n, pa.int64())})
                yield pa.RecordBatch.from_pydict({
                    "row": own[doc], "doc_id": nothing, "n_words": pa.nulls(len(at), pa.int32()),
                    "pos": pa.array((at - words.firsts[doc]).astype(np.int32)), "gram": pa.array(values.view(np.int64))})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.col("text").cast("string"))
    return shipped(rows).mapInArrow(run, SCHEMA)


def diagonals(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Votes per (row, template, diagonal), and one row per document with neither."""
    windows = F.broadcast(template_windows(docs.sparkSession, templates))
    matched = text_windows(docs).join(windows, "gram", "left").filter("pos is null or at is not null")
    return matched.groupBy("row", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("at").alias("votes"),
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("label").alias("label"),
        F.max("base").alias("base"), F.max("windows").alias("windows"),
        F.collect_list(F.when(~F.col("base"), F.col("at"))).alias("held"))


def runs_of_neighbours(votes: DataFrame) -> DataFrame:
    """Neighbouring diagonals with enough votes as one run each, with its ``parts``; other rows stay as they are."""
    enough = F.col("base") | F.col("template").isNull() | (
        F.col("votes") >= F.least(F.greatest(F.lit(2), MIN_SHARE * F.col("windows")), MIN_COVERED * F.col("windows")))
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(by) <= NEIGHBOURS) & ~F.col("base")
    runs = votes.filter(enough).withColumn("starts", F.when(near, 0).otherwise(1))
    return (runs.withColumn("run", F.sum("starts").over(by))
            .groupBy("row", "template", "run")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("votes").alias("votes"),
                 F.min("first").alias("first"), F.max("label").alias("label"),
                 F.max("base").alias("base"), F.max("windows").alias("windows"),
                 F.array_sort(F.collect_list(F.struct("diagonal", "first", "last", "held"))).alias("parts")))


def best_cover(parts: Column, windows: Column) -> Column:
    """The largest share of a template's windows that a stretch of neighbouring diagonals holds, null if none is verified."""
    longest = windows / MIN_COVERED + NEIGHBOURS
    most = F.ceil(longest + windows).cast("int")  # diagonals that can meet in a span of that length

    def cover(stretch: Column) -> Column:
        length = F.array_max(stretch["last"]) - F.array_min(stretch["first"]) + 1
        share = F.size(F.array_distinct(F.flatten(stretch["held"]))) / windows
        return F.when((share >= MIN_COVERED) & length.between(MIN_COVERED * windows, longest), share)

    return F.array_max(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_max(F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts) - i + 1, most)), lambda n: cover(F.slice(parts, i, n))))))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per document (doc_id, text): places of the base phrases, their labels, all labels, and the best share covered."""
    runs = runs_of_neighbours(diagonals(docs, templates))
    phrase = F.coalesce(F.col("base") & (F.col("votes") == F.col("windows")), F.lit(False))
    covered = F.when(phrase, 1.0).when(~F.col("base"), best_cover(F.col("parts"), F.col("windows")))
    found = runs.withColumns({"phrase": phrase, "covered": covered}).withColumn("verified", F.col("covered").isNotNull())

    def names(which: str):
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col(which), F.col("label")))), ",")

    return found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"),
        F.count_if("phrase").alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("last_word"),
        names("phrase").alias("base_labels"), names("verified").alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score")).drop("row")
