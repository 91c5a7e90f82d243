"""Token counts by scanning flat token files for end-of-document ids.

A token file is nothing but fixed-width little-endian ids, with no index. Files are
cut into blocks; each block is read once by a range read and searched for the
separator in one vector comparison, which yields the places of the documents that
end in it. What a block cannot know, how many documents ended before it and where
its first one began, comes from a prefix scan over one narrow row per block. So
neither files nor documents bound the parallelism: a document may span many blocks.

Writing: each task appends the ids of its documents and a separator after each to a
file of its own in the shared folder. The manifest of written rows names the files
of the tasks that counted; given its names, files of lost or repeated attempts are not read.
A vocabulary whose ids don't fit the width, and a separator that texts can yield, are refused.

Defined cases: a null or empty text is its separator alone; tokens after a file's last
separator form a document that is not closed; an empty file has none; odd bytes at the
end of a file are no token; repeated rows are documents of their own; extra columns are
not read; no rows give no files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.llm.tokens import encoder
from bidlens.llm.words import slices
from bidlens.session import cut_lineage, stage_path

SEPARATOR = 49407  # the end-of-text id of the word vocabulary, which plain text never gets
WIDTH = 2  # bytes per id
BLOCK_BYTES = 4 << 20
MANIFEST = "file string, ordinal long, doc_id long"


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1)


def _check(tokenizer, separator: int, width: int) -> None:
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    largest = max(separator, *vocabulary.values())
    if largest >= 256 ** width:
        raise ValueError(f"ids up to {largest} need more than {width} bytes")
    controls = tokenizer.get_added_tokens_decoder()
    if tokenizer.id_to_token(separator) is not None and not (separator in controls and controls[separator].special):
        raise ValueError(f"texts can yield the separator {separator}")


def write_tokens(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, separator: int = SEPARATOR,
                 width: int = WIDTH) -> tuple[str, DataFrame]:
    """Write the ids of ``docs`` (doc_id, text) to flat files; returns the folder and the manifest (file, ordinal, doc_id)."""
    target = _uri(folder or stage_path(docs.sparkSession, "tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        store, path = fs.FileSystem.from_uri(target)
        store.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tokens"
        coder, done = encoder(tokenizer, special=False), 0
        _check(coder.tokenizer, separator, width)
        with store.open_output_stream(f"{path}/{name}") as out:
            for batch in (b for group in ([first], batches) for b in group):
                for piece in slices(batch.column(1), 4 << 20):
                    ids, borders = coder.encode(piece)
                    sizes = np.diff(borders) + 1
                    whole = np.full(int(sizes.sum()), separator, f"<u{width}")
                    inner = np.ones(len(whole), bool)
                    inner[np.cumsum(sizes) - 1] = False
                    whole[inner] = ids
                    out.write(whole.tobytes())
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.DictionaryArray.from_arrays(np.zeros(piece.size, np.int32), [name]).cast(pa.string()),
                        "ordinal": pa.array(np.arange(done, done + piece.size)),
                        "doc_id": batch.column(0).slice(piece.first, piece.size)})
                    done += piece.size

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return target, cut_lineage(shipped(rows).mapInArrow(run, MANIFEST), "manifest")


def token_blocks(spark: SparkSession, folder: str, width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
                 files: DataFrame | None = None) -> DataFrame:
    """(file, block, start, tokens): the blocks, in tokens, of a folder's token files, all or those named by ``files`` (file)."""
    step = max(1, block_bytes // width)
    found = spark.read.format("binaryFile").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.expr(f"length div {width}").alias("size"))
    if files is not None:
        found = found.join(files.select("file").distinct(), "file", "left_semi")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(step).cast("long"))
    return (found.filter("size > 0").select("file", "size", F.posexplode(starts).alias("block", "start"))
            .select("file", "block", "start", F.least(F.lit(step), F.col("size") - F.col("start")).alias("tokens")))


def separator_places(blocks: DataFrame, folder: str, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """``blocks`` with the places (tokens from the file's start) of the separators in each."""
    target = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    raw = source.read_at(row["tokens"] * width, row["start"] * width)
                places = np.flatnonzero(np.frombuffer(raw, f"<u{width}") == separator) + row["start"]
                yield pa.RecordBatch.from_pydict({
                    **{k: [row[k]] for k in ("file",)}, "block": pa.array([row["block"]], pa.int32()),
                    "start": [row["start"]], "tokens": [row["tokens"]],
                    "places": pa.array([places], pa.list_(pa.int64()))})

    count = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    spread = blocks.select("file", F.col("block").cast("int"), F.col("start").cast("long"), F.col("tokens").cast("long"))
    return shipped(spread.repartition(4 * count, "file", "block")).mapInArrow(
        run, "file string, block int, start long, tokens long, places array<long>")


def document_sizes(places: DataFrame) -> DataFrame:
    """(file, ordinal, start, tokens, closed) of every document, from the separators of all blocks.

    ``places`` is read twice, so it should be a written table. ``tokens`` leaves the separator out.
    """
    summary = places.select("file", "block", F.size("places").alias("n"), F.expr("try_element_at(places, -1)").alias("last"),
                            (F.col("start") + F.col("tokens")).alias("end"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("documents"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"))
    inside = places.join(carried, ["file", "block"]).select(
        "file", "documents", "previous", "places", F.posexplode("places").alias("k", "place"))
    start = F.when(F.col("k") == 0, F.col("previous")).otherwise(F.expr("try_element_at(places, k)")) + 1
    closed = inside.select("file", (F.col("documents") + F.col("k")).alias("ordinal"), start.alias("start"),
                           (F.col("place") - start).alias("tokens"), F.lit(True).alias("closed"))
    tails = summary.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"),
                                        F.max("end").alias("end"))
    opened = tails.filter("end > start").select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("tokens"),
                                                F.lit(False).alias("closed"))
    return closed.unionByName(opened)


def count_tokens(spark: SparkSession, folder: str, separator: int = SEPARATOR, width: int = WIDTH,
                 block_bytes: int = BLOCK_BYTES, files: DataFrame | None = None) -> DataFrame:
    """(file, ordinal, start, tokens, closed) of every document in the token files of ``folder``.

    Where a manifest is at hand, ``files`` should be it: a folder may hold files of attempts that did not count.
    """
    blocks = token_blocks(spark, folder, width, block_bytes, files)
    return document_sizes(cut_lineage(separator_places(blocks, folder, separator, width), "separators"))


def document_tokens(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): its number in its token file, where it starts there, and its tokens."""
    folder, manifest = write_tokens(docs)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, ordinal long, start long, n_tokens long")
    found = count_tokens(docs.sparkSession, folder, files=manifest)
    return manifest.join(found, ["file", "ordinal"], "left").select(
        "doc_id", "ordinal", "start", F.col("tokens").alias("n_tokens"))
