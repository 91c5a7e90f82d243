"""Row numbers that are unique by construction and stay the same however often a table is read.

A running number per task changes when a table is split differently on its next read, as
may happen after executors were lost, and a file's name and place only number the rows of a
bare scan. So the numbers are written once, next to the rows, and read from there: of a
task that ran twice only one attempt's rows are ever committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.session import cut_lineage


def numbered(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A written copy of ``docs``, or of its ``columns``: (row, doc), the number and the columns as a struct.

    The number is the writing task's and the row's place in it. Columns of any name, also ``row``, lie apart in the struct.
    """
    kept = [docs[f"`{c}`"] for c in (columns or docs.columns)]
    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*kept).alias("doc")), "numbered")


def unnumbered(rows: DataFrame) -> DataFrame:
    """The documents of ``numbered`` rows with their own columns."""
    return rows.select("doc.*")
