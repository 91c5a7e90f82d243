"""Bringing this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame

import bidlens

_shipped: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after the package's modules were sent to its session's workers once."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        home = os.path.dirname(os.path.abspath(bidlens.__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="bidlens-"), "bidlens.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(home):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(home)))
        context.addPyFile(target)
        _shipped.add(context.applicationId)
    return df
