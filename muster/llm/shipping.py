"""Hands this package to the executors, whose Python workers may not have it on their path, and bounds what they hold."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import muster


#: Texts are worked on in slices of a quarter megabyte, so larger batches would only take memory beside the executor's heap.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def shipped(spark: SparkSession) -> SparkSession:
    """The session, with the package added to its application once, and Arrow batches of few megabytes."""
    _add(spark.sparkContext.applicationId)
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    return spark


@functools.cache
def _add(application: str) -> None:
    top = os.path.dirname(os.path.abspath(muster.__file__))
    handle, path = tempfile.mkstemp(prefix="muster-", suffix=".zip")
    with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    SparkSession.active().sparkContext.addPyFile(path)
