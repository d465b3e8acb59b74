"""Send this package to the executors, for sessions whose workers cannot import it, in batches of fewer rows."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import orderlake

_sent: set[str] = set()

#: Rows of whole texts in one Arrow batch: some MB at both ends, where Spark's default of 10,000 takes a hundred.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> None:
    """Once for each application: hand a zip of the package to ``addPyFile``. A session that allows larger Arrow
    batches than ``BATCH_ROWS`` rows gets this bound."""
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    top = os.path.dirname(os.path.abspath(orderlake.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="orderlake-ship-"), "orderlake.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(target)
    _sent.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
