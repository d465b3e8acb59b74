"""The shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, made the checkpoint folder of this session.

    Only a local session (tests) may go without the setting and then gets a folder of its own; a
    cluster without it is an error, since executors share no local folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return named or current
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="orderlake-shared-")
    context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder: its lineage ends there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
