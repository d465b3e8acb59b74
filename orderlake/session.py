"""Session helpers: time zone, adaptive execution and the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

UTC = "UTC"


def use_utc(spark: SparkSession) -> SparkSession:
    """All landing strings carry a ``Z`` suffix and dates are UTC dates."""
    spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def tune_for_scale(spark: SparkSession) -> SparkSession:
    """Runtime re-planning: coalesce small shuffles, split skewed join partitions.

    These are Spark defaults in 4.x; set explicitly so a cluster profile that
    switched them off does not silently lose skew handling.
    """
    for key, value in (
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
    ):
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Shuffle files go as soon as the action that wrote them has ended, not when the driver collects its garbage. For runs of
#: many writes, none of which runs a plan twice.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's checkpoint folder; only set one where it is unset (tests)."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback:
        raise ValueError("set spark.checkpoint.dir, or pass a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def local_session(app: str = "orderlake", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench; a cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
