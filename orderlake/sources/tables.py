"""Lake layout and table I/O.

Tables live under one root on shared storage (any Hadoop-compatible URI). The
format is Delta when the ``delta`` package is importable, else Parquet; nothing
requires Delta. Partitioned tables use Hive-style ``event_date=...`` folders.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlake.session import settings
from orderlake.sources.schemas import LANDING_COLUMNS, LANDING_SCHEMA

# The catalog names and relative paths of the published tables.
TABLE_LOCATIONS = {
    "bronze.orders_raw": "bronze/orders_raw",
    "silver.orders": "silver/orders",
    "gold.daily_sales": "gold/daily_sales",
    "gold.product_performance": "gold/product_performance",
    "gold.country_revenue": "gold/country_revenue",
    "gold.order_status_summary": "gold/order_status_summary",
    "gold.pipeline_health": "gold/pipeline_health",
    "ops.dq_check_results": "ops/dq_check_results",
    "ops.pipeline_run_log": "ops/pipeline_run_log",
}
REJECTED_LOCATION = "ops/rejected_records"
QUARANTINE_LOCATION = "ops/quarantine"
LANDING_LOCATION = "landing/orders"
STAGING_LOCATION = "_staging"
#: Of the lake's Parquet files: smaller than Spark's default.
CODEC = "zstd"
#: The codec's own level: a higher one (9) takes an eighth off Bronze and 4 % off Silver for half as much CPU time again.
KEPT = {"compression": CODEC, "parquet.compression.codec.zstd.level": "3"}


def delta_installed() -> bool:
    return importlib.util.find_spec("delta") is not None


@dataclass(frozen=True)
class Lake:
    """Paths of every table under ``root``."""

    root: str
    fmt: str = "auto"

    @property
    def format(self) -> str:
        if self.fmt != "auto":
            return self.fmt
        return "delta" if delta_installed() else "parquet"

    def path(self, relative: str) -> str:
        return f"{self.root.rstrip('/')}/{relative}"

    @property
    def landing(self) -> str:
        return self.path(LANDING_LOCATION)

    @property
    def bronze_orders(self) -> str:
        return self.path(TABLE_LOCATIONS["bronze.orders_raw"])

    @property
    def silver_orders(self) -> str:
        return self.path(TABLE_LOCATIONS["silver.orders"])

    def gold(self, name: str) -> str:
        return self.path(TABLE_LOCATIONS[f"gold.{name}"])

    @property
    def run_log(self) -> str:
        return self.path(TABLE_LOCATIONS["ops.pipeline_run_log"])

    @property
    def dq_results(self) -> str:
        return self.path(TABLE_LOCATIONS["ops.dq_check_results"])

    @property
    def rejected(self) -> str:
        return self.path(REJECTED_LOCATION)

    def index(self, name: str) -> str:
        """Folder of an index kept beside the tables."""
        return self.path(f"_index/{name}")

    @property
    def changes(self) -> str:
        """Signed row images of each Silver merge, one folder for each load."""
        return self.path("_changes/silver")

    @property
    def journal(self) -> str:
        """Merges that are decided but not yet finished."""
        return self.path("_journal/silver")

    def gold_state(self, *parts: str) -> str:
        return self.path("/".join(["_gold_state", *parts]))

    @property
    def quarantine(self) -> str:
        return self.path(QUARANTINE_LOCATION)

    def staging(self, *parts: str) -> str:
        return self.path("/".join([STAGING_LOCATION, *parts]))


# ------------------------------------------------------------------ reads


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Load a table by path."""
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Is there a readable table at ``path``? (no job; of a Parquet table the folders are looked through up to its first file)"""
    if fmt == "parquet":
        return _has_files(*_file_system(spark, path))
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def _has_files(fs, folder) -> bool:
    """Is a data file below ``folder``, by Spark's rule of names?"""
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        if (not name.startswith(("_", ".")) or "=" in name) and (status.isFile() or _has_files(fs, status.getPath())):
            return True
    return False


def read_landing(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Landing JSON lines with the explicit 16-field schema (no inference pass).

    Reading the landing root also yields the ``event_date``/``batch_id`` folder columns; Bronze replaces
    both, and the payload is built from the 16 fields only. ``corrupt`` names a column for the text of
    lines that are no such record (their 16 fields are NULL).
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt is None:
        return reader.schema(LANDING_SCHEMA).json(path)
    schema = StructType([*LANDING_SCHEMA.fields, StructField(corrupt, StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", corrupt).json(path)


# ------------------------------------------------------------------ passes

#: A write that shuffles more rows than this runs in passes, each over a share of the keys, so that the shuffle files of one
#: are gone before the next: at most so many, since each reads its input again and adds its own files.
PASS_ROWS = 20_000_000
MOST_PASSES = 8


def passes(rows: int) -> int:
    return max(1, min(MOST_PASSES, -(-rows // PASS_ROWS)))


def share(df: DataFrame, keys: Sequence[str], k: int, n: int) -> DataFrame:
    """The ``k``-th of ``n`` shares of the rows; rows of equal keys are in the same, also in those of another table."""
    return df if n == 1 else df.filter(F.pmod(F.xxhash64(*keys), F.lit(n)) == F.lit(k))


# ------------------------------------------------------------------ writes

#: Of writes by partition: a small table of many partitions, most of whose time is opening files, is dealt over all cores too.
SPREAD = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Group rows by the partition columns before a partitioned write.

    Without it every task writes a file into every date it holds (tasks x dates
    small files). ``REBALANCE`` lets adaptive execution size the output tasks and
    split a hot date over several tasks instead of one.
    """
    return df.hint("rebalance", *cols) if cols else df


def write_landing(events: DataFrame, lake: Lake, run_date: F.Column, batch_id: F.Column, few: bool = False) -> None:
    """K1: JSON lines, compressed, under ``orders/event_date=<run date>/batch_id=<batch>``.

    Dynamic partition overwrite: re-running one batch replaces only that batch. A compressed file is read
    by one task; the rebalanced write keeps each to the size of a shuffle partition. ``few``: the rows belong
    to a few folders, into which each task writes a file of its own, without a shuffle.
    """
    out = events.select(*LANDING_COLUMNS, F.date_format(run_date, "yyyy-MM-dd").alias("event_date"), batch_id.alias("batch_id"))
    (
        (out if few else rebalanced(out, "event_date", "batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("event_date", "batch_id")
        .json(lake.landing)
    )


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None, grouped: bool = False) -> None:
    """K2/K5/K6/K7: append rows (partitioned when asked; ``grouped``: already rebalanced by that column)."""
    if partition_by and not grouped:
        df = rebalanced(df, partition_by)
    w = df.write.format(fmt).mode("append").options(**KEPT)
    if partition_by:
        w = w.partitionBy(partition_by)
    with settings(df.sparkSession, SPREAD):
        w.save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """K3/K4: replace a whole table (Delta also replaces its schema)."""
    if partition_by:
        df = rebalanced(df, partition_by)
    w = df.write.format(fmt).mode("overwrite").options(**KEPT)
    if fmt == "delta":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(partition_by)
    with settings(df.sparkSession, SPREAD):
        w.save(path)


def overwrite_partitions(df: DataFrame | Sequence[str], path: str, partition_by: str = "event_date", grouped: bool = False, **taken) -> None:
    """Replace only the partitions present in ``df`` (Parquet dynamic overwrite). ``grouped``: its rows lie
    together by that column already, as in files that were written so. Instead of rows, folders in which they
    are written by partition already: their files are moved (``take_partitions``)."""
    if not isinstance(df, DataFrame):
        return take_partitions(folders=df, path=path, **taken)
    with settings(df.sparkSession, SPREAD):
        (
            (df if grouped else rebalanced(df, partition_by))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**KEPT)
            .partitionBy(partition_by)
            .format("parquet")
            .save(path)
        )


def take_partitions(spark: SparkSession, folders: Sequence[str], path: str, mark: str, replaced: Sequence[str] = ()) -> None:
    """Move the files of partitions that are written already into the table at ``path``, under names that begin with ``mark``.

    Of the partitions named in ``replaced`` all files of other names go first, and an empty one goes altogether.
    Only renames and deletes: a call that died is finished by the next one.
    """
    staged = {part for folder in folders for part in list_names(spark, folder) if "=" in part}

    def take(part: str) -> None:
        if part in gone:
            for name in list_names(spark, f"{path}/{part}"):
                if not name.startswith((mark, ".")):
                    delete_path(spark, f"{path}/{part}/{name}")
        for k, folder in enumerate(folders):
            for name in list_names(spark, f"{folder}/{part}"):
                if name.endswith(".parquet"):
                    move(spark, f"{folder}/{part}/{name}", f"{path}/{part}/{mark}{k}-{name}")
        if part in gone and not any(n.startswith(mark) for n in list_names(spark, f"{path}/{part}")):
            delete_path(spark, f"{path}/{part}")

    gone = set(replaced)
    with ThreadPoolExecutor(8) as pool:  # each partition by itself: many small ones wait for the file system together
        list(pool.map(take, sorted(staged | gone)))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the cluster's file system client (used for emptied partitions)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``?"""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below ``path``, sorted; none if it does not exist."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its target must not exist."""
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written under another name, then renamed."""
    fs, hpath = _file_system(spark, path)
    _, draft = _file_system(spark, path + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(hpath, False)
    if not fs.rename(draft, hpath):
        raise OSError(f"could not write {path}")


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, hpath = _file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, lake: Lake, catalog_prefix: str = "") -> DataFrame:
    """K8: register the layer tables in the catalog as EXTERNAL tables.

    Bronze, Silver and the ops tables are registered over their paths, without a copy. A Gold table, which
    is small and replaced as a whole, is written to a folder of its own for each publication; switching the
    table's location to it is the last step, so a reader sees the table before or the table after, never
    a half-written one, and a publication that dies leaves the old one. The folder before the current one is
    kept for readers at work. ``rejected_records`` is not published, as in the reference. Returns ``SHOW
    TABLES`` of the gold schema.
    """
    fmt = lake.format
    for schema in sorted({name.split(".")[0] for name in TABLE_LOCATIONS}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog_prefix}{schema}")
    for name, relative in TABLE_LOCATIONS.items():
        path = lake.path(relative)
        if not table_exists(spark, path, fmt):
            continue
        full = f"{catalog_prefix}{name}"
        if name.startswith("gold.") and fmt == "parquet":
            publish_version(spark, full, read_table(spark, path, fmt), lake.path(f"_published/{name}"))
            continue
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, path=path, source=fmt)
        switch_location(spark, full, path)
        if fmt == "parquet" and _is_partitioned(spark, full):
            # partitions come and go with merges: drop those whose folder is gone, add the new ones
            spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    return spark.sql(f"SHOW TABLES IN {catalog_prefix}gold")


def publish_version(spark: SparkSession, table: str, df: DataFrame, folder: str) -> str:
    """Replace an external table by ``df``: write a new version beside the old ones, then switch to it."""
    names = [n for n in list_names(spark, folder) if n.startswith("version=")]
    version = max((int(n.removeprefix("version=")) for n in names), default=0) + 1
    path = f"{folder}/version={version:012d}"
    df.write.mode("overwrite").parquet(path)
    if spark.catalog.tableExists(table):
        before = table_location(spark, table)
        switch_location(spark, table, path)
    else:
        before = None
        spark.catalog.createTable(table, path=path, source="parquet")
    for name in names:
        if before is None or not before.rstrip("/").endswith(name):
            delete_path(spark, f"{folder}/{name}")
    return path


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def switch_location(spark: SparkSession, table: str, path: str) -> None:
    """Point an external table to another folder."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    try:
        return any(c.isPartition for c in spark.catalog.listColumns(table))
    except AnalysisException:
        return False
