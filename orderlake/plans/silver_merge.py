"""The Silver merge on plain Parquet folders: indexed, journaled, and with a feed of its changes.

Reading. An index of key hashes and dates, kept by every merge, names the staged keys that Silver may hold and
the dates where they may live. Only those keys meet Silver's rows, by the columns that decide and that the feed
needs; whole rows are shuffled once, when the staged ones are grouped by date. Stale entries (a row moved on)
and hash collisions only let a key too many meet. The index is 16 bytes a key, read without its partitions'
other columns; it is built by one scan of the key columns where it does not exist.

Writing. Everything a merge will do is written to staging first: the new rows by date, what is left of the
dates that lose a row, and the old images of changed rows. One small journal file then decides the merge.
Applying it - adding to the index and to the change feed, moving the files into Silver, removing emptied
dates - only overwrites, moves or deletes, so a merge that dies on the way is finished by the next one
(``recover``) and leaves nothing twice. Before the journal file exists nothing has happened.

Loads are numbered; the feed holds one folder of signed images for each (``operators.gold_delta``).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.operators.gold_delta import IMAGE, as_inserts, signed_images
from orderlake.operators.merge import ACTION_COL, merge_latest
from orderlake.session import settings
from orderlake.sources import tables as T

KEY_INDEX = "silver_keys"
BATCH_INDEX = "bronze_batches"
# Folder of rows whose partition value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Parquet that one task copies of the dates that lose a row.
COPY_BYTES = "16m"
#: So many replaced keys are sent to every task that copies; more are joined by a shuffle.
SENT_KEYS = 100_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias("h")


def partition_folder(lake: T.Lake, day: str | None) -> str:
    return f"{lake.silver_orders}/event_date={day or NULL_PARTITION}"


def loads(spark: SparkSession, lake: T.Lake) -> list[int]:
    """Numbers of the loads in the change feed."""
    names = T.list_names(spark, lake.changes)
    return sorted(int(n.removeprefix("load=")) for n in names if n.startswith("load="))


# ------------------------------------------------------------------ batches of Bronze


def index_batches(spark: SparkSession, lake: T.Lake, bronze: DataFrame) -> None:
    """Note the dates of the batches in ``bronze``, before their rows are appended: a batch that never
    arrives only leaves dates too many."""
    dates = bronze.select("event_date", "batch_id").distinct()
    dates.write.mode("append").partitionBy("batch_id").parquet(lake.index(BATCH_INDEX))


def append_once(spark: SparkSession, lake: T.Lake, bronze: DataFrame, batch_id: str, staging: str) -> None:
    """Append a batch to Bronze so that appending it again replaces it.

    The rows are written to staging and moved into Bronze's partitions under names that carry the batch.
    A retry first removes the files of that name from the dates that any attempt has noted in the index,
    so whatever an attempt left behind, the batch is there once. One rename for each file of the batch.
    """
    T.rebalanced(bronze, "event_date").write.mode("overwrite").partitionBy("event_date").parquet(staging)
    written = spark.read.schema(bronze.select("batch_id", "event_date").schema).parquet(staging)
    index_batches(spark, lake, written)
    mark = f"batch-{quote(batch_id, safe='')}-"
    index = spark.read.schema("event_date date, batch_id string").parquet(lake.index(BATCH_INDEX)).filter(F.col("batch_id") == batch_id)
    for (day,) in index.select("event_date").distinct().collect():  # one row for each date of the batch
        folder = f"{lake.bronze_orders}/event_date={day or NULL_PARTITION}"
        for name in T.list_names(spark, folder):
            if name.startswith(mark):
                T.delete_path(spark, f"{folder}/{name}")
    for part in T.list_names(spark, staging):
        if part.startswith("event_date="):
            files = [n for n in T.list_names(spark, f"{staging}/{part}") if n.endswith(".parquet")]
            for k, name in enumerate(files):
                T.move(spark, f"{staging}/{part}/{name}", f"{lake.bronze_orders}/{part}/{mark}{k:05d}.parquet")
    T.delete_path(spark, staging)


def bronze_of_batches(spark: SparkSession, lake: T.Lake, batch_ids: Sequence[str]) -> DataFrame:
    """Rows of some batches. Their dates come from the index by a join, so Spark prunes Bronze's
    partitions at run time; rows without a date lie in a partition of their own, which a plain filter
    picks. A batch that the index does not know (written before there was one) is searched everywhere."""
    wanted = F.col("batch_id").isin(list(batch_ids))
    bronze = T.read_table(spark, lake.bronze_orders, lake.format).filter(wanted)
    if not T.path_exists(spark, lake.index(BATCH_INDEX)):
        return bronze
    index = spark.read.schema("event_date date, batch_id string").parquet(lake.index(BATCH_INDEX)).filter(wanted)
    if {r[0] for r in index.select("batch_id").distinct().collect()} != set(batch_ids):  # one row for each batch asked for
        return bronze
    dates = index.filter("event_date is not null").select("event_date").distinct()
    return bronze.join(dates, "event_date", "left_semi").select(bronze.columns).unionByName(bronze.filter("event_date is null"))


# ------------------------------------------------------------------ keys of Silver


def build_key_index(spark: SparkSession, lake: T.Lake, keys: Sequence[str]) -> None:
    """Index all of Silver anew (also drops stale entries)."""
    silver = spark.read.parquet(lake.silver_orders)
    path = lake.index(KEY_INDEX)
    draft = f"{path}-new"
    silver.select(key_hash(keys), "event_date").write.mode("overwrite").parquet(f"{draft}/load=0")
    T.delete_path(spark, path)
    T.move(spark, draft, path)


def known_keys(spark: SparkSession, lake: T.Lake, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries (``h``, ``event_date``) of the index that have the hash of a key of ``source``."""
    if not T.path_exists(spark, lake.index(KEY_INDEX)):
        build_key_index(spark, lake, keys)
    index = spark.read.schema("h long, event_date date").parquet(lake.index(KEY_INDEX))
    return index.join(source.select(key_hash(keys)), "h", "left_semi")


def candidate_dates(spark: SparkSession, lake: T.Lake, source: DataFrame, keys: Sequence[str]) -> list:
    """Dates where the keys of ``source`` may live, and its own: at most one value for each calendar day."""
    now = known_keys(spark, lake, source, keys).select("event_date")
    return [r[0] for r in now.union(source.select("event_date")).distinct().collect()]


def target_of(spark: SparkSession, lake: T.Lake, dates: Sequence, silver: DataFrame | None = None) -> DataFrame:
    """Silver rows of some dates; the filter is on the partition column alone. ``silver``: the table, where its files are listed already."""
    own = F.col("event_date").isin([d for d in dates if d is not None])
    silver = spark.read.parquet(lake.silver_orders) if silver is None else silver
    return silver.filter(own | F.col("event_date").isNull() if None in dates else own)


def forget(spark: SparkSession, lake: T.Lake) -> None:
    """Drop what was kept about a Silver that no longer exists (its index, feed, journal and Gold state)."""
    for path in (lake.journal, lake.changes, lake.index(KEY_INDEX), lake.gold_state()):
        T.delete_path(spark, path.rstrip("/"))


# ------------------------------------------------------------------ merge


def merge(spark: SparkSession, lake: T.Lake, staged: Sequence[DataFrame], keys: Sequence[str], staging: str) -> int:
    """Merge staged rows (in shares, written one after the other) into Silver; returns the number of this load (0: nothing staged).

    Staged keys that the index knows meet Silver's rows, many of them in passes over shares of the keys; every row
    of a key, old or new, is in the same pass. A row of Silver that is not replaced stays in its file unless another
    one of its date is.
    """
    recover(spark, lake)
    load = max(loads(spark, lake), default=0) + 1
    for k, part in enumerate(staged):
        part.write.mode("append" if k else "overwrite").parquet(f"{staging}/source", compression=T.CODEC)
    source = spark.read.parquet(f"{staging}/source")
    if source.isEmpty():
        T.delete_path(spark, staging)
        return 0
    known_keys(spark, lake, source, keys).write.mode("overwrite").parquet(f"{staging}/known")
    known = spark.read.schema("h long, event_date date").parquet(f"{staging}/known")
    silver = spark.read.parquet(lake.silver_orders)
    cols = silver.columns
    changed = _meet(spark, target_of(spark, lake, _dates(known), silver), source.select(*cols), known.select("h"), keys, staging)
    action = F.col(ACTION_COL)
    # a staged row takes the place of each row it replaces; one that meets only rows to keep is not taken in
    times = changed.filter(action.isin("keep", "update")).groupBy(*keys).agg(F.count_if(action == "update").cast("int").alias("__times"))
    added = source.select(*cols).join(times, list(keys), "left").withColumn("__n", F.explode(F.array_repeat(F.lit(0), F.coalesce("__times", F.lit(1)))))
    with settings(spark, T.SPREAD):
        _by_date(T.rebalanced(added.select(*cols), "event_date"), f"{staging}/merged/added")
    updated = changed.filter(action == "update")
    losing = _dates(updated.select(F.col("_old_event_date").alias("event_date")))
    left = target_of(spark, lake, losing, silver)
    few = updated.count() <= SENT_KEYS
    # a file holds one date: tasks copy files, a few dates each, and sort no more rows than a shuffle partition has
    with settings(spark, {"spark.sql.files.maxPartitionBytes": COPY_BYTES, **T.SPREAD}):
        gone = updated.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("updated_at").alias("__newer"))
        replaced = F.col("updated_at") < F.col("__newer")
        for k in keys:
            replaced = replaced & (F.col(k) == F.col(f"__{k}"))
        left = left.join(F.broadcast(gone) if few else gone, replaced, "left_anti").select(*cols)
        _by_date(left if few else T.rebalanced(left, "event_date"), f"{staging}/merged/left")
    for name in ("source", "known"):
        T.delete_path(spark, f"{staging}/{name}")
    T.write_small(spark, f"{staging}/merged/_SUCCESS", "")
    plan = {"load": load, "staging": staging, "keys": list(keys), "schema": silver.schema.json(), "losing": [d.isoformat() if d else None for d in losing]}
    T.write_small(spark, f"{lake.journal}/{load:012d}.json", json.dumps(plan))
    apply(spark, lake, plan)
    return load


def _dates(rows: DataFrame) -> list:
    """Distinct dates: at most one value for each calendar day."""
    return [r[0] for r in rows.select("event_date").distinct().collect()]


def _by_date(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(**T.KEPT).partitionBy("event_date").parquet(path)


def _meet(spark: SparkSession, silver: DataFrame, source: DataFrame, known: DataFrame, keys: Sequence[str], staging: str) -> DataFrame:
    """What becomes of the staged rows and of Silver's whose key hash is ``known``: ``_merge_action`` and the images, written to staging."""
    narrow = list(dict.fromkeys([*keys, "updated_at", *IMAGE]))
    n = T.passes(2 * known.count())
    for k in range(n):
        sides = []
        for rows in (silver, source):
            hashed = T.share(rows.select(*narrow), keys, k, n).withColumn("__h", key_hash(keys))
            sides.append(hashed.join(known.withColumnRenamed("h", "__h"), "__h", "left_semi").drop("__h"))
        met = merge_latest(*sides, keys=keys, columns=narrow, track=IMAGE).filter(F.col(ACTION_COL) != "target_only")
        met.write.mode("append" if k else "overwrite").parquet(f"{staging}/merged/met", compression=T.CODEC)
    return spark.read.schema(met.schema).parquet(f"{staging}/merged/met")


def apply(spark: SparkSession, lake: T.Lake, plan: dict) -> None:
    """Carry a decided merge out; doing it again changes nothing."""
    merged, load, keys = f"{plan['staging']}/merged", plan["load"], plan["keys"]
    if not T.path_exists(spark, f"{merged}/_FED"):  # before files leave staging
        added = spark.read.schema(StructType.fromJson(json.loads(plan["schema"]))).parquet(f"{merged}/added")
        updated = spark.read.parquet(f"{merged}/met").filter(F.col(ACTION_COL) == "update")
        stayed = updated.filter(F.col("event_date").eqNullSafe(F.col("_old_event_date"))).select(*keys)
        added.join(stayed, list(keys), "left_anti").select(key_hash(keys), "event_date").write.mode("overwrite").parquet(f"{lake.index(KEY_INDEX)}/load={load}")
        images = as_inserts(added).unionByName(signed_images(updated).filter("sign < 0"))
        images.write.mode("overwrite").parquet(f"{lake.changes}/load={load}", compression=T.CODEC)
        T.write_small(spark, f"{merged}/_FED", "")
    losing = [partition_folder(lake, day).rpartition("/")[2] for day in plan["losing"]]
    T.overwrite_partitions([f"{merged}/added", f"{merged}/left"], lake.silver_orders, spark=spark, mark=f"load-{load:012d}-", replaced=losing)
    T.delete_path(spark, f"{lake.journal}/{load:012d}.json")
    T.delete_path(spark, plan["staging"])


def recover(spark: SparkSession, lake: T.Lake) -> list[int]:
    """Finish the merges that were decided but not carried out; returns their loads."""
    names = [n for n in T.list_names(spark, lake.journal) if n.endswith(".json")]
    done = []
    for name in names:
        plan = json.loads(T.read_small(spark, f"{lake.journal}/{name}"))
        if not T.path_exists(spark, f"{plan['staging']}/merged/_SUCCESS"):
            raise FileNotFoundError(f"{lake.journal}/{name} needs {plan['staging']}, which is gone")
        apply(spark, lake, plan)
        done.append(plan["load"])
    return done
