"""Business tables from the change feed of Silver, with their state on shared storage.

State and references (``operators.gold_delta``) live under ``_gold_state``: the state of each table in
one folder for each version, the references as signed counts in one folder for each load, by bucket. A
commit file, written last, names the version and the reference folders that belong to it; whatever a
refresh that died has written belongs to no commit and is overwritten by the next one. So a refresh takes
every load exactly once: those after the last commit, up to the feed's newest.

A refresh reads the feed's new folders, the state, and the references in the buckets of changed groups.
After ``FOLD`` loads the references are folded into one folder. Without a commit, with ``rebuild``, or if
the feed lacks a load, everything is built from Silver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.operators import gold_delta as D
from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T

#: Reference folders that are read one by one before they are folded.
FOLD = 16


def last_commit(spark: SparkSession, lake: T.Lake) -> dict | None:
    names = [n for n in T.list_names(spark, lake.gold_state("commits")) if n.endswith(".json")]
    return json.loads(T.read_small(spark, lake.gold_state("commits", names[-1]))) if names else None


def _state_path(lake: T.Lake, version: int, table: str) -> str:
    return lake.gold_state("state", f"version={version}", table)


def _reference_path(lake: T.Lake, table: str, load: str) -> str:
    return lake.gold_state("references", table, f"load={load}")


def _kept(spark: SparkSession, references: DataFrame, path: str, n: int = 1) -> DataFrame:
    """Write references by bucket, in ``n`` passes over shares of their values, and read them back; no rows leave no
    files, so the schema is told."""
    for k in range(n):
        part = T.share(references, ["value"], k, n)
        T.append(part, path, partition_by="bucket") if k else T.overwrite(part, path, partition_by="bucket")
    return spark.read.schema(references.schema).parquet(path)


def _steps(spark: SparkSession, table: D.GoldTable, deltas: DataFrame, references: DataFrame | None, path: str, n: int) -> DataFrame | None:
    """Changes of distinct counts, found in passes over shares of the values and written to ``path``; None where one pass will do."""
    if n == 1 or references is None:
        return None
    for k in range(n):
        part = D.distinct_deltas(table, T.share(deltas, ["value"], k, n), T.share(references, ["value"], k, n))
        part.write.mode("append" if k else "overwrite").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def references_of(spark: SparkSession, lake: T.Lake, table: D.GoldTable, numbers: list[str], schema: StructType, buckets: list[int] | None = None) -> DataFrame | None:
    """References of some loads, in all buckets or only in those that are named (a partition filter)."""
    out = None
    for path in (_reference_path(lake, table.name, n) for n in numbers):  # each a table of its own, partitioned by bucket; at most FOLD of them
        if T.path_exists(spark, path):
            part = spark.read.schema(schema).parquet(path)
            part = part if buckets is None else part.filter(part["bucket"].isin(buckets))
            out = part if out is None else out.unionByName(part)
    return out


def refresh(spark: SparkSession, lake: T.Lake, rebuild: bool = False) -> dict[str, DataFrame]:
    """Take the loads since the last commit in; returns the tables, read from the new state."""
    sm.recover(spark, lake)
    commit = None if rebuild else last_commit(spark, lake)
    feed = sm.loads(spark, lake)
    newest = max(feed, default=0)
    new = [n for n in feed if commit is not None and n > commit["load"]]
    if commit is None or new != list(range(commit["load"] + 1, newest + 1)):
        commit = _build(spark, lake, newest)
    elif new:
        commit = _advance(spark, lake, commit, new)
    return {t.name: with_clock(D.published(t, spark.read.parquet(_state_path(lake, commit["version"], t.name)))) for t in D.GOLD_TABLES}


def with_clock(table: DataFrame) -> DataFrame:
    return table.withColumn("gold_updated_at", F.current_timestamp())


def _next_version(spark: SparkSession, lake: T.Lake) -> int:
    """Greater than that of any commit."""
    names = T.list_names(spark, lake.gold_state("commits"))
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0) + 1


def _commit(spark: SparkSession, lake: T.Lake, version: int, load: int, references: list[str]) -> dict:
    commit = {"version": version, "load": load, "references": references}
    before = last_commit(spark, lake)
    T.write_small(spark, lake.gold_state("commits", f"{version:012d}.json"), json.dumps(commit))
    for table in D.GOLD_TABLES if len(references) == 1 else ():  # folded or rebuilt: older ones are in it
        for name in T.list_names(spark, lake.gold_state("references", table.name)):
            if name != f"load={references[0]}":
                T.delete_path(spark, lake.gold_state("references", table.name, name))
    for name in T.list_names(spark, lake.gold_state("state")):  # readers of the version before may still be at work
        if int(name.removeprefix("version=")) < (before["version"] if before else version):
            T.delete_path(spark, lake.gold_state("state", name))
    return commit


def _passes(rows: DataFrame) -> int:
    """Each value of a pass has files in many buckets: half as many passes as elsewhere."""
    return -(-T.passes(rows.count()) // 2)


def _build(spark: SparkSession, lake: T.Lake, load: int) -> dict:
    version = _next_version(spark, lake)
    images = lake.gold_state("images")  # read for each table: by all of Silver's partitions once only
    D.as_inserts(spark.read.parquet(lake.silver_orders)).write.mode("overwrite").parquet(images, compression=T.CODEC)
    inserts = spark.read.parquet(images)
    n = _passes(inserts)
    for table in D.GOLD_TABLES:
        deltas = D.reference_deltas(table, inserts)
        path = _reference_path(lake, table.name, str(version))
        D.next_state(table, inserts, deltas=_kept(spark, deltas, path, n)).write.mode("overwrite").parquet(_state_path(lake, version, table.name))
    T.delete_path(spark, images)
    return _commit(spark, lake, version, load, [str(version)])


def _advance(spark: SparkSession, lake: T.Lake, commit: dict, new: list[int]) -> dict:
    version = _next_version(spark, lake)
    signed = spark.read.parquet(*[f"{lake.changes}/load={n}" for n in new])
    numbers = [*commit["references"], str(version)]
    fold = len(numbers) > FOLD
    n = _passes(signed)
    for table in D.GOLD_TABLES:
        path, steps_path = _reference_path(lake, table.name, str(version)), lake.gold_state("steps", table.name)
        deltas = _kept(spark, D.reference_deltas(table, signed), path, n)
        before = references_of(spark, lake, table, commit["references"], deltas.schema, D.touched_buckets(deltas))
        state = spark.read.parquet(_state_path(lake, commit["version"], table.name))
        steps = _steps(spark, table, deltas, before, steps_path, n)
        D.next_state(table, signed, state, before, deltas, steps).write.mode("overwrite").parquet(_state_path(lake, version, table.name))
        T.delete_path(spark, steps_path)
        if fold:
            whole = references_of(spark, lake, table, numbers, deltas.schema)
            _kept(spark, D.fold_references(table, whole), _reference_path(lake, table.name, f"{version}-folded"), _passes(whole))
    return _commit(spark, lake, version, new[-1], [f"{version}-folded"] if fold else numbers)
