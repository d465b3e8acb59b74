"""Connected components of an edge table: forests inside tasks, then small stars and hops between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.storage import cut


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges that is not the smallest of its component, and that smallest one."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        low = label.copy()
        np.minimum.at(low, label[a], least)
        np.minimum.at(low, label[b], least)
        low = low[low]
        while not np.array_equal(low, low[low]):
            low = low[low]
        if np.array_equal(low[label], label):
            break
        label = low[label]
    up = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[up], nodes[label[up]]


def _local(edges: DataFrame) -> DataFrame:
    """The edges of each partition as stars (node, smallest one it reaches there); ``moved`` if any edge of the partition is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, moved = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], False
        for batch in batches:
            us.append(batch.column("u").to_numpy())
            vs.append(batch.column("v").to_numpy())
            moved = moved or bool(pc.any(batch.column("moved")).as_py())
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(np.full(len(u), moved))], names=["u", "v", "moved"])

    return edges.mapInArrow(run, "u long, v long, moved boolean")


def _round(now: DataFrame) -> DataFrame:
    """Each node goes to the smallest of its upper nodes, these go there too, and then each one step further up.

    A node has one upper node for each task that saw it, at most. Hops are a many-to-one join, so a node that
    very many point to does not gather them.
    """
    once = now.select("u", "v").repartition("u").dropDuplicates()
    marked = once.withColumn("p", F.min("v").over(Window.partitionBy("u")))
    parent = marked.filter("v = p").select("u", "p")
    hop = parent.join(parent.select(F.col("u").alias("p"), F.col("p").alias("g")), "p", "left")
    hop = hop.select("u", F.coalesce("g", "p").alias("v"), F.col("g").isNotNull().alias("moved"))
    return _local(hop.unionByName(marked.filter("v <> p").select(F.col("v").alias("u"), F.col("p").alias("v"), F.lit(True).alias("moved"))))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node that has an edge.

    Every task first reduces its edges to a spanning forest, so what is left links the trees of different
    tasks. Rounds repeat until nothing moves: all edges are (node, root) then. Their number grows with the
    logarithm of the longest chain of trees.
    """
    now = cut(_local(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.lit(True).alias("moved")).filter("u <> v")))
    while not now.filter("moved").isEmpty():
        now = cut(_round(now))
    now = now.select("u", "v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
