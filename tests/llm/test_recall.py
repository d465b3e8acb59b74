"""Recall of the neighbour search on the given table, against brute force."""

from __future__ import annotations

import numpy as np

from orderlake.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_recall_on_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    found = {}
    for r in QUERIES["op2_cross_polytope"](spark, FOLDER).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [n for n in np.lexsort((ids, distance)) if n != q][:10]
        mine = found[ids[q]]
        assert sorted(mine) == list(range(1, 11))
        assert all(abs(score - distance[ids == v][0]) < 1e-9 for v, score in mine.values())
        hits += len({v for v, _ in mine.values()} & set(ids[order].tolist()))
    assert hits >= 0.9 * 10 * int((ids % 100 == 0).sum())
