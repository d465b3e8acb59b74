"""Components against union-find, for chains, hubs and random graphs; labels without a cap."""

from __future__ import annotations

import random

import pytest

from orderlake.llm import language_id
from orderlake.llm.components import components
from orderlake.llm.ship import ship


def expected(edges):
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for e in edges for x in e}


def graph(kind, pick):
    if kind == "chain":
        names = pick.sample(range(10_000), 700)
        return list(zip(names, names[1:], strict=False))
    if kind == "hub":
        return [(5, k) for k in range(10, 3000)] + [(9000 + k, 10 + k) for k in range(50)]
    if kind == "repeated":
        return [(1, 2)] * 50 + [(2, 1), (3, 3), (4, 2)]
    return [(pick.randrange(900), pick.randrange(900)) for _ in range(600)] if kind == "random" else []


@pytest.mark.parametrize("kind", ["chain", "hub", "repeated", "random", "none"])
def test_components(spark, kind):
    ship(spark)
    pick = random.Random(3)
    edges = graph(kind, pick)
    pick.shuffle(edges)
    rows = components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    want = {k: v for k, v in expected([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)


def test_every_label_is_learned(spark):
    """300 labels, each with words of its own; no class is left out."""
    ship(spark)
    pick = random.Random(4)
    rows = []
    for k in range(300):
        letters = pick.sample("abcdefghijklmnopqrstuvwxyzäöüéñ", 5)
        own = ["".join(pick.choice(letters) for _ in range(pick.randint(3, 7))) for _ in range(12)]
        rows += [(1000 * k + n, " ".join(pick.choice(own) for _ in range(40)), f"l{k:03d}") for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.languages) == 300
    got = language_id.identify(docs, model).collect()
    assert len({r.lang_pred for r in got}) > 256


def test_very_long_text_and_repeated_rows(spark):
    ship(spark)
    rows = [(1, "the river runs under the old bridge " * 20_000, "en"), (2, "der fluss läuft unter der alten brücke", "de"), (2, "der fluss läuft unter der alten brücke", "de"), (3, "x" * 200_000, None), (None, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.identify(docs, language_id.fit(docs)).collect()
    assert len(got) == 5 and len({tuple(r) for r in got if r.doc_id == 2}) == 1
    assert {r.lang_pred for r in got if r.doc_id is None} == {"und"}
