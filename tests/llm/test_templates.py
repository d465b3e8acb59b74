"""Templates: the cases of the second verdict, and brute force over all windows of texts and items."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import templates as t
from orderlake.llm.ship import ship

LYON = "a train leaves the town of Lyon with 12 wagons and comes back to the town of Lyon after 30 km"


def judged(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, hash string, form int, place int, item long, th int")
    b = spark.createDataFrame(items, "item_id long, text string, size int, total int")
    return {r.doc_id: (r.contaminated, r["items"]) for r in t.decontaminate(d, b).collect()}


def rows_of(texts):
    return [(k, x, "h", 1, 2, 3, 4) for k, x in enumerate(texts)]


def items_of(texts):
    return [(k, x, 1, 2) for k, x in enumerate(texts)]


def test_slots_are_consistent_over_the_whole_copy(spark):
    ship(spark)
    texts = [
        LYON.replace("Lyon", "Nice").replace("12", "7"),
        LYON.replace("Lyon", "Nice", 1).replace("Lyon", "Rome"),
        LYON.replace("Lyon", "Nice", 1).replace("Lyon", "Rome").replace("and comes", "and then comes"),
        LYON.replace("Lyon", "Nice").replace("and comes", "and then comes"),
        LYON.replace("Lyon", "Nice") + " " + "quiet filler words stand here " * 4 + LYON.replace("Lyon", "Rome"),  # two copies, each by its own
    ]
    got = judged(spark, rows_of(texts), items_of([LYON]))
    assert [got[k][0] for k in range(5)] == [True, False, False, True, True]


def test_short_items_are_searched_as_plain_words(spark):
    ship(spark)
    docs = rows_of(["yes who wrote the song today", "who wrote that song", "Yes, who wrote: the song?", "abracadabra", None, ""])
    got = judged(spark, docs, items_of(["who wrote the song", "Abracadabra!", "", None]))
    assert {k: v[1] for k, v in got.items() if v[0]} == {0: [0], 2: [0], 3: [1]}


def test_texts_of_one_item_are_items_of_their_own(spark):
    ship(spark)
    one, other = "the first question asks about the height of a very old tower by the sea", "another wording wants the number of steps up to the light at its top"
    items = [(7, one, 1, 2), (7, other, 1, 2), (7, one, 1, 2)]
    half = " ".join(one.split()[:8]) + " nothing else " + " ".join(other.split()[:4])
    got = judged(spark, rows_of([one, f"so {other} indeed", "clean words only", half]), items)
    assert [got[k][0] for k in range(4)] == [True, True, False, False]


def test_empty_benchmark_and_long_text(spark):
    ship(spark)
    long = "word " * 100_000 + LYON + " word" * 1000
    assert judged(spark, rows_of([long, "x"]), items_of([LYON]))[0] == (True, [0])
    assert judged(spark, rows_of([long]), [])[0] == (False, [])
    assert judged(spark, [], items_of([LYON])) == {}


def brute(doc, item):
    """Windows compared one by one."""
    if doc is None or item is None:
        return False
    d, i = t.Tokens(pa.array([doc])), t.Tokens(pa.array([item]))
    for form in t.FORMS:
        n = len(i.rows[form])
        size = t.WINDOW if n >= t.WINDOW else n
        if size < (t.LEAST if form else 1):
            continue
        sides = []
        for x in (d, i):
            start, h = x.windows(form, size)
            sides.append([(int(s), int(v), [(q["kind"], q["value"]) for q in x.slots(form, int(s), size)]) for s, v in zip(start, h, strict=True) if v])
        found = {}
        for s, v, slots in sides[0]:
            for p, w, own in sides[1]:
                if v == w:
                    found.setdefault(s - p, []).append((p, [(k, a, b) for (k, a), (_, b) in zip(own, slots, strict=True)]))
        copies, last = [], None
        for diagonal in sorted(found):
            if last is None or diagonal - last > t.GAP:
                copies.append([])
            copies[-1].append(diagonal)
            last = diagonal
        mine, theirs, longest = set(), set(), 0
        for copy in copies:
            met = {m for diagonal in copy for _, ms in found[diagonal] for m in ms}
            if len({(k, a) for k, a, _ in met}) == len(met) == len({(k, b) for k, _, b in met}):
                for diagonal in copy:
                    places = {p for p, _ in found[diagonal]}
                    mine |= places
                    theirs |= {p + diagonal for p in places}
                    longest = max(longest, len(places))
        if mine and (2 * min(len(mine), len(theirs)) >= n - size + 1 or longest >= t.RUN):
            return True
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    ship(spark)
    pick = random.Random(seed)
    words = "the a of in town train goes back from where how many does it take to reach river old red".split()
    names, numbers = ["Lyon", "Nice", "Rome", "Anna"], ["3", "12", "45", "7"]

    def text(n):
        return " ".join(pick.choice(words) if pick.random() < 0.7 else pick.choice(names + numbers) for _ in range(n))

    items = [text(pick.choice([1, 3, 5, 7, 8, 12, 25])) for _ in range(12)]
    docs = []
    for _ in range(60):
        own = pick.choice(items).split()
        for _ in range(pick.randint(0, 3)):
            at = pick.randrange(len(own))
            own[at : at + pick.randint(0, 1)] = [pick.choice(words + names + numbers)]
        swap = dict(zip(names + numbers, pick.sample(names, 4) + pick.sample(numbers, 4), strict=True)) if pick.random() < 0.6 else {}
        docs.append(f"{text(pick.randint(0, 6))} {' '.join(swap.get(w, w) for w in own)} {text(pick.randint(0, 6))}".strip())
    got = judged(spark, rows_of(docs), items_of(items))
    want = {k: [n for n, item in enumerate(items) if brute(doc, item)] for k, doc in enumerate(docs)}
    assert {k: v[1] for k, v in got.items()} == want
    assert 5 < sum(map(bool, want.values())) and any(len(items[n].split()) >= 8 for v in want.values() for n in v)


def test_filter_loses_no_hash(spark):
    ship(spark)
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    filter_ = t.bloom_filter(spark.createDataFrame([(int(h),) for h in hashes], "hash long"))
    assert len(t._in_filter(filter_, hashes.view(np.uint64))) == len(hashes)
    other = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 50_000)
    assert len(t._in_filter(filter_, other.view(np.uint64))) < 1000
