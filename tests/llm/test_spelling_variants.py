"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from orderlake.llm.spelling_variants import _symbols, damaged_runs, neighbourhood, op11_spelling_variants, reduced_hash, variant_forms

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    near = {w: [u for u in n if one_edit(w, u)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda u: (-n[u], u), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def collected(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def write(spark, folder, rows, schema=DOCS):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return folder


def corpus(seed):
    pick = random.Random(seed)
    stems = ["".join(pick.choice("abcéßn") for _ in range(pick.randint(5, 9))) for _ in range(12)]
    rows = []
    for doc in range(150):
        words = []
        for _ in range(pick.randint(0, 60)):
            w = list(stems[min(11, int(pick.expovariate(0.5)))])
            if pick.random() < 0.4:
                at = pick.randrange(len(w))
                w[at : at + pick.randint(0, 1)] = pick.choice(["", "a", "É", "x"])
            words.append("".join(w) if pick.random() < 0.7 else "".join(w).upper())
        rows.append((doc, pick.choice([" ", "\n", " 7 ", "-"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, lake_root, seed):
    rows = corpus(seed)
    found = collected(op11_spelling_variants(spark, write(spark, lake_root, rows)))
    assert found == expected(rows)
    assert any(r[1] for r in found)


def test_odd_inputs(spark, lake_root):
    long = "ab" * 2_500
    rows = [(None, "nationwide " * 30), (1, None), (2, ""), (3, "Nationwidé " * 6), (3, "Nationwidé " * 6), (4, "natiońwide × ÷÷÷÷÷÷÷ 12345678 кириллица " * 6), (5, f"{long} " * 5), (6, f"{long}a " * 5)]
    assert collected(op11_spelling_variants(spark, write(spark, lake_root, rows))) == expected(rows)


def test_extra_columns_and_empty_table(spark, lake_root):
    names = ["word", "n", "r", "id", "run", "h", "form", "near"]
    schema = T.StructType([*DOCS.fields, *[T.StructField(c, T.StringType()) for c in names]])
    rows = [(k, "Colour colours colour", *["x"] * len(names)) for k in range(20)]
    assert collected(op11_spelling_variants(spark, write(spark, lake_root, rows, schema))) == expected([r[:2] for r in rows])
    assert op11_spelling_variants(spark, write(spark, f"{lake_root}/empty", [])).count() == 0


def test_chain_of_forms_reaches_its_root(spark):
    counts = {"abcdefgh": 5, "abcdefg": 25, "abcdef": 130, "xabcdef": 700, "xxabcdef": 3501, "lonely": 9}
    found = {r.word: r.root for r in variant_forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert found == {**dict.fromkeys(counts, "xxabcdef"), "lonely": "lonely"}


def test_equal_counts_take_the_least_word(spark):
    rows = [("common", 5), ("commoné", 50), ("commonz", 50), ("kommon", 50)]
    found = {r.word: (r.form, r.n_near) for r in variant_forms(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert found["common"] == ("commonz", 3)


@pytest.mark.parametrize("symbols", [1, 2, 6])
def test_neighbourhood_is_complete_and_without_repeats(symbols):
    pick = random.Random(symbols)
    words = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 7))) for _ in range(40)]
    for place, code in _symbols(words, symbols):
        rows, hashes = (np.concatenate(x) for x in zip(*neighbourhood(code, symbols), strict=True))
        for k, own in enumerate(code.tolist()):
            want = {tuple(own)}
            for i in range(len(own) + 1):
                want |= {(*own[:i], c, *own[i:]) for c in range(1, symbols + 1)}
                if i < len(own):
                    want |= {(*own[:i], c, *own[i + 1 :]) for c in range(1, symbols + 1)} | {(*own[:i], *own[i + 1 :])}
            mine = hashes[rows == k]
            assert len(mine) == len(set(mine.tolist())) == len(want)
    assert len(reduced_hash(words, symbols)) == len(words)


def test_damage_takes_one_letter(spark):
    rows = [(k, "wonderful") for k in range(2000)]
    found = Counter(r.word for r in damaged_runs(spark.createDataFrame(rows, DOCS)).collect())
    want = Counter()
    for k, run in rows:
        h = zlib.crc32(f"{k}:{run}".encode())
        want[run if h % 199 else run[: h % 9] + run[h % 9 + 1 :]] += 1
    assert found == want and len(found) > 1
