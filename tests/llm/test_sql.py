"""Operators that SQL can express, against their DuckDB SQL: on the smallest tables, and quotations where there are any."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
from orderlake.llm.quotations import OP6_SQL, op6_quotations
from orderlake.llm.registry import ORACLES, QUERIES


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(r[k] for k in order) for r in rows)


def by_sql(sql, folder):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        path = f"{folder}/{table}.parquet"
        if folder == SF_SMALL or table == "conversations":
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}{'' if folder == SF_SMALL else '/*.parquet'}')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    columns, rows = by_sql(ORACLES[name], SF_SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, map(tuple, df.collect())) == bag(columns, rows)


def mailing_list(seed):
    """Conversations whose messages quote earlier ones, whole or in part, on several levels, some with an announcement."""
    pick = random.Random(seed)
    words = "river stone möve letter under quiet nine lamps follow early".split()

    def line():
        return " ".join(pick.choice(words) for _ in range(pick.randint(2, 7)))

    rows = []
    for conv in range(25):
        texts = []
        for turn in range(pick.randint(1, 9)):
            own = [line() for _ in range(pick.randint(1, 4))]
            parts = []
            if texts and pick.random() < 0.8:
                quoted = pick.choice(texts).split("\n")
                at = pick.randrange(len(quoted))
                if pick.random() < 0.5:
                    parts.append(pick.choice(["On Monday Ann wrote:", "Am Montag schrieb Ann: ", "hello"]))
                parts += [pick.choice(["> ", ">", " > "]) + q for q in quoted[at : at + pick.randint(1, 5)]]
                if pick.random() < 0.3:
                    parts.insert(pick.randrange(len(parts) + 1), "")
            text = "\n".join(parts + own if pick.random() < 0.7 else own + parts)
            texts.append(text)
            rows.append((conv, turn if pick.random() < 0.95 else None, pick.choice(["user", "assistant", None]), pick.choice([text] * 9 + [None])))
    return [*rows, *rows[:3], (None, 1, "user", "x"), (99, 0, "user", ""), (99, 1, "user", "> " + "long line " * 20_000), (99, 2, "user", ">" * 40 + " deep")]


@pytest.mark.parametrize("seed", [1, 2])
def test_quotations_equal_sql(spark, lake_root, seed):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(mailing_list(seed), schema).coalesce(1).write.parquet(f"{lake_root}/conversations.parquet")
    df = op6_quotations(spark, lake_root)
    found = [tuple(r) for r in df.collect()]
    columns, rows = by_sql(OP6_SQL, lake_root)
    assert bag(df.columns, found) == bag(columns, rows)
    linked = df.columns.index("n_linked")
    assert sum(r[linked] > 0 for r in found) > 30


def test_quotations_of_no_messages(spark, lake_root):
    schema = "conv_id long, turn long, role string, text string, conv string, up int, p int"
    spark.createDataFrame([], schema).write.parquet(f"{lake_root}/conversations.parquet")
    assert op6_quotations(spark, lake_root).count() == 0
