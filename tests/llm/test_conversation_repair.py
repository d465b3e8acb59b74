"""Conversation repair against a shortest-path search over whole audits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from orderlake.llm.conversation_repair import END, Endings, RepairPlan, _audited, before, op12_conversation_repair

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
NEED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damage(rows):
    def put(v):
        return " " if v is None else v

    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{put(conv)}:{put(turn)}".encode()) % 20
        role, text = put(role), put(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        yield from [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)


def solve(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, fault = set(), []
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        fault.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            text = "\n".join(f"{r}:{t}" for r, t in lines)
            return gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()
        if (i, state) in done:
            continue
        done.add((i, state))
        need, after = NEED[state], STEP[state, NEED[state][0]]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after, (*lines, (need, ""))))
        if i == len(rows):
            continue
        role, text = rows[i][2:]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
        if fault[i] not in ("blank", "duplicate"):
            late = fault[i] == "truncated"
            heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, after, (*lines, (need, text))))
            if (state, role[:1]) in STEP:
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, STEP[state, role[:1]], (*lines, (role, text))))


def by_conversation(rows, all_rows):
    return {conv: solve([r for r in rows if r[0] == conv]) for conv in {r[0] for r in all_rows}}


def conversations(seed, many=40):
    pick = random.Random(seed)
    rows = []
    for conv in [None, *range(many)]:
        for turn in range(pick.choice([0, 1, 2, 5, 9, 30])):
            role = pick.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "usher"])
            text = pick.choice(["Yes.", "No", "  \t", "", None, f"Word {pick.random()}.", f"Text {pick.randint(0, 3)}!", "End.\n "])
            rows.append((conv, pick.choice([turn] * 8 + [None, turn - 1, turn + 3]), role, text))
    return rows + rows[:5]


def reported(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def write(spark, folder, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/conversations.parquet")
    return folder


def test_query_equals_search(spark, lake_root):
    rows = conversations(1)
    rows += [(900, 5, "user", "x" * 300_000 + "."), *[(901, k, "user", "Same.") for k in range(3)]]
    assert reported(op12_conversation_repair(spark, write(spark, lake_root, rows))) == by_conversation(list(damage(rows)), rows)


@pytest.mark.parametrize("piece", [1, 3, 512])
def test_pieces_of_any_size_give_the_same(spark, piece):
    rows = conversations(2)
    pick = random.Random(piece)
    rows += [(77, k, pick.choice(["user", "assistant", "assistant", "system"]), pick.choice(["A.", f"B{k}.", f"C{k}"])) for k in range(400)]  # a hot one
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert reported(RepairPlan(spark.createDataFrame(rows, ROWS), piece=piece).report()) == by_conversation(plain, rows)


def test_messages_are_legal_and_hash_to_the_report(spark):
    plan = RepairPlan(spark.createDataFrame(conversations(3), ROWS), piece=4)
    told = reported(plan.report())
    lines = {}
    for r in sorted(plan.messages().collect(), key=lambda r: (str(r.conv_id), r.place)):
        lines.setdefault(r.conv_id, []).append(r)
    for conv, row in told.items():
        mine = lines.get(conv, [])
        assert [r.place for r in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in mine))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == row[-1]
        assert "".join(r.edit for r in mine) == row[-2].replace("D", "")


def test_extra_columns_empty_table_and_lost_conversations(spark, lake_root):
    names = ["conv", "head", "digest", "part", "seq", "kind", "fate", "copy", "signature"]
    schema = T.StructType([*ROWS.fields, *[T.StructField(c, T.IntegerType()) for c in names]])
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello.", *[1] * len(names)), (gone + 1000, 1, "user", "Hello.", *[1] * len(names))]
    found = reported(op12_conversation_repair(spark, write(spark, lake_root, rows, schema)))
    assert found == by_conversation(list(damage([r[:4] for r in rows])), rows)
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert op12_conversation_repair(spark, write(spark, f"{lake_root}/empty", [])).count() == 0


def test_nodes_are_shared_by_common_endings():
    grown = []
    endings = Endings((END, ("", "II", "I", ""), (0, 3, 3, 3)), lambda node, sign: grown.append(sign) or _audited(node, sign))
    signatures = sorted(["ua", "sua", "uaua", "suaua", "oua", "xua"], key=lambda s: s[::-1])
    nodes = {s: endings.node(s) for s in signatures}
    assert len(grown) == len({s[k:] for s in signatures for k in range(len(s))})
    assert nodes["suaua"][0][0] == 0 and nodes["suaua"][1][0] == "KKKKK"
    assert nodes["xua"][1][0] == "DKK" and nodes["oua"][0][0] == 3  # deleted: an inserted or changed role would cost 4
    assert before(END, "a")[0][0] == 2  # an inserted user before it
