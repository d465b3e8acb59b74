"""Cheapest repairs of conversation structure over a suffix-shared automaton of role/fault signatures.

A conversation is legal if its roles read ``(s?(ua)+)?`` by their initials. Each message becomes one symbol: a
message that must go (blank, or role and text seen before), or its role's initial with a mark if it is truncated.
The symbols of a conversation are its signature; the edits that repair it depend on nothing else. Messages may be
kept, given another role, deleted, or new ones inserted, at the costs below; of all cheapest edit sequences the one
whose initials are least in ASCII order is taken.

Signatures are sorted by their reverse, over all conversations, so signatures with a common ending are neighbours.
A task walks them with one stack: a node is a distinct ending, made once and kept while its endings last, and holds
for each state of the grammar the cost to go and the best audit suffix. Two choices at a node begin with different
letters, so the least letter among the cheapest decides and no audits are compared. The stack is never longer than
one signature; two tasks share a node only at their border.

No conversation needs to fit a task. Messages are sorted by range over conversation, turn, role and text, so a hot
conversation lies in many tasks; each task cuts its runs into pieces of at most ``PIECE`` messages. A duplicate is
known by a mark that travels with the first of its kind (one small row for each distinct message, sorted before it).
Only pieces of conversations that a border or the size cuts are chained: a piece's costs between the four states on
entry and on exit are a small matrix, a conversation's matrices are applied from its end, and each piece's signature
joins the automaton with the costs that follow it, taken relative to their least. Then every piece knows its audits,
and one pass in order applies them to the texts. Only this pass has a conversation's rows in one task, because one
sha256 (or one numbering) has to go through them; it streams and holds one piece of texts, and the audit.

Order: by turn (nulls first), equal turns by role and text. Defined results: a null role or text is one space; a null
conversation is one of its own; repeated rows are messages like others (and duplicates of the first); a conversation
without messages is legal and has an empty audit; roles with other initials are illegal until changed; no rows, no
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.storage import new_folder

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Messages, and characters of text, of a piece (at least one message).
PIECE, CHARS = 512, 1 << 20

#: States of the grammar: nothing yet, after system, after user, after assistant (as the first, it may end).
START, SYSTEM, USER, ASSISTANT = range(4)
#: What has to follow each state, and where that leads.
NEXT = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
#: Where each initial leads; others lead nowhere.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
#: Cost to go and audit at the end of a conversation.
END, END_AUDIT, END_STATE = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""), (START, ASSISTANT, ASSISTANT, ASSISTANT)
FAR = 1 << 40

GONE = "x"
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"


def symbol(role: str, text: str, seen: bool) -> tuple[str, int]:
    """The symbol of a message and its first fault: 0 none, 1 blank, 2 duplicate, 3 truncated."""
    body = text.rstrip(SPACE)
    if not body:
        return GONE, 1
    if seen:
        return GONE, 2
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, 0) if body[-1] in STOPS else (initial.upper(), 3)


def before(costs: tuple, sign: str) -> tuple[tuple, list]:
    """Costs to go of the four states before a symbol, and the choice of each: its letter and the state it leads to.

    An insertion stays before the symbol: its choice goes on with that state's own choice.
    """
    cost, choice = [], []
    gone = sign == GONE
    initial, late = sign.lower(), TRUNCATED if sign.isupper() else 0
    for state in range(4):
        best = (DELETE + costs[state], "D", state)
        if not gone:
            to = STEPS.get((state, initial))
            if to is not None:
                best = min(best, (KEEP + late + costs[to], "K", to))
            best = min(best, (REROLE + late + costs[AFTER[state]], "R", AFTER[state]))
        cost.append(best[0])
        choice.append(best[1:])
    done = list(cost)
    for state in (USER, ASSISTANT):
        done[state] = min(cost[state], INSERT + cost[AFTER[state]])
    for state in (START, SYSTEM):
        done[state] = min(cost[state], INSERT + done[USER])
    for state in range(4):
        least = INSERT + done[AFTER[state]]
        if least == done[state] and (least < cost[state] or choice[state][0] > "I"):
            choice[state] = ("I", AFTER[state])
    return tuple(done), choice


class Endings:
    """The nodes along one signature, from its end; signatures must come sorted by their reverse."""

    def __init__(self, start: tuple, grow: Callable[[tuple, str], tuple]):
        self.nodes, self.grow, self.reverse = [start], grow, ""

    def node(self, signature: str) -> tuple:
        reverse = signature[::-1]
        same = 0
        for a, b in zip(self.reverse, reverse, strict=False):
            if a != b:
                break
            same += 1
        del self.nodes[same + 1 :]
        for sign in reverse[same:]:
            self.nodes.append(self.grow(self.nodes[-1], sign))
        self.reverse = reverse
        return self.nodes[-1]


def _audited(node: tuple, sign: str) -> tuple:
    """Costs to go, audits and last states of the node that reads ``sign`` before ``node``."""
    costs, choice = before(node[0], sign)
    audits, exits = [None] * 4, [0] * 4

    def fill(state: int) -> None:
        letter, to = choice[state]
        if letter == "I":
            if audits[to] is None:
                fill(to)
            audits[state], exits[state] = letter + audits[to], exits[to]
        else:
            audits[state], exits[state] = letter + node[1][to], node[2][to]

    for state in range(4):
        if audits[state] is None:
            fill(state)
    return costs, audits, exits


def _crossed(node: tuple, sign: str) -> tuple:
    """For each state on exit, the costs to go of the four states on entry."""
    return tuple(before(costs, sign)[0] for costs in node)


def _ordered(rows: DataFrame) -> DataFrame:
    """Messages in order, over range partitions, each distinct one announced by a mark (a row without text)."""
    rows = rows.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))
    first = rows.groupBy("conv", "role", "head", "digest").agg(F.min(F.struct("turn")).alias("first")).select("conv", F.col("first.turn").alias("turn"), "role", F.lit(None).cast("string").alias("text"), "head", "digest")
    keys = ["conv", "turn", "role", "head"]
    return rows.unionByName(first).repartitionByRange(*keys).sortWithinPartitions(*keys, "text").withColumn("part", F.spark_partition_id())


_PIECES = "part int, seq long, open boolean, signature string, bodies binary, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"


class _Piece:
    def __init__(self, conv, part: int, seq: int, follows: bool):
        self.conv, self.part, self.seq, self.open = conv, part, seq, follows
        self.signs, self.bodies, self.chars = [], [], 0
        self.faults = [0] * 4
        self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        sign, fault = symbol(role, text, seen)
        self.signs.append(sign)
        self.faults[fault] += 1
        if sign != GONE:
            self.bodies.append((role, text))
            self.chars += len(text)
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.high = turn
            self.low = turn if self.low is None else self.low

    def row(self, press: zstandard.ZstdCompressor) -> tuple:
        blob = press.compress(json.dumps(self.bodies, ensure_ascii=False).encode())
        return (self.conv, self.part, self.seq, self.open, "".join(self.signs), blob, *self.faults[1:], self.illegal, self.first, self.last, self.low, self.high, self.turns)


def _cut_pieces(schema: pa.Schema, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        piece, seq, place, marked = None, 0, None, set()
        for batch in batches:
            out = []
            for conv, turn, role, text, head, digest, part in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "head", "digest", "part")), strict=True):
                if place != (conv, turn, role, head):
                    place, marked = (conv, turn, role, head), set()
                if text is None:
                    marked.add(digest)
                    continue
                if piece is None or piece.conv != conv or len(piece.signs) >= most or piece.chars >= CHARS:
                    follows = piece is None or piece.conv == conv
                    if piece is not None:
                        piece.open = piece.open or follows
                        out.append(piece.row(press))
                        seq += 1
                    piece = _Piece(conv, part, seq, follows)
                piece.add(turn, role, text, digest not in marked)
                marked.discard(digest)
            if out:
                yield _batch(out, schema)
        if piece is not None:
            piece.open = True
            yield _batch([piece.row(press)], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _matrices(pieces: DataFrame) -> DataFrame:
    """``signature`` and ``matrix`` (entry by exit, in a row) of each distinct signature of cut conversations."""
    out = _arrow("signature string, matrix array<long>", pieces.sparkSession)
    unit = tuple(tuple(0 if s == e else FAR for s in range(4)) for e in range(4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings(unit, _crossed)
        for batch in batches:
            rows = []
            for signature in batch.column("signature").to_pylist():
                node = endings.node(signature)
                rows.append((signature, [node[e][s] for s in range(4) for e in range(4)]))
            if rows:
                yield _batch(rows, out)

    distinct = pieces.filter("open").select("signature").distinct().withColumn("back", F.reverse("signature"))
    return distinct.repartitionByRange("back").sortWithinPartitions("back").select("signature").mapInArrow(run, "signature string, matrix array<long>")


def _chained(pieces: DataFrame) -> DataFrame:
    """For each piece of a cut conversation, the relative costs that follow it, and whether it is the last one."""
    out = _arrow("part int, seq long, follow string, tail boolean", pieces.sparkSession)
    mine = pieces.filter("open").select("conv", "part", "seq", "signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, now, begun = END, None, False
        for batch in batches:
            rows = []
            for key, part, seq, matrix in zip(*(batch.column(c).to_pylist() for c in ("conv", "part", "seq", "matrix")), strict=True):
                tail = not begun or key != now
                if tail:
                    costs, now, begun = END, key, True
                least = min(costs)
                rows.append((part, seq, ",".join(str(c - least) for c in costs), tail))
                costs = tuple(min(matrix[4 * s + e] + costs[e] - least for e in range(4)) for s in range(4))
            if rows:
                yield _batch(rows, out)

    ordered = mine.join(_matrices(pieces), "signature").select("conv", "part", "seq", "matrix").repartition("conv")
    return ordered.sortWithinPartitions("conv", F.desc("part"), F.desc("seq")).mapInArrow(run, "part int, seq long, follow string, tail boolean")


def _automaton(keys: DataFrame) -> DataFrame:
    """Audits and last states, by the state on entry, of each distinct signature with what follows it."""
    schema = "signature string, follow string, tail boolean, audits array<string>, exits array<int>"
    out = _arrow(schema, keys.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings, at = None, None
        for batch in batches:
            rows = []
            for signature, follow, tail in zip(*(batch.column(c).to_pylist() for c in ("signature", "follow", "tail")), strict=True):
                if at != (follow, tail):
                    at = (follow, tail)
                    costs = tuple(map(int, follow.split(",")))
                    endings = Endings((costs, END_AUDIT, END_STATE) if tail else (costs, ("",) * 4, range(4)), _audited)
                node = endings.node(signature)
                rows.append((signature, follow, tail, list(node[1]), list(node[2])))
            if rows:
                yield _batch(rows, out)

    order = ["tail", "follow", "back"]
    distinct = keys.select("signature", "follow", "tail").distinct().withColumn("back", F.reverse("signature"))
    return distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("signature", "follow", "tail").mapInArrow(run, schema)


class RepairPlan:
    """Pieces of all conversations and the audits that repair them, written to the shared folder."""

    def __init__(self, rows: DataFrame, conversations: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece: int = PIECE):
        """``conversations`` (one column of that name) adds conversations that may have no messages."""
        spark = rows.sparkSession
        self.conv_col = conv_col
        self.conv = rows.schema[conv_col].dataType.simpleString()
        rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"))
        self.all = (rows.select("conv") if conversations is None else conversations.select(F.col(conv_col).alias("conv"))).distinct()
        schema = f"conv {self.conv}, {_PIECES}"
        folder = new_folder(spark, "pieces")
        _ordered(rows).mapInArrow(_cut_pieces(_arrow(schema, spark), piece), schema).write.parquet(folder)
        self.pieces = spark.read.schema(schema).parquet(folder)

    def records(self) -> DataFrame:
        """All records of each conversation in one partition, in order: itself, then audits and bodies of its pieces."""
        keys = self.pieces.select("part", "seq", "signature").join(_chained(self.pieces), ["part", "seq"], "left")
        keys = keys.select("part", "seq", "signature", F.coalesce("follow", F.lit(",".join(map(str, END)))).alias("follow"), F.coalesce("tail", F.lit(True)).alias("tail"))
        audits = keys.join(_automaton(keys), ["signature", "follow", "tail"]).select("part", "seq", "audits", "exits")
        audits = self.pieces.select("conv", "part", "seq").join(audits, ["part", "seq"]).withColumn("kind", F.lit(1))
        bodies = self.pieces.withColumn("kind", F.lit(2))
        itself = self.all.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("seq"), F.lit(0).alias("kind"))
        every = itself.unionByName(audits, allowMissingColumns=True).unionByName(bodies, allowMissingColumns=True)
        return every.repartition("conv").sortWithinPartitions("conv", "part", "seq", "kind")

    def messages(self) -> DataFrame:
        """The repaired conversations: ``place`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I) of each message."""
        schema = f"conv {self.conv}, place long, role string, text string, edit string"
        out = _arrow(schema, self.pieces.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, chars, place, now = [], 0, 0, None
            for event, conv, value in _walk(batches):
                if event == "begin":
                    place, now = 0, conv
                elif event == "message":
                    rows.append((now, place, *value))
                    place, chars = place + 1, chars + len(value[1])
                    if len(rows) >= 4096 or chars >= CHARS:
                        yield _batch(rows, out)
                        rows, chars = [], 0
            if rows:
                yield _batch(rows, out)

        return self.records().mapInArrow(run, schema).withColumnRenamed("conv", self.conv_col)

    def report(self) -> DataFrame:
        """Faults, cost, audit and the digest of the repaired messages (``role:text`` lines) of each conversation."""
        schema = f"conv {self.conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
        out = _arrow(schema, self.pieces.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            digest, first = hashlib.sha256(), True
            for event, conv, value in _walk(batches):
                if event == "begin":
                    digest, first = hashlib.sha256(), True
                elif event == "message":
                    digest.update(f"{'' if first else chr(10)}{value[0]}:{value[1]}".encode())
                    first = False
                else:
                    rows.append((conv, *value, digest.hexdigest()))
                    if len(rows) >= 4096:
                        yield _batch(rows, out)
                        rows = []
            if rows:
                yield _batch(rows, out)

        return self.records().mapInArrow(run, schema).withColumnRenamed("conv", self.conv_col)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Events of ordered records: ("begin", conv, None), ("message", conv, (role, text, edit)), ("end", conv, counts and audit)."""
    open_ = zstandard.ZstdDecompressor()
    now, begun = None, False
    names = ("conv", "kind", "audits", "exits", "signature", "bodies", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")
    state, cost, audit, audits, exits = START, 0, [], None, None
    faults, last, low, high, turns = [0] * 4, None, None, None, 0

    def ended() -> tuple:
        return (high - low + 1 - turns if turns else 0, *faults, cost, "".join(audit))

    for batch in batches:
        for conv, kind, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if not begun or conv != now:
                if begun:
                    yield "end", now, ended()
                now, begun = conv, True
                state, cost, audit = START, 0, []
                faults, last, low, high, turns = [0] * 4, None, None, None, 0
                yield "begin", now, None
            if kind == 1:
                audits, exits = rest[0], rest[1]
            elif kind == 2:
                signature, bodies, *counts = rest[2:]
                letters = audits[state]
                after = exits[state]
                audit.append(letters)
                faults = [a + b for a, b in zip(faults, counts[:4], strict=True)]
                first, final, lowest, highest, number = counts[4:]
                faults[3] += last is not None and last + first not in LEGAL
                last = final
                if number:
                    turns += number - (high == lowest)
                    low, high = lowest if low is None else low, highest
                body = iter(json.loads(open_.decompress(bodies)))
                at = 0
                for letter in letters:
                    if letter == "I":
                        cost += INSERT
                        yield "message", now, (NEXT[state], "", "I")
                        state = AFTER[state]
                        continue
                    sign = signature[at]
                    at += 1
                    role, text = next(body) if sign != GONE else (None, None)
                    if letter == "D":
                        cost += DELETE
                        continue
                    cost += TRUNCATED if sign.isupper() else 0
                    if letter == "K":
                        cost += KEEP
                        state = STEPS[state, sign.lower()]
                    else:
                        cost += REROLE
                        role = NEXT[state]
                        state = AFTER[state]
                    yield "message", now, (role, text, letter)
                if state != after:
                    raise RuntimeError("an audit does not end where its automaton says")
    if begun:
        yield "end", now, ended()


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the hash of (conversation, turn) picks."""

    def key(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations, damaged first."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return RepairPlan(damaged(rows), rows.select("conv_id")).report()
