"""Conversations in reply order, without quotations, from quoted passages linked to their originals.

Lines that begin with ``>`` marks are quoted; the number of marks is their level. Consecutive lines of a
level, without blank ones between them, are a passage (of level 0: a paragraph of the message's own
text). Passages are normalised (lower case, white space joined) and hashed, as a whole and line by line.
The original of a hash is the earliest message of the conversation that has it as a whole own text, a
paragraph or a line; passages are joined to originals by conversation and hash. A message replies to
the original of most of its level-1 lines (a passage that matches as a whole counts one more), to the
latest of them if several have as many. A line such as "On Monday Ann wrote:" before a quotation goes
with it.

Following replies upwards, with steps that double in length, gives each message the first message of its
thread and its depth. Messages are ordered by conversation, first message of the thread, and turn, so a
reply always comes after what it replies to; the order is a global sort, so a conversation of any size
lies over as many tasks as it needs.

All joins are many to one on small aggregates; only DataFrame functions run.

Defined results: null and empty texts have no own text and no quotations; messages with a null
conversation or turn keep their row, link to nothing and begin a thread of their own; rows with the same
conversation and turn are one message said in parts: all get the same link, repeated rows stay; no rows,
no result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.storage import cut

#: Marks at the beginning of a quoted line.
MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: A line that announces a quotation.
ANNOUNCES = r"^(on|am|le|el)[ ,].*(wrote|schrieb|écrit|escribió).*:$"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` worked out once: a projection of its own could be inlined at every use."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _parts(rows: DataFrame, text_col: str) -> DataFrame:
    """Adds ``own_text``, ``runs`` (level, lines), ``n_quoted`` and ``quote_depth`` to each row."""
    marks = MARKS.replace("\\", "\\\\")
    line = _let(
        f"regexp_extract(l, '{marks}', 1)", "m",
        "named_struct('level', length(m) - length(replace(m, '>', '')), 'raw', l, 'norm', lower(trim(regexp_replace(if(m = '', l, substr(ltrim(' \\t', l), length(m) + 1)), '[ \\t\\r]+', ' '))))",
    )
    lines = f"transform(split(coalesce({text_col}, ''), '\\r?\\n', -1), l -> {line})"
    quiet = f"""transform(p, (x, i) -> if(x.level = 0 and coalesce(get(p, i + 1).level, 0) > 0 and x.norm rlike '{ANNOUNCES}',
        named_struct('level', -1, 'raw', x.raw, 'norm', x.norm), x))"""
    begins = """filter(sequence(0, size(q) - 1), i -> i = 0 or q[i].level <> q[i - 1].level or q[i].norm = '' or q[i - 1].norm = '')"""
    runs = """filter(transform(b, (s, k) -> named_struct('level', q[s].level, 'lines', transform(slice(q, s + 1, coalesce(get(b, k + 1), size(q)) - s), x -> x.norm))),
        r -> r.level >= 0 and r.lines[0] <> '')"""
    own = "regexp_replace(array_join(transform(filter(q, x -> x.level = 0), x -> x.raw), '\\n'), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '')"
    found = f"""named_struct('runs', r, 'own', {own}, 'quoted', cast(size(filter(r, x -> x.level > 0)) as long),
        'deep', cast(coalesce(array_max(transform(r, x -> x.level)), 0) as long))"""
    whole = _let(lines, "p", _let(quiet, "q", _let(begins, "b", _let(runs, "r", found))))
    return rows.withColumn("parsed", F.expr(whole)).select(
        *[c for c in rows.columns if c != text_col], F.col("parsed.runs").alias("runs"), F.col("parsed.own").alias("own_text"), F.col("parsed.quoted").alias("n_quoted"), F.col("parsed.deep").alias("quote_depth")
    )


def _units(parts: DataFrame) -> DataFrame:
    """Hashes of whole passages and paragraphs, of their lines, and of whole own texts."""
    runs = parts.filter("conv is not null and turn is not null").select("conv", "turn", F.posexplode("runs").alias("place", "run"))
    pieces = F.expr(
        """concat(array(named_struct('norm', array_join(run.lines, ' '), 'whole', true, 'weight', if(size(run.lines) > 1, 1, 2))),
            if(size(run.lines) > 1, transform(run.lines, x -> named_struct('norm', x, 'whole', false, 'weight', 1)), array()))"""
    )
    by_line = runs.select("conv", "turn", "place", F.col("run.level").alias("level"), F.explode(pieces).alias("p"))
    whole = parts.filter("conv is not null and turn is not null").select(
        "conv", "turn", F.expr("flatten(transform(filter(runs, r -> r.level = 0), r -> r.lines))").alias("lines")
    )
    whole = whole.filter(F.size("lines") > 1).select("conv", "turn", F.lit(-1).alias("place"), F.lit(0).alias("level"), F.struct(F.array_join("lines", " ").alias("norm"), F.lit(True).alias("whole"), F.lit(0).alias("weight")).alias("p"))
    return by_line.unionByName(whole).select("conv", "turn", "place", "level", F.md5(F.col("p.norm").cast("binary")).alias("h"), "p.whole", "p.weight")


def _threads(links: DataFrame) -> DataFrame:
    """First message of the thread and depth of every message that replies; links are (conv, turn, up)."""
    now = cut(links.select("conv", "turn", "up", F.lit(1).alias("depth")))
    while True:
        above = now.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv", "up"], "left")
        moved = joined.select("conv", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        moved = cut(moved)
        if moved.filter("moved").isEmpty():
            return moved.select("conv", "turn", F.col("up").alias("top"), "depth")
        now = moved.drop("moved")


def link_quotations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each message, in reply order.

    ``own_text`` without quotations, ``formatted`` with the role, ``n_quoted`` passages, ``n_linked``
    distinct whole passages with an original, ``quote_depth``, ``reply_to`` (a turn), ``thread_turn``
    (first message of the thread) and ``depth`` there.
    """
    parts = _parts(rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("body")), "body")
    units = _units(parts)
    quoted = cut(units.filter("level > 0"))
    origin = units.filter("level = 0").join(quoted.select("conv", "h").distinct(), ["conv", "h"], "left_semi")
    origin = origin.groupBy("conv", "h").agg(F.min("turn").alias("up"))
    linked = cut(quoted.join(origin, ["conv", "h"]).filter("up < turn").select("conv", "turn", "level", "h", "whole", "weight", "up"))
    votes = linked.filter("level = 1").groupBy("conv", "turn", "up").agg(F.sum("weight").alias("w")).groupBy("conv", "turn").agg(F.max(F.struct("w", "up")).alias("best"))
    replies = cut(votes.select("conv", "turn", F.col("best.up").alias("up")))
    threads = _threads(replies)
    passages = linked.filter("whole").groupBy("conv", "turn").agg(F.countDistinct("level", "h").alias("n_linked"))
    per = replies.join(threads, ["conv", "turn"]).join(passages, ["conv", "turn"], "full")
    return (
        parts.join(per, ["conv", "turn"], "left")
        .select(
            F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), "own_text",
            F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("own_text")).alias("formatted"),
            "n_quoted", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "quote_depth",
            F.col("up").alias("reply_to"), F.coalesce("top", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        )
        .orderBy(conv_col, "thread_turn", turn_col)
    )


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotations."""
    return link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP6_SQL = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, regexp_split_to_array(coalesce(text, ''), '\r?\n') AS ls FROM conversations
), raw AS (
  SELECT r, conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM m
), marked AS (
  SELECT *, len(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1)) - len(replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '>', '')) AS lv,
         lower(trim(regexp_replace(regexp_replace(line, '^[ \t]*((?:>[ \t]?)+)', ''), '[ \t\r]+', ' ', 'g'))) AS norm
  FROM raw
), lines AS (
  SELECT *, CASE WHEN lv = 0 AND coalesce(lead(lv) OVER (PARTITION BY r ORDER BY i), 0) > 0
                  AND regexp_matches(norm, '^(on|am|le|el)[ ,].*(wrote|schrieb|écrit|escribió).*:$') THEN -1 ELSE lv END AS level
  FROM marked
), grouped AS (
  SELECT *, sum(b) OVER (PARTITION BY r ORDER BY i) AS g FROM (
    SELECT *, CASE WHEN i = 1 OR level <> lag(level) OVER w OR norm = '' OR lag(norm) OVER w = '' THEN 1 ELSE 0 END AS b
    FROM lines WINDOW w AS (PARTITION BY r ORDER BY i))
), runs AS (
  SELECT r, conv_id, turn, g, level, string_agg(norm, ' ' ORDER BY i) AS norm, count(*) AS n
  FROM grouped WHERE norm <> '' AND level >= 0 GROUP BY ALL
), units AS (
  SELECT r, conv_id, turn, g, level, norm, true AS whole, CASE WHEN n > 1 THEN 1 ELSE 2 END AS weight FROM runs
  UNION ALL
  SELECT x.r, x.conv_id, x.turn, x.g, x.level, x.norm, false, 1 FROM grouped x JOIN runs USING (r, g) WHERE n > 1 AND x.norm <> ''
  UNION ALL
  SELECT r, conv_id, turn, -1, 0, string_agg(norm, ' ' ORDER BY i), true, 0 FROM grouped WHERE level = 0 AND norm <> '' GROUP BY r, conv_id, turn
), origin AS (
  SELECT conv_id, norm, min(turn) AS up FROM units WHERE level = 0 GROUP BY 1, 2
), linked AS (
  SELECT u.*, up FROM units u JOIN origin o ON u.conv_id = o.conv_id AND u.norm = o.norm WHERE level > 0 AND up < turn
), votes AS (
  SELECT conv_id, turn, up, sum(weight) AS w FROM linked WHERE level = 1 GROUP BY ALL
), replies AS (
  SELECT conv_id, turn, up FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY w DESC, up DESC) = 1
), walk AS (
  SELECT conv_id, turn, up AS top, 1 AS depth FROM replies
  UNION ALL
  SELECT w.conv_id, w.turn, p.up, depth + 1 FROM walk w JOIN replies p ON w.conv_id = p.conv_id AND w.top = p.turn
), threads AS (
  SELECT conv_id, turn, arg_max(top, depth) AS top, max(depth) AS depth FROM walk GROUP BY 1, 2
), passages AS (
  SELECT conv_id, turn, count(DISTINCT (level, norm)) AS n FROM linked WHERE whole GROUP BY 1, 2
), own AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (level = 0) AS t, coalesce(max(level) FILTER (norm <> '' AND level >= 0), 0) AS deep FROM grouped GROUP BY r
), counted AS (
  SELECT r, count(*) FILTER (level > 0) AS n FROM runs GROUP BY r
)
SELECT m.conv_id, m.turn, m.role, s.own_text, '<|' || coalesce(m.role, '') || '|>' || chr(10) || s.own_text AS formatted,
       CAST(coalesce(counted.n, 0) AS BIGINT) AS n_quoted, CAST(coalesce(passages.n, 0) AS BIGINT) AS n_linked, CAST(s.deep AS BIGINT) AS quote_depth,
       replies.up AS reply_to, coalesce(threads.top, m.turn) AS thread_turn, CAST(coalesce(threads.depth, 0) AS BIGINT) AS depth
FROM m
JOIN (SELECT r, deep, regexp_replace(coalesce(t, ''), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS own_text FROM own) s USING (r)
LEFT JOIN counted USING (r)
LEFT JOIN replies ON m.conv_id = replies.conv_id AND m.turn = replies.turn
LEFT JOIN threads ON m.conv_id = threads.conv_id AND m.turn = threads.turn
LEFT JOIN passages ON m.conv_id = passages.conv_id AND m.turn = passages.turn
"""
