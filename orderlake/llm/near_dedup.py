"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct shingles of lower-cased words (with fewer words than
a shingle, the whole sequence as one). A sketch has one coordinate for each of t bins. In round i every
element is thrown into a hashed bin with a hashed value, and each bin keeps its smallest (round, value);
t rounds of random bins are followed by t rounds that throw every element into bin 0, 1, ..., so each
coordinate is filled for sure, and rounds stop as soon as all of a document's bins are full. Agreeing
coordinates estimate the Jaccard similarity with the concentration of independent ones. Bands of
consecutive coordinates are hash-joined to candidates, which are confirmed on their whole sets.

Equal sets are merged first: only the smallest document of each goes on. In a bucket (a band's key)
every document is compared with the bucket's smallest one. The links found give components. Buckets
that still hold several components are compared once more, in blocks inside tasks: the documents
outside the bucket's largest component against all of the bucket, but for pairs already connected.
So all candidates of different components are compared, while a group of near copies costs its
number of documents, and pairs of a group are never written out.

Chance of missing a pair at the similarity itself: ``MISS`` at most by the choice of bands.

Defined results: null, empty and blank texts have no shingles, are linked with nothing and kept; a
null id is linked with nothing and kept, with a null component; repeated rows give equal rows; rows
of one id with different texts are judged each by its own text; no rows, no result. Other columns are
not read. ``drop_near_duplicates`` compares rows with null ids as well and prefers any id to null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.lean import lean
from orderlake.llm.packed import pack_text, unpack
from orderlake.llm.storage import cut
from orderlake.llm.words import mix, multipliers, sequence_hash, slices, words

#: Largest chance that a pair at the threshold shares no band.
MISS = 1e-6
#: Documents of a block outside the largest component, and of the rest.
OUTSIDE, MEMBERS = 256, 2048
#: Bytes of compressed texts opened at once.
FRAMES = 1 << 18
#: Distinct shingles compared at once in a block.
COLUMNS = 4096

U = np.uint64


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and rows in each."""
    rows = 5 if percent >= 85 else 4
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows)), rows


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of all distinct shingles, in that order."""
    w = words(column, lower=True)
    h = w.hashes()
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    row, value = [short], [sequence_hash(h, w.first[short], count[short], 11)]
    n = len(h) - k + 1
    if n > 0:
        whole = w.row[:n] == w.row[k - 1 :]
        m = multipliers(k, 13)
        s = h[:n] * m[0]
        for j in range(1, k):
            s = s + h[j : n + j] * m[j]
        row.append(w.row[:n][whole])
        value.append(mix(s[whole]))
    row, value = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def packed_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of compressed texts, opened a few at a time."""
    batch = pa.RecordBatch.from_arrays([column], names=["packed"])
    rows, values, at = [np.zeros(0, np.int64)], [np.zeros(0, U)], 0
    for part in slices(batch, "packed", most=FRAMES):
        row, value = shingle_sets(unpack(part.column("packed")), k)
        rows.append(row + at)
        values.append(value)
        at += part.num_rows
    return np.concatenate(rows), np.concatenate(values)


def sketches(row: np.ndarray, value: np.ndarray, rows: int, t: int) -> np.ndarray:
    """rows x t coordinates; rows without elements stay at the largest number."""
    out = np.full((rows, t), np.iinfo(U).max, U)
    flat = out.reshape(-1)
    for i in range(2 * t):
        if not len(row):
            break
        h = mix(value + U(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        bins = ((h & U(0xFFFF)) * U(t) >> U(16)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, row * t + bins, U(i) << U(48) | h >> U(16))
        present = np.unique(row)
        open_ = np.zeros(rows, bool)
        open_[present] = (out[present] == np.iinfo(U).max).any(axis=1)
        live = open_[row]
        row, value = row[live], value[live]
    return out


def _described(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """Size, digest and band keys of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, place = multipliers(bands, 17), multipliers(rows, 19)
        for batch in batches:
            for part in slices(batch, "body"):
                row, value = shingle_sets(part.column("body"), k)
                size = np.bincount(row, minlength=part.num_rows).astype(np.int64)
                first = np.concatenate(([0], np.cumsum(size)[:-1]))
                s = sketches(row, value, part.num_rows, bands * rows).reshape(part.num_rows, bands, rows)
                keys = mix((mix(s) * place[None, None, :]).sum(axis=2, dtype=U) + band[None, :]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"), part.column("th"), pa.array(size),
                        pa.array(sequence_hash(value, first, size, 23).astype(np.int64)), pa.array(sequence_hash(value, first, size, 29).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * bands, pa.int32()), pa.array(keys.reshape(-1))),
                    ],
                    names=["doc", "th", "n", "d1", "d2", "keys"],
                )

    return docs.mapInArrow(lean(run), "doc long, th long, n long, d1 long, d2 long, keys array<long>")


def _overlap(row_a: np.ndarray, a: np.ndarray, row_b: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """Size of the intersection in each row."""
    row, value = np.concatenate([row_a, row_b]), np.concatenate([a, b])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    return np.bincount(row[1:][twice], minlength=rows)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the similarity."""
    left = texts.select(F.col("node").alias("a"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("packed").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", "text_b", most=FRAMES):
                a, b = (packed_sets(part.column(c), k) for c in ("text_a", "text_b"))
                n = part.num_rows
                both = _overlap(*a, *b, n)
                union = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n) - both
                yield part.select(["a", "b"]).filter(pa.array((100 * both >= percent * union) & (union > 0)))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(lean(check), "a long, b long")


def _block_links(table: pa.Table, k: int, percent: int) -> pa.Table:
    """Links between a block's outside documents and its members: one for each document and component."""
    outside = table.filter(table["outside"]).combine_chunks()
    members = table.filter(pc.invert(table["outside"])).combine_chunks()
    n, m = outside.num_rows, members.num_rows
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not n or not m:
        return none
    sets = [packed_sets(t["packed"].combine_chunks(), k) for t in (outside, members)]
    size = [np.bincount(r, minlength=c) for (r, _), c in zip(sets, (n, m), strict=True)]
    common = np.intersect1d(sets[0][1], sets[1][1])
    both = np.zeros((n, m), np.float32)
    for c in range(0, len(common), COLUMNS):
        some = common[c : c + COLUMNS]
        dense = []
        for (row, value), count in zip(sets, (n, m), strict=True):
            at = np.searchsorted(some, value)
            at[at == len(some)] = 0
            hit = some[at] == value
            x = np.zeros((count, len(some)), np.float32)
            x[row[hit], at[hit]] = 1
            dense.append(x)
        both += dense[0] @ dense[1].T
    both = both.astype(np.int64)
    ca, cb = outside["comp"].to_numpy(), members["comp"].to_numpy()
    good = (100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)) & (ca[:, None] != cb[None, :])
    i, j = np.nonzero(good)
    if not len(i):
        return none
    _, one = np.unique(np.stack([i, cb[j]]), axis=1, return_index=True)
    return pa.table({"a": pa.array(ca[i[one]]), "b": pa.array(cb[j[one]])})


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, null_ids: bool = False) -> DataFrame:
    """``doc``, ``th`` (hash of the text) and ``n`` of every row, and ``least``, the smallest id of its component with its ``th``."""
    bands, rows = bands_for(percent)
    body = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("body"))
    described = cut(_described(body, shingle, bands, rows))
    known = described.filter("n > 0" if null_ids else "n > 0 and doc is not null")
    # a node is a set, not an id: an id may have several texts
    sets = known.groupBy("d1", "d2").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "th")).alias("one"), F.first("keys").alias("keys"))
    sets = cut(sets.select("d1", "d2", F.monotonically_increasing_id().alias("node"), "one", "keys"))

    spread = sets.select("node", F.explode("keys").alias("key"))
    least = spread.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("size")).filter("size > 1").drop("size")
    buckets = cut(spread.join(least, "key").select("key", "node", "lead"))

    wanted = buckets.select("node").distinct().join(sets, "node").select("node", F.col("one.doc").alias("own_doc"), F.col("one.th").alias("own_th"))
    searched = body.filter("body is not null" if null_ids else "doc is not null")
    texts = cut(pack_text(searched, "body").join(wanted, F.col("doc").eqNullSafe(F.col("own_doc")) & (F.col("th") == F.col("own_th"))).select("node", "packed").dropDuplicates(["node", "packed"]))

    pairs = buckets.filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    first = components(_confirmed(pairs, texts, shingle, percent))

    # buckets whose documents other than the smallest one lie in several components
    own = buckets.join(first, "node", "left")
    own = own.select("key", "node", "lead", F.coalesce("root", "node").alias("comp")).filter("node <> lead")
    per = own.groupBy("key", "comp").agg(F.count("*").alias("c"))
    per = per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("n"), F.count("*").alias("comps")).filter("comps > 1")
    per = per.select("key", F.col("top.comp").alias("main"), "n", (F.col("n") - F.col("top.c")).alias("out"))
    rest = own.join(per, "key").select(
        "key", "node", "comp", (F.col("comp") != F.col("main")).alias("far"),
        F.ceil(F.col("out") / OUTSIDE).cast("int").alias("outs"), F.ceil(F.col("n") / MEMBERS).cast("int").alias("parts"),
        F.abs(F.hash("node", F.lit(5))).alias("h"),
    )
    rest = cut(rest.join(texts, "node"))
    as_member = rest.select("key", F.explode(F.sequence(F.lit(0), F.col("outs") - 1)).alias("x"), (F.col("h") % F.col("parts")).alias("y"), F.lit(False).alias("outside"), "comp", "packed")
    as_outside = rest.filter("far").select("key", (F.col("h") % F.col("outs")).alias("x"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("y"), F.lit(True).alias("outside"), "comp", "packed")
    blocks = as_member.unionByName(as_outside).groupBy("key", "x", "y")
    later = blocks.applyInArrow(lambda table: _block_links(table, shingle, percent), "a long, b long")
    second = components(later).select(F.col("node").alias("root"), F.col("root").alias("last"))
    roots = first.join(second, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    alone = second.filter("root <> last").join(first.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("last").alias("root"))
    roots = roots.unionByName(alone)

    linked = roots.join(sets.select("node", "one"), "node")
    least = linked.groupBy("root").agg(F.min("one").alias("least"))
    linked = linked.join(least, "root").select("node", "least")
    groups = sets.join(linked, "node", "left").select("d1", "d2", F.coalesce("least", "one").alias("least"))
    return described.join(groups, ["d1", "d2"], "left").select("doc", "th", "n", F.when((F.col("n") > 0) & (F.lit(null_ids) | F.col("doc").isNotNull()), F.col("least")).alias("least"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Id, size of the set, ``component_id`` (smallest id reachable by links) and whether it is that id."""
    return (
        _grouped(docs, id_col, text_col, shingle, percent)
        .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least.doc", "doc").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of one text of each component, that of the smallest id (null is the largest); of equal ids and texts one row."""
    grouped = _grouped(docs, id_col, text_col, shingle, percent, null_ids=True)
    rows = grouped.groupBy("doc", "th").agg(F.count("*").alias("rows"), F.min("least").alias("least"))
    gone = F.col("least").isNotNull() & ~(F.col("least.doc").eqNullSafe(F.col("doc")) & (F.col("least.th") == F.col("th")))
    twice = (F.col("rows") > 1) & (F.col("doc").isNotNull() | F.col("least").isNotNull())
    marks = rows.select(F.col("doc").alias("d"), F.col("th").alias("t"), F.when(gone, "gone").when(twice, "twice").alias("mark")).filter("mark is not null")
    # the columns of the input under numbers, so that no name clashes
    own = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    numbered = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    marked = numbered.join(marks, F.col(own[id_col]).cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(own[text_col]) == F.col("t")), "left")
    named = [F.col(n).alias(c) for c, n in own.items()]
    once = marked.filter("mark is null").select(*named)
    return once.unionByName(marked.filter("mark = 'twice'").dropDuplicates([own[id_col], own[text_col]]).select(*named))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.85 on three-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)
