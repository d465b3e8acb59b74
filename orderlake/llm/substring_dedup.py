"""Exact removal of repeated word windows by super-k-mer partitioning.

Consecutive windows of a document that share a minimiser (the smallest hash of their two-word
pieces) form a run, the super-k-mer. A run travels as one packed string to the bucket of its
minimiser; there the windows of all runs of one minimiser are sorted, and equal neighbours give the
smallest document that holds each window. Documents are dealt to groups by hash; equal runs of a group
travel once, with the smallest and largest document that has them, so thousands of copies cost a run for
each group. The buckets answer to the groups, which hold the texts and cut their runs again to find the
words that are covered.

Minimisers that hold more than one run in ``HEAVY_SHARE`` of a task (and enough of them over all
tasks) are split: each of their windows travels alone, to the bucket of the window's own hash. The
result is the same either way; only the route differs.

Runs are matched by two 64-bit hashes (route and content), windows by their bytes. Hashes are worked out
again from the words where a run arrives, so they don't travel.

Defined results: null text has no words; fewer words than a window, nothing is removed; a null id
is never earlier than another id and its document stays whole; repeated rows give equal rows;
different texts under one id are separate documents of that id; empty input, empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.packed import pack_text, unpack
from orderlake.llm.storage import cut
from orderlake.llm.words import Words, mix, multipliers, ragged, sequence_hash, slices, words

WINDOW = 13
PIECE = 2
#: Bytes of words for each bucket, before runs overlap.
BUCKET_BYTES = 2 << 20
#: Bytes of text in a group of documents: equal runs of a group travel once.
GROUP_BYTES = 4 << 20
#: A minimiser with more than one in so many runs of a group's worth of text is reported as heavy.
HEAVY_SHARE = 4096
#: Heavy minimisers with fewer runs than this in all, or than one in 100,000, need no split.
HEAVY_RUNS = 10_000
#: Windows in one packed string, so that a text of one repeated word doesn't make one huge row.
LONGEST = 256

U = np.uint64


def _pieces(h: np.ndarray) -> np.ndarray:
    """Hash of the words from each place on that make a piece."""
    m = multipliers(PIECE, 7)
    g = np.zeros(len(h) - PIECE + 1, U)
    for k in range(PIECE):
        g += h[k : len(h) - PIECE + 1 + k] * m[k]
    return mix(g)


def _least(h: np.ndarray, window: int) -> np.ndarray:
    """Minimiser of the window from each place on."""
    least, width, span = _pieces(h), 1, window - PIECE + 1
    while width * 2 <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = span - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def runs(w: Words, window: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows, route and content hash of each run of these texts."""
    h = w.hashes()
    n = len(h) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(U), none.astype(U)
    least = _least(h, window)
    valid = w.row[:n] == w.row[window - 1 :]
    alone = np.isin(least, hot)
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (w.row[1:n] != w.row[: n - 1]) | alone[1:]
    start = np.flatnonzero(begins)
    if not len(start):
        return none, none, none.astype(U), none.astype(U)
    number = np.add.reduceat(valid.astype(np.int64), start)
    if (long := number > LONGEST).any():
        parts = np.where(long, -(-number // LONGEST), 1)
        step = np.arange(int(parts.sum())) - np.repeat(np.concatenate(([0], np.cumsum(parts)[:-1])), parts)
        start, number = np.repeat(start, parts) + step * LONGEST, np.repeat(number, parts)
        number = np.minimum(LONGEST, number - step * LONGEST)
    route = least[start].copy()
    if (single := alone[start]).any():
        route[single] = sequence_hash(h, start[single], np.full(int(single.sum()), window), 5)
    return start, number, route, sequence_hash(h, start, number + window - 1, 3)


def _heavy(docs: DataFrame, text_col: str, window: int) -> tuple[np.ndarray, int]:
    """Minimisers to split, at most 100,000, and the bytes of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, most=GROUP_BYTES):
                w = words(part.column(text_col))
                _, _, route, _ = runs(w, window, np.zeros(0, U))
                m, k = np.unique(route, return_counts=True)
                keep = k >= max(8, len(route) // HEAVY_SHARE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*m[keep].astype(np.int64).tolist(), None], pa.int64()),
                        pa.array([*k[keep].tolist(), len(route)], pa.int64()),
                        pa.array([*[0] * int(keep.sum()), int(w.lengths.sum() + len(w.starts))], pa.int64()),
                    ],
                    names=["route", "runs", "bytes"],
                )

    found = docs.select(text_col).mapInArrow(count, "route long, runs long, bytes long")
    sums = cut(found.groupBy("route").agg(F.sum("runs").alias("runs"), F.sum("bytes").alias("bytes")))
    total = sums.filter("route is null").select("runs", "bytes").first()
    if total is None:
        return np.zeros(0, U), 0
    least = max(HEAVY_RUNS, total["runs"] // 100_000)
    hot = [r["route"] for r in sums.filter(f"route is not null and runs >= {least}").select("route").toLocalIterator()]
    return np.array(sorted(hot), dtype=np.int64).astype(U), total["bytes"]


def _described(w: Words, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Route and content hash of packed runs, one a row; the same as where they were cut."""
    h = w.hashes()
    count = np.diff(w.first)
    content = sequence_hash(h, w.first[:-1], count, 3)
    route = sequence_hash(h, w.first[:-1], count, 5)
    kept = np.flatnonzero(~alone)
    if len(kept):
        g = _pieces(h)
        size = count[kept] - PIECE + 1
        route[kept] = np.minimum.reduceat(g[ragged(w.first[kept], size)], np.concatenate(([0], np.cumsum(size)[:-1])))
    return route, content


def _payload(press: zstandard.ZstdCompressor, low: np.ndarray, high: np.ndarray, alone: np.ndarray, texts: list[bytes]) -> bytes:
    """Runs as one string: smallest and largest document, whether alone, length, texts."""
    head = np.stack([low.astype(U), (high - low).astype(U), alone.astype(U), np.array([len(t) for t in texts], U)])
    return press.compress(np.ascontiguousarray(head.view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1)).tobytes() + b"".join(texts))


def _opened(payload: bytes, n: int) -> tuple[np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    head = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 32 * n).reshape(4, 8, n).transpose(0, 2, 1)).view(U)[:, :, 0].astype(np.int64)
    ends = np.cumsum(head[3]) + 32 * n
    return head[:3], [raw[b - k : b] for b, k in zip(ends.tolist(), head[3].tolist(), strict=True)]


def _send(table: pa.Table, window: int, hot: np.ndarray, buckets: int) -> pa.Table:
    """Distinct runs of a group of documents, packed for each bucket."""
    group = table["part"][0].as_py()
    routes, contents, docs, singles, texts = [], [], [], [], []
    for part in table.filter(pc.is_valid(table["doc"])).combine_chunks().to_batches(max_chunksize=256):
        w = words(unpack(part.column("packed")))
        start, number, route, content = runs(w, window, hot)
        if len(start):
            text, at = w.joined()
            ends = at[start + number + window - 1] - 1
            texts += [text[a:b] for a, b in zip(at[start].tolist(), ends.tolist(), strict=True)]
            docs.append(part.column("doc").to_numpy()[w.row[start]])
            singles.append(np.isin(_least(w.hashes(), window)[start], hot))
            routes.append(route)
            contents.append(content)
    out: tuple[list, list, list] = ([], [], [])
    if texts:
        route, content, doc, alone = (np.concatenate(x) for x in (routes, contents, docs, singles))
        order = np.lexsort((doc, content, route))
        r, c, d = route[order], content[order], doc[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
        begin = np.flatnonzero(new)
        low, high, pick = d[begin], d[np.append(begin[1:], len(r)) - 1], order[begin]
        bucket = (mix(r[begin]) % U(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1])), len(by))
        press = zstandard.ZstdCompressor(level=3)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = by[a:b]
            out[0].append(int(bucket[own[0]]))
            out[1].append(len(own))
            out[2].append(_payload(press, low[own], high[own], alone[pick[own]], [texts[k] for k in pick[own]]))
    return pa.table({"bucket": pa.array(out[0], pa.int64()), "part": pa.array([group] * len(out[0]), pa.int64()), "n": pa.array(out[1], pa.int32()), "payload": pa.array(out[2], pa.binary())})


def _sort_bucket(table: pa.Table, window: int) -> pa.Table:
    """For each group of documents, its runs that hold a repeated window, and the first document of each window."""
    heads, texts, routes, contents, groups = [], [], [], [], []
    for payload, n, group in zip(table["payload"].to_pylist(), table["n"].to_pylist(), table["part"].to_pylist(), strict=True):
        head, own = _opened(payload, n)
        route, content = _described(words(pa.array(own, pa.binary()).cast(pa.large_string())), head[2] > 0)
        texts += own
        heads.append(head[:2])
        routes.append(route)
        contents.append(content)
        groups.append(np.full(n, group, np.int64))
    low, high = np.concatenate(heads, axis=1)
    high = low + high
    route, content, group = (np.concatenate(x) for x in (routes, contents, groups))
    order = np.lexsort((content, route))
    r, c, low, high, group = route[order], content[order], low[order], high[order], group[order]
    same_route = np.append(True, r[1:] != r[:-1])
    begin = np.flatnonzero(same_route | np.append(True, c[1:] != c[:-1]))
    lowest, highest = np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
    ends = np.append(begin[1:], len(r))
    edges = np.flatnonzero(same_route[begin])
    shared = np.flatnonzero(np.minimum.reduceat(lowest, edges) < np.maximum.reduceat(highest, edges))
    edges = np.append(edges, len(begin))
    out: tuple[list, list, list, list] = ([], [], [], [])
    for g in shared.tolist():
        windows, firsts = [], {}
        for k in range(edges[g], edges[g + 1]):
            text = texts[order[begin[k]]].split(b" ")
            count = len(text) - window + 1
            firsts[k] = [0] * count
            doc = int(lowest[k])
            windows += [(b" ".join(text[j : j + window]), doc, k, j) for j in range(count)]
        windows.sort()
        before, first = None, 0
        for key, doc, k, j in windows:
            if key != before:
                before, first = key, doc
            firsts[k][j] = first
        for k, own in firsts.items():
            least = min(own)
            for i in range(begin[k], ends[k]):
                if least < high[i]:
                    out[0].append(int(group[i]))
                    out[1].append(int(r[i].astype(np.int64)))
                    out[2].append(int(c[i].astype(np.int64)))
                    out[3].append(own)
    return pa.table({"part": pa.array(out[0], pa.int64()), "route": pa.array(out[1], pa.int64()), "content": pa.array(out[2], pa.int64()), "firsts": pa.array(out[3], pa.list_(pa.int64()))})


def _covered(w: Words, docs: np.ndarray, known: np.ndarray, window: int, hot: np.ndarray, found: dict[str, np.ndarray]) -> np.ndarray:
    """Which words of these texts lie in a window that a smaller document has."""
    cover = np.zeros(len(w.starts) + 1, np.int64)
    start, number, route, content = runs(w, window, hot)
    if len(start) and len(found["key"]):
        key = mix(route) + content
        at = np.searchsorted(found["key"], key)
        at[at == len(found["key"])] = 0
        hit = (found["key"][at] == key) & (found["route"][at] == route) & known[w.row[start]]
        start, number, at = start[hit], number[hit], at[hit]
        first = found["firsts"][ragged(found["begin"][at], number)]
        place = ragged(start, number)
        place = place[first < np.repeat(docs[w.row[start]], number)]
        cover += np.bincount(place, minlength=len(cover)) - np.bincount(np.minimum(place + window, len(cover) - 1), minlength=len(cover))
    return np.cumsum(cover)[:-1] > 0


def _rewrite(docs: pa.Table, shared: pa.Table, window: int, hot: np.ndarray, id_col: str) -> pa.Table:
    """Documents of a group without the covered words."""
    lists = shared["firsts"].combine_chunks()
    route, content = (shared[c].to_numpy().astype(np.int64).astype(U) for c in ("route", "content"))
    key = mix(route) + content
    order = np.argsort(key, kind="stable")
    found = {"key": key[order], "route": route[order], "begin": lists.offsets.to_numpy()[:-1][order], "firsts": lists.values.to_numpy().astype(np.int64)}
    out = []
    for part in docs.combine_chunks().to_batches(max_chunksize=256):
        w = words(unpack(part.column("packed")))
        ids = part.column("doc")
        gone = _covered(w, ids.fill_null(0).to_numpy().astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False), window, hot, found)
        removed = np.bincount(w.row[gone], minlength=part.num_rows)
        text, at = w.joined()
        pieces = []
        for r in range(part.num_rows):
            a, b = int(w.first[r]), int(w.first[r + 1])
            if not removed[r]:
                pieces.append(text[at[a] : max(at[a], at[b] - 1)])
            else:
                pieces.append(b" ".join([text[at[j] : at[j + 1] - 1] for j in (np.flatnonzero(~gone[a:b]) + a).tolist()]))
        out.append(
            pa.table(
                {
                    id_col: ids, "kept_text": pa.array([p.decode() for p in pieces], pa.string()), "n_words": pa.array(np.diff(w.first).astype(np.int64)),
                    "n_removed": pa.array(removed.astype(np.int64)), "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
                }
            )
        )
    schema = pa.schema([(id_col, pa.int64()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    return pa.concat_tables(out) if out else schema.empty_table()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Each document without the words that repeated windows cover: id, ``kept_text``, ``n_words``, ``n_removed``, ``kept_sha256``."""
    hot, size = _heavy(docs.select(text_col), text_col, window)
    buckets, groups = max(1, size // BUCKET_BYTES), max(1, size // GROUP_BYTES)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"))
    rows = pack_text(rows.withColumn("part", F.pmod(F.xxhash64("doc", "body"), F.lit(groups))), "body")
    # both uses of the groups share one exchange
    sent = rows.groupBy("part").applyInArrow(lambda table: _send(table, window, hot, buckets), "bucket long, part long, n int, payload binary")
    shared = sent.groupBy("bucket").applyInArrow(lambda table: _sort_bucket(table, window), "part long, route long, content long, firsts array<long>")
    schema = f"`{id_col}` long, kept_text string, n_words long, n_removed long, kept_sha256 string"
    return rows.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(lambda own, found: _rewrite(own, found, window, hot, id_col), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that an earlier document's 13-word window covers, removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).drop("kept_text")


#: A window is written as its words joined by one space; words hold no space.
OP1_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), win AS (
  SELECT r, doc_id, s, array_to_string(ws[s:s + 12], ' ') AS key
  FROM (SELECT r, doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS s FROM w)
), firsts AS (
  SELECT md5(key) AS k, min(doc_id) AS first FROM win GROUP BY 1
), gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 13)) AS p
  FROM win JOIN firsts ON md5(key) = k WHERE first < doc_id
), per AS (
  SELECT r, list(p) AS ps FROM gone GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN per USING (r)
"""
