"""Spelling variants grouped through one-edit neighbourhoods in a reduced alphabet.

Words are counted in the JVM over all texts. Every letter is hashed to one of ``SYMBOLS`` symbols, so each
word of the vocabulary has a reduced word; one edit between two words is at most one edit between their
reduced words (none, if a letter is replaced by one of its own symbol). For each distinct reduced word the
full neighbourhood - itself, and every string one inserted, deleted or replaced symbol away - is written as
hashes, joined to the vocabulary's reduced words, and the words behind each pair of reduced words are
verified on the original strings inside the join condition, so candidates are never stored.

A reduced word is known by a polynomial hash: a neighbour's hash comes from a prefix, a symbol and a suffix
in constant time, for all words of a length and all places at once. Equal strings have equal hashes, so no
pair is lost; unequal ones with equal hashes are refused by the verification. Edits that give the same
string (a symbol inserted before or after its like) are written once.

A word's form is its near word of the largest count (ties: the smallest in code-point order) if that is
``RATIO`` times the word's count or more. Counts grow at least fivefold along a chain of forms, so a chain
has fewer than 32 steps and five rounds of doubling reach every root.

The vocabulary is written to the shared folder before it is joined: Spark then knows its size and chooses
between a broadcast (below its own threshold) and a shuffle of the neighbourhoods. Rows of very common
words are added up before the shuffle; a word has a bounded number of near words, so no key is hot after it.

Defined results: null and empty texts have no words; a null id has no hash, so nothing is deleted from its
words; repeated rows count each time; no rows, no result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.storage import cut, new_folder
from orderlake.llm.words import mix

#: Symbols of the reduced alphabet. A word of length L has about 2 * SYMBOLS * L neighbours; fewer symbols
#: mean fewer of them and more words behind each reduced word.
SYMBOLS = 6
LENGTH = 6
COUNT = 5
RATIO = 5
#: Every run whose hash this divides loses a letter.
DAMAGE = 199
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Doublings that cover the longest chain: log5(2**63) < 2**5.
DOUBLINGS = 5
#: Hashes worked out at once.
CHUNK = 1 << 20

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)


def damaged_runs(docs: DataFrame, least: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` for each maximal run of letters that has ``least`` code points after its damage."""
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)


def _symbols(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the places of its words in the list, and their symbols (from 1) as a matrix."""
    size = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    code = mix(points.astype(U)) % U(symbols) + U(1)
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    for n in np.unique(size):
        place = np.flatnonzero(size == n)
        step = max(1, CHUNK // max(1, int(n)))
        for k in range(0, len(place), step):
            part = place[k : k + step]
            yield part, code[start[part][:, None] + np.arange(n)]


def _powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, U)
    out[1:] = np.cumprod(np.full(n, BASE, U), dtype=U)
    return out


def reduced_hash(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The hash of each word's reduced word."""
    out = np.zeros(len(words), U)
    for place, code in _symbols(words, symbols):
        out[place] = mix((code * _powers(code.shape[1])[:-1][::-1]).sum(axis=1, dtype=U))
    return out.view(np.int64)


def neighbourhood(code: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and hashes of all reduced words at most one edit from the rows of ``code``."""
    n, size = code.shape
    power = _powers(size + 1)
    before = np.zeros((n, size + 1), U)  # hash of the first i symbols
    after = np.zeros((n, size + 1), U)  # hash of the symbols from i on
    for i in range(size):
        before[:, i + 1] = before[:, i] * BASE + code[:, i]
        j = size - 1 - i
        after[:, j] = code[:, j] * power[i] + after[:, j + 1]
    rows = np.arange(n)
    yield rows, mix(before[:, size])
    step = max(1, CHUNK // (n * symbols))
    every = np.arange(1, symbols + 1, dtype=U)
    for low in range(0, size + 1, step):
        i = np.arange(low, min(low + step, size + 1))
        fresh = (i == 0)[None, :, None] | (code[:, np.maximum(i - 1, 0)][:, :, None] != every)
        added = (before[:, i] * power[size + 1 - i] + after[:, i])[:, :, None] + every * power[size - i][:, None]
        yield np.broadcast_to(rows[:, None, None], fresh.shape)[fresh], mix(added[fresh])
        i = i[i < size]
        if not len(i):
            continue
        without = before[:, i] * power[size - 1 - i] + after[:, i + 1]
        first = (i == 0)[None, :] | (code[:, i] != code[:, np.maximum(i - 1, 0)])
        yield np.broadcast_to(rows[:, None], first.shape)[first], mix(without[first])
        other = code[:, i][:, :, None] != every
        changed = (before[:, i] * power[size - i] + after[:, i + 1])[:, :, None] + every * power[size - 1 - i][:, None]
        yield np.broadcast_to(rows[:, None, None], other.shape)[other], mix(changed[other])


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n`` for all pairs of words (both ways) that are one edit apart.

    ``vocabulary`` has ``word`` and ``n``; words are distinct and not null.
    """
    spark = vocabulary.sparkSession

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reduced_hash(batch.column("word").to_pylist(), symbols))], names=["word", "n", "r"])

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("r").to_numpy()
            for place, code in _symbols(batch.column("word").to_pylist(), symbols):
                for k in range(0, len(place), step := max(1, CHUNK // (code.shape[1] * symbols))):
                    for row, h in neighbourhood(code[k : k + step], symbols):
                        yield pa.RecordBatch.from_arrays([pa.array(own[place[k + row]]), pa.array(h.view(np.int64))], names=["r", "near_r"])

    folder = new_folder(spark, "vocabulary")
    vocabulary.select("word", "n").mapInArrow(reduce, "word string, n long, r long").write.parquet(folder)
    words = spark.read.parquet(folder)
    reduced = words.groupBy("r").agg(F.min("word").alias("word"))
    around = reduced.mapInArrow(generate, "r long, near_r long").join(words.select(F.col("r").alias("near_r")).distinct(), "near_r")
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("r").alias("near_r"))
    return words.join(around, "r").join(other, "near_r").filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def variant_forms(vocabulary: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each word of the vocabulary."""
    vocabulary = cut(vocabulary.select("word", "n"))
    near = near_words(vocabulary, symbols).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form"))).alias("best"))
    joined = cut(vocabulary.join(near, "word", "left").withColumn("large", -F.col("best.order") >= ratio * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("large"), F.col("best.form")).alias("form"), F.when(F.col("large"), -F.col("best.order")).alias("form_n")
    ))
    up = joined.filter("form is not null").select("word", F.col("form").alias("top"))
    for _ in range(DOUBLINGS):
        up = cut(up.join(up.select(F.col("word").alias("top"), F.col("top").alias("next")), "top", "left").select("word", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")))
        if up.filter("moved").isEmpty():
            break
    return joined.join(up.select("word", "top"), "word", "left").withColumn("root", F.coalesce("top", "word")).drop("top")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    vocabulary = damaged_runs(docs).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= COUNT)
    return variant_forms(vocabulary).select("word", "form", "root", "n", "n_near", "form_n")
