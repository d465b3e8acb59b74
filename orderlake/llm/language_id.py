"""Language identification with averaged hashed subword embeddings.

A text's features are the character n-grams (1 to 4, with word borders) and whole forms of its
lower-cased words, hashed to ``BUCKETS`` rows of an embedding table. Their average goes through a linear
softmax. Both layers are trained by stochastic gradient descent in numpy, in one task, on a bounded sample:
at most ``PER_LANGUAGE`` labelled documents of each label (of all labels; with many of them fewer of each,
``SAMPLE`` in all but ``LEAST`` of each), each once whole and once as a few words in a row, so that short
texts are learned too. A fifth of the sample is held back to calibrate: one temperature scales the scores.

A prediction is rejected by either of two bounds that depend on the length of the text. Its score must
reach what all but one in ``REJECT_ONE_IN`` held-back texts of its class of length (``LENGTHS`` words)
reach; with fewer of them, that is the smallest. And enough of its subwords of 3 and 4 characters must be
known from the training texts: their share, averaged over the words, may lie ``SPREAD`` deviations below the median of held-back
whole texts, where the deviation is that between texts and that between words over the number of words.
This second bound is an estimate of medians and deviations, so it does not move with the size of the
sample; it rejects languages that were not learned and strings of letters, which may have any score.

A prediction sums one vector of ``SIZE`` numbers for each word; the distinct words of a batch are worked out
once, ``CALL`` at a time. Neither this nor the model grows with the number of labels by more than ``SIZE``
numbers each. Every text is read whole; only texts go to Python, and only the answers come back.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected; a null
id counts as not held out; without labelled documents everything is ``und``; repeated rows give equal
rows; no rows, no result. Where the input has a column of a result's name, the result's is that with
``language_id_`` in front. Label, source and id are never features.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.storage import new_folder
from orderlake.llm.words import group_sums, mix, multipliers, slices, words

BUCKETS = 1 << 15
SIZE = 16
GRAMS = 4
PER_LANGUAGE, SAMPLE, LEAST = 400, 20_000, 50
EPOCHS = 3
#: With more labels than this there are more epochs in proportion, up to a number of steps.
MORE_LABELS, MOST_STEPS = 8, 6000
BATCH = 32
RATE = 0.5
SHORT = 12
#: Largest factor (otherwise the number of labels) of the step of embeddings, which are averaged over a whole text.
STEP = 16
REJECT_ONE_IN = 1000
#: Words at which the classes of length begin.
LENGTHS = (1, 4, 16)
SPREAD = 6.0
#: Least deviations of the share of known subwords, between texts and between words.
BETWEEN, WITHIN = 0.02, 0.1
#: Bits of the hashes that mark known subwords.
KNOWN_BITS = 22
AROUND = re.compile(r"^[\W\d_]+|[\W\d_]+$")
SEED = 20
#: Words worked out at once.
CALL = 1 << 13

UNKNOWN = "und"


def word_subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the subwords of 3 and 4 characters of all words with a letter, without what is no letter around them, and their words."""
    own = [n for n, t in enumerate(texts) if any(map(str.isalpha, t))]
    lowered = ["<" + (texts[n] if texts[n].isalpha() else AROUND.sub("", texts[n])).lower() + ">" for n in own]
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.array(own, np.int64), np.array([len(t) for t in lowered], np.int64))
    codes, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in (3, 4):
        if len(chars) < n:
            break
        m = multipliers(n, 61 + n)
        h = np.zeros(len(chars) - n + 1, np.uint64)
        for j in range(n):
            h += chars[j : len(chars) - n + 1 + j] * m[j]
        inside = owner[: len(h)] == owner[n - 1 :]
        codes.append((mix(h[inside]) >> np.uint64(64 - KNOWN_BITS)).astype(np.int64))
        owners.append(owner[: len(h)][inside])
    return np.concatenate(codes), np.concatenate(owners)


def known_shares(texts: list[str], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of known subwords of each word, and 1 for words that have any: a long token is one word."""
    code, who = word_subwords(texts)
    hit = (known[code >> 3] >> (code & 7).astype(np.uint8) & 1).astype(np.float64)
    size = np.bincount(who, minlength=len(texts))
    return np.bincount(who, weights=hit, minlength=len(texts)) / np.maximum(size, 1), (size > 0).astype(np.float64)


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words in a row, and how many each word has."""
    lowered = ["<" + t.lower() + ">" for t in texts]
    size = np.array([len(t) for t in lowered], np.int64)
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    codes, owners = [], []
    for n in range(1, GRAMS + 1):
        if len(chars) < n:
            break
        m = multipliers(n, 31 + n)
        h = np.zeros(len(chars) - n + 1, np.uint64)
        for j in range(n):
            h += chars[j : len(chars) - n + 1 + j] * m[j]
        inside = owner[: len(h)] == owner[n - 1 :]
        codes.append(mix(h[inside]))
        owners.append(owner[: len(h)][inside])
    if len(chars):
        place = np.arange(len(chars)) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
        codes.append(mix(group_sums(chars * multipliers(int(size.max()), 41)[place], size)))
        owners.append(np.arange(len(texts)))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    code, who = (np.concatenate(codes) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return code[order], np.bincount(who, minlength=len(texts))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    """Embeddings, softmax layer, temperature, and what bounds rejection."""

    languages: list[str]
    table: np.ndarray  # buckets x SIZE
    out: np.ndarray  # languages x SIZE
    bias: np.ndarray
    temperature: float
    bounds: np.ndarray  # of scores, for each class of length
    known: np.ndarray  # bits of the known subwords
    share: tuple[float, float, float]  # of known subwords: median, deviation between texts, between words

    def scores(self, average: np.ndarray) -> np.ndarray:
        return _softmax((average @ self.out.T + self.bias) / self.temperature)

    def word_sums(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sum of each word's embeddings, how many they are, share of known subwords, and whether it has any."""
        sums = np.zeros((len(found), SIZE), np.float32)
        count, share, any_ = np.zeros(len(found), np.int64), np.zeros(len(found)), np.zeros(len(found))
        for k in range(0, len(found), CALL):
            some = found[k : k + CALL]
            code, n = word_features(some)
            sums[k : k + CALL] = np.add.reduceat(self.table[code], np.concatenate(([0], np.cumsum(n)[:-1])), axis=0)
            count[k : k + CALL] = n
            share[k : k + CALL], any_[k : k + CALL] = known_shares(some, self.known)
        return sums, count, share, any_

    def rejects(self, score: np.ndarray, share: np.ndarray, count: np.ndarray) -> np.ndarray:
        """By score and share of known subwords of texts of so many words."""
        middle, between, within = self.share
        least = middle - SPREAD * np.sqrt(between**2 + within**2 / np.maximum(count, 1))
        return (score < self.bounds[length_class(count)]) | (share < least)


def length_class(count: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS[1:], count, side="right")


def _deviation(x: np.ndarray) -> float:
    """From the median, so that a few odd texts don't widen it."""
    return float(1.4826 * np.median(np.abs(x - np.median(x)))) if len(x) else 0.0


def train(texts: list[str], labels: list[str]) -> LanguageModel | None:
    """Fit on whole texts and on a few words of each; a fifth calibrates."""
    languages = sorted(set(labels))
    if not languages:
        return None
    draw = np.random.default_rng(SEED)
    features, sizes, target, kept_back, parts = [], [], [], [], []
    for text, label in zip(texts, labels, strict=True):
        split = text.split()
        if not any(c.isalpha() for c in text):
            continue
        at = int(draw.integers(max(1, len(split) - SHORT + 1)))
        back = draw.random() < 0.2
        for part in (split, split[at : at + 1 + int(draw.integers(SHORT))]):
            if any(c.isalpha() for w in part for c in w):
                code, _ = word_features(part)
                features.append(code.astype(np.uint16))
                sizes.append(len(code))
                target.append(languages.index(label))
                kept_back.append(back)
                parts.append(part)
    if not features:
        return None
    y, back, n = np.array(target), np.array(kept_back), np.array(sizes)
    if back.all() or not back.any():
        back[:] = False
        back[::5] = len(y) > 5
    table = draw.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    out, bias = np.zeros((len(languages), SIZE), np.float32), np.zeros(len(languages), np.float32)

    def averages(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.concatenate([features[i] for i in own])
        starts = np.concatenate(([0], np.cumsum(n[own])[:-1]))
        return code, np.repeat(np.arange(len(own)), n[own]), np.add.reduceat(table[code], starts, axis=0) / n[own][:, None]

    fit = np.flatnonzero(~back)
    per_epoch = -(-len(fit) // BATCH)
    epochs = EPOCHS * max(1, min(len(languages) // MORE_LABELS, MOST_STEPS // (EPOCHS * per_epoch)))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        for own in np.array_split(draw.permutation(fit), -(-len(fit) // BATCH)):
            rate = RATE * (1 - step / steps)
            code, who, x = averages(own)
            p = _softmax(x @ out.T + bias)
            p[np.arange(len(own)), y[own]] -= 1
            step_x = (p @ out) / n[own][:, None]
            weight = step_x[who]
            used, back_to = np.unique(code, return_inverse=True)
            for k in range(SIZE):
                table[used, k] -= rate * min(len(languages), STEP) * np.bincount(back_to, weights=weight[:, k], minlength=len(used))
            out -= rate * (p.T @ x)
            bias -= rate * p.sum(axis=0) / len(own)
            step += 1
    held = np.flatnonzero(back) if back.any() else fit
    logits = np.concatenate([averages(own)[2] @ out.T + bias for own in np.array_split(held, -(-len(held) // BATCH))])
    grid = np.exp(np.linspace(np.log(0.1), np.log(10), 60))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    best = _softmax(logits / temperature).max(axis=1)
    count = np.array([sum(any(map(str.isalpha, w)) for w in parts[i]) for i in held])
    classes = length_class(count)
    bounds = np.array([np.quantile(best[classes == c] if (classes == c).any() else best, 1 / REJECT_ONE_IN, method="lower") for c in range(len(LENGTHS))])
    known = np.zeros(1 << KNOWN_BITS >> 3, np.uint8)
    for i in fit:
        code, _ = word_subwords(parts[i])
        np.bitwise_or.at(known, code >> 3, (1 << (code & 7)).astype(np.uint8))
    shares, deviations = [], []
    for i, n_words in zip(held, count, strict=True):
        hit, all_ = known_shares(parts[i], known)
        if n_words >= min(LENGTHS[-1], count.max()):
            shares.append(hit.sum() / max(all_.sum(), 1))
        deviations.append(np.std(hit[all_ > 0]) if n_words > 1 else 0.0)
    spread = (float(np.median(shares)), max(BETWEEN, _deviation(np.array(shares))), max(WITHIN, float(np.median(deviations))))
    return LanguageModel(languages, table, out, bias, temperature, bounds, known, spread)


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Train on the labelled documents with the smallest hashes, of each label ``per_language`` at most, or a share of ``SAMPLE``, but ``LEAST``."""
    keys = ["label", "h", "th"]
    labelled = docs.select(F.col(label_col).cast("string").alias("label"), F.xxhash64(id_col, F.lit(SEED)).alias("h"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).filter("label is not null and text is not null")
    take = min(per_language, max(LEAST, SAMPLE // max(1, labelled.select("label").distinct().count())))
    # the rows are chosen by their hashes alone (each task sends ``take`` of a label at most), then their texts are fetched
    few = Window.partitionBy("label").orderBy("h", "th")
    chosen = labelled.select(*keys).withColumn("place", F.row_number().over(few)).filter(F.col("place") <= take).select(*keys).distinct()
    folder = new_folder(docs.sparkSession, "language-sample")  # written, so that Spark knows how small it is
    chosen.write.parquet(folder)
    wanted = docs.sparkSession.read.schema("label string, h long, th long").parquet(folder)
    sample = labelled.join(wanted, keys, "left_semi").dropDuplicates(keys).select("label", "h", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("label", "h", "text")), strict=True))
        model = train([r[2] for r in rows], [r[0] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # the sample is bounded by the labels; it stays in one task, and the model (a few MB) comes to the driver
    learned = sample.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(learned[0]["model"]) if learned else None


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """All columns, and ``lang_pred``, ``score`` (0 to 1), ``rejected``."""
    kept = [f.name for f in docs.schema.fields]
    names_out = []
    for name in ("lang_pred", "score", "rejected"):
        while name in kept:
            name = f"language_id_{name}"
        names_out.append(name)
    answer = "language_id"
    while answer in [*kept, *names_out]:
        answer += "_"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x SIZE numbers, and SIZE for each label

    def predicted(text: pa.Array, model: LanguageModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = len(text)
        best, score, letters, odd = np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows, bool), np.zeros(rows, bool)
        w = words(text)
        if len(w.starts):
            codes, distinct = pd.factorize(w.hashes())
            sample = np.zeros(len(distinct), np.int64)
            sample[codes[::-1]] = np.arange(len(codes))[::-1]
            raw = w.data.tobytes()
            own = [raw[a:b].decode() for a, b in zip(w.starts[sample].tolist(), w.ends[sample].tolist(), strict=True)]
            size = np.diff(w.first)
            count = group_sums(np.array([any(map(str.isalpha, t)) for t in own], np.int64)[codes], size)
            letters = count > 0
            if model is not None:
                sums, n, share, any_ = model.word_sums(own)
                average = np.stack([group_sums(sums[codes, j].astype(np.float64), size) for j in range(SIZE)], axis=1)
                p = model.scores(average / np.maximum(group_sums(n[codes], size), 1)[:, None])
                best, score = p.argmax(axis=1), p.max(axis=1)
                odd = model.rejects(score, group_sums(share[codes], size) / np.maximum(group_sums(any_[codes], size), 1), count)
        sure = letters & (model is not None)
        names = np.array([*(model.languages if model is not None else []), UNKNOWN], object)
        return names[np.where(sure, best, len(names) - 1)], np.where(sure, score, 0.0), ~sure | odd

    @F.arrow_udf("label string, score double, rejected boolean")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in texts:
            parts = [np.zeros(0, object)], [np.zeros(0)], [np.zeros(0, bool)]
            for piece in slices(pa.RecordBatch.from_arrays([column], names=["text"]), "text"):
                for all_, some in zip(parts, predicted(piece.column("text"), model), strict=True):
                    all_.append(some)
            label, score, rejected = (np.concatenate(p) for p in parts)
            yield pa.StructArray.from_arrays([pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=["label", "score", "rejected"])

    told = docs.withColumn(answer, judge(F.col(text_col)))
    return told.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{answer}`.{f}").alias(n) for f, n in zip(("label", "score", "rejected"), names_out, strict=True)])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
