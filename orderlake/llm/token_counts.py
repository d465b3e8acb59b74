"""Token counts by rank-synchronous merging of numpy arrays.

A batch's distinct words are normalised, split into pre-tokens, and each distinct pre-token becomes a
sequence of symbols (its bytes, the last one marked as a word's end where the vocabulary does so). All
sequences lie in one flat array. In each round every sequence finds its lowest-ranked adjacent pair and
merges all places of that pair, left to right, until no sequence has a pair with a rank. What is left
are the tokens. The counts of words are then summed along the texts.

The special strings of the vocabulary count as one token each wherever they stand in a text, as the
tokenizers library does by default. Special tokens must be taken from the text as it is (not
normalised), without white space around them.

Defined results: null and empty texts have no bytes and no tokens; repeated rows give equal rows; no
rows, no result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.wordcodes import load_tokenizer
from orderlake.llm.words import group_sums, slices, words

#: Pre-tokens merged together.
CALL = 1 << 16
#: Words and counts remembered between batches.
REMEMBER = 1 << 21

U = np.uint64


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return [chr(dict(zip(other, range(256, 512), strict=False)).get(b, b)) for b in range(256)]


class RankMerger:
    """Merges of a byte-level BPE file (``.json``) on arrays of pre-tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.last = np.array([vocab[c + end] for c in byte_letters()], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], strict=True))
        key = left << 32 | right
        key, first = np.unique(key, return_index=True)
        self.key, self.rank, self.made = key, first.astype(np.int64), made[first]

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token."""
        out = np.zeros(len(tokens), np.int64)
        for k in range(0, len(tokens), CALL):
            out[k : k + CALL] = self._counts(tokens[k : k + CALL])
        return out

    def _counts(self, tokens: list[bytes]) -> np.ndarray:
        size = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(size)
        full = size > 0
        symbols[ends[full] - 1] = self.last[raw[ends[full] - 1]]
        owner = np.repeat(np.arange(len(tokens)), size)
        out = size.copy()
        none = len(self.key) + 1
        while len(symbols) > 1:
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.searchsorted(self.key, pair)
            at[at == len(self.key)] = 0
            same = owner[:-1] == owner[1:]
            rank = np.where(same & (self.key[at] == pair), self.rank[at], none)
            begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(np.append(rank, none), begin)
            length = np.diff(np.append(begin, len(owner)))
            low = np.repeat(least, length)
            merge = (rank == low[:-1]) & (rank < none)
            # of overlapping places (a a a) the first, third, ... are taken
            follows = np.append(False, merge[1:] & merge[:-1])
            if follows.any():
                place = np.arange(len(merge))
                head = np.maximum.accumulate(np.where(merge & ~follows, place, 0))
                merge &= (place - head) % 2 == 0
            spot = np.flatnonzero(merge)
            symbols[spot] = self.made[at[spot]]
            keep = np.ones(len(symbols), bool)
            keep[spot + 1] = False
            # a sequence without a merge is done: its symbols are counted and leave
            live = np.repeat(least < none, length)
            done = ~live
            if done.any():
                seq = owner[begin[least >= none]]
                out[seq] = length[least >= none]
            keep &= live
            symbols, owner = symbols[keep], owner[keep]
        if len(symbols):
            out[owner[0]] = 1
        return out


class TokenCounter:
    """Token counts of texts; words are counted once and remembered."""

    _open: dict[str, TokenCounter] = {}

    @classmethod
    def of(cls, path: str) -> TokenCounter:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        if not path.endswith(".json"):
            raise ValueError("a .json file of the tokenizers library is needed")
        tokenizer = load_tokenizer(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.by_words = len({str(self._pieces(s.join(["One", "2,"]))) for s in (" ", "\n ")}) == 1 and self._pieces("One 2,") == self._pieces("One") + self._pieces("2,")
        added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.merger = RankMerger(path)
        self.letters = {c: b for b, c in enumerate(byte_letters())}
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int32)

    def _pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text, in the vocabulary's letters for bytes."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [p for p, _ in self.splitter.pre_tokenize_str(text)] if text else []

    def _count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, with its special strings."""
        pieces: list[str] = []
        owner: list[int] = []
        extra = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            parts = [text]
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                extra[k] = len(parts) - 1
            for part in parts:
                own = self._pieces(part) if part else []
                pieces += own
                owner += [k] * len(own)
        if not pieces:
            return extra
        number: dict[str, int] = {}
        code = np.array([number.setdefault(p, len(number)) for p in pieces], np.int64)
        letters = self.letters
        n = self.merger.counts([bytes([letters[c] for c in p]) for p in number])
        return extra + np.bincount(np.array(owner), weights=n[code], minlength=len(texts)).astype(np.int64)

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text; null as empty."""
        import pandas as pd

        if not self.by_words:  # white space belongs to tokens: whole texts
            return self._count([t or "" for t in column.to_pylist()])
        w = words(column)
        codes, distinct = pd.factorize(w.hashes())
        sample = np.zeros(len(distinct), np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        n = np.zeros(len(distinct), np.int64)
        n[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            text = w.data.tobytes()
            n[new] = self._count([text[a:b].decode() for a, b in zip(w.starts[sample[new]].tolist(), w.ends[sample[new]].tolist(), strict=True)])
            if len(self.keys) + len(new) > REMEMBER:
                self.keys, self.counts = self.keys[:0], self.counts[:0]
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys)
            self.keys, self.counts = keys[order], np.concatenate([self.counts, n[new].astype(np.int32)])[order]
        return group_sums(n[codes], np.diff(w.first))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and whether the tokens exceed ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.of(tokenizer)
        for batch in batches:
            for part in slices(batch, text_col):
                text = part.column(text_col)
                n = counter.count(text)
                size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(id_col), size, pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)
