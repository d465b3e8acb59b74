"""Token ids of whole texts, with each distinct word encoded once by a worker process.

The tokenizers library encodes the distinct words of a batch; their ids are then laid out along the
texts with numpy. This gives the ids of the whole text for tokenizers that drop white space and
split at it (their merges never cross it), which ``check`` verifies on construction.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from orderlake.llm.words import ragged, words

#: Words remembered between batches; a full memory starts anew with the words of the batch at hand.
REMEMBER = 1 << 21
#: Words in one call of the library.
CALL = 4096

U = np.uint64


def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordEncoder:
    """Ids of texts, null as empty; the same as ``encode(text, add_special_tokens=False).ids``."""

    _open: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The encoder of this process, with what it remembers."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.check()
        self.keys = np.zeros(0, U)  # sorted hashes of words
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def check(self) -> None:
        parts = ["One", "two's", "3.5,", "d'été", "naïve<|endoftext|>"]
        apart = [i for p in parts for i in self.tokenizer.encode(p, add_special_tokens=False).ids]
        for space in (" ", "\n", "\t  "):
            if self.tokenizer.encode(space.join(parts), add_special_tokens=False).ids != apart:
                raise ValueError("this tokenizer does not split at white space: encode whole texts with it")

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        ids, sizes = [], []
        for k in range(0, len(found), CALL):
            chunk = found[k : k + CALL]
            code = self.tokenizer.encode(" ".join(chunk), add_special_tokens=False)
            at = np.cumsum([0] + [len(w) + 1 for w in chunk])
            begins = np.fromiter((a for a, _ in code.offsets), np.int64, len(code.ids))
            owner = np.searchsorted(at, begins, side="right") - 1
            ids.append(np.array(code.ids, np.uint32))
            sizes.append(np.bincount(owner, minlength=len(chunk)).astype(np.int32))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, keys: np.ndarray, found: list[str]) -> None:
        ids, sizes = self._encode(found)
        if len(self.keys) + len(keys) > REMEMBER:
            self.keys, self.begin, self.size, self.ids = self.keys[:0], self.begin[:0], self.size[:0], self.ids[:0]
        begin = len(self.ids) + np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)[:-1]))
        keys, begin, size = np.concatenate([self.keys, keys]), np.concatenate([self.begin, begin]), np.concatenate([self.size, sizes])
        order = np.argsort(keys)
        self.keys, self.begin, self.size, self.ids = keys[order], begin[order], size[order], np.concatenate([self.ids, ids])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin (one more than rows)."""
        import pandas as pd

        w = words(column)
        codes, distinct = pd.factorize(w.hashes())
        sample = np.zeros(len(distinct), np.int64)
        sample[codes[::-1]] = np.arange(len(codes))[::-1]
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if len(distinct) and not known.all():
            if len(self.keys) + int((~known).sum()) > REMEMBER:
                known[:] = False  # what was remembered goes
            text = w.data.tobytes()
            new = np.flatnonzero(~known)
            self._learn(distinct[new], [text[a:b].decode() for a, b in zip(w.starts[sample[new]].tolist(), w.ends[sample[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, distinct)
        size, begin = self.size[at][codes].astype(np.int64), self.begin[at][codes]
        total = np.concatenate(([0], np.cumsum(size)))
        return self.ids[ragged(begin, size)], total[w.first]
