"""Cost-balanced packing of token sequences.

A document of n ids costs n + n * n / ``ATTENTION_SPAN``: linear work plus attention. Tasks take their
documents in blocks of about ``BLOCK_TOKENS`` ids, so memory is bounded and nothing is shuffled. In a
block, full sequences are cut from documents longer than a sequence; the rest of each document, from
the most expensive down, goes to the sequence of the lowest cost that still has room for it. What fits
nowhere as a whole is cut over the rooms left, again cheapest sequence first. The rooms are just as
many as the ids: full sequences, and the rest as sequences whose lengths are powers of two, which need
no padding.

Defined results: null and empty texts have the end id only; a repeated row is packed again; no rows,
no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.lean import lean
from orderlake.llm.wordcodes import WordEncoder
from orderlake.llm.words import slices

#: Ids in a sequence.
CAPACITY = 2048
#: Length at which attention costs as much as the linear part.
ATTENTION_SPAN = 1024
#: Ids packed together.
BLOCK_TOKENS = 2_000_000
#: Pieces in one Arrow batch, of a sequence's ids at most: a few MB at both ends.
BATCH_PIECES = 512

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(n: np.ndarray | int) -> np.ndarray | float:
    return n + n * n / ATTENTION_SPAN


def rooms(total: int, capacity: int) -> np.ndarray:
    """Sequence lengths for so many ids: full ones, and powers of two for the rest."""
    rest = total % capacity
    return np.array([capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if rest >> b & 1], np.int64)


def pack_block(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a block; documents by position."""
    pieces = []
    full = lengths // capacity
    sequence = 0
    for d in np.flatnonzero(full).tolist():
        for k in range(int(full[d])):
            pieces.append((d, k * capacity, capacity, sequence, 0))
            sequence += 1
    begin, rest = full * capacity, lengths % capacity
    left = rooms(int(rest.sum()), capacity)
    used = np.zeros(len(left), np.int64)
    price = np.zeros(len(left))

    def put(d: int, start: int, n: int, s: int) -> None:
        pieces.append((d, start, n, sequence + s, int(used[s])))
        used[s] += n
        left[s] -= n
        price[s] += cost(n)

    cut = []
    for d in np.lexsort((np.arange(len(rest)), -rest)).tolist():
        n = int(rest[d])
        if not n:
            break
        s = int(np.argmin(np.where(left >= n, price, np.inf)))
        if left[s] >= n:
            put(d, int(begin[d]), n, s)
        else:
            cut.append(d)
    for d in cut:
        start, n = int(begin[d]), int(rest[d])
        while n:
            s = int(np.argmin(np.where(left > 0, price, np.inf)))
            take = min(n, int(left[s]))
            put(d, start, take, s)
            start, n = start + take, n - take
    return pieces


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, block: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each piece: id, start in the document, length, digest, ``sequence_id``, offset there, ``ids``."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        next_id = TaskContext.get().partitionId() << 40
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            if not held:
                return
            keys = pa.concat_arrays([x[0] for x in held])
            lengths = np.concatenate([np.diff(x[1]) for x in held])
            ids = np.concatenate([x[2] for x in held])
            held.clear()
            first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            pieces = np.array(pack_block(lengths, capacity), np.int64).reshape(-1, 5)
            sequences = int(pieces[:, 3].max()) + 1 if len(pieces) else 0
            for k in range(0, len(pieces), BATCH_PIECES):
                d, start, n, sequence, offset = pieces[k : k + BATCH_PIECES].T
                own = [ids[a : a + m].astype("<u4") for a, m in zip((first[d] + start).tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(d)), pa.array(start), pa.array(n), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()), pa.array(lengths[d].astype(np.int64)),
                        pa.array(sequence + next_id), pa.array(offset), pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(np.concatenate(own).astype(np.int32))),
                    ],
                    names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
                )
            next_id += sequences

        for batch in batches:
            for part in slices(batch, text_col):
                ids, bounds = encoder.encode(part.column(text_col))
                ids = np.insert(ids, bounds[1:], end_id).astype(np.uint32)
                held.append((part.column(id_col), bounds + np.arange(len(bounds)), ids))
                count += len(ids)
                if count >= block:
                    yield from flush()
                    held, count = [], 0
        yield from flush()

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(lean(run), f"`{id_col}` long, {PIECES}, ids array<int>")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1).drop("ids")
