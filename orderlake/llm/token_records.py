"""Token ids as length-delimited binary records with masked checksums and an offset index.

A shard ``part-NNNNN.records`` is a row of frames: length of the payload (8 bytes, little-endian),
masked CRC-32C of those 8 bytes (4), payload, masked CRC-32C of the payload (4). The payload is the
id column's value (8 bytes, signed; the smallest number stands for null), then the ids as 16-bit
integers where the vocabulary allows it, else as 32-bit ones. ``part-NNNNN.index`` has, for each
record, its offset in the shard (8 bytes) and its number of ids (8 bytes), so that a reader can take
records in any order. Shards follow each other in ascending order of ids, nulls first.

Tasks write to a name of their own and move it into place when it is whole, so a task that runs
again replaces its shard with the same bytes. Files go through ``pyarrow.fs``: any folder it can open
and executors share.

Defined results: null and empty texts have the end id only; rows with one id are written one after
the other, by text; no rows, no shards. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.storage import cut, new_folder
from orderlake.llm.wordcodes import WordEncoder
from orderlake.llm.words import slices

NULL_ID = -(1 << 63)
#: Bytes of each payload that are checked side by side.
BLOCK = 256

MANIFEST = "shard int, path string, width int, records long, tokens long, bytes long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
    return table


_TABLE = _crc_table()


def _zeros_operator(n: int) -> np.ndarray:
    """4 x 256: what n zero bytes make of each byte of a CRC's state."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).copy()
    for _ in range(n):
        state = (state >> 8) ^ _TABLE[state & 0xFF]
    return state


_SHIFT = _zeros_operator(BLOCK)


def crc32c(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of each piece of ``data``: blocks of all pieces side by side, then joined."""
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    short = lengths % BLOCK
    # the first bytes of each piece, so that full blocks remain
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-short, kind="stable")
    for k in range(int(short.max()) if len(short) else 0):
        own = order[: int(np.searchsorted(-short[order], -k, side="left"))]
        state[own] = (state[own] >> 8) ^ _TABLE[(state[own] ^ data[starts[own] + k]) & 0xFF]
    blocks = lengths // BLOCK
    total = int(blocks.sum())
    if total:
        first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
        number = np.arange(total) - np.repeat(first, blocks)
        begin = np.repeat(starts + short, blocks) + number * BLOCK
        part = np.zeros(total, np.uint32)
        for k in range(BLOCK):
            part = (part >> 8) ^ _TABLE[(part ^ data[begin + k]) & 0xFF]
        order = np.argsort(-blocks, kind="stable")
        for k in range(int(blocks.max())):
            own = order[: int(np.searchsorted(-blocks[order], -k, side="left"))]
            s = state[own]
            state[own] = _SHIFT[0][s & 0xFF] ^ _SHIFT[1][(s >> 8) & 0xFF] ^ _SHIFT[2][(s >> 16) & 0xFF] ^ _SHIFT[3][s >> 24] ^ part[first[own] + k]
    return state ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frame(ids: np.ndarray, bounds: np.ndarray, keys: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """Frames of a batch of records, and the size of each."""
    payload = 8 + np.diff(bounds) * width
    size = payload + 16
    begin = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(begin[-1]), np.uint8)
    begin = begin[:-1]
    put = lambda at, value: out.__setitem__(at[:, None] + np.arange(value.shape[1]), value)
    as_bytes = lambda x, kind: np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), -1)
    put(begin, as_bytes(payload, "<u8"))
    put(begin + 8, as_bytes(masked(crc32c(out, begin, np.full(len(begin), 8))), "<u4"))
    put(begin + 12, as_bytes(keys, "<i8"))
    body = ids.astype(f"<u{width}").view(np.uint8)
    for a, lo, hi in zip((begin + 20).tolist(), (bounds[:-1] * width).tolist(), (bounds[1:] * width).tolist(), strict=True):
        out[a : a + hi - lo] = body[lo:hi]
    put(begin + 12 + payload, as_bytes(masked(crc32c(out, begin + 12, payload)), "<u4"))
    return out.tobytes(), size


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards and indexes to ``folder``; returns the manifest, one row for each shard."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{top}/part-{shard:05d}"
        own = f"{top}/.{uuid.uuid4().hex}"
        records = tokens = size = 0
        data = index = None
        try:
            for batch in batches:
                for part in slices(batch, text_col):
                    if data is None:
                        data, index = store.open_output_stream(f"{own}.records"), store.open_output_stream(f"{own}.index")
                    ids, bounds = encoder.encode(part.column(text_col))
                    bounds = bounds + np.arange(len(bounds))
                    full = np.insert(ids, bounds[1:] - np.arange(1, len(bounds)), end_id)
                    keys = part.column(id_col).fill_null(NULL_ID).to_numpy().astype(np.int64)
                    framed, sizes = frame(full, bounds, keys, width)
                    data.write(framed)
                    at = size + np.concatenate(([0], np.cumsum(sizes)[:-1]))
                    index.write(np.ascontiguousarray(np.stack([at, np.diff(bounds)], axis=1).astype("<i8")).tobytes())
                    records, tokens, size = records + len(keys), tokens + len(full), size + len(framed)
        finally:
            if data is not None:
                data.close()
                index.close()
        if data is None:
            return
        store.move(f"{own}.index", f"{name}.index")
        store.move(f"{own}.records", f"{name}.records")
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/part-{shard:05d}"], "width": pa.array([width], pa.int32()), "records": [records], "tokens": [tokens], "bytes": [size]}
        )

    # rows of one id (or of none) are dealt over tasks by how their texts begin, which keeps the order by id and text
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col).repartitionByRange(F.col(id_col), F.substring(text_col, 1, 64)).sortWithinPartitions(id_col, text_col)
    return cut(rows.mapInArrow(write, MANIFEST))


def _frames(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, payload positions and payload sizes of the frames at ``offsets``; all checksums hold."""
    raw = np.frombuffer(data, np.uint8)
    number = lambda at, n, kind: np.ascontiguousarray(raw[at[:, None] + np.arange(n)]).view(kind)[:, 0]
    size = number(offsets, 8, "<u8").astype(np.int64)
    good = masked(crc32c(raw, offsets, np.full(len(offsets), 8))) == number(offsets + 8, 4, "<u4")
    if not good.all():
        raise ValueError("a record's length does not match its checksum")
    if not (masked(crc32c(raw, offsets + 12, size)) == number(offsets + 12 + size, 4, "<u4")).all():
        raise ValueError("a record does not match its checksum")
    return raw, offsets + 12, size


def read_records(manifest: DataFrame, id_col: str = "doc_id", most: int = 4 << 20) -> DataFrame:
    """All records of the shards: id, ``start`` (ids of all records before), ``ids``."""
    n = max(1, manifest.count())
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))  # a row for each shard

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                with store.open_input_stream(f"{path}.index") as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
                start = row["before"] + np.concatenate(([0], np.cumsum(index[:, 1])[:-1]))
                edges = np.append(index[:, 0], row["bytes"])
                with store.open_input_file(f"{path}.records") as f:
                    a = 0
                    while a < len(index):
                        b = max(a + 1, int(np.searchsorted(edges, edges[a] + most, side="right")) - 1)
                        raw, at, size = _frames(f.read_at(int(edges[b] - edges[a]), int(edges[a])), edges[a:b] - edges[a])
                        if not ((size - 8) // row["width"] == index[a:b, 1]).all():
                            raise ValueError("the index does not match its records")
                        keys = np.ascontiguousarray(raw[at[:, None] + np.arange(8)]).view("<i8")[:, 0]
                        body = [raw[p + 8 : p + s].view(f"<u{row['width']}") for p, s in zip(at.tolist(), size.tolist(), strict=True)]
                        offsets = np.concatenate(([0], np.cumsum(index[a:b, 1])))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, pa.int64(), mask=keys == NULL_ID), pa.array(start[a:b], pa.int64()),
                                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(body).astype(np.int32))),
                            ],
                            names=[id_col, "start", "ids"],
                        )
                        a = b

    return shards.repartition(n).mapInArrow(read, f"`{id_col}` long, start long, ids array<int>")


def id_digests(records: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids and CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, at = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"]
            )

    return records.mapInArrow(digest, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records in the shared folder, read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_records(docs, new_folder(spark, "token-records"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return id_digests(read_records(manifest))
