"""Texts compressed inside map tasks, so that shuffles carry fewer bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def pack_text(df: DataFrame, text_col: str, out: str = "packed") -> DataFrame:
    """Replace a text column by a binary column of zstd frames; null stays null."""
    kept = [f for f in df.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            frames = [None if v is None else press.compress(v.encode()) for v in batch.column(text_col).to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(frames, pa.binary())], names=[*(f.name for f in kept), out])

    return df.mapInArrow(pack, schema)


def unpack(frames: pa.Array) -> pa.Array:
    """The texts of a column of frames."""
    open_ = zstandard.ZstdDecompressor()
    return pa.array([None if v is None else open_.decompress(v).decode() for v in frames.to_pylist()], pa.large_string())
