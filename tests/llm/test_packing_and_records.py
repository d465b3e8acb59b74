"""Packing and token records through Spark, on odd rows, held against the library."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import types as T
from tokenizers import Tokenizer

from orderlake.llm import packing, token_records
from orderlake.llm.ship import ship
from orderlake.llm.storage import new_folder

BPE = public_tokenizers.path("word_bpe_49k.json")
CLASHING = ["ids", "start", "length", "sequence_id", "offset", "doc_tokens", "n_tokens", "shard", "path"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in CLASHING]])


def rows():
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "One two's 3.5, d'été naïve"), (4, "One two's 3.5, d'été naïve"), (4, "another text of this id"), (None, "no id at all"), (None, "no id, other words"), (5, "x" * 100_000), (6, "many words in a row " * 3000), (7, "<|endoftext|> I'm 🙂")]
    return [(*r, *range(len(CLASHING))) for r in texts]


def expected(end):
    tokenizer = Tokenizer.from_file(BPE)
    return [(r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, end], "<u4")) for r in rows()]


def test_packing_of_odd_rows(spark):
    ship(spark)
    pieces = packing.pack(spark.createDataFrame(rows(), SCHEMA).repartition(3), BPE, end_id=1).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    wanted = Counter((i, ids.tobytes()) for i, ids in expected(1))
    # pieces of one id and length may be of equal texts: they are told apart by their digests, in order of their starts
    found = defaultdict(list)
    for p in pieces:
        found[p.doc_id].append(p)
    for doc, ids in {i: [x for j, x in expected(1) if j == i] for i, _ in expected(1)}.items():
        assert sum(p.length for p in found[doc]) == sum(map(len, ids))
        if len(ids) == 1:
            whole = np.concatenate([np.array(p.ids, "<u4") for p in sorted(found[doc], key=lambda p: p.start)])
            assert wanted[doc, whole.tobytes()] == 1 and {p.doc_tokens for p in found[doc]} == {len(whole)}
        else:  # short ones lie in one piece each
            assert Counter(np.array(p.ids, "<u4").tobytes() for p in found[doc]) == Counter(x.tobytes() for x in ids)
    assert packing.pack(spark.createDataFrame([], SCHEMA), BPE, end_id=1).count() == 0


def test_records_of_a_hot_and_a_missing_id_lie_in_several_shards(spark):
    ship(spark)
    many = [(None if k % 2 else 7, f"text {k} of few ids " * (k % 5), *range(len(CLASHING))) for k in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would be put together again
    try:
        manifest = token_records.write_records(spark.createDataFrame(many, SCHEMA), new_folder(spark, "records"), BPE, end_id=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = [r.records for r in manifest.collect()]
    assert sum(shards) == 4000 and len(shards) >= 4 and max(shards) < 2000
    read = token_records.read_records(manifest).collect()
    tokenizer = Tokenizer.from_file(BPE)
    want = Counter((r[0], tuple([*tokenizer.encode(r[1], add_special_tokens=False).ids, 2])) for r in many)
    assert Counter((r.doc_id, tuple(r.ids)) for r in read) == want
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids)
    ids = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
