"""The stages of the pipeline on documents whose fate is known."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from orderlake.llm import surrogates

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    keep = docs.orderBy("doc_id").first()
    extra = [(900001, "12 34", "en", "s", 5), (900002, None, "en", "s", 0), (900003, keep["text"], "en", "s", 1), (900004, f"Before it. {item} After it.", "en", "s", 1), (900005, "Write to ann.lee@mail.org with words of one kind about the thing and that of the one.", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns
        if name == "pii":
            text = docs.filter("doc_id = 900005").first()["text"]
            assert "ann.lee" not in text and [m[2] for m in surrogates.mentions(text)] == ["email"]
    assert keep["doc_id"] in ids[0] and not {900001, 900002} & ids[0]
    assert 900003 in ids[0] and 900003 not in ids[1]
    assert 900004 in ids[1] and 900004 not in ids[2]
    assert ids[2] == ids[3] == ids[4] and 900005 in ids[4]


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
