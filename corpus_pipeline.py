"""A training corpus from raw documents: language, near duplicates, benchmark passages, personal data, packing.

Each stage reads all that its predecessor kept and is written as Parquet to the shared folder.

1. Language identification learns from the labelled documents; documents it rejects go (no letter, or a
   score or a share of known subwords below the bounds for its length).
2. Near duplicates (five-word shingles, Jaccard similarity of 0.8): the smallest id of each group stays
   with its text, and one of equal rows; texts of one id are judged each by its own.
3. Documents that hold an item of the benchmark, also with other numbers or names, go.
4. Personal data is replaced by surrogates; ``n_chars`` follows the text.
5. Documents are packed into sequences of at most 2048 ids.

Null texts and texts without a letter go at the first stage; rows with a null id are
searched, and removed or kept, like others. An empty
table passes all stages.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.language_id import fit, identify
from orderlake.llm.near_dedup import drop_near_duplicates
from orderlake.llm.packing import pack
from orderlake.llm.ship import ship
from orderlake.llm.storage import new_folder
from orderlake.llm.surrogates import replace_entities
from orderlake.llm.templates import contamination

#: Session setting with the key of the surrogates. Who knows the key can work surrogates out from a list of names.
SURROGATE_KEY = "spark.orderlake.surrogates.key"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rejected = identify(docs, fit(docs))
    return rejected.filter(~F.col(rejected.columns[-1])).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_near_duplicates(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc").alias("__found_doc"), F.col("th").alias("__found_text")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__found_doc")) & (F.xxhash64("text") == F.col("__found_text")), "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    replaced = replace_entities(docs, key=surrogate_key(spark))
    count = replaced.columns[-1]
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return replaced.select(*docs.columns)


def surrogate_key(spark: SparkSession) -> str:
    """The session's key for surrogates; without one, a key of this run that nobody keeps."""
    return spark.conf.get(SURROGATE_KEY, None) or secrets.token_hex(32)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(docs, TOKENIZER, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: The stages train a model and verify sets; SQL cannot express them. Tests hold near duplicates against
#: brute force and the other stages against planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k + 1}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
