"""From raw documents to training tokens, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it kept; ``run`` writes every
stage's result as Parquet in the shared folder and hands what it reads back to the next one.
All but the last return the columns of ``documents``.

* toxicity: documents that the restored-text scorer rejects go;
* simhash: of every group of near copies one document stays;
* decontaminate: benchmark passages leave the texts, and documents that hardly hold anything else go;
* mix: every document is there as often as the curriculum reads it, in training order;
* tokens: ids in binary shards, in the order the mix is stored in, which is training order; returns the digest of
  each reading, read back by its position.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkyard.llm.decontaminate import remove_benchmark
from linkyard.llm.mixing import mixed
from linkyard.llm.ship import stored
from linkyard.llm.simhash import drop_near_copies
from linkyard.llm.token_output import encode_in_order
from linkyard.llm.toxicity import drop_toxic


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, _table(spark, sf_dir, "labels"), threshold=0.3)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_benchmark(docs, _table(spark, sf_dir, "benchmark"), window=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_in_order(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("simhash", simhash), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: The scorer and the tokenizer have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
