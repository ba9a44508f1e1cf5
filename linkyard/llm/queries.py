"""The checked queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .chat import format_and_read, with_hard_conversation
from .decontaminate import contamination
from .katz import katz_report
from .langid import language_report
from .licences import licence_scan
from .merkle import MANIFEST_SQL, manifest_report
from .mixing import MIX_SQL, mix_report
from .quality_crf import quality_report
from .repair import REPAIR_SQL, repair_report
from .simhash import near_duplicates
from .suffix_dedup import repeat_report
from .token_output import encode_and_read
from .toxicity import toxicity_scores


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_shards(spark, sf_dir):
    return encode_and_read(_t(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_curriculum_mix(spark, sf_dir):
    return mix_report(_t(spark, sf_dir, "documents"))


def op3_chat_windows(spark, sf_dir):
    return format_and_read(with_hard_conversation(_t(spark, sf_dir, "conversations")))


def op4_language_codes(spark, sf_dir):
    return language_report(_t(spark, sf_dir, "documents"))


def op5_line_crf(spark, sf_dir):
    return quality_report(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def op6_suffix_repeats(spark, sf_dir):
    return repeat_report(_t(spark, sf_dir, "documents"), length=400)


def op7_simhash_tiles(spark, sf_dir):
    return near_duplicates(_t(spark, sf_dir, "documents"), shingle=4, radius=4)


def op8_suffix_automaton(spark, sf_dir):
    return contamination(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), window=10)


def op9_katz(spark, sf_dir):
    return katz_report(_t(spark, sf_dir, "documents"))


def op10_restored_toxicity(spark, sf_dir):
    return toxicity_scores(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), threshold=0.3)


def op11_conversation_repair(spark, sf_dir):
    return repair_report(_t(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark, sf_dir):
    return manifest_report(_t(spark, sf_dir, "documents"))


def op13_licence_scan(spark, sf_dir):
    return licence_scan(_t(spark, sf_dir, "documents")).drop("notices")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_shards": op1_token_shards,
    "op2_curriculum_mix": op2_curriculum_mix,
    "op3_chat_windows": op3_chat_windows,
    "op4_language_codes": op4_language_codes,
    "op5_line_crf": op5_line_crf,
    "op6_suffix_repeats": op6_suffix_repeats,
    "op7_simhash_tiles": op7_simhash_tiles,
    "op8_suffix_automaton": op8_suffix_automaton,
    "op9_katz": op9_katz,
    "op10_restored_toxicity": op10_restored_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_licence_scan": op13_licence_scan,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {"op2_curriculum_mix": MIX_SQL, "op11_conversation_repair": REPAIR_SQL, "op12_merkle_manifest": MANIFEST_SQL}
