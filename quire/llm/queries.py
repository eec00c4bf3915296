"""The queries of the training-data operators over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import licenses, mixing
from quire.llm.bpe import round_trip
from quire.llm.common import table
from quire.llm.fingerprints import fingerprints
from quire.llm.jaccard_join import jaccard_components
from quire.llm.lm_scores import score_documents
from quire.llm.quality_classifier import classify
from quire.llm.quality_rules import apply_rules
from quire.llm.substring_dedup import deduplicate as drop_passages
from quire.llm.suffix_dedup import deduplicate


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(table(spark, sf_dir, "documents")))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return apply_rules(table(spark, sf_dir, "documents"), trusted)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_passages(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_bpe, op3_mixing, op4_lm_scores, op5_fingerprints, op6_quality_rules, op7_quality_classifier, op8_licenses, op9_substring_dedup, op10_ngram_join)}
#: The others are models, encoders or joins that SQL cannot express or is too slow for; tests hold them against plain versions.
ORACLES: dict[str, str] = {"op8_licenses": licenses.oracle()}
