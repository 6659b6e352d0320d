"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chain_dedup, collocations, crf_langid, fm_decontam, html_extract, license_scan, max_sketch, nn_descent, pii, setsketch, sp_codec, suffix_dedup, toxicity
from .common import table


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decontam.digest(fm_decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.digest(sp_codec.coded(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(html_extract.main_texts(table(spark, sf_dir, "pages")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.digest(toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.pii_spans(table(spark, sf_dir, "documents")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch.digest(max_sketch.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf_langid.digest(crf_langid.predicted(docs.select("doc_id", "text"), crf_langid.train(docs)))


QUERIES = {f.__name__: f for f in (op1_nearest_neighbours, op2_decontaminate, op3_suffix_dedup, op4_repeated_passages, op5_sentencepiece, op6_license_scan, op7_html_extraction, op8_toxicity, op9_pii, op10_near_duplicates, op11_ranked_search, op12_collocations, op13_language_id)}

ORACLE_SQL: dict[str, str] = {"op2_decontaminate": fm_decontam.ORACLE, "op3_suffix_dedup": suffix_dedup.ORACLE, "op10_near_duplicates": setsketch.ORACLE, "op11_ranked_search": max_sketch.ORACLE, "op12_collocations": collocations.ORACLE}
