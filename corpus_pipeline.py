"""From raw documents to encoded training documents, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame whose Parquet is the next one's ``docs``. All but the last
return the columns of ``documents``:

1. toxicity: documents scored 0.5 or more go;
2. near duplicates: one document of each group of near copies stays (the smallest
   doc_id; of equal rows, one). Unlike texts under one doc_id are documents of their own;
3. decontamination: documents in which a twentieth of the words lies in benchmark
   phrases go;
4. personal data: every span is replaced by its kind in brackets;
5. encoding: piece ids of each document.

Rows without doc_id are judged by their text alone and stay in stage 2; null and
empty texts stay, with no pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsynth.llm import fm_decontam, pii, setsketch, sp_codec, toxicity
from docsynth.llm.common import checkpointed, table
from docsynth.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where("score < 0.5").select(*docs.columns)


#: Repeated doc_ids of unlike texts are broadcast up to this many (about 100 bytes each).
BROADCAST_IDS = 200_000
#: Surrogate ids of the further texts of a repeated doc_id start here, so that a plain doc_id of their group stays before them.
SURROGATES = 1 << 62


def with_row_ids(docs: DataFrame) -> DataFrame:
    """Adds ``_stage_id``: the doc_id, and for all but the first text (by hash) of a repeated one a surrogate."""
    key = F.md5(F.coalesce(F.col("text"), F.lit("")))
    repeated = checkpointed(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("_stage_doc"), key.alias("_stage_key"))
                            .groupBy("_stage_doc").agg(F.min("_stage_key").alias("_stage_first"), F.max("_stage_key").alias("_stage_last"))
                            .where("_stage_first < _stage_last").drop("_stage_last"))
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_IDS else repeated
    joined = docs.join(side, F.col("doc_id").cast("long") == F.col("_stage_doc"), "left")
    surrogate = F.lit(SURROGATES) + F.pmod(F.xxhash64(F.col("doc_id"), key), F.lit(SURROGATES))
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("_stage_first") < key, surrogate).otherwise(F.col("doc_id").cast("long")))
    return joined.withColumn("_stage_id", own).drop("_stage_doc", "_stage_first")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row_ids(docs)
    kept = setsketch.near_duplicates(rows.select("_stage_id", "text"), "_stage_id").where("kept and doc_id is not null")
    first = Window.partitionBy("_stage_id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    once = (rows.join(kept.select(F.col("doc_id").alias("_stage_id")).distinct(), "_stage_id", "left_semi")
            .withColumn("_stage_row", F.row_number().over(first)).where("_stage_row = 1"))
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = fm_decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return fm_decontam.with_verdict(found).where("not contaminated").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_codec.encode(docs).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("personal_data", redact), ("sentencepiece", encode)]

#: A string kernel, sketches and a Viterbi search have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's Parquet lies in the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
