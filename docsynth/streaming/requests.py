"""Structured Streaming: fill documents as requests arrive.

A request is a row ``(template_id, doc_index)`` (or ``doc_id``) landing in a
folder as JSON/CSV/parquet files. The value generator is a projection plus
stream-static broadcast joins against the template fields and the name
dictionaries, so the same operator runs on the stream; keyed draws make a
replayed micro-batch produce exactly the same values, so the file sink's
checkpoint gives exactly-once output without any state store.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.augplan import augmentation_plan
from ..operators.values import generate_values
from ..session import ensure_checkpoint_dir

REQUEST_SCHEMA = "template_id string, doc_index bigint"


def read_requests(spark: SparkSession, path: str, fmt: str = "json", schema: str = REQUEST_SCHEMA,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of document requests with ``doc_id = template_index``."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    req = r.load(path)
    if "doc_id" not in req.columns:
        req = req.withColumn("doc_id", F.concat(F.col("template_id"), F.lit("_"), F.col("doc_index").cast("string")))
    return req


def values_stream(requests: DataFrame, fields: DataFrame, seed: int, first_names: DataFrame,
                  last_names: DataFrame, indian_names: DataFrame) -> DataFrame:
    """The value generator applied to a streaming frame of requests."""
    return generate_values(requests.select("doc_id", "template_id"), fields, seed, first_names, last_names,
                           indian_names)


def plan_stream(requests: DataFrame, probability: float = 0.5, seed: int = 0) -> DataFrame:
    """The augmentation plan applied to a streaming frame of requests."""
    return augmentation_plan(requests.select("doc_id"), probability, seed)


def _checkpoint_location(spark: SparkSession, name: str, given: str | None) -> str:
    if given:
        return given
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", name)


def write_stream(df: DataFrame, path: str, name: str, checkpoint: str | None = None,
                 available_now: bool = False, processing_time: str | None = None,
                 partition_by: tuple = ()) -> StreamingQuery:
    """Append a stream to a parquet folder; the checkpoint defaults to a
    folder under the session's shared checkpoint directory."""
    spark = df.sparkSession
    w = (df.writeStream.format("parquet").option("path", path).outputMode("append")
         .option("checkpointLocation", _checkpoint_location(spark, name, checkpoint)).queryName(name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
