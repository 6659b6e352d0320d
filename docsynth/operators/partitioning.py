"""Partitioning helper for row-multiplying queries over small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-spread narrow rows by ``key`` before they are multiplied.

    For callers that know their input is a table of few splits; operators never
    spread by themselves. ``num_partitions`` defaults to the session's shuffle
    partitions. Hash partitioning keeps retries deterministic; streams are left
    alone.
    """
    if df.isStreaming:
        return df
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(n, key)
