"""Pairing annotation files with image files.

The reference sorts both listings and zips them: pairs by rank, not by name,
silently truncating the longer side. ``pair_by_position`` keeps that rule with
a parallel global rank; ``pair_by_stem`` is the name-based alternative with a
report of unmatched rows on either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import global_rank


def pair_by_position(left: DataFrame, right: DataFrame, left_order: Sequence[str],
                     right_order: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """Inner join of the i-th row of ``left`` with the i-th row of ``right``
    (both in code-point order of their order columns); 0-based ``rank``."""
    a = global_rank(left, left_order, rank_col)
    b = global_rank(right, right_order, rank_col)
    return a.join(b, rank_col, "inner")


def pair_by_stem(left: DataFrame, right: DataFrame, key: str, status_col: str = "status") -> DataFrame:
    """``matched`` / ``left_only`` / ``right_only`` per distinct ``key``.

    Both key lists are tagged and unioned, then one ``groupBy(key)`` with
    partial (map-side) aggregation ORs the tags: a single shuffle, and a key
    repeated millions of times is combined before it is shuffled.
    """
    tagged = (left.select(F.col(key), F.lit(True).alias("_ds_l"), F.lit(False).alias("_ds_r"))
              .unionByName(right.select(F.col(key), F.lit(False).alias("_ds_l"), F.lit(True).alias("_ds_r"))))
    g = tagged.groupBy(key).agg(F.bool_or("_ds_l").alias("_ds_l"), F.bool_or("_ds_r").alias("_ds_r"))
    status = (F.when(F.col("_ds_l") & F.col("_ds_r"), F.lit("matched"))
              .when(F.col("_ds_l"), F.lit("left_only")).otherwise(F.lit("right_only")))
    return g.select(key, status.alias(status_col))


def pairing_rules(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str],
                  id_col: str, rank_col: str = "rank") -> DataFrame:
    """Rule rows (V11) for listing entries left without a partner when the two
    sides have different lengths (the reference drops them silently)."""
    a = global_rank(left.select(*left_order, F.col(id_col).alias("_ds_id")), left_order, rank_col)
    b = global_rank(right.select(*right_order), right_order, rank_col).withColumn("_ds_r", F.lit(True))
    lonely_left = a.join(b, rank_col, "left_anti").select(F.col("_ds_id").cast("string").alias("template_id"))
    lonely_right = b.join(a.select(rank_col), rank_col, "left_anti").select(
        F.concat(F.lit("unpaired:"), F.concat_ws("|", *[F.col(c).cast("string") for c in right_order]))
        .alias("template_id"))
    return lonely_left.unionByName(lonely_right).select(
        "template_id", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("field_name"),
        F.lit("V11_annotation_image_count_mismatch").alias("rule"))
