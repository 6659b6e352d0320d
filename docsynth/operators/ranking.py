"""Global ordinals and running totals without a single-task window.

``row_number() over (order by k)`` with no partition runs in one task. Here the
rows are dealt to ranges of the key by fixed splitters, a window numbers the rows
inside a range, and the counts (or sums) of the ranges before are added. The
splitters are quantiles of the ``SAMPLE`` rows with the smallest hashes, found by one
small job when the operator is called; they are literals of the plan, so a row's range
depends on its key alone. Retries and re-planning cannot move rows, and nothing has to
be checkpointed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows whose keys are sorted for the splitters, and the most ranges they make.
SAMPLE, RANGES = 8192, 1024

_RANGE = "_ds_range"


def _ranges(df: DataFrame, order_cols: Sequence[str]) -> tuple[Column, int]:
    """(number of a row's range, ranges): ranges of about equal numbers of rows, in key order."""
    keys = df.select(*order_cols)
    sample = keys.orderBy(F.xxhash64(*order_cols), *order_cols).limit(SAMPLE).orderBy(*order_cols).collect()
    wanted = min(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    picks = sorted({len(sample) * i // wanted for i in range(1, wanted)} - {0})
    if not picks:
        return F.lit(0), 1
    types = [keys.schema[c].dataType for c in order_cols]

    def struct(row) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row, types))])

    splitters = F.array(*[struct(sample[i]) for i in picks])
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])

    # bisection: lo splitters are not above the key, those from hi on are
    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(splitters, middle) <= s["key"]
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(
            F.when(below, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(middle).alias("hi"), s["key"].alias("key")))

    steps = F.sequence(F.lit(1), F.lit(len(picks).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(picks)).alias("hi"), key.alias("key"))
    return F.aggregate(steps, start, halve)["lo"], len(picks) + 1


def _with_offsets(df: DataFrame, order_cols: Sequence[str], inside: Column, size: Column, out_col: str) -> DataFrame:
    """``inside``, a window column over a row's range, plus ``size`` summed over the ranges before."""
    number, _ = _ranges(df, order_cols)
    rows = df.withColumn(_RANGE, number)
    sizes = rows.groupBy(_RANGE).agg(size.alias("_ds_size"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_RANGE, F.coalesce(F.sum("_ds_size").over(before), F.lit(0)).alias("_ds_off"))
    # at most RANGES rows: safe to broadcast
    return (rows.withColumn("_ds_in", inside).join(F.broadcast(offsets), _RANGE)
            .withColumn(out_col, (F.col("_ds_off") + F.col("_ds_in")).cast("bigint"))
            .drop(_RANGE, "_ds_off", "_ds_in"))


def global_rank(df: DataFrame, order_cols: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """0-based dense ordinal over ``order_cols`` (a total order), equal to
    ``row_number() over (order by ...) - 1`` but computed in parallel."""
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order_cols)) - 1
    return _with_offsets(df, order_cols, inside, F.count(F.lit(1)), rank_col)


def running_total(df: DataFrame, order_cols: Sequence[str], value: Column | str,
                  out_col: str = "running") -> DataFrame:
    """Inclusive running sum of an integer ``value`` over ``order_cols``."""
    v = (F.col(value) if isinstance(value, str) else value).cast("bigint")
    within = Window.partitionBy(_RANGE).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_ds_v", v)
    return _with_offsets(rows, order_cols, F.sum("_ds_v").over(within), F.sum("_ds_v"), out_col).drop("_ds_v")
