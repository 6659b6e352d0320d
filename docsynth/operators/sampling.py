"""Dictionary lookups driven by keyed draws.

* ``sample_uniform``: uniform pick of a dictionary row (``random.choice``): the
  dictionary gets a dense 0-based index per group and each row joins on
  ``floor(u * n)``.
* ``sample_weighted``: inverse-CDF pick with integer weights: the range join
  ``lo <= u < hi`` with each interval exploded over the bins it meets, an equi-join
  on ``floor(u * B)`` and the range as a filter, so it plans as a hash join.

The dictionary side is broadcast only after its rows and bytes are checked against
``max_broadcast_rows`` and ``DEFAULT_MAX_BROADCAST_BYTES``; above these the join is a shuffle join on uniformly
spread keys (draws are uniform, so there is no hot key on the probe side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import global_rank, running_total

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# A dictionary at most this long is ranked with plain windows (it is also
# within the broadcast bound); a longer one uses the parallel offset method.
SMALL_DICTIONARY_ROWS = 200_000


#: Bound of the bytes of a broadcast side; a row counts its strings and ``ROW_BYTES``.
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
ROW_BYTES = 64


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table (its strings, and ``ROW_BYTES`` a row), in one job."""
    strings = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("bigint")
               for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = F.lit(0).cast("bigint")
    for s in strings:
        size = size + s
    n, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return int(n), int(held) + ROW_BYTES * int(n)


def within_bounds(n_rows: int, n_bytes: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    return n_rows <= max_rows and n_bytes <= DEFAULT_MAX_BROADCAST_BYTES


def checked_broadcast(df: DataFrame, n_rows: int, n_bytes: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a side whose measured rows and bytes are within the bounds."""
    return F.broadcast(df) if within_bounds(n_rows, n_bytes, max_rows) else df


def _group_cols(by: Sequence[str] | None) -> list[str]:
    return list(by or [])


NULL_KEY_SALTS = 4096


def _spread_null_key(key: Column, row_cols: Sequence[str], broadcast: bool) -> Column:
    """Rows that need no lookup carry a null key. In a shuffle join all of them
    would hash to one reducer, so they get a negative key (matching nothing)
    spread by a hash of the row; with a broadcast join nulls cost nothing."""
    if broadcast:
        return key
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in row_cols]), F.lit(NULL_KEY_SALTS))
    return F.coalesce(key, (F.lit(-1) - salt).cast("bigint"))


def index_dictionary(dictionary: DataFrame, order_cols: Sequence[str], by: Sequence[str] | None = None,
                     idx_col: str = "_ds_idx", n_col: str = "_ds_n", size: tuple[int, int] | None = None) -> DataFrame:
    """Dense 0-based index of each row inside its group, plus the group size.

    ``size`` is what ``measured`` gives for the dictionary, where it is known."""
    by = _group_cols(by)
    n_rows, n_bytes = size or measured(dictionary)
    if n_rows <= SMALL_DICTIONARY_ROWS:
        w = Window.partitionBy(*by).orderBy(*order_cols)
        return (dictionary.withColumn(idx_col, (F.row_number().over(w) - 1).cast("bigint"))
                .withColumn(n_col, F.count(F.lit(1)).over(Window.partitionBy(*by))))
    ranked = global_rank(dictionary, [*by, *order_cols], "_ds_g")
    if not by:  # one group: the global rank is the index, the size is known
        return ranked.withColumnRenamed("_ds_g", idx_col).withColumn(n_col, F.lit(n_rows).cast("bigint"))
    # one row per group, groups <= dictionary rows (checked bound)
    groups = ranked.groupBy(*by).agg(F.min("_ds_g").alias("_ds_start"), F.count(F.lit(1)).alias(n_col))
    joined = ranked.join(checked_broadcast(groups, n_rows, n_bytes), by)
    return joined.withColumn(idx_col, (F.col("_ds_g") - F.col("_ds_start")).cast("bigint")).drop("_ds_g", "_ds_start")


def sample_uniform(df: DataFrame, dictionary: DataFrame, u: Column, order_cols: Sequence[str],
                   by: Sequence[str] | None = None, how: str = "left",
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach one uniformly drawn dictionary row to each row of ``df``.

    ``order_cols`` fix the dictionary order (they must be a total order inside a
    group), ``by`` restricts the pick to the dictionary rows of the same group
    (e.g. gender). ``u`` is a keyed draw in [0, 1).
    """
    by = _group_cols(by)
    size = n_dict, n_bytes = measured(dictionary)
    indexed = index_dictionary(dictionary, order_cols, by, size=size)
    rows = df.withColumn("_ds_u", u)
    if by:
        # at most one row per group, and groups <= dictionary rows
        sizes = indexed.select(*by, "_ds_n").distinct()
        rows = rows.join(checked_broadcast(sizes, n_dict, n_bytes, max_broadcast_rows), by, "left")
    else:
        rows = rows.withColumn("_ds_n", F.lit(n_dict).cast("bigint"))
    is_bc = within_bounds(n_dict, n_bytes, max_broadcast_rows)
    idx = F.floor(F.col("_ds_u") * F.col("_ds_n")).cast("bigint")
    rows = rows.withColumn("_ds_idx", _spread_null_key(idx, df.columns, is_bc)).drop("_ds_n")
    right = checked_broadcast(indexed.drop("_ds_n"), n_dict, n_bytes, max_broadcast_rows)
    return rows.join(right, [*by, "_ds_idx"], how).drop("_ds_idx", "_ds_u")


def weighted_intervals(dictionary: DataFrame, order_cols: Sequence[str], weight_col: str,
                       by: Sequence[str] | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """CDF interval [lo, hi) of each dictionary row inside its group.

    Weights are integers; cumulative weights are summed exactly as integers and
    divided once, so every engine gets bit-identical bounds.
    """
    by = _group_cols(by)
    d = dictionary.filter(F.col(weight_col) > 0)
    n_rows, n_bytes = size or measured(d)
    if n_rows <= SMALL_DICTIONARY_ROWS:
        w = F.col(weight_col).cast("bigint")
        run = Window.partitionBy(*by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding,
                                                                         Window.unboundedFollowing)
        d = d.select("*", F.sum(w).over(run).alias("_ds_cum"), F.sum(w).over(whole).alias("_ds_tot"))
        total = F.col("_ds_tot").cast("double")
        return (d.withColumn("lo", (F.col("_ds_cum") - w).cast("double") / total)
                .withColumn("hi", F.col("_ds_cum").cast("double") / total).drop("_ds_cum", "_ds_tot"))
    cum = running_total(d, [*by, *order_cols], weight_col, "_ds_hi")
    cum = cum.withColumn("_ds_lo", F.col("_ds_hi") - F.col(weight_col).cast("bigint"))
    agg = [F.min("_ds_lo").alias("_ds_start"), F.sum(F.col(weight_col).cast("bigint")).alias("_ds_total")]
    if by:  # one row per group, groups <= dictionary rows (checked bound)
        cum = cum.join(checked_broadcast(cum.groupBy(*by).agg(*agg), n_rows, n_bytes), by)
    else:  # one group: its start and total are two scalars
        tot = cum.agg(*agg).first()
        cum = cum.withColumn("_ds_start", F.lit(int(tot["_ds_start"] or 0)).cast("bigint")) \
                 .withColumn("_ds_total", F.lit(int(tot["_ds_total"] or 0)).cast("bigint"))
    total = F.col("_ds_total").cast("double")
    return (cum.withColumn("lo", (F.col("_ds_lo") - F.col("_ds_start")).cast("double") / total)
            .withColumn("hi", (F.col("_ds_hi") - F.col("_ds_start")).cast("double") / total)
            .drop("_ds_lo", "_ds_hi", "_ds_start", "_ds_total"))


def sample_weighted(df: DataFrame, dictionary: DataFrame, u: Column, order_cols: Sequence[str],
                    weight_col: str, by: Sequence[str] | None = None, bins: int | None = None,
                    how: str = "left", max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach one dictionary row drawn with probability proportional to weight.

    An equi-join on (group, bin) plus the range filter: a hash join (broadcast when
    the exploded intervals are within the bound, else a shuffle join on uniformly
    spread bins), never a nested loop over the dictionary.
    """
    by = _group_cols(by)
    size = n_int, n_bytes = measured(dictionary)
    intervals = weighted_intervals(dictionary, order_cols, weight_col, by, size=size)
    if weight_col not in order_cols:
        intervals = intervals.drop(weight_col)
    rows = df.withColumn("_ds_u", u)
    # as many bins as the group has words (unless given): n intervals that cover
    # [0, 1) once meet at most n + b bins, so the exploded side has at most 2 n rows
    if bins:
        intervals = intervals.withColumn("_ds_b", F.lit(int(bins)).cast("bigint"))
    elif by:
        intervals = intervals.withColumn("_ds_b", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    else:
        intervals = intervals.withColumn("_ds_b", F.lit(max(1, n_int)).cast("bigint"))
    if by:
        sizes = intervals.select(*by, "_ds_b").distinct()  # at most one row per dictionary row
        rows = rows.join(checked_broadcast(sizes, n_int, n_bytes, max_broadcast_rows), by, "left")
    else:
        rows = rows.withColumn("_ds_b", F.lit(int(bins) if bins else max(1, n_int)).cast("bigint"))
    bl = F.floor(F.col("lo") * F.col("_ds_b").cast("double")).cast("bigint")
    bh = F.least(F.floor(F.col("hi") * F.col("_ds_b").cast("double")).cast("bigint"), F.col("_ds_b") - 1)
    exploded = intervals.withColumn("_ds_bin", F.explode(F.sequence(bl, F.greatest(bl, bh)))).drop("_ds_b")
    times = 2 if not bins else 1 + int(bins)
    is_bc = within_bounds(times * n_int, times * n_bytes, max_broadcast_rows)
    right = F.broadcast(exploded) if is_bc else exploded
    bin_ = F.floor(F.col("_ds_u") * F.col("_ds_b").cast("double")).cast("bigint")
    rows = rows.withColumn("_ds_bin", _spread_null_key(bin_, df.columns, is_bc)).drop("_ds_b")
    keyed = rows.join(right, [*by, "_ds_bin"], "left")
    hit = (F.col("_ds_u") >= F.col("lo")) & (F.col("_ds_u") < F.col("hi"))
    if how == "inner":
        out = keyed.filter(hit)
    else:
        # a row's bin may hold several intervals: keep the one that contains u.
        # Exactly one does, so filtering the non-containing matches is exact.
        out = keyed.filter(hit | F.col("lo").isNull())
    return out.drop("_ds_u", "_ds_bin", "lo", "hi")
