"""Keyed random draws.

``F.rand(seed)`` depends on partitioning and task order, so a retried or
repartitioned task would draw different values. Every draw here is instead a
pure function of (seed, keys): the first 52 bits of ``md5(seed|k1|..|kn)`` read
as an integer and divided by 2^52, giving a double in [0, 1). The same value
comes out of DuckDB with
``cast('0x'||substr(md5(concat_ws('|', seed, k1..kn)),1,13) as bigint) / 2^52``,
which is what the SQL oracles use.

Keys must be non-null (``concat_ws`` skips nulls) and are cast to string, so
use integers or strings as keys, never doubles or timestamps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = 4503599627370496.0


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    return F.lit(str(k))


def draw_key(seed: int, *keys) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), *[_as_col(k) for k in keys])


def u01(seed: int, *keys) -> Column:
    """Uniform double in [0, 1) keyed by (seed, keys)."""
    hex13 = F.substring(F.md5(draw_key(seed, *keys)), 1, 13)
    return F.conv(hex13, 16, 10).cast("bigint") / F.lit(TWO_POW_52)


def randint(lo, hi, seed: int, *keys) -> Column:
    """Integer uniform on [lo, hi] inclusive (Python ``random.randint``)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(int(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(int(hi))
    return (lo_c + F.floor(u01(seed, *keys) * (hi_c - lo_c + F.lit(1)))).cast("bigint")


def uniform(lo, hi, seed: int, *keys) -> Column:
    """Double uniform on [lo, hi) (Python ``random.uniform``)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return lo_c.cast("double") + u01(seed, *keys) * (hi_c.cast("double") - lo_c.cast("double"))


def index_of(n, u: Column) -> Column:
    """0-based index into a list of ``n`` items for a draw ``u``."""
    n_c = n if isinstance(n, Column) else F.lit(int(n))
    return F.floor(u * n_c).cast("int")


def choice(items: Sequence, seed: int, *keys) -> Column:
    """Uniform pick from a literal list (``random.choice``)."""
    arr = F.array(*[F.lit(x) for x in items])
    return F.element_at(arr, index_of(len(items), u01(seed, *keys)) + F.lit(1))


def pick_char(alphabet: str, u: Column) -> Column:
    """One character of ``alphabet`` chosen by draw ``u``."""
    return F.lit(alphabet).substr(index_of(len(alphabet), u) + F.lit(1), F.lit(1))


# ---- SQL text of the same draws (used by the DuckDB oracles) ----

def sql_u01(seed: int, *key_sql: str) -> str:
    keys = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return (f"(CAST('0x' || substr(md5(concat_ws('|', {keys})), 1, 13) AS BIGINT)"
            f" / 4503599627370496.0::DOUBLE)")


def sql_randint(lo: str, hi: str, seed: int, *key_sql: str) -> str:
    return f"(CAST({lo} AS BIGINT) + CAST(floor({sql_u01(seed, *key_sql)} * (({hi}) - ({lo}) + 1)) AS BIGINT))"


def sql_uniform(lo: str, hi: str, seed: int, *key_sql: str) -> str:
    return (f"(CAST({lo} AS DOUBLE) + {sql_u01(seed, *key_sql)} * "
            f"(CAST({hi} AS DOUBLE) - CAST({lo} AS DOUBLE)))")


def sql_index(n: str, u_sql: str) -> str:
    return f"CAST(floor({u_sql} * ({n})) AS INTEGER)"


def sql_choice(items: Sequence[str], seed: int, *key_sql: str) -> str:
    lits = ", ".join("'" + str(x).replace("'", "''") + "'" for x in items)
    return f"([{lits}])[{sql_index(str(len(items)), sql_u01(seed, *key_sql))} + 1]"


def sql_pick_char(alphabet: str, u_sql: str) -> str:
    return f"substr('{alphabet}', {sql_index(str(len(alphabet)), u_sql)} + 1, 1)"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
