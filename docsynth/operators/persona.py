"""Person names, e-mails, company names and addresses drawn from dictionaries.

Each operator adds columns to ``df``; ``keys`` are the columns that identify
the draw (document id, field position...). All draws are keyed, so the result
does not depend on partitioning or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import choice, index_of, randint, u01
from ..functions.generators import alphanum, honorific, resolve_gender, truthy
from ..sources.dictionaries import (COMPANY_ADJECTIVES, COMPANY_NOUNS, DEFAULT_EMAIL_DOMAIN,
                                    EMAIL_DOMAINS, EMAIL_SEPARATORS)
from .sampling import sample_uniform, sample_weighted


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def _when_needed(cond: Column | None, u: Column) -> Column:
    return u if cond is None else F.when(cond, u)


def gen_name(df: DataFrame, keys: Sequence[str], seed: int, first_names: DataFrame,
             last_names: DataFrame, indian_names: DataFrame, name_type="name_type",
             gender="name_gender", indian="name_indian", suffix="name_suffix",
             only_where: Column | None = None, out_col: str = "name",
             error_col: str = "name_error") -> DataFrame:
    """Person name per row.

    ``name_type`` 'first_name' / 'last_name' / anything else (full name; 'first'
    wins over 'last'); gender 'male'/'female' or drawn; ``indian`` picks a full
    name uniformly from the gendered ``indian_names`` and takes token 1 or 2;
    ``suffix`` puts an honorific in front (male 'Dr. ', female one of three).
    A one-token Indian name asked for its last name gives a null name and an
    error. Flags follow Python truthiness of the attribute text.
    """
    k = _keys(keys)
    nt, ind, suf = _col(name_type), truthy(_col(indian)), truthy(_col(suffix))
    rows = df.withColumn("_ds_gender", resolve_gender(_col(gender), seed, *k))
    first = first_names.select(F.col("name").alias("_ds_first"), F.col("gender").alias("_ds_gender"),
                               F.col("weight"))
    need_plain = ~ind if only_where is None else (only_where & ~ind)
    rows = sample_weighted(rows, first, _when_needed(need_plain, u01(seed, *k, "first")),
                           ["_ds_first"], "weight", by=["_ds_gender"])
    last = last_names.select(F.col("name").alias("_ds_last"), F.col("weight"))
    rows = sample_weighted(rows, last, _when_needed(need_plain, u01(seed, *k, "last")), ["_ds_last"], "weight")
    ind_dict = indian_names.select(F.col("name").alias("_ds_ind"), F.col("gender").alias("_ds_gender"))
    need_ind = ind if only_where is None else (only_where & ind)
    rows = sample_uniform(rows, ind_dict, _when_needed(need_ind, u01(seed, *k, "indian")), ["_ds_ind"],
                          by=["_ds_gender"])
    tokens = F.split(F.col("_ds_ind"), " ")
    first_only, last_only = nt == "first_name", nt == "last_name"
    indian_name = (F.when(first_only, F.element_at(tokens, 1))
                   .when(last_only, F.try_element_at(tokens, F.lit(2)))
                   .otherwise(F.col("_ds_ind")))
    plain_name = (F.when(first_only, F.col("_ds_first"))
                  .when(last_only, F.col("_ds_last"))
                  .otherwise(F.concat_ws(" ", F.col("_ds_first"), F.col("_ds_last"))))
    base = F.when(ind, indian_name).otherwise(plain_name)
    named = F.when(suf & base.isNotNull(), F.concat(honorific(F.col("_ds_gender"), seed, *k), base)).otherwise(base)
    err = F.when(ind & last_only & F.col("_ds_ind").isNotNull() & (F.size(tokens) < 2),
                 F.lit("indian_name_without_last"))
    return (rows.withColumn(out_col, named).withColumn(error_col, err)
            .drop("_ds_gender", "_ds_first", "_ds_last", "_ds_ind"))


def _pick2(a: Column, b: Column, u: Column) -> Column:
    return F.when(index_of(2, u) == 0, a).otherwise(b)


def gen_email(df: DataFrame, keys: Sequence[str], seed: int, first_names: DataFrame,
              last_names: DataFrame, random_domain=False, out_col: str = "email") -> DataFrame:
    """``user@domain`` with 1-2 user-name segments.

    The four parts (5-10 random lower-case letters, a first name, a last name, a
    year 1900-2030) are drawn once per e-mail; each segment is
    choice(letters, first) + choice(separator) + choice(last, year), segments
    joined with nothing between. Domain gmail.com, or one of 13 when
    ``random_domain``.
    """
    k = _keys(keys)
    first = first_names.select(F.col("name").alias("_ds_efirst"), F.col("weight"))
    last = last_names.select(F.col("name").alias("_ds_elast"), F.col("weight"))
    rows = sample_weighted(df, first, u01(seed, *k, "email_first"), ["_ds_efirst"], "weight")
    rows = sample_weighted(rows, last, u01(seed, *k, "email_last"), ["_ds_elast"], "weight")
    n_letters = randint(5, 10, seed, *k, "email_len")
    letters = alphanum(F.repeat(F.lit("c"), n_letters.cast("int")), seed, *k, "email_letters")
    year = randint(1900, 2030, seed, *k, "email_year").cast("string")

    def segment(i: int) -> Column:
        return F.concat(_pick2(letters, F.col("_ds_efirst"), u01(seed, *k, "email_a", i)),
                        choice(EMAIL_SEPARATORS, seed, *k, "email_sep", i),
                        _pick2(F.col("_ds_elast"), year, u01(seed, *k, "email_b", i)))

    n_seg = randint(1, 2, seed, *k, "email_segs")
    user = F.concat(segment(0), F.when(n_seg == 2, segment(1)).otherwise(F.lit("")))
    rd = _col(random_domain) if isinstance(random_domain, (str, Column)) else F.lit(bool(random_domain))
    domain = F.when(rd, choice(EMAIL_DOMAINS, seed, *k, "email_domain")).otherwise(F.lit(DEFAULT_EMAIL_DOMAIN))
    return rows.withColumn(out_col, F.concat(user, F.lit("@"), domain)).drop("_ds_efirst", "_ds_elast")


def gen_company(df: DataFrame, keys: Sequence[str], seed: int, first_names: DataFrame,
                out_col: str = "company") -> DataFrame:
    """One of three forms, uniformly: 'Adj Noun', 'First Noun', 'First Adj Noun'."""
    k = _keys(keys)
    first = first_names.select(F.col("name").alias("_ds_cfirst"), F.col("weight"))
    form = randint(1, 3, seed, *k, "company_form")
    rows = sample_weighted(df, first, F.when(form != 1, u01(seed, *k, "company_first")), ["_ds_cfirst"], "weight")
    adj = choice(COMPANY_ADJECTIVES, seed, *k, "company_adj")
    noun = choice(COMPANY_NOUNS, seed, *k, "company_noun")
    name = (F.when(form == 1, F.concat_ws(" ", adj, noun))
            .when(form == 2, F.concat_ws(" ", F.col("_ds_cfirst"), noun))
            .otherwise(F.concat_ws(" ", F.col("_ds_cfirst"), adj, noun)))
    return rows.withColumn(out_col, name).drop("_ds_cfirst")


def gen_address(df: DataFrame, keys: Sequence[str], seed: int, addresses: DataFrame,
                order_cols: Sequence[str]) -> DataFrame:
    """A uniformly drawn address record: ``address`` (address1 then address2, no
    separator), ``city`` (nullable), ``state``, ``postal_code``; coordinates are
    dropped."""
    k = _keys(keys)
    book = addresses.select(*order_cols,
                            F.concat(F.col("address1"), F.coalesce(F.col("address2"), F.lit(""))).alias("address"),
                            "city", "state", F.col("postalCode").alias("postal_code"))
    dup = [c for c in order_cols if c not in ("address", "city", "state", "postal_code")]
    out = sample_uniform(df, book, u01(seed, *k, "address"), list(order_cols))
    return out.drop(*[c for c in dup if c not in df.columns])
