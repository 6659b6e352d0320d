"""Column functions that draw typed values (masked codes, dates, numbers...).

Each takes the seed and the row keys (document id, field position...) and is a
plain Spark expression, so it runs inside whole-stage codegen (literal masks and
formats) or as a higher-order function (per-row masks and formats). Lookups in
dictionaries (names, addresses) need a join and live in
``docsynth.operators.sampling`` / ``docsynth.operators.persona``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .draws import choice, pick_char, randint, u01, uniform
from .strftime import date_part_of, spark_pattern, strftime, strftime_error

# Character classes of a mask (n digit, C upper case, c lower case).
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Default bounds of a drawn date, as in the reference's defaults.
DATE_START = "2021-01-01 00:00:00"
DATE_END = "2024-01-01 00:00:00"

# Honorifics ("suffix" in the reference, written before the name).
MALE_HONORIFIC = "Dr. "
FEMALE_HONORIFICS = ["Dr. ", "Miss. ", "Mrs. "]
GENDERS = ["male", "female"]


def _mask_char(c: Column, u: Column, keep_literals: bool) -> Column:
    other = c if keep_literals else F.lit("")
    return (F.when(c == "n", pick_char(DIGITS, u))
            .when(c == "C", pick_char(UPPER, u))
            .when(c == "c", pick_char(LOWER, u))
            .otherwise(other))


def alphanum(mask, seed: int, *keys, literal: str = "drop") -> Column:
    """Masked code: ``n`` digit, ``C`` A-Z, ``c`` a-z.

    ``literal='drop'`` (the reference rule) drops every other mask character, so
    ``nnn-nn-nnnn`` gives nine digits; ``literal='keep'`` copies them. Draw key of
    character i is (seed, keys.., 'an', i).
    """
    keep = literal == "keep"
    if isinstance(mask, str):
        parts = [_mask_char(F.lit(ch), u01(seed, *keys, "an", i), keep) for i, ch in enumerate(mask)]
        return F.concat(*parts) if parts else F.lit("")
    chars = F.filter(F.split(mask, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: _mask_char(c, u01(seed, *keys, "an", i), keep)), "")


def _epoch(s: str) -> int:
    return int(_dt.datetime.fromisoformat(s).replace(tzinfo=_dt.timezone.utc).timestamp())


def day_count(start: str = DATE_START, end: str = DATE_END) -> int:
    return (_dt.date.fromisoformat(end[:10]) - _dt.date.fromisoformat(start[:10])).days


def second_count(start: str = DATE_START, end: str = DATE_END) -> int:
    return _epoch(end) - _epoch(start)


def random_date(seed: int, *keys, start: str = DATE_START, end: str = DATE_END) -> Column:
    """Uniform calendar date in [start, end) (UTC, so every day is equally likely)."""
    days = day_count(start, end)
    return F.date_add(F.lit(start[:10]).cast("date"), F.floor(u01(seed, *keys, "date") * F.lit(days)).cast("int"))


def random_datetime(seed: int, *keys, start: str = DATE_START, end: str = DATE_END) -> Column:
    """Uniform whole second in [start, end) as timestamp_ntz (time-zone free)."""
    secs = F.floor(u01(seed, *keys, "datetime") * F.lit(second_count(start, end)))
    return F.timestamp_add("SECOND", secs, F.lit(start).cast("timestamp_ntz"))


def gen_date(fmt, seed: int, *keys, date_only: bool = True,
             start: str = DATE_START, end: str = DATE_END, pattern: Column | None = None) -> Column:
    """A drawn date rendered with a Python format.

    ``date_only`` (the reference's default) keeps the format up to the first
    space, as the reference does, and draws a calendar day; otherwise a
    timestamp to the second is drawn and the whole format is used.
    ``pattern`` is the Spark pattern of the (cut) format when it was already
    translated upstream (``date_pattern`` on the template dimension).
    """
    if date_only:
        return strftime(random_date(seed, *keys, start=start, end=end), date_part_of(fmt), pattern)
    return strftime(random_datetime(seed, *keys, start=start, end=end), fmt, pattern)


def date_pattern(fmt: Column, date_only: bool = True) -> Column:
    """Spark pattern of a format column (cut at the first space when date-only)."""
    return spark_pattern(date_part_of(fmt) if date_only else fmt)


def date_format_error(fmt: Column, date_only: bool = True) -> Column:
    return strftime_error(date_part_of(fmt) if date_only else fmt)


def number_bounds(num_digits: int = 2, decimal_places: int = 0):
    """Default range of ``get_number``: decimals widen the digit count first."""
    if decimal_places:
        num_digits += decimal_places
    return 10 ** (num_digits - 1), 10 ** num_digits - 1


def gen_int(seed: int, *keys, num_digits: int = 2, start=None, end=None) -> Column:
    lo, hi = number_bounds(num_digits)
    return randint(lo if start is None else start, hi if end is None else end, seed, *keys, "int")


def gen_decimal(seed: int, *keys, num_digits: int = 2, decimal_places: int = 2,
                start=None, end=None) -> Column:
    """Uniform double rounded half-even to ``decimal_places``."""
    lo, hi = number_bounds(num_digits, decimal_places)
    x = uniform(lo if start is None else start, hi if end is None else end, seed, *keys, "dec")
    return F.bround(x, decimal_places)


def currency(x: Column, symbol: bool = True, grouping: bool = True) -> Column:
    """en_US currency text: two decimals, optional ``$`` and thousands commas."""
    body = F.format_number(F.abs(x), 2)
    if not grouping:
        body = F.regexp_replace(body, ",", "")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$" if symbol else ""), body)


def resolve_gender(gender: Column, seed: int, *keys) -> Column:
    """Given gender if it is male/female, else a uniform draw of the two."""
    return F.when(gender.isin(*GENDERS), gender).otherwise(choice(GENDERS, seed, *keys, "gender"))


def honorific(gender: Column, seed: int, *keys) -> Column:
    return F.when(gender == "male", F.lit(MALE_HONORIFIC)).otherwise(
        choice(FEMALE_HONORIFICS, seed, *keys, "honorific"))


def address_text(address: Column, city: Column, state: Column, postal_code: Column,
                 name: Column | None = None) -> Column:
    """``address\\ncity, state zip`` (or ``address\\nstate zip`` without a city),
    with an optional ``name\\n`` line in front."""
    tail = F.when(city.isNotNull(), F.concat(city, F.lit(", "), state, F.lit(" "), postal_code)) \
        .otherwise(F.concat(state, F.lit(" "), postal_code))
    body = F.concat(address, F.lit("\n"), tail)
    if name is None:
        return body
    return F.when(name.isNotNull() & (name != ""), F.concat(name, F.lit("\n"), body)).otherwise(body)


def static_override(generated: Column, static: Column) -> Column:
    """A static value replaces the drawn one only when longer than one character."""
    return F.when(static.isNotNull() & (F.length(static) > 1), static).otherwise(generated)


def truthy(v: Column) -> Column:
    """Python truthiness of an XML attribute after the True/False coercion."""
    return v.isNotNull() & (v != "") & (v != "False")
