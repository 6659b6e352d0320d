"""Python ``strftime`` formats on Spark columns.

Templates give date formats in Python's ``%`` notation. Two paths:

* a literal format (known when the plan is built) is translated once into a
  Spark datetime pattern, so the whole projection stays in whole-stage codegen;
* a format held in a column (one per template field) is split into tokens and
  each token formatted with ``date_format``; a directive outside the supported
  set makes the value null and ``strftime_error`` true.

Supported directives are those on which Python, Spark and DuckDB agree.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python strftime directive -> Spark datetime pattern.
DIRECTIVES = {
    "d": "dd", "m": "MM", "Y": "yyyy", "y": "yy", "H": "HH", "M": "mm", "S": "ss",
    "I": "hh", "p": "a", "B": "MMMM", "b": "MMM", "A": "EEEE", "a": "EEE", "j": "DDD",
}

_TOKEN = re.compile(r"%.|%$|[^%]+", re.S)
TOKEN_REGEX = "(%.|%$|[^%]+)"


class UnsupportedFormat(ValueError):
    pass


def to_spark_pattern(fmt: str) -> str:
    """Translate a Python strftime format into a Spark datetime pattern."""
    out, literal = [], []

    def flush():
        if literal:
            out.append("'" + "".join(literal).replace("'", "''") + "'")
            literal.clear()

    for tok in _TOKEN.findall(fmt):
        if tok == "%%":
            literal.append("%")
        elif tok.startswith("%"):
            key = tok[1:]
            if key not in DIRECTIVES:
                raise UnsupportedFormat(f"unsupported strftime directive {tok!r} in {fmt!r}")
            flush()
            out.append(DIRECTIVES[key])
        else:
            literal.append(tok)
    flush()
    return "".join(out)


def date_part_of(fmt):
    """The reference's date-only rule: keep the format up to the first space."""
    if isinstance(fmt, Column):
        return F.substring_index(fmt, " ", 1)
    return fmt.split(" ")[0]


def _tokens(fmt: Column) -> Column:
    return F.regexp_extract_all(fmt, F.lit(TOKEN_REGEX), 1)


def strftime_error(fmt: Column) -> Column:
    """True when a column format holds a directive we cannot render."""
    allowed = F.array(*[F.lit("%" + k) for k in DIRECTIVES], F.lit("%%"))
    return F.exists(_tokens(fmt), lambda t: t.startswith("%") & ~F.array_contains(allowed, t))


# What Python's strptime reads for a directive (names in English, any case).
_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
PARSED = {
    "d": r"(?:3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9])", "m": r"(?:1[0-2]|0[1-9]|[1-9])", "Y": r"\d\d\d\d", "y": r"\d\d",
    "H": r"(?:2[0-3]|[0-1]\d|\d)", "I": r"(?:1[0-2]|0[1-9]|[1-9]| [1-9])", "M": r"(?:[0-5]\d|\d)", "S": r"(?:6[0-1]|[0-5]\d|\d)",
    "j": r"(?:36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9])", "p": "(?:am|pm)",
    "B": f"(?:{'|'.join(_MONTHS)})", "b": f"(?:{'|'.join(m[:3] for m in _MONTHS)})",
    "A": f"(?:{'|'.join(_DAYS)})", "a": f"(?:{'|'.join(d[:3] for d in _DAYS)})",
}


def strptime_accepts(fmt: Column, text: str) -> Column:
    """Whether Python's ``strptime`` reads ``text`` by the format (for texts whose day and
    month fit together in any order).

    The format becomes a regular expression: a directive reads the first of its
    alternatives that fits, white space any white space, other characters
    themselves; the text has to be used up without trying again. A directive that is unknown
    or stands twice reads nothing."""
    def read(t: Column) -> Column:
        out = F.when(t == "%%", F.lit("%"))
        for key, pattern in PARSED.items():
            out = out.when(t == "%" + key, F.lit(pattern))
        literal = F.regexp_replace(F.regexp_replace(t, r"([\\.^$*+?(){}\[\]|])", r"\\$1"), r"\s+", r"\\s+")
        return out.when(t.startswith("%"), F.lit("(?!)")).otherwise(literal)

    tokens = _tokens(fmt)
    directives = F.filter(tokens, lambda t: t.startswith("%") & (t != "%%"))
    pattern = F.concat(F.lit("^(?i)"), F.array_join(F.transform(tokens, read), ""))
    used = F.call_function("regexp_extract", F.lit(text), pattern, F.lit(0))
    return (F.size(directives) == F.size(F.array_distinct(directives))) & (used == text)


SUPPORTED_REGEX = "^(%[" + "".join(DIRECTIVES) + "%]|[^%])*$"


def spark_pattern(fmt: Column) -> Column:
    """Column form of ``to_spark_pattern`` (null for unsupported formats).

    Meant for the template dimension (one row per field), so the document
    rows carry a ready Spark pattern: ``%%`` is parked as \\u0001, quotes in
    literal text are doubled, every literal run (at the start or right after a
    directive) is quoted, then each directive becomes its pattern letters.
    """
    s = F.regexp_replace(fmt, "%%", "\u0001")
    s = F.regexp_replace(s, "'", "''")
    s = F.regexp_replace(s, "(?:(?<=^)|(?<=%.))([^%]+)", "'$1'")
    for key, pat in DIRECTIVES.items():
        s = F.regexp_replace(s, "%" + key, pat)
    s = F.regexp_replace(s, "\u0001", "%")
    return F.when(fmt.rlike(SUPPORTED_REGEX), s)


def format_with(ts: Column, pattern: Column) -> Column:
    """``date_format`` with a per-row Spark pattern (formatters are cached)."""
    return F.call_function("date_format", ts, pattern)


def strftime(ts: Column, fmt, pattern: Column | None = None) -> Column:
    """Render ``ts`` (date or timestamp_ntz) with a Python strftime format.

    A literal format is translated once; with ``pattern`` (a column made by
    ``spark_pattern`` upstream) one ``date_format`` per row is used; a bare
    format column falls back to rendering token by token.
    """
    if isinstance(fmt, str):
        return F.date_format(ts, to_spark_pattern(fmt))
    if pattern is not None:
        return F.when(pattern.isNotNull(), format_with(ts, pattern))

    def render(t: Column) -> Column:
        expr = F.when(t == "%%", F.lit("%"))
        for key, pat in DIRECTIVES.items():
            expr = expr.when(t == "%" + key, F.date_format(ts, pat))
        return expr.when(t.startswith("%"), F.lit(None)).otherwise(t)

    parts = F.transform(_tokens(fmt), render)
    return F.when(strftime_error(fmt), F.lit(None).cast("string")).otherwise(F.array_join(parts, ""))
