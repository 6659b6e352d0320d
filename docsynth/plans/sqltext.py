"""SQL text (DuckDB dialect) of the library's column functions.

Used only to write the independent oracle queries the driver runs next to the
Spark queries; nothing in the library executes these strings.
"""

from __future__ import annotations

from ..functions.draws import sql_choice, sql_index, sql_pick_char, sql_randint, sql_str, sql_u01, sql_uniform
from ..functions.generators import DIGITS, LOWER, UPPER, day_count, second_count, FEMALE_HONORIFICS, MALE_HONORIFIC

__all__ = ["sql_u01", "sql_randint", "sql_uniform", "sql_choice", "sql_index", "sql_str", "truthy", "cap",
           "alphanum", "date_value", "datetime_value", "values_clause", "honorific", "gender"]


def truthy(v: str) -> str:
    return f"({v} IS NOT NULL AND {v} <> '' AND {v} <> 'False')"


def cap(v: str) -> str:
    return f"(upper(substr({v}, 1, 1)) || lower(substr({v}, 2)))"


def _mask_case(c: str, u: str, keep: bool) -> str:
    other = c if keep else "''"
    return (f"CASE {c} WHEN 'n' THEN {sql_pick_char(DIGITS, u)} WHEN 'C' THEN {sql_pick_char(UPPER, u)} "
            f"WHEN 'c' THEN {sql_pick_char(LOWER, u)} ELSE {other} END")


def alphanum(mask: str, seed: int, *keys: str, keep: bool = False) -> str:
    u = sql_u01(seed, *keys, "'an'", "i - 1")
    chars = f"list_filter(string_split({mask}, ''), lambda c: c <> '')"
    return f"array_to_string(list_transform({chars}, lambda c, i: {_mask_case('c', u, keep)}), '')"


def alphanum_literal(mask: str, seed: int, *keys: str, keep: bool = False) -> str:
    parts = [_mask_case(sql_str(ch), sql_u01(seed, *keys, "'an'", str(i)), keep) for i, ch in enumerate(mask)]
    return "(" + " || ".join(parts) + ")" if parts else "''"


_DIRECTIVES = "dmYyHMSIpBbAaj"


def strftime_any(ts: str, fmt: str) -> str:
    """strftime with a per-row format: DuckDB wants a constant format, so the
    format is split into tokens and each directive rendered on its own."""
    cases = " ".join(f"WHEN '%{d}' THEN strftime({ts}, '%{d}')" for d in _DIRECTIVES)
    toks = f"regexp_extract_all({fmt}, '(%.|%$|[^%]+)', 1)"
    body = f"array_to_string(list_transform({toks}, lambda t: CASE t WHEN '%%' THEN '%' {cases} ELSE t END), '')"
    return f"(CASE WHEN regexp_full_match({fmt}, '(%[{_DIRECTIVES}%]|[^%])*') THEN {body} END)"


def date_value(fmt: str, seed: int, *keys: str, start: str = "2021-01-01", days: int | None = None) -> str:
    n = days if days is not None else day_count()
    d = f"(DATE '{start}' + CAST(floor({sql_u01(seed, *keys, chr(39) + 'date' + chr(39))} * {n}) AS INTEGER))"
    return strftime_any(d, f"split_part({fmt}, ' ', 1)")


def datetime_value(fmt: str, seed: int, *keys: str, start: str = "2021-01-01 00:00:00") -> str:
    secs = f"CAST(floor({sql_u01(seed, *keys, chr(39) + 'datetime' + chr(39))} * {second_count()}) AS BIGINT)"
    return strftime_any(f"(TIMESTAMP '{start}' + to_seconds({secs}))", fmt)


def gender(given: str, seed: int, *keys: str) -> str:
    return (f"CASE WHEN {given} IN ('male', 'female') THEN {given} "
            f"ELSE {sql_choice(['male', 'female'], seed, *keys, chr(39) + 'gender' + chr(39))} END")


def honorific(g: str, seed: int, *keys: str) -> str:
    return (f"CASE WHEN {g} = 'male' THEN {sql_str(MALE_HONORIFIC)} "
            f"ELSE {sql_choice(FEMALE_HONORIFICS, seed, *keys, chr(39) + 'honorific' + chr(39))} END")


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return sql_str(str(v))


def values_clause(rows, columns, types=None) -> str:
    """``(VALUES ...) AS t(cols)`` with optional casts of the first row."""
    body = []
    for j, r in enumerate(rows):
        vals = []
        for i, v in enumerate(r):
            s = _lit(v)
            if types and j == 0:
                s = f"CAST({s} AS {types[i]})"
            vals.append(s)
        body.append("(" + ", ".join(vals) + ")")
    return "(VALUES " + ", ".join(body) + ") AS t(" + ", ".join(columns) + ")"
