"""DuckDB SQL oracles, one per registered query (same names and columns)."""

from __future__ import annotations

from . import sqltext as S
from .fixtures import FIELD_COLUMNS, SEED, TEMPLATE_FIELDS
from .queries import (ALNUM_MASKS, BAD_FORMATS, DATE_FORMATS, DATETIME_FORMATS, FLAG_TEXTS, MANIFEST_BASE)
from ..operators.augplan import CATALOG, expected_rate, gate_threshold, member_interval
from .fixtures import DEFAULT_ADVANCE, HELVETICA_WIDTHS, TEMPLATE_SIZES
from ..sources.dictionaries import (COMPANY_ADJECTIVES, COMPANY_NOUNS, EMAIL_DOMAINS, EMAIL_SEPARATORS)

_FIELD_TYPES = ["VARCHAR", "INTEGER", "VARCHAR", "INTEGER", "INTEGER", "INTEGER", "INTEGER"] + ["VARCHAR"] * 12


def _fields_cte() -> str:
    return f"fields AS (SELECT * FROM {S.values_clause(TEMPLATE_FIELDS, FIELD_COLUMNS, _FIELD_TYPES)})"


def _docs_cte() -> str:
    return ("docs AS (SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS doc_id, "
            "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'invoice' ELSE 'w2' END AS template_id "
            "FROM customer)")


def _name_dict_ctes() -> str:
    t1, t2 = S.cap("split_part(p_name, ' ', 1)"), S.cap("split_part(p_name, ' ', 2)")
    return f"""
p_words AS (SELECT {t1} AS t1, {t2} AS t2,
    CASE WHEN p_size % 2 = 0 THEN 'male' ELSE 'female' END AS g_size,
    CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 2 = 0 THEN 'male' ELSE 'female' END AS g_brand
  FROM part),
first_w AS (SELECT t1 AS name, g_size AS gender, COUNT(*) AS weight FROM p_words WHERE t1 <> '' GROUP BY 1, 2),
first_i AS (SELECT name, gender,
    CAST(SUM(weight) OVER (PARTITION BY gender ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - weight AS DOUBLE)
      / CAST(SUM(weight) OVER (PARTITION BY gender) AS DOUBLE) AS lo,
    CAST(SUM(weight) OVER (PARTITION BY gender ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
      / CAST(SUM(weight) OVER (PARTITION BY gender) AS DOUBLE) AS hi
  FROM first_w),
last_w AS (SELECT t2 AS name, COUNT(*) AS weight FROM p_words WHERE t2 <> '' GROUP BY 1),
last_i AS (SELECT name,
    CAST(SUM(weight) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - weight AS DOUBLE)
      / CAST(SUM(weight) OVER () AS DOUBLE) AS lo,
    CAST(SUM(weight) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
      / CAST(SUM(weight) OVER () AS DOUBLE) AS hi
  FROM last_w),
anyfirst_w AS (SELECT name, SUM(weight) AS weight FROM first_w GROUP BY 1),
anyfirst_i AS (SELECT name,
    CAST(SUM(weight) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - weight AS DOUBLE)
      / CAST(SUM(weight) OVER () AS DOUBLE) AS lo,
    CAST(SUM(weight) OVER (ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
      / CAST(SUM(weight) OVER () AS DOUBLE) AS hi
  FROM anyfirst_w),
ind_w AS (SELECT DISTINCT trim(concat_ws(' ', t1, t2)) AS name, g_brand AS gender FROM p_words
  WHERE trim(concat_ws(' ', t1, t2)) <> ''),
ind_i AS (SELECT name, gender, row_number() OVER (PARTITION BY gender ORDER BY name) - 1 AS idx,
    COUNT(*) OVER (PARTITION BY gender) AS n FROM ind_w)"""


def _name_sql(alias: str, keys: tuple[str, ...], name_type: str, gender: str, indian: str, suffix: str,
              need: str) -> tuple[str, str, str]:
    """(joins, name expression, error expression) for rows aliased ``alias``
    that already carry a resolved gender column ``{alias}.g``."""
    k = tuple(f"{alias}.{x}" for x in keys)
    u_first = S.sql_u01(SEED, *k, "'first'")
    u_last = S.sql_u01(SEED, *k, "'last'")
    u_ind = S.sql_u01(SEED, *k, "'indian'")
    ind = S.truthy(f"{alias}.{indian}")
    joins = f"""
  LEFT JOIN first_i fi ON ({need}) AND NOT {ind} AND fi.gender = {alias}.g AND {u_first} >= fi.lo AND {u_first} < fi.hi
  LEFT JOIN last_i li ON ({need}) AND NOT {ind} AND {u_last} >= li.lo AND {u_last} < li.hi
  LEFT JOIN ind_i ii ON ({need}) AND {ind} AND ii.gender = {alias}.g AND ii.idx = CAST(floor({u_ind} * ii.n) AS BIGINT)"""
    nt = f"{alias}.{name_type}"
    ind_name = (f"CASE WHEN {nt} = 'first_name' THEN split_part(ii.name, ' ', 1) "
                f"WHEN {nt} = 'last_name' THEN NULLIF(split_part(ii.name, ' ', 2), '') ELSE ii.name END")
    plain = (f"CASE WHEN {nt} = 'first_name' THEN fi.name WHEN {nt} = 'last_name' THEN li.name "
             f"ELSE concat_ws(' ', fi.name, li.name) END")
    base = f"(CASE WHEN {ind} THEN {ind_name} ELSE {plain} END)"
    name = (f"CASE WHEN {S.truthy(alias + '.' + suffix)} AND {base} IS NOT NULL "
            f"THEN {S.honorific(alias + '.g', SEED, *k)} || {base} ELSE {base} END")
    err = (f"CASE WHEN {ind} AND {nt} = 'last_name' AND ii.name IS NOT NULL AND len(string_split(ii.name, ' ')) < 2 "
           f"THEN 'indian_name_without_last' END")
    return joins, name, err


def _values_ctes() -> str:
    a, d, n = S.truthy("is_alphanum"), S.truthy("is_date"), S.truthy("is_name")
    kind = f"CASE WHEN {a} THEN 'alphanum' WHEN {d} THEN 'date' WHEN {n} THEN 'name' END"
    bad_fmt = "NOT regexp_full_match(split_part(date_format, ' ', 1), '(%[dmYyHMSIpBbAaj%]|[^%])*')"
    err = ("CASE WHEN kind = 'alphanum' AND mask IS NULL THEN 'V1_alphanum_without_mask' "
           "WHEN kind = 'date' AND date_format IS NULL THEN 'V2_date_without_format' "
           "WHEN kind = 'name' AND name_type = 'n/a' THEN 'V3_name_type_na' "
           "WHEN kind = 'alphanum' AND mask = '' THEN 'V4_empty_mask' "
           "WHEN static_value IN ('True', 'False') THEN 'V6_static_is_boolean' "
           f"WHEN kind = 'date' AND {bad_fmt} THEN 'V18_unsupported_date_format' END")
    joins, name, name_err = _name_sql("r", ("doc_id", "pos"), "name_type", "name_gender", "name_indian",
                                      "name_suffix", "r.kind = 'name' AND r.error IS NULL")
    gen = (f"CASE WHEN r.kind = 'alphanum' THEN {S.alphanum('r.mask', SEED, 'r.doc_id', 'r.pos')} "
           f"WHEN r.kind = 'date' THEN {S.date_value('r.date_format', SEED, 'r.doc_id', 'r.pos')} "
           f"WHEN r.kind = 'name' THEN {name} END")
    return f"""{_fields_cte()},
{_docs_cte()},
{_name_dict_ctes()},
tf AS (SELECT *, {kind} AS kind FROM fields WHERE type = 'textbox'),
tf2 AS (SELECT *, {err} AS error FROM tf WHERE kind IS NOT NULL),
rows AS (SELECT d.doc_id, f.*, {S.gender('f.name_gender', SEED, 'd.doc_id', 'f.pos')} AS g
  FROM docs d JOIN tf2 f ON d.template_id = f.template_id),
gen AS (SELECT r.doc_id, r.template_id, r.pos, r.field_name, r.kind, r.static_value,
    {gen} AS generated, coalesce(r.error, {name_err}) AS error
  FROM rows r {joins}),
vals AS (SELECT doc_id, template_id, pos, field_name, kind,
    CASE WHEN error IS NULL THEN
      CASE WHEN static_value IS NOT NULL AND length(static_value) > 1 THEN static_value ELSE generated END
    END AS value, error
  FROM gen)"""


def generate_values() -> str:
    return f"WITH {_values_ctes()}\nSELECT doc_id, template_id, pos, field_name, kind, value, error FROM vals"



def _list(items) -> str:
    return "[" + ", ".join("NULL" if x is None else S.sql_str(x) for x in items) + "]"


def _explode(items, idx: str, val: str) -> str:
    """``(SELECT ...) AS t(idx, val)`` with 0-based positions, like posexplode."""
    rows = ", ".join(f"({i}, {S.sql_str(x)})" for i, x in enumerate(items))
    return f"(VALUES {rows}) AS lit({idx}, {val})"


def gen_alphanum() -> str:
    k = ("c.c_custkey", "m.mask_no")
    return f"""SELECT c.c_custkey, m.mask_no, m.mask,
  {S.alphanum('m.mask', SEED, *k)} AS value,
  {S.alphanum('m.mask', SEED, *k, keep=True)} AS value_keep
FROM customer c, {_explode(ALNUM_MASKS, 'mask_no', 'mask').replace('AS lit', 'AS m')}"""


def gen_date() -> str:
    return f"""SELECT o.o_orderkey, f.fmt_no, f.fmt, {S.date_value('f.fmt', SEED, 'o.o_orderkey', 'f.fmt_no')} AS value
FROM orders o, {_explode(DATE_FORMATS, 'fmt_no', 'fmt').replace('AS lit', 'AS f')}"""


def gen_datetime() -> str:
    return f"""SELECT o.o_orderkey, f.fmt_no, f.fmt, {S.datetime_value('f.fmt', SEED, 'o.o_orderkey', 'f.fmt_no')} AS value
FROM orders o, {_explode(DATETIME_FORMATS, 'fmt_no', 'fmt').replace('AS lit', 'AS f')}"""


def split_errors() -> str:
    ok = "regexp_full_match(split_part(f.fmt, ' ', 1), '(%[dmYyHMSIpBbAaj%]|[^%])*')"
    return f"""SELECT o.o_orderkey, f.fmt_no, f.fmt, {S.date_value('f.fmt', SEED, 'o.o_orderkey', 'f.fmt_no')} AS value,
  CASE WHEN NOT {ok} THEN 'V18_unsupported_date_format' END AS error,
  CASE WHEN {ok} THEN 'good' ELSE 'rejected' END AS side
FROM orders o, {_explode(BAD_FORMATS, 'fmt_no', 'fmt').replace('AS lit', 'AS f')}"""


def gen_number() -> str:
    return f"""SELECT o_orderkey, {S.sql_randint('10000', '99999', SEED, 'o_orderkey', "'int'")} AS value,
  {S.sql_randint('0', 'CAST(floor(o_totalprice) AS BIGINT)', SEED, 'o_orderkey', "'range'")} AS value_range
FROM orders"""


def _decimal(lo: str, hi: str, key: str) -> str:
    return f"round_even({S.sql_uniform(lo, hi, SEED, key, chr(39) + 'dec' + chr(39))}, 2)"


def gen_decimal() -> str:
    return f"SELECT o_orderkey, {_decimal('1000', '9999', 'o_orderkey')} AS value FROM orders"


def gen_currency() -> str:
    body = "format('{:,.2f}', abs(amount))"
    sign = "CASE WHEN amount < 0 THEN '-' ELSE '' END"
    return f"""WITH a AS (SELECT o_orderkey, {_decimal('-50000', '50000', 'o_orderkey')} AS amount FROM orders)
SELECT o_orderkey, amount, {sign} || '$' || {body} AS usd, {sign} || {body} AS usd_plain,
  {sign} || '$' || replace({body}, ',', '') AS usd_ungrouped FROM a"""


def static_override() -> str:
    return f"""WITH c AS (SELECT c_custkey, {S.alphanum_literal('nnnn', SEED, 'c_custkey')} AS generated,
    CASE c_custkey % 4 WHEN 1 THEN 'X' WHEN 2 THEN c_mktsegment WHEN 3 THEN '' END AS static_value FROM customer)
SELECT c_custkey, generated, static_value,
  CASE WHEN static_value IS NOT NULL AND length(static_value) > 1 THEN static_value ELSE generated END AS value FROM c"""


def field_kinds() -> str:
    n = len(FLAG_TEXTS)
    flags = _list(FLAG_TEXTS)
    a, d, nm = S.truthy("is_alphanum"), S.truthy("is_date"), S.truthy("is_name")
    return f"""WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'checkbox' ELSE 'textbox' END AS type,
    {flags}[c_custkey % {n} + 1] AS is_alphanum,
    {flags}[CAST(floor(c_custkey / {n}) AS BIGINT) % {n} + 1] AS is_date,
    {flags}[CAST(floor(c_custkey / {n * n}) AS BIGINT) % {n} + 1] AS is_name FROM customer),
k AS (SELECT *, CASE WHEN {a} THEN 'alphanum' WHEN {d} THEN 'date' WHEN {nm} THEN 'name' END AS kind
  FROM f WHERE type = 'textbox')
SELECT c_custkey, type, is_alphanum, is_date, is_name, kind FROM k WHERE kind IS NOT NULL"""


def sample_uniform() -> str:
    u = S.sql_u01(SEED, "e.event_id", "'supplier'")
    return f"""WITH d AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx,
    COUNT(*) OVER () AS n FROM supplier)
SELECT e.event_id, d.s_suppkey, d.s_name FROM events e LEFT JOIN d ON d.idx = CAST(floor({u} * d.n) AS BIGINT)"""


def _weighted_cte(name: str, src: str, order: str = "word") -> str:
    cum = f"SUM(weight) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""{name} AS (SELECT *, CAST({cum} - weight AS DOUBLE) / CAST(SUM(weight) OVER () AS DOUBLE) AS lo,
    CAST({cum} AS DOUBLE) / CAST(SUM(weight) OVER () AS DOUBLE) AS hi FROM ({src}))"""


def sample_weighted() -> str:
    u = S.sql_u01(SEED, "e.event_id", "'word'")
    words = ("SELECT word, COUNT(*) AS weight FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) "
             "WHERE word <> '' GROUP BY 1")
    return f"""WITH {_weighted_cte('d', words)}
SELECT e.event_id, d.word FROM events e LEFT JOIN d ON {u} >= d.lo AND {u} < d.hi"""


def sample_weighted_grouped() -> str:
    u = S.sql_u01(SEED, "e.event_id", "'grouped'")
    cum = "SUM(weight) OVER (PARTITION BY grp ORDER BY word ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""WITH w AS (SELECT grp, word, COUNT(*) AS weight FROM (SELECT unnest(string_split(p_name, ' ')) AS word,
    CAST(least(floor(p_size / 10), 2) AS INTEGER) AS grp FROM part) WHERE word <> '' GROUP BY 1, 2),
d AS (SELECT *, CAST({cum} - weight AS DOUBLE) / CAST(SUM(weight) OVER (PARTITION BY grp) AS DOUBLE) AS lo,
    CAST({cum} AS DOUBLE) / CAST(SUM(weight) OVER (PARTITION BY grp) AS DOUBLE) AS hi FROM w),
e AS (SELECT event_id, CAST(event_id % 4 AS INTEGER) AS grp FROM events)
SELECT e.event_id, e.grp, d.word FROM e LEFT JOIN d ON d.grp = e.grp AND {u} >= d.lo AND {u} < d.hi"""


def _customer_params_cte() -> str:
    return """cp AS (SELECT c_custkey, c_name, c_nationkey,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'first_name' WHEN 'MACHINERY' THEN 'last_name' ELSE 'full' END AS name_type,
    CASE c_nationkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'x' END AS name_gender,
    CASE WHEN c_acctbal < 1000 THEN 'True' ELSE 'False' END AS name_indian,
    CASE WHEN c_nationkey % 4 = 0 THEN 'True' ELSE 'False' END AS name_suffix FROM customer)"""


def gen_name() -> str:
    joins, name, err = _name_sql("r", ("c_custkey",), "name_type", "name_gender", "name_indian", "name_suffix",
                                 "TRUE")
    return f"""WITH {_name_dict_ctes()},
{_customer_params_cte()},
rows AS (SELECT cp.*, {S.gender('cp.name_gender', SEED, 'cp.c_custkey')} AS g FROM cp)
SELECT r.c_custkey, {name} AS name, {err} AS name_error FROM rows r {joins}"""


def _address_cte() -> str:
    return """book AS (SELECT s_suppkey,
    CAST(s_suppkey AS VARCHAR) || ' ' || n_name || ' Road' AS address1,
    CASE WHEN s_acctbal > 5000 THEN ' Apt ' || CAST(CAST(floor(s_acctbal) AS BIGINT) % 100 AS VARCHAR) ELSE '' END AS address2,
    CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE 'City' || CAST(s_nationkey AS VARCHAR) END AS city,
    r_name AS state, lpad(CAST(s_suppkey * 37 % 100000 AS VARCHAR), 5, '0') AS postal_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
bi AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx, COUNT(*) OVER () AS n FROM book)"""


def _address_rows(extra: str = "") -> str:
    u = S.sql_u01(SEED, "c.c_custkey", "'address'")
    return f"""WITH {_address_cte()},
addr AS (SELECT c.c_custkey, c.c_name, bi.address1 || coalesce(bi.address2, '') AS address, bi.city, bi.state,
    bi.postal_code FROM customer c LEFT JOIN bi ON bi.idx = CAST(floor({u} * bi.n) AS BIGINT))"""


def gen_address() -> str:
    return _address_rows() + "\nSELECT c_custkey, address, city, state, postal_code FROM addr"


def gen_address_text() -> str:
    tail = "CASE WHEN city IS NOT NULL THEN city || ', ' || state || ' ' || postal_code ELSE state || ' ' || postal_code END"
    body = f"address || chr(10) || ({tail})"
    return _address_rows() + (f"\nSELECT c_custkey, CASE WHEN c_name IS NOT NULL AND c_name <> '' "
                              f"THEN c_name || chr(10) || {body} ELSE {body} END AS text FROM addr")


def _pick2(a: str, b: str, u: str) -> str:
    return f"CASE WHEN {S.sql_index('2', u)} = 0 THEN {a} ELSE {b} END"


def gen_email() -> str:
    k = "c.c_custkey"
    uf, ul = S.sql_u01(SEED, k, "'email_first'"), S.sql_u01(SEED, k, "'email_last'")
    n_letters = S.sql_randint("5", "10", SEED, "c_custkey", "'email_len'")
    letters = S.alphanum(f"repeat('c', CAST({n_letters} AS INTEGER))", SEED, "c_custkey", "'email_letters'")
    year = f"CAST({S.sql_randint('1900', '2030', SEED, 'c_custkey', chr(39) + 'email_year' + chr(39))} AS VARCHAR)"

    def seg(i: int) -> str:
        a = _pick2("letters", "efirst", S.sql_u01(SEED, "c_custkey", "'email_a'", str(i)))
        sep = S.sql_choice(EMAIL_SEPARATORS, SEED, "c_custkey", "'email_sep'", str(i))
        b = _pick2("elast", "year", S.sql_u01(SEED, "c_custkey", "'email_b'", str(i)))
        return f"(({a}) || {sep} || ({b}))"

    nseg = S.sql_randint("1", "2", SEED, "c_custkey", "'email_segs'")
    dom = (f"CASE WHEN c_nationkey % 2 = 0 THEN {S.sql_choice(EMAIL_DOMAINS, SEED, 'c_custkey', chr(39) + 'email_domain' + chr(39))} "
           f"ELSE 'gmail.com' END")
    return f"""WITH {_name_dict_ctes()},
base AS (SELECT c.c_custkey, c.c_nationkey, af.name AS efirst, li.name AS elast FROM customer c
  LEFT JOIN anyfirst_i af ON {uf} >= af.lo AND {uf} < af.hi
  LEFT JOIN last_i li ON {ul} >= li.lo AND {ul} < li.hi),
parts AS (SELECT *, {letters} AS letters, {year} AS year FROM base)
SELECT c_custkey, {seg(0)} || CASE WHEN {nseg} = 2 THEN {seg(1)} ELSE '' END || '@' || ({dom}) AS email FROM parts"""


def gen_company() -> str:
    k = "c.c_custkey"
    form = S.sql_randint("1", "3", SEED, k, "'company_form'")
    uf = S.sql_u01(SEED, k, "'company_first'")
    adj = S.sql_choice(COMPANY_ADJECTIVES, SEED, k, "'company_adj'")
    noun = S.sql_choice(COMPANY_NOUNS, SEED, k, "'company_noun'")
    return f"""WITH {_name_dict_ctes()}
SELECT c.c_custkey, CASE WHEN {form} = 1 THEN concat_ws(' ', {adj}, {noun})
  WHEN {form} = 2 THEN concat_ws(' ', af.name, {noun}) ELSE concat_ws(' ', af.name, {adj}, {noun}) END AS company
FROM customer c LEFT JOIN anyfirst_i af ON {form} <> 1 AND {uf} >= af.lo AND {uf} < af.hi"""


def _records_cte() -> str:
    return f"""{_values_ctes()},
good AS (SELECT *, min(pos) OVER (PARTITION BY doc_id, field_name) AS first_pos,
    max(pos) OVER (PARTITION BY doc_id, field_name) AS last_pos FROM vals WHERE error IS NULL),
win AS (SELECT * FROM good WHERE pos = last_pos)"""


def assemble_records() -> str:
    return f"""WITH {_records_cte()}
SELECT doc_id, template_id, CAST(COUNT(*) AS INTEGER) AS n_fields,
  string_agg(field_name || '=' || value, ';' ORDER BY first_pos) AS record_kv FROM win GROUP BY doc_id, template_id"""


def record_json() -> str:
    return f"""WITH {_records_cte()}
SELECT doc_id, '{{"textbox":{{' || string_agg(to_json(field_name) || ':' || to_json(value), ',' ORDER BY first_pos)
  || '}}}}' AS json FROM win GROUP BY doc_id"""


def parse_annotations() -> str:
    tid = "'part_' || CAST(p_partkey AS VARCHAR)"
    return f"""SELECT {tid} AS template_id, 0 AS pos, 'textbox' AS type,
  CAST(trunc(p_retailprice) AS INTEGER) AS xmin, p_size AS ymin, CAST(trunc(p_retailprice + 100.0) AS INTEGER) AS xmax,
  p_size + 20 AS ymax, CASE WHEN p_size > 40 THEN p_name ELSE p_brand END AS field_name,
  CAST(p_size AS VARCHAR) AS max_length, CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS is_alphanum,
  CASE WHEN p_type = 'SMALL' THEN NULL ELSE 'nnn-nn' END AS mask, ' ' || p_type || ' ' AS static_value,
  p_size * 20 AS width, p_size * 25 AS height FROM part
UNION ALL
SELECT {tid}, 1, 'checkbox', -1, 0, 10, 10, 'chk_' || CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, NULL,
  p_size * 20, p_size * 25 FROM part"""


def nested_annotations() -> str:
    return """WITH p AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id, p_partkey, p_brand, p_type, p_size, p_size % 3 <> 0 AS nested FROM part),
o AS (
  SELECT template_id, 0 AS pos, 'textbox' AS type, p_size AS xmin, 10 AS ymin, p_size + 100 AS xmax, 30 AS ymax,
    CASE WHEN nested AND p_size % 2 = 0 THEN 'in & <' || CAST(p_partkey AS VARCHAR) ELSE p_brand END AS field_name,
    CAST(p_size AS VARCHAR) AS max_length, CASE WHEN nested THEN 'True' END AS is_alphanum FROM p
  UNION ALL SELECT template_id, 1, 'checkbox', 1, 2, 3, 4, 'in & <' || CAST(p_partkey AS VARCHAR), NULL, 'True' FROM p WHERE nested
  UNION ALL SELECT template_id, CASE WHEN nested THEN 2 ELSE 1 END, 'textbox', 5, 6, 7, 8, p_type || ' ü', NULL, NULL FROM p)
SELECT template_id, CAST(pos AS INTEGER) AS pos, type, CAST(xmin AS INTEGER) AS xmin, CAST(ymin AS INTEGER) AS ymin, CAST(xmax AS INTEGER) AS xmax,
  CAST(ymax AS INTEGER) AS ymax, field_name, max_length, is_alphanum FROM o"""


def xml_records() -> str:
    joins, name, _ = _name_sql("r", ("doc_id", "pos"), "name_type", "name_gender", "name_indian", "name_suffix", "TRUE")
    return f"""WITH {_name_dict_ctes()},
good AS (SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS template_id, c_nationkey FROM customer
  WHERE c_acctbal >= 0 AND c_nationkey NOT IN (3, 5, 7, 9, 13, 17) AND c_mktsegment NOT IN ('BUILDING', 'FURNITURE')),
docs AS (SELECT template_id || '_' || CAST(i AS VARCHAR) AS doc_id, template_id, c_nationkey FROM good, (SELECT unnest(range(0, 2)) AS i)),
rows AS (SELECT *, 1 AS pos, 'full' AS name_type, NULL AS name_indian, NULL AS name_suffix, {S.gender("NULL", SEED, 'doc_id', '1')} AS g FROM docs),
v AS (SELECT r.doc_id, r.template_id, r.c_nationkey, {S.alphanum_literal('nnnn', SEED, 'r.doc_id', '0')} AS acct, {name} AS holder FROM rows r {joins})
SELECT doc_id, template_id, CAST(CASE WHEN c_nationkey = 11 THEN 1 ELSE 2 END AS INTEGER) AS n_fields,
  CASE WHEN c_nationkey = 11 THEN 'acct=' || holder ELSE 'acct=' || acct || ';holder=' || holder END AS record_kv FROM v"""


def document_records() -> str:
    ctes = _records_cte().replace(_docs_cte(), """alldocs AS (SELECT 'cust_' || CAST(c_custkey AS VARCHAR) AS doc_id, c_nationkey,
    CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'invoice' ELSE 'w2' END AS form FROM customer),
docs AS (SELECT doc_id, CASE c_nationkey WHEN 4 THEN 'blank' WHEN 6 THEN 'lost_' || form ELSE form END AS template_id FROM alldocs)""")
    return f"""WITH {ctes},
rec AS (SELECT doc_id, COUNT(*) AS n, string_agg(field_name || '=' || value, ';' ORDER BY first_pos) AS kv FROM win GROUP BY doc_id)
SELECT d.doc_id, d.template_id, CAST(coalesce(n, 0) AS INTEGER) AS n_fields, coalesce(kv, '') AS record_kv,
  CASE WHEN d.template_id LIKE 'lost\\_%' ESCAPE '\\' THEN 'unknown_template' END AS error FROM docs d LEFT JOIN rec USING (doc_id)"""


def validate_templates() -> str:
    tid = "'cust_' || CAST(c_custkey AS VARCHAR)"
    ok = "c_nationkey <> 7"
    rows = [
        ("-1", "NULL", "'V14_unparsable_xml'", "c_nationkey = 7"),
        ("-1", "NULL", "'V9_size_missing'", f"{ok} AND c_nationkey = 3"),
        ("-1", "NULL", "'V10_size_not_integer'", f"{ok} AND c_acctbal < 0"),
        ("0", "'acct'", "'V9_box_not_number'", f"{ok} AND c_nationkey = 17"),
        ("0", "'acct'", "'V1_alphanum_without_mask'", f"{ok} AND c_mktsegment = 'BUILDING'"),
        ("0", "'acct'", "'V6_static_is_boolean'", f"{ok} AND c_nationkey = 5"),
        ("0", "'acct'", "'V8_max_length_not_number'", f"{ok} AND c_nationkey = 9"),
        ("1", "CASE WHEN c_nationkey = 11 THEN 'acct' ELSE 'holder' END", "'V5_required_key_missing'",
         f"{ok} AND c_nationkey = 13"),
        ("1", "CASE WHEN c_nationkey = 11 THEN 'acct' ELSE 'holder' END", "'V3_name_type_na'",
         f"{ok} AND c_nationkey <> 13 AND c_mktsegment = 'FURNITURE'"),
        ("1", "'acct'", "'V12_duplicate_field_name'", f"{ok} AND c_nationkey = 11"),
        ("1", "CASE WHEN c_nationkey = 11 THEN 'acct' ELSE 'holder' END", "'V13_font_size_not_positive'",
         f"{ok} AND c_mktsegment = 'AUTOMOBILE'"),
    ]
    parts = [f"SELECT {tid} AS template_id, CAST({p} AS INTEGER) AS pos, CAST({f} AS VARCHAR) AS field_name, "
             f"{r} AS rule FROM customer WHERE {w}" for p, f, r, w in rows]
    return "\nUNION ALL\n".join(parts)


def date_templates() -> str:
    # formats by number, as text of this query; (reads both bounds, can be rendered), worked out by hand
    verdicts = [(True, True), (False, True), (True, True), (False, True), (True, True), (False, True), (False, True), (False, False), None, (True, True),
                (True, True), (False, True), (False, True), (False, False), (True, True)]
    bad = [i for i, v in enumerate(verdicts) if v and not v[0]]
    odd = [i for i, v in enumerate(verdicts) if v and not v[1]]
    n, empty = len(verdicts), verdicts.index(None)
    rules = [("V17_size_not_positive", "-1", "NULL", "p_size % 11 = 0"), ("V9_box_missing", "0", "name", "p_size % 13 = 0"),
             ("V16_field_name_empty", "0", "name", "p_size % 10 = 0"), ("V2_date_without_format", "0", "name", f"p_partkey % {n} = {empty}"),
             ("V7_date_format_rejects_bounds", "0", "name", f"p_partkey % {n} IN ({', '.join(map(str, bad))})"),
             ("V18_unsupported_date_format", "0", "name", f"p_partkey % {n} IN ({', '.join(map(str, odd))})"),
             ("V15_duplicate_template_id", "-1", "NULL", "p_partkey % 50 = 0")]
    parts = [f"SELECT template_id, CAST({pos} AS INTEGER) AS pos, CAST({name} AS VARCHAR) AS field_name, '{rule}' AS rule FROM p WHERE {where}"
             for rule, pos, name, where in rules]
    # a field repeats its name in its template only if it comes later; each of the copies of one id has one field
    return ("WITH p AS (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN 'twice' ELSE 'part_' || CAST(p_partkey AS VARCHAR) END AS template_id, "
            "CASE WHEN p_size % 10 <> 0 THEN 'day' END AS name FROM part)\n" + "\nUNION ALL\n".join(parts))


def _part_templates_cte() -> str:
    return ("t AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id, "
            "replace(p_name, ' ', '_') || '.' || CAST(p_partkey AS VARCHAR) AS stem FROM part),"
            "d AS (SELECT t.*, i AS doc_index, t.stem || '_' || CAST(i AS VARCHAR) AS doc_id FROM t, range(5) r(i))")


def expand_documents() -> str:
    return f"WITH {_part_templates_cte()} SELECT doc_id, template_id, doc_index FROM d"


def expand_hot_template() -> str:
    return """WITH t AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id,
    CASE WHEN p_partkey % 997 = 1 THEN p_size * 1000 ELSE p_size % 2 END AS n FROM part)
SELECT t.template_id || '_' || CAST(r.i AS VARCHAR) AS doc_id, t.template_id, r.i AS doc_index
FROM t, LATERAL (SELECT range AS i FROM range(t.n)) r"""


def expand_parts() -> str:
    return """WITH t AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id, p_size AS n FROM part)
SELECT t.template_id || '_' || CAST(r.i AS VARCHAR) AS doc_id, t.template_id, r.i AS doc_index
FROM t, LATERAL (SELECT range AS i FROM range(t.n)) r"""


def manifest() -> str:
    b = MANIFEST_BASE
    return (f"WITH {_part_templates_cte()} SELECT doc_id, template_id, "
            f"'{b}/jsons/' || doc_id || '.json' AS json_path, '{b}/pdfs/' || doc_id || '.pdf' AS pdf_path, "
            f"'{b}/images/' || doc_id || '.png' AS image_path, '{b}/txts/' || doc_id || '.txt' AS txt_path FROM d")


def pair_by_position() -> str:
    return """WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS rank FROM documents),
b AS (SELECT page_id, row_number() OVER (ORDER BY url, page_id) - 1 AS rank FROM pages)
SELECT a.rank, a.doc_id, b.page_id FROM a JOIN b ON a.rank = b.rank"""


def pair_by_stem_report() -> str:
    return """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
  CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'matched'
       WHEN d.doc_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS status
FROM documents d FULL OUTER JOIN (SELECT doc_id + 3 AS doc_id FROM labels) l ON d.doc_id = l.doc_id"""



def _d(x) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)" if x is not None else "CAST(NULL AS DOUBLE)"


def combine_boxes() -> str:
    x0 = "CAST(l_linenumber AS DOUBLE) * 10.0::DOUBLE"
    return f"""SELECT l_orderkey, min({x0}) AS x0, min(l_quantity) AS y0,
  max({x0} + l_extendedprice / 1000.0::DOUBLE) AS x1, max(l_quantity + l_tax * 100.0::DOUBLE) AS y1
FROM lineitem GROUP BY l_orderkey"""


def _words_sql(glyphs: str, carry: str = "") -> str:
    """Gaps-and-islands words over a glyph relation (doc_id, page, line, pos, ch, x0..y1)."""
    c = f", {carry}" if carry else ""
    return f"""gs AS (SELECT *, CASE WHEN ch IN (' ', chr(10)) THEN 1 ELSE 0 END AS sep FROM {glyphs}),
gi AS (SELECT *, SUM(sep) OVER (PARTITION BY doc_id, page, line ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island,
    SUM(sep) OVER (PARTITION BY doc_id, page, line) AS nsep FROM gs),
wd AS (SELECT doc_id, page, line, island{c}, string_agg(ch, '' ORDER BY pos) AS text,
    min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1
  FROM gi WHERE sep = 0 AND island < nsep GROUP BY doc_id, page, line, island{c}),
words AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, line, island) - 1 AS BIGINT) AS word_no
  FROM wd)"""


def words_from_glyphs() -> str:
    chars = "list_filter(string_split(ltext, ''), lambda c: c <> '')"
    return f"""WITH ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS ltext,
    CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line,
    len(string_split(text, chr(10))) AS nl
  FROM documents),
cs AS (SELECT doc_id, line, CASE WHEN line < nl - 1 THEN list_append({chars}, chr(10)) ELSE {chars} END AS cs FROM ln),
g0 AS (SELECT doc_id, 1 AS page, line, unnest(cs) AS ch, CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS pos
  FROM cs),
glyphs AS (SELECT doc_id, page, line, pos, ch, CAST(pos AS DOUBLE) * 6.0::DOUBLE AS x0,
    CAST(line AS DOUBLE) * 12.0::DOUBLE AS y0, CAST(pos AS DOUBLE) * 6.0::DOUBLE + 6.0::DOUBLE AS x1,
    CAST(line AS DOUBLE) * 12.0::DOUBLE + 10.0::DOUBLE AS y1 FROM g0),
{_words_sql('glyphs')}
SELECT doc_id, page, line, word_no, text, x0, y0, x1, y1 FROM words"""


def _widget_cols(xmin: str, ymin: str, xmax: str, ymax: str, width: str, height: str) -> dict[str, str]:
    pw = f"(CAST({width} AS DOUBLE) * 72.0::DOUBLE / 100.0::DOUBLE)"
    ph = f"(CAST({height} AS DOUBLE) * 72.0::DOUBLE / 100.0::DOUBLE)"
    sw, sh = f"({pw} / CAST({width} AS DOUBLE))", f"({ph} / CAST({height} AS DOUBLE))"
    x1, y1 = f"(CAST({xmin} AS DOUBLE) * {sh})", f"(CAST({ymin} AS DOUBLE) * {sw})"
    x2, y2 = f"(CAST({xmax} AS DOUBLE) * {sh})", f"(CAST({ymax} AS DOUBLE) * {sw})"
    by1, by2 = f"({ph} - {y2} - 1.0::DOUBLE)", f"({ph} - {y1} - 1.0::DOUBLE)"
    h = f"({by2} - {by1})"
    return {"x": x1, "y": by1, "w": f"({x2} - {x1})", "h": h,
            "font_size": f"CAST(trunc({h} - 4.0::DOUBLE) AS INTEGER)"}


def widgets() -> str:
    w = _widget_cols("xmin", "ymin", "xmax", "ymax", "width", "height")
    return f"""WITH f AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id, 0 AS pos,
    CASE WHEN p_size > 40 THEN p_name ELSE p_brand END AS name, CAST(p_size AS VARCHAR) AS max_length,
    CAST(trunc(p_retailprice) AS INTEGER) AS xmin, p_size AS ymin, CAST(trunc(p_retailprice + 100.0) AS INTEGER) AS xmax,
    p_size + 20 AS ymax, p_size * 20 AS width, p_size * 25 AS height FROM part)
SELECT template_id, pos, name, 1 AS page_number, {w['x']} AS x, {w['y']} AS y, {w['w']} AS w, {w['h']} AS h,
  TRY_CAST(max_length AS DOUBLE) AS max_length, 'Helvetica' AS font, {w['font_size']} AS font_size, -1 AS border_width
FROM f"""


def widgets_of_images() -> str:
    def cols(axes: str) -> str:
        pw, ph = "(iw * 72.0::DOUBLE / 100.0::DOUBLE)", "(ih * 72.0::DOUBLE / 100.0::DOUBLE)"
        sw, sh = f"({pw} / (p_size * 20)::DOUBLE)", f"({ph} / (p_size * 25)::DOUBLE)"
        sx, sy = (sh, sw) if axes == "swapped" else (sw, sh)
        low, high = f"({ph} - ymax * {sy} - 1.0::DOUBLE)", f"({ph} - ymin * {sy} - 1.0::DOUBLE)"
        return f"""SELECT template_id, '{axes}' AS axes, format, image_width, image_height, 0 AS pos, xmin * {sx} AS x, {low} AS y,
    xmax * {sx} - xmin * {sx} AS w, {high} - {low} AS h, CAST(trunc({high} - {low} - 4.0::DOUBLE) AS INTEGER) AS font_size FROM f"""

    return f"""WITH s AS (SELECT *, p_size * 20 + p_partkey % 7 * 10 AS w, p_size * 25 + p_partkey % 5 * 30 AS h,
    p_partkey % 3 <> 0 AND p_partkey % 11 = 0 AS cut FROM part),
f AS (SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS template_id, p_size, CASE WHEN cut THEN NULL WHEN p_partkey % 3 = 0 THEN 'png' ELSE 'jpeg' END AS format,
    CAST(CASE WHEN NOT cut THEN w END AS BIGINT) AS image_width, CAST(CASE WHEN NOT cut THEN h END AS BIGINT) AS image_height,
    CAST(CASE WHEN cut THEN p_size * 20 ELSE w END AS DOUBLE) AS iw, CAST(CASE WHEN cut THEN p_size * 25 ELSE h END AS DOUBLE) AS ih,
    trunc(p_retailprice)::DOUBLE AS xmin, p_size::DOUBLE AS ymin, trunc(p_retailprice + 100.0)::DOUBLE AS xmax, (p_size + 20)::DOUBLE AS ymax FROM s)
{cols('swapped')} UNION ALL {cols('straight')}"""


def _glyph_ctes() -> str:
    sizes = S.values_clause(TEMPLATE_SIZES, ["template_id", "width", "height"], ["VARCHAR", "INTEGER", "INTEGER"])
    metrics = S.values_clause([(chr(32 + i), w) for i, w in enumerate(HELVETICA_WIDTHS)], ["ch", "advance"],
                              ["VARCHAR", "INTEGER"])
    w = _widget_cols("f.xmin", "f.ymin", "f.xmax", "f.ymax", "s.width", "s.height")
    return f"""{_values_ctes()},
sizes AS (SELECT * FROM {sizes}),
metrics AS (SELECT * FROM {metrics}),
wg AS (SELECT f.template_id, f.pos, {w['x']} AS x, {w['y']} AS y, {w['font_size']} AS font_size
  FROM fields f JOIN sizes s ON f.template_id = s.template_id WHERE f.type = 'textbox'),
gv AS (SELECT v.doc_id, v.template_id, v.pos AS line, w.x, w.y, w.font_size,
    list_filter(string_split(v.value, ''), lambda c: c <> '') AS cs
  FROM vals v JOIN wg w ON v.template_id = w.template_id AND v.pos = w.pos
  WHERE v.error IS NULL AND v.value IS NOT NULL),
g1 AS (SELECT doc_id, template_id, line, x, y, font_size, unnest(cs) AS ch,
    CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS pos FROM gv),
g2 AS (SELECT g1.*, coalesce(m.advance, {DEFAULT_ADVANCE}) AS adv FROM g1 LEFT JOIN metrics m ON m.ch = g1.ch),
g3 AS (SELECT doc_id, template_id, line, x, y, font_size, pos, ch, adv,
    coalesce(SUM(adv) OVER (PARTITION BY doc_id, line ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM g2),
nl AS (SELECT gv.doc_id, gv.template_id, gv.line, gv.x, gv.y, gv.font_size, CAST(len(gv.cs) AS INTEGER) AS pos,
    chr(10) AS ch, 0 AS adv,
    coalesce(t.s, 0) AS b
  FROM gv LEFT JOIN (SELECT doc_id, line, SUM(adv) AS s FROM g2 GROUP BY doc_id, line) t
    ON gv.doc_id = t.doc_id AND gv.line = t.line),
ga AS (SELECT * FROM g3 UNION ALL SELECT doc_id, template_id, line, x, y, font_size, pos, ch, adv, b FROM nl),
glyphs AS (SELECT doc_id, template_id, 1 AS page, line, pos, ch,
    x + CAST(font_size * b AS DOUBLE) / 1000.0::DOUBLE AS x0, y AS y0,
    x + CAST(font_size * (b + adv) AS DOUBLE) / 1000.0::DOUBLE AS x1, y + CAST(font_size AS DOUBLE) AS y1 FROM ga)"""


def layout_glyphs() -> str:
    return f"WITH {_glyph_ctes()}\nSELECT doc_id, page, line, pos, ch, x0, y0, x1, y1 FROM glyphs"


def form_words() -> str:
    return (f"WITH {_glyph_ctes()},\n{_words_sql('glyphs', 'template_id')}\n"
            "SELECT doc_id, line, word_no, text, x0, y0, x1, y1 FROM words")


def _label_ctes() -> str:
    heights = " ".join(f"WHEN '{t}' THEN {h * 2}" for t, _, h in TEMPLATE_SIZES)
    return f"""{_glyph_ctes()},
{_words_sql('glyphs', 'template_id')},
lw AS (SELECT words.*, CAST(CASE template_id {heights} END AS DOUBLE) AS img_h,
    x0 * 2.0::DOUBLE AS sx0, y0 * 2.0::DOUBLE AS sy0, x1 * 2.0::DOUBLE AS sx1, y1 * 2.0::DOUBLE AS sy1 FROM words),
lf AS (SELECT *, CAST(trunc((sy1 - sy0) * 0.1::DOUBLE) AS INTEGER) AS shift FROM lw),
lq AS (SELECT *, sx0 - 1 AS fx0, img_h - sy0 - shift AS fy0, sx1 + 1 AS fx1, img_h - sy1 - shift AS fy1 FROM lf)"""


def _quad(x0: str, y0: str, x1: str, y1: str) -> list[str]:
    a, b, c, d = (f"CAST(trunc({v}) AS INTEGER)" for v in (x0, y0, x1, y1))
    return [a, b, c, b, c, d, a, d]


def label_boxes() -> str:
    qa, qr = _quad("fx0", "fy0", "fx1", "fy1"), _quad("x0", "y0", "x1", "y1")
    cols_a = ", ".join(f"{q} AS q{i + 1}" for i, q in enumerate(qa))
    cols_r = ", ".join(f"{q} AS q{i + 1}" for i, q in enumerate(qr))
    return f"""WITH {_label_ctes()}
SELECT doc_id, word_no, TRUE AS augment, {cols_a}, text FROM lq
UNION ALL
SELECT doc_id, word_no, FALSE AS augment, {cols_r}, text FROM lq"""


def label_lines() -> str:
    qa = _quad("fx0", "fy0", "fx1", "fy1")
    parts = ", ".join(f"CAST({q} AS VARCHAR)" for q in qa)
    return f"WITH {_label_ctes()}\nSELECT doc_id, word_no, concat_ws(',', {parts}, text) AS line FROM lq"


def _catalog_values(probability: float = 0.5) -> str:
    rows = []
    for order, op in enumerate(CATALOG):
        thr = gate_threshold(op, probability)
        plo, phi = member_interval(op, probability) if op.group else (None, None)
        grp = S.sql_str(op.group) if op.group else "NULL"
        base = f"{order}, {S.sql_str(op.phase)}, {op.slot}, {S.sql_str(op.op)}, {grp}, {_d(thr)}, {_d(plo)}, {_d(phi)}"
        for prm in (op.params or (None,)):
            if prm is None:
                rows.append(f"({base}, NULL, NULL, {_d(None)}, {_d(None)}, NULL, NULL)")
                continue
            ch = S.sql_str("|".join(prm.choices)) if prm.choices else "NULL"
            fx = S.sql_str(prm.value) if prm.value is not None else "NULL"
            rows.append(f"({base}, {S.sql_str(prm.name)}, {S.sql_str(prm.kind)}, {_d(prm.lo)}, {_d(prm.hi)}, {ch}, {fx})")
    return ("(VALUES " + ", ".join(rows) +
            ") AS c(ord, phase, slot, op, grp, thr, plo, phi, param, kind, lo, hi, choices, fixed)")


def _plan_cte() -> str:
    d = "o.o_orderkey"
    ug, up = S.sql_u01(SEED, d, "'aug'", "c.grp", "'gate'"), S.sql_u01(SEED, d, "'aug'", "c.grp", "'pick'")
    uo = S.sql_u01(SEED, d, "'aug'", "c.op", "'gate'")
    active = f"CASE WHEN c.grp IS NULL THEN {uo} < c.thr ELSE {ug} < c.thr AND {up} >= c.plo AND {up} < c.phi END"
    u = S.sql_u01(SEED, "o_orderkey", "'aug'", "op", "param")
    n_ch = "len(string_split(choices, '|'))"
    randint = f"CAST(CAST(lo AS BIGINT) + CAST(floor({u} * (CAST(hi AS BIGINT) - CAST(lo AS BIGINT) + 1)) AS BIGINT) AS DOUBLE)"
    return f"""x AS (SELECT {d}, c.*, {active} AS active FROM orders o, {_catalog_values()}),
plan AS (SELECT o_orderkey, CAST(dense_rank() OVER (PARTITION BY o_orderkey ORDER BY ord) AS INTEGER) AS step,
    phase, slot, op, param,
    CASE WHEN kind = 'range' THEN lo END AS lo, CASE WHEN kind = 'range' THEN hi END AS hi,
    CASE kind WHEN 'uniform' THEN lo + {u} * (hi - lo) WHEN 'randint' THEN {randint} END AS value_num,
    CASE kind WHEN 'choice' THEN string_split(choices, '|')[CAST(floor({u} * {n_ch}) AS INTEGER) + 1]
      WHEN 'fixed' THEN fixed END AS value
  FROM x WHERE active)"""


def augmentation_plan() -> str:
    return f"WITH {_plan_cte()}\nSELECT o_orderkey, step, phase, slot, op, param, lo, hi, value_num, value FROM plan"


def plan_audit() -> str:
    exp = ", ".join(f"({S.sql_str(o.op)}, {_d(expected_rate(o, 0.5))})" for o in CATALOG)
    return f"""WITH {_plan_cte()},
per_op AS (SELECT op, COUNT(DISTINCT o_orderkey) AS n FROM plan GROUP BY op)
SELECT p.op, CAST(p.n AS BIGINT) AS n_active, CAST(p.n AS DOUBLE) / CAST((SELECT COUNT(*) FROM orders) AS DOUBLE) AS rate,
  e.expected_rate FROM per_op p JOIN (VALUES {exp}) AS e(op, expected_rate) ON p.op = e.op"""


ORACLES = {
    "generate_values": generate_values,
    "gen_alphanum": gen_alphanum,
    "gen_date": gen_date,
    "gen_datetime": gen_datetime,
    "split_errors": split_errors,
    "gen_number": gen_number,
    "gen_decimal": gen_decimal,
    "gen_currency": gen_currency,
    "static_override": static_override,
    "field_kinds": field_kinds,
    "sample_uniform": sample_uniform,
    "sample_weighted": sample_weighted,
    "sample_weighted_range": sample_weighted,
    "sample_weighted_grouped": sample_weighted_grouped,
    "gen_name": gen_name,
    "gen_address": gen_address,
    "gen_address_text": gen_address_text,
    "gen_email": gen_email,
    "gen_company": gen_company,
    "assemble_records": assemble_records,
    "record_json": record_json,
    "parse_annotations": parse_annotations,
    "nested_annotations": nested_annotations,
    "xml_records": xml_records,
    "document_records": document_records,
    "validate_templates": validate_templates,
    "date_templates": date_templates,
    "expand_documents": expand_documents,
    "manifest": manifest,
    "expand_hot_template": expand_hot_template,
    "expand_parts": expand_parts,
    "pair_by_position": pair_by_position,
    "pair_by_stem_report": pair_by_stem_report,
    "combine_boxes": combine_boxes,
    "words_from_glyphs": words_from_glyphs,
    "widgets": widgets,
    "widgets_of_images": widgets_of_images,
    "layout_glyphs": layout_glyphs,
    "form_words": form_words,
    "form_words_from_glyphs": form_words,
    "label_boxes": label_boxes,
    "label_lines": label_lines,
    "augmentation_plan": augmentation_plan,
    "plan_audit": plan_audit,
}


def oracle_sql() -> dict[str, str]:
    return {name: fn() for name, fn in ORACLES.items()}
