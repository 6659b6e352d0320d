"""Registered queries: each builds a DataFrame from the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame with flat,
aliased columns; ``docsynth.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import randint, u01
from ..functions.generators import (alphanum, currency, date_format_error, gen_date, gen_decimal, gen_int,
                                    static_override)
from ..functions.generators import address_text as address_text_col
from ..operators.expand import expand_documents, manifest
from ..operators.partitioning import spread
from ..operators.pairing import pair_by_position, pair_by_stem
from ..operators.persona import gen_address, gen_company, gen_email, gen_name
from ..operators.records import assemble_records, record_json, record_kv
from ..operators.sampling import sample_uniform, sample_weighted
from ..operators.validate import validate_templates
from ..operators.values import generate_values, split_errors, text_fields
from ..sources.annotations import parse_annotations, stem, templates, typed_fields
from ..sources.images import image_size
from ..operators.augplan import augmentation_plan, plan_audit
from ..operators.labels import QUAD_COLS, label_boxes, label_lines
from ..operators.layout import layout_glyphs, layout_words, widgets
from ..operators.words import combine_boxes, glyphs_from_text, words_from_glyphs
from ..functions.geometry import DEFAULT_RENDER_FACTOR
from ..functions.strftime import to_spark_pattern
from ..session import ensure_checkpoint_dir
from .dataset import WARNING_RULES
from .fixtures import (FIELD_SCHEMA, SEED, TEMPLATE_SIZES, customer_documents, first_names_any, font_metrics, literal_frame,
                       name_dictionaries, read, template_fields, template_sizes)

# Fixed values used by the queries (masks and formats exercised per row).
ALNUM_MASKS = ["nnn-nn-nnnn", "CCcc nn", "Cnc-x#"]
DATE_FORMATS = ["%d-%m-%Y", "%m/%d/%Y", "%B %d, %Y", "%Y%j", "%a %d %b %y"]
DATETIME_FORMATS = ["%d-%m-%Y %H:%M:%S", "%Y-%m-%d %I:%M %p", "%A, %B %d %Y %H%%"]
BAD_FORMATS = ["%d-%m-%Y", "%Q-%m", "%Y/%m/%d", "%d %Q", "%e-%m"]
FLAG_TEXTS = ["True", "False", "false", "", None, "yes"]
MANIFEST_BASE = "data"


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(customer_documents(spark, sf_dir), "doc_id")
    first, last, indian = name_dictionaries(spark, sf_dir)
    return generate_values(docs, template_fields(spark), SEED, first, last, indian)


def q_generate_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir)


def _with_literal(df: DataFrame, items: list, idx_col: str, val_col: str) -> DataFrame:
    """Each row repeated once per literal item (an explode, not a join)."""
    arr = F.array(*[F.lit(x) for x in items])
    return spread(df, df.columns[0]).select("*", F.posexplode(arr).alias(idx_col, val_col))


def q_gen_alphanum(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey")
    c = _with_literal(c, ALNUM_MASKS, "mask_no", "mask")
    k = [F.col("c_custkey"), F.col("mask_no")]
    return c.select("c_custkey", "mask_no", "mask", alphanum(F.col("mask"), SEED, *k).alias("value"),
                    alphanum(F.col("mask"), SEED, *k, literal="keep").alias("value_keep"))


def _with_formats(df: DataFrame, formats: list, date_only: bool) -> DataFrame:
    """Each row once per literal format, with the format's Spark pattern
    translated on the driver (the formats are literals)."""
    pairs = [F.struct(F.lit(f).alias("fmt"),
                      F.lit(to_spark_pattern(f.split(" ")[0] if date_only else f)).alias("pattern"))
             for f in formats]
    df = spread(df, df.columns[0])
    return df.select("*", F.posexplode(F.array(*pairs)).alias("fmt_no", "_ds_f"))


def q_gen_date(spark, sf_dir):
    o = _with_formats(read(spark, sf_dir, "orders").select("o_orderkey"), DATE_FORMATS, True)
    return o.select("o_orderkey", "fmt_no", F.col("_ds_f.fmt").alias("fmt"),
                    gen_date(F.col("_ds_f.fmt"), SEED, F.col("o_orderkey"), F.col("fmt_no"),
                             pattern=F.col("_ds_f.pattern")).alias("value"))


def q_gen_datetime(spark, sf_dir):
    o = _with_formats(read(spark, sf_dir, "orders").select("o_orderkey"), DATETIME_FORMATS, False)
    return o.select("o_orderkey", "fmt_no", F.col("_ds_f.fmt").alias("fmt"),
                    gen_date(F.col("_ds_f.fmt"), SEED, F.col("o_orderkey"), F.col("fmt_no"), date_only=False,
                             pattern=F.col("_ds_f.pattern")).alias("value"))


def q_split_errors(spark, sf_dir):
    """Dates with some unsupported formats: good and rejected rows, tagged."""
    o = _with_literal(read(spark, sf_dir, "orders").select("o_orderkey"), BAD_FORMATS, "fmt_no", "fmt")
    o = o.select("o_orderkey", "fmt_no", "fmt",
                 gen_date(F.col("fmt"), SEED, F.col("o_orderkey"), F.col("fmt_no")).alias("value"),
                 F.when(date_format_error(F.col("fmt")), F.lit("V18_unsupported_date_format")).alias("error"))
    good, bad = split_errors(o)
    return good.withColumn("side", F.lit("good")).unionByName(bad.withColumn("side", F.lit("rejected")))


def q_gen_number(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", gen_int(SEED, k, num_digits=5).alias("value"),
                    randint(F.lit(0).cast("bigint"), F.floor(F.col("o_totalprice")).cast("bigint"), SEED, k, "range")
                    .alias("value_range"))


def q_gen_decimal(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey")
    return o.select("o_orderkey", gen_decimal(SEED, F.col("o_orderkey"), num_digits=2, decimal_places=2)
                    .alias("value"))


def q_gen_currency(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey")
    x = gen_decimal(SEED, F.col("o_orderkey"), start=-50000, end=50000, decimal_places=2)
    o = o.select("o_orderkey", x.alias("amount"))
    a = F.col("amount")
    return o.select("o_orderkey", "amount", currency(a).alias("usd"),
                    currency(a, symbol=False).alias("usd_plain"),
                    currency(a, grouping=False).alias("usd_ungrouped"))


def q_static_override(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    static = (F.when(F.col("c_custkey") % 4 == 1, F.lit("X")).when(F.col("c_custkey") % 4 == 2, F.col("c_mktsegment"))
              .when(F.col("c_custkey") % 4 == 3, F.lit("")))
    c = c.select("c_custkey", alphanum("nnnn", SEED, F.col("c_custkey")).alias("generated"),
                 static.alias("static_value"))
    return c.select("*", static_override(F.col("generated"), F.col("static_value")).alias("value"))


def _flag(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in FLAG_TEXTS]), (i % len(FLAG_TEXTS)).cast("int") + 1)


def q_field_kinds(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    n = len(FLAG_TEXTS)
    f = c.select(F.col("c_custkey").cast("string").alias("template_id"), F.lit(0).alias("pos"),
                 F.when(k % 10 == 0, F.lit("checkbox")).otherwise(F.lit("textbox")).alias("type"),
                 _flag(k).alias("is_alphanum"), _flag(F.floor(k / n)).alias("is_date"),
                 _flag(F.floor(k / (n * n))).alias("is_name"),
                 F.lit("nn").alias("mask"), F.lit("%Y").alias("date_format"), F.lit("full").alias("name_type"),
                 F.lit(None).cast("string").alias("static_value"))
    t = text_fields(f)
    return t.select(F.col("template_id").cast("bigint").alias("c_custkey"), "type", "is_alphanum", "is_date",
                    "is_name", "kind")


def q_sample_uniform(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return sample_uniform(e, s, u01(SEED, F.col("event_id"), "supplier"), ["s_suppkey"]) \
        .select("event_id", "s_suppkey", "s_name")


def _part_words(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_name")
    w = p.select(F.explode(F.split(F.col("p_name"), " ")).alias("word")).filter(F.col("word") != "")
    return w.groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("weight"))


def q_sample_weighted(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id")
    return sample_weighted(e, _part_words(spark, sf_dir), u01(SEED, F.col("event_id"), "word"), ["word"],
                           "weight").select("event_id", "word")


def q_sample_weighted_range(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id")
    return sample_weighted(e, _part_words(spark, sf_dir), u01(SEED, F.col("event_id"), "word"), ["word"],
                           "weight", bins=64).select("event_id", "word")


def q_sample_weighted_grouped(spark, sf_dir):
    """A word of the event's own type's dictionary: the groups' sizes are unequal, one has no words."""
    e = read(spark, sf_dir, "events").select("event_id", F.pmod("event_id", F.lit(4)).cast("int").alias("grp"))
    p = read(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word"), F.least(F.floor(F.col("p_size") / 10), F.lit(2)).cast("int").alias("grp"))
    words = p.filter(F.col("word") != "").groupBy("grp", "word").agg(F.count(F.lit(1)).cast("bigint").alias("weight"))
    return sample_weighted(e, words, u01(SEED, F.col("event_id"), "grouped"), ["word"], "weight", by=["grp"]).select("event_id", "grp", "word")


def _customer_name_params(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("first_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("last_name")).otherwise(F.lit("full")).alias("name_type"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("male")).when(F.col("c_nationkey") % 3 == 1, F.lit("female"))
        .otherwise(F.lit("x")).alias("name_gender"),
        F.when(F.col("c_acctbal") < 1000, F.lit("True")).otherwise(F.lit("False")).alias("name_indian"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit("True")).otherwise(F.lit("False")).alias("name_suffix"))


def q_gen_name(spark, sf_dir):
    first, last, indian = name_dictionaries(spark, sf_dir)
    c = _customer_name_params(spark, sf_dir)
    return gen_name(c, ["c_custkey"], SEED, first, last, indian).select("c_custkey", "name", "name_error")


def address_book(spark, sf_dir) -> DataFrame:
    """supplier x nation x region as an address set (no city for every fifth nation)."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select(
        "s_suppkey",
        F.concat(F.col("s_suppkey").cast("string"), F.lit(" "), F.col("n_name"), F.lit(" Road")).alias("address1"),
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit(" Apt "), (F.floor(F.col("s_acctbal")) % 100).cast("string")))
        .otherwise(F.lit("")).alias("address2"),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("City"), F.col("s_nationkey").cast("string"))).alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(((F.col("s_suppkey") * 37) % 100000).cast("string"), 5, "0").alias("postalCode"))


def q_gen_address(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey")
    return gen_address(c, ["c_custkey"], SEED, address_book(spark, sf_dir), ["s_suppkey"]) \
        .select("c_custkey", "address", "city", "state", "postal_code")


def q_gen_address_text(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    a = gen_address(c, ["c_custkey"], SEED, address_book(spark, sf_dir), ["s_suppkey"])
    return a.select("c_custkey", address_text_col(F.col("address"), F.col("city"), F.col("state"),
                                                  F.col("postal_code"), F.col("c_name")).alias("text"))


def q_gen_email(spark, sf_dir):
    first, last, _ = name_dictionaries(spark, sf_dir)
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    c = c.withColumn("random_domain", F.col("c_nationkey") % 2 == 0)
    return gen_email(c, ["c_custkey"], SEED, first_names_any(first), last, "random_domain") \
        .select("c_custkey", "email")


def q_gen_company(spark, sf_dir):
    first, _, _ = name_dictionaries(spark, sf_dir)
    c = read(spark, sf_dir, "customer").select("c_custkey")
    return gen_company(c, ["c_custkey"], SEED, first_names_any(first)).select("c_custkey", "company")


def q_assemble_records(spark, sf_dir):
    rec = assemble_records(_values(spark, sf_dir))
    return rec.select("doc_id", "template_id", F.size("textbox").cast("int").alias("n_fields"),
                      record_kv(F.col("textbox")).alias("record_kv"))


def q_record_json(spark, sf_dir):
    rec = assemble_records(_values(spark, sf_dir))
    return rec.select("doc_id", record_json(F.col("textbox")).alias("json"))


# ---- templates from XML ----

def _xml_escape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def _tag(name: str, body: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))


def _attr(name: str, value: Column) -> Column:
    return _tag("attribute", F.concat(_tag("name", F.lit(name)), _tag("value", _xml_escape(value))))


def _box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return _tag("bndbox", F.concat(_tag("xmin", xmin), _tag("ymin", ymin), _tag("xmax", xmax), _tag("ymax", ymax)))


def part_annotation_xml(spark, sf_dir) -> DataFrame:
    """One VOC annotation per part: a text box (attributes in a wrapper, a
    repeated field name when p_size > 40) and a check box (bare attributes)."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    p = spread(p, "p_partkey")
    s = F.col("p_size")
    obj0 = _tag("object", F.concat(
        _tag("name", F.lit("textbox")),
        _box(F.col("p_retailprice").cast("string"), s.cast("string"),
             (F.col("p_retailprice") + F.lit(100.0)).cast("string"), (s + 20).cast("string")),
        _tag("attributes", F.concat(
            _attr("1_field_name", F.col("p_brand")), _attr("2_max_length", s.cast("string")),
            _attr("3_is_alphanum", F.when(s % 2 == 0, F.lit("True")).otherwise(F.lit("False"))),
            _attr("alpha_num_placement", F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.lit("nnn-nn"))),
            _attr("static_value", F.concat(F.lit(" "), F.col("p_type"), F.lit(" "))),
            F.when(s > 40, _attr("1_field_name", F.col("p_name"))).otherwise(F.lit(""))))))
    obj1 = _tag("object", F.concat(
        _tag("name", F.lit("checkbox")),
        _box(F.lit("-1.9"), F.lit("0"), F.lit("10.99"), F.lit("10")),
        _attr("1_field_name", F.concat(F.lit("chk_"), F.col("p_partkey").cast("string")))))
    xml = _tag("annotation", F.concat(
        _tag("size", F.concat(_tag("width", (s * 20).cast("string")), _tag("height", (s * 25).cast("string")))),
        obj0, obj1))
    return p.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("template_id"),
                    xml.alias("xml"))


def q_parse_annotations(spark, sf_dir):
    parsed = parse_annotations(part_annotation_xml(spark, sf_dir))
    t = templates(parsed).select("template_id", "width", "height")
    f = typed_fields(parsed).select("template_id", "pos", "type", "xmin", "ymin", "xmax", "ymax", "field_name",
                                    "max_length", "is_alphanum", "mask", "static_value")
    return f.join(t, "template_id")


def customer_annotation_xml(spark, sf_dir) -> DataFrame:
    """One annotation per customer with defects injected from its columns."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    c = spread(c, "c_custkey")
    nk, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    size = _tag("size", F.concat(
        _tag("width", F.when(F.col("c_acctbal") < 0, F.lit("800.0")).otherwise(F.lit("800"))),
        F.when(nk == 3, F.lit("")).otherwise(_tag("height", F.lit("1000")))))
    obj0 = _tag("object", F.concat(
        _tag("name", F.lit("textbox")),
        _box(F.when(nk == 17, F.lit("abc")).otherwise(F.lit("40")), F.lit("60"), F.lit("240"), F.lit("80")),
        _tag("attributes", F.concat(
            _attr("1_field_name", F.lit("acct")),
            _attr("2_max_length", F.when(nk == 9, F.lit("abc")).otherwise(F.lit("4"))),
            _attr("3_is_alphanum", F.lit("True")),
            _attr("alpha_num_placement", F.when(seg == "BUILDING", F.lit("")).otherwise(F.lit("nnnn"))),
            _attr("static_value", F.when(nk == 5, F.lit("True")).otherwise(F.lit("")))))))
    obj1 = _tag("object", F.concat(
        _tag("name", F.lit("textbox")),
        _box(F.lit("40"), F.lit("100"), F.lit("240"), F.when(seg == "AUTOMOBILE", F.lit("105")).otherwise(F.lit("130"))),
        _tag("attributes", F.concat(
            _attr("1_field_name", F.when(nk == 11, F.lit("acct")).otherwise(F.lit("holder"))),
            _attr("2_max_length", F.lit("20")), _attr("3_is_alphanum", F.lit("False")),
            _attr("4_is_date", F.lit("False")), _attr("5_is_name", F.lit("True")),
            F.when(nk == 13, F.lit("")).otherwise(
                _attr("name_type", F.when(seg == "FURNITURE", F.lit("n/a")).otherwise(F.lit("full")))),
            _attr("name_gender", F.lit("")), _attr("static_value", F.lit(""))))))
    xml = _tag("annotation", F.concat(size, obj0, obj1))
    xml = F.when(nk == 7, F.substring(xml, 1, 60)).otherwise(xml)
    return c.select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("template_id"),
                    xml.alias("xml"))


def nested_annotation_xml(spark, sf_dir) -> DataFrame:
    """One annotation per part with objects at several depths: a text box in a
    group (p_size not divisible by 3: with a check box inside it, before or after
    its own attributes), and a text box at the root, its name as CDATA."""
    p = spread(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size"), "p_partkey")
    s = F.col("p_size")
    inner = _tag("object", F.concat(
        _tag("bndbox", F.lit("<xmin>1.5</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax>")), _tag("name", F.lit("checkbox")),
        _attr("1_field_name", F.concat(F.lit("in & <"), F.col("p_partkey").cast("string"))), _attr("3_is_alphanum", F.lit("True"))))
    inner = F.when(s % 3 == 0, F.lit("<!-- <object> -->")).otherwise(inner)
    own = _tag("attributes", F.concat(_attr("1_field_name", F.col("p_brand")), _attr("2_max_length", s.cast("string"))))
    outer = _tag("object", F.concat(
        _tag("name", F.lit("textbox")), F.when(s % 2 == 0, F.concat(own, inner)).otherwise(F.concat(inner, own)),
        _box(s.cast("string"), F.lit("10"), (s + 100).cast("string"), F.lit("30.7"))))
    last = F.concat(F.lit("<object kind='a>b'><name><![CDATA[text]]>box</name>"), _box(F.lit("5"), F.lit("6"), F.lit("7"), F.lit("8")),
                    _tag("extra", _tag("deep", _attr("1_field_name", F.concat(F.col("p_type"), F.lit(" ü"))))), F.lit("<attribute/></object>"))
    xml = F.concat(F.lit('<?xml version="1.0"?>\n'), _tag("annotation", F.concat(
        F.lit("<size><width>100</width><height>200</height></size>\n<!-- note -->"), _tag("group", _tag("page", outer)), last)))
    return p.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("template_id"), xml.alias("xml"))


def q_nested_annotations(spark, sf_dir):
    return typed_fields(parse_annotations(nested_annotation_xml(spark, sf_dir))).select(
        "template_id", "pos", "type", "xmin", "ymin", "xmax", "ymax", "field_name", "max_length", "is_alphanum")


XML_DOCS = 2


def _accepted(parsed: DataFrame) -> DataFrame:
    """Templates that break no rule that stops a document from being filled."""
    blocking = validate_templates(parsed).filter(~F.col("rule").isin(*WARNING_RULES)).select("template_id").distinct()
    return parsed.join(blocking, "template_id", "left_anti")


def q_xml_records(spark, sf_dir):
    """From annotation XML to records: parse, validate, reject, expand, fill, assemble."""
    ensure_checkpoint_dir(spark)
    good = _accepted(parse_annotations(customer_annotation_xml(spark, sf_dir))).drop("xml").checkpoint()  # read by every later step
    docs = expand_documents(templates(good).select("template_id"), XML_DOCS)
    first, last, indian = name_dictionaries(spark, sf_dir)
    values = generate_values(docs, typed_fields(good).drop("attributes", "bndbox"), SEED, first, last, indian)
    rec = assemble_records(values, documents=docs)
    return rec.select("doc_id", "template_id", F.size("textbox").cast("int").alias("n_fields"), record_kv(F.col("textbox")).alias("record_kv"))


# A template without text fields.
BLANK_FIELD = ("blank", 0, "checkbox", 10, 10, 20, 20, "tick", "1", "False", "False", "False", None, None, "n/a", "False", None, "False", None)


def q_document_records(spark, sf_dir):
    """One record per document, of known templates, of one without text fields
    (an empty record) and of unknown ones (an empty record and the error)."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    form = F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), F.lit("invoice")).otherwise(F.lit("w2"))
    template = F.when(F.col("c_nationkey") == 4, F.lit("blank")).when(F.col("c_nationkey") == 6, F.concat(F.lit("lost_"), form)).otherwise(form)
    docs = spread(c, "c_custkey").select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("doc_id"), template.alias("template_id"))
    first, last, indian = name_dictionaries(spark, sf_dir)
    fields = template_fields(spark).unionByName(literal_frame(spark, [BLANK_FIELD], FIELD_SCHEMA))
    values, rejected = split_errors(generate_values(docs, fields, SEED, first, last, indian))
    rec = assemble_records(values, documents=docs)
    lost = rejected.filter(F.col("error") == "unknown_template").select("doc_id", "error")
    return rec.join(lost, "doc_id", "left").select("doc_id", "template_id", F.size("textbox").cast("int").alias("n_fields"),
                                                   record_kv(F.col("textbox")).alias("record_kv"), "error")


def q_validate_templates(spark, sf_dir):
    return validate_templates(parse_annotations(customer_annotation_xml(spark, sf_dir)))


# Date formats of the templates of ``date_templates``: some read the bounds 01-01-2021 and
# 01-01-2024, some do not, two cannot be rendered, one is empty.
TEMPLATE_DATE_FORMATS = ["%d-%m-%Y", "%m/%d/%Y", "%m-%d-%Y %H", "%Y-%m-%d", "%d-%m-20%y", "%d-%m-%y", "%d-%d-%Y", "%Q-%m", "", "%j-%m-%Y",
                         "%H-%M-%Y", "%d-%b-%Y", "(%d)-%m-%Y", "%d-%m-%Y%", "01-%m-%Y"]


def date_annotation_xml(spark, sf_dir) -> DataFrame:
    """One annotation per part with a date field, and defects by its columns."""
    p = spread(read(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    k, s = F.col("p_partkey"), F.col("p_size")
    fmt = F.element_at(F.array(*[F.lit(f) for f in TEMPLATE_DATE_FORMATS]), (k % len(TEMPLATE_DATE_FORMATS)).cast("int") + 1)
    box = F.when(s % 13 == 0, F.lit("")).otherwise(_box(F.lit("1"), F.lit("1"), F.lit("90"), F.lit("40")))
    xml = _tag("annotation", F.concat(
        _tag("size", F.concat(_tag("width", F.when(s % 11 == 0, F.lit("0")).otherwise(F.lit("100"))), _tag("height", F.lit("100")))),
        _tag("object", F.concat(
            _tag("name", F.lit("textbox")), box, _attr("1_field_name", F.when(s % 10 == 0, F.lit("")).otherwise(F.lit("day"))),
            _attr("2_max_length", F.lit("9")), _attr("3_is_alphanum", F.lit("False")), _attr("4_is_date", F.lit("True")),
            _attr("date_format", fmt), _attr("static_value", F.lit(""))))))
    return p.select(F.when(k % 50 == 0, F.lit("twice")).otherwise(F.concat(F.lit("part_"), k.cast("string"))).alias("template_id"), xml.alias("xml"))


def q_date_templates(spark, sf_dir):
    return validate_templates(parse_annotations(date_annotation_xml(spark, sf_dir)))


# ---- documents ----

def part_templates(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = F.concat(F.lit("/forms/JPEGImages/"), F.regexp_replace(F.col("p_name"), " ", "_"), F.lit("."),
                    F.col("p_partkey").cast("string"), F.lit(".jpg"))
    return p.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("template_id"),
                    path.alias("image_path"))


def q_expand_documents(spark, sf_dir):
    t = part_templates(spark, sf_dir).withColumn("stem", stem(F.col("image_path")))
    return expand_documents(t, 5, stem_col="stem").select("doc_id", "template_id", "doc_index")


def q_expand_hot_template(spark, sf_dir):
    """Skewed expansion: a few parts hold nearly all documents, of the others
    half have one and half none; the tasks hold equal shares."""
    hot = F.when(F.col("p_partkey") % 997 == 1, F.col("p_size") * 1000).otherwise(F.col("p_size") % 2)
    t = read(spark, sf_dir, "part").select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("template_id"), hot.alias("n_docs"))
    return expand_documents(t, "n_docs").select("doc_id", "template_id", "doc_index")


def q_expand_parts(spark, sf_dir):
    """Expansion of template rows with their own counts: p_size documents per part."""
    t = read(spark, sf_dir, "part").select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("template_id"),
                                           "p_size")
    return expand_documents(t, "p_size", docs_per_chunk=10_000).select("doc_id", "template_id", "doc_index")


def q_manifest(spark, sf_dir):
    t = part_templates(spark, sf_dir).withColumn("stem", stem(F.col("image_path")))
    d = expand_documents(t, 5, stem_col="stem").select("doc_id", "template_id")
    return manifest(d, MANIFEST_BASE)


def q_pair_by_position(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source")
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    return pair_by_position(d, p, ["source", "doc_id"], ["url", "page_id"]) \
        .select("rank", "doc_id", "page_id")


def q_pair_by_stem_report(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id")
    lab = read(spark, sf_dir, "labels").select((F.col("doc_id") + 3).alias("doc_id"))  # the last ones have no document
    return pair_by_stem(d, lab, "doc_id")


# ---- layout, words, labels ----

def q_combine_boxes(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax")
    x0 = F.col("l_linenumber").cast("double") * F.lit(10.0)
    boxes = li.select("l_orderkey", x0.alias("bx0"), F.col("l_quantity").alias("by0"),
                      (x0 + F.col("l_extendedprice") / F.lit(1000.0)).alias("bx1"),
                      (F.col("l_quantity") + F.col("l_tax") * F.lit(100.0)).alias("by1"))
    return combine_boxes(boxes, ["l_orderkey"], "bx0", "by0", "bx1", "by1")


def q_words_from_glyphs(spark, sf_dir):
    d = spread(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return words_from_glyphs(glyphs_from_text(d)).select("doc_id", "page", "line", "word_no", "text",
                                                         "x0", "y0", "x1", "y1")


def q_widgets(spark, sf_dir):
    parsed = parse_annotations(part_annotation_xml(spark, sf_dir))
    return widgets(templates(parsed), typed_fields(parsed))


def _hex(value: Column, width: int) -> Column:
    return F.lpad(F.hex(value.cast("bigint")), 2 * width, "0")


def part_image_bytes(spark, sf_dir) -> DataFrame:
    """The header of one template image per part, wider and higher than its
    annotation says: PNG, JPEG with segments before its frame, or cut off."""
    p = spread(read(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    k = F.col("p_partkey")
    w, h = F.col("p_size") * 20 + k % 7 * 10, F.col("p_size") * 25 + k % 5 * 30
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), _hex(w, 4), _hex(h, 4), F.lit("0802000000"))
    segment = F.concat(F.lit("FFE1"), _hex(k % 50 + 2, 2), F.repeat(F.lit("C0"), (k % 50).cast("int")))
    frame = F.concat(F.lit("FFFFC2001108"), _hex(h, 2), _hex(w, 2), F.lit("03"))
    jpeg = F.concat(F.lit("FFD8FFE000104A46494600010100000100010000"), segment, segment, frame)
    content = F.when(k % 3 == 0, png).when(k % 11 == 0, F.lit("FFD8FFE0001000FFD9")).otherwise(jpeg)
    return p.select(F.concat(F.lit("part_"), k.cast("string")).alias("template_id"), F.unhex(content).alias("content"))


def q_widgets_of_images(spark, sf_dir):
    """Widgets on pages whose scales differ, where both axis rules matter."""
    parsed = parse_annotations(part_annotation_xml(spark, sf_dir))
    sizes = part_image_bytes(spark, sf_dir).select("template_id", image_size(F.col("content")).alias("size"))
    sizes = sizes.select("template_id", F.col("size.format").alias("format"), F.col("size.width").alias("image_width"), F.col("size.height").alias("image_height"))
    t = templates(parsed).join(sizes, "template_id")
    both = [widgets(t, typed_fields(parsed), axes=axes).withColumn("axes", F.lit(axes)) for axes in ("swapped", "straight")]
    return (both[0].unionByName(both[1]).join(sizes, "template_id")
            .select("template_id", "axes", "format", "image_width", "image_height", "pos", "x", "y", "w", "h", "font_size"))


def _template_widgets(spark) -> DataFrame:
    return widgets(template_sizes(spark), template_fields(spark))


def _glyphs(spark, sf_dir) -> DataFrame:
    vals, _ = split_errors(_values(spark, sf_dir))
    return layout_glyphs(vals, _template_widgets(spark), font_metrics(spark))


def q_layout_glyphs(spark, sf_dir):
    return _glyphs(spark, sf_dir).drop("template_id")


def _image_height(factor: float = DEFAULT_RENDER_FACTOR) -> Column:
    sizes = F.create_map(*[x for t, _, h in TEMPLATE_SIZES for x in (F.lit(t), F.lit(int(h * factor)))])
    return sizes[F.col("template_id")]


def _form_words(spark, sf_dir) -> DataFrame:
    vals, _ = split_errors(_values(spark, sf_dir))
    return layout_words(vals, _template_widgets(spark), font_metrics(spark))


def q_form_words_from_glyphs(spark, sf_dir):
    """The same words through the generic glyph operator (glyph rows, one
    shuffle by line); must equal ``form_words``."""
    w = words_from_glyphs(_glyphs(spark, sf_dir), carry=["template_id"])
    return w.select("doc_id", "line", "word_no", "text", "x0", "y0", "x1", "y1")


def q_form_words(spark, sf_dir):
    return _form_words(spark, sf_dir).select("doc_id", "line", "word_no", "text", "x0", "y0", "x1", "y1")


def q_label_boxes(spark, sf_dir):
    w = _form_words(spark, sf_dir).withColumn("augment", F.explode(F.array(F.lit(True), F.lit(False))))
    lb = label_boxes(w, _image_height(), F.col("augment"))
    return lb.select("doc_id", "word_no", "augment", *QUAD_COLS, "text")


def q_label_lines(spark, sf_dir):
    lb = label_boxes(_form_words(spark, sf_dir), _image_height(), True)
    return label_lines(lb)


def q_augmentation_plan(spark, sf_dir):
    o = spread(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return augmentation_plan(o, 0.5, SEED, doc_col="o_orderkey")


def q_plan_audit(spark, sf_dir):
    o = spread(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return plan_audit(augmentation_plan(o, 0.5, SEED, doc_col="o_orderkey"), o.count(), 0.5)


QUERIES = {
    "generate_values": q_generate_values,
    "gen_alphanum": q_gen_alphanum,
    "gen_date": q_gen_date,
    "gen_datetime": q_gen_datetime,
    "split_errors": q_split_errors,
    "gen_number": q_gen_number,
    "gen_decimal": q_gen_decimal,
    "gen_currency": q_gen_currency,
    "static_override": q_static_override,
    "field_kinds": q_field_kinds,
    "sample_uniform": q_sample_uniform,
    "sample_weighted": q_sample_weighted,
    "sample_weighted_range": q_sample_weighted_range,
    "sample_weighted_grouped": q_sample_weighted_grouped,
    "gen_name": q_gen_name,
    "gen_address": q_gen_address,
    "gen_address_text": q_gen_address_text,
    "gen_email": q_gen_email,
    "gen_company": q_gen_company,
    "assemble_records": q_assemble_records,
    "record_json": q_record_json,
    "parse_annotations": q_parse_annotations,
    "nested_annotations": q_nested_annotations,
    "xml_records": q_xml_records,
    "document_records": q_document_records,
    "validate_templates": q_validate_templates,
    "date_templates": q_date_templates,
    "expand_documents": q_expand_documents,
    "manifest": q_manifest,
    "expand_hot_template": q_expand_hot_template,
    "expand_parts": q_expand_parts,
    "pair_by_position": q_pair_by_position,
    "pair_by_stem_report": q_pair_by_stem_report,
    "combine_boxes": q_combine_boxes,
    "words_from_glyphs": q_words_from_glyphs,
    "widgets": q_widgets,
    "widgets_of_images": q_widgets_of_images,
    "layout_glyphs": q_layout_glyphs,
    "form_words": q_form_words,
    "form_words_from_glyphs": q_form_words_from_glyphs,
    "label_boxes": q_label_boxes,
    "label_lines": q_label_lines,
    "augmentation_plan": q_augmentation_plan,
    "plan_audit": q_plan_audit,
}
