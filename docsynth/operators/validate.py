"""Template validation: every rule broken, as rows, before any expansion.

The reference stops the whole run at the first bad field; here a bad template
is one or more rule rows ``(template_id, pos, field_name, rule)`` computed on
the template dimension (small), so a bad template costs one rejected row
instead of N failed documents. Template-level rules use ``pos = -1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.generators import truthy
from ..functions.strftime import date_part_of, strftime_error, strptime_accepts
from ..sources.annotations import size_int, strip, typed_object_columns
from .values import field_kind

# The bounds of drawn dates as the reference writes them. It reads them with
# a field's own format, so a format that does not read both ends its run; here dates are
# drawn without them, so this rule (V7) only warns.
DATE_BOUNDS = ("01-01-2021", "01-01-2024")


def _rules(*pairs: tuple[Column, str]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(name)) for c, name in pairs]), lambda x: x.isNotNull())


def _has(key: str) -> Column:
    return F.map_contains_key(F.col("attributes"), F.lit(key))


def _is_number(v: Column) -> Column:
    return strip(v).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")


def _template_rule_list() -> list[tuple[Column, str]]:
    broken = F.col("xml_broken")
    return [
        (broken, "V14_unparsable_xml"),
        (~broken & (F.col("width_text").isNull() | F.col("height_text").isNull()), "V9_size_missing"),
        ((F.col("width_text").isNotNull() & F.col("width").isNull())
         | (F.col("height_text").isNotNull() & F.col("height").isNull()), "V10_size_not_integer"),
        ((F.col("width") <= 0) | (F.col("height") <= 0), "V17_size_not_positive"),
    ]


def _field_rule_list(resolution: float) -> list[tuple[Column, str]]:
    text = F.col("type") == "textbox"
    a, d, n = truthy(F.col("is_alphanum")), truthy(F.col("is_date")), truthy(F.col("is_name"))
    box = F.col("bndbox")
    box_missing = box.isNull() | box["xmin"].isNull() | box["ymin"].isNull() | box["xmax"].isNull() | box["ymax"].isNull()
    box_nan = ~box_missing & (F.col("xmin").isNull() | F.col("ymin").isNull() | F.col("xmax").isNull()
                              | F.col("ymax").isNull())
    missing = (~_has("1_field_name") | ~_has("3_is_alphanum")
               | (a & (~_has("alpha_num_placement") | ~_has("static_value")))
               | (~a & ~_has("4_is_date"))
               | (~a & d & (~_has("date_format") | ~_has("static_value")))
               | (~a & ~d & ~_has("5_is_name"))
               | (~a & ~d & n & (~_has("name_type") | ~_has("name_gender") | ~_has("static_value"))))
    kind = F.col("kind")
    font_size = (F.col("ymax") - F.col("ymin")).cast("double") * F.lit(72.0 / resolution) - F.lit(4.0)
    return [
        (box_missing, "V9_box_missing"),
        (box_nan, "V9_box_not_number"),
        (text & missing, "V5_required_key_missing"),
        (text & kind.isNotNull() & _has("1_field_name") & F.col("field_name").isNull(), "V16_field_name_empty"),
        (text & (kind == "alphanum") & F.col("mask").isNull(), "V1_alphanum_without_mask"),
        (text & (kind == "date") & F.col("date_format").isNull(), "V2_date_without_format"),
        (text & (kind == "name") & (F.col("name_type") == "n/a"), "V3_name_type_na"),
        (text & (kind == "alphanum") & (F.col("mask") == ""), "V4_empty_mask"),
        (text & kind.isNotNull() & F.col("static_value").isin("True", "False"), "V6_static_is_boolean"),
        (text & (kind == "date") & F.col("date_format").isNotNull()
         & strftime_error(date_part_of(F.col("date_format"))), "V18_unsupported_date_format"),
        (text & (kind == "date") & F.col("date_format").isNotNull()
         & ~(strptime_accepts(date_part_of(F.col("date_format")), DATE_BOUNDS[0])
             & strptime_accepts(date_part_of(F.col("date_format")), DATE_BOUNDS[1])), "V7_date_format_rejects_bounds"),
        (text & (~_has("2_max_length") | F.col("max_length").isNull() | ~_is_number(F.col("max_length"))),
         "V8_max_length_not_number"),
        (text & kind.isNotNull() & F.col("field_name").isNotNull() & (F.col("pos") > F.col("_ds_first")),
         "V12_duplicate_field_name"),
        (text & ~box_missing & ~box_nan & (F.floor(font_size) <= 0), "V13_font_size_not_positive"),
    ]


def duplicate_template_rules(parsed: DataFrame, id_col: str = "template_id") -> DataFrame:
    """V15: one row per copy of a template id used more than once. Reads only
    the id column (a partially aggregated count), never the XML."""
    dup = parsed.groupBy(F.col(id_col).alias("template_id")).agg(F.count(F.lit(1)).alias("_ds_n"))
    dup = dup.filter(F.col("_ds_n") > 1)
    return dup.select("template_id", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("field_name"),
                      F.explode(F.array_repeat(F.lit("V15_duplicate_template_id"), F.col("_ds_n").cast("int")))
                      .alias("rule"))


def validate_templates(parsed: DataFrame, id_col: str = "template_id", ann: str = "annotation",
                       resolution: float = 100.0) -> DataFrame:
    """All rule rows ``(template_id, pos, field_name, rule)`` of the parsed
    annotations; template-level rules have ``pos = -1``.

    One pass: objects are exploded once (outer, so a template without objects
    keeps a row), template rules are evaluated on each template's first row
    and field rules on every object row, and rules are exploded. The only
    shuffle is the duplicate-name window keyed by (template, field name), on
    the template dimension; V15 comes from an id-only aggregation.
    """
    a = F.col(ann)
    rows = parsed.select(
        F.col(id_col).alias("template_id"),
        size_int(a["size"]["width"]).alias("width"), size_int(a["size"]["height"]).alias("height"),
        a["size"]["width"].alias("width_text"), a["size"]["height"].alias("height_text"),
        a["_corrupt_record"].isNotNull().alias("xml_broken"),
        F.posexplode_outer(a["object"]).alias("pos", "obj"))
    rows = rows.select("*", *typed_object_columns(F.col("obj")))
    rows = rows.withColumn("kind", field_kind(F.col("is_alphanum"), F.col("is_date"), F.col("is_name")))
    text_kind = (F.col("type") == "textbox") & F.col("kind").isNotNull()
    rows = rows.withColumn("_ds_first", F.min(F.when(text_kind, F.col("pos")))
                           .over(Window.partitionBy("template_id", "field_name")))
    first_row = F.col("pos").isNull() | (F.col("pos") == 0)
    t_rules = _rules(*[(first_row & c, name) for c, name in _template_rule_list()])
    f_rules = _rules(*[(F.col("obj").isNotNull() & c, name) for c, name in _field_rule_list(resolution)])
    tagged = F.concat(F.transform(t_rules, lambda r: F.struct(F.lit(True).alias("t"), r.alias("rule"))),
                      F.transform(f_rules, lambda r: F.struct(F.lit(False).alias("t"), r.alias("rule"))))
    out = rows.select("template_id", "pos", "field_name", F.explode(tagged).alias("_ds_r"))
    out = out.select("template_id",
                     F.when(F.col("_ds_r.t"), F.lit(-1)).otherwise(F.col("pos")).cast("int").alias("pos"),
                     F.when(F.col("_ds_r.t"), F.lit(None).cast("string")).otherwise(F.col("field_name"))
                     .alias("field_name"),
                     F.col("_ds_r.rule").alias("rule"))
    return out.unionByName(duplicate_template_rules(parsed, id_col))
