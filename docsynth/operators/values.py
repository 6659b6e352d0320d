"""Field typing and the value generator (template x document x field).

``fields`` is the typed field table of the templates (one row per annotation
object; see ``docsynth.sources.annotations.typed_fields``). ``documents`` has
one row per document: ``doc_id``, ``template_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generators import alphanum, date_format_error, date_pattern, gen_date, static_override, truthy
from .persona import gen_name
from .sampling import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, measured

KINDS = ("alphanum", "date", "name")


def field_kind(is_alphanum: Column, is_date: Column, is_name: Column) -> Column:
    """Dispatch in the reference's priority: alphanum, then date, then name;
    null when no flag is truthy (such a field never gets a value)."""
    return (F.when(truthy(is_alphanum), F.lit("alphanum"))
            .when(truthy(is_date), F.lit("date"))
            .when(truthy(is_name), F.lit("name")))


def field_error(kind: Column, mask: Column, date_format: Column, name_type: Column,
                static_value: Column, field_name: Column) -> Column:
    """First field-level rule broken by a typed field (null when none)."""
    return (F.when(kind.isNotNull() & field_name.isNull(), F.lit("V16_field_name_empty"))
            .when((kind == "alphanum") & mask.isNull(), F.lit("V1_alphanum_without_mask"))
            .when((kind == "date") & date_format.isNull(), F.lit("V2_date_without_format"))
            .when((kind == "name") & (name_type == "n/a"), F.lit("V3_name_type_na"))
            .when((kind == "alphanum") & (mask == ""), F.lit("V4_empty_mask"))
            .when(kind.isNotNull() & static_value.isin("True", "False"), F.lit("V6_static_is_boolean"))
            .when((kind == "date") & date_format_error(date_format), F.lit("V18_unsupported_date_format")))


def text_fields(fields: DataFrame) -> DataFrame:
    """Keep text boxes, add ``kind`` and ``error``; drop kind-less fields."""
    f = fields.filter(F.col("type") == "textbox")
    f = f.withColumn("kind", field_kind(F.col("is_alphanum"), F.col("is_date"), F.col("is_name")))
    f = f.filter(F.col("kind").isNotNull())
    f = f.withColumn("date_pattern", F.when(F.col("kind") == "date", date_pattern(F.col("date_format"))))
    name = F.col("field_name") if "field_name" in f.columns else F.lit("")
    return f.withColumn("error", field_error(F.col("kind"), F.col("mask"), F.col("date_format"),
                                             F.col("name_type"), F.col("static_value"), name))


def generate_values(documents: DataFrame, fields: DataFrame, seed: int, first_names: DataFrame,
                    last_names: DataFrame, indian_names: DataFrame,
                    max_broadcast_fields: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per (document, text field with a kind): the drawn value.

    Output: doc_id, template_id, pos, field_name, kind, value, error. The
    field table is the template dimension: it is broadcast after a size check,
    so the document side streams without a shuffle. A field breaking a rule
    gets ``value`` null and the rule in ``error`` instead of ending the job; a
    document whose template is not in ``fields`` gets one row at ``pos`` -1 with
    the error ``unknown_template`` (a template without text fields gives no rows).
    """
    tf = text_fields(fields)
    size = measured(fields)  # upper bound of the text-field rows
    known = fields.select("template_id").distinct().join(tf, "template_id", "left").withColumn("_ds_known", F.lit(True))
    spec = checked_broadcast(known, *size, max_rows=max_broadcast_fields)
    rows = documents.select("doc_id", "template_id").join(spec, "template_id", "left")
    rows = rows.filter(F.col("kind").isNotNull() | F.col("_ds_known").isNull())
    rows = rows.withColumn("pos", F.coalesce("pos", F.lit(-1)))
    rows = rows.withColumn("error", F.when(F.col("_ds_known").isNull(), F.lit("unknown_template")).otherwise(F.col("error")))
    key = [F.col("doc_id"), F.col("pos")]
    rows = gen_name(rows, ["doc_id", "pos"], seed, first_names, last_names, indian_names,
                    only_where=(F.col("kind") == "name") & F.col("error").isNull(), out_col="_ds_name",
                    error_col="_ds_name_err")
    generated = (F.when(F.col("kind") == "alphanum", alphanum(F.col("mask"), seed, *key))
                 .when(F.col("kind") == "date", gen_date(F.col("date_format"), seed, *key,
                                                         pattern=F.col("date_pattern")))
                 .when(F.col("kind") == "name", F.col("_ds_name")))
    error = F.coalesce(F.col("error"), F.col("_ds_name_err"))
    value = F.when(error.isNull(), static_override(generated, F.col("static_value")))
    return rows.select("doc_id", "template_id", "pos", "field_name", "kind",
                       value.alias("value"), error.alias("error"))


def split_errors(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows): a bad row leaves the job instead of ending it."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())
