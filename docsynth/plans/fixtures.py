"""Template specs and dictionaries used by the registered queries.

The driver tables are TPC-H-like, not forms, so the queries turn them into the
library's inputs: customers become documents, ``part`` names become name
dictionaries, supplier x nation becomes an address book. The two literal
templates below are the "form" every customer document is filled from; the
work of every query grows with the driver tables, not with these literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42

FIELD_COLUMNS = ["template_id", "pos", "type", "xmin", "ymin", "xmax", "ymax", "field_name", "max_length",
                 "is_alphanum", "is_date", "is_name", "mask", "date_format", "name_type", "name_suffix",
                 "name_gender", "name_indian", "static_value"]

FIELD_SCHEMA = ("template_id string, pos int, type string, xmin int, ymin int, xmax int, ymax int, "
                "field_name string, max_length string, is_alphanum string, is_date string, is_name string, "
                "mask string, date_format string, name_type string, name_suffix string, name_gender string, "
                "name_indian string, static_value string")

T, Fa = "True", "False"

# Two literal form templates. Columns as FIELD_COLUMNS. They exercise: masks with
# dropped literals, a checkbox (dropped), a kind-less field with a static (no
# value), one- and two-character statics, a date format cut at its first space,
# first/last/full/Indian names with and without honorific, a duplicated field
# name (last assignment wins, first position kept) and a 'false' flag (truthy).
TEMPLATE_FIELDS = [
    ("w2", 0, "textbox", 40, 60, 240, 80, "ssn", "11", T, Fa, Fa, "nnn-nn-nnnn", None, "n/a", Fa, None, Fa, None),
    ("w2", 1, "textbox", 40, 90, 240, 110, "employee_id", "6", T, Fa, Fa, "CCnnnn", None, "n/a", Fa, None, Fa, None),
    ("w2", 2, "textbox", 260, 60, 400, 80, "birth_date", "10", Fa, T, Fa, None, "%d-%m-%Y", "n/a", Fa, None, Fa, None),
    ("w2", 3, "textbox", 40, 120, 240, 142, "first_name", "20", Fa, Fa, T, None, None, "first_name", T, "male", Fa, None),
    ("w2", 4, "textbox", 260, 120, 460, 142, "last_name", "20", Fa, Fa, T, None, None, "last_name", Fa, "x", Fa, None),
    ("w2", 5, "checkbox", 500, 60, 512, 72, "retired", "1", Fa, Fa, Fa, None, None, "n/a", Fa, None, Fa, None),
    ("w2", 6, "textbox", 40, 150, 240, 170, "note", "10", Fa, Fa, Fa, None, None, "n/a", Fa, None, Fa, "ABC"),
    ("w2", 7, "textbox", 40, 180, 140, 200, "code", "5", T, Fa, Fa, "Cc-nn", None, "n/a", Fa, None, Fa, "X"),
    ("w2", 8, "textbox", 160, 180, 200, 200, "state", "2", T, Fa, Fa, "CC", None, "n/a", Fa, None, Fa, "NY"),
    ("w2", 9, "textbox", 260, 180, 460, 200, "pay_month", "12", Fa, T, Fa, None, "%B %d, %Y", "n/a", Fa, None, Fa, None),
    ("w2", 10, "textbox", 40, 210, 300, 232, "spouse", "30", Fa, Fa, T, None, None, "full", "false", "female", T, None),
    ("w2", 11, "textbox", 40, 240, 300, 262, "employer", "30", Fa, Fa, T, None, None, "full", Fa, "", Fa, None),
    ("invoice", 0, "textbox", 30, 30, 230, 50, "invoice_no", "6", T, Fa, Fa, "nnnnnn", None, "n/a", Fa, None, Fa, None),
    ("invoice", 1, "textbox", 250, 30, 450, 50, "invoice_date", "10", Fa, T, T, "nn", "%m-%d-%Y", "n/a", Fa, None, Fa, None),
    ("invoice", 2, "textbox", 30, 60, 330, 84, "customer", "30", Fa, Fa, T, None, None, "last_name", T, "male", T, None),
    ("invoice", 3, "textbox", 30, 90, 230, 110, "invoice_no", "2", T, T, Fa, "nCc", "%Y", "n/a", Fa, None, Fa, None),
    ("invoice", 4, "textbox", 250, 90, 450, 110, "reference", "8", T, Fa, Fa, "ccccnnnn", None, "n/a", Fa, None, Fa, "R-1"),
]

# Template image sizes (pixels) of the two literal templates.
TEMPLATE_SIZES = [("w2", 800, 1000), ("invoice", 600, 800)]

# Helvetica advance widths per 1000 em for the printable ASCII
# range (space to tilde, in code point order); other characters use 556.
HELVETICA_WIDTHS = [
    278, 278, 355, 556, 556, 889, 667, 191, 333, 333, 389, 584, 278, 333, 278, 278,
    556, 556, 556, 556, 556, 556, 556, 556, 556, 556, 278, 278, 584, 584, 584, 556,
    1015, 667, 667, 722, 722, 667, 611, 778, 722, 278, 500, 667, 556, 833, 722, 778,
    667, 778, 722, 667, 611, 722, 667, 944, 667, 667, 611, 278, 278, 278, 469, 556,
    333, 556, 556, 500, 556, 556, 278, 556, 556, 222, 222, 500, 222, 833, 556, 556,
    556, 556, 333, 500, 278, 556, 500, 722, 500, 500, 500, 334, 260, 334, 584,
]
DEFAULT_ADVANCE = 556


def literal_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small literal table. Built from a pandas frame, which Spark converts
    with Arrow into a JVM-side relation (no Python workers at run time, and no
    large literal expression tree to re-analyse on every plan step)."""
    import pandas as pd
    names = [f.strip().split(" ", 1)[0] for f in schema.split(",")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names).astype(object), schema)


def template_fields(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, TEMPLATE_FIELDS, FIELD_SCHEMA)


def template_sizes(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, TEMPLATE_SIZES, "template_id string, width int, height int")


def font_metrics(spark: SparkSession) -> DataFrame:
    rows = [(chr(32 + i), int(w)) for i, w in enumerate(HELVETICA_WIDTHS)]
    return literal_frame(spark, rows, "ch string, advance int")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cap(c: Column) -> Column:
    """Upper-case first letter, rest lower case (same text in DuckDB)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is one document; household and machinery customers get
    the invoice template, the others the W-2 template."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return c.select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("doc_id"),
                    F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), F.lit("invoice"))
                    .otherwise(F.lit("w2")).alias("template_id"))


def name_dictionaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(first_names, last_names, indian_names) from the words of ``part.p_name``.

    First token -> first name (gender from p_size parity), second token -> last
    name, weights are occurrence counts; the two-token name is an Indian-style
    full name (gender from the brand number parity), drawn uniformly.
    """
    p = read(spark, sf_dir, "part").select("p_name", "p_size", "p_brand")
    t1 = cap(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)))
    t2 = cap(F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)))
    g_size = F.when(F.col("p_size") % 2 == 0, F.lit("male")).otherwise(F.lit("female"))
    brand_no = F.regexp_extract(F.col("p_brand"), r"(\d+)$", 1).cast("int")
    g_brand = F.when(brand_no % 2 == 0, F.lit("male")).otherwise(F.lit("female"))
    first = (p.select(t1.alias("name"), g_size.alias("gender")).filter(F.col("name") != "")
             .groupBy("name", "gender").agg(F.count(F.lit(1)).cast("bigint").alias("weight")))
    last = (p.select(t2.alias("name")).filter(F.col("name") != "")
            .groupBy("name").agg(F.count(F.lit(1)).cast("bigint").alias("weight")))
    indian = (p.select(F.trim(F.concat_ws(" ", t1, t2)).alias("name"), g_brand.alias("gender"))
              .filter(F.col("name") != "").distinct())
    return first, last, indian


def first_names_any(first: DataFrame) -> DataFrame:
    """First names regardless of gender (weights summed)."""
    return first.groupBy("name").agg(F.sum("weight").cast("bigint").alias("weight"))
