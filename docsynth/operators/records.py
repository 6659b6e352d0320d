"""Ground-truth records: one map per document, and its JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assemble_records(values: DataFrame, doc_cols=("doc_id", "template_id"), out_col: str = "textbox",
                     documents: DataFrame | None = None) -> DataFrame:
    """``groupBy(document)`` of the long values into ``map<field_name, value>``.

    Only rows without an error take part (split them off first). A field name
    used by several fields keeps the value of the last one and the position of
    the first one, as successive dict assignments do; values without a field
    name are left out. Group size is the field count of one template, so no group
    grows with the data. With ``documents`` (their ``doc_cols``) every document
    has a record, an empty one if none of its fields got a value.
    """
    good = values.filter(F.col("error").isNull()) if "error" in values.columns else values
    good = good.filter(F.col("field_name").isNotNull())
    entries = F.array_sort(F.collect_list(F.struct("pos", "field_name", "value")))
    g = good.groupBy(*doc_cols).agg(entries.alias("_ds_e"))
    e = F.col("_ds_e")
    names = F.array_distinct(F.transform(e, lambda x: x["field_name"]))  # in order of first use
    rec = F.map_from_entries(F.transform(names, lambda n: F.struct(
        n, F.element_at(F.filter(e, lambda x: x["field_name"] == n), -1)["value"])))
    records = g.select(*doc_cols, rec.alias(out_col))
    if documents is None:
        return records
    none = F.create_map().cast(records.schema[out_col].dataType)
    return (documents.select(*doc_cols).join(records, list(doc_cols), "left")
            .select(*doc_cols, F.coalesce(out_col, none).alias(out_col)))


def record_kv(record: Column | str, sep: str = ";") -> Column:
    """Flat ``key=value;..`` text of a record in its key order."""
    record = F.col(record) if isinstance(record, str) else record
    return F.array_join(F.transform(F.map_entries(record), lambda x: F.concat(x["key"], F.lit("="), x["value"])), sep)


def record_json(record: Column | str, root: str = "textbox") -> Column:
    """``{"textbox": {...}}`` as one JSON line (keys in field order)."""
    record = F.col(record) if isinstance(record, str) else record
    return F.to_json(F.struct(record.alias(root)))
