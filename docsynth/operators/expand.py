"""Template x index expansion, document naming and the artifact manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Templates are dealt to this many buckets by a hash of their row; a prefix sum of
# documents runs inside the buckets and over the buckets' sums.
PREFIX_BUCKETS = 1024

# Artifact folders and extensions written per document.
ARTIFACTS = {"json_path": ("jsons", ".json"), "pdf_path": ("pdfs", ".pdf"),
             "image_path": ("images", ".png"), "txt_path": ("txts", ".txt")}


def document_offsets(templates: DataFrame, count_col: str, offset_col: str, total_col: str) -> DataFrame:
    """Documents of the templates before each one (in an order by hash) and of all of them.

    A two-level prefix sum without an eager job: windows over the rows of a
    hash bucket, one over at most ``PREFIX_BUCKETS`` bucket sums. Rows that are
    equal in every column get interchangeable ranges.
    """
    plain = [c for c, t in templates.dtypes if not t.startswith(("map", "variant"))]
    t = templates.withColumn("_ds_h", F.xxhash64(*plain)).withColumn("_ds_b", F.pmod("_ds_h", F.lit(PREFIX_BUCKETS)))
    before = Window.partitionBy("_ds_b").orderBy("_ds_h", count_col).rowsBetween(Window.unboundedPreceding, -1)
    inside = t.withColumn("_ds_in", F.coalesce(F.sum(count_col).over(before), F.lit(0)))
    sums = t.groupBy("_ds_b").agg(F.sum(count_col).alias("_ds_s"))  # at most PREFIX_BUCKETS rows
    earlier = Window.orderBy("_ds_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_ds_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select("_ds_b", F.coalesce(F.sum("_ds_s").over(earlier), F.lit(0)).alias("_ds_pre"),
                       F.sum("_ds_s").over(whole).alias(total_col))
    return (inside.join(F.broadcast(sums), "_ds_b").withColumn(offset_col, F.col("_ds_pre") + F.col("_ds_in"))
            .drop("_ds_h", "_ds_b", "_ds_in", "_ds_pre"))


def expand_documents(templates: DataFrame, num_files, id_col: str = "template_id",
                     stem_col: str | None = None, docs_per_chunk: int | None = None) -> DataFrame:
    """``num_files`` documents per template, indexes 0..n-1 (n <= 0 gives none).

    ``num_files`` is an int or a column name (per-template counts). All
    documents are numbered by a prefix sum over the templates and cut into
    chunks of consecutive numbers, one chunk a task: a template becomes one row
    per chunk that it reaches into, the rows go to the task of their chunk's
    number, and explode there. So every task makes the same number of documents,
    whether one template holds them all or millions of templates hold one each,
    and only template rows are shuffled, never documents. By default there are
    as many chunks as the session has shuffle partitions; ``docs_per_chunk``
    bounds a chunk instead (one small count over the templates when called).
    ``doc_id`` is ``{stem}_{index}``.
    """
    n = F.col(num_files) if isinstance(num_files, str) else F.lit(int(num_files))
    t = templates.withColumn("_ds_n", n.cast("bigint")).filter(F.col("_ds_n") > 0)
    t = t.withColumn("_ds_stem", F.col(stem_col) if stem_col else F.col(id_col))
    if docs_per_chunk is None:
        chunks = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    else:
        chunks = max(1, -(-(t.agg(F.sum("_ds_n")).first()[0] or 0) // int(docs_per_chunk)))
    t = document_offsets(t, "_ds_n", "_ds_off", "_ds_all")
    size = F.ceil(F.col("_ds_all") / chunks) if docs_per_chunk is None else F.lit(int(docs_per_chunk))
    t = t.withColumn("_ds_size", size.cast("bigint"))
    first, last = F.expr("_ds_off div _ds_size"), F.expr("(_ds_off + _ds_n - 1) div _ds_size")
    t = t.withColumn("_ds_chunk", F.explode(F.sequence(first, last)))
    t = t.repartitionById(chunks, F.col("_ds_chunk").cast("int"))
    lo = F.greatest(F.lit(0).cast("bigint"), F.col("_ds_chunk") * F.col("_ds_size") - F.col("_ds_off"))
    hi = F.least(F.col("_ds_n"), (F.col("_ds_chunk") + 1) * F.col("_ds_size") - F.col("_ds_off")) - 1
    out = t.withColumn("doc_index", F.explode(F.sequence(lo, hi)))
    out = out.withColumn("doc_id", F.concat(F.col("_ds_stem"), F.lit("_"), F.col("doc_index").cast("string")))
    return out.drop("_ds_n", "_ds_chunk", "_ds_stem", "_ds_off", "_ds_all", "_ds_size")


def manifest(documents: DataFrame, base_path: str, doc_col: str = "doc_id") -> DataFrame:
    """One row per document with its four artifact paths."""
    base = base_path.rstrip("/")
    cols = [F.concat(F.lit(f"{base}/{folder}/"), F.col(doc_col), F.lit(ext)).alias(name)
            for name, (folder, ext) in ARTIFACTS.items()]
    return documents.select("*", *cols)
