"""Dataset writers (sinks).

Defaults avoid one file per document: ground-truth records are JSON lines and
labels are parquet, both partitioned by template; ``per_document=True`` gives
the reference's one-text-file-per-document layout for small sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.labels import label_line


# Tasks, and so files, over which a template's documents are spread.
FILE_BUCKETS = 64


def _file_bucket():
    """Bucket of a document in its template: its lines lie in few files, those of a hot
    template in many tasks, and nothing has to be sampled (computed twice) to find ranges."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILE_BUCKETS))


def write_records(records: DataFrame, path: str, mode: str = "overwrite", record_col: str = "textbox") -> None:
    """One JSON line per document, ``{"doc_id": .., "textbox": {..}}``,
    partitioned by ``template_id``."""
    line = F.to_json(F.struct(F.col("doc_id"), F.col(record_col).alias("textbox")))
    (records.select("template_id", "doc_id", line.alias("value")).repartition("template_id", _file_bucket())
     .select("template_id", "value").write.mode(mode).partitionBy("template_id").text(path))


def write_labels(labels: DataFrame, path: str, mode: str = "overwrite", per_document: bool = False) -> None:
    """Label lines ``x1,y1,..,y4,text``.

    Default: parquet ``(template_id, doc_id, word_no, line)`` partitioned by
    template. ``per_document=True``: plain text, one folder per document,
    lines in word order (many small files; for small sets only).
    """
    lines = labels.select(*[c for c in ("template_id",) if c in labels.columns], "doc_id", "word_no",
                          label_line().alias("line"))
    if per_document:
        (lines.repartition("doc_id").sortWithinPartitions("doc_id", "word_no")
         .select("doc_id", F.col("line").alias("value"))
         .write.mode(mode).partitionBy("doc_id").text(path))
    else:
        by_template = "template_id" in lines.columns
        w = (lines.repartition("template_id", _file_bucket()) if by_template else lines).write.mode(mode)
        if by_template:
            w = w.partitionBy("template_id")
        w.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
