"""One file per document: a batch sink with commit, and the ledger of what is written.

``write_record_files`` and ``write_label_files`` write a document's JSON and label
text at the paths its manifest row names, through a Python data source writer. A task
writes its files under hidden names beside the final ones, forces them to disk and
renames them only when its last row is written, so a task that fails, or an attempt that
is lost, leaves no document's file behind, and a repeated attempt writes the same bytes to
the same names. Hidden files of a worker that was killed go when the job commits or
aborts. The driver's commit gets one count per task, never the files' names, and writes
the marker ``_SUCCESS``.

``pending`` holds a manifest against the files that are there: the documents still to be
made, so that a stopped run goes on where it ended. ``reconciled`` also names files that
no document asks for.

Paths must be folders that all executors see (a shared mount), as for checkpoints.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.labels import label_line

FORMAT = "docsynth_files"
SUCCESS = "_SUCCESS"


@dataclass
class FilesWritten(WriterCommitMessage):
    files: int


class FileWriter(DataSourceWriter):
    """Rows (path, content) -> files; see the module's text for the commit rules."""

    def __init__(self, folder: str):
        self.folder, self.job = folder, uuid.uuid4().hex

    def write(self, rows) -> FilesWritten:
        attempt, staged = f"{self.job}-{uuid.uuid4().hex}", {}
        try:
            for row in rows:
                folder, name = os.path.split(row["path"])
                os.makedirs(folder, exist_ok=True)
                hidden = os.path.join(folder, f".{name}.{attempt}")
                staged[hidden] = row["path"]
                with open(hidden, "w", encoding="utf-8", errors="surrogatepass", newline="") as f:
                    f.write(row["content"])
                    f.flush()
                    os.fsync(f.fileno())
            for hidden, path in staged.items():
                os.replace(hidden, path)
        finally:
            for hidden in staged:
                if os.path.exists(hidden):
                    os.remove(hidden)
        return FilesWritten(len(staged))

    def commit(self, messages) -> None:
        self._clear()
        os.makedirs(self.folder, exist_ok=True)
        with open(os.path.join(self.folder, SUCCESS), "w") as f:
            f.write(json.dumps({"files": sum(m.files for m in messages if m)}) + "\n")

    def abort(self, messages) -> None:
        """Files of finished tasks are whole and stay: the next run's ledger counts them."""
        self._clear()

    def _clear(self) -> None:
        """Remove what killed workers of this job left; names pass one by one."""
        for folder, _, names in os.walk(self.folder):
            for name in names:
                if name.startswith(".") and f".{self.job}-" in name:
                    os.remove(os.path.join(folder, name))


class DocumentFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, content string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def write_files(files: DataFrame, folder: str) -> None:
    """Rows (path, content) as files; ``folder`` gets the marker of success. Rows
    without a path or content write nothing; of several rows with one path any one stays."""
    spark = files.sparkSession
    spark.dataSource.register(DocumentFiles)
    marker = os.path.join(folder, SUCCESS)
    if os.path.exists(marker):  # a marker tells of the last run that ended
        os.remove(marker)
    (files.select("path", "content").filter("path is not null and content is not null")
     .write.format(FORMAT).mode("append").option("path", folder).save())


def _json_texts(records: DataFrame, manifest: DataFrame, record_col: str) -> DataFrame:
    """Indented, ASCII-escaped ``{"textbox": {..}}`` of every record, at its path."""
    import pyarrow as pa
    named = records.select("doc_id", record_col).join(manifest.select("doc_id", "json_path"), "doc_id")

    def texts(batches):
        for batch in batches:
            out = [json.dumps({"textbox": dict(r or [])}, indent=4) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "content"])

    return named.select("json_path", record_col).mapInArrow(texts, "path string, content string")


def write_record_files(records: DataFrame, manifest: DataFrame, base_path: str, record_col: str = "textbox") -> None:
    """One JSON file per record at its manifest's ``json_path``."""
    write_files(_json_texts(records, manifest, record_col), os.path.join(base_path, "jsons"))


def write_label_files(labels: DataFrame, manifest: DataFrame, base_path: str) -> None:
    """One text file per document at its ``txt_path``: a line ``x1,y1,..,y4,text`` per word, in
    order; a document without words gets an empty file."""
    lines = labels.select("doc_id", F.struct("word_no", label_line().alias("line")).alias("_ds_l"))
    # a document's words are the words of one template's fields
    grouped = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list("_ds_l")).alias("_ds_l"))
    text = F.array_join(F.transform("_ds_l", lambda x: F.concat(x["line"], F.lit("\n"))), "")
    files = manifest.select("doc_id", F.col("txt_path").alias("path")).join(grouped, "doc_id", "left")
    write_files(files.select("path", F.coalesce(text, F.lit("")).alias("content")), os.path.join(base_path, "txts"))


def _found(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Paths of the finished files of a folder (their bytes are not read)."""
    if not os.path.isdir(folder) or not any(n.endswith(suffix) and not n.startswith((".", "_")) for n in os.listdir(folder)):
        return spark.createDataFrame([], "path string")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    # the listing's paths are URIs: file:/a/b
    return listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path"))


def reconciled(manifest: DataFrame, base_path: str) -> DataFrame:
    """The ledger: doc_id, path, status of every JSON and txt file that a document asks for or
    that is there: ``written``, ``missing``, or ``unasked`` (doc_id null)."""
    spark = manifest.sparkSession
    out = None
    for kind, folder, suffix in (("json_path", "jsons", ".json"), ("txt_path", "txts", ".txt")):
        asked = manifest.select("doc_id", F.col(kind).alias("path"))
        there = _found(spark, os.path.join(base_path, folder), suffix).withColumn("_ds_there", F.lit(True))
        held = asked.withColumn("_ds_asked", F.lit(True)).join(there, "path", "full")
        status = (F.when(F.col("_ds_asked").isNull(), F.lit("unasked")).when(F.col("_ds_there").isNull(), F.lit("missing")).otherwise(F.lit("written")))
        held = held.select("doc_id", "path", status.alias("status"))
        out = held if out is None else out.unionByName(held)
    return out


def pending(manifest: DataFrame, base_path: str) -> DataFrame:
    """Rows of the manifest whose JSON or txt file is not there yet."""
    missing = reconciled(manifest, base_path).filter("status = 'missing'").select("doc_id").distinct()
    return manifest.join(missing, "doc_id", "left_semi")


def finish(manifest: DataFrame, base_path: str, fill, label) -> int:
    """Write the files of all documents that lack one, and return how many documents that were.

    ``fill(documents)`` gives their records, ``label(documents)`` their label boxes; both get
    the pending rows of the manifest only, so a run that was stopped computes what is left."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(manifest.sparkSession)
    todo = pending(manifest, base_path).checkpoint()  # fixed: the files written below would change it
    left = todo.count()
    if left:
        write_record_files(fill(todo), todo, base_path)
        write_label_files(label(todo), todo, base_path)
    return left
