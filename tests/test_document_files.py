"""One file per document, with commit, and going on after a stopped run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from docsynth.functions.geometry import DEFAULT_RENDER_FACTOR
from docsynth.operators.expand import expand_documents, manifest
from docsynth.operators.labels import label_boxes
from docsynth.operators.layout import layout_words, widgets
from docsynth.operators.records import assemble_records
from docsynth.operators.values import generate_values
from docsynth.plans.fixtures import font_metrics, name_dictionaries, template_fields, template_sizes
from docsynth.sources import document_files as D


def everything(folder):
    return {os.path.join(d, n)[len(folder):]: open(os.path.join(d, n), encoding="utf-8", newline="").read()
            for d, _, names in os.walk(folder) for n in names}


def job(spark, sf_small, base, docs_per_template=6):
    docs = expand_documents(template_sizes(spark), docs_per_template)
    asked = manifest(docs.select("doc_id", "template_id"), base)

    def values(todo):
        return generate_values(todo.select("doc_id", "template_id"), template_fields(spark), 5, *name_dictionaries(spark, sf_small))

    def fill(todo):
        return assemble_records(values(todo), documents=todo)

    def label(todo):
        words = layout_words(values(todo).filter("error is null"), widgets(template_sizes(spark), template_fields(spark)), font_metrics(spark))
        return label_boxes(words, F.lit(1000 * DEFAULT_RENDER_FACTOR), True)

    return asked, fill, label


def test_files_of_a_job_and_a_run_that_goes_on(spark, sf_small, tmpdir_path):
    whole, stopped = f"{tmpdir_path}/whole", f"{tmpdir_path}/stopped"
    asked, fill, label = job(spark, sf_small, whole)
    assert D.finish(asked, whole, fill, label) == 12
    files = everything(whole)
    names = {p for r in asked.collect() for p in (r.json_path, r.txt_path)}
    assert {whole + p for p in files if not p.endswith("_SUCCESS")} == names  # no hidden file is left
    record = files["/jsons/w2_0.json"]
    assert record == json.dumps(json.loads(record), indent=4) and record.startswith('{\n    "textbox": {\n        "ssn"')
    lines = files["/txts/w2_0.txt"].splitlines()
    assert lines and all(len(x.split(",", 8)) == 9 for x in lines) and files["/txts/w2_0.txt"].endswith("\n")
    assert json.loads(files["/jsons/_SUCCESS"]) == {"files": 12}

    # stopped after some documents, one of them with its JSON only
    asked, fill, label = job(spark, sf_small, stopped)
    half = asked.filter("doc_id in ('w2_1', 'w2_3', 'invoice_5')")
    D.write_record_files(fill(half), half, stopped)
    D.write_label_files(label(half.filter("doc_id <> 'w2_3'")), half.filter("doc_id <> 'w2_3'"), stopped)
    status = {(r.path[len(stopped):], r.status) for r in D.reconciled(asked, stopped).collect()}
    assert ("/jsons/w2_3.json", "written") in status and ("/txts/w2_3.txt", "missing") in status and ("/txts/w2_1.txt", "written") in status
    seen = []
    assert D.finish(asked, stopped, lambda t: seen.append(sorted(r.doc_id for r in t.collect())) or fill(t), label) == 10
    assert "w2_1" not in seen[0] and "w2_3" in seen[0] and len(seen[0]) == 10
    again = everything(stopped)
    assert {k: v for k, v in again.items() if not k.endswith("_SUCCESS")} == {k: v for k, v in files.items() if not k.endswith("_SUCCESS")}
    assert D.finish(asked, stopped, fill, label) == 0


def test_a_failed_task_leaves_no_file(spark, tmpdir_path):
    rows = spark.range(40, numPartitions=4).select(F.concat(F.lit(f"{tmpdir_path}/jsons/"), F.col("id").cast("string"), F.lit(".json")).alias("path"),
                                                   F.when(F.col("id") == 25, F.raise_error(F.lit("broken"))).otherwise(F.lit("é\r\n")).alias("content"))
    with pytest.raises(Exception, match="broken"):
        D.write_files(rows, f"{tmpdir_path}/jsons")
    left = everything(tmpdir_path)
    assert not [p for p in left if os.path.basename(p).startswith(".")] and "/jsons/_SUCCESS" not in left
    assert not {f"/jsons/{i}.json" for i in range(20, 30)} & set(left)  # the failed task's
    asked = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit(f"{tmpdir_path}/jsons/"), F.col("id").cast("string"), F.lit(".json")).alias("json_path"),
                                   F.concat(F.lit(f"{tmpdir_path}/jsons/"), F.col("id").cast("string"), F.lit(".json")).alias("txt_path"))
    assert D.reconciled(asked, tmpdir_path).filter("status = 'written'").count() == len(left)
    D.write_files(rows.filter("path not like '%/25.json'"), f"{tmpdir_path}/jsons")
    after = everything(tmpdir_path)
    assert len(after) == 40 and after["/jsons/7.json"] == "é\r\n" and json.loads(after["/jsons/_SUCCESS"]) == {"files": 39}


def test_unasked_files_and_empty_manifests(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/txts")
    with open(f"{tmpdir_path}/txts/old.txt", "w") as f:
        f.write("x")
    none = spark.createDataFrame([], "doc_id string, json_path string, txt_path string")
    assert [(r.doc_id, os.path.basename(r.path), r.status) for r in D.reconciled(none, tmpdir_path).collect()] == [(None, "old.txt", "unasked")]
    assert D.pending(none, tmpdir_path).count() == 0 and D.finish(none, tmpdir_path, None, None) == 0
