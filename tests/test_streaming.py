"""The value generator and plan on a stream equal the batch results."""

import json
import os

from pyspark.sql import functions as F

from docsynth.operators.values import generate_values
from docsynth.plans.fixtures import name_dictionaries, template_fields
from docsynth.streaming.requests import plan_stream, read_requests, values_stream, write_stream


def test_stream_equals_batch(spark, sf_small, tmpdir_path):
    req_dir = os.path.join(tmpdir_path, "requests")
    os.makedirs(req_dir)
    for part in range(3):
        with open(os.path.join(req_dir, f"r{part}.json"), "w") as f:
            for i in range(part * 10, part * 10 + 10):
                f.write(json.dumps({"template_id": "w2" if i % 3 else "invoice", "doc_index": i}) + "\n")
    first, last, ind = name_dictionaries(spark, sf_small)
    fields = template_fields(spark)
    req = read_requests(spark, req_dir, max_files_per_trigger=1)
    out = os.path.join(tmpdir_path, "values")
    q = write_stream(values_stream(req, fields, 7, first, last, ind), out, "values_test",
                     checkpoint=os.path.join(tmpdir_path, "ck"), available_now=True)
    q.awaitTermination(300)
    streamed = {tuple(r) for r in spark.read.parquet(out).collect()}

    docs = spark.read.json(req_dir, schema="template_id string, doc_index bigint").withColumn(
        "doc_id", F.concat(F.col("template_id"), F.lit("_"), F.col("doc_index").cast("string")))
    batch = {tuple(r) for r in generate_values(docs, fields, 7, first, last, ind).collect()}
    assert streamed == batch and len(batch) > 0

    plan_out = os.path.join(tmpdir_path, "plan")
    q2 = write_stream(plan_stream(req, 0.5, 7), plan_out, "plan_test", checkpoint=os.path.join(tmpdir_path, "ck2"),
                      available_now=True)
    q2.awaitTermination(300)
    assert spark.read.parquet(plan_out).select("doc_id").distinct().count() == 30
