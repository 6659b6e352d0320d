"""Files in and out: annotation folders, image listings, the dataset job."""

import json
import os

from pyspark.sql import functions as F

from docsynth.plans.dataset import Dictionaries, build_dataset, load_templates
from docsynth.plans.fixtures import font_metrics
from docsynth.sources.annotations import list_images, read_annotations, typed_fields

ANN = """<annotation>
  <size><width>{w}</width><height>1000</height></size>
  <object><name>textbox</name><bndbox><xmin>40</xmin><ymin>60</ymin><xmax>240</xmax><ymax>80</ymax></bndbox>
    <attributes>
      <attribute><name>1_field_name</name><value>ssn</value></attribute>
      <attribute><name>2_max_length</name><value>11</value></attribute>
      <attribute><name>3_is_alphanum</name><value>True</value></attribute>
      <attribute><name>4_is_date</name><value>False</value></attribute>
      <attribute><name>5_is_name</name><value>False</value></attribute>
      <attribute><name>alpha_num_placement</name><value>nnn-nn-nnnn</value></attribute>
      <attribute><name>static_value</name><value></value></attribute>
    </attributes></object>
  <object><name>textbox</name><bndbox><xmin>40</xmin><ymin>100</ymin><xmax>300</xmax><ymax>124</ymax></bndbox>
    <attributes>
      <attribute><name>1_field_name</name><value>holder</value></attribute>
      <attribute><name>2_max_length</name><value>30</value></attribute>
      <attribute><name>3_is_alphanum</name><value>False</value></attribute>
      <attribute><name>4_is_date</name><value>False</value></attribute>
      <attribute><name>5_is_name</name><value>True</value></attribute>
      <attribute><name>name_type</name><value>full</value></attribute>
      <attribute><name>name_gender</name><value></value></attribute>
      <attribute><name>name_suffix</name><value>False</value></attribute>
      <attribute><name>static_value</name><value></value></attribute>
    </attributes></object>
</annotation>"""


def make_forms(root, widths, n_images=None):
    os.makedirs(f"{root}/Annotations")
    os.makedirs(f"{root}/JPEGImages")
    for i, w in enumerate(widths):
        with open(f"{root}/Annotations/form{i}.xml", "w") as f:
            f.write(ANN.format(w=w))
    for i in range(len(widths) if n_images is None else n_images):
        with open(f"{root}/JPEGImages/img{i}.v1.jpg", "wb") as f:
            f.write(b"\xff\xd8" + bytes(10))


def dictionaries(spark):
    first = spark.createDataFrame([("Ann", "female", 3), ("Bob", "male", 2)], "name string, gender string, weight long")
    last = spark.createDataFrame([("Lee", 1), ("Kim", 4)], "name string, weight long")
    ind = spark.createDataFrame([("Ravi Kumar", "male"), ("Asha Rao", "female")], "name string, gender string")
    return Dictionaries(first, last, ind, font_metrics(spark))


def test_read_annotation_files_and_images(spark, tmpdir_path):
    make_forms(tmpdir_path, ["800", "600"])
    a = read_annotations(spark, f"{tmpdir_path}/Annotations/*.xml")
    assert a.count() == 2
    f = typed_fields(a.withColumn("template_id", F.col("annotation_path")))
    assert f.count() == 4
    imgs = list_images(spark, f"{tmpdir_path}/JPEGImages/*")
    assert sorted(os.path.basename(r.image_path) for r in imgs.collect()) == ["img0.v1.jpg", "img1.v1.jpg"]
    t = load_templates(spark, tmpdir_path)
    assert sorted(r.template_id for r in t.collect()) == ["img0.v1", "img1.v1"]


def test_dataset_job_end_to_end(spark, tmpdir_path):
    base, out = f"{tmpdir_path}/forms", f"{tmpdir_path}/out"
    make_forms(base, ["800", "800.0", "700"])  # the second template is rejected (V10)
    paths = build_dataset(spark, base, out, 4, dictionaries(spark), seed=1, augment=True)
    rejected = spark.read.parquet(paths["rejected_templates"]).collect()
    assert {r.template_id for r in rejected} == {"img1.v1"}
    assert {r.rule for r in rejected} == {"V10_size_not_integer"}
    recs = spark.read.text(paths["records"]).collect()
    assert len(recs) == 8
    rec = json.loads(recs[0].value)
    assert set(rec["textbox"]) == {"ssn", "holder"} and len(rec["textbox"]["ssn"]) == 9
    labels = spark.read.parquet(paths["labels"])
    assert labels.select("doc_id").distinct().count() == 8
    assert all(len(r.line.split(",", 8)) == 9 for r in labels.collect())
    assert spark.read.parquet(paths["manifest"]).count() == 8
    assert spark.read.parquet(paths["augmentation_plan"]).select("doc_id").distinct().count() == 8


def test_unpaired_files_are_reported(spark, tmpdir_path):
    from docsynth.plans.dataset import unpaired_rules
    make_forms(tmpdir_path, ["800", "800"], n_images=1)
    rows = unpaired_rules(spark, tmpdir_path).collect()
    assert len(rows) == 1 and rows[0].rule == "V11_annotation_image_count_mismatch"
    assert rows[0].template_id.endswith("form1.xml")


def test_records_and_words_read_buckets_without_shuffle(spark, tmpdir_path):
    from docsynth.operators.layout import layout_words, widgets
    from docsynth.operators.records import assemble_records
    from docsynth.plans.dataset import write_bucketed_values
    from docsynth.plans.fixtures import template_fields, template_sizes
    v = spark.createDataFrame([(f"d{i}", "w2", p, "f", "k", "ab cd", None) for i in range(20) for p in (0, 1)],
                              "doc_id string, template_id string, pos int, field_name string, kind string, "
                              "value string, error string")
    t = write_bucketed_values(v, f"{tmpdir_path}/values", 4)
    rec = assemble_records(t)
    words = layout_words(t, widgets(template_sizes(spark), template_fields(spark)), font_metrics(spark))
    for df in (rec, words):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(doc_id" not in plan, plan
    assert rec.count() == 20 and words.count() == 80
    import glob
    assert len(glob.glob(f"{tmpdir_path}/values/*.parquet")) <= 4  # one file per bucket


def test_files_with_odd_names_pair_in_plain_order(spark, tmpdir_path):
    import os
    from docsynth.plans.dataset import load_templates
    names = ["a b", "a!b", "a%b", "a#b", "a+b", "ä", "z"]
    for folder, ext in (("Annotations", ".xml"), ("JPEGImages", ".jpg")):
        os.makedirs(f"{tmpdir_path}/{folder}")
        for n in names:
            with open(f"{tmpdir_path}/{folder}/{n}{ext}", "w") as f:
                f.write("<annotation><size><width>1</width><height>1</height></size></annotation>")
    got = {(os.path.basename(r.annotation_path), os.path.basename(r.image_path)) for r in load_templates(spark, tmpdir_path).collect()}
    assert got == {(f"{n}.xml", f"{n}.jpg") for n in names}


def test_partitioned_records_write_few_files(spark, tmpdir_path):
    import glob
    from docsynth.sources.writers import write_records
    rec = spark.range(400).selectExpr("concat('d', id) doc_id", "concat('t', id % 5) template_id", "map('a', 'b') textbox").repartition(16)
    write_records(rec, f"{tmpdir_path}/rec")
    assert len(glob.glob(f"{tmpdir_path}/rec/*/*.txt")) <= 5 + 8  # templates plus range borders


def test_per_document_label_text_files(spark, tmpdir_path):
    from docsynth.sources.writers import write_labels
    rows = [("d1", 1, 0, "a,b", 1, 2, 3, 2, 3, 4, 1, 4), ("d1", 1, 1, "c", 5, 6, 7, 6, 7, 8, 5, 8),
            ("d2", 1, 0, "x", 0, 0, 1, 0, 1, 1, 0, 1)]
    df = spark.createDataFrame(rows, "doc_id string, page int, word_no long, text string, "
                                     "q1 int, q2 int, q3 int, q4 int, q5 int, q6 int, q7 int, q8 int")
    out = f"{tmpdir_path}/labels"
    write_labels(df, out, per_document=True)
    d1 = [r.value for r in spark.read.text(f"{out}/doc_id=d1").collect()]
    assert d1 == ["1,2,3,2,3,4,1,4,a,b", "5,6,7,6,7,8,5,8,c"]
    assert d1[0].split(",", 8)[8] == "a,b"   # readers split on the first eight commas


def test_command_line_job(spark, tmpdir_path):
    from docsynth.__main__ import main
    base, out = f"{tmpdir_path}/forms", f"{tmpdir_path}/out"
    make_forms(base, ["800"])
    d = dictionaries(spark)
    paths = {}
    for name in ("first_names", "last_names", "indian_names", "font_metrics"):
        paths[name] = f"{tmpdir_path}/{name}"
        getattr(d, name).write.parquet(paths[name])
    main(["--base_path", base, "--out", out, "--num_files", "3", "--augment", "false", "--seed", "5",
          *[x for k, v in paths.items() for x in (f"--{k}", v)]])
    assert spark.read.text(f"{out}/records").count() == 3
    assert not os.path.exists(f"{out}/augmentation_plan")
