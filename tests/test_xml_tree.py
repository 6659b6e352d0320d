"""Objects of annotation XML against a walk of the parsed tree."""

import random
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from docsynth.operators.records import assemble_records
from docsynth.operators.values import generate_values
from docsynth.sources.annotations import parse_annotations, read_annotations, typed_fields
from docsynth.sources.xml_tree import elements, objects

TEXTS = ["a", " b ", "", "&lt;x&gt;", "&amp;amp;", "&#233;&#x1F600;", "<![CDATA[<b> & &amp;]]>", "m<!-- <object> -->n", "q<?pi <name>?>", "\n", "'\""]
TAGS = ["object", "object", "attributes", "attribute", "bndbox", "name", "value", "xmin", "ymin", "xmax", "ymax", "g"]


def random_xml(rng, depth=0):
    tag = rng.choice(TAGS) if depth else "annotation"
    mark = rng.choice(["", " k='>'", ' k="a/>" j="1"', "\n"])
    if depth > 5 or (depth and rng.random() < 0.2):
        return f"<{tag}{mark}/>" if rng.random() < 0.3 else f"<{tag}{mark}>{rng.choice(TEXTS)}</{tag}>"
    inner = "".join(random_xml(rng, depth + 1) + rng.choice(["", " ", "tail"]) for _ in range(rng.randint(1, 5)))
    return f"<{tag}{mark}>{rng.choice(TEXTS)}{inner}</{tag} >" if depth else f"<!-- <object/> --><{tag}>{inner}</{tag}>"


def text(e):
    return None if e is None else (e.text or None)


def walked(xml):
    out = []
    for o in ET.fromstring(xml).iter("object"):
        attributes = [(text(a.find("name")), text(a.find("value"))) for a in o.iter("attribute") if a.find("name") is not None or a.find("value") is not None]
        out.append((text(o.find("name")), [text(o.find(f"bndbox/{c}")) for c in ("xmin", "ymin", "xmax", "ymax")], attributes))
    return out


def test_objects_of_random_trees(spark):
    rng = random.Random(7)
    xmls = [random_xml(rng) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(xmls)), "id long, xml string")
    got = {r.id: [(o.name, list(o.bndbox) if o.bndbox else [None] * 4, [(a.name, a.value) for a in o.attributes.attribute]) for o in r.objects]
           for r in objects(df, "id", "xml").collect()}
    for i, xml in enumerate(xmls):
        assert got.get(i, []) == walked(xml), xml
    assert sum(len(v) for v in got.values()) > 500


def test_elements_have_their_parents(spark):
    xml = "<a><b x='<'><c/>t</b><!-- <d> --><b>u<e>v</e>w</b></a>"
    rows = elements(spark.createDataFrame([(1, xml)], "id long, xml string"), "id", "xml").orderBy("node").collect()
    assert [(r.tag, r.parent_tag, r.depth, r.text) for r in rows] == [
        ("a", None, 1, None), ("b", "a", 2, None), ("c", "b", 3, None), ("b", "a", 2, "u"), ("e", "b", 3, "v")]


def test_one_document_with_thousands_of_objects(spark):
    deep = "<object><name>d</name>" * 30 + "<attribute><name>k</name><value>v</value></attribute>" + "</object>" * 30
    flat = "".join(f"<object><name>n{i}</name><attribute><name>k</name><value>{i}</value></attribute></object>" for i in range(5000))
    df = spark.createDataFrame([(f"<annotation>{deep}<g>{flat}</g></annotation>",)] * 2, "xml string")
    found = parse_annotations(df).select("annotation.object").collect()
    assert len(found) == 2 and found[0] == found[1]
    names = [(o.name, [(a.name, a.value) for a in o.attributes.attribute]) for o in found[0].object]
    assert names == [("d", [("k", "v")])] * 30 + [(f"n{i}", [("k", str(i))]) for i in range(5000)]


def test_broken_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, "<annotation><object>"), (2, None), (3, ""), (4, "<annotation/>"), (5, "no xml")], "id long, xml string")
    rows = {r.id: r.annotation for r in parse_annotations(df).collect()}
    assert all(a is None or a.object is None for a in rows.values())
    assert rows[1]._corrupt_record and rows[5]._corrupt_record and rows[4]._corrupt_record is None


def test_files_with_declaration_and_nested_objects(spark, tmpdir_path):
    inner = "<object><name>textbox</name><attribute><name>1_field_name</name><value>in</value></attribute></object>"
    with open(f"{tmpdir_path}/a b.xml", "w", encoding="utf-8") as f:
        f.write(f"<?xml version='1.0' encoding='utf-8'?>\n<annotation><size><width>3</width><height>4</height></size><page><object><name>g</name>{inner}</object></page></annotation>\n")
    rows = typed_fields(read_annotations(spark, f"{tmpdir_path}/*.xml").withColumn("template_id", F.lit("t"))).orderBy("pos").collect()
    assert [(r.pos, r.type, r.field_name) for r in rows] == [(0, "g", "in"), (1, "textbox", "in")]


def test_documents_of_unknown_templates_are_error_rows(spark, sf_small):
    from docsynth.plans.fixtures import name_dictionaries, template_fields
    docs = spark.createDataFrame([("a", "w2"), ("b", "nowhere"), ("c", None)], "doc_id string, template_id string")
    values = generate_values(docs, template_fields(spark), 1, *name_dictionaries(spark, sf_small))
    lost = values.filter("error = 'unknown_template'").orderBy("doc_id").collect()
    assert [(r.doc_id, r.pos, r.field_name, r.value) for r in lost] == [("b", -1, None, None), ("c", -1, None, None)]
    sizes = {r.doc_id: r.n for r in assemble_records(values, ["doc_id"], documents=docs).select("doc_id", F.size("textbox").alias("n")).collect()}
    assert sizes["b"] == sizes["c"] == 0 < sizes["a"]


def test_texts_are_walked_where_they_lie(spark):
    xml = "<annotation><size><width>3</width><height>4</height></size><object><name>o&#233;&bad;</name><object/></object></annotation>"
    df = spark.createDataFrame([(None, xml.replace("&bad;", "")), (1, xml), (None, xml.replace("&bad;", "")), (2, None)], "id long, xml string")
    parsed = parse_annotations(df)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan  # no task holds more than a batch of texts
    found = [(r.id, r.annotation and r.annotation.object and [o.name for o in r.annotation.object]) for r in parsed.collect()]
    assert sorted(found, key=str) == sorted([(None, ["oé", None])] * 2 + [(1, None), (2, None)], key=str)


def test_the_walk_is_not_repeated_below_a_repartition(spark):
    df = spark.createDataFrame([("t", "<annotation><object><name>n</name></object></annotation>")], "template_id string, xml string").repartition(3, "template_id")
    plan = typed_fields(parse_annotations(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
