"""One test per reference rule that shapes the data (SURVEY 'Exact semantics')."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docsynth.functions.draws import randint, u01
from docsynth.functions.generators import (address_text, alphanum, currency, gen_date, gen_decimal, honorific,
                                           static_override, truthy)
from docsynth.functions.strftime import UnsupportedFormat, strftime, to_spark_pattern
from docsynth.operators.expand import expand_documents
from docsynth.operators.records import assemble_records, record_json, record_kv
from docsynth.operators.values import field_kind
from docsynth.operators.words import words_from_glyphs
from docsynth.sources.annotations import parse_annotations, stem, templates, typed_fields


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_mask_drops_other_characters(spark):
    v = one(spark, alphanum("nnn-nn-nnnn", 1, F.lit("d"), F.lit(0)))
    assert len(v) == 9 and v.isdigit()
    keep = one(spark, alphanum("nnn-nn-nnnn", 1, F.lit("d"), F.lit(0), literal="keep"))
    assert keep[3] == "-" and keep.replace("-", "") == v


def test_mask_literal_and_column_paths_agree(spark):
    df = spark.range(200).select(F.col("id"), F.lit("Cc-nn x C").alias("m"))
    rows = df.select(alphanum("Cc-nn x C", 5, F.col("id")).alias("a"),
                     alphanum(F.col("m"), 5, F.col("id")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert all(r.a[0].isupper() and r.a[1].islower() and r.a[2:4].isdigit() for r in rows)


def test_one_character_static_is_ignored(spark):
    gen = F.lit("GEN")
    assert one(spark, static_override(gen, F.lit("X"))) == "GEN"
    assert one(spark, static_override(gen, F.lit("XY"))) == "XY"
    assert one(spark, static_override(gen, F.lit(None).cast("string"))) == "GEN"


def test_flag_truthiness(spark):
    vals = ["True", "False", "false", "", None, "yes"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.t for r in df.select(truthy(F.col("v")).alias("t")).collect()]
    assert got == [True, False, True, False, False, True]


def test_kind_priority(spark):
    k = one(spark, field_kind(F.lit("True"), F.lit("True"), F.lit("True")))
    assert k == "alphanum"
    assert one(spark, field_kind(F.lit("False"), F.lit("False"), F.lit("False"))) is None


def test_honorific_is_a_prefix(spark):
    assert one(spark, F.concat(honorific(F.lit("male"), 1, F.lit("k")), F.lit("Ann"))) == "Dr. Ann"
    fem = spark.range(300).select(honorific(F.lit("female"), 1, F.col("id")).alias("h"))
    assert {r.h for r in fem.collect()} == {"Dr. ", "Miss. ", "Mrs. "}


def test_address_without_city(spark):
    t = one(spark, address_text(F.lit("1 Main St"), F.lit(None).cast("string"), F.lit("CA"), F.lit("90001")))
    assert t == "1 Main St\nCA 90001"
    t = one(spark, address_text(F.lit("1 Main St"), F.lit("LA"), F.lit("CA"), F.lit("90001"), F.lit("Bo")))
    assert t == "Bo\n1 Main St\nLA, CA 90001"


def test_date_only_cuts_format_at_first_space(spark):
    v = one(spark, gen_date("%B %d, %Y", 3, F.lit("d")))
    assert v in ["January", "February", "March", "April", "May", "June", "July", "August", "September",
                 "October", "November", "December"]


def test_strftime_translation_and_column_path(spark):
    assert to_spark_pattern("%d-%m-%Y") == "dd'-'MM'-'yyyy"
    with pytest.raises(UnsupportedFormat):
        to_spark_pattern("%Q")
    ts = F.lit("2021-03-05 14:07:09").cast("timestamp_ntz")
    fmt = "%a %d %b %Y %I:%M:%S %p %j %%"
    assert one(spark, strftime(ts, fmt)) == dt.datetime(2021, 3, 5, 14, 7, 9).strftime(fmt)
    assert one(spark, strftime(ts, F.lit(fmt))) == dt.datetime(2021, 3, 5, 14, 7, 9).strftime(fmt)
    assert one(spark, strftime(ts, F.lit("%Q"))) is None


def test_decimal_widens_digits_and_rounds_half_even(spark):
    v = one(spark, gen_decimal(1, F.lit("k"), num_digits=2, decimal_places=2))
    assert 1000 <= v <= 9999 and round(v, 2) == v
    assert one(spark, F.bround(F.lit(2.5), 0)) == 2.0


def test_currency_format(spark):
    assert one(spark, currency(F.lit(-1234.5))) == "-$1,234.50"
    assert one(spark, currency(F.lit(1234.5), symbol=False, grouping=False)) == "1234.50"


def test_zero_documents_and_no_count_down(spark):
    t = spark.createDataFrame([("a",), ("b",)], "template_id string")
    assert expand_documents(t, 0).count() == 0
    assert expand_documents(t, 3).count() == 6


def test_hot_template_is_split_into_chunks(spark):
    t = spark.createDataFrame([("hot",)], "template_id string")
    d = expand_documents(t, 1000, docs_per_chunk=64)
    assert d.count() == 1000
    assert d.select("doc_index").distinct().count() == 1000
    sizes = [n for n in d.rdd.glom().map(len).collect() if n]
    assert len(sizes) == 16 and max(sizes) <= 64


def test_stem_cuts_last_extension_only(spark):
    df = spark.createDataFrame([("/a/b/form.v2.jpg",), ("/x/.hidden",), ("/x/plain",), ("rel/file.",)], "p string")
    assert [r.s for r in df.select(stem(F.col("p")).alias("s")).collect()] == ["form.v2", ".hidden", "plain", "file"]


def test_unterminated_word_is_dropped_and_tab_stays(spark):
    rows = [("d", 1, 0, i, ch, float(i), 0.0, float(i + 1), 1.0) for i, ch in enumerate("a  b\tc\nlast")]
    g = spark.createDataFrame(rows, "doc_id string, page int, line int, pos int, ch string, "
                                    "x0 double, y0 double, x1 double, y1 double")
    words = [r.text for r in words_from_glyphs(g).orderBy("word_no").collect()]
    assert words == ["a", "b\tc"]
    kept = [r.text for r in words_from_glyphs(g, keep_unterminated=True).orderBy("word_no").collect()]
    assert kept == ["a", "b\tc", "last"]


def test_word_numbers_run_across_lines(spark):
    rows = []
    for line, text in enumerate(["ab cd\n", "ef\n"]):
        rows += [("d", 1, line, i, ch, 0.0, 0.0, 1.0, 1.0) for i, ch in enumerate(text)]
    g = spark.createDataFrame(rows, "doc_id string, page int, line int, pos int, ch string, "
                                    "x0 double, y0 double, x1 double, y1 double")
    got = [(r.word_no, r.text) for r in words_from_glyphs(g).orderBy("word_no").collect()]
    assert got == [(0, "ab"), (1, "cd"), (2, "ef")]


def test_duplicate_field_name_last_value_first_position(spark):
    v = spark.createDataFrame([("d", "t", 0, "a", "1"), ("d", "t", 1, "b", "2"), ("d", "t", 2, "a", "3")],
                              "doc_id string, template_id string, pos int, field_name string, value string")
    r = assemble_records(v)
    assert r.select(record_kv(F.col("textbox")).alias("kv")).first().kv == "a=3;b=2"
    assert r.select(record_json(F.col("textbox")).alias("j")).first().j == '{"textbox":{"a":"3","b":"2"}}'


XML = ("<annotation><size><width>{w}</width><height>1000</height></size>"
       "<object><name>textbox</name><bndbox><xmin>40.9</xmin><ymin>-1.9</ymin><xmax>240</xmax><ymax>80.5</ymax></bndbox>"
       "<attributes><attribute><name>1_field_name</name><value>first</value></attribute>"
       "<attribute><name>static_value</name><value></value></attribute>"
       "<attribute><name>alpha_num_placement</name><value> n n </value></attribute>"
       "<attribute><name>1_field_name</name><value>second</value></attribute></attributes></object>"
       "<object><name>checkbox</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox>"
       "<attribute><name>1_field_name</name><value>bare</value></attribute></object></annotation>")


def test_xml_parsing_rules(spark):
    df = spark.createDataFrame([("t1", XML.format(w="800")), ("t2", XML.format(w="800.0")),
                                ("t3", "<annotation><size>")], "template_id string, xml string")
    p = parse_annotations(df)
    t = {r.template_id: r for r in templates(p).collect()}
    assert t["t1"].width == 800 and t["t2"].width is None and t["t3"].xml_broken
    f = typed_fields(p).filter("template_id = 't1'").orderBy("pos").collect()
    assert (f[0].xmin, f[0].ymin, f[0].xmax, f[0].ymax) == (40, -1, 240, 80)
    assert f[0].field_name == "second"            # later duplicate attribute wins
    assert f[0].static_value is None              # empty value is None
    assert f[0].mask == " n n "                   # surrounding spaces kept
    assert f[1].type == "checkbox" and f[1].field_name == "bare"


def test_draws_do_not_depend_on_partitioning(spark):
    base = spark.range(5000).select(F.col("id"), u01(7, F.col("id"), "x").alias("u"),
                                    randint(1, 6, 7, F.col("id")).alias("r"))
    a = {(r.id, r.u, r.r) for r in base.collect()}
    b = {(r.id, r.u, r.r) for r in base.repartition(37).collect()}
    assert a == b
    us = [x[1] for x in a]
    assert 0 <= min(us) and max(us) < 1 and abs(sum(us) / len(us) - 0.5) < 0.02
    assert {x[2] for x in a} == {1, 2, 3, 4, 5, 6}


def test_column_pattern_translation_matches_literal(spark):
    from docsynth.functions.strftime import spark_pattern
    fmts = ["%d-%m-%Y", "%m/%d/%Y", "%B %d, %Y", "%Y%j", "%a %d %b %y", "%%d%H's %%", "x%I:%M %p y", "%Q"]
    df = spark.createDataFrame([(f,) for f in fmts], "f string")
    got = {r.f: r.p for r in df.select("f", spark_pattern(F.col("f")).alias("p")).collect()}
    for f in fmts:
        try:
            want = to_spark_pattern(f)
        except UnsupportedFormat:
            want = None
        if want is None:
            assert got[f] is None
        else:
            ts = F.lit("2022-11-07 09:05:03").cast("timestamp_ntz")
            assert one(spark, F.date_format(ts, got[f])) == dt.datetime(2022, 11, 7, 9, 5, 3).strftime(f)


def test_line_offsets_equal_a_running_sum_at_any_block_size(spark, monkeypatch):
    import docsynth.operators.words as W
    rows = [(d, pg, ln, (d * 7 + ln + pg) % 5) for d in range(4) for pg in (1, 2) for ln in range(9)]
    per_line = spark.createDataFrame(rows, "doc_id int, page int, line int, _ds_n long")
    want, run = set(), {}
    for d, pg, ln, n in rows:
        want.add((d, pg, ln, run.get(d, 0)))
        run[d] = run.get(d, 0) + n
    for block in (1, 4, 4096):
        monkeypatch.setattr(W, "LINE_BLOCK", block)
        assert {tuple(r) for r in W.line_offsets(per_line).collect()} == want


def partition_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_expansion_balances_documents_and_never_shuffles_them(spark):
    # one template of 400,000 documents and 20,000 of one
    t = spark.range(20_001).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("template_id"),
                                   F.when(F.col("id") == 7, 400_000).otherwise(1).alias("n"))
    for options, chunk in (({"docs_per_chunk": 20_000}, 20_000), ({}, -(-420_000 // int(spark.conf.get("spark.sql.shuffle.partitions"))))):
        d = expand_documents(t, "n", **options)
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Generate") < plan.index("Exchange")  # documents above every exchange
        sizes = partition_sizes(d)
        assert sum(sizes) == 420_000 and max(sizes) <= chunk and len(sizes) == -(-420_000 // chunk)
        assert d.select("doc_id").distinct().count() == 420_000
        assert d.filter("template_id = 't7'").agg(F.min("doc_index"), F.max("doc_index"), F.count_distinct("doc_index")).first() == (0, 399_999, 400_000)


def test_expansion_of_repeated_null_and_negative_rows(spark):
    t = spark.createDataFrame([("a", 3, {"k": 1}), ("a", 3, {"k": 1}), ("a", 2, None), ("b", None, None), ("c", -5, None), ("d", 0, None)],
                              "template_id string, n int, m map<string,int>")
    got = sorted((r.template_id, r.doc_index) for r in expand_documents(t, "n").collect())
    assert got == sorted([("a", i) for i in range(3)] * 2 + [("a", i) for i in range(2)])
    assert expand_documents(t.limit(0), "n", docs_per_chunk=5).count() == 0


def test_records_keep_documents_without_values_and_skip_nameless_fields(spark):
    from docsynth.operators.records import assemble_records
    v = spark.createDataFrame([("d1", "t", 0, "a", "1"), ("d1", "t", 1, "b", "2"), ("d1", "t", 2, "a", "3"), ("d1", "t", 3, None, "4")],
                              "doc_id string, template_id string, pos int, field_name string, value string")
    docs = spark.createDataFrame([("d1", "t"), ("d2", "t")], "doc_id string, template_id string")
    got = {r.doc_id: r.textbox for r in assemble_records(v, documents=docs).collect()}
    assert list(got["d1"].items()) == [("a", "3"), ("b", "2")] and got["d2"] == {}


def test_empty_field_names_and_sizes_that_are_not_positive_are_rules(spark):
    from docsynth.operators.layout import widgets
    from docsynth.operators.validate import validate_templates
    from docsynth.sources.annotations import parse_annotations, templates, typed_fields
    attrs = "".join(f"<attribute><name>{n}</name><value>{v}</value></attribute>" for n, v in
                    (("1_field_name", ""), ("2_max_length", "4"), ("3_is_alphanum", "True"), ("alpha_num_placement", "nn"), ("static_value", "")))
    box = "<bndbox><xmin>1</xmin><ymin>1</ymin><xmax>3e9</xmax><ymax>50</ymax></bndbox>"
    xml = f"<annotation><size><width>0</width><height>\n90\n</height></size><object><name>textbox</name>{box}<attributes>{attrs}</attributes></object></annotation>"
    parsed = parse_annotations(spark.createDataFrame([("t", xml)], "template_id string, xml string"))
    assert templates(parsed).first().height == 90  # white space around a size is cut
    rules = {r.rule for r in validate_templates(parsed).collect()}
    assert {"V16_field_name_empty", "V17_size_not_positive", "V9_box_not_number"} <= rules
    assert widgets(templates(parsed), typed_fields(parsed)).count() == 1  # no division by zero


def test_weighted_lookup_of_many_groups(spark):
    from docsynth.operators.sampling import sample_weighted, weighted_intervals
    words = spark.range(3000).selectExpr("id % 300 as grp", "id as word", "id % 7 + 1 as weight")
    rows = spark.range(3000).selectExpr("id", "id % 300 as grp")
    u = F.col("id") / 3000.0
    a = sample_weighted(rows, words, u, ["word"], "weight", by=["grp"])
    b = rows.withColumn("u", u).join(weighted_intervals(words, ["word"], "weight", by=["grp"]), "grp").filter("u >= lo and u < hi")
    assert {(r.id, r.word) for r in a.collect()} == {(r.id, r.word) for r in b.collect()}


def test_stem_pairing_counts_each_key_once(spark):
    from docsynth.operators.pairing import pair_by_stem
    left = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    got = {(r.k, r.status) for r in pair_by_stem(left, right, "k").collect()}
    assert got == {("a", "matched"), ("b", "left_only"), ("c", "right_only")}
    assert pair_by_stem(left, right, "k").count() == 3


def test_duplicate_template_and_field_rules(spark):
    from docsynth.operators.validate import validate_templates
    obj = ("<object><name>textbox</name><bndbox><xmin>1</xmin><ymin>1</ymin><xmax>50</xmax><ymax>40</ymax></bndbox>"
           "<attributes><attribute><name>1_field_name</name><value>f</value></attribute>"
           "<attribute><name>2_max_length</name><value>3</value></attribute>"
           "<attribute><name>3_is_alphanum</name><value>True</value></attribute>"
           "<attribute><name>alpha_num_placement</name><value>nn</value></attribute>"
           "<attribute><name>static_value</name><value></value></attribute></attributes></object>")
    xml = f"<annotation><size><width>10</width><height>10</height></size>{obj}{obj}</annotation>"
    df = spark.createDataFrame([("t", xml), ("t", xml), ("u", xml)], "template_id string, xml string")
    rules = [tuple(r) for r in validate_templates(parse_annotations(df)).collect()]
    assert sorted(r for r in rules if r[3].startswith("V15")) == [("t", -1, None, "V15_duplicate_template_id")] * 2
    assert ("u", 1, "f", "V12_duplicate_field_name") in rules
    assert ("u", 0, "f", "V12_duplicate_field_name") not in rules
