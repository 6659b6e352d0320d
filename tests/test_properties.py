"""Properties over the driver tables: ranges, distributions, invariance."""

import math

from pyspark.sql import functions as F

from docsynth.operators.augplan import CATALOG, augmentation_plan, expected_rate, plan_audit
from docsynth.operators.sampling import sample_uniform, sample_weighted, weighted_intervals
from docsynth.functions.draws import u01
from docsynth.plans.queries import QUERIES


def test_mask_length_is_class_count(spark, sf_small):
    rows = QUERIES["gen_alphanum"](spark, sf_small).collect()
    for r in rows:
        assert len(r.value) == sum(r.mask.count(c) for c in "nCc")
        assert len(r.value_keep) == len(r.mask)


def test_dates_in_range(spark, sf_small):
    df = QUERIES["gen_date"](spark, sf_small).filter("fmt_no = 0")
    for r in df.collect():
        d, m, y = map(int, r.value.split("-"))
        assert 2021 <= y <= 2023 and 1 <= m <= 12 and 1 <= d <= 31


def test_values_invariant_under_repartition(spark, sf_small):
    a = QUERIES["generate_values"](spark, sf_small)
    left = {tuple(r) for r in a.collect()}
    b = {tuple(r) for r in a.repartition(1).collect()}
    c = {tuple(r) for r in a.repartition(64, "doc_id").collect()}
    assert left == b == c


def test_binned_equals_plain_range_join(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/events.parquet").select("event_id")
    words = (spark.read.parquet(f"{sf_small}/part.parquet")
             .select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").count()
             .withColumnRenamed("count", "weight"))
    u = u01(9, F.col("event_id"))
    binned = {tuple(r) for r in sample_weighted(e, words, u, ["word"], "weight", bins=7).collect()}
    intervals = weighted_intervals(words, ["word"], "weight")
    plain = {tuple(r) for r in e.withColumn("u", u).join(intervals, F.expr("u >= lo and u < hi"), "left").select(*sample_weighted(
        e, words, u, ["word"], "weight").columns).collect()}
    assert binned == plain and len(binned) == e.count()


def test_weighted_draws_follow_weights(spark):
    d = spark.createDataFrame([("a", 1), ("b", 3)], "word string, weight long")
    rows = spark.range(20000).withColumnRenamed("id", "k")
    got = sample_weighted(rows, d, u01(3, F.col("k")), ["word"], "weight").groupBy("word").count().collect()
    share = {r.word: r["count"] / 20000 for r in got}
    assert abs(share["b"] - 0.75) < 4 * math.sqrt(0.75 * 0.25 / 20000)


def test_uniform_by_group_stays_in_group(spark):
    d = spark.createDataFrame([("m1", "male"), ("m2", "male"), ("f1", "female")], "name string, gender string")
    rows = spark.range(300).select(F.col("id"), F.when(F.col("id") % 2 == 0, "male").otherwise("female").alias("gender"))
    out = sample_uniform(rows, d, u01(1, F.col("id")), ["name"], by=["gender"]).collect()
    assert all(r.name[0] == r.gender[0] for r in out) and len(out) == 300


def test_plan_rates_within_four_sigma(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_orderkey")
    n = docs.count()
    audit = {r.op: r for r in plan_audit(augmentation_plan(docs, 0.5, 11, "o_orderkey"), n, 0.5).collect()}
    for op in CATALOG:
        p = expected_rate(op, 0.5)
        got = audit[op.op].rate if op.op in audit else 0.0
        assert abs(got - p) <= 4 * math.sqrt(p * (1 - p) / n) + 1e-9, (op.op, got, p)


def test_plan_steps_are_dense_and_in_phase_order(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_orderkey").limit(200)
    order = {o.op: i for i, o in enumerate(CATALOG)}
    rows = augmentation_plan(docs, 0.5, 2, "o_orderkey").select("o_orderkey", "step", "op").distinct().collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.o_orderkey, []).append((r.step, order[r.op]))
    for steps in by_doc.values():
        steps.sort()
        assert [s for s, _ in steps] == list(range(1, len(steps) + 1))
        assert [o for _, o in steps] == sorted(o for _, o in steps)


def test_label_box_contains_its_glyphs(spark, sf_small):
    words = QUERIES["form_words"](spark, sf_small)
    glyphs = QUERIES["layout_glyphs"](spark, sf_small).filter("ch NOT IN (' ', '\n')")
    j = glyphs.alias("g").join(words.alias("w"), ["doc_id", "line"]).filter(
        "g.x0 >= w.x0 AND g.x1 <= w.x1 AND g.y0 >= w.y0 AND g.y1 <= w.y1")
    per_glyph = j.select("doc_id", "line", "pos").distinct().count()
    terminated = glyphs.count()
    assert per_glyph == terminated


def test_large_dictionary_path_matches_small_path(spark, sf_small, monkeypatch):
    import docsynth.operators.sampling as S
    e = spark.read.parquet(f"{sf_small}/events.parquet").select("event_id")
    words = (spark.read.parquet(f"{sf_small}/part.parquet")
             .select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").count()
             .withColumnRenamed("count", "weight"))
    sup = spark.read.parquet(f"{sf_small}/supplier.parquet").select("s_suppkey", "s_name")
    named = sup.withColumn("g", F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b"))
    ev = e.withColumn("g", F.when(F.col("event_id") % 3 == 0, "a").otherwise("b"))
    u = u01(4, F.col("event_id"))

    def run(mb=S.DEFAULT_MAX_BROADCAST_ROWS):
        return ({tuple(r) for r in S.sample_weighted(e, words, u, ["word"], "weight",
                                                     max_broadcast_rows=mb).collect()},
                {tuple(r) for r in S.sample_uniform(e, sup, u, ["s_suppkey"], max_broadcast_rows=mb).collect()},
                {tuple(r) for r in S.sample_uniform(ev, named, u, ["s_suppkey"], by=["g"],
                                                    max_broadcast_rows=mb).collect()})
    small = run()
    monkeypatch.setattr(S, "SMALL_DICTIONARY_ROWS", 0)  # distributed ranking
    assert run(mb=0) == small                           # and shuffle joins instead of broadcasts


def test_rows_without_lookup_are_spread_in_shuffle_joins(spark):
    from docsynth.operators.sampling import sample_weighted
    d = spark.createDataFrame([("a", 1), ("b", 3)], "word string, weight long")
    rows = spark.range(4000).withColumnRenamed("id", "k")
    u = F.when(F.col("k") % 4 == 0, u01(3, F.col("k")))  # three quarters need no lookup
    out = sample_weighted(rows, d, u, ["word"], "weight", max_broadcast_rows=0)
    got = out.collect()
    assert len(got) == 4000
    assert sum(r.word is not None for r in got) == 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_ds_bin" in plan  # a shuffle join (AQE may still broadcast at run time)
    assert "coalesce(FLOOR" in plan and "xxhash64" in plan   # null keys get a spread salt


def test_long_rows_are_not_broadcast_however_few(spark, monkeypatch):
    import docsynth.operators.sampling as S
    monkeypatch.setattr(S, "DEFAULT_MAX_BROADCAST_BYTES", 1 << 20)
    rows = spark.range(100).withColumnRenamed("id", "k")
    u = u01(5, F.col("k"))
    long, short = (spark.range(30).select(F.col("id").alias("w"), F.lit(1).alias("weight"), F.repeat(F.lit("é"), n).alias("text"))
                   for n in (20000, 3))
    assert S.measured(short) == (30, 30 * (6 + S.ROW_BYTES)) and S.measured(short.limit(0)) == (0, 0)
    for sample in (lambda d: S.sample_uniform(rows, d, u, ["w"]), lambda d: S.sample_weighted(rows, d, u, ["w"], "weight")):
        assert "strategy=broadcast" in sample(short)._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in sample(long)._jdf.queryExecution().optimizedPlan().toString()
        assert {(r.k, r.w) for r in sample(long).collect()} == {(r.k, r.w) for r in sample(short).collect()}


def test_advances_of_a_large_character_set(spark):
    from docsynth.operators.layout import layout_glyphs, layout_words
    codes = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000] + [0x1F600, 0x10FFFF]  # more than 65,536
    metrics = spark.createDataFrame([(chr(c), 100 + c % 900) for c in codes] + [("A", 9999), ("fi", 1), (None, 5), ("\U0001F601", None)],
                                    "ch string, advance int")
    value = "A中\U0001F600\U0001F601\U0010FFFFz"
    values = spark.createDataFrame([(1, "t", 0, value), (2, "t", 0, "")], "doc_id long, template_id string, pos int, value string")
    spec = spark.createDataFrame([("t", 0, 0.0, 0.0, 1000)], "template_id string, pos int, x double, y double, font_size int")
    glyphs = layout_glyphs(values, spec, metrics, default_advance=7).where("doc_id = 1").orderBy("pos").collect()
    widths = [g.x1 - g.x0 for g in glyphs]
    assert widths == [7.0 if c == "\U0001F601" else 100.0 + ord(c) % 900 for c in value] + [0.0]
    (word,) = layout_words(values, spec, metrics, default_advance=7).collect()
    assert word.text == value and word.x1 == sum(widths)
    none = layout_glyphs(values, spec, metrics.limit(0), default_advance=7).where("doc_id = 1").collect()
    assert [g.x1 - g.x0 for g in sorted(none, key=lambda g: g.pos)] == [7.0] * len(value) + [0.0]
