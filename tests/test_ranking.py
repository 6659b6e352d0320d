"""Global ranks and running totals by fixed splitters."""

import random

from pyspark.sql import functions as F

from docsynth.operators import ranking as R


def test_ranks_and_totals_of_mixed_keys(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice([None, "", "a", "Zé", "日本", "a" * 50, "\x01"]), rng.choice([None, -5, 0, 3, 2 ** 40]), i, rng.randint(-3, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b long, c int, v int").repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    for sample in (8192, 40, 1):
        monkeypatch.setattr(R, "SAMPLE", sample)
        got = {r.c: r.rank for r in R.global_rank(df, ["a", "b", "c"]).collect()}
        assert got == {r[2]: i for i, r in enumerate(order)}
        total, want = 0, {}
        for r in order:
            total += r[3]
            want[r[2]] = total
        assert {r.c: r.running for r in R.running_total(df, ["a", "b", "c"], "v").collect()} == want
    assert R.global_rank(df.limit(0), ["a", "c"]).count() == 0


def test_ranges_are_even_and_no_checkpoint_is_made(spark):
    df = spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    number, n = R._ranges(df, ["k"])
    sizes = [r["count"] for r in df.groupBy(number.alias("r")).count().collect()]
    assert len(sizes) == n == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 1.2 * 100_000 / n
    ranked = R.global_rank(df, ["k"])
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan
    assert ranked.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first() == (0, 99_999, 100_000)
