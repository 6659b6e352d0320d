"""The strptime acceptor against Python's own."""

import random
import time

from pyspark.sql import functions as F

from docsynth.functions.strftime import PARSED, strptime_accepts

FORMATS = ["%d-%m-%Y", "%m-%d-%Y", "%m/%d/%Y", "%Y-%m-%d", "%d-%m-20%y", "%d-%m-%y", "%d-%m-%Y%%", "%d-%d-%Y", "%Q", "", "%", "%d-%m-%", "(%d)-%m-%Y", "%j-%m-%Y",
           "%H-%I-%Y", "%M-%S-%Y", "0%d-%m-%Y", "01-01-2021", "01-01-20%y", "%d\t-%m-%Y", "%D-%m-%Y", "%b-%d-%Y", "[%d]", "%d.%m.%Y", "a+b", "%d-%m-%Y$", "%y%y-%d"]


def accepts(text, fmt):
    try:
        time.strptime(text, fmt)
        return True
    except Exception:  # also a directive that stands twice
        return False


def test_formats_read_what_python_reads(spark):
    rng = random.Random(1)
    parts = [f"%{k}" for k in PARSED if k not in "pBbAa"] + ["-", "-", "-", "0", "1", "20", "2021", "/", "."]
    formats = FORMATS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(1500)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(formats)], "id int, fmt string")
    for text in ("01-01-2021", "01-01-2024"):
        got = {r.id: r.ok for r in df.select("id", strptime_accepts(F.col("fmt"), text).alias("ok")).collect()}
        for i, f in enumerate(formats):
            assert got[i] == accepts(text, f), (text, f)
        assert 5 < sum(got.values()) < len(formats) - 5
