"""Pixel sizes from image headers."""

import random
import struct

from pyspark.sql import functions as F

from docsynth.sources.images import image_size, read_image_sizes


def png(w, h):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBB", 13, b"IHDR", w, h, 8, 2, 0, 0, 0) + b"rest"


def jpeg(w, h, segments=(), frame=0xC0, fill=0):
    body = b"".join(b"\xff" + bytes([m]) + struct.pack(">H", len(d) + 2) + d for m, d in segments)
    return b"\xff\xd8" + body + b"\xff" * fill + b"\xff" + bytes([frame]) + struct.pack(">HBHHB", 17, 8, h, w, 3) + bytes(9) + b"\xff\xda"


def sizes(spark, contents):
    df = spark.createDataFrame([(i, bytearray(c) if c is not None else None) for i, c in enumerate(contents)], "id int, content binary")
    return [tuple(r.s) if r.s else None for r in df.select("id", image_size(F.col("content")).alias("s")).orderBy("id").collect()]


def test_sizes_of_headers(spark):
    rng = random.Random(3)
    cases = [(png(1, 70_000), ("png", 1, 70_000)), (jpeg(640, 480), ("jpeg", 640, 480))]
    for _ in range(20):
        # segments whose data look like frames, of any length up to the longest
        segments = [(rng.choice([0xE0, 0xE1, 0xDB, 0xC4, 0xFE]), rng.choice([b"\xff\xc0\x00\x11", b"", rng.randbytes(rng.randint(0, 65_533))])) for _ in range(rng.randint(0, 6))]
        w, h = rng.randint(1, 65_535), rng.randint(1, 65_535)
        cases.append((jpeg(w, h, segments, rng.choice([0xC0, 0xC1, 0xC2, 0xCF]), rng.randint(0, 3)), ("jpeg", w, h)))
    assert sizes(spark, [c for c, _ in cases]) == [s for _, s in cases]


def test_thousands_of_segments_before_the_frame(spark):
    assert sizes(spark, [jpeg(9, 8, [(0xFE, b"x")] * 30_000)]) == [("jpeg", 9, 8)]


def test_files_without_a_size(spark):
    assert sizes(spark, [None, b"", b"\xff\xd8", b"\xff\xd8\xff", b"\xff\xd8\xff\xe0\x00", b"\xff\xd8\xff\xe0\x00\x01\xff\xc0", b"GIF89a" + bytes(30), png(5, 5)[:22],
                         png(0, 5), b"\xff\xd8" + bytes(50), jpeg(3, 4)[:9], b"\xff\xd8\xff\xda" + jpeg(3, 4)[2:], b"\xff\xd8" + b"\xff" * 500]) == [None] * 13


def test_sizes_of_files(spark, tmpdir_path):
    for name, content in (("a.png", png(30, 40)), ("b.jpg", jpeg(50, 60, [(0xE0, b"JFIF")])), ("c.jpg", b"no image")):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(content)
    got = {r.image_path.rsplit("/", 1)[1]: (r.image_width, r.image_height) for r in read_image_sizes(spark, f"{tmpdir_path}/*").collect()}
    assert got == {"a.png": (30, 40), "b.jpg": (50, 60), "c.jpg": (None, None)}
