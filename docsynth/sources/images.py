"""Pixel sizes of image files, read from their headers.

Column expressions over the bytes of ``binaryFile`` rows: a PNG's size stands in
its first chunk, a JPEG's in the first frame header, which is found by walking
from marker to marker. No pixels are decoded and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats.
PNG_SIGNATURE = "89504E470D0A1A0A0000000D49484452"  # signature, then length and name of the first chunk
JPEG_START = "FFD8"
FRAME_MARKERS = [0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF]
BARE_MARKERS = [0x01, *range(0xD0, 0xD9)]  # without a length
LAST_MARKERS = [0x00, 0xD9, 0xDA]  # no frame header comes after these


def _number(content: Column, at: Column, width: int) -> Column:
    """Big-endian unsigned number of ``width`` bytes from 1-based ``at``; null beyond the end."""
    digits = F.hex(F.substr(content, at, F.lit(width)))
    return F.when(F.length(digits) == 2 * width, F.conv(digits, 16, 10).cast("bigint"))


def _walk(content: Column) -> Column:
    """struct(at, done, width, height) after walking a JPEG's markers."""
    def state(at, done, width=None, height=None):
        none = F.lit(None).cast("bigint")
        return F.struct(at.cast("bigint").alias("at"), F.lit(done).alias("done"),
                        (none if width is None else width).alias("width"), (none if height is None else height).alias("height"))

    def step(s: Column) -> Column:
        at = s["at"]
        marker, size = _number(content, at + 1, 1), _number(content, at + 2, 2)
        return (F.when(s["done"], s)
                .when(F.coalesce(_number(content, at, 1) != 0xFF, F.lit(True)) | marker.isNull(), state(at, True))
                .when(marker == 0xFF, state(at + 1, False))
                .when(marker.isin(BARE_MARKERS), state(at + 2, False))
                .when(marker.isin(FRAME_MARKERS), state(at, True, _number(content, at + 7, 2), _number(content, at + 5, 2)))
                .when(marker.isin(LAST_MARKERS) | F.coalesce(size < 2, F.lit(True)), state(at, True))
                .otherwise(state(at + 2 + size, False)))

    # every step goes at least a byte on; steps are taken in rounds, so a size that is found early ends the walk
    round_ = F.sequence(F.lit(1), F.ceil(F.sqrt(F.length(content))).cast("int") + 1)
    return F.aggregate(round_, state(F.lit(3), False),
                       lambda s, _: F.when(s["done"], s).otherwise(F.aggregate(round_, s, lambda t, _: step(t))))


def image_size(content: Column) -> Column:
    """struct(format, width, height) of an image's bytes; a null struct when
    they hold no PNG or JPEG header with a size."""
    png = F.struct(F.lit("png").alias("format"), _number(content, F.lit(17), 4).alias("width"), _number(content, F.lit(21), 4).alias("height"))
    jpeg = F.transform(F.array(_walk(content)), lambda w: F.struct(F.lit("jpeg").alias("format"), w["width"].alias("width"), w["height"].alias("height")))
    found = (F.when(F.hex(F.substr(content, F.lit(1), F.lit(16))) == PNG_SIGNATURE, F.array(png))
             .when(F.hex(F.substr(content, F.lit(1), F.lit(2))) == JPEG_START, jpeg))
    return F.get(F.filter(found, lambda s: (s["width"] > 0) & (s["height"] > 0)), F.lit(0))


def read_image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``image_path``, ``length``, ``image_width``, ``image_height`` of every file
    (null sizes where the header gives none)."""
    files = spark.read.format("binaryFile").load(path)
    sized = files.select(F.col("path").alias("image_path"), "length", image_size(F.col("content")).alias("_ds_size"))
    return sized.select("image_path", "length", F.col("_ds_size.width").alias("image_width"), F.col("_ds_size.height").alias("image_height"))
