"""Word boxes to OCR label lines (8 corner coordinates + text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import DEFAULT_RENDER_FACTOR, quad, to_image_rows

QUAD_COLS = ["q1", "q2", "q3", "q4", "q5", "q6", "q7", "q8"]


def label_boxes(words: DataFrame, image_height: Column | str, augment: Column | bool = True,
                factor: float = DEFAULT_RENDER_FACTOR) -> DataFrame:
    """Label quads per word.

    With ``augment`` the reference scales the point boxes by the render factor
    and flips them to image rows (against the rendered image height); without
    it the raw bottom-left point boxes are written (they then do not match the
    rendered image, as in the reference). Adds ``q1..q8`` ints.
    """
    h = F.col(image_height) if isinstance(image_height, str) else image_height
    aug = augment if isinstance(augment, Column) else F.lit(bool(augment))
    f = F.lit(float(factor))
    sx0, sy0, sx1, sy1 = (F.col("x0") * f, F.col("y0") * f, F.col("x1") * f, F.col("y1") * f)
    fx0, fy0, fx1, fy1 = to_image_rows(sx0, sy0, sx1, sy1, h.cast("double"))
    q_aug = quad(fx0, fy0, fx1, fy1)
    q_raw = quad(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    cols = [F.when(aug, a).otherwise(b).alias(n) for a, b, n in zip(q_aug, q_raw, QUAD_COLS)]
    return words.select("*", *cols)


def label_line(df_cols=QUAD_COLS, text_col: str = "text") -> Column:
    """``x1,y1,...,y4,text``: the text is not escaped, so readers split on the
    first eight commas."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in df_cols], F.col(text_col))


def label_lines(labels: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    return labels.select(doc_col, "word_no", label_line().alias("line"))
