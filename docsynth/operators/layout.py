"""Form widgets and glyph layout of the filled values.

``widgets`` is the widget spec the reference creates per text box (position
in points, font size, max length). ``layout_glyphs`` places each value's
characters in its widget with per-character font advances, so the word and
label operators have glyph input without PDF bytes (the placement rule is the
library's own: left-aligned on the widget's bottom edge, one line per field,
a newline glyph closing every field).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import DEFAULT_RESOLUTION, page_points, scale_to_page, to_bottom_left
from .sampling import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, measured

DEFAULT_FONT = "Helvetica"
DEFAULT_ADVANCE = 556


def widgets(templates: DataFrame, fields: DataFrame, resolution: float = DEFAULT_RESOLUTION,
            axes: str = "swapped", font: str = DEFAULT_FONT) -> DataFrame:
    """One widget per text box: name, page 1, x/y/w/h in points (bottom-left
    origin), ``max_length`` as a number, font size ``int(h - 4)``, no border.

    The page is the template's image at ``resolution``: its pixel size in
    ``image_width`` and ``image_height`` (see ``sources.images``) where the
    templates have it, else the size the annotation gives. Boxes are scaled
    from the annotation's size to the page's; with ``axes="swapped"`` (the
    reference's rule) x by the height's scale and y by the width's."""
    pixels = [F.coalesce(*[F.col(c) for c in (f"image_{side}", side) if c in templates.columns]).alias(f"_ds_{side}")
              for side in ("width", "height")]
    t = templates.select("template_id", "width", "height", *pixels)
    f = fields.filter(F.col("type") == "textbox").select("template_id", "pos", "field_name", "max_length",
                                                          "xmin", "ymin", "xmax", "ymax")
    j = f.join(t, "template_id")  # both sides are template dimensions; Spark picks the join by their sizes
    pw, ph = page_points(F.col("_ds_width"), resolution), page_points(F.col("_ds_height"), resolution)
    scale_w, scale_h = (F.try_divide(pw, F.col("width").cast("double")),
                        F.try_divide(ph, F.col("height").cast("double")))
    x1, y1, x2, y2 = scale_to_page(F.col("xmin").cast("double"), F.col("ymin").cast("double"),
                                   F.col("xmax").cast("double"), F.col("ymax").cast("double"),
                                   scale_w, scale_h, axes)
    bx1, by1, bx2, by2 = to_bottom_left(x1, y1, x2, y2, ph)
    h = by2 - by1
    return j.select("template_id", "pos", F.col("field_name").alias("name"), F.lit(1).alias("page_number"),
                    bx1.alias("x"), by1.alias("y"), (bx2 - bx1).alias("w"), h.alias("h"),
                    F.col("max_length").try_cast("double").alias("max_length"), F.lit(font).alias("font"),
                    (h - F.lit(4.0)).try_cast("int").alias("font_size"), F.lit(-1).alias("border_width"))


# Code points a page of the advance table.
PAGE = 256


def _advances(metrics: DataFrame, default_advance: int):
    """The advance of a character as an expression: two arrays searched by code point.

    The table has at most one entry a code point (of several the least advance, of
    none or null the default), so what the plan carries is bounded by Unicode; entries
    of more than one character match nothing. Pages without an entry are not stored."""
    one = metrics.where("ch is not null and char_length(ch) = 1 and advance is not null")
    found = {r["code"]: r["advance"] for r in one.groupBy(F.ascii("ch").alias("code")).agg(
        F.min("advance").cast("int").alias("advance")).collect()}
    pages = sorted({code // PAGE for code in found})
    number = {page: i for i, page in enumerate(pages)}
    places = [number.get(page, -1) for page in range(pages[-1] + 1)] if pages else [-1]
    values = [found.get(page * PAGE + low, default_advance) for page in pages for low in range(PAGE)] or [default_advance]

    def constant(numbers):  # one literal, folded to an array when the plan is made
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")

    at, of = constant(places), constant(values)

    def advance(c):  # a page that is not stored gives a place outside the array
        code = F.ascii(c)
        place = F.get(at, F.shiftright(code, PAGE.bit_length() - 1)) * PAGE + code % PAGE
        return F.coalesce(F.get(of, place), F.lit(default_advance))

    return advance


# Elements summed together before the sums of such blocks are added up.
SUM_BLOCK = 64


def _prefix_sums(values):
    """Sums before each element and of all, [0, v0, v0 + v1, ..]: within blocks of
    ``SUM_BLOCK`` elements, then over the blocks, so the cost of a long array
    grows far slower than with its square."""
    zero = F.lit(0).cast("bigint")

    def total(part):
        return F.aggregate(part, zero, lambda acc, x: acc + x)

    n = F.size(values)
    starts = F.sequence(F.lit(0), F.floor(n / SUM_BLOCK).cast("int"))
    blocks = F.transform(starts, lambda b: total(F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))
    upto = F.transform(starts, lambda b: total(F.slice(blocks, F.lit(1), b)))
    inside = F.flatten(F.transform(starts, lambda b: F.transform(
        F.sequence(F.lit(0), F.least(F.lit(SUM_BLOCK - 1), n - b * SUM_BLOCK)),
        lambda i: F.element_at(upto, b + 1) + total(F.slice(values, b * SUM_BLOCK + 1, i)))))
    return inside


def layout_glyphs(values: DataFrame, widget_spec: DataFrame, metrics: DataFrame,
                  default_advance: int = DEFAULT_ADVANCE,
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Glyph rows ``(doc_id, template_id, page, line, pos, ch, x0, y0, x1, y1)``.

    Each value becomes one line (``line`` = field position) on page 1; glyph
    ``pos`` i starts at ``x + font_size * (advances before i) / 1000`` (integer
    advances per 1000 em summed exactly, scaled last); boxes span the font
    size above ``y``. A ``'\\n'`` glyph with an empty box closes the line.
    The per-character prefix sums are array expressions on the value row, so
    the layout adds no shuffle; widgets (the template dimension) are
    broadcast after a size check, the metrics are arrays searched by code point.
    """
    w = widget_spec.select("template_id", "pos", "x", "y", "font_size")
    w = checked_broadcast(w, *measured(w), max_rows=max_broadcast_rows)
    v = values.filter(F.col("value").isNotNull()).select("doc_id", "template_id", "pos", "value").join(
        w, ["template_id", "pos"])
    advance = _advances(metrics, default_advance)
    chars = F.filter(F.split(F.col("value"), ""), lambda c: c != "")
    v = v.withColumn("_ds_chars", chars)
    v = v.withColumn("_ds_adv", F.transform("_ds_chars", advance))
    v = v.withColumn("_ds_cum", _prefix_sums(F.col("_ds_adv")))
    glyph = F.arrays_zip(F.concat(F.col("_ds_chars"), F.array(F.lit("\n"))).alias("ch"),
                         F.col("_ds_cum").alias("b"),
                         F.concat(F.col("_ds_adv"), F.array(F.lit(0))).alias("a"))
    g = v.select("doc_id", "template_id", F.lit(1).alias("page"), F.col("pos").alias("line"), "x", "y", "font_size",
                 F.posexplode(glyph).alias("pos", "g"))
    fs = F.col("font_size").cast("bigint")
    start = F.col("x") + (fs * F.col("g.b")).cast("double") / F.lit(1000.0)
    end = F.col("x") + (fs * (F.col("g.b") + F.col("g.a"))).cast("double") / F.lit(1000.0)
    return g.select("doc_id", "template_id", "page", "line", "pos", F.col("g.ch").alias("ch"), start.alias("x0"),
                    F.col("y").alias("y0"), end.alias("x1"), (F.col("y") + fs.cast("double")).alias("y1"))


def layout_words(values: DataFrame, widget_spec: DataFrame, metrics: DataFrame,
                 default_advance: int = DEFAULT_ADVANCE,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Words of the laid-out values, equal to
    ``words_from_glyphs(layout_glyphs(...))`` without building glyph rows.

    Per value (one line closed by a newline) the word runs between separators
    are found in the array domain, with boxes from the same integer advance
    sums as the glyphs (first glyph's left edge, last glyph's right edge).
    Numbering across a document needs its lines together: one ``groupBy`` of
    the value rows per document, whose size is the template's text-field
    count, so no group grows with the data.
    Output: doc_id, template_id, page, line, word_no, text, x0, y0, x1, y1.
    """
    w = widget_spec.select("template_id", "pos", "x", "y", "font_size")
    w = checked_broadcast(w, *measured(w), max_rows=max_broadcast_rows)
    v = values.filter(F.col("value").isNotNull()).select("doc_id", "template_id", "pos", "value").join(
        w, ["template_id", "pos"])
    advance = _advances(metrics, default_advance)
    chars = F.filter(F.split(F.col("value"), ""), lambda c: c != "")
    v = v.withColumn("_ds_chars", chars)
    adv = F.transform("_ds_chars", lambda c: advance(c).cast("bigint"))
    v = v.withColumn("_ds_adv", adv)
    # cum[i] = advance before glyph i, for i = 0..n (cum[n] = whole value)
    v = v.withColumn("_ds_cum", _prefix_sums(F.col("_ds_adv")))
    n = F.size("_ds_chars")
    # separator positions, with the closing newline at n
    seps = F.filter(F.sequence(F.lit(0), n),
                    lambda i: (i == n) | F.element_at(F.col("_ds_chars"), i + 1).isin(" ", "\n"))
    v = v.withColumn("_ds_seps", seps)
    runs = F.transform("_ds_seps", lambda s, k: F.struct(
        F.when(k == 0, F.lit(0)).otherwise(F.element_at(F.col("_ds_seps"), k) + 1).alias("start"), s.alias("end")))
    runs = F.filter(runs, lambda r: r["end"] > r["start"])
    fs = F.col("font_size").cast("bigint")

    def word(r):
        start, end = r["start"], r["end"]
        x0 = F.col("x") + (fs * F.element_at(F.col("_ds_cum"), start + 1)).cast("double") / F.lit(1000.0)
        x1 = F.col("x") + (fs * F.element_at(F.col("_ds_cum"), end + 1)).cast("double") / F.lit(1000.0)
        return F.struct(F.array_join(F.slice(F.col("_ds_chars"), start + 1, end - start), "").alias("text"),
                        x0.alias("x0"), x1.alias("x1"))

    v = v.select("doc_id", "template_id", "pos", "y", "font_size", F.transform(runs, word).alias("_ds_words"))
    per_doc = v.groupBy("doc_id", "template_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "y", "font_size", "_ds_words"))).alias("_ds_lines"))
    flat = F.flatten(F.transform("_ds_lines", lambda ln: F.transform(ln["_ds_words"], lambda wd: F.struct(
        ln["pos"].alias("line"), wd["text"].alias("text"), wd["x0"].alias("x0"), ln["y"].alias("y0"),
        wd["x1"].alias("x1"), (ln["y"] + ln["font_size"].cast("double")).alias("y1")))))
    out = per_doc.select("doc_id", "template_id", F.posexplode(flat).alias("word_no", "_ds_w"))
    return out.select("doc_id", "template_id", F.lit(1).alias("page"), F.col("_ds_w.line").alias("line"),
                      F.col("word_no").cast("bigint").alias("word_no"), "_ds_w.text", "_ds_w.x0", "_ds_w.y0",
                      "_ds_w.x1", "_ds_w.y1")
