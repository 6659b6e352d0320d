"""The end-to-end job: a folder of form templates -> a synthetic dataset.

Input layout (as the reference expects): ``{base}/Annotations/*.xml`` and
``{base}/JPEGImages/*``, paired by sorted position. Output under ``out``:

* ``rejected_templates``: rule rows of templates that fail validation;
* ``values``: the long ground-truth table (doc, field, value), bucketed by doc;
* ``records``: one JSON line per document (``{"doc_id", "textbox"}``);
* ``labels``: label lines ``x1,y1,..,y4,text`` per word;
* ``augmentation_plan`` (when ``augment``) and ``manifest``.

The values table is written first (bucketed by document) and read back for
records and labels, so the generation runs once, later stages restart from
files if an executor is lost, and neither per-document grouping shuffles.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import DEFAULT_RENDER_FACTOR
from ..operators.augplan import augmentation_plan
from ..operators.expand import expand_documents, manifest
from ..operators.labels import label_boxes
from ..operators.layout import layout_words, widgets
from ..operators.pairing import pair_by_position, pairing_rules
from ..operators.records import assemble_records
from ..operators.validate import validate_templates
from ..operators.values import generate_values
from ..sources.annotations import read_annotations, stem, templates, typed_fields
from ..sources.images import read_image_sizes
from ..sources.writers import write_labels, write_records, write_table

# Rules that only warn (the document can still be generated).
WARNING_RULES = ("V7_date_format_rejects_bounds", "V12_duplicate_field_name", "V13_font_size_not_positive")


@dataclass
class Dictionaries:
    first_names: DataFrame   # name, gender, weight
    last_names: DataFrame    # name, weight
    indian_names: DataFrame  # name, gender
    font_metrics: DataFrame  # ch, advance


def load_templates(spark: SparkSession, base: str) -> DataFrame:
    """Annotations paired with images by sorted position (the reference rule);
    ``template_id`` is the image file name without its last extension. The page
    of a template is its image, so the image's pixel size comes along."""
    ann, img = _listings(spark, base)
    paired = pair_by_position(ann, img, ["annotation_path"], ["image_path"])
    return paired.withColumn("template_id", stem(F.col("image_path")))


def _listings(spark: SparkSession, base: str):
    return (read_annotations(spark, f"{base.rstrip('/')}/Annotations/*.xml"),
            read_image_sizes(spark, f"{base.rstrip('/')}/JPEGImages/*"))


def unpaired_rules(spark: SparkSession, base: str) -> DataFrame:
    """V11 rows for annotation or image files left without a partner."""
    ann, img = _listings(spark, base)
    return pairing_rules(ann, img, ["annotation_path"], ["image_path"], "annotation_path")


def _default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _values_table(path: str) -> str:
    return "docsynth_values_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex[:16]


def write_bucketed_values(values: DataFrame, path: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Write the values table bucketed by ``doc_id`` (sorted by position) as an
    external table at ``path`` and return the table.

    Both later per-document groupings (records, word layout) then read
    co-located buckets: the one shuffle is this write, not one per consumer.
    The table is registered in the session catalog under a per-path name, which
    ``build_dataset`` drops at its end (the files stay).
    """
    name = _values_table(path)
    # rows of a bucket meet in one task first: one file per bucket
    (values.repartition(buckets, "doc_id").write.mode(mode).format("parquet").bucketBy(buckets, "doc_id").sortBy("doc_id", "pos")
     .option("path", path).saveAsTable(name))
    return values.sparkSession.table(name)


def build_dataset(spark: SparkSession, base: str, out: str, num_files: int, dicts: Dictionaries,
                  seed: int = 0, augment: bool = True, probability: float = 0.5,
                  factor: float = DEFAULT_RENDER_FACTOR, mode: str = "overwrite",
                  buckets: int | None = None) -> dict[str, str]:
    out = out.rstrip("/")
    parsed = load_templates(spark, base)
    rules = validate_templates(parsed).unionByName(unpaired_rules(spark, base))
    write_table(rules, f"{out}/rejected_templates", mode)
    rules = spark.read.parquet(f"{out}/rejected_templates")
    blocking = rules.filter(~F.col("rule").isin(*WARNING_RULES)).select("template_id").distinct()
    good = parsed.join(blocking, "template_id", "left_anti")
    tpl = templates(good).select("template_id", "width", "height", "image_width", "image_height")
    fields = typed_fields(good).drop("attributes", "bndbox")

    docs = expand_documents(tpl, num_files)
    values = generate_values(docs, fields, seed, dicts.first_names, dicts.last_names, dicts.indian_names)
    values = write_bucketed_values(values, f"{out}/values", buckets or _default_buckets(spark), mode)

    write_records(assemble_records(values, documents=docs), f"{out}/records", mode)

    words = layout_words(values.filter(F.col("error").isNull()), widgets(tpl, fields), dicts.font_metrics)
    heights = tpl.select("template_id", (F.col("height") * F.lit(factor)).alias("_img_h"))
    labels = label_boxes(words.join(heights, "template_id"), "_img_h", augment, factor)
    write_labels(labels, f"{out}/labels", mode)

    outputs = {"rejected_templates": f"{out}/rejected_templates", "values": f"{out}/values",
               "records": f"{out}/records", "labels": f"{out}/labels", "manifest": f"{out}/manifest"}
    if augment:
        write_table(augmentation_plan(docs, probability, seed), f"{out}/augmentation_plan", mode)
        outputs["augmentation_plan"] = f"{out}/augmentation_plan"
    write_table(manifest(docs.select("doc_id", "template_id"), out), f"{out}/manifest", mode)
    spark.sql(f"DROP TABLE IF EXISTS {_values_table(f'{out}/values')}")
    return outputs
