"""Pascal-VOC-like annotation XML as tables.

``read_annotations`` reads whole files (one row each, path from ``_metadata``);
``parse_annotations`` parses a string column: ``from_xml`` judges the text and gives
the size, ``xml_tree.object_list`` the objects at any depth with all attributes inside
them. ``templates`` and ``typed_fields`` project the parsed struct into the two
relations the operators use.

Reference parsing rules kept: ``<value></value>`` is None (Spark gives '', so
``nullif``), surrounding spaces are kept, only the exact texts True/False are
booleans (kept as text here; see ``truthy``), a later attribute with the same
name wins, box coordinates are ``int(float(text))`` (truncation), sizes are
``int(text)`` (so '800.0' is invalid). Objects count wherever they stand below the
root, in document order; an object holds every ``attribute`` element inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .xml_tree import object_list

_ATTR = "array<struct<name:string,value:string>>"
ANNOTATION_SCHEMA = (
    "size struct<width:string,height:string>, "
    "object array<struct<name:string, bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>, "
    f"attributes:struct<attribute:{_ATTR}>, attribute:{_ATTR}>>, "
    "_corrupt_record string"
)
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "_corrupt_record"}

ATTRIBUTE_KEYS = {
    "field_name": "1_field_name", "max_length": "2_max_length", "is_alphanum": "3_is_alphanum",
    "is_date": "4_is_date", "is_name": "5_is_name", "mask": "alpha_num_placement",
    "date_format": "date_format", "name_type": "name_type", "name_suffix": "name_suffix",
    "name_gender": "name_gender", "name_indian": "name_indian", "static_value": "static_value",
}


def parse_annotations(df: DataFrame, xml_col: str = "xml", out_col: str = "annotation") -> DataFrame:
    """Parse an XML string column into the annotation struct (null leaves on
    broken XML, with the raw text in ``annotation._corrupt_record``).

    Each text is walked where its row lies (see ``xml_tree``): rows may repeat, need no key
    and are not shuffled."""
    parsed = df.withColumn(out_col, F.from_xml(F.col(xml_col), ANNOTATION_SCHEMA, XML_OPTIONS))
    whole = F.col(out_col)["_corrupt_record"].isNull()
    return parsed.withColumn(out_col, F.col(out_col).withField("object", F.when(whole, object_list(F.col(xml_col)))))


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Scan ``path`` (a folder or glob of .xml files): one row per file with
    ``annotation_path`` and the struct in ``annotation``."""
    raw = spark.read.text(path, wholetext=True)
    # the metadata path is URI-escaped; files pair in the order of plain paths
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parsed = parse_annotations(raw.select(plain.alias("annotation_path"), F.col("value").alias("_ds_text")), "_ds_text")
    return parsed.select("annotation_path", "annotation")


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """File listing of an image folder (bytes are pruned: only path/length read)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("image_path"), "length")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """``splitext(basename(path))[0]``: cut the last extension only; leading
    dots are not an extension."""
    b = basename(path)
    s = F.regexp_extract(b, r"^(\.*[^.].*?)(\.[^.]*)?$", 1)
    return F.when(s == "", b).otherwise(s)


def strip(v: Column) -> Column:
    """The text without white space (line breaks and tabs too) at its ends."""
    return F.regexp_replace(v, r"^\s+|\s+$", "")


def size_int(v: Column) -> Column:
    """``int(text)``: whole numbers only, null otherwise ('800.0' -> null)."""
    return F.when(strip(v).rlike(r"^[+-]?\d+$"), strip(v).try_cast("int"))


def coord_int(v: Column) -> Column:
    """``int(float(text))``: parse as double, truncate toward zero."""
    d = strip(v)
    num = F.when(d.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), d.cast("double"))
    return num.try_cast("int")  # out of int range -> null (a V9 row), never an ANSI error


def templates(df: DataFrame, id_col: str = "template_id", ann: str = "annotation") -> DataFrame:
    """Template table: id, width, height (null when not a plain integer), raw texts, and the
    pixel size of the template's image if ``df`` has it."""
    a = F.col(ann)
    return df.select(F.col(id_col).alias("template_id"),
                     size_int(a["size"]["width"]).alias("width"),
                     size_int(a["size"]["height"]).alias("height"),
                     a["size"]["width"].alias("width_text"), a["size"]["height"].alias("height_text"),
                     a["_corrupt_record"].isNotNull().alias("xml_broken"),
                     *[c for c in ("image_width", "image_height") if c in df.columns])


def _dedup_last(attrs: Column) -> Column:
    """Keep only the last occurrence of each attribute name."""
    named = F.filter(attrs, lambda x: x["name"].isNotNull())
    return F.filter(named, lambda x, i: ~F.exists(F.slice(named, i + 2, F.size(named) + 1),
                                                  lambda y: y["name"] == x["name"]))


def attribute_map(obj: Column) -> Column:
    both = F.concat(F.coalesce(obj["attributes"]["attribute"], F.array().cast(_ATTR)),
                    F.coalesce(obj["attribute"], F.array().cast(_ATTR)))
    kept = _dedup_last(both)
    return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["name"].alias("key"),
                                                                    F.nullif(x["value"], F.lit("")).alias("value"))))


def typed_object_columns(obj: Column) -> list[Column]:
    """Typed columns of one ``<object>`` struct: type, integer box, the
    attribute texts by name, the attribute map and the raw box."""
    box = obj["bndbox"]
    attrs = attribute_map(obj)
    cols = [obj["name"].alias("type"),
            coord_int(box["xmin"]).alias("xmin"), coord_int(box["ymin"]).alias("ymin"),
            coord_int(box["xmax"]).alias("xmax"), coord_int(box["ymax"]).alias("ymax")]
    cols += [attrs[key].alias(name) for name, key in ATTRIBUTE_KEYS.items()]
    return cols + [attrs.alias("attributes"), box.alias("bndbox")]


def typed_fields(df: DataFrame, id_col: str = "template_id", ann: str = "annotation") -> DataFrame:
    """The typed field table (FIXTURES §2 ``fields``) plus the raw attribute map."""
    o = df.select(F.col(id_col).alias("template_id"), F.posexplode(F.col(ann)["object"]).alias("pos", "obj"))
    return o.select("template_id", "pos", *typed_object_columns(F.col("obj")))
