"""Objects of annotation XML at any depth, by bracket matching of tags.

An XML text is cut into its tags, each with the text up to the next one (a regular
expression; comments, processing instructions and declarations fall out). Everything
else is a running count or a last value over the tags, in order:

* an element's depth is the number of tags open at it;
* its parent is the last element opened one level higher up;
* the objects around it are, for every number of open objects, the last one opened
  at that number.

So an object may stand in a group, in another object or below any other element, and
holds every attribute anywhere inside it, also those of objects inside it, as a walk over
all its descendants gives them. A text is one row's value, so its tags are walked where
the row lies: nothing is shuffled or sorted, a task holds one Arrow batch, and the work is
linear in the tags and in the depth of objects within objects.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ASIDE = r"<!--.*?-->|<\?.*?\?>"
_CDATA = r"<!\[CDATA\[.*?\]\]>"
_TAG = r"</?[^\s/>!?](?:\"[^\"]*\"|'[^']*'|[^'\">]+)*+>"
_FLAGS = re.DOTALL | re.ASCII
#: A tag with all text after it, or something outside the tree.
_TOKEN = re.compile(rf"{_ASIDE}|<!(?!\[)[^>]*>|({_TAG})((?:[^<]+|{_CDATA}|{_ASIDE})*+)", _FLAGS)
_NAME = re.compile(r"</?([^\s/>]+)", _FLAGS)
_PIECE = re.compile(rf"{_CDATA}|{_ASIDE}|[^<]+", _FLAGS)
_REFERENCE = re.compile(r"&[^;&\s]+;", _FLAGS)
_NUMBER = re.compile(r"&#(?:([0-9]{1,7})|x([0-9a-fA-F]{1,6}));")

COORDS = ("xmin", "ymin", "xmax", "ymax")
_ATTRIBUTE = "array<struct<name:string,value:string>>"
_OBJECTS = (f"array<struct<name:string,bndbox:struct<{','.join(f'{c}:string' for c in COORDS)}>,"
            f"attributes:struct<attribute:{_ATTRIBUTE}>,attribute:{_ATTRIBUTE}>>")
_ELEMENTS = "array<struct<node:int,parent:int,parent_tag:string,tag:string,depth:int,objects:int,text:string>>"

# The entities every XML text may use.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&amp;": "&", "&quot;": '"', "&apos;": "'"}


def _resolved(reference: re.Match) -> str:
    """A character or entity reference as its character; what is none, as it is."""
    part = reference[0]
    number = _NUMBER.fullmatch(part)
    if not number:
        return ENTITIES.get(part, part)
    code = int(number[1]) if number[1] else int(number[2], 16)
    return chr(code) if code < 0xD800 or 0xE000 <= code <= 0x10FFFF else part


def text_of(raw: str) -> str | None:
    """Character data of the text between two tags; None when there is none."""
    if "<" not in raw and "&" not in raw:
        return raw or None
    pieces = (p[9:-3] if p.startswith("<![CDATA[") else "" if p.startswith("<") else _REFERENCE.sub(_resolved, p)
              for p in _PIECE.findall(raw))
    return "".join(pieces) or None


def _walked(xml: str) -> Iterator[tuple]:
    """(node, parent, parent_tag, tag, depth, objects, text) of every element, in document order."""
    depth = objects = 0
    last: dict[int, tuple[int, str]] = {}
    for node, token in enumerate(_TOKEN.finditer(xml)):
        head = token[1]
        if head is None:
            continue
        tag = _NAME.match(head)[1]
        step = -1 if head.startswith("</") else 0 if head.endswith("/>") else 1
        alone = step == 0  # opens and closes at once
        depth += step
        objects += step if tag == "object" else 0
        if step < 0:
            continue
        at = depth + alone
        parent, parent_tag = last.get(at - 1, (None, None))
        last[at] = (node, tag)
        yield node, parent, parent_tag, tag, at, objects + (alone and tag == "object"), None if alone else text_of(token[2])


def _objects_of(xml: str) -> list[dict] | None:
    """The objects of a text in document order; None without any."""
    found: dict[int, tuple[int, dict, dict]] = {}  # by node: depth, name and box, attributes by node
    around: dict[int, int] = {}
    for node, parent, parent_tag, tag, depth, objects, text in _walked(xml):
        if tag == "object":
            if objects > 0:
                around[objects] = node
                found[node] = (depth, {}, {})
        elif parent_tag == "attribute" and tag in ("name", "value"):
            for level in range(1, objects + 1):  # the first child of a name counts, also without text
                if level in around:
                    found[around[level]][2].setdefault(parent, {}).setdefault(tag, text)
        elif parent is not None and objects in around:
            above, own, _ = found[around[objects]]
            if tag == "name" and depth == above + 1 or tag in COORDS and parent_tag == "bndbox" and depth == above + 2:
                own.setdefault(tag, text)
    return [{"name": own.get("name"), "bndbox": {c: own.get(c) for c in COORDS} if any(c in own for c in COORDS) else None,
             "attributes": {"attribute": [{"name": a.get("name"), "value": a.get("value")} for _, a in sorted(attributes.items())]},
             "attribute": []} for _, (_, own, attributes) in sorted(found.items())] or None


def _per_text(rows, fields: str):
    """A column function of XML texts, one value of type ``fields`` for each."""
    kind = _arrow(fields)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else rows(t.decode("utf-8", "replace")) for t in texts.to_pylist()], kind)

    # not to be repeated in filters that the optimizer derives and pushes below a repartition
    return lambda text: F.arrow_udf(run, fields).asNondeterministic()(text.cast("binary"))


def _arrow(fields: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType
    return to_arrow_type(DataType.fromDDL(fields))


def object_list(xml: Column) -> Column:
    """Every ``object`` element of a text in document order as struct<name, bndbox,
    attributes, attribute>; its name and box are those of its own children (the first of
    several), its attributes all those inside it. Null without objects."""
    return _per_text(_objects_of, _OBJECTS)(xml)


def elements(df: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """One row per element, in document order of ``node``: ``id_col``, node, parent, parent_tag,
    tag, depth (the root's is 1), objects (number of ``object`` elements it stands in, itself
    included) and text (up to its first child; null without)."""
    names = ("node", "parent", "parent_tag", "tag", "depth", "objects", "text")
    listed = _per_text(lambda xml: [dict(zip(names, e)) for e in _walked(xml)], _ELEMENTS)(F.col(xml_col))
    return df.select(id_col, F.inline(listed))


def objects(df: DataFrame, id_col: str, xml_col: str) -> DataFrame:
    """``id_col`` and ``objects`` (see ``object_list``) of the texts that have any."""
    return df.select(id_col, object_list(F.col(xml_col)).alias("objects")).where("objects is not null")
