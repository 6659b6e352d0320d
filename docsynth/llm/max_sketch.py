"""Ranked lexical search with hashed max-sketches.

Every document's impacts (one per term, growing with the term's frequency, falling
with the document's length) fold into a vector: a term's hashes name ``HASHES``
coordinates, and a coordinate holds the largest impact folded into it. The least of a
term's coordinates is never below its impact, so the weighted sum of such lookups over
an item's terms bounds the document's score for the item. All items look up all
documents of a slice at once; then each item takes the documents by falling bound and
rescores them on their words, until the bound is below its ``k``-th best score so far.
The tasks' best rows of each item are ranked together.

The vector is as wide as the document's distinct terms ask for (``WIDTH`` times their
number), so a very long text is bounded as tightly as a short one. Vectors live only
while their slice of texts is searched.

Items are held by the tasks in parts of at most ``PART_BYTES`` of text (or one item);
each part's answer is written to the checkpoint folder before the next part begins.

Rules for odd rows: texts that are null or without terms neither count nor rank; items
without terms have no answer; each row is a document of its own (rows of one doc_id
rank one by one) and each row of the items an item of its own; rows without doc_id rank
after others of their score; an empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsynth.operators.ranking import running_total

from .common import _WORD_TABLE, checkpointed, slices, words

TOP = 20
#: Bytes of item text that a task holds at once.
PART_BYTES = 4 << 20
#: Coordinates of a sketch for each distinct term, and the coordinates that a term is folded into.
WIDTH, HASHES = 8, 2
#: Impacts are folded in steps of this size, rounded up.
STEP = 16
#: Bytes of text searched at once; entries of the lookup table held at once.
SLICE_BYTES, LOOKUPS = 1 << 20, 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 25 + (25 * n * n_docs) // n_terms


def impact(tf, norm):
    """Of numbers or arrays; grows with ``tf`` and stays below 1,000,000."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


# ---- hashes of terms ----

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.cumprod(np.full(n, _BASE, np.uint64)), np.cumprod(np.full(n, _INVERSE, np.uint64)))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class TermHashes:
    """64-bit hashes of all terms of a byte string, by prefix sums of a polynomial."""

    def __init__(self):
        self.up, self.down = _powers(1 << 12)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start of each term, its hash)."""
        data = data.translate(_WORD_TABLE)
        if len(data) + 1 > len(self.up):
            self.up, self.down = _powers(2 * len(data))
        chars = np.frombuffer(data, np.uint8)
        edge = np.diff(np.concatenate(([False], chars != 0x20, [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * self.up[:len(chars)], out=sums[1:])
        return start, mixed((sums[end] - sums[start]) * self.down[start])


def coordinates(h: np.ndarray) -> list[np.ndarray]:
    """Coordinates of a term, from the upper 48 bits of its hash, one array for each of
    ``HASHES``; a sketch's width masks them."""
    return [(h >> np.uint64(16 + 24 * i)).astype(np.int64) & 0xFFFFFF for i in range(HASHES)]


# ---- sketches of a slice of texts ----

class Sketches:
    """Sketches of some texts, those of one width together."""

    def __init__(self, texts: list[bytes], hashes: TermHashes, n_docs: int, n_terms: int):
        ends = np.cumsum([len(t) + 1 for t in texts])
        start, h = hashes(b"\n".join(texts))
        doc = np.searchsorted(ends, start, "right")
        self.length = np.bincount(doc, minlength=len(texts))
        # a document's terms: its number above 48 bits of the hash (terms that fall together
        # only raise a bound)
        key, tf = np.unique((doc.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)), return_counts=True)
        doc = (key >> np.uint64(48)).astype(np.int64)
        norm = 100 - 25 + (25 * self.length * n_docs) // max(1, n_terms)
        folded = -(-impact(tf.astype(np.int64), norm[doc]) // STEP)
        distinct = np.maximum(8, np.bincount(doc, minlength=len(texts)))
        width = 1 << np.ceil(np.log2(WIDTH * distinct)).astype(np.int64)
        order = np.argsort(width, kind="stable")
        offset = np.zeros(len(texts), np.int64)
        offset[order] = np.cumsum(width[order]) - width[order]
        self.cells = np.zeros(int(width.sum()), np.uint16)
        for c in coordinates(key << np.uint64(16)):
            np.maximum.at(self.cells, offset[doc] + (c & (width[doc] - 1)), folded.astype(np.uint16))
        self.groups = [(int(w), order[width[order] == w]) for w in np.unique(width)]
        self.offset = offset

    def bounds(self, queries: "Queries"):
        """Per some documents: (their numbers, documents x items upper bounds; 0 without terms)."""
        step = max(1, LOOKUPS // max(1, len(queries.term)))
        for width, docs in self.groups:
            for i in range(0, len(docs), step):
                some = docs[i:i + step]
                first = int(self.offset[some[0]])
                table = self.cells[first:first + width * len(some)].reshape(len(some), width)
                looked = reduce(np.minimum, (table[:, c & (width - 1)] for c in queries.coordinates))
                weighted = looked * queries.weight  # of int64
                yield some, np.add.reduceat(weighted, queries.start, axis=1) * STEP


class Queries:
    """The items of a part as flat arrays over their distinct terms."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], n_docs: int):
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for item in items for t in item}))}
        names = list(self.vocabulary)
        hashes = TermHashes()
        hashed = np.concatenate([hashes(t)[1] for t in names])
        term, weights, start = [], [], []
        for item in items:
            start.append(len(term))
            for t, n in Counter(item).items():
                term.append(self.vocabulary[t])
                # a term of no document weighs nothing: its impact is nought everywhere
                weights.append(n * weight(n_docs, df[t]) if t in df else 0)
        self.term, self.weight, self.start = np.array(term), np.array(weights, np.int64), np.array(start)
        self.coordinates = coordinates(hashed[self.term])

    def scores(self, text: bytes, norm: int) -> np.ndarray:
        """Exact scores of a text for all items, from its words."""
        known = self.vocabulary.get
        found = [i for i in map(known, text.translate(_WORD_TABLE).split()) if i is not None]
        tf = np.bincount(np.array(found, np.int64), minlength=len(self.vocabulary))
        return np.add.reduceat(impact(tf, norm)[self.term] * self.weight, self.start)


class Best:
    """The k best (score, doc_id) of each item so far: equal scores by the smaller id, none last."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps, self.least = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def offer(self, item: int, score: int, doc_id):
        heap = self.heaps[item]
        entry = (score, -math.inf if doc_id is None else -doc_id)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[item] = max(1, heap[0][0])


def searched(texts: list[bytes], ids: list, sketches: Sketches, queries: Queries, best: Best, n_docs: int, n_terms: int):
    """Offer every document that a bound lets through to the items' best lists."""
    exact: dict[int, np.ndarray] = {}
    for docs, bounds in sketches.bounds(queries):
        for item in np.flatnonzero((bounds >= best.least).any(axis=0)).tolist():
            column = bounds[:, item]
            for row in np.argsort(-column, kind="stable").tolist():
                if column[row] < best.least[item]:
                    break
                doc = int(docs[row])
                if doc not in exact:
                    exact[doc] = queries.scores(texts[doc], length_norm(int(sketches.length[doc]), n_docs, n_terms))
                score = int(exact[doc][item])
                if score > 0:
                    best.offer(item, score, ids[doc])
        exact.clear()


# ---- jobs ----

def _term_counts(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """(documents with terms, their terms, document frequency of each term of the vocabulary)."""
    def run(batches):
        df, n_docs, n_terms = Counter(), 0, 0
        for batch in batches:
            for piece in slices(batch, 0, SLICE_BYTES):
                for text in piece.column(0).to_pylist():
                    found = words(text)
                    n_docs += bool(found)
                    n_terms += len(found)
                    df.update(vocabulary.intersection(found))
        terms = list(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] + terms, pa.binary()), pa.array([n_docs] + [df[t] for t in terms], pa.int64()),
             pa.array([n_terms] + [0] * len(terms), pa.int64())], names=["term", "docs", "terms"])

    counted = docs.select("text").mapInArrow(run, "term binary, docs long, terms long")
    rows = counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect()
    totals = next(((r.docs, r.terms) for r in rows if r.term is None), (0, 0))
    return *totals, {bytes(r.term): r.docs for r in rows if r.term is not None}


def _parts(items: DataFrame, part_bytes: int) -> list[DataFrame]:
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= part_bytes:
        return [items]
    before = running_total(items, ["item_id", "text"], F.octet_length("text"), "_sum")
    part = F.floor((F.col("_sum") - F.octet_length("text")) / part_bytes)
    cut = before.select("item_id", "text", part.alias("_part"))
    return [cut.where(F.col("_part") == i).drop("_part") for i in range(-(-total // part_bytes))]


def _best_of_part(docs: DataFrame, items: DataFrame, k: int, part: int) -> DataFrame | None:
    rows = [(r.item_id, words(r.text)) for r in items.collect()]  # at most part_bytes of text, or one item
    rows = [(i, w) for i, w in rows if w]
    if not rows:
        return None
    n_docs, n_terms, df = _term_counts(docs, {t for _, w in rows for t in w})
    if not df:
        return None
    names, queries = [i for i, _ in rows], Queries([w for _, w in rows], df, n_docs)
    item_type = items.schema["item_id"].dataType
    schema = f"item_no long, item_id {item_type.simpleString()}, doc_id long, score long"

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        best, hashes = Best(len(names), k), TermHashes()
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in piece.column(1).to_pylist()]
                sketches = Sketches(texts, hashes, n_docs, n_terms)
                searched(texts, piece.column(0).to_pylist(), sketches, queries, best, n_docs, n_terms)
        out = [(i, names[i], None if d == -math.inf else -d, s) for i, heap in enumerate(best.heaps) for s, d in heap]
        kinds = [pa.int64(), to_arrow_type(item_type), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)],
                                         names=["item_no", "item_id", "doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.lit(part).alias("part"), "item_no", "item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, part_bytes: int = PART_BYTES) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each row of ``items`` (item_id, text):
    item_id, rank (from 1), doc_id, score, and (part, item_no), which name the item's row."""
    items = items.select("item_id", "text").where("text is not null")
    parts = _parts(items, part_bytes)
    found = [_best_of_part(docs, part, k, i) for i, part in enumerate(parts)]
    if len(parts) > 1:  # one part's search ends before the next one's begins
        found = [f if f is None else checkpointed(f) for f in found]
    found = [f for f in found if f is not None]
    if not found:
        schema = f"part int, item_no long, item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def digest(found: DataFrame) -> DataFrame:
    return found.select("item_id", "rank", "doc_id", "score")


ORACLE = """WITH d AS (SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT rn, doc_id, unnest(w) AS term FROM d),
tf AS (SELECT rn, doc_id, term, COUNT(*) AS tf FROM t GROUP BY ALL),
dn AS (SELECT rn, COUNT(*) AS n FROM t GROUP BY rn),
s AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS terms FROM dn),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
i AS (SELECT row_number() OVER () AS ino, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
it AS (SELECT ino, item_id, term, COUNT(*) AS c FROM (SELECT ino, item_id, unnest(w) AS term FROM i) GROUP BY ALL),
w AS (SELECT it.*, CAST(floor(1000 * ln(CAST(2 * s.docs + 2 AS DOUBLE) / CAST(2 * df.df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM it JOIN df USING (term), s),
sc AS (SELECT w.ino, w.item_id, tf.rn, tf.doc_id,
    CAST(SUM(w.c * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + ((25 * dn.n * s.docs) // s.terms))))) AS BIGINT) AS score
  FROM w JOIN tf USING (term) JOIN dn USING (rn), s GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY ino ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""
