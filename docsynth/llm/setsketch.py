"""MinHash near-duplicates with SetSketch registers.

A document's set is its distinct five-word shingles. Each shingle draws an
ascending series of exponentially spaced points, each dealt to a random
register; a register keeps its smallest point, truncated to a logarithmic grid
(base ``BASE``), so sketches merge by the register-wise maximum of the grid
values and registers of similar sets are equal about as often as the sets are
alike. Bands of register values propose pairs; the joint estimate from the
registers (maximum likelihood over both sets' sizes and their overlap) drops
pairs far below the threshold, and the rest is confirmed on the full sets.

Pairs are kept few without losing links: documents of equal sets are one class
from the start; in each band bucket every class is first held against the
bucket's most central one (that with the most mates over all bands). Classes of
buckets that then still hold several components are held against each other by
an exact prefix filter on their rarest shingles. Components grow by smallest-label rounds over
checkpoints. Only counts reach the driver.

Defined results: null, empty and wordless texts have an empty set, no links and
are kept; texts of fewer words are one shingle; rows with equal doc_id are one
document per id for the components (their sets are linked through the id) and
each row is returned; a null doc_id is linked with nothing and returned with a
null component; extra columns are left out of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, checkpointed, list_array, map_columns, tokens

SHINGLE = 5
#: Registers, registers of a band, base and shift of the grid (values fit 16 bits).
REGISTERS, BAND, BASE, SHIFT = 160, 4, 1.001, 20.0
TOP = 65534
#: Links: THRESHOLD[0] * intersection >= THRESHOLD[1] * union.
THRESHOLD = (100, 75)
#: Pairs whose estimate is so far below the threshold are not confirmed (over five standard deviations).
MARGIN = 0.2
#: Shingles sketched at a time in a task.
SKETCH_ELEMENTS = 400_000
#: Edges of a task in the rounds of ``components``.
EDGE_ROWS = 100_000
#: Ids up to which they are sent to the texts (16 bytes each); more are joined by a shuffle of the texts.
SENT_IDS = 1_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = tokens(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(size, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out = mix(out * _STEP + h[j:n - k + 1 + j])
    return np.unique(out)


def _drawn(owner, state, at, registers):
    """Each element's next point and its register."""
    state = mix(state + _STEP)
    at = at - np.log1p(-((state >> np.uint64(11)).astype(np.float64) * 2.0 ** -53)) / registers
    slot = owner * registers + (mix(state ^ _M1) % np.uint64(registers)).astype(np.int64)
    return owner, state, at, slot


def sketch(elements: np.ndarray, lengths: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Register values of sets (rows), from their concatenated elements; 0 for empty sets.

    Points are drawn up to a horizon at which a set's registers are nearly all
    hit; sets with an empty register draw on to a larger one, so values are exact."""
    docs = len(lengths)
    low = np.full(docs * registers, np.inf)
    horizon = (np.log(registers) + 2.0) / np.maximum(lengths, 1)
    points = _drawn(np.repeat(np.arange(docs), lengths), mix(elements + _M2), np.zeros(len(elements)), registers)
    while len(points[0]):
        due = points[2] <= horizon[points[0]]
        parked, points = [tuple(x[~due] for x in points)], tuple(x[due] for x in points)
        while len(points[0]):
            np.minimum.at(low, points[3], points[2])
            points = _drawn(*points[:3], registers)
            due = points[2] <= horizon[points[0]]
            parked.append(tuple(x[~due] for x in points))
            points = tuple(x[due] for x in points)
        unfilled = np.isinf(low.reshape(docs, registers)).any(1)
        horizon = np.where(unfilled, horizon * 2, horizon)
        points = tuple(np.concatenate(x) for x in zip(*parked))
        points = tuple(x[unfilled[points[0]]] for x in points) if unfilled.any() else ((),)
    low = low.reshape(docs, registers)
    with np.errstate(divide="ignore"):
        grid = np.floor(1.0 - np.log(low / SHIFT) / np.log(BASE))
    return np.where(np.isinf(low), 0, np.clip(grid, 1, TOP)).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 100) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs (rows) of sets of known size."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1 - u
    reach = np.minimum(u / v, v / u)[:, None] * np.linspace(0, 1, steps + 1)[None, :]

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = p(u[:, None] - v[:, None] * reach), p(v[:, None] - u[:, None] * reach)
    with np.errstate(divide="ignore", invalid="ignore"):
        def term(count, prob):
            return np.where(count[:, None] > 0, count[:, None] * np.log(np.maximum(prob, 1e-300)), 0.0)

        value = term(above, more) + term(below, less) + term(equal, 1 - more - less)
    return reach[np.arange(len(reach)), value.argmax(1)]


def alike(shared: int, size_a: int, size_b: int) -> bool:
    return THRESHOLD[0] * shared >= THRESHOLD[1] * (size_a + size_b - shared)


def _sketched(texts: list) -> dict:
    sets = [shingles(t) for t in texts]
    lengths = np.array([len(s) for s in sets], np.int64)
    rows, a = [], 0
    while a < len(sets):
        b, total = a, 0
        while b < len(sets) and (b == a or total + lengths[b] <= SKETCH_ELEMENTS):
            total += lengths[b]
            b += 1
        rows.append(sketch(np.concatenate(sets[a:b]), lengths[a:b]))
        a = b
    return {"n": lengths.tolist(), "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "sketch": [x.tobytes() for m in rows for x in m]}


#: Rows of an Arrow batch shingled at a time.
SLICE_ROWS = 500


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (shingles), set_key (128-bit hash of the set; null if empty) and sketch of every document."""

    def run(batches):
        for batch in batches:
            parts = [_sketched(batch["text"][i:i + SLICE_ROWS]) for i in range(0, len(batch["text"]), SLICE_ROWS)]
            yield {c: [x for part in parts for x in part[c]] for c in ("n", "set_key", "sketch")}

    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_columns(frame, run, ["text"], [("n", T.LongType()), ("set_key", T.BinaryType()), ("sketch", T.BinaryType())], keep=["doc_id"], slice_bytes=SLICE_BYTES)


def _close_sizes(a, b) -> F.Column:
    """Sizes of which a link is possible."""
    return THRESHOLD[0] * F.least(a, b) >= THRESHOLD[1] * F.greatest(a, b)


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose joint estimate does not rule a link out."""
    floor = THRESHOLD[1] / THRESHOLD[0] - MARGIN

    def side(c):
        return classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))

    def run(batches):
        for batch in batches:
            if not batch["s_a"]:
                yield {"estimate": []}
                continue
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch[c]), -1) for c in ("s_a", "s_b"))
            yield {"estimate": joint_estimate(a, b, np.array(batch["n_a"], float), np.array(batch["n_b"], float)).tolist()}

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_close_sizes(F.col("n_a"), F.col("n_b")))
    out = map_columns(both, run, ["s_a", "s_b", "n_a", "n_b"], [("estimate", T.DoubleType())], keep=["a", "b"])
    return out.where(F.col("estimate") >= floor)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that are links by their full sets (``sets``: id, elements)."""

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch["e_a"], batch["e_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                out.append(alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield {"link": out}

    def side(c):
        return sets.select(F.col("id").alias(c), F.col("elements").alias(f"e_{c}"))

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return map_columns(both, run, ["e_a", "e_b"], [("link", T.BooleanType())], keep=["a", "b"]).where("link").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every end of the edges (a, b).

    Alternates large-star and small-star rounds until the edges no longer change:
    every end is then tied to its component's smallest id. Minima are aggregated
    before the shuffle; only counts and a checksum reach the driver. What is
    shuffled lies in tasks of ``EDGE_ROWS`` edges, so that few edges make few files."""

    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    def minima(e):
        return e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    edges = checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    tasks = before[0] // EDGE_ROWS + 1
    edges = edges.coalesce(tasks)
    while before[0]:
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")
        large = both.join(minima(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # m <= a < b
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        joined = large.join(minima(large), "a").coalesce(tasks)
        small = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x")).select("x.*")
        edges = checkpointed(small.where("a != b").distinct().coalesce(tasks))
        now = state(edges)
        if now == before:
            break
        before = now
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    base = checkpointed(sketches(docs, doc_id, text))
    filled = base.where("set_key is not null and doc_id is not null")
    firsts = filled.groupBy("set_key").agg(F.min("doc_id").alias("id"))
    classes = checkpointed(filled.groupBy("set_key").agg(F.min(F.struct("doc_id", "n", "sketch")).alias("x"))
                           .select(F.col("x.doc_id").alias("id"), "x.n", "x.sketch"))
    bands = REGISTERS // BAND
    key = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(F.substring("sketch", i * 2 * BAND + 1, F.lit(2 * BAND)), i))
    rows = classes.select(F.explode(key).alias("band"), "id", "n")
    shared_bands = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    mates = checkpointed(rows.join(shared_bands, "band"))  # members of buckets of two and more classes
    popular = mates.groupBy("id").agg(F.sum("size").alias("fame"))  # the most central of a group meets the most mates
    sets = checkpointed(_full_sets(docs, popular.select("id"), doc_id, text))
    close = checkpointed(classes.join(popular, "id"))

    lead = mates.join(popular, "id").groupBy("band").agg(F.max(F.struct("fame", (-F.col("id")).alias("minus"))).alias("x")).select("band", (-F.col("x.minus")).alias("lead"))
    star = mates.join(lead, "band").where("id != lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    links = checkpointed(confirmed(estimated(star, close), sets))
    more = confirmed(rare_pairs(_open_classes(mates, links), sets), sets)

    members = filled.select("doc_id", "set_key").join(firsts, "set_key").select("doc_id", "id")
    shared = members.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("doc_id", "lo")
    twice = members.join(shared, "doc_id").select(F.col("lo").alias("a"), F.col("id").alias("b"))
    linked = components(links.union(more).union(twice))
    placed_docs = (base.join(firsts, "set_key", "left").join(linked, "id", "left")
                   .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id")))
    return placed_docs.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _open_classes(mates: DataFrame, links: DataFrame) -> DataFrame:
    """id, n and component of the classes in buckets that hold several components."""
    placed = mates.join(components(links), "id", "left").select("band", "id", "n", F.coalesce("component", "id").alias("component"))
    several = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band")
    return checkpointed(placed.join(several, "band").select("id", "n", "component").distinct())


def rare_pairs(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may be links, complete among ``classes``.

    With shingles in a common order, rarest first, two linked sets share one of the
    first n - ceil(t n) + 1 of each. Shingles of one class alone count for that
    number but are not joined, so copies that differ by edits of their own meet
    only if they are nearly alike."""

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(e, np.int64) for e in batch["elements"]]
            yield {"shingle": list_array(np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(f) for f in found], np.int64), pa.int64())}

    wide = map_columns(sets.join(classes, "id").select("id", "n", "component", "elements"), run, ["elements"], [("shingle", T.ArrayType(T.LongType()))], keep=["id", "n", "component"])
    rows = wide.select("id", "n", "component", F.explode("shingle").alias("shingle"))
    common = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi"))
              .where("df > 1").select("shingle", "df", (F.col("lo") < F.col("hi")).alias("joins")))
    listed = rows.join(common, "shingle").groupBy("id", "n", "component").agg(F.sort_array(F.collect_list(F.struct("df", "shingle", "joins"))).alias("s"))
    least = F.ceil(F.col("n") * THRESHOLD[1] / THRESHOLD[0])
    prefix = F.greatest(F.lit(0), F.col("n") - least + 1 - (F.col("n") - F.size("s"))).cast("int")
    alone = F.col("n") - F.size("s")
    heads = (listed.select("id", "n", "component", alone.alias("alone"), F.posexplode(F.slice("s", F.lit(1), prefix)).alias("i", "x")).where("x.joins")
             .select("id", "n", "component", F.col("x.shingle").alias("shingle"), (F.col("alone") + F.col("i")).alias("before")))
    x, y = (heads.select("shingle", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "n", "component", "before")]) for k in "xy")
    # at the first shared shingle, what is left of both sets holds the whole intersection
    left = F.least(F.col("n_x") - F.col("before_x"), F.col("n_y") - F.col("before_y"))
    enough = left * (THRESHOLD[0] + THRESHOLD[1]) >= THRESHOLD[1] * (F.col("n_x") + F.col("n_y"))
    return (x.join(y, "shingle").where("component_x < component_y").where(enough)
            .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct())


def _full_sets(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id and elements (sorted 64-bit hashes, as bytes) of the documents with these ids."""

    def run(batches):
        for batch in batches:
            yield {"elements": [shingles(t).tobytes() for t in batch["text"]]}

    ids = checkpointed(ids.distinct())
    ids = F.broadcast(ids) if ids.count() <= SENT_IDS else ids  # else every text is shuffled to pick these
    frame = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null").join(ids, "id", "left_semi")
    return map_columns(frame, run, ["text"], [("elements", T.BinaryType())], keep=["id"], slice_bytes=SLICE_BYTES)


#: The same rows in DuckDB: all pairs of full sets that share a shingle, and what is reachable over them.
ORACLE = """WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id,
    COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
g AS (SELECT DISTINCT rn, doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d),
n AS (SELECT rn, COUNT(*) AS n FROM g GROUP BY rn),
p AS (SELECT a.rn AS ra, b.rn AS rb, any_value(a.doc_id) AS x, any_value(b.doc_id) AS y, COUNT(*) AS common
  FROM g a JOIN g b ON a.sh = b.sh AND a.rn < b.rn GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n na ON na.rn = ra JOIN n nb ON nb.rn = rb WHERE 100 * common >= 75 * (na.n + nb.n - common)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.id = e.x WHERE r.c < e.y),
m AS (SELECT id, MIN(c) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n USING (rn) JOIN m ON m.id = d.doc_id"""
