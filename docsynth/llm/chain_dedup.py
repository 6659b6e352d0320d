"""Repeated passages by collinear chaining of shared seeds.

Seeds are word k-mers, one minimiser for every ``WINDOW`` consecutive ones, so
two texts share a seed wherever ``K + WINDOW - 1`` words are equal. Each seed is
tied to its first place in the corpus (smallest doc_id, then position), which
keeps links linear in the seeds: a passage of n documents gives n - 1 links.
Per document and partner, seeds are chained in order of both texts with gap
costs through a Fenwick tree of prefix maxima; chains are aligned on the words
(seeds whose words differ are dropped; between seeds, and outward past both ends)
and kept from an identity of 0.75; one below that is cut at its worst gap until its
pieces reach it. The words around a document's chains travel to the partner; an
extension that comes to the end of them is made anew on the whole texts.
A document's aligned spans that touch or overlap form regions; those of at
least ``MIN_WORDS`` words are repeated passages.

The result has one row per passage and partner: doc_id, start and end_ (words),
partner_id (a smaller doc_id) with its start and end, n_equal words and the
identity; first occurrences have no row, and documents without repeats none.

Defined results: null, empty and short texts have no seeds and no rows; rows
without doc_id are left out; rows of equal doc_id are one document's texts, each
chained on its own against other documents and, as a partner, aligned with the
seeds whose words it holds; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, list_array, slices, words

#: Words of a seed, consecutive seeds that share a minimiser, words of a passage, least identity.
K, WINDOW, MIN_WORDS, IDENTITY = 6, 12, 50, 0.75
#: Score of a seed in a chain and cost of each skipped word on either side.
SEED_SCORE, GAP_COST = 6.0, 0.1
#: Words sent along beside a chain; longer extensions are made on the whole texts.
BESIDE = 2 * (K + WINDOW)
#: Bytes of texts that a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20
#: Ids of documents with long extensions that are broadcast at most (8 bytes each); more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_STEPS = np.arange(K)


def word_hashes(text: str | None) -> np.ndarray:
    ws = words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def seeds(hashes: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the minimisers of a text's k-mers (all k-mers' minimum, if fewer than a window)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for j in range(k):
        value = (value ^ hashes[j:j + n]) * _STEP
        value ^= value >> np.uint64(29)
    value = value * _M1
    value ^= value >> np.uint64(32)
    w = min(window, n)
    if w > 1:
        at = np.unique(np.lib.stride_tricks.sliding_window_view(value, w).argmin(1) + np.arange(n - w + 1))
    else:
        at = np.arange(n)
    # in repetitive text one seed value follows itself; every ``window``-th of such a run is kept
    value = value[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (np.diff(at) > w)
    start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    offset = at - at[start]
    keep = new.copy()
    keep[1:] |= (offset[1:] // max(w, 1)) > (offset[:-1] // max(w, 1))
    keep[:-1] |= new[1:]
    keep[-1:] = True
    return value[keep], at[keep]


def chains(x: np.ndarray, y: np.ndarray, score: float = SEED_SCORE, gap: float = GAP_COST) -> list[list[int]]:
    """Chains of seeds (indices, in order): disjoint, of falling score.

    f(j) = score + max(0, max f(i) - gap * skipped words) over i before j in both
    texts; with c = gap * (x + y) the inner maximum is a prefix maximum of
    f(i) + c(i) over y, kept in a Fenwick tree."""
    if len(x) == 1:
        return [[0]]
    order = np.lexsort((-y, x))
    rank = np.searchsorted(np.unique(y), y) + 1
    size = int(rank.max(initial=0))
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    best, before = {}, {}
    xs, ys, rs = x.tolist(), y.tolist(), rank.tolist()
    waiting: list[int] = []
    last_x = None
    for j in order.tolist():
        if xs[j] != last_x:  # seeds of one place in the text do not follow each other
            for i in waiting:
                item, r = (best[i] + gap * (xs[i] + ys[i]), i), rs[i]
                while r <= size:
                    if item[0] > tree[r][0]:
                        tree[r] = item
                    r += r & -r
            waiting, last_x = [], xs[j]
        top, r = (-np.inf, -1), rs[j] - 1
        while r > 0:
            if tree[r][0] > top[0]:
                top = tree[r]
            r -= r & -r
        gain = top[0] - gap * (xs[j] + ys[j])
        best[j], before[j] = (score + gain, top[1]) if gain > 0 else (score, -1)
        waiting.append(j)
    used, out = set(), []
    for j in sorted(best, key=lambda j: (-best[j], j)):
        chain = []
        while j >= 0 and j not in used:
            used.add(j)
            chain.append(j)
            j = before[j]
        if chain:
            out.append(chain[::-1])
    return out


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short word rows."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    x, y = a.tolist(), b.tolist()
    both = set(x) & set(y)  # other words are in no common subsequence
    if len(both) < 2:
        return len(both) and min(x.count(v := both.pop()), y.count(v))
    a, b = np.array([v for v in x if v in both], np.uint64), np.array([v for v in y if v in both], np.uint64)
    row = np.zeros(len(b) + 1, np.int32)
    for v in a:
        step = np.where(b == v, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """Words of both rows and equal words of the best-scoring extension from their start (equal 1, other -2, drop 6),
    and the words of ``a`` that were looked at."""
    i = j = equal = score = 0
    best = (0, 0, 0, 0)
    n, m, size = len(a), len(b), 16
    x, y = a[:size].tolist(), b[:size].tolist()
    while i < n and j < m and score > best[0] - 6:
        if max(i, j) + 3 > size:  # the look-ahead needs three words
            size *= 4
            x, y = a[:size].tolist(), b[:size].tolist()
        if x[i] == y[j]:
            i, j, equal, score = i + 1, j + 1, equal + 1, score + 1
            if score > best[0]:
                best = (score, i, j, equal)
            continue
        for di, dj in ((1, 1), (1, 0), (0, 1)):
            p = x[i + di:i + di + 2]
            if len(p) == 2 and p == y[j + dj:j + dj + 2]:
                i, j = i + di, j + dj
                break
        else:
            i, j = i + 1, j + 1
        score -= 2
    return *best[1:], min(n, i + 3) if j < m else 0


def equal_stretches(xw: np.ndarray, yw: np.ndarray, x: np.ndarray, y: np.ndarray, k: int) -> list[list[int]]:
    """Start and end in both rows of the stretches of equal words that a chain of seeds spans, in order.

    Seeds of one diagonal without an unequal word between them are one stretch; a
    seed that overlaps the stretch before it on another diagonal is left out."""
    runs: list[list[int]] = []
    turns = [0, *(np.flatnonzero(np.diff(y - x)) + 1).tolist(), len(x)]
    for a, e in zip(turns, turns[1:]):
        lo, hi, shift = int(x[a]), int(x[e - 1]) + k, int(y[a] - x[a])
        bad = np.flatnonzero(xw[lo:hi] != yw[lo + shift:hi + shift])
        parts = [a, e]
        if len(bad):
            parts = [a, *(a + 1 + np.flatnonzero(np.diff(np.searchsorted(bad, x[a:e] - lo)))).tolist(), e]
        for f, g in zip(parts, parts[1:]):
            start, end = int(x[f]), int(x[g - 1]) + k
            if runs:
                _, px, _, py = runs[-1]
                if start < px and py - px == shift:
                    runs[-1][1], runs[-1][3] = max(px, end), max(py, end + shift)
                    continue
                if start < px or start + shift < py:
                    f += int(np.searchsorted(x[f:g], max(px, py - shift)))
                    if f == g:
                        continue
                    start = int(x[f])
            runs.append([start, end, start + shift, end + shift])
    return runs


def align(xw: np.ndarray, yw: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = K,
          goes_on: tuple[bool, bool] = (False, False)) -> list[tuple[int, int, int, int, int]] | None:
    """Spans in both word rows and equal words of the pieces of a chain of seeds at x and y that reach the identity.

    Seeds whose words differ are left out. A chain that does not reach the identity,
    with or without its extensions, is cut at its worst gap, and both parts are judged
    anew, extended past their own ends. ``goes_on`` tells on which sides ``xw`` is cut
    out of a longer row; None, if an extension came to such an end."""
    inside = (x + k <= len(xw)) & (y + k <= len(yw))
    x, y = x[inside], y[inside]
    same = (xw[x[:, None] + _STEPS[:k]] == yw[y[:, None] + _STEPS[:k]]).all(1)
    x, y = x[same], y[same]
    if not len(x):
        return []
    runs = equal_stretches(xw, yw, x, y, k)
    gaps = [(common_words(xw[a[1]:b[0]], yw[a[3]:b[2]]), max(b[0] - a[1], b[2] - a[3])) for a, b in zip(runs, runs[1:])]
    loss = [IDENTITY * size - equal for equal, size in gaps]
    upto = list(accumulate((r[1] - r[0] for r in runs), initial=0))
    between = list(accumulate((equal for equal, _ in gaps), initial=0))
    out, waiting = [], [(0, len(runs))]
    while waiting:
        lo, hi = waiting.pop()
        (ax, _, ay, _), (_, px, _, py) = runs[lo], runs[hi - 1]
        equal = upto[hi] - upto[lo] + between[hi - 1] - between[lo]
        left, right, none = extend(xw[:ax][::-1], yw[:ay][::-1]), extend(xw[px:], yw[py:]), (0, 0, 0, 0)
        if (goes_on[0] and left[3] >= ax) or (goes_on[1] and right[3] >= len(xw) - px):
            return None
        tried = [(ax - a[0], px + b[0], ay - a[1], py + b[1], equal + a[2] + b[2]) for a in (left, none) for b in (right, none)]
        good = [t for t in tried if t[4] >= IDENTITY * max(t[1] - t[0], t[3] - t[2])]
        if good:
            out.append(max(good, key=lambda t: t[1] - t[0]))
        elif hi - lo > 1:
            cut = 1 + max(range(lo, hi - 1), key=loss.__getitem__)
            waiting += [(cut, hi), (lo, cut)]
    return out


_SEEDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("seed", T.ArrayType(T.LongType())), T.StructField("place", T.ArrayType(T.IntegerType()))])
_PLACES = T.ArrayType(T.ArrayType(T.IntegerType()))
_CHAINS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("partner_id", T.LongType()), T.StructField("x", _PLACES), T.StructField("y", _PLACES),
                        T.StructField("cuts", T.ArrayType(T.IntegerType())), T.StructField("near", T.BinaryType()), T.StructField("n_words", T.IntegerType())])
_SPANS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "end_", "partner_id", "partner_start", "partner_end", "n_equal")]
                      + [T.StructField("x", T.ArrayType(T.IntegerType())), T.StructField("y", T.ArrayType(T.IntegerType()))])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(cols, schema)], names=schema.names)


def seed_rows(docs: DataFrame, bits: int) -> DataFrame:
    """seed (its upper ``bits`` bits), doc_id and place of every document's minimisers (docs: doc_id, text).

    They are found once and kept in the shared folder, as two uses shuffle them: minima of seeds, added up before
    their shuffle, and the join, whose large partitions can be split."""
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            found = [seeds(word_hashes(t)) for t in b.column(1).to_pylist()]
            value, place = (np.concatenate(c) for c in zip(*found))
            sizes = np.array([len(p) for _, p in found], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), list_array((value >> shift).astype(np.int64), sizes, pa.int64()),
                                              list_array(place.astype(np.int32), sizes, pa.int32())], names=_SEEDS.names)

    kept = checkpointed(docs.mapInArrow(run, _SEEDS))
    return kept.select("doc_id", F.explode(F.arrays_zip("seed", "place")).alias("s")).select("s.seed", "doc_id", "s.place")


def _windows(found: list[np.ndarray], n: int) -> list[tuple[int, int]]:
    """Disjoint stretches of a text of n words around its chains (their places, each)."""
    out: list[tuple[int, int]] = []
    for a, e in sorted((max(0, int(c[0]) - BESIDE), min(n, int(c[-1]) + K + BESIDE)) for c in found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((a, e))
    return out


def _chained(bits: int):
    """Chains of each document and partner with the words around them (input: doc_id, text, links, twice)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            out, held = [], 0
            for doc, text, links, twice in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                place, partner, at, seed = (links.values.field(i).to_numpy() for i in range(4))
                hashes = word_hashes(text)
                if twice:  # the seeds of this text only
                    value, where = seeds(hashes)
                    own = np.zeros(max(len(hashes), int(place.max()) + 1), np.int64) - 1
                    own[where] = (value >> np.uint64(64 - bits)).astype(np.int64)
                    mine = own[place] == seed
                    place, partner, at = place[mine], partner[mine], at[mine]
                order = np.argsort(partner, kind="stable")
                ids, starts = np.unique(partner[order], return_index=True)
                for p, which in zip(ids.tolist(), np.split(order, starts[1:])):
                    x, y = place[which].astype(np.int64), at[which].astype(np.int64)
                    found = chains(x, y)
                    cuts = _windows([x[c] for c in found], len(hashes))
                    near = b"".join(hashes[a:e].tobytes() for a, e in cuts)
                    out.append((doc, p, [x[c].tolist() for c in found], [y[c].tolist() for c in found], [v for cut in cuts for v in cut], near, len(hashes)))
                    held += len(near)
                    if held > SLICE_BYTES:
                        yield _batch(out, _CHAINS)
                        out, held = [], 0
            yield _batch(out, _CHAINS)

    return run


def _aligned(batches: Iterator[pa.RecordBatch]):
    """Spans of the pieces of chains (joined with their partner's text) that reach the identity;
    chains whose extension comes to the end of the words sent along keep their places instead."""
    for b in (part for whole in batches for part in slices(whole, 7, SLICE_BYTES)):
        out, known = [], (None, None)
        for doc, partner, xs, ys, cuts, near, n, text in zip(*[c.to_pylist() for c in b.columns]):
            if known[0] != text:
                known = (text, word_hashes(text))
            words_, edges = np.frombuffer(near, np.uint64), np.array(cuts).reshape(-1, 2)
            upto = np.cumsum([0, *(edges[:, 1] - edges[:, 0])])
            for x, y in zip(xs, ys):
                w = int(np.searchsorted(edges[:, 0], x[0], "right")) - 1
                a, e = edges[w].tolist()
                found = align(words_[upto[w]:upto[w + 1]], known[1], np.array(x, np.int64) - a, np.array(y, np.int64), goes_on=(a > 0, e < n))
                if found is None:
                    out.append((doc, None, None, partner, None, None, None, x, y))
                else:
                    out += [(doc, a + x0, a + x1, partner, y0, y1, equal, None, None) for x0, x1, y0, y1, equal in found]
        yield _batch(out, _SPANS)


def _aligned_whole(batches: Iterator[pa.RecordBatch]):
    """The same for chains joined with both whole texts (input: doc_id, partner_id, x, y, own, text)."""
    for b in (part for whole in batches for piece in slices(whole, 4, SLICE_BYTES) for part in slices(piece, 5, SLICE_BYTES)):
        out = []
        for doc, partner, x, y, own, text in zip(*[c.to_pylist() for c in b.columns]):
            found = align(word_hashes(own), word_hashes(text), np.array(x, np.int64), np.array(y, np.int64))
            out += [(doc, x0, x1, partner, y0, y1, equal, None, None) for x0, x1, y0, y1, equal in found]
        yield _batch(out, _SPANS)


def _long_extensions(whole: DataFrame, open_: DataFrame) -> DataFrame:
    """Spans of the chains that need the whole texts (a small part of the documents' texts moves)."""
    ids = open_.select("doc_id").union(open_.select("partner_id")).distinct()
    texts = whole.join(F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids, "doc_id", "left_semi")
    own = texts.select("doc_id", F.col("text").alias("own"))
    other = texts.select(F.col("doc_id").alias("partner_id"), "text")
    met = open_.join(own, "doc_id").join(other, "partner_id")
    return met.select("doc_id", "partner_id", "x", "y", "own", "text").mapInArrow(_aligned_whole, _SPANS)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of at least ``min_words`` words that stand in a document of smaller doc_id, too."""
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    # so many bits that one seed in some thousands meets another's by chance; alignment drops it
    n_bytes = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(63, max(16, int(n_bytes).bit_length() + 8))
    placed = seed_rows(whole, bits)
    first = (placed.groupBy("seed").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("last"))
             .where("first.doc_id < last").select("seed", F.col("first.doc_id").alias("partner_id"), F.col("first.place").alias("at")))
    links = placed.join(first, "seed").where("doc_id > partner_id")
    gathered = links.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "partner_id", "at", "seed"))).alias("links"))  # a document's own seeds
    twice = whole.groupBy("doc_id").agg((F.min(F.xxhash64("text")) < F.max(F.xxhash64("text"))).alias("twice"))
    chained = whole.join(gathered.join(twice, "doc_id"), "doc_id").select("doc_id", "text", "links", "twice").mapInArrow(_chained(bits), _CHAINS)
    # the partners' texts come by doc_id, too: both joins read one shuffle of the texts
    asked = chained.withColumnsRenamed({"doc_id": "asker", "partner_id": "doc_id"})
    found = checkpointed(asked.join(whole, "doc_id").select("asker", "doc_id", "x", "y", "cuts", "near", "n_words", "text").mapInArrow(_aligned, _SPANS))
    done, open_ = found.where("x is null").drop("x", "y"), found.where("x is not null").select("doc_id", "partner_id", "x", "y")
    spans = done if open_.isEmpty() else done.union(_long_extensions(whole, open_).drop("x", "y"))
    # a span inside another one with the same partner says nothing more
    longer = F.max("end_").over(Window.partitionBy("doc_id", "partner_id").orderBy("start", F.desc("end_"), "partner_start").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.distinct().withColumn("longer", longer).where("longer is null or longer < end_").drop("longer")
    upto = F.max("end_").over(Window.partitionBy("doc_id").orderBy("start", "end_", "partner_id", "partner_start").rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.withColumn("fresh", F.when(upto >= F.col("start"), 0).otherwise(1))
    region = F.sum("fresh").over(Window.partitionBy("doc_id").orderBy("start", "end_", "partner_id", "partner_start"))
    of_region = Window.partitionBy("doc_id", "region")
    sized = (cut.withColumn("region", region).withColumn("size", F.max("end_").over(of_region) - F.min("start").over(of_region)))
    return (sized.where(F.col("size") >= min_words)
            .select("doc_id", "start", "end_", "partner_id", "partner_start", "partner_end", "n_equal",
                    (F.col("n_equal") / F.greatest(F.col("end_") - F.col("start"), F.col("partner_end") - F.col("partner_start"))).alias("identity")))
