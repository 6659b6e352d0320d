"""Benchmark decontamination with an FM-index per shard of training documents.

Each task cuts its documents into shards of bounded size, maps words to the ids
of the benchmark vocabulary and indexes the shard: suffix array, Burrows-Wheeler
transform, wavelet matrix, sampled suffix positions. Test phrases are found by
backward search through wavelet ranks, located by walking to a sampled suffix
position, and merged into removal spans. Words outside the benchmark's
vocabulary cannot lie in an occurrence, so they are string ends in the index,
and strings shorter than the shortest phrase are not indexed; nothing is lost.
The pass over the documents is narrow: no shuffle.

Defined results: null or wordless texts have no words and no hits; null items
and items without words have no phrases; repeated items count once by id; an
empty benchmark hits nothing; rows with equal ids are judged each on their own;
extra columns are carried along.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, sha_of, words

WINDOW = 13
#: Symbols of one shard's index.
SHARD_SYMBOLS = 1 << 20
#: Every so many positions of a string, the suffix array keeps the position.
SAMPLE = 32
#: UTF-8 bytes of benchmark text searched in one pass; a larger benchmark takes more passes.
PART_BYTES = 4 << 20

SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (0 ends a string; equal strings rank by position).

    A first sort takes several symbols packed in 64 bits; what is still tied is
    doubled. A suffix whose string ends within the compared symbols is resolved."""
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    per = max(1, 63 // bits)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(per):
        shifted = np.zeros(n, np.int64)
        if j < n:
            shifted[:n - j] = text[j:]
        alive &= shifted > 0
        key = (key << bits) | (shifted * alive)
    sa = np.argsort(key, kind="stable")
    tied = alive[sa]  # the compared symbols hold no string end
    head = np.ones(n, bool)
    head[1:] = (key[sa[1:]] != key[sa[:-1]]) | ~tied[1:]
    rank, h = np.empty(n, np.int64), per
    starts = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = starts
    while True:
        lone = head.copy()
        lone[:-1] &= head[1:]
        slots = np.flatnonzero(~lone)  # members of groups of two and more
        if not len(slots):
            return sa
        pos = sa[slots]
        group, after = rank[pos], rank[pos + h]
        order = np.lexsort((pos, after, group))
        pos, group, after = pos[order], group[order], after[order]
        sa[slots] = pos
        new = np.ones(len(slots), bool)
        new[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        head[slots] = new
        starts = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[pos] = starts[slots]
        h *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit level after another."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels, cur = [], seq
        for level in range(bits - 1, -1, -1):
            bit = (cur >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(seq) - int(ones[-1])
            self.levels.append((level, ones, zeros))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        lo, hi = np.zeros(len(symbols), np.int64), ends.astype(np.int64)
        for level, ones, zeros in self.levels:
            one = (symbols >> level) & 1 == 1
            a, b = ones[lo], ones[hi]
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return hi - lo


class FMIndex:
    """FM-index of a text of strings that each end with 0."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        sa = suffix_array(text)
        self.bwt = text[sa - 1]  # before the first string stands the last one's end
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(n_symbols).bit_length()))
        start = np.ones(len(text), bool)
        start[1:] = text[:-1] == 0
        offset = np.arange(len(text)) - np.maximum.accumulate(np.where(start, np.arange(len(text)), 0))
        self.sampled = (offset % SAMPLE == 0)[sa]
        self.nth = np.cumsum(self.sampled) - 1
        self.positions = sa[self.sampled]
        self.n = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that start with each pattern (rows of equal length)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, j]
            lo[live] = self.below[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.below[c] + self.wavelet.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
            if not len(live):
                break
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled one, then add the steps."""
        out, todo, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            found = self.sampled[at]
            out[todo[found]] = self.positions[self.nth[at[found]]] + steps
            todo, at = todo[~found], at[~found]
            c = self.bwt[at]
            at = self.below[c] + self.wavelet.rank(c, at)
            steps += 1
        return out


class Phrases:
    """Test phrases of one part of the benchmark, as symbol rows by length."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, ws in items:
            symbols = [self.ids.setdefault(w, len(self.ids) + 1) for w in ws]
            size = min(window, len(symbols))
            for i in range(len(symbols) - size + 1 if size else 0):
                owners.setdefault(tuple(symbols[i:i + size]), set()).add(item)
        self.by_length: list[tuple[int, np.ndarray, list[list]]] = []
        for size in sorted({len(k) for k in owners}):
            keys = [k for k in owners if len(k) == size]
            self.by_length.append((size, np.array(keys, np.int64), [sorted(i for i in owners[k] if i is not None) for k in keys]))
        self.shortest = self.by_length[0][0] if self.by_length else 0


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans covered by the given ones (touching spans join)."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def search_shard(parts: list[np.ndarray], origins: list[tuple[int, np.ndarray]], phrases: Phrases):
    """Index strings of a shard and search all phrases.

    ``parts``: symbols of each document's kept strings, each string with its end;
    ``origins``: its row and the word positions of these symbols. Yields (row, spans, items)."""
    text = np.concatenate(parts)
    row = np.repeat([r for r, _ in origins], [len(p) for p in parts])
    at_word = np.concatenate([w for _, w in origins])
    index = FMIndex(text, len(phrases.ids))
    cover = np.zeros(len(text) + 1, np.int32)
    items: dict[int, set] = {}
    for size, patterns, owners in phrases.by_length:
        lo, hi = index.search(patterns)
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            continue
        count = (hi - lo)[hit]
        which = np.repeat(hit, count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[hit], count)
        pos = index.locate(rows)
        np.add.at(cover, pos, 1)
        np.add.at(cover, pos + size, -1)
        for r, w in np.unique(np.stack([row[pos], which], 1), axis=0):
            items.setdefault(int(r), set()).update(owners[w])
    covered = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]])
    edge = np.diff(covered)
    spans: dict[int, list] = {}
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        spans.setdefault(int(row[a]), []).append((int(at_word[a]), int(at_word[b - 1]) + 1))
    for r in spans:
        yield r, spans[r], items.get(r, set())


def _pass(phrases: Phrases, shard_symbols: int):
    """The task side of one pass: adds what this part's phrases hit to the state columns."""

    def run(batches):
        for batch in batches:
            state = [([tuple(s.values()) for s in sp or []], set(it or [])) for sp, it in zip(batch["_spans"], batch["_items"])]
            count, parts, origins, size = [], [], [], 0

            def flush():
                for r, spans, items in search_shard(parts, origins, phrases):
                    state[r] = (merged(state[r][0] + spans), state[r][1] | items)

            get = phrases.ids.get
            for r, text in enumerate(batch["_text"]):
                ws = words(text)
                count.append(len(ws))
                ids = np.fromiter((get(w, 0) for w in ws), np.int64, len(ws))
                known = np.concatenate([[0], (ids > 0).astype(np.int8), [0]])
                edge = np.diff(known)
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                long = (b - a >= phrases.shortest) & bool(phrases.shortest)
                if not long.any():
                    continue
                keep = np.concatenate([np.arange(x, y + 1) for x, y in zip(a[long], b[long])])
                parts.append(np.append(ids, 0)[keep])
                origins.append((r, keep))
                size += len(keep)
                if size >= shard_symbols:
                    flush()
                    parts, origins, size = [], [], 0
            if parts:
                flush()
            yield {"_words": count, "_spans": [[{"start": x, "end": y} for x, y in s] for s, _ in state],
                   "_items": [sorted(i) for _, i in state]}

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES,
                  shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """Documents with ``n_words``, ``hit_spans`` (maximal word spans) and ``hit_items``.

    The benchmark is taken in parts of a checked size (by hash of the item), one
    narrow pass each; each part's phrases travel with the tasks, nothing else does."""
    bench = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct()
    total = bench.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n_parts = max(1, -(-int(total) // part_bytes))
    out = docs.withColumns({"_text": F.col(text), "_words": F.lit(0).cast("long"), "_spans": F.lit(None).cast(T.ArrayType(SPAN)),
                            "_items": F.lit(None).cast("array<string>")})
    for p in range(n_parts):
        part = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_parts)) == p)
        phrases = Phrases([(r.i, words(r.t)) for r in part.collect()], window)
        out = map_columns(out, _pass(phrases, shard_symbols), ["_text", "_spans", "_items"],
                          [("_words", T.LongType()), ("_spans", T.ArrayType(SPAN)), ("_items", T.ArrayType(T.StringType()))])
    return (out.drop("n_words", "hit_spans", "hit_items").withColumnsRenamed({"_words": "n_words", "_spans": "hit_spans", "_items": "hit_items"}).drop("_text"))


def with_verdict(found: DataFrame) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated`` (at least a twentieth of the words hit)."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``contamination``."""
    spans = F.array_join(F.transform("hit_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return with_verdict(found).select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                                      sha_of(F.concat_ws(",", F.array_sort("hit_items"))).alias("items_sha256"), "contaminated", spans.alias("hit_spans"))


#: The same rows in DuckDB: word windows of documents joined with those of the items.
ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS rn, doc_id,
    COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bk AS (SELECT item, w, LEAST(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM bk),
ks AS (SELECT DISTINCT k FROM bw),
pl AS (SELECT rn, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, ks WHERE len(w) >= k),
hit AS (SELECT DISTINCT pl.rn, pl.i, pl.k, bw.item FROM pl JOIN bw ON pl.k = bw.k AND array_to_string(pl.w[pl.i:pl.i + pl.k - 1], ' ') = bw.g),
its AS (SELECT rn, COUNT(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rn, item FROM hit) GROUP BY rn),
pos AS (SELECT DISTINCT rn, unnest(range(i - 1, i + k - 1)) AS p FROM (SELECT DISTINCT rn, i, k FROM hit)),
runs AS (SELECT rn, MIN(p) AS a, MAX(p) + 1 AS e FROM (SELECT rn, p, p - row_number() OVER (PARTITION BY rn ORDER BY p) AS island FROM pos) GROUP BY rn, island),
sp AS (SELECT rn, SUM(e - a) AS n_hit, string_agg(a || ':' || e, ',' ORDER BY a) AS s FROM runs GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, COALESCE(its.n, 0) AS n_items,
    sha256(COALESCE(its.s, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated, COALESCE(sp.s, '') AS hit_spans
FROM d LEFT JOIN sp USING (rn) LEFT JOIN its USING (rn)"""
