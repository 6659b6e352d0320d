"""Collocations by SON partitioning.

Texts are cut into pieces and words; a phrase is two to five words running within a
piece. The table's partitions are dealt to ``SHARDS`` shards, whatever its size, and each
shard is mined completely at a support lowered in proportion: a phrase that stands
``min_count`` times stands ``min_count / SHARDS`` times in one of them at least, wherever
its rows lie. A shard may be larger than any task: its tasks count phrases slice by slice
(``SLICE_BYTES`` of text) and the counts of a shard are summed by its phrases' hashes (two
phrases of one hash only make more candidates). The locally frequent phrases of all shards
whose counts over all shards reach the support are united as bits of a filter of at most ``FILTER_BITS``. Mining goes length by length: a
phrase is looked at only where the phrases without its last and without its first word are
in the filter, for they stand wherever it does.

Then all candidates are counted globally and exactly: every slice counts the phrases that
the filter lets through, numbering words and phrases (nothing rests on hashes), the counts
are summed by the phrases themselves, in the task (``KEPT_PHRASES`` of them at a time) and then
over all tasks, and phrases below ``min_count`` go. A frequent phrase stands in nearly every task, so each
of them sends nearly all candidates; that pass runs in tasks by the cluster's cores, not by the
table's partitions, or its rows would grow with the product of partitions and candidates.

Rules for odd rows: null texts and null languages count as empty texts and ``und``; each
row counts, repeated or not; doc_id and further columns are ignored; an empty table gives
no rows. A text is never cut: a task holds a slice or one text. Ranks are unique: equal
score and count go by the phrase's bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, slices

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: A phrase goes if a longer one around it stands at least this share (in percent) of its times.
ABSORBED = 100
SHARDS = 8
SLICE_BYTES = 32 << 20
#: Phrases whose counts a task of the exact pass holds, and tasks of that pass for each core.
KEPT_PHRASES, CORE_TASKS = 300_000, 2
#: Most bits of the candidates' filter (2**30: 128 MB), and bytes of text for each bit below that.
FILTER_BITS, BYTES_A_BIT = 30, 16
#: Salts that spread a language's candidates.
SALTS = 64

#: Piece ends become line feeds, tabs blanks, A-Z lower case.
_TABLE = bytes(0x0A if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BREAK = b"\n"


class _Numbers(dict):
    """Numbers the words that it is asked for, from 0."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _joined(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase followed by a word."""
    h = phrase + np.uint64(0x9E3779B97F4A7C15) * word
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


class Slice:
    """The words of some texts of one language as numbers; 0 stands between pieces."""

    def __init__(self, lang: str, texts: list[str]):
        numbers, parts = _Numbers({_BREAK: 0}), []
        for text in texts:
            cut = text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(_BREAK, b" \n ").split(b" ")
            parts.append(np.fromiter((numbers[w] for w in cut if w), np.int32))
            parts.append(np.zeros(1, np.int32))
        self.ids = np.concatenate(parts)
        self.words = list(numbers)
        self.n_words = int((self.ids != 0).sum())
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)

    def mined(self, length: int, kept) -> tuple[np.ndarray, np.ndarray]:
        """(hash, count) of all phrases of this length whose parts shorter by one ``kept(hashes)`` lets through."""
        if length == 1:
            return self.hashes[1:], np.bincount(self.ids, minlength=len(self.words))[1:]
        at = np.flatnonzero(self.ids)  # where phrases of the shorter length begin
        of_word = self.hashes[self.ids]
        hashes = of_word[at]
        for n in range(2, length):
            inside = at + n - 1 < len(self.ids)
            at, hashes = at[inside], hashes[inside]
            inside = self.ids[at + n - 1] != 0
            at, hashes = at[inside], hashes[inside]
            hashes = _joined(hashes, of_word[at + n - 1])
        ok = kept(hashes)
        at, hashes = at[ok], hashes[ok]
        pair = np.flatnonzero(np.diff(at) == 1)  # kept here and one word on
        return np.unique(_joined(hashes[pair], of_word[at[pair] + length - 1]), return_counts=True)

    def levels(self, kept, longest: int):
        """Per length: (phrase's number without its last word, last word, count) of the phrases
        that ``kept(hashes)`` lets through; numbers are places in the length before."""
        ids, n_words = self.ids, len(self.words)
        counts = np.bincount(ids, minlength=n_words)
        ok = kept(self.hashes)
        ok[0] = False
        place = np.cumsum(ok) - 1
        alive, phrase = ok[ids], place[ids]
        last = np.flatnonzero(ok)
        hashes = self.hashes[ok]
        yield np.full(len(last), -1), last, counts[ok]
        for length in range(2, longest + 1):
            at = np.flatnonzero(alive[:-1] & alive[1:])
            if not len(at):
                return
            key, inverse, counts = np.unique(phrase[at] * n_words + ids[at + length - 1], return_inverse=True, return_counts=True)
            head, last = key // n_words, key % n_words
            hashes = _joined(hashes[head], self.hashes[last])
            ok = kept(hashes)
            place = np.cumsum(ok) - 1
            there = ok[inverse]
            # a phrase ends before the array does: the last ``length - 1`` words begin none
            alive, phrase = np.zeros(len(alive) - 1, bool), np.zeros(len(alive) - 1, np.int64)
            alive[at[there]] = True
            phrase[at[there]] = place[inverse[there]]
            hashes = hashes[ok]
            yield head[ok], last[ok], counts[ok]


def _slices(batches, limit: int):
    """(language, texts) of every slice of a task's rows."""
    texts, held = {}, 0
    for batch in batches:
        for piece in slices(batch, 1, max(1, limit // 8)):
            held += 64 * piece.num_rows + piece.column(1).nbytes
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            if held >= limit:
                yield from texts.items()
                texts, held = {}, 0
    yield from texts.items()


class Filter:
    """Candidates as bits of their hashes, at most 2 ** ``FILTER_BITS`` of them."""

    def __init__(self, bits: int):
        self.bits, self.table = bits, np.zeros((1 << bits) // 8, np.uint8)

    def add(self, found: DataFrame):
        """Set the bits of the hashes in column ``hash``."""
        # a Spark bitmap holds 32,768 bits, lowest bit of a byte first; bucket 1 begins with number 1
        number = F.shiftrightunsigned("hash", 64 - self.bits) + 1
        found = found.select(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
        maps = found.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
        for r in maps.toLocalIterator():
            self.table[(r.bucket - 1) * 4096:r.bucket * 4096] |= np.frombuffer(r["map"], np.uint8)

    def shared(self, spark):
        """A function for tasks that tells which hashes are in."""
        sent, bits = spark.sparkContext.broadcast(self.table.tobytes()), self.bits

        def kept(hashes):
            table, bit = np.frombuffer(sent.value, np.uint8), hashes >> np.uint64(64 - bits)
            return (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

        return kept


def candidates(rows: DataFrame, min_count: int, longest: int, shards: int, slice_bytes: int) -> Filter:
    """A filter of all phrases that are locally frequent in a shard."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = Filter(min(FILTER_BITS, max(18, math.ceil(math.log2(total / BYTES_A_BIT + 1)))))
    for length in range(1, longest + 1):
        kept = found.shared(rows.sparkSession)

        def mine(batches, length=length, kept=kept):
            shard = TaskContext.get().partitionId() % shards
            for lang, texts in _slices(batches, slice_bytes):
                hashes, counts = Slice(lang, texts).mined(length, kept)
                for i in range(0, len(hashes), 1 << 18):
                    some = hashes[i:i + (1 << 18)].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard, np.int32)), pa.array(some), pa.array(counts[i:i + (1 << 18)])],
                                                     names=["shard", "hash", "n"])

        # any shares of the support that add up to it will do, whatever the shards hold: equal ones
        mined = rows.mapInArrow(mine, "shard int, hash long, n long").repartition("hash")
        local = mined.groupBy("shard", "hash").agg(F.sum("n").alias("n"))
        # a hash's shards lie together, so what all of them hold is known here too: no phrase stands oftener than its hash
        both = local.groupBy("hash").agg(F.max("n").alias("local"), F.sum("n").alias("total"))
        found.add(both.where((F.col("local") * shards >= min_count) & (F.col("total") >= min_count)).select("hash"))
    return found


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST,
                     shards: int = SHARDS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Exact counts: lang, words (1 to ``longest``), phrase, f of every phrase that stands
    ``min_count`` times, and one row per lang with words 0, whose f is its number of words."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    kept = candidates(rows, min_count, longest, shards, slice_bytes).shared(rows.sparkSession)
    tasks = max(shards, CORE_TASKS * rows.sparkSession.sparkContext.defaultParallelism)
    counted = task_counts(rows, kept, longest, slice_bytes, tasks).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return counted.where((F.col("words") == 0) | (F.col("f") >= min_count))


def task_counts(rows: DataFrame, kept, longest: int, slice_bytes: int, tasks: int) -> DataFrame:
    """lang, words, phrase, f of the phrases that ``kept(hashes)`` lets through, counted by at most ``tasks`` tasks."""

    def count(batches):
        totals: dict = {}  # (lang, length): phrase: count
        for lang, texts in _slices(batches, slice_bytes):
            held = Slice(lang, texts)
            _add(totals.setdefault((lang, 0), {}), [b""], [held.n_words])
            before = []
            for length, (head, last, counts) in enumerate(held.levels(kept, longest), 1):
                word = held.words
                if length == 1:
                    before = [word[i] for i in last.tolist()]
                else:
                    before = [before[p] + b" " + word[i] for p, i in zip(head.tolist(), last.tolist())]
                _add(totals.setdefault((lang, length), {}), before, counts.tolist())
                if sum(map(len, totals.values())) > KEPT_PHRASES:
                    yield from _rows(totals)
                    totals = {}
        yield from _rows(totals)

    return rows.coalesce(tasks).mapInArrow(count, "lang string, words int, phrase string, f long")


def _add(total: dict, phrases: list[bytes], counts: list[int]) -> None:
    for phrase, n in zip(phrases, counts):
        total[phrase] = total.get(phrase, 0) + n


def _rows(totals: dict):
    for (lang, length), total in totals.items():
        phrases, counts = [p.decode("utf-8", "surrogatepass") for p in total], list(total.values())
        for i in range(0, len(phrases), 1 << 16):
            n = len(phrases[i:i + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(np.full(n, length, np.int32)), pa.array(phrases[i:i + (1 << 16)], pa.string()),
                                              pa.array(counts[i:i + (1 << 16)], pa.int64())], names=["lang", "words", "phrase", "f"])


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 absorbed: int = ABSORBED, shards: int = SHARDS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent = checkpointed(frequent_phrases(docs, min_count, longest, shards, slice_bytes))
    counts = frequent.where("words > 0").select("lang", "phrase", "f")
    phrases = frequent.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))

    # the longest run around a phrase that is longer by one has the largest count of all around it
    inner = phrases.where("words > 2").select(
        "lang", F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"),
        F.col("a").alias("around"))
    around = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left = phrases.join(around, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {absorbed} * a").drop("around")

    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("_l", F.expr("substring_index(phrase, ' ', k)")).withColumn("_r", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("_l"), F.col("f").alias("l")), ["lang", "_l"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("_r"), F.col("f").alias("r")), ["lang", "_r"])
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("_salt")
    totals = frequent.where("words = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    cuts = cuts.select("*", salt).join(totals, ["lang", "_salt"])
    exact = "CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0)) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
    cuts = cuts.withColumn("score", F.expr(exact).cast("long"))
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", salt)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the first of a language are among the first of its salts, which no task holds all of
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """WITH p AS (SELECT row_number() OVER () AS p, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest(list_transform(range(1, CAST(len(w) - m + 2 AS BIGINT)), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, COUNT(*) AS f FROM g GROUP BY ALL HAVING COUNT(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
o AS (SELECT lang, unnest([array_to_string(list_slice(w, i, i + k - 1), ' ') FOR i IN range(1, CAST(m - k + 2 AS BIGINT))]) AS phrase, a
  FROM c, (SELECT unnest(range(2, 5)) AS k) WHERE k < m),
x AS (SELECT lang, phrase, MAX(a) AS around FROM o GROUP BY ALL),
left_ AS (SELECT c.* FROM c LEFT JOIN x USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a),
k AS (SELECT left_.lang, left_.phrase, left_.a, n.n, k, l.f AS l, r.f AS r,
    CAST(CAST(1000 AS HUGEINT) * a * n.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM left_, (SELECT unnest(range(1, 5)) AS k), n, f l, f r
  WHERE k < left_.m AND n.lang = left_.lang AND l.lang = left_.lang AND r.lang = left_.lang
    AND l.phrase = array_to_string(list_slice(w, 1, k), ' ') AND r.phrase = array_to_string(list_slice(w, k + 1, left_.m), ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM k),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000"""
