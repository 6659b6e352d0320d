"""Suffix-array dedup: bytes covered by 50-byte strings of earlier documents go.

A string of ``LENGTH`` bytes holds ``LENGTH - GRAM + 1`` byte grams; the least
gram hash, its minimiser, is the same wherever the string stands. A document is
cut into runs of string starts of equal minimiser. Copies of a whole text are left
out first (all their bytes go, and what they hold stands in the first one too), then minimisers that stand in one
document only (their strings cannot repeat); the remaining runs meet by minimiser; texts that share too few bytes around it are told apart,
and each task builds the suffix array of its runs' other distinct texts with the difference-cover algorithm: sampled triples are sorted
and named, names are sorted recursively, the other suffixes are sorted by the
sample's ranks and merged. Adjacent prefixes of ``LENGTH`` bytes are compared;
each group of equal ones has a smallest doc_id, and the starts of larger
doc_ids in it are removed. Minimisers of more than ``HOT_DOCS`` documents take
an exact way of their own: equal runs are grouped by a 128-bit hash and the strings
of unlike ones one by one, with minima aggregated before the shuffle and joins that can be split.

Defined results: null texts are empty, shorter ones than ``LENGTH`` lose
nothing; rows without doc_id lose nothing and remove nothing; rows of equal
doc_id do not touch each other; extra columns are carried along, columns of the
names ``n_bytes``, ``removed`` and ``kept`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, list_array, map_columns

#: Bytes of a repeated string, and of a gram.
LENGTH, GRAM = 50, 20
#: Documents from which on a minimiser's strings are grouped one by one.
HOT_DOCS = 20_000
#: Bytes of runs in one suffix array (whole minimisers).
BLOCK_BYTES = 4 << 20
#: Runs whose removed spans are told at a time.
SPAN_ROWS = 8192
#: Every string has, around its minimiser, at least one of these numbers of bytes before and after.
_AROUND = [(l, LENGTH - GRAM - min(l + 7, LENGTH - GRAM)) for l in range(0, LENGTH - GRAM + 1, 8)]

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum (``pick``) of every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes at every byte, as a number."""
    n = len(data) - 7
    eight = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        part = np.frombuffer(data, "<u8", (len(data) - o) // 8, o)
        eight[o::8] = part[:len(eight[o::8])]
    return eight


def gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the gram at every byte."""
    eight = _eights(data)
    a, b, c = eight[:-(GRAM - 8)], eight[8:len(eight) - (GRAM - 16)], eight[GRAM - 8:]  # the last eight bytes overlap
    h = (a * _C1) ^ (b * _C2 + (c >> np.uint64(31))) ^ (c * _C3)
    h ^= h >> np.uint64(32)
    h *= _C3
    return h ^ (h >> np.uint64(29))


def minimisers(data: bytes) -> np.ndarray:
    """Minimiser of the string at every start (none: shorter data)."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64)
    return _slide(gram_hashes(data), LENGTH - GRAM + 1, np.minimum)


def _short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The hashes' upper ``bits`` bits as long values."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _named(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks (from 1) of the keys among the distinct ones, and their number."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(new)
    return name, int(new.sum())


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative values by the difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = s.astype(np.int64) + 1
    top = int(s.max()) + 1
    p = np.concatenate([s, np.zeros(4, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    if top < 1 << 20:
        name, kinds = _named((p[sample] * top + p[sample + 1]) * top + p[sample + 2])
    else:
        pair, _ = _named(p[sample] * top + p[sample + 1]) if top < 1 << 31 else _named(p[sample])
        name, kinds = _named(pair * (int(p.max()) + 1) + p[sample + 2])
    order = np.argsort(name) if kinds == len(sample) else suffix_array(name)
    sorted_sample = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sorted_sample] = np.arange(1, len(sample) + 1)
    sorted_sample = sorted_sample[sorted_sample < n]
    zero = np.arange(0, n, 3)
    scale = n + 4
    key0 = p[zero] * scale + rank[zero + 1]
    by = np.argsort(key0)
    zero, key0 = zero[by], key0[by]
    # the others are counted before each: those at 1 by (value, rank), those at 2 by (two values, rank)
    at1, at2 = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted(p[at1] * scale + rank[at1 + 1], key0)
    pair2, pair0 = p[at2] * top + p[at2 + 1], p[zero] * top + p[zero + 1]
    if top < 1 << 20:
        before += np.searchsorted(pair2 * scale + rank[at2 + 2], pair0 * scale + rank[zero + 2])
    else:  # names of many kinds: pairs are named before they are scaled
        both, _ = _named(np.concatenate([pair2, pair0]))
        before += np.searchsorted(both[:len(pair2)] * scale + rank[at2 + 2], both[len(pair2):] * scale + rank[zero + 2])
    out = np.full(n, -1, np.int64)
    out[before + np.arange(len(zero))] = zero
    out[out < 0] = sorted_sample
    return out


def may_meet(strings: list[bytes], grams: np.ndarray, bits: int) -> np.ndarray:
    """Which of the distinct strings may share ``LENGTH`` bytes with another one of their minimiser.

    Shared bytes hold the minimiser at the same place, so they hold one of ``_AROUND`` (bytes
    before and after it), whole, in both. Strings whose minimiser stands in one of
    them more than once all may meet."""
    sizes = np.array([len(x) for x in strings])
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    body = b"\0".join(strings) + b"\0"
    eight, found = _eights(body), _short(gram_hashes(body), bits)
    which = np.repeat(np.arange(len(strings)), sizes + 1)[:len(found)]
    at = np.flatnonzero(found == grams[which])
    at = at[at + GRAM <= ends[which[at]]]
    place = np.zeros(len(strings), np.int64)
    place[which[at]] = at
    out = np.isin(grams, grams[np.bincount(which[at], minlength=len(strings)) != 1])
    for before, after in _AROUND:
        has = np.flatnonzero((place - before >= starts) & (place + GRAM + after <= ends))
        first, end = place[has] - before, place[has] + GRAM + after
        hashed = np.zeros(len(has), np.uint64)
        for j in range(0, before + GRAM + after, 8):
            hashed = (hashed ^ eight[np.minimum(first + j, end - 8)]) * _C3
            hashed ^= hashed >> np.uint64(29)
        _, back, count = np.unique(hashed, return_inverse=True, return_counts=True)
        out[has[count[back] > 1]] = True
    return out


def smallest_owners(strings: list[bytes], owner: np.ndarray) -> list[np.ndarray]:
    """For each string (with its smallest doc_id) the smallest doc_id at every start of ``LENGTH`` bytes."""
    sizes = np.array([len(x) for x in strings])
    text = np.zeros(int((sizes + 1).sum()), np.int16)
    starts = np.cumsum(sizes + 1) - sizes - 1
    body = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text[:] = body.astype(np.int16) + 1
    text[starts + sizes] = 0
    which = np.repeat(np.arange(len(strings)), sizes + 1)
    room = starts[which] + sizes[which] - np.arange(len(text))  # bytes up to the string's end
    sa = suffix_array(text)
    sa = sa[room[sa] >= LENGTH]
    same = np.arange(1, len(sa))
    eight = _eights(body.tobytes())
    for j in [*range(0, LENGTH - 8, 8), LENGTH - 8]:  # the last eight bytes overlap
        same = same[eight[sa[same] + j] == eight[sa[same - 1] + j]]
    new = np.ones(len(sa), bool)
    new[same] = False
    group = np.cumsum(new) - 1
    low = np.minimum.reduceat(owner[which[sa]], np.flatnonzero(new)) if len(sa) else owner[:0]
    least = np.empty(len(text), np.int64)
    least[sa] = low[group] if len(sa) else 0
    return [least[a:a + n - LENGTH + 1] for a, n in zip(starts.tolist(), sizes.tolist())]


def removed_runs(least: np.ndarray, first: np.ndarray, size: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the maximal runs below a row's doc_id; row i has ``size[i]`` values of ``least`` from ``first[i]`` on."""
    end = np.cumsum(size + 1)  # a place that is never removed stands behind each row
    begin = end - size - 1
    row = np.repeat(np.arange(len(size)), size + 1)
    place = np.arange(len(row)) - begin[row]
    inside = place < size[row]
    mask = np.zeros(len(row) + 1, np.int8)  # and before the first one
    mask[1:][inside] = least[first[row[inside]] + place[inside]] < docs[row[inside]]
    edge = np.diff(mask)
    a, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return row[a], place[a], e - begin[row[a]]


_RUNS = T.StructType([T.StructField("gram", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()),
                      T.StructField("start", T.IntegerType()), T.StructField("run", T.BinaryType())])
#: Of a packed run: its place, then the bytes (fewer bytes in a shuffle than columns; zeros side by side).
_PACKED = T.StructType([T.StructField("gram", T.LongType()), T.StructField("packed", T.BinaryType())])
_PLACE = np.dtype([("doc", "<i8"), ("start", ">i4"), ("part", "<i4")])
_SPANS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("from_", T.LongType()), T.StructField("to", T.LongType())])


def _cut(bits: int, packed: bool):
    """Runs of starts of equal, wanted minimisers (input: doc_id, part, data, grams), ``_PACKED`` or ``_RUNS``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                values, places, texts = [], [], []
                for doc, part, data, grams in zip(*[b.column(i).slice(at, 256).to_pylist() for i in range(4)]):
                    value = _short(minimisers(data), bits)
                    good = np.isin(value, np.array(grams, np.int64))
                    edge = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, int)
                    ends = np.append(edge[1:], len(value))[good[edge]]
                    edge = edge[good[edge]]
                    values.append(value[edge])
                    place = np.zeros(len(edge), _PLACE)
                    place["doc"], place["start"], place["part"] = doc, edge, part
                    places.append(place)
                    texts += [data[a:e - 1 + LENGTH] for a, e in zip(edge.tolist(), ends.tolist())]
                gram, place = np.concatenate([np.zeros(0, np.int64), *values]), np.concatenate([np.zeros(0, _PLACE), *places]).astype(_PLACE)  # which turns bytes round
                if packed:
                    head, n = place.tobytes(), _PLACE.itemsize
                    cols = [gram, [head[i * n:i * n + n] + x for i, x in enumerate(texts)]]
                else:
                    cols = [gram, *(place[c].astype(f"i{place[c].itemsize}") for c in ("doc", "part", "start")), texts]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary()) if packed else (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                                 names=(_PACKED if packed else _RUNS).names)

    return run


def _solved(batches: list[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Removed byte spans of packed runs (whole minimisers)."""
    rows = pa.Table.from_batches(batches)
    packed, grams = rows["packed"].to_pylist(), rows["gram"].to_numpy()
    place = np.frombuffer(b"".join([x[:_PLACE.itemsize] for x in packed]), _PLACE)
    docs = place["doc"].astype(np.int64)
    coded = pa.array([x[_PLACE.itemsize:] for x in packed], pa.binary()).dictionary_encode()  # equal texts have equal minimisers
    strings, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    owner = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(owner, at, docs)
    gram = np.empty(len(strings), np.int64)
    gram[at] = grams
    # texts that meet no other under their minimiser repeat as a whole; the others are sorted
    of_gram = np.unique(gram, return_inverse=True)[1]
    n_starts = np.array([len(r) for r in strings]) - LENGTH + 1
    first = np.cumsum(n_starts) - n_starts
    least = np.repeat(owner, n_starts)  # the texts' starts one after the other
    several = np.flatnonzero(np.bincount(of_gram)[of_gram] > 1)
    if len(several):
        several = several[may_meet([strings[i] for i in several], gram[several], bits)]
    if len(several):
        for i, found in zip(several.tolist(), smallest_owners([strings[i] for i in several], owner[several])):
            least[first[i]:first[i] + len(found)] = found
    yield from _spans(least, first[at], n_starts[at], docs, place["part"].astype(np.int32), place["start"].astype(np.int64))


def _repeated(bits: int):
    """Removed byte spans of packed runs that come sorted by minimiser."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            grams = b.column(0).to_numpy()
            cut = int(np.searchsorted(grams, grams[-1]))  # the batch's last minimiser may go on
            if size >= BLOCK_BYTES and (cut or last != grams[0]):
                yield from _solved(held + [b.slice(0, cut)], bits)
                held, size, b = [], 0, b.slice(cut)
            held.append(b)
            size += pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            last = grams[-1]
        if held:
            yield from _solved(held, bits)

    return run


def _spans(least: np.ndarray, first: np.ndarray, size: np.ndarray, docs: np.ndarray, parts: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Removed byte spans of runs with the smallest doc_ids of their starts, some rows at a time."""
    for i in range(0, len(docs), SPAN_ROWS):
        at = slice(i, i + SPAN_ROWS)
        row, a, e = removed_runs(least, first[at], size[at], docs[at])
        start = starts[at][row]
        cols = docs[at][row], parts[at][row], start + a, start + e - 1 + LENGTH
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=_SPANS.names)


def _strings(batches: Iterator[pa.RecordBatch]):
    """Each string of the runs (input: a, b, first, run) with its place ``i``."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = list(zip(*[batch.column(i).slice(at, 256).to_pylist() for i in range(4)]))
            out = [(a, b, first, i, run[i:i + LENGTH]) for a, b, first, run in rows for i in range(len(run) - LENGTH + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                             names=["a", "b", "first", "i", "string"])


def _lost(batches: Iterator[pa.RecordBatch]):
    """Removed byte spans (input: doc_id, part, start, least)."""
    for batch in batches:
        docs, parts, starts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        lists = batch.column(3)
        ends = np.cumsum(size := lists.value_lengths().to_numpy(zero_copy_only=False))
        yield from _spans(lists.flatten().to_numpy(zero_copy_only=False), ends - size, size, docs, parts, starts.astype(np.int64))


def _merged_spans(spans: DataFrame) -> DataFrame:
    """doc_id, part and ``removed``: maximal byte spans, in order."""

    def run(batches):
        for batch in batches:
            out = []
            for spans in batch["spans"]:
                done: list[list[int]] = []
                for a, e in sorted((s["from_"], s["to"]) for s in spans):
                    if done and a <= done[-1][1]:
                        done[-1][1] = max(done[-1][1], e)
                    else:
                        done.append([a, e])
                out.append([{"start": a, "end": e} for a, e in done])
            yield {"removed": out}

    by_doc = spans.groupBy("doc_id", "part").agg(F.collect_list(F.struct("from_", "to")).alias("spans"))  # one document's
    return map_columns(by_doc, run, ["spans"], [("removed", _REMOVED)], keep=["doc_id", "part"])


_REMOVED = T.ArrayType(T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)]))


def _whole(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data")).where("doc_id is not null")


def _part(data: str):
    """Tells texts of one doc_id apart."""
    return F.pmod(F.xxhash64(data), F.lit(1 << 20)).cast("int")


def removed_spans(whole: DataFrame) -> DataFrame:
    """doc_id, part (hash of the data) and the removed spans of the documents (doc_id, data) that lose bytes."""
    # minimisers are kept to so many bits that one in about 64 meets another's by chance
    n_bytes = whole.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    bits = min(63, max(16, int(n_bytes).bit_length() + 2))

    def grams(batches):
        for batch in batches:
            found = [np.unique(_short(minimisers(d), bits)) for d in batch["data"]]
            yield {"gram": list_array(np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(f) for f in found], np.int64), pa.int64())}

    first = whole.groupBy(F.xxhash64("data").alias("a"), F.xxhash64(F.lit(1), "data").alias("b")).agg(F.min("doc_id").alias("first"))
    copies = (whole.select("doc_id", _part("data").alias("part"), F.xxhash64("data").alias("a"), F.xxhash64(F.lit(1), "data").alias("b"), F.octet_length("data").cast("long").alias("to"))
              .join(first, ["a", "b"]).where((F.col("doc_id") > F.col("first")) & (F.col("to") >= LENGTH)).select("doc_id", "part", F.lit(0).cast("long").alias("from_"), "to"))

    copied = copies.groupBy("doc_id").agg(F.collect_set("part").alias("copied"))  # more than one only for repeated ids
    own = whole.join(copied, "doc_id", "left").withColumn("part", _part("data"))
    own = own.where(~F.array_contains(F.coalesce("copied", F.array().cast("array<int>")), F.col("part"))).select("doc_id", "part", "data")

    rows = map_columns(own, grams, ["data"], [("gram", T.ArrayType(T.LongType()))], keep=["doc_id"], slice_bytes=SLICE_BYTES).select(F.explode("gram").alias("gram"), "doc_id")
    # counted where they lie: (minimiser, id) rows are shuffled once, and those of several documents once more, to their documents
    several = rows.withColumn("docs", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("docs > 1")
    # the hot ones are told by the sign
    wanted = several.select("doc_id", F.when(F.col("docs") > HOT_DOCS, -1 - F.col("gram")).otherwise(F.col("gram")).alias("gram")).repartition("doc_id")

    def runs(hot: bool) -> DataFrame:
        """Runs of the documents' wanted minimisers, hot or not."""
        # no filter on the sign: it would be pushed down and the rows made and shuffled for each
        mine = F.when(F.col("gram") < 0, -1 - F.col("gram")) if hot else F.when(F.col("gram") >= 0, F.col("gram"))
        listed = wanted.groupBy("doc_id").agg(F.collect_list(mine).alias("grams")).where(F.size("grams") > 0)  # one document's
        return own.join(listed, "doc_id").select("doc_id", "part", "data", "grams").mapInArrow(_cut(bits, not hot), _RUNS if hot else _PACKED)

    met = runs(False).repartition("gram").sortWithinPartitions("gram").mapInArrow(_repeated(bits), _SPANS)
    hot = runs(True).withColumn("a", F.xxhash64("run")).withColumn("b", F.xxhash64(F.lit(1), "run"))
    unlike = hot.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.first("run").alias("run"))
    strings = unlike.mapInArrow(_strings, "a long, b long, first long, i int, string binary")
    strings = strings.select("a", "b", "first", "i", F.xxhash64("string").alias("sa"), F.xxhash64(F.lit(1), "string").alias("sb"))
    low = strings.groupBy("sa", "sb").agg(F.min("first").alias("low"))
    least = (strings.join(low, ["sa", "sb"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("i", "low"))).alias("least"))  # one run's
             .select("a", "b", F.transform("least", lambda x: x["low"]).alias("least")))
    alone = hot.join(least, ["a", "b"]).select("doc_id", "part", "start", "least").mapInArrow(_lost, _SPANS)
    return _merged_spans(met.unionByName(alone).unionByName(copies))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with n_bytes, ``removed`` (maximal byte spans) and ``kept`` (the remaining bytes)."""
    spans = removed_spans(_whole(docs, doc_id, text))
    extra = {f"_x{i}": c for i, c in enumerate(docs.columns) if c not in (doc_id, text, "n_bytes", "removed", "kept")}
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), data.alias("data"), *[F.col(f"`{c}`").alias(x) for x, c in extra.items()])
    by_id = spans.groupBy("doc_id").agg(F.collect_list(F.struct("part", "removed")).alias("spans"))  # one entry but for repeated ids
    own = F.filter("spans", lambda x: x["part"] == _part("data"))
    met = rows.where("doc_id is not null").join(by_id, "doc_id", "left").withColumn("removed", F.get(own, F.lit(0))["removed"]).drop("spans")
    lost = rows.where("doc_id is null").withColumn("removed", F.lit(None).cast(_REMOVED))
    met = met.unionByName(lost)

    def run(batches):
        for batch in batches:
            out = []
            for d, spans in zip(batch["data"], batch["removed"]):
                at, kept = 0, []
                for s in spans or ():
                    kept.append(d[at:s["start"]])
                    at = s["end"]
                out.append(b"".join(kept) + d[at:])
            yield {"kept": out, "removed": [s or [] for s in batch["removed"]], "n_bytes": [len(d) for d in batch["data"]]}

    done = map_columns(met, run, ["data", "removed"], [("removed", _REMOVED), ("kept", T.BinaryType()), ("n_bytes", T.LongType())], keep=["doc_id", "data", *extra], slice_bytes=SLICE_BYTES)
    return done.select(F.col("doc_id").alias(doc_id), F.col("data").cast("string").alias(text), *[F.col(x).alias(c) for x, c in extra.items()], "n_bytes", "removed", "kept")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``deduplicated``."""
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows in DuckDB: every 50-byte string (as hex) with the first document it starts in.
ORACLE = """WITH d AS (SELECT row_number() OVER () AS rn, doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
b AS (SELECT rn, doc_id, unnest(range(0, (len(h) // 2 - 50) // 256 + 1)) AS b, h FROM d WHERE len(h) >= 100),
p AS (SELECT rn, doc_id, b, substr(h, 512 * b + 1, 610) AS p FROM b),
s AS (SELECT rn, doc_id, b, p, unnest(range(0, LEAST(256, len(p) // 2 - 49))) AS j FROM p),
g AS (SELECT rn, doc_id, 256 * b + j AS i, md5_number(substr(p, 2 * j + 1, 100)) AS g FROM s),
f AS (SELECT g, MIN(doc_id) AS m FROM g GROUP BY g HAVING MIN(doc_id) < MAX(doc_id)),
c AS (SELECT rn, i, lag(i) OVER (PARTITION BY rn ORDER BY i) AS before FROM g JOIN f USING (g) WHERE doc_id > m),
k AS (SELECT rn, i, SUM(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rn ORDER BY i) AS island FROM c),
r AS (SELECT rn, MIN(i) AS a, MAX(i) + 50 AS e FROM k GROUP BY rn, island),
o AS (SELECT rn, a, e, COALESCE(lag(e) OVER (PARTITION BY rn ORDER BY a), 0) AS gap FROM r),
t AS (SELECT rn, COUNT(*) AS n_spans, SUM(e - a) AS n_removed, MAX(e) AS last, string_agg(substr(h, 2 * gap + 1, 2 * (a - gap)), '' ORDER BY a) AS head
  FROM o JOIN d USING (rn) GROUP BY rn)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
    sha256(unhex(COALESCE(head, '') || substr(h, 2 * COALESCE(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rn)"""
