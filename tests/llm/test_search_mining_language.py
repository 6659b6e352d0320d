"""Ranked search, collocations and language identification against brute force."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsynth.llm import collocations, crf_langid, max_sketch, queries

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
EXTRA = "doc_id long, text string, lang string, score double, rank int, item_id long, phrase string, term string, held_out boolean, lang_pred string"


def with_extras(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, 3, 9, "p", "t", True, "x") for i, t, lang in rows], EXTRA)


# ---- ranked search ----

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_ranked(docs, items, k=20):
    tfs = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in tfs), sum(n for *_, n in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    out = []
    for item, text in items:
        scored = []
        for doc, tf, n in tfs:
            if n:
                m = 100 - 25 + 25 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in terms(text) if tf[t])
                if s > 0:
                    scored.append((-s, math.inf if doc is None else doc))
        out += [(item, r, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def ranked_rows(found):
    return sorted([tuple(r) for r in max_sketch.digest(found).collect()], key=str)


def test_ranked_search_of_the_query_is_brute_force(spark, sf, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted([tuple(r) for r in queries.op11_ranked_search(spark, sf).collect()], key=str)
    assert got == brute_ranked(list(texts.items()), items)


def test_ranked_search_ties_odd_rows_and_parts(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 60)).tolist()), "en") for i in range(150)]
    docs += [(200 + i, "same words here w1 w2", "en") for i in range(40)]  # ties
    docs += [(7, "w1 again", None), (None, "w3 W4 without id", "en"), (None, "w3 W4 without id", "en"), (300, None, "en"), (301, " .,", "en"),
             (302, "w5 " * 50_000, "en"), (303, "x" * 300_000 + " w6", "en")]
    items = [(1, "Same words, W1!"), (2, None), (2, "w3 w4 w4 unknown"), (2, "w3 w4 w4 unknown"), (None, "w5 w6 Été"), (5, "--"), (6, "nothingknown"), (7, "w7 " * 4000)]
    frame, asked = with_extras(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    want = brute_ranked([d[:2] for d in docs], items)
    assert ranked_rows(max_sketch.ranked(frame, asked)) == want
    # many parts of items, each its own search
    assert ranked_rows(max_sketch.ranked(frame, asked, part_bytes=25)) == want
    assert max_sketch.ranked(frame.limit(0), asked).count() == 0 and max_sketch.ranked(frame, asked.limit(0)).count() == 0


def test_sketch_bounds_are_never_below_the_scores():
    rng = np.random.default_rng(2)
    docs = [" ".join(f"t{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 400)) % 5000).encode() for _ in range(60)]
    items = [[f"t{int(x)}".encode() for x in rng.zipf(1.3, 30) % 5000] for _ in range(20)]
    words = [d.split() for d in docs]
    df, n_terms = Counter(t for w in words for t in set(w)), sum(map(len, words))
    q = max_sketch.Queries(items, dict(df), len(docs))
    sketches = max_sketch.Sketches(docs, max_sketch.TermHashes(), len(docs), n_terms)
    seen = 0
    for some, bounds in sketches.bounds(q):
        for d, row in zip(some.tolist(), bounds):
            exact = q.scores(docs[d], max_sketch.length_norm(len(words[d]), len(docs), n_terms))
            assert (row >= exact).all()
            seen += 1
    assert seen == len(docs)


# ---- collocations ----

def brute_collocations(rows, min_count, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 6):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            gone |= {(lang, w[i:i + m]) for i in range(len(w) - m + 1) if a >= f[lang, w[i:i + m]]}
    best = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            s, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            best.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, r, p.decode(), -a, lf, rf, n[lang], -s) for lang, found in best.items()
                  for r, (s, a, p, lf, rf) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("shards, slice_bytes, parts", [(8, 1 << 25, 1), (8, 400, 5), (1, 400, 3), (40, 2000, 7)])
def test_collocations_are_brute_force(spark, shards, slice_bytes, parts):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        lang = [None, "en", "en", "fr", "und"][i % 5]
        words = [f"w{int(x)}" for x in rng.zipf(1.6, 60) % 40]
        for at in range(0, 60, 9):
            words[at] += rng.choice([".", ",", "", "\n", "\t", "!", " .", "\x0b"])
        if i % 3 == 0:
            words[5:5] = ["New", "York", "City", "council", "Ñandú"]
        rows.append((i % 50, " ".join(words), lang))
    rows += [(1, None, "en"), (None, "", None), (3, "a a a a a a a a a a a a a a", "en"), (4, " \t .. ", "fr"), (5, "new york city", "de")]
    frame = with_extras(spark, rows).repartition(parts)
    got = sorted(tuple(r) for r in collocations.collocations(frame, 6, 5, 25, 100, shards, slice_bytes).collect())
    assert got == brute_collocations([(lang, t) for _, t, lang in rows], 6, 25) and got
    assert collocations.collocations(frame.limit(0)).count() == 0


def test_a_counting_task_sends_each_phrase_once(spark):
    rows = spark.createDataFrame([("en", f"one two three w{i}") for i in range(240)], "lang string, text string").repartition(60)
    counted = collocations.task_counts(rows, lambda hashes: np.ones(len(hashes), bool), 3, 400, 4)
    sent = counted.select("*", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in sent}) <= 4 and len({(r.task, r.lang, r.words, r.phrase) for r in sent}) == len(sent)
    total = Counter()
    for r in sent:
        total[r.words, r.phrase] += r.f
    assert total[0, ""] == 960 and total[2, "two three"] == 240 and total[3, "two three w7"] == 1 and len(total) == 1 + 243 + 242 + 241


def test_exact_scores_beyond_64_bits(spark):
    assert spark.sql("SELECT CAST(1000 AS DECIMAL(4,0)) * CAST(900000000000000 AS DECIMAL(15,0)) * CAST(900000000000001 AS DECIMAL(15,0)) div "
                     "(CAST(900000000000000 AS DECIMAL(15,0)) * CAST(999999999 AS DECIMAL(15,0))) AS s").first().s == 1000 * 900000000000001 // 999999999


# ---- language ----

def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(3)
    steps, k = 5, 3
    emit, start, trans = rng.normal(size=(steps, 2, k)), rng.normal(size=k), rng.normal(size=(k, k))
    lengths = np.array([5, 3])
    marginals, pairs, log_z = crf_langid.forward_backward(emit, lengths, start, trans)
    want_pairs, want_z = np.zeros((k, k)), 0.0
    for c, n in enumerate(lengths):
        paths = list(product(range(k), repeat=int(n)))
        p = np.array([np.exp(start[y[0]] + sum(emit[t, c, y[t]] for t in range(n)) + sum(trans[y[t - 1], y[t]] for t in range(1, n))) for y in paths])
        want_z += np.log(p.sum())
        p /= p.sum()
        for t in range(n):
            assert np.allclose(marginals[t, c], [sum(p[i] for i, y in enumerate(paths) if y[t] == j) for j in range(k)])
        for i, y in enumerate(paths):
            for t in range(1, n):
                want_pairs[y[t - 1], y[t]] += p[i]
    assert np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_language_of_held_out_documents(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and any(c.isalpha() for c in docs[r.doc_id].text or "")]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    per = {}
    for r in held:
        per.setdefault(docs[r.doc_id].lang, []).append(r.lang_pred == docs[r.doc_id].lang)
    assert all(sum(v) >= 0.9 * len(v) for v in per.values())


def test_code_switched_words_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = crf_langid.train(docs)
    by = {lang: " ".join(crf_langid.letters(" ".join(r.text for r in docs.where(f"lang = '{lang}'").collect()))[-400:-370]) for lang in ("en", "de", "fr")}
    mixed = f"{by['en']} {by['de']} {by['fr']}"
    got = crf_langid.word_labels(spark.createDataFrame([(1, mixed), (2, None)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    want = ["en"] * len(by["en"].split()) + ["de"] * len(by["de"].split()) + ["fr"] * len(by["fr"].split())
    assert sum(a == b for a, b in zip(got[0].word_langs, want)) >= 0.9 * len(want) and got[1].word_langs == []
    odd = with_extras(spark, [(1, None, "en"), (2, "", "en"), (3, "12 .. 7", None), (None, by["de"], None), (4, by["fr"], "en"), (4, by["fr"], "en"),
                              (5, "x" * 200_000, "en"), (6, by["en"] * 400, "fr")])
    rows = crf_langid.digest(crf_langid.predicted(odd, model)).collect()
    assert Counter((r.doc_id, r.lang_pred) for r in rows if r.doc_id != 5) == Counter(
        [(1, "und"), (2, "und"), (3, "und"), (None, "de"), (4, "fr"), (4, "fr"), (6, "en")])
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    empty = docs.limit(0)
    assert crf_langid.train(empty) is None and crf_langid.predicted(empty, model).count() == 0
    assert [r.lang_pred for r in crf_langid.predicted(odd.limit(1), None).collect()] == ["und"]


# ---- encoding and decoding in one pass ----

def test_coded_is_decode_of_encode(spark, sf, odd):
    from docsynth.llm import sp_codec
    for frame in (spark.read.parquet(f"{sf}/documents.parquet"), odd, odd.limit(0)):
        want = sorted(((r.doc_id, r.text, r.ids, r.decoded) for r in sp_codec.decode(sp_codec.encode(frame)).collect()), key=str)
        assert sorted(((r.doc_id, r.text, r.ids, r.decoded) for r in sp_codec.coded(frame).collect()), key=str) == want


def test_texts_of_flat_ids():
    from docsynth.llm import sp_codec
    rng, surface = np.random.default_rng(4), sp_codec.Pieces.load().surface
    surfaces = sp_codec.Surfaces(surface)
    counts = np.array([0, 3, 0, 40, 1, 7, 0])
    for top in (len(surface), 300):  # the first ids are single bytes: broken characters
        flat = rng.integers(0, top, counts.sum())
        ends = np.cumsum(counts)
        want = [sp_codec.decode_ids(flat[e - n:e].tolist(), surface) for e, n in zip(ends, counts)]
        assert surfaces.texts(flat, counts).to_pylist() == want


def test_candidates_of_one_shard_need_the_support_of_all(spark):
    from docsynth.llm import collocations as C
    rows = spark.createDataFrame([("en", "often here. seldom there")] * 4 + [("en", "often here")] * 4, "lang string, text string").coalesce(1)
    kept = C.candidates(rows, 8, 5, 2, 1 << 20)
    held = C.Slice("en", ["often here. seldom there"])
    bit = held.hashes[1:] >> np.uint64(64 - kept.bits)
    there = (kept.table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
    assert dict(zip(held.words[1:], there.tolist())) == {b"often": 1, b"here": 1, b"seldom": 0, b"there": 0}
