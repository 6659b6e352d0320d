"""Operators that hold documents or vectors against each other, and the pipeline."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from docsynth.llm import chain_dedup, fm_decontam, nn_descent, pii, queries, setsketch, sp_codec, suffix_dedup

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# ---- nearest neighbours ----

def brute_nearest(vectors, query, k):
    q = np.array(vectors[query], float)
    scored = []
    for i, v in vectors.items():
        if i != query:
            v = np.array(v, float)
            scored.append((-(q * v).sum() / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum())), i))
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_recall_of_the_query(spark, sf):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = {}
    for r in queries.op1_nearest_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    asked = [i for i in vectors if i % 50 == 0]
    assert set(got) == set(asked)
    hits = 0
    for q in asked:
        want = brute_nearest(vectors, q, 5)
        rows = sorted(got[q])
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5] and rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len({i for i, _ in want} & {r[1] for r in rows})
        exact = dict(brute_nearest(vectors, q, len(vectors)))
        assert all(abs(exact[r[1]] - r[2]) < 1e-12 for r in rows)
    assert hits >= 0.9 * 5 * len(asked)


def recall(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = {}
    for r in nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    asked = range(0, len(unit), 50)
    for q in asked:
        far = ((unit - unit[q]) ** 2).sum(1)
        far[q] = 9
        hits += len(got[q] & set(np.argsort(far)[:5].tolist()))
    return hits / (5 * len(asked))


def test_recall_among_thousands_of_near_equal_vectors(spark):
    rng = np.random.default_rng(12)
    centre = rng.standard_normal(64)
    assert recall(spark, centre + 0.003 * rng.standard_normal((3000, 64))) >= 0.9


def test_rounds_and_hops_go_on_until_nothing_changes(spark, monkeypatch):
    angle = lambda i: [float(np.cos(i / 10)), float(np.sin(i / 10))]
    table = spark.createDataFrame([(i, angle(i)) for i in range(6)], "vec_id long, embedding array<double>")
    nodes = nn_descent.checkpointed(nn_descent.nodes_of(nn_descent.vectors(table), 6).coalesce(1))
    units = nn_descent.checkpointed(nn_descent.unit_vectors(nodes))
    # the nearest nodes stand at the end of a path: 0, 5, 4, 3, 2, 1
    path = spark.createDataFrame([(i, [i - 1 if i else 5]) for i in range(6)], "id long, nbrs array<long>")
    found = nn_descent.search(units, path, spark.createDataFrame([(0,)], "qid long").coalesce(1), 6)
    assert sorted(r.id for r in found.collect()) == list(range(6))

    calls = []

    def offers(lists, units):  # a better edge in each of six rounds
        calls.append(1)
        n = len(calls)
        return spark.createDataFrame([(0, 100 + n, -0.001 / n, True)] if n <= 6 else [], nn_descent._EDGE)

    monkeypatch.setattr(nn_descent, "improved", offers)
    graph = nn_descent.neighbour_graph(nodes, units)
    assert len(calls) == 7 and {100 + n for n in range(1, 7)} <= set(graph.where("id = 0").first().nbrs)


def test_messages_from_part_to_part(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 8))
    ids = rng.choice(10 ** 15, 1500, replace=False) - 10 ** 14  # negative ones, too
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    nodes = nn_descent.checkpointed(nn_descent.nodes_of(nn_descent.vectors(table), 6).coalesce(1))
    units = nn_descent.checkpointed(nn_descent.unit_vectors(nodes))
    real, graphs, found, rows = nn_descent.improved, [], [], []

    def counted(lists, homes):
        offers = nn_descent.checkpointed(real(lists, homes))
        rows.append((offers.count(), homes.parts))
        return offers

    monkeypatch.setattr(nn_descent, "improved", counted)
    for parts in (1, 7):
        monkeypatch.setattr(nn_descent, "parts_for", lambda units, parts=parts: parts)
        graph = nn_descent.neighbour_graph(nodes, units)
        graphs.append({r.id: r.nbrs for r in graph.collect()})
        asked = nodes.where("pmod(id, 100) = 3").selectExpr("id AS qid")
        found.append(sorted(nn_descent.search(units, graph, asked, 6).collect()))
    # a few rows between any two parts, however many edges are offered (tens of thousands in a first round)
    assert all(n <= 4 * parts ** 2 for n, parts in rows)
    # the rounds do not depend on the parts, and their lists are those of brute force
    assert found[0] == found[1] and graphs[0] == graphs[1] and set(graphs[0]) == set(ids.tolist())
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    best = np.argsort(-(unit @ unit.T), axis=1)[:, 1:11]
    assert np.mean([len(set(graphs[1][int(i)]) & set(ids[b].tolist())) / 10 for i, b in zip(ids, best)]) > 0.99


def test_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)]  # copies
    rows += [(1000 + i, [float(x) for x in rng.standard_normal(3)]) for i in range(40)]
    odd = [(2000, None), (2001, []), (2002, [0.0, 0.0, 0.0]), (2003, [1.0, None, 2.0]), (2004, [1.0, float("nan"), 2.0]), (2005, [float("inf"), 1.0, 1.0]),
           (2006, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(df, "vec_id % 50 = 0").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert [v for _, v in sorted(got[0])] == [1, 2, 3, 4, 5] and [v for _, v in sorted(got[250])] == [0, 1, 2, 3, 4]
    assert all(v < 2000 for rows in got.values() for _, v in rows)
    few = spark.createDataFrame([(50, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in nn_descent.nearest(few, "vec_id % 50 = 0").orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nn_descent.nearest(few.limit(0), "vec_id % 50 = 0").count() == 0


# ---- suffix-array dedup ----

def brute_removed(docs, length=50):
    """docs: (doc_id, bytes); removed mask of each row."""
    first = {}
    for i, b in docs:
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k:k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in docs:
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1 if i is not None else 0):
            if first[b[k:k + length]] < i:
                mask[k:k + length] = b"\1" * length
        out.append(bytes(mask))
    return out


def expected_digest(docs):
    out = []
    for (i, b), mask in zip(docs, brute_removed(docs)):
        kept = bytes(x for x, m in zip(b, mask) if not m)
        out.append((i, len(b), sum(mask), len(re.findall(b"\1+", mask)), hashlib.sha256(kept).hexdigest()))
    return out


def test_difference_cover_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(1500):
        s = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 50)))
        assert suffix_dedup.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def key(row):
    return str(row)


def test_suffix_query_equals_brute_force(spark, sf, texts):
    want = expected_digest(sorted((i, t.encode()) for i, t in texts.items()))
    got = [tuple(r) for r in queries.op3_suffix_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == want


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup_of_odd_rows(spark, odd, empty, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_DOCS", hot)
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcdefgh "), 400))
    more = [(20, base), (21, base), (22, base[:200] + "é" + base[200:]), (23, "zz" + base[100:160] + base[100:160]), (24, "a" * 300), (25, "a" * 200), (21, base[:60]),
            (30, base[10:59]), (31, base[10:60]), (None, base)]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = [tuple(r) for r in suffix_dedup.digest(suffix_dedup.deduplicated(docs)).collect()]
    assert sorted(got, key=key) == sorted(expected_digest(rows), key=key)
    assert suffix_dedup.deduplicated(empty).count() == 0


def test_suffix_minimisers_are_shuffled_once(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "a passage that comes again in every document of this table " * 2) for i in range(9)], "doc_id long, text string")
    plan = suffix_dedup.deduplicated(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [gram") == 1  # the runs'; (minimiser, id) rows lie by minimiser for the count alone


def test_removed_runs_equal_a_loop():
    rng = np.random.default_rng(6)
    for _ in range(50):
        least = rng.integers(0, 4, 60)
        n = int(rng.integers(1, 20))
        size = rng.integers(1, 9, n)
        first, docs = rng.integers(0, 50, n), rng.integers(0, 5, n)
        want = []
        for r in range(n):
            mask = [*(least[first[r]:first[r] + size[r]] < docs[r]), False]
            want += [(r, i, i + mask[i:].index(False)) for i in range(size[r]) if mask[i] and not (i and mask[i - 1])]
        assert list(zip(*[x.tolist() for x in suffix_dedup.removed_runs(least, first, size, docs)])) == want


def runs_of(texts, bits=40):
    """(minimiser, run) rows of the texts, by minimiser."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "part": [0] * len(texts), "data": texts,
                                        "grams": [sorted(set(suffix_dedup._short(suffix_dedup.minimisers(t), bits).tolist())) for t in texts]})
    return pa.Table.from_batches(suffix_dedup._cut(bits, True)(iter([batch]))).sort_by("gram")


def test_only_texts_that_may_meet_are_sorted(monkeypatch):
    rng = np.random.default_rng(7)
    noise = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    shared, short = noise(400), noise(30)
    # a passage of 30 bytes stands in all (no string of 50 does), one of 400 in five, a periodic one in three
    texts = [noise(300) + short + noise(300) + shared * (i < 5) + b"ab" * 90 * (i in (1, 6, 7)) + noise(60) for i in range(40)]
    rows, bits = runs_of(texts), 40
    sent, keep = [], suffix_dedup.smallest_owners
    monkeypatch.setattr(suffix_dedup, "smallest_owners", lambda strings, owner: sent.extend(strings) or keep(strings, owner))
    found = pa.Table.from_batches(list(suffix_dedup._solved(rows.to_batches(), bits)))
    lost = [np.zeros(len(t), bool) for t in texts]
    for doc, start, end in zip(*[found[c].to_pylist() for c in ("doc_id", "from_", "to")]):
        lost[doc][start:end] = True
    want = expected_digest(list(enumerate(texts)))
    assert [int(x.sum()) for x in lost] == [w[2] for w in want] and sum(w[2] for w in want) > 1600
    assert len(sent) < 40 and not any(short in x for x in sent)  # the 40 texts around the short passage are told apart before
    whole = [x.slice(i, 7) for x in rows.to_batches() for i in range(0, x.num_rows, 7)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 900)
    blocks = pa.Table.from_batches(list(suffix_dedup._repeated(bits)(iter(whole))))
    assert sorted(zip(*[c.to_pylist() for c in blocks.columns])) == sorted(zip(*[c.to_pylist() for c in found.columns]))


def test_strings_that_share_fifty_bytes_may_meet():
    rng = np.random.default_rng(9)
    rows = runs_of([bytes(rng.integers(97, 97 + int(rng.integers(2, 4)), 120, dtype=np.uint8)) for _ in range(60)] + [b"abc" * 50, b"ab" * 70, b"ab" * 60])
    kinds = sorted({(g, x[suffix_dedup._PLACE.itemsize:]) for g, x in zip(rows["gram"].to_pylist(), rows["packed"].to_pylist())})
    got = suffix_dedup.may_meet([x for _, x in kinds], np.array([g for g, _ in kinds]), 40)
    of = {}
    for i, (_, x) in enumerate(kinds):
        for j in range(len(x) - 49):
            of.setdefault(x[j:j + 50], set()).add(i)
    assert all(got[list(v)].all() for v in of.values() if len(v) > 1)


# ---- passages ----

def test_chain_scores_equal_a_quadratic_search():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 14))
        x, y = np.sort(rng.integers(0, 60, n)), rng.integers(0, 60, n)
        best = {}
        order = sorted(range(n), key=lambda j: (x[j], -y[j]))
        for j in order:
            best[j] = max([6.0] + [6.0 + best[i] - 0.1 * (x[j] - x[i] + y[j] - y[i]) for i in order if x[i] < x[j] and y[i] < y[j] and i in best])
        found = chain_dedup.chains(x, y)
        first = found[0]
        score = 6.0 + sum(6.0 - 0.1 * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(first, first[1:]))
        assert score == pytest.approx(max(best.values()))
        assert sorted(i for c in found for i in c) == list(range(n))
        assert all(x[a] < x[b] and y[a] < y[b] for c in found for a, b in zip(c, c[1:]))


def test_fuzzy_passages_are_found_and_clean_documents_left(spark, odd, empty):
    rng = np.random.default_rng(4)
    word = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    passage = word(60)
    edited = passage[:25] + ["new"] + passage[26:45] + passage[46:]
    docs = {1: word(30) + passage + word(30), 2: word(100), 3: word(10) + passage + word(40), 4: word(50) + edited, 5: word(40) + passage[:30] + word(40), 6: word(5)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = [r for r in chain_dedup.repeated_passages(df).collect()]
    assert {(r.doc_id, r.partner_id) for r in got} == {(3, 1), (4, 1)}
    exact = next(r for r in got if r.doc_id == 3)
    assert (exact.start, exact.end_, exact.partner_start, exact.partner_end, exact.identity) == (10, 70, 30, 90, 1.0)
    fuzzy = next(r for r in got if r.doc_id == 4)
    assert (fuzzy.start, fuzzy.end_) == (50, 109) and 0.9 < fuzzy.identity < 1
    assert {r.doc_id for r in chain_dedup.repeated_passages(odd).collect()} <= {4, 6, 8}
    assert chain_dedup.repeated_passages(empty).count() == 0


def test_passages_far_apart_and_blocks_between_are_pieces_of_their_own(spark):
    rng = np.random.default_rng(14)
    word = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    one, two, whole = word(60), word(60), word(120)
    docs = {1: word(20) + one + word(100) + two + word(20), 2: word(30) + one + word(100) + two + word(30),  # two passages 100 words apart
            3: word(20) + whole + word(20), 4: word(10) + whole[:60] + word(100) + whole[60:] + word(10)}  # a block inserted
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = sorted((r.doc_id, r.start, r.end_, r.partner_id, r.partner_start, r.partner_end, r.identity) for r in chain_dedup.repeated_passages(df).collect())
    assert got == [(2, 30, 90, 1, 20, 80, 1.0), (2, 190, 250, 1, 180, 240, 1.0), (4, 10, 70, 3, 20, 80, 1.0), (4, 170, 230, 3, 80, 140, 1.0)]


def test_seeds_count_only_with_equal_words():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 60, 100).astype(np.uint64) for _ in range(2))
    at = np.arange(0, 90, 10)
    assert chain_dedup.align(a, b, at, at) == []
    b[20:75] = a[20:75]
    assert chain_dedup.align(a, b, at, at) == [(20, 75, 20, 75, 55)]


def test_texts_of_one_id_are_chained_on_their_own(spark):
    rng = np.random.default_rng(9)
    word = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    a, b, c = word(150), word(150), word(150)
    rows = [(1, a), (1, b), (2, word(30) + a[20:120] + word(30)), (3, c), (4, word(5) + c[:70]), (4, word(20) + b[:80] + word(9))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted((r.doc_id, r.start, r.end_, r.partner_id, r.partner_start, r.partner_end, r.identity) for r in chain_dedup.repeated_passages(df).collect())
    assert got == [(2, 30, 130, 1, 20, 120, 1.0), (4, 5, 75, 3, 0, 70, 1.0), (4, 20, 100, 1, 0, 80, 1.0)]


def test_extension_goes_on_past_the_words_sent_along(spark):
    rng = np.random.default_rng(21)
    word = lambda n: ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]
    passage = word(200)
    edited = [w if i < 20 or i % 6 else "new" + w for i, w in enumerate(passage)]  # seeds at its start only
    docs = {1: word(60) + passage + word(60), 2: word(60) + edited + word(60), 3: word(300)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    (r,) = chain_dedup.repeated_passages(df).collect()
    assert (r.doc_id, r.start, r.partner_id, r.partner_start) == (2, 60, 1, 60)
    assert r.end_ >= 258 and r.end_ == r.partner_end and r.identity >= 0.8


def test_passage_query_covers_repeats_of_fifty_words(spark, sf, texts):
    found = {}
    for r in queries.op4_repeated_passages(spark, sf).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start, r.end_))
    first, repeated, missed = {}, 0, 0
    for i in sorted(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[i].translate(LOWER))
        covered = set()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k:k + 50]), i) < i:
                covered.update(range(k, k + 50))
        repeated, missed = repeated + len(covered), missed + len(covered - found.get(i, set()))
    assert repeated and missed <= 0.001 * repeated


# ---- near duplicates ----

def brute_components(docs):
    """(doc_id, text) rows -> set size and component of each."""
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = {i: i for i, _ in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and docs[a][0] is not None and docs[b][0] is not None:
                same = len(sets[a] & sets[b])
                if 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(docs[a][0]), find(docs[b][0])
                    parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for (i, _), s in zip(docs, sets)]


def check_components(got, docs):
    want = [(i, n, c, True if i is None else i == c) for i, n, c in brute_components(docs)]
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)


def test_near_duplicate_query_equals_brute_force(spark, sf, texts):
    check_components(queries.op10_near_duplicates(spark, sf).collect(), sorted(texts.items()))


def test_near_duplicates_of_edited_copies_and_odd_rows(spark, odd, empty):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    base = [word() for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for p in rng.integers(0, 60, int(rng.integers(0, 3))):
            w[p] = word()
        rows.append((100 + int(rng.permutation(1000)[0]) * 100 + i, " ".join(w)))
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    check_components(setsketch.near_duplicates(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert setsketch.near_duplicates(empty).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(7)
    a, b = (rng.integers(0, 2 ** 63, 400, dtype=np.uint64) for _ in range(2))
    sizes = lambda *x: np.array([len(y) for y in x])
    k = setsketch.sketch(np.concatenate([a, b]), sizes(a, b))
    union = setsketch.sketch(np.concatenate([a, b]), np.array([800]))
    assert (setsketch.merged(k[0], k[1]) == union[0]).all()
    pairs = [(np.concatenate([a[:c], b[c:]])) for c in (0, 200, 300, 400)]
    s = setsketch.sketch(np.concatenate([a, *pairs]), sizes(a, *pairs))
    est = setsketch.joint_estimate(np.repeat(s[:1], 4, 0), s[1:], np.full(4, 400.0), np.full(4, 400.0))
    assert est == pytest.approx([c / (800 - c) for c in (0, 200, 300, 400)], abs=0.15)


def test_rare_pairs_are_complete(spark):
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.choice(40, int(rng.integers(8, 30)), replace=False).astype(np.uint64)) for _ in range(80)]
    frame = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "id long, elements binary")
    classes = spark.createDataFrame([(i, len(s), i) for i, s in enumerate(sets)], "id long, n long, component long")
    got = {(r.a, r.b) for r in setsketch.confirmed(setsketch.rare_pairs(classes, frame), frame).collect()}
    want = {(i, j) for j in range(80) for i in range(j) if setsketch.alike(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))}
    assert got == want and want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    got = {r.id: r.component for r in setsketch.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}}


def test_few_edges_lie_in_few_tasks(spark, monkeypatch):
    parts, keep = [], setsketch.checkpointed
    monkeypatch.setattr(setsketch, "checkpointed", lambda df: parts.append((out := keep(df)).rdd.getNumPartitions()) or out)
    monkeypatch.setattr(setsketch, "EDGE_ROWS", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r.component for r in setsketch.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {i: 0 for i in range(51)}
    assert len(parts) > 2 and set(parts[1:]) == {3}


def test_texts_are_not_shuffled_for_few_ids(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(20)], "doc_id long, text string")
    ids = spark.createDataFrame([(i % 7,) for i in range(14)], "id long")
    sent = setsketch._full_sets(docs, ids, "doc_id", "text")
    assert "ResolvedHint (strategy=broadcast)" in (plan := sent._jdf.queryExecution().toString()) or "rightHint=(strategy=broadcast)" in plan
    monkeypatch.setattr(setsketch, "SENT_IDS", 0)
    shuffled = setsketch._full_sets(docs, ids, "doc_id", "text")
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, shuffled.collect())) and sent.count() == 7


# ---- pipeline ----

def test_pipeline_stages_equal_brute_force(spark, sf, texts, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows[name] = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()} if name != "toxicity" else texts
        if name == "near_duplicates":
            assert set(rows[name]) == {i for i, _, c in brute_components(sorted(kept.items())) if i == c}
        elif name == "decontamination":
            found = fm_decontam.digest(fm_decontam.contamination(before, spark.read.parquet(f"{sf}/benchmark.parquet"))).collect()
            assert set(rows[name]) == {r.doc_id for r in found if not r.contaminated}
        elif name == "personal_data":
            auto = pii.anchors()
            assert set(rows[name]) == set(kept)
            assert all(r.n_chars == len(r.text) and (r.text == kept[i]) == (not pii.spans_of(kept[i], auto)) for i, r in rows[name].items())
        elif name == "sentencepiece":
            surface = sp_codec.Pieces.load().surface
            assert {i: sp_codec.decode_ids(r.ids, surface) for i, r in rows[name].items()} == kept
        if name != "sentencepiece":
            assert docs.columns == columns
    final = {r.doc_id: tuple(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert final == {i: tuple(r.ids) for i, r in rows["sentencepiece"].items()}


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark, sf, odd, empty, tmp_path):
    for name, docs in (("odd", odd), ("empty", empty)):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, sf).write.parquet(str(tmp_path / f"{name}{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{i}"))
        assert docs.count() == (0 if name == "empty" else 10)  # one of the two equal rows goes


def test_unlike_texts_of_one_doc_id_are_documents_of_their_own(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, b), (2, None), (4, c), (4, c + " end"), (5, c), (6, None), (7, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()
    assert corpus_pipeline.drop_near_duplicates(spark, docs, sf).columns == docs.columns
    by_text = {x: [r.doc_id for r in kept if r.text and r.text.startswith(f"{x}0") and r.doc_id is not None] for x in "abc"}
    assert by_text["a"] == [1] and by_text["c"] == [4] and len(by_text["b"]) == 1
    assert sorted(r.doc_id for r in kept if not r.text) == [2, 6, 7]  # empty ones are linked with nothing
    assert sum(r.doc_id is None for r in kept) == 1
