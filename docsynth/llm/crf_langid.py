"""Language of documents by a linear-chain conditional random field over their words.

Every word of a text gets one of the learned languages. A word's features are its
letters' n-grams (1 to 4 letters, hashed), its affixes (the n-grams that hold its
beginning or its end) and where the lexicon has seen it; learned transitions tie a word
to the one before it, so that a word without features of its own follows its neighbours
and a run of another language is a run. Forward-backward gives each word's distribution;
their mean over the whole text is the document's, its largest entry the prediction and
the score. ``word_labels`` gives the words' own labels (code-switched text).

Learning: weights by gradient ascent on the likelihood. Only documents with a language
whose crc32(doc_id as text) mod ``FOLDS`` is not ``HELD_OUT`` are learned from, by
their text and lang. The sample is bounded: ``SAMPLE_DOCS`` documents, as many of each
language as of the others, ``WINDOW`` words running of each, from a hashed place. Half of the
chains run within one document, half are spliced from runs of several documents, which
is where transitions between languages are learned.

A chain holds ``CHAIN`` words running of one text; longer texts are several chains.

Rules for odd rows: null texts and texts without a letter are ``und`` with score 0, and
so is everything where nothing could be learned; each row is judged by its text alone;
null ids count as the empty text in the fold (crc32 0); equal means go to the language
that sorts first; further columns stay, save those of the outputs' names; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

FOLDS, HELD_OUT = 3, 1
SAMPLE_DOCS, WINDOW = 1000, 256
CHAIN = 128
#: Rows of the weight table for hashed n-grams, the longest n-gram, and shares that part the lexicon's bins.
NGRAMS, LONGEST = 1 << 16, 4
SHARES = (0.0, 0.6, 0.9)
ROUNDS, RATE, DECAY = 40, 0.25, 1e-5
SLICE_BYTES = 2 << 20

_LETTERS = re.compile(r"[^\W\d_]+")
_BEGIN, _END = "\x02", "\x03"


def letters(text: str | None) -> list[str]:
    """Words: maximal runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower()) if text else []


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word's number, hashed n-gram) of every n-gram, affixes with their mark."""
    chars = np.frombuffer("".join(_BEGIN + w + _END for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))  # characters from here to the word's end
    h = np.zeros(len(chars), np.uint64)
    owners, grams = [], []
    for n in range(1, LONGEST + 1):
        h = h[:len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1:]
        at = np.flatnonzero(left[:len(h)] >= n)
        mixed = (h[at] ^ (h[at] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        owners.append(owner[at])
        grams.append((mixed >> np.uint64(40)).astype(np.int64) & (NGRAMS - 1))
    return np.concatenate(owners), np.concatenate(grams)


class _Numbers(dict):
    """Numbers the words that it is asked for, from 0."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def numbered(texts) -> tuple[list[str], np.ndarray]:
    """(distinct words, number of each word of the texts in a row)."""
    number = _Numbers()
    ids = np.concatenate([np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts])
    return list(number), ids


def forward_backward(emit: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray, with_pairs: bool = True):
    """Chains' marginals. ``emit``: steps x chains x labels of log potentials, chains by falling
    length; ``trans`` [from, to] and ``start`` are logs too. Returns (marginals of the words,
    sum of the marginals of pairs of neighbours if asked for, log partition functions' sum)."""
    steps, chains, labels = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, a, first = np.exp(emit - top), np.exp(trans), np.exp(start)
    alive = [int((lengths > t).sum()) for t in range(steps)]
    alpha, beta = np.zeros_like(emit), np.ones_like(emit)
    log_z = 0.0
    for t in range(steps):
        n = alive[t]
        now = (first if t == 0 else alpha[t - 1, :n] @ a) * e[t, :n]
        total = now.sum(axis=1, keepdims=True)
        alpha[t, :n] = now / total
        log_z += float(np.log(total).sum() + top[t, :n].sum())
    pairs = np.zeros((labels, labels))
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        if not n:
            continue
        right = e[t + 1, :n] * beta[t + 1, :n]
        back = right @ a.T
        if with_pairs:
            both = alpha[t, :n, :, None] * a * right[:, None, :]
            pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[t, :n] = back / back.sum(axis=1, keepdims=True)
    marginals = alpha * beta
    marginals /= np.maximum(marginals.sum(axis=2, keepdims=True), 1e-300)
    return marginals, pairs, log_z


def laid_out(sizes: np.ndarray, chain: int = CHAIN):
    """Words of several texts, one after the other, as chains of at most ``chain`` words by falling
    length: (step, chain) of each word and the chains' lengths."""
    full, rest = sizes // chain, sizes % chain
    per_text = full + (rest > 0)
    lengths = np.full(int(per_text.sum()), chain)
    last = np.cumsum(per_text) - 1
    lengths[last[rest > 0]] = rest[rest > 0]
    order = np.argsort(-lengths, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return step, np.repeat(place, lengths), lengths[order]


class Model:
    """Languages, lexicon (word -> row of the weights) and weights."""

    def __init__(self, languages: list[str], lexicon: dict[str, int]):
        self.languages, self.lexicon = languages, lexicon
        k = len(languages)
        self.weights = np.zeros((NGRAMS + 1 + k * len(SHARES), k))
        self.start, self.trans = np.zeros(k), np.zeros((k, k))

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        owner, gram = ngrams(words)
        seen = np.array([self.lexicon.get(w, NGRAMS) for w in words], np.int64)
        return np.concatenate([owner, np.arange(len(words))]), np.concatenate([gram, seen])

    def emissions(self, words: list[str]) -> np.ndarray:
        owner, row = self.features(words)
        return np.stack([np.bincount(owner, self.weights[row, k], len(words)) for k in range(len(self.languages))], axis=1)

    def marginals(self, texts: list[list[str]]) -> np.ndarray:
        """Words (of all texts in a row) x languages."""
        distinct, ids = numbered(texts)
        table = self.emissions(distinct)
        step, chain, lengths = laid_out(np.array([len(t) for t in texts]))
        emit = np.zeros((int(step.max()) + 1, len(lengths), len(self.languages)))
        emit[step, chain] = table[ids]
        return forward_backward(emit, lengths, self.start, self.trans, False)[0][step, chain]


def lexicon(samples: list[tuple[str, list[str]]], languages: list[str]) -> dict[str, int]:
    """Words of at least two samples -> the weight row of their main language and its share of them."""
    counts: dict[str, Counter] = {}
    for lang, words in samples:
        for w in set(words):
            counts.setdefault(w, Counter())[lang] += 1
    out = {}
    for w, c in counts.items():
        total = sum(c.values())
        lang, n = min(c.items(), key=lambda x: (-x[1], x[0]))
        if total > 1:
            share = sum(n >= s * total for s in SHARES) - 1
            out[w] = NGRAMS + 1 + languages.index(lang) * len(SHARES) + share
    return out


def fitted(samples: list[tuple[str, list[str]]], rounds: int = ROUNDS) -> Model | None:
    """A model of (language, words) samples; None without words."""
    samples = [(lang, words) for lang, words in samples if words]
    if not samples:
        return None
    languages = sorted({lang for lang, _ in samples})
    code = {lang: i for i, lang in enumerate(languages)}
    model = Model(languages, lexicon(samples, languages))
    rng = np.random.default_rng(13)
    chains, runs = [], []
    for i, (lang, words) in enumerate(samples):
        if i % 2 == 0:
            chains += [(words[j:j + CHAIN], [code[lang]] * len(words[j:j + CHAIN])) for j in range(0, len(words), CHAIN)]
        else:
            at = 0
            while at < len(words):
                size = int(rng.integers(4, 40))
                runs.append((words[at:at + size], [code[lang]] * len(words[at:at + size])))
                at += size
    words, labels = [], []
    for i in rng.permutation(len(runs)).tolist():
        words, labels = words + runs[i][0], labels + runs[i][1]
        if len(words) >= CHAIN - 40:
            chains.append((words, labels))
            words, labels = [], []
    if words:
        chains.append((words, labels))
    distinct, ids = numbered([words for words, _ in chains])
    truth = np.array([k for _, labels in chains for k in labels])
    owner, row = model.features(distinct)
    step, chain, lengths = laid_out(np.array([len(w) for w, _ in chains]))
    k, n = len(languages), len(ids)
    gold = np.zeros((n, k))
    gold[np.arange(n), truth] = 1.0
    first = step == 0
    gold_start = gold[first].sum(axis=0)
    after = np.flatnonzero(~first)
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (truth[after - 1], truth[after]), 1.0)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.start, model.trans)]
    for r in range(1, rounds + 1):
        table = np.stack([np.bincount(owner, model.weights[row, j], len(distinct)) for j in range(k)], axis=1)
        emit = np.zeros((int(step.max()) + 1, len(lengths), k))
        emit[step, chain] = table[ids]
        marginals, pairs, _ = forward_backward(emit, lengths, model.start, model.trans)
        found = marginals[step, chain]
        by_word = np.stack([np.bincount(ids, (gold - found)[:, j], len(distinct)) for j in range(k)], axis=1)
        slope = np.stack([np.bincount(row, by_word[owner, j], len(model.weights)) for j in range(k)], axis=1)
        slopes = (slope, gold_start - found[first].sum(axis=0), gold_pairs - pairs)
        # Adam
        for x, g, (m, v) in zip((model.weights, model.start, model.trans), slopes, moments):
            g = g / n - DECAY * x
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x += RATE * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-10)
    model.weights = model.weights.astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, window: int = WINDOW) -> Model | None:
    """Fit on at most ``sample_docs`` windows of ``window`` words, dealt to the languages in turn."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    rows = rows.select("lang", "text", key.alias("key"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    chosen = rows.withColumn("turn", turn).where(F.col("turn") <= sample_docs).orderBy("turn", "lang").limit(sample_docs)

    def cut(batches):
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                out = []
                for lang, text, key in zip(*(piece.column(i).to_pylist() for i in range(3))):
                    words = letters(text)
                    at = key % max(1, len(words) - window + 1)
                    out.append((lang, key, words[at:at + window]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.list_(pa.string())))],
                    names=["lang", "key", "words"])

    sample = chosen.select("lang", "text", "key").mapInArrow(cut, "lang string, key long, words array<string>").collect()
    return fitted([(r.lang, r.words) for r in sorted(sample, key=lambda r: (r.key, r.lang, r.words))])


def _judged(docs: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """Every row, with the columns of ``schema``, which ``fn(texts)`` returns as lists."""
    names = [f.name for f in schema.fields]
    keep = [c for c in docs.columns if c not in names]
    at = keep.index("text")
    frame = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)])
    out = T.StructType([T.StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)] + schema.fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        for batch in batches:
            for piece in slices(batch, at, SLICE_BYTES):
                found = [pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(fn(piece.column(at).to_pylist()), schema.fields)]
                yield pa.RecordBatch.from_arrays([piece.column(i) for i in range(len(keep))] + found,
                                                 names=[f"_k{i}" for i in range(len(keep))] + names)

    return frame.mapInArrow(run, out).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *names)


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score``."""
    def judge(texts):
        words = [letters(t) for t in texts]
        sizes = np.array([len(w) for w in words])
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        some = np.flatnonzero(sizes)
        if model is None or not len(some):
            return lang, score
        p = model.marginals([words[i] for i in some])
        mean = np.add.reduceat(p, np.cumsum(sizes[some]) - sizes[some], axis=0) / sizes[some, None]
        for i, row in zip(some.tolist(), mean):
            best = int(row.argmax())
            lang[i], score[i] = model.languages[best], min(1.0, float(row[best]))
        return lang, score

    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return _judged(docs, judge, schema)


def word_labels(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns with ``words`` and ``word_langs``: every word's likeliest language."""
    def judge(texts):
        words = [letters(t) for t in texts]
        if model is None or not any(words):
            return words, [["und"] * len(w) for w in words]
        best = model.marginals([w for w in words if w]).argmax(axis=1).tolist()
        names = iter([model.languages[b] for b in best])
        return words, [[next(names) for _ in w] for w in words]

    schema = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("words", "word_langs")])
    return _judged(docs, judge, schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
