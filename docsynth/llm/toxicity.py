"""Toxicity scores from a string-kernel support vector machine.

The kernel of two words is the gap-weighted subsequence kernel (common
subsequences of three characters, each gap and character costs a factor), so an
insult with inserted, spaced or dropped characters stays close to its plain
form. Landmark words, chosen by how much their document frequencies differ
between the labels, give each word a Nyström feature vector; a squared-hinge
support vector machine is trained on words as instances of labelled documents
(a toxic document needs one toxic word, a clean one has none), and a logistic
curve turns a document's word margins into its score.

Fitting takes a bounded sample of labelled rows (``SAMPLE_DOCS`` documents of at
most ``SAMPLE_BYTES`` bytes, the smallest hashes of their ids) to the driver;
scoring reads every whole text, inside tasks, without a shuffle. Labels, lang,
source and doc_id are no inputs of a score.

Defined results: null and empty texts get the score of a text without words;
with no labelled rows of both labels every score is the share of label 1 (0
without rows); null labels are left out, several labels of an id count as 1 if
one is 1; extra columns are carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns

SAMPLE_DOCS = 3000
SAMPLE_BYTES = 16384
LANDMARKS = 96
#: Candidates for landmarks, and how many like words are taken.
CANDIDATES, FAMILY = 400, 12
#: Order and decay of the subsequence kernel.
ORDER, DECAY = 3, 0.6
#: Share of a landmark's distinct characters that a word needs to be compared with it.
SHARED = 0.8
#: A longer token is read in overlapping windows of this many characters.
TOKEN_CHARS = 48
KEPT_TOKENS = 400_000
#: Rows, and bytes of text, cut into tokens at a time.
SLICE_ROWS, SLICE_BYTES = 1000, 4 << 20
#: Words whose kernel rows are held at a time.
BLOCK_WORDS, FIT_WORDS = 20_000, 4_000
FOLDS = 5

_EDGE = " .,;:!?|*#&%$\"'()[]{}<>/\\-_=+~`"
_SPACED = re.compile(r"(?<!\S)(?:\S )(?:\S ){2,}\S(?!\S)")


def _points(words: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of paired words: code points, pairs x characters.

    Each order's decayed double sum over earlier characters is a plain running sum
    of terms divided by the decay of their place (all are positive)."""
    s, t = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)  # pairs side by side in memory
    (n, pairs), m = s.shape, len(t)
    same = (s[:, None, :] == t[None, :, :]).astype(np.float64) * (DECAY * DECAY)
    decay = DECAY ** (np.arange(n)[:, None, None] + np.arange(m)[None, :, None])
    prime = np.ones((n + 1, m + 1, pairs))
    for _ in range(ORDER - 1):
        met = same * prime[:n, :m]
        met /= decay
        np.cumsum(met, axis=0, out=met)
        np.cumsum(met, axis=1, out=met)
        met *= decay
        prime = np.zeros((n + 1, m + 1, pairs))
        prime[1:, 1:] = met
    return (same * prime[:n, :m]).sum((0, 1))


def _bits(points: np.ndarray) -> np.ndarray:
    """The set of a word's characters as 64 bits."""
    out = np.zeros(len(points), np.uint64)
    for j in range(points.shape[1]):
        out |= np.uint64(1) << (points[:, j].astype(np.uint64) % np.uint64(61))
    return out


def _self_kernel(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words))
    for n, idx in _by_length(words).items():
        if n >= ORDER:
            p = _points([words[i] for i in idx], n)
            for a in range(0, len(idx), 4096):
                out[idx[a:a + 4096]] = subsequence_kernel(p[a:a + 4096], p[a:a + 4096])
    return out


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    return {n: np.array(g) for n, g in groups.items()}


def kernel_rows(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of words and landmarks. A pair that shares less than
    ``SHARED`` of the landmark's distinct characters counts as 0."""
    out = np.zeros((len(words), len(landmarks)))
    marks = _by_length(landmarks)
    mark_self = np.sqrt(_self_kernel(landmarks))
    for n, idx in _by_length(words).items():
        if n < ORDER:
            continue
        own = _points([words[i] for i in idx], n)
        bits = _bits(own)
        near, self_k = [], np.zeros(len(idx))
        for m, marked in marks.items():
            theirs = _points([landmarks[i] for i in marked], m)
            mark_bits = _bits(theirs)
            common = np.bitwise_count(bits[:, None] & mark_bits[None, :])
            r, c = np.nonzero(common >= np.ceil(SHARED * np.bitwise_count(mark_bits)).astype(np.uint8)[None, :])
            near.append((theirs, marked, r, c))
        used = np.unique(np.concatenate([r for _, _, r, _ in near])) if near else np.zeros(0, int)
        per = max(1, 400_000 // (n * n))
        for a in range(0, len(used), per):
            p = own[used[a:a + per]]
            self_k[used[a:a + per]] = subsequence_kernel(p, p)
        for theirs, marked, r, c in near:
            per = max(1, 400_000 // (n * theirs.shape[1]))
            for a in range(0, len(r), per):
                rr, cc = r[a:a + per], c[a:a + per]
                value = subsequence_kernel(own[rr], theirs[cc])
                out[idx[rr], marked[cc]] = value / np.maximum(np.sqrt(self_k[rr]) * mark_self[marked[cc]], 1e-300)
    return out


def plain_token(token: str) -> str:
    return token.strip(_EDGE)


def tokens_of(text: str | None) -> list[str]:
    """Lower-cased tokens between white space, and runs of single characters joined to one."""
    if not text:
        return []
    low = text.lower()
    out = low.split()
    if m := _SPACED.findall(low):
        out += [x.replace(" ", "") for x in m]
    return out


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None  # on kernel rows: Nyström map and machine in one
    bias: float = -1.0
    curve: np.ndarray | None = None
    constant: float = 0.0

    def margins(self, tokens: list[str]) -> np.ndarray:
        """Machine's margin of each token (windows of a long one: the largest)."""
        words, owner = [], []
        for i, token in enumerate(tokens):
            w = plain_token(token)
            cuts = [w] if len(w) <= TOKEN_CHARS else [w[a:a + TOKEN_CHARS] for a in range(0, len(w) - TOKEN_CHARS // 2, TOKEN_CHARS // 2)]
            words += cuts
            owner += [i] * len(cuts)
        out = np.full(len(tokens), self.bias)
        for a in range(0, len(words), BLOCK_WORDS):
            part = kernel_rows(words[a:a + BLOCK_WORDS], self.landmarks) @ self.weights + self.bias
            np.maximum.at(out, np.array(owner[a:a + BLOCK_WORDS]), part)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(features), self.constant)
        return 1.0 / (1.0 + np.exp(-np.clip(design(features) @ self.curve, -500, 500)))


#: Margins beyond which a document's tokens are counted.
LEVELS = (-0.5, 0.0, 0.5)


def design(features: np.ndarray) -> np.ndarray:
    """Inputs of the logistic curve: bounded largest margin, tokens beyond each level and their shares."""
    top, size, counts = features[:, 0], np.maximum(features[:, 1], 1), features[:, 2:]
    return np.hstack([np.ones((len(top), 1)), np.clip(top, -1.5, 1.5)[:, None], np.log1p(counts), np.sqrt(counts / size[:, None])])


def document_features(margins: np.ndarray, lengths: np.ndarray, bias: float) -> np.ndarray:
    """Largest margin, number of tokens, number of tokens beyond each level; per document."""
    out = np.zeros((len(lengths), 2 + len(LEVELS)))
    out[:, 0], out[:, 1] = bias, lengths
    full = lengths > 0
    if len(margins):
        starts = (np.cumsum(lengths) - lengths)[full]
        out[full, 0] = np.maximum.reduceat(margins, starts)
        for i, level in enumerate(LEVELS):
            out[full, 2 + i] = np.add.reduceat((margins > level).astype(float), starts)
    return out


def squared_hinge(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights (last: bias) of a linear machine with squared hinge loss, by Newton steps."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    theta = np.zeros(xb.shape[1])
    ridge = np.eye(len(theta)) * penalty
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        margin = 1 - y * (xb @ theta)
        act = margin > 0
        grad = ridge @ theta - xb[act].T @ (w[act] * y[act] * margin[act])
        step = np.linalg.solve(ridge + (xb[act] * w[act, None]).T @ xb[act], grad)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return theta


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(theta)), x.T @ (p - y) + ridge * theta)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return theta


class Numbered(dict):
    """Numbers what it is asked for, from 0."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def choose_landmarks(docs: Iterable[Iterable[str]], y: np.ndarray, n: int) -> list[str]:
    """Words whose document frequencies speak most for label 1 (smoothed log odds, several documents each)."""
    count = {1: Counter(), 0: Counter()}
    for words, label in zip(docs, y):
        count[int(label)].update(words)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    scored = []
    for w, a in count[1].items():
        b = count[0].get(w, 0)
        if a >= 2 and ORDER <= len(w) <= TOKEN_CHARS:
            p1, p0 = (a + 0.5) / (n1 + 1), (b + 0.5) / (n0 + 1)
            z = (np.log(p1) - np.log(p0)) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if z > 2:
                scored.append((-z, w))
    ranked = [w for _, w in sorted(scored)[:CANDIDATES]]
    like = kernel_rows(ranked, ranked) > 0.7
    taken: list[int] = []
    for i in range(len(ranked)):  # a few of each family of like words
        if len(taken) < n and like[i, taken].sum() < FAMILY:
            taken.append(i)
    return [ranked[i] for i in taken]


def fit(texts: list[str | None], labels: list[int], n_landmarks: int = LANDMARKS) -> Model:
    """Train on labelled texts (on the driver: the sample is bounded)."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    number = Numbered()  # a text is held as its tokens' numbers, each token and word once
    tokens = [np.fromiter((number[t] for t in tokens_of(text)), np.int32) for text in texts]
    word_number = Numbered()
    word_of = np.array([word_number[plain_token(t)] for t in number], np.int32)
    words = list(word_number)
    docs = [np.unique(word_of[ts]) for ts in tokens]
    marks = choose_landmarks(([words[i] for i in d.tolist()] for d in docs), y, n_landmarks)
    if not marks:
        return Model(constant=float(y.mean()))
    # Nystroem: the landmark matrix's inverse root, small eigenvalues left out
    value, vector = np.linalg.eigh(kernel_rows(marks, marks))
    good = value > 1e-6
    root = vector[:, good] / np.sqrt(value[good])
    vocabulary = sorted(w for w in words if ORDER <= len(w) <= TOKEN_CHARS)
    at = np.full(len(words), -1)  # features of words that are near any landmark; the others' are zero
    n_near, blocks, near = 0, [], []
    for a in range(0, len(vocabulary), FIT_WORDS):
        part = kernel_rows(vocabulary[a:a + FIT_WORDS], marks)
        met = np.flatnonzero(part.any(1))
        at[[word_number[vocabulary[a + i]] for i in met.tolist()]] = n_near + np.arange(len(met))
        n_near += len(met)
        near.append(part[met].max(1))
        blocks.append(part[met] @ root)
    x = np.concatenate(blocks)
    del blocks
    inside = [np.sort(at[d][at[d] >= 0]) for d in docs]
    margin = np.concatenate(near)  # at first: nearness to any landmark
    for _ in range(5):
        use, sign, weight = [], [], []
        for idx, label in zip(inside, y):
            if not len(idx):
                continue
            if label:
                k = idx[[margin[idx].argmax()]]
            else:
                k = idx[np.argsort(-margin[idx], kind="stable")[:3]]
            use.append(k)
            sign += [1.0 if label else -1.0] * len(k)
            weight += [1.0 / len(k)] * len(k)
        pick, sign, weight = np.concatenate(use), np.array(sign), np.array(weight)
        theta = squared_hinge(x[pick], sign, weight)
        margin = x @ theta[:-1] + theta[-1]
    del x, docs, inside
    model = Model(marks, root @ theta[:-1], float(theta[-1]))
    near = np.concatenate([model.margins(list(islice(number, a, a + BLOCK_WORDS))) for a in range(0, len(number), BLOCK_WORDS)] or [np.zeros(0)])
    flat = np.concatenate([near[ts] for ts in tokens])
    features = document_features(flat, np.array([len(ts) for ts in tokens]), model.bias)
    model.curve = logistic(design(features), y)
    return model


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text (null: of the empty text) modulo 5 is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The bounded sample of labelled documents: id, text, label."""
    chosen = (labels.where("toxic is not null and doc_id is not null").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("toxic").alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).withColumnRenamed("doc_id", "_id"))
    return (docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"])  # at most sample_docs rows
            .where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
            .select("_id", F.col("text").alias("_text"), "_label").orderBy(F.xxhash64("_id"), "_id", "_text").limit(sample_docs))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(docs, labels).collect()
    return fit([r["_text"] for r in rows], [int(r["_label"] > 0) for r in rows])


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents with ``score`` (0 to 1; higher: more likely toxic)."""

    def run(batches):
        known: dict[str, float] = {}
        for batch in batches:
            out, texts = [], batch[text]
            if model.curve is None:
                yield {"score": [model.constant] * len(texts)}
                continue
            for a in range(0, len(texts), SLICE_ROWS):
                cut = [tokens_of(t) for t in texts[a:a + SLICE_ROWS]]
                if len(known) > KEPT_TOKENS:
                    known = {}
                fresh = list(dict.fromkeys(t for ts in cut for t in ts if t not in known))
                known.update(zip(fresh, model.margins(fresh).tolist()))
                lengths = np.array([len(ts) for ts in cut], np.int64)
                flat = np.fromiter((known[t] for ts in cut for t in ts), float, int(lengths.sum()))
                out.append(model.score(document_features(flat, lengths, model.bias)))
            yield {"score": np.concatenate(out).tolist() if out else []}

    return map_columns(docs, run, [text], [("score", T.DoubleType())], slice_bytes=SLICE_BYTES)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``scored``."""
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
