"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is escaped as the model does it (a leading space, spaces as the meta
symbol) and cut where no piece can cross: before runs of spaces, around line
breaks. Distinct words of a batch are encoded once. Words of equal length
advance together: rolling substring hashes probe the sorted keys of the pieces
of each length (hits are compared character by character), and one vectorised
maximum per position stores the best last piece. The best segmentation has the
largest sum of piece scores; of equal sums the one with the longest last piece
wins. Characters without a piece become byte pieces. All work is narrow.

Defined results: null and empty texts have no pieces and decode to the empty
text; the meta symbol itself is read as a space, unpaired surrogates cannot
occur in Spark strings; extra columns are carried along, columns of the output
names are replaced. The model file is read on the driver; its table (bounded by
the vocabulary) travels with the tasks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, list_array, map_columns, sha_of, slices

#: Place of the public model; a parameter of every function here.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
#: Penalty below the lowest piece for a character without a piece.
UNKNOWN_PENALTY = 10.0
#: Characters of one Viterbi block, and words kept encoded by a task.
BLOCK_CHARS = 1 << 17
KEPT_WORDS = 300_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Piece table: per length the sorted substring hashes with ids and code points."""

    longest: int
    keys: dict
    scores: np.ndarray
    unknown: float
    surface: list
    byte_id: np.ndarray
    cut_lines: bool

    @staticmethod
    def load(path: str = MODEL_PATH) -> Pieces:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        scores = np.array([model.get_score(i) for i in range(size)], np.float64)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        is_byte = [model.is_byte(i) for i in range(size)]
        normal = [i for i in range(size) if not special[i] and not is_byte[i]]
        if any(a != META and b == META for i in normal for a, b in zip(names[i], names[i][1:])):
            raise ValueError("pieces with a space inside or at their end are not supported")
        byte_id = np.full(256, model.unk_id(), np.int32)
        surface = [b""] * size
        for i in range(size):
            if is_byte[i]:
                value = int(names[i][3:5], 16)
                byte_id[value], surface[i] = i, bytes([value])
            elif not special[i]:
                surface[i] = names[i].replace(META, " ").encode()
        keys = {}
        for n in sorted({len(names[i]) for i in normal}):
            ids = np.array([i for i in normal if len(names[i]) == n], np.int32)
            points = np.array([[ord(c) for c in names[i]] for i in ids], np.uint32)
            value = _window_hashes(points, n)[:, 0]
            order = np.argsort(value, kind="stable")
            if len(np.unique(value)) < len(value):
                raise ValueError("two pieces share a hash")
            keys[n] = (value[order], ids[order], points[order])
        return Pieces(max(keys, default=1), keys, scores, float(scores[normal].min()) - UNKNOWN_PENALTY if normal else 0.0,
                      surface, byte_id, not any("\n" in names[i] for i in normal))


def _window_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all substrings of length n: rows x starts."""
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    width = points.shape[1] - n + 1
    out = np.zeros((len(points), max(width, 0)), np.uint64)
    for j in range(n if width > 0 else 0):
        out = out * _BASE + mixed[:, j:j + width]
    return out


def viterbi(points: np.ndarray, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Best last piece (id, or -1 for a character without one) and its length at each end, for words of equal length."""
    rows, length = points.shape
    top = min(table.longest, length)
    gain = np.full((rows, length, top), -np.inf)  # by end and by start (start = end - top + k)
    piece = np.full((rows, length, top), -1, np.int32)
    gain[:, :, top - 1] = table.unknown
    for n, (keys, ids, known) in table.keys.items():
        if n > length:
            continue
        value = _window_hashes(points, n)
        at = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
        r, s = np.nonzero(keys[at] == value)
        if not len(r):
            continue
        at = at[r, s]
        same = (points[r[:, None], s[:, None] + np.arange(n)] == known[at]).all(1)
        r, s, at = r[same], s[same], at[same]
        gain[r, s + n - 1, top - n] = table.scores[ids[at]]
        piece[r, s + n - 1, top - n] = ids[at]
    best = np.full((rows, top + length), -np.inf)  # best[:, top + e - 1]: up to end e
    best[:, top - 1] = 0.0
    last, width = np.empty((rows, length), np.int32), np.empty((rows, length), np.int32)
    every = np.arange(rows)
    for e in range(length):
        reach = best[:, e:e + top] + gain[:, e]
        k = reach.argmax(1)  # the first of equal ones: the longest piece
        best[:, top + e] = reach[every, k]
        last[:, e], width[:, e] = piece[every, e, k], top - k
    return last, width


def encode_words(words: list[str], table: Pieces) -> list[np.ndarray]:
    """Piece ids of each word."""
    out: list = [None] * len(words)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, members in by_length.items():
        if not length:
            for i in members:
                out[i] = np.zeros(0, np.int32)
            continue
        per = max(1, BLOCK_CHARS // length)
        for a in range(0, len(members), per):
            block = members[a:a + per]
            points = np.frombuffer("".join(words[i] for i in block).replace(" ", META).encode("utf-32-le"), np.uint32).reshape(len(block), length)
            last, width = viterbi(points, table)
            at = np.full(len(block), length - 1)
            live = np.arange(len(block))
            steps: list[list] = [[] for _ in block]
            while len(live):
                ids, size = last[live, at[live]], width[live, at[live]]
                for j, p, e in zip(live.tolist(), ids.tolist(), at[live].tolist()):
                    steps[j].append(p if p >= 0 else ~int(points[j, e]))
                at[live] -= size
                live = live[at[live] >= 0]
            for i, back in zip(block, steps):
                ids = []
                for p in reversed(back):
                    if p >= 0:
                        ids.append(p)
                    else:
                        ids.extend(table.byte_id[b] for b in chr(~p).encode())
                out[i] = np.array(ids, np.int32)
    return out


class Encoder:
    """Encodes texts, keeping a bounded number of words encoded."""

    def __init__(self, table: Pieces):
        self.table = table
        self.cut = re.compile(r"\n| +[^ \n]*|[^ \n]+" if table.cut_lines else r" +[^ ]*").findall
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def batch(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Flat piece ids of the texts, and their number for each."""
        cut = [self.cut(" " + t.replace(META, " ")) if t else [] for t in texts]
        if len(self.index) > KEPT_WORDS:
            self.reset()
        fresh = list(dict.fromkeys(w for ws in cut for w in ws if w not in self.index))
        if fresh:
            ids = encode_words(fresh, self.table)
            sizes = np.array([len(x) for x in ids], np.int64)
            self.index.update(zip(fresh, range(len(self.starts), len(self.starts) + len(fresh))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, *ids])
        n_words = np.array([len(ws) for ws in cut], np.int64)
        at = np.fromiter((self.index[w] for ws in cut for w in ws), np.int64, int(n_words.sum()))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_words)])]
        return flat, np.diff(upto)


def encode(docs: DataFrame, model_path: str = MODEL_PATH, text: str = "text") -> DataFrame:
    """Documents with ``ids``, the piece ids of the whole text."""
    table = Pieces.load(model_path)

    def run(batches):
        encoder = Encoder(table)
        for batch in batches:
            flat, counts = encoder.batch(batch[text])
            yield {"ids": list_array(flat, counts, pa.int32())}

    return map_columns(docs, run, [text], [("ids", T.ArrayType(T.IntegerType()))], slice_bytes=SLICE_BYTES)


def decode_ids(ids: list[int] | None, surface: list[bytes]) -> str:
    value = b"".join([surface[i] for i in ids or ()]).decode("utf-8", "replace")
    return value[1:] if value.startswith(" ") else value


def decode(tokens: DataFrame, model_path: str = MODEL_PATH, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Rows with ``out``, the text of their piece ids."""
    table = Pieces.load(model_path)

    def run(batches):
        for batch in batches:
            yield {out: [decode_ids(x, table.surface) for x in batch[ids]]}

    return map_columns(tokens, run, [ids], [(out, T.StringType())])


class Surfaces:
    """Texts of flat piece ids, as bytes, without a Python object for each id."""

    def __init__(self, surface: list[bytes]):
        self.size = np.array([len(b) for b in surface], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(surface), np.uint8)

    def texts(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each row's ids, without the blank it begins with."""
        sizes = self.size[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.data[np.repeat(self.start[flat] - (ends - sizes), sizes) + np.arange(total)]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        some = np.diff(upto) > 0
        drop = upto[:-1][some]
        drop = drop[data[drop] == 0x20]
        kept = np.ones(total, bool)
        kept[drop] = False
        offsets = upto - np.searchsorted(drop, upto)
        out = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[kept].tobytes()))
        try:
            out.validate(full=True)
            return out
        except pa.ArrowInvalid:  # ids that are no encoding of a text may hold broken characters
            whole = data[kept].tobytes()
            return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.string())


def coded(docs: DataFrame, model_path: str = MODEL_PATH, text: str = "text") -> DataFrame:
    """Documents with ``ids``, the piece ids of the whole text, and ``decoded``, the text of those
    ids: ``decode(encode(docs))`` in one pass, slice by slice, with the ids as flat arrays."""
    table = Pieces.load(model_path)
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    at = keep.index(text)
    frame = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)])
    schema = T.StructType([T.StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches):
        encoder, surfaces = Encoder(table), Surfaces(table.surface)
        for batch in batches:
            for piece in slices(batch, at, SLICE_BYTES):
                flat, counts = encoder.batch(piece.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(piece.columns + [list_array(flat, counts, pa.int32()), surfaces.texts(flat, counts)],
                                                 names=schema.names)

    return frame.mapInArrow(run, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "ids", "decoded")


def digest(tokens: DataFrame) -> DataFrame:
    """Per document its ids, their number, and whether decoding gives the text back (the meta symbol as a space)."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), META, " ")
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", sha_of(F.col("decoded")).alias("decoded_sha256"),
                         (F.col("decoded") == text).alias("round_trip"))
