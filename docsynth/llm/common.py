"""Helpers shared by the operators: byte-level words, Arrow tasks, checkpoints."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsynth.session import ensure_checkpoint_dir

#: ASCII letters lower-cased, every other ASCII byte outside [0-9a-z] a space;
#: bytes of multi-byte characters are word bytes.
_WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased (null: none)."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split() if text else []


def tokens(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (null: none).

    On bytes, ``lower`` changes A-Z only and ``split`` cuts at exactly these characters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def fold(doc_id, folds: int = 5) -> int:
    """crc32 of the id as text, modulo ``folds`` (null: of the empty text)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def map_columns(df: DataFrame, fn: Callable[[dict, int], Iterator[dict]], inputs: list[str],
                outputs: list[tuple[str, T.DataType]], keep: list[str] | None = None, slice_bytes: int | None = None) -> DataFrame:
    """Add ``outputs`` to every row, computed batch by batch from ``inputs`` inside tasks.

    ``fn`` gets an iterator of ``{input: python list}`` and yields, per batch and in
    order, ``{output: list or Arrow array}``. ``keep`` names the columns carried
    along (default: all); a kept column of an output's name is replaced. No shuffle.
    ``slice_bytes`` cuts batches into whole rows of so many bytes of the first input, a text column.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in {n for n, _ in outputs}]
    sent = keep + [c for c in inputs if c not in keep]  # each column once
    at = [sent.index(c) for c in inputs]
    frame = df.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(sent)])
    kept = T.StructType([T.StructField(f"_k{i}", df.schema[c].dataType) for i, c in enumerate(keep)])
    schema = T.StructType(kept.fields + [T.StructField(n, t) for n, t in outputs])
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = [to_arrow_type(t) for _, t in outputs]
    n_keep, names = len(keep), [n for n, _ in outputs]

    def run(batches):
        held = []

        def feed():
            for batch in batches:
                for b in [batch] if slice_bytes is None else slices(batch, at[0], slice_bytes):
                    held.append(b)
                    yield {c: b.column(i).to_pylist() for i, c in zip(at, inputs)}

        for out in fn(feed()):
            b = held.pop(0)
            cols = [b.column(i) for i in range(n_keep)]
            cols += [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, type=t)
                     for v, t in ((out[n], t) for n, t in zip(names, arrow))]
            yield pa.RecordBatch.from_arrays(cols, names=[f"_k{i}" for i in range(n_keep)] + names)

    out = frame.mapInArrow(run, schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *names)


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive whole rows of a batch, without copies: each piece holds at most
    ``limit`` bytes of the text column (a row counting 64 more), or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size + 64 > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 64
    if start < len(sizes):
        yield batch.slice(start)


#: Bytes of text that a task's Python works on at a time.
SLICE_BYTES = 1 << 20


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and per-row lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def sha_of(column) -> F.Column:
    """Lowercase hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
