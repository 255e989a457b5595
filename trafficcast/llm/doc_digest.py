"""Document fingerprints: a quartile bucket digest of byte triplets.

Every three consecutive bytes are hashed to one of 128 buckets. The digest states for each bucket
in which quartile of the text's own bucket counts it lies (two bits), then the length on a
logarithmic scale (one byte), as hex. Two digests differ by the sum of their quartile steps and a
capped length step; likeness is one minus that difference over the difference of unrelated texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import slices
from trafficcast.llm.common import documents, keyed, staged

BUCKETS = 128
#: Expected steps between two unrelated digests (5/4 a bucket), and the most that length counts.
FAR = BUCKETS * 5 // 4
FAR_LENGTH = 16


def digest(texts: list[bytes]) -> np.ndarray:
    """Rows of BUCKETS quartile codes and one length code."""
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    for i, text in enumerate(texts):
        if len(text) > 2:
            b = np.frombuffer(text, np.uint8).astype(np.uint32)
            h = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1)
            counts[i] = np.bincount((h >> np.uint32(25)).astype(np.intp), minlength=BUCKETS)
    ranked = np.sort(counts, axis=1)
    codes = np.zeros((len(texts), BUCKETS + 1), np.uint8)
    for quarter in (1, 2, 3):
        codes[:, :BUCKETS] += counts > ranked[:, [BUCKETS * quarter // 4 - 1]]
    codes[:, BUCKETS] = np.minimum(np.round(8 * np.log2(1 + sizes)), 255)
    return codes


def written(codes: np.ndarray) -> list[str]:
    """Digests as hex: four buckets a byte, then the length."""
    quads = codes[:, :BUCKETS].reshape(len(codes), BUCKETS // 4, 4)
    packed = (quads << np.array([6, 4, 2, 0], np.uint8)).sum(axis=2, dtype=np.uint8)
    return [bytes(row).hex() for row in np.concatenate([packed, codes[:, BUCKETS:]], axis=1)]


def read_back(text: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(text), np.uint8)
    return np.append(((packed[:-1, None] >> np.array([6, 4, 2, 0])) & 3).ravel(), packed[-1]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, from 0 (as far apart as unrelated texts, or more) to 1 (equal digests)."""
    steps = np.abs(a.astype(np.int16) - b)
    far = steps[:, :BUCKETS].sum(axis=1) + np.minimum(steps[:, BUCKETS], FAR_LENGTH)
    return np.maximum(0.0, 1.0 - far / (FAR + FAR_LENGTH))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row; no shuffle. Null counts as empty; equal texts are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t.encode() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(written(digest(texts)), pa.string())], names=["key", "fingerprint"])

    plain = keyed(docs, key, text)
    found = plain.mapInArrow(run, f"key {plain.schema['key'].dataType.simpleString()}, fingerprint string")
    return found.withColumnRenamed("key", key)


def edited(text: str, after: str) -> str:
    """The last quarter (rounded down) replaced by as much of the start of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


_COLUMNS = [
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]


def _compared(keys: list, texts: list[str], nexts: list[str], codes: np.ndarray, next_codes: np.ndarray, place: list) -> pa.RecordBatch:
    """One row a text; `place` is (edge, part) for rows at the ends of a partition."""
    changed = [edited(t, n).encode() for t, n in zip(texts, nexts, strict=True)]
    other = digest(changed)
    values = [
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        written(codes),
        written(other),
        likeness(codes, other),
        likeness(codes, next_codes),
    ]
    arrays = [keys, *(pa.array(v, kind) for v, (_, kind) in zip(values, _COLUMNS, strict=True))]
    edge, part, text = place
    arrays += [pa.array(edge, pa.int32()), pa.array(part, pa.int64()), pa.array(text, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["key", *(n for n, _ in _COLUMNS), "edge", "part", "text"])


def _edge(key: pa.Array, kind: int, part: int, text: str) -> pa.RecordBatch:
    arrays = [key, *(pa.nulls(1, k) for _, k in _COLUMNS), pa.array([kind], pa.int32()), pa.array([part], pa.int64()), pa.array([text])]
    return pa.RecordBatch.from_arrays(arrays, names=["key", *(n for n, _ in _COLUMNS), "edge", "part", "text"])


def neighbour_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's digest next to those of its edited text and of the next row by ascending key.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every
    row; the row after the last is the first, a single row follows itself. Null text counts as
    empty, null keys come first, rows of one key follow each other by text; an empty table gives
    none; other columns are ignored. The key must be orderable.

    Texts are range-partitioned by key and sorted once; each task compares neighbours as they pass.
    Only the first and last text of every partition are set aside and joined in a second step, the
    last of one with the first of the next that has rows; the driver sees the partitions' numbers.
    Writes when called.
    """
    plain = keyed(docs, key, text)
    kind = plain.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edge int, part long, text string"

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pending = None
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, texts = batch.column("key"), batch.column("text").to_pylist()
                codes = digest([t.encode() for t in texts])
                if pending is None:
                    yield _edge(keys.slice(0, 1), 0, part, texts[0])
                else:
                    keys = pa.concat_arrays([pending[0], keys])
                    texts, codes = [pending[1], *texts], np.concatenate([pending[2], codes])
                n = len(texts) - 1
                if n:
                    nothing = [None] * n
                    yield _compared(keys.slice(0, n), texts[:-1], texts[1:], codes[:-1], codes[1:], (nothing, nothing, nothing))
                pending = keys.slice(n, 1), texts[-1], codes[-1:]
        if pending is not None:
            yield _edge(pending[0], 1, part, pending[1])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts, nexts = batch.column("text").to_pylist(), batch.column("after").to_pylist()
                codes, next_codes = (digest([t.encode() for t in column]) for column in (texts, nexts))
                nothing = [None] * len(texts)
                yield _compared(batch.column("key"), texts, nexts, codes, next_codes, (nothing, nothing, nothing))

    ordered = plain.repartitionByRange("key").sortWithinPartitions("key", "text")
    inside = staged(ordered.mapInArrow(inner, schema), "digests")
    firsts = inside.where("edge = 0").select(F.col("part").alias("onto"), F.col("text").alias("after"))
    parts = sorted(r.onto for r in firsts.select("onto").collect())
    order = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part long, onto long")
    # A row for each partition.
    ends = inside.where("edge = 1").select("key", "part", "text").join(F.broadcast(order), "part").join(firsts, "onto").select("key", "text", "after")
    result = inside.where("edge is null").unionByName(ends.mapInArrow(across, schema))
    return result.drop("edge", "part", "text").withColumnRenamed("key", key)


def op6_digests(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_digests(documents(spark, folder))
