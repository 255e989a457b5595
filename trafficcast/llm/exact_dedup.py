"""Exact dedup by composable polynomial fingerprints and chunkwise comparison.

A text's white space runs become one space each. Its bytes are read as 32-bit symbols w0, w1, ... and
its fingerprint is the sum of (wi + 1) * B^i modulo 2^61 - 1. Chunks are hashed side by side in numpy,
as if each stood first, and combined by shifting each by the symbols before it:
H(xy) = H(x) + B^|x| * H(y). So a huge text costs no more memory than a chunk beyond itself.

Equal fingerprints (with equal byte lengths) are only candidates. Their texts are cut into chunks, and
the least and the greatest chunk at each place are found by a grouped aggregation in the JVM, which
combines in every task before it shuffles: a group of any size reaches the shuffle as one row per
task and chunk. A group whose extremes agree everywhere is one text. In any other group the chunks
prove a collision, and its texts are told apart by their SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.llm.bytesops import slices, text_bytes
from trafficcast.llm.common import documents, staged

PRIME = (1 << 61) - 1
BASE = int.from_bytes(b"exact-up", "big") % PRIME
#: Symbols hashed at once, and characters of a text that are compared at once.
CHUNK_SYMBOLS = 1 << 14
CHUNK_CHARS = 1 << 16
#: A group with more than this share of all rows is joined by broadcast; there are at most so many such groups.
HOT_GROUPS = 10_000

_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)
_powers: list[np.ndarray] = []


def _chunk_powers() -> tuple[np.ndarray, np.ndarray]:
    """B^0, B^1, ... of one chunk, as low and high halves."""
    if not _powers:
        values, power = [], 1
        for _ in range(CHUNK_SYMBOLS):
            values.append(power)
            power = power * BASE % PRIME
        whole = np.array(values, np.uint64)
        _powers.extend([whole & _LOW, whole >> _HALF])
    return _powers[0], _powers[1]


def combined(first: int, symbols: int, second: int) -> int:
    """Fingerprint of two texts in a row, the first one of so many symbols."""
    return (first + pow(BASE, symbols, PRIME) * second) % PRIME


def fingerprints(column: pa.Array) -> np.ndarray:
    """Fingerprint of each text; zero bytes fill its last symbol."""
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    symbols = (sizes + 3) // 4
    ends = np.cumsum(symbols)
    begins = ends - symbols
    total = int(ends[-1]) if len(ends) else 0
    padded = np.zeros(4 * total, np.uint8)
    padded[np.arange(len(data)) + np.repeat(4 * begins - offsets[:-1], sizes)] = data
    chunks = (symbols + CHUNK_SYMBOLS - 1) // CHUNK_SYMBOLS
    owner = np.repeat(np.arange(len(symbols)), chunks)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = begins[owner] + order * CHUNK_SYMBOLS
    hashes = [0] * len(symbols)
    if total:
        sums = _sums(padded.view("<u4").astype(np.uint64) + np.uint64(1), starts)
        shift = pow(BASE, CHUNK_SYMBOLS, PRIME)
        # From the last chunk of a text to its first.
        for i, value in zip(owner[::-1].tolist(), sums[::-1], strict=True):
            hashes[i] = (hashes[i] * shift + value) % PRIME
    return np.array(hashes, np.int64)


def _sums(symbols: np.ndarray, starts: np.ndarray) -> list[int]:
    """Sum of symbol times power modulo the prime from each start to the next."""
    low, high = _chunk_powers()
    place = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
    parts = [symbols * low[place], symbols * high[place]]
    halves = [np.add.reduceat(half, starts).tolist() for part in parts for half in (part & _LOW, part >> _HALF)]
    return [(a + (b << 32) + (c << 32) + (d << 64)) % PRIME for a, b, c, d in zip(*halves, strict=True)]


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _with_fingerprints(texts: DataFrame, keep_text: bool) -> DataFrame:
    """Adds fp and n_bytes of `text`, which goes unless it is to be kept."""
    fields = [f for f in texts.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*fields, T.StructField("fp", T.LongType()), T.StructField("n_bytes", T.LongType())])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                sizes = np.diff(text_bytes(column)[1])
                arrays = [*(part.column(n) for n in names), pa.array(fingerprints(column)), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return texts.mapInArrow(run, schema)


def colliding(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(fp, n_bytes) of the candidates whose texts are not all the same, by comparing them chunk by chunk."""
    count = F.floor((F.char_length("text") + F.lit(CHUNK_CHARS - 1)) / CHUNK_CHARS).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
        lambda i: F.substring(F.col("text"), i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS)),
    )
    found = _with_fingerprints(texts.select("text"), keep_text=True).join(candidates, ["fp", "n_bytes"], "left_semi")
    chunks = found.select("fp", "n_bytes", F.posexplode(pieces).alias("place", "chunk"))
    extremes = chunks.groupBy("fp", "n_bytes", "place").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return extremes.where(F.col("least") != F.col("most")).select("fp", "n_bytes").distinct()


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal if they are after every run of white space became one space; null counts as the
    empty text. The row with the smallest key stays; of rows that share it, one; null keys come last,
    and a group of null keys alone has a null keep_id. group_size counts rows. An empty table gives no
    rows; other columns are ignored.
    """
    plain = docs.select(docs[key].alias("key"), normalised(docs[text]).alias("text"))
    rows = plain.select(
        F.monotonically_increasing_id().alias("row"), "key", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "text"
    )
    rows = staged(_with_fingerprints(rows, keep_text=False), "fingerprints")
    sizes = rows.groupBy("fp", "n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("fp", "n_bytes")
    split = staged(colliding(plain, staged(sizes, "equal-fingerprints")), "collisions")
    told = rows.join(split.withColumn("split", F.lit(True)), ["fp", "n_bytes"], "left").withColumn(
        "variant", F.when(F.col("split"), F.col("sha")).otherwise("")
    )
    same = ["fp", "n_bytes", "variant"]
    first = F.min(F.struct(F.col("key").isNull().alias("last"), F.col("key").alias("key"), F.col("row").alias("row")))
    groups = staged(told.groupBy(same).agg(F.count("*").alias("group_size"), first.alias("first")), "groups")
    # No more than HOT_GROUPS groups can have more than that share of the rows; no other group is large.
    least = groups.agg((F.coalesce(F.sum("group_size"), F.lit(0)) / HOT_GROUPS).alias("least")).first()["least"]
    hot = groups.where(F.col("group_size") > least) if least >= 1 else groups.limit(0)
    marked = told.join(F.broadcast(hot.withColumn("hot", F.lit(True))), same, "left")
    rest = marked.where("hot is null").drop("group_size", "first", "hot").join(groups, same)
    both = marked.where("hot").drop("hot").unionByName(rest)
    return both.select(
        F.col("key").alias(key),
        F.col("first.key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose key stays; rows of one key and text stay together."""
    gone = exact_copies(docs, key, text).where(~F.col(key).eqNullSafe(F.col("keep_id"))).select(key).distinct()
    return docs.join(gone, key, "left_anti")


OP13_SQL = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY t)
"""


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_copies(documents(spark, folder))
