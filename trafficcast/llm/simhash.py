"""SimHash near-duplicates with pivot distance tables.

A fingerprint is the bitwise majority over the XXH64 values of all word shingles of the whole text.
Two fingerprints with at most `max_bits` differing bits agree on all but `max_bits` of any blocks
their bits are cut into; with two more blocks than that, every link agrees on some two blocks, so
one table per pair of blocks brings all links together and no exact link is lost. Within a table's
bucket each fingerprint gets its Hamming distances to a fixed set of reference fingerprints; by the
triangle inequality two fingerprints whose distances to any reference differ by more than
`max_bits` cannot link, and only pairs that survive this are compared. Buckets hand on a spanning
forest of their links, not all pairs; a bucket above BUCKET fingerprints is dealt out by pairs of
chunks, which together still compare every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import LOWER, SPACE, mixed, pick, slices, spans, text_bytes
from trafficcast.llm.common import arrow_map, documents, keyed, staged
from trafficcast.llm.components import connected_components
from trafficcast.llm.xxh import xxh64

BUCKET = 2048
PIVOTS = mixed(np.arange(1, 9, dtype=np.uint64))
#: Buckets up to this size compare all their pairs in one vector.
_SMALL = 8
_MOST = 65535
_SPREAD = np.array([sum(((v >> b) & 1) << (16 * b) for b in range(4)) for v in range(16)], np.uint64)


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A-Z lower-cased, words joined by one space: bytes, word starts and lengths, words per text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, owner = spans(~SPACE[data], offsets)
    lengths = ends - starts
    joined = pick(np.append(data, np.uint8(32)), starts, lengths + 1)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    joined[begin + lengths] = 32
    return joined, begin, lengths, np.bincount(owner, minlength=len(column))


def fingerprints_of(column: pa.Array, words: int) -> np.ndarray:
    """Fingerprint of each text of one slice."""
    joined, begin, lengths, counts = normalised(column)
    result = np.zeros(len(column), np.uint64)
    if not len(begin):
        return result
    shingles = np.where(counts >= words, counts - words + 1, counts > 0)
    first = np.cumsum(counts) - counts
    head = pick(np.arange(len(begin)), first, shingles)
    tail = head + np.repeat(np.where(counts >= words, words, counts) - 1, shingles)
    h = xxh64(joined, begin[head], begin[tail] + lengths[tail] - begin[head])
    # Sixteen-bit lanes count the set bits of up to 65,535 shingles; longer texts take several runs.
    runs = -(-shingles // _MOST)
    owner = np.repeat(np.arange(len(column)), runs)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    cuts = np.repeat(np.cumsum(shingles) - shingles, runs) + turn * _MOST
    lanes = np.empty((len(cuts), 16), np.uint64)
    for k in range(16):
        part = ((h >> np.uint64(4 * k)) & np.uint64(15)).astype(np.intp)
        lanes[:, k] = np.add.reduceat(_SPREAD[part], cuts)
    votes = np.zeros((len(column), 64), np.int64)
    np.add.at(votes, owner, lanes.view("<u2").reshape(len(cuts), 64).astype(np.int64))
    bits = 2 * votes > shingles[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(key, fp) of every row; fp is the 64-bit fingerprint as a long, 0 for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = fingerprints_of(part.column("text"), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found)], names=[key, "fp"])

    return arrow_map(keyed(docs, key, text), run, key, "fp long")


def _tables(max_bits: int) -> list[list[int]]:
    """Bit masks of every pair of blocks, as (mask, ...) of two's complement longs."""
    blocks = max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [(a | b) - (1 << 64 if (a | b) >> 63 else 0) for a, b in combinations(masks, 2)]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS).astype(np.int8)


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints."""
    table = pivot_table(fps)
    left = np.arange(len(fps))
    heads, tails = [], []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        i = queue.pop()
        near = left[np.abs(table[left] - table[i]).max(axis=1, initial=0) <= max_bits]
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]
        if len(near):
            heads.append(np.full(len(near), fps[i]))
            tails.append(fps[near])
            queue += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *heads]), np.concatenate([none, *tails])


def bucket_links(fps: np.ndarray, sizes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within consecutive buckets of the given sizes."""
    starts = np.cumsum(sizes) - sizes
    heads, tails = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    table = pivot_table(fps)
    for size in range(2, _SMALL + 1):
        at = starts[sizes == size]
        if len(at):
            a, b = np.triu_indices(size, 1)
            a, b = (at[:, None] + a).ravel(), (at[:, None] + b).ravel()
            stay = np.abs(table[a] - table[b]).max(axis=1) <= max_bits
            a, b = a[stay], b[stay]
            stay = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
            heads.append(fps[a[stay]])
            tails.append(fps[b[stay]])
    for start, size in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist(), strict=True):
        u, v = _forest(np.unique(fps[start : start + size]), max_bits)
        heads.append(u)
        tails.append(v)
    return np.concatenate(heads), np.concatenate(tails)


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v): links among distinct fingerprints `fp` that connect all those within `max_bits`."""
    tables = F.array(
        *(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("b")) for i, m in enumerate(_tables(max_bits)))
    )
    rows = distinct.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.b")
    hot = rows.groupBy("t", "b").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET)
    hot = staged(hot.select("t", "b", F.ceil(F.col("n") / F.lit(BUCKET)).alias("chunks")), "hot")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    dealt = (
        rows.join(hot, ["t", "b"], "left")
        .withColumn("mine", F.coalesce(chunk, F.lit(0)))
        .withColumn("other", other)
        .select("fp", "t", "b", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    )
    bucket = F.xxhash64("t", "b", "lo", "hi")
    # A bucket is named by its hash: buckets that share a name are compared together, which adds work, not links.
    rows = dealt.select(bucket.alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_b, kept_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def found(b, f):
            edges = np.flatnonzero(np.diff(b)) + 1
            sizes = np.diff(np.concatenate([[0], edges, [len(b)]]))
            u, v = bucket_links(f, sizes, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            b = np.concatenate([kept_b, batch.column("bucket").to_numpy()])
            f = np.concatenate([kept_f, batch.column("fp").to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(b, b[-1])) if len(b) else 0
            kept_b, kept_f = b[whole:], f[whole:]
            if whole:
                yield found(b[:whole], f[:whole])
        if len(kept_b):
            yield found(kept_b, kept_f)

    return rows.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """(key, fp, component_id) of every row; component_id is the smallest key it can reach.

    Texts without words have fingerprint 0 and link like any other; shorter texts than a shingle are
    one shingle. Repeated rows stay and share a component; null keys are never a component's name
    unless all its keys are null; an empty table gives none; other columns are ignored. Writes the
    fingerprints and the rounds of the component search to the shared folder when called.
    """
    prints = staged(fingerprints(docs, key, text, words), "fingerprints")
    least = staged(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = connected_components(links(least.select("fp"), max_bits))
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(key, "fp", "component_id")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of `docs`, all columns, without those whose component has a document of a smaller key.

    A document is a key with a text: rows of one key and other texts are judged each for itself, in
    the order of a hash; rows that repeat key and text are one document and stay or go together.
    Documents without a key come after all others. An empty table gives none.
    """
    mark = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    name = F.struct(docs[key].isNull().alias("lacking"), docs[key].alias("key"), mark.alias("mark"))
    found = near_duplicates(docs.select(name.alias("name"), docs[text].alias("text")), "name", "text", words, max_bits)
    others = found.where("name <> component_id").select(F.col("name.key").alias("__key"), F.col("name.mark").alias("__mark"))
    marked = docs.withColumn("__at", mark)
    same = (F.col("__at") == F.col("__mark")) & F.col(f"`{key}`").eqNullSafe(F.col("__key"))
    return marked.join(others, same, "left_anti").drop("__at")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
