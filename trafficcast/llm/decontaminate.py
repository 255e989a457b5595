"""Benchmark decontamination by winnowing.

Texts become words. Every K consecutive words hash to a gram; of each W consecutive grams the least
hash is kept, ties all together, so any two equal spans of K + W - 1 words keep the same gram at the
same place. Kept grams of the benchmark are the index; kept grams of the documents that the index
knows are joined to it, each with the words around it, and a hit is extended word by word to both
sides. A span of at least K + W - 1 words in common is a hit; nothing shorter is. Benchmark items
with fewer words than that have one gram of all their words, looked up at every place.

Documents are read once and never shuffled: rows carry grams only where a bit table of the index,
of fixed size, has them. Spark broadcasts the index if it is small enough by its own measure and
shuffles the hits otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficcast.llm.bytesops import LOWER, WORD, mixed, prefix_hash, slices, span_hash, spans, text_bytes
from trafficcast.llm.common import documents, keyed, staged

SPAN = 13
GRAM = 5
#: Size of the bit table, whatever the size of the benchmark.
TABLE_BITS = 20

_HITS = "array<struct<fp: bigint, at: int, lead: int, words: string>>"


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, word hashes, and the first word of each text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, owner = spans(WORD[data], offsets)
    first = np.searchsorted(owner, np.arange(len(column) + 1))
    return data, starts, ends, span_hash(prefix_hash(data), starts, ends), first


def grams(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of `size` words from each word on, and whether they lie in one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = mixed(total + words[k : k + n])
    owner = np.searchsorted(first, np.arange(len(words)), side="right")
    return total, owner[:n] == owner[size - 1 :]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each `width` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def winnowed(hashes: np.ndarray, valid: np.ndarray, width: int) -> np.ndarray:
    """Which grams are the least of some `width` consecutive grams of one text."""
    n = len(hashes)
    if n < width:
        return np.zeros(n, bool)
    least = _sliding(hashes, width, np.minimum)
    whole = _sliding(valid, width, np.logical_and)
    least = np.where(whole, least, 0)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    best = _sliding(padded, width, np.maximum)
    anywhere = _sliding(np.concatenate([np.zeros(width - 1, bool), whole, np.zeros(width - 1, bool)]), width, np.logical_or)
    return anywhere & (best == hashes) & valid


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Winnower:
    """Finds the grams of texts; on documents only those that the bit table has."""

    def __init__(self, span: int, gram: int, short: tuple[int, ...] = (), table: bytes | None = None):
        self.span, self.gram, self.short, self.table = span, gram, short, table

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.table, np.uint8)
        at = _bit(hashes)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

    def found(self, column: pa.Array, benchmark: bool) -> tuple[np.ndarray, list[list[dict]]]:
        data, starts, ends, words, first = word_spans(column)
        counts = np.diff(first)
        raw = data.tobytes()
        rows: list[list[dict]] = [[] for _ in counts]
        reach = self.span - self.gram
        wanted = [(self.gram, reach)] + [(m, 0) for m in self.short]
        for size, around in wanted:
            hashes, valid = grams(words, first, size)
            keep = winnowed(hashes, valid, around + 1) if around else valid
            if self.table is not None:
                keep = keep.copy()
                keep[keep] = self._known(hashes[keep])
            at = np.flatnonzero(keep)
            owner = np.searchsorted(first, at, side="right") - 1
            if benchmark and not around:
                fits = counts[owner] == size
                at, owner = at[fits], owner[fits]
            elif benchmark:
                fits = counts[owner] >= self.span
                at, owner = at[fits], owner[fits]
            low = np.maximum(first[owner], at - around)
            high = np.minimum(first[owner + 1], at + size + around)
            for i, o, a, b, h in zip(at.tolist(), owner.tolist(), low.tolist(), high.tolist(), hashes[at].view(np.int64).tolist(), strict=True):
                text = b" ".join(raw[starts[w] : ends[w]] for w in range(a, b)).decode("utf-8", "replace")
                rows[o].append({"fp": h, "at": i - int(first[o]), "lead": i - a, "words": text})
        return counts, rows

    def scan(self, benchmark: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("words", pa.string())]))
            for batch in batches:
                for part in slices(batch, "text"):
                    counts, rows = self.found(part.column("text"), benchmark)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), part.column("mark"), pa.array(counts.astype(np.int64)), pa.array(rows, kind)],
                        names=["key", "mark", "n_words", "hits"],
                    )

        return run


def _scanned(table: DataFrame, key: str, text: str, run) -> DataFrame:
    plain = keyed(table, key, text).withColumn("mark", F.xxhash64("key", "text"))
    fields = [T.StructField("key", plain.schema["key"].dataType)]
    schema = T.StructType(fields + T.StructType.fromDDL(f"mark long, n_words long, hits {_HITS}").fields)
    return plain.mapInArrow(run, schema)


def _lengths(benchmark: DataFrame, item: str, text: str, span: int, gram: int) -> tuple[int, ...]:
    """The word counts of items shorter than a span; at most span - 1 numbers."""
    counted = _scanned(benchmark, item, text, Winnower(span, gram).scan(True))
    rows = counted.where(f"n_words > 0 and n_words < {span}").select("n_words").distinct().collect()
    return tuple(sorted(r[0] for r in rows))


def benchmark_index(benchmark: DataFrame, item: str = "item_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, tuple[int, ...], bytes]:
    """The staged index (fp, lead, words, items), the short item lengths and the bit table."""
    short = _lengths(benchmark, item, text, span, gram)
    found = _scanned(benchmark, item, text, Winnower(span, gram, short).scan(True))
    rows = found.select(F.col("key").cast("string").alias("item"), F.explode("hits").alias("h"))
    index = rows.groupBy("h.fp", "h.lead", "h.words").agg(F.collect_set("item").alias("items"))
    index = staged(index.select("fp", F.col("lead").alias("i_lead"), F.col("words").alias("i_words"), "items"), "index")
    bits = np.zeros(1 << TABLE_BITS, np.uint8)
    places = index.select(F.shiftrightunsigned("fp", 64 - TABLE_BITS).alias("b")).distinct()
    bits[[r[0] for r in places.collect()]] = 1
    return index, short, np.packbits(bits, bitorder="little").tobytes()


def _extend(span: int, gram: int):
    """Hits as (start, end) in words of the document; null where the words do not bear the hash out."""

    def reach(a: list[str], b: list[str]) -> int:
        n = 0
        while n < len(a) and n < len(b) and a[n] == b[n]:
            n += 1
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("at", "lead", "words", "i_lead", "i_words")]
            starts: list[int | None] = []
            ends: list[int | None] = []
            for at, lead, words, i_lead, i_words in zip(*columns, strict=True):
                start = end = None
                if i_words is not None:
                    mine, other = words.split(" "), i_words.split(" ")
                    right = reach(mine[lead:], other[i_lead:])
                    left = reach(mine[:lead][::-1], other[:i_lead][::-1])
                    # A gram of fewer words than a span is long enough only as a whole short item.
                    need = span if len(other) >= span else len(other)
                    if left + right >= need:
                        start, end = at - left, at + right
                starts.append(start)
                ends.append(end)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "mark", "n_words", "items")), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["key", "mark", "n_words", "items", "start", "end"],
            )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """(key, n_words, n_hit, spans, items) of every document.

    A document word is hit if it lies in an occurrence of `span` consecutive words of an item, or of
    a whole item with fewer words. `spans` are the hit stretches [start, end) as found, sorted,
    `items` the items with an occurrence, as sorted strings. Null and empty texts have no words and no hits,
    on either side; rows that repeat key and text give one row each... of equal result; null keys
    are a key of their own; empty tables give no rows or no hits; other columns are ignored.
    """
    index, short, table = benchmark_index(benchmark, item, item_text, span, gram)
    scanned = _scanned(docs, key, text, Winnower(span, gram, short, table).scan(False))
    rows = scanned.groupBy("key", "mark").agg(F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("hits").alias("hits"))
    flat = rows.select("key", "mark", "copies", "n_words", F.explode_outer("hits").alias("h")).select("key", "mark", "copies", "n_words", "h.*")
    return _hits(flat, index, key, span, gram)


def _hits(flat: DataFrame, index: DataFrame, key: str, span: int, gram: int) -> DataFrame:
    # Documents without a candidate join on their own mark, which spreads them, and match nothing.
    name = F.coalesce(flat["fp"], flat["mark"])
    joined = flat.join(index, (name == index["fp"]) & flat["fp"].isNotNull(), "left").drop(index["fp"])
    packed = joined.withColumn("n_words", F.struct("copies", "n_words"))
    kind = joined.schema["key"].dataType
    schema = T.StructType(
        [T.StructField("key", kind)]
        + T.StructType.fromDDL("mark long, n_words struct<copies: bigint, n_words: bigint>, items array<string>, start long, end long").fields
    )
    found = packed.select("key", "mark", "n_words", "items", "at", "lead", "words", "i_lead", "i_words").mapInArrow(_extend(span, gram), schema)
    hit = F.col("start").isNotNull()
    merged = found.groupBy("key", "mark").agg(
        F.first("n_words").alias("n"),
        F.array_sort(F.collect_set(F.when(hit, F.struct("start", "end")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))).alias("items"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda a, s: F.struct(
            (a["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).alias("total"),
            F.greatest(a["upto"], s["end"]).alias("upto"),
        ),
        lambda a: a["total"],
    )
    return merged.select(
        F.col("key").alias(key), F.col("n.n_words").alias("n_words"), covered.alias("n_hit"), "spans", "items",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n.copies"))).alias("_copy"),
    ).drop("_copy")


def flagged(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds contaminated: hit words are at least one in `share`."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = flagged(contamination(documents(spark, folder), documents(spark, folder, "benchmark")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
