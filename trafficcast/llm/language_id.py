"""Language identification by Bayesian evidence fusion.

log P(language | page) adds up four kinds of evidence: the likelihood of the text under byte
triplet counts of labelled texts; the language that the markup declares; the address suffix; and
the prior of the host, which is shrunk towards that of its domain, which is shrunk towards that of
all pages. The last three are learned from the pages by grouped sums of the text's own posterior,
and a page's own share is taken out of what it is judged by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import LOWER, slices, text_bytes
from trafficcast.llm.common import documents, staged

BUCKETS = 1 << 12
#: Neighbouring triplets share bytes; their log likelihoods are scaled down by this.
TEMPER = 0.3
#: Pages' worth of the wider prior that a host or domain starts with.
SHRINK = 5.0
#: Largest number of languages; the model is so many rows of BUCKETS numbers.
MOST_LANGUAGES = 256


def triplets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed lower-case byte triplets with signs and digits as blanks, and where each text's start."""
    data, offsets = text_bytes(column)
    low = LOWER[data]
    low = np.where((low >= 0x61) & (low <= 0x7A) | (low >= 0x80), low, np.uint8(32)).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
    h = ((low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]) * np.uint32(0x9E3779B1)
    sizes = np.maximum(np.diff(offsets) - 2, 0)
    where = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.repeat(offsets[:-1] - where[:-1], sizes) + np.arange(where[-1])
    return (h[inside] >> np.uint32(20)).astype(np.int64), where


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and log P(triplet | language), from counts over all labelled texts."""
    plain = docs.select(docs[lang].cast("string").alias("lang"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")).where("lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                h, where = triplets(part.column("text"))
                names = np.array(part.column("lang").to_pylist())
                for name in set(names.tolist()):
                    mine = np.repeat(names == name, np.diff(where))
                    totals[name] = totals.get(name, 0) + np.bincount(h[mine], minlength=BUCKETS)
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], names=["lang", "bucket", "n"])

    counts = plain.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = staged(counts, "triplets")
    names = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.ones((len(names), BUCKETS))
    found = counts.toArrow()
    if found.num_rows:
        at = np.searchsorted(names, np.array(found.column("lang").to_pylist()))
        np.add.at(table, (at, found.column("bucket").to_numpy()), found.column("n").to_numpy())
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(pages: DataFrame, table: np.ndarray) -> DataFrame:
    """Replaces `text` by `ll`, the tempered log likelihoods of the languages."""
    others = [f for f in pages.schema.fields if f.name != "text"]
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, where = triplets(part.column("text"))
                full = np.diff(where) > 0
                ll = np.zeros((len(part), len(table)))
                if full.any():
                    for i, row in enumerate(table):
                        ll[full, i] = np.add.reduceat(row[h].astype(np.float64), where[:-1][full])
                at = np.arange(len(part) + 1, dtype=np.int32) * len(table)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array((TEMPER * ll).ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), lists], names=[*names, "ll"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    return pages.mapInArrow(run, f"{kinds}, ll array<double>")


def page_parts(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, host, domain, suffix, declared, text) of every page, in column functions."""
    address, body = pages[url].cast("string"), F.coalesce(pages[html].cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce(address, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    declared = F.lower(F.regexp_extract(body, r"(?i)<html\b[^<>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", 1))
    # What is never closed runs to the end, and a tag ends before the next one: no place is scanned twice.
    text = F.regexp_replace(body, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    return pages.select(pages[key].alias("key"), host.alias("host"), declared.alias("declared"), text.alias("text")).select(
        "key", "host", F.substring_index("host", ".", -2).alias("domain"), F.substring_index("host", ".", -1).alias("suffix"), "declared", "text"
    )


def _sums(pages: DataFrame, by: list[str], name: str, languages: int) -> DataFrame:
    """Summed text posteriors of each group as one array."""
    sums = pages.groupBy(*by).agg(*(F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(languages)))
    return sums.select(*by, F.array(*(f"s{i}" for i in range(languages))).alias(name))


def identify(pages: DataFrame, languages: list[str], table: np.ndarray, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, lang, confidence, text_lang, declared) of every page.

    A page without text, address or declaration is judged by the evidence it has; null and empty
    values count as none. Ties go to the language first in the alphabet. Repeated rows and null keys
    give one row each, an empty table none; without any labelled text the language is null. Hosts
    join as one row a host, so a host with very many pages is split by Spark, never gathered.
    """
    n = len(languages)
    if not n:
        return page_parts(pages, key, url, html).select(
            F.col("key").alias(key), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"),
            F.lit(None).cast("string").alias("text_lang"), "declared",
        )
    top = F.array_max("ll")
    known = text_evidence(page_parts(pages, key, url, html), table)
    raw = known.withColumn("e", F.transform("ll", lambda x: F.exp(x - top)))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    known = staged(raw.withColumn("p", F.transform("e", lambda x: x / total)).drop("e"), "evidence")
    world = _sums(known, [], "w", n).where("w[0] is not null")
    places = {c: _sums(known, [c], f"{c}_sum", n) for c in ("host", "domain", "suffix", "declared")}
    # One row.
    joined = known.crossJoin(F.broadcast(world))
    for name, sums in places.items():
        joined = joined.join(sums, name)
    kinds = {c: places[c].count() for c in ("suffix", "declared")}
    each = F.sequence(F.lit(0), F.lit(n - 1))

    def less(sums: str, i: Column) -> Column:
        """A sum without the page's own share."""
        return F.greatest(F.col(sums)[i] - F.col("p")[i], F.lit(0.0))

    def amount(sums: str) -> Column:
        return F.aggregate(F.col(sums), F.lit(0.0), lambda a, x: a + x) - 1

    def shrunk(sums: str, wider):
        return lambda i: (less(sums, i) + SHRINK * wider(i)) / (F.greatest(amount(sums), F.lit(0.0)) + SHRINK)

    everywhere = lambda i: (less("w", i) + 1) / (amount("w") + n)
    prior = shrunk("host_sum", shrunk("domain_sum", everywhere))

    def given(name: str, i: Column) -> Column:
        """P(value | language), one page's worth spread over all values, and one more where a declaration names it."""
        own = F.when(F.col("declared") == F.array(*map(F.lit, languages))[i], 1.0).otherwise(0.0) if name == "declared" else F.lit(0.0)
        extra = 1.0 if name == "declared" else 0.0
        return (less(f"{name}_sum", i) + own + 1 / (kinds[name] + 1)) / (less("w", i) + 1 + extra)

    def evidence(i: Column) -> Column:
        found = F.col("ll")[i] + F.log(prior(i)) + F.log(given("suffix", i))
        return found + F.when(F.col("declared") == "", 0.0).otherwise(F.log(given("declared", i)))

    named = F.array(*map(F.lit, languages))
    fused = joined.select("key", "declared", "ll", F.transform(each, evidence).alias("f"))
    best = F.array_max("f")
    whole = F.aggregate("f", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("f")))
    return fused.select(
        F.col("key").alias(key),
        F.element_at(named, F.array_position("f", best).cast("int")).alias("lang"),
        (1 / whole).alias("confidence"),
        F.element_at(named, F.array_position("ll", F.array_max("ll")).cast("int")).alias("text_lang"),
        "declared",
    )


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    languages, table = train(documents(spark, folder))
    return identify(documents(spark, folder, "pages"), languages, table).withColumn("confidence", F.round("confidence", 6))
