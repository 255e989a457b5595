"""How the sources of a language differ in their words.

Identical texts of a language are first collapsed into one row with the number of documents that each
source has of it, so that every text is split into terms once, however many copies it has. Counts and
document frequencies are added with those multiplicities, summed within each task, and then by
(language, source, term) and (language, term).

Sources are compared on smoothed shares p = 1 + floor(UNIT * (count + 1) / (N + V)) of the terms that
enough documents of the language have. f(p, q) = floor((p - q)^2 / q). A pair of sources s, t is never
laid out over the whole vocabulary: with p0 the share of a term that a source lacks,

  sum f = V * f(p0s, p0t)
        + sum over the terms of s of f(ps, p0t) - f(p0s, p0t)   by how often each count occurs in s
        + sum over the terms of t of f(p0s, pt) - f(p0s, p0t)   likewise
        + sum over terms of both of f(ps, pt) - f(ps, p0t) - f(p0s, pt) + f(p0s, p0t)

and only the last sum needs terms one by one, each with its list of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import LOWER, byte_class, distinct_spans, slices, spans, text_bytes
from trafficcast.llm.common import documents, staged

MIN_DOCS = 3
TOP = 200
UNIT = 1_000_000_000
#: Bytes of text whose counts a task sums before it passes them on.
SUM_BYTES = 4 << 20
#: Pairs of postings worked on at once, and sums held by one task before it passes them on.
PAIRS = 1 << 20
HELD = 1 << 20

#: Bytes of `[^\x00-\x40\x5B-\x60\x7B-\x7F]`.
TERM = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def collapsed(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, text, copies): distinct texts of each language with (source, m), m documents of each source.

    The text moves once. Its SHA-256 stands for it while multiplicities are counted, which combines
    within tasks, so a text with very many copies is one row per task and source there.
    """
    plain = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    named = plain.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    copies = (
        named.groupBy("lang", "sha", "source").agg(F.count("*").alias("m"))
        .groupBy("lang", "sha").agg(F.collect_list(F.struct("source", "m")).alias("copies"))
    )
    texts = named.groupBy("lang", "sha").agg(F.min("text").alias("text"))
    return texts.join(copies, ["lang", "sha"]).select("lang", "text", "copies")


def _term_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    """Weighted counts of one slice, summed by (lang, source, term)."""
    data, offsets = text_bytes(part.column("text"))
    data = LOWER[data]
    starts, ends, owner = spans(TERM[data], offsets)
    first, term = distinct_spans(data, starts, ends)
    width = max(len(first), 1)
    # Occurrences of each term in each text.
    cells, counts = np.unique(owner * width + term, return_counts=True)
    texts, terms = cells // width, cells % width
    copies = part.column("copies")
    where = copies.offsets.to_numpy().astype(np.int64)
    inner = copies.values
    lang, names = part.column("lang").dictionary_encode(), inner.field("source").dictionary_encode()
    m, source = inner.field("m").to_numpy(), names.indices.to_numpy().astype(np.int64)
    # One row per cell and source of its text, then one per (lang, source, term).
    many = np.diff(where)[texts]
    cell = np.repeat(np.arange(len(cells)), many)
    copy = np.repeat(where[texts] - (np.cumsum(many) - many), many) + np.arange(len(cell))
    langs = lang.indices.to_numpy().astype(np.int64)[texts[cell]]
    code = (langs * max(len(names.dictionary), 1) + source[copy]) * width + terms[cell]
    order = np.argsort(code, kind="stable")
    code = code[order]
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    n = np.add.reduceat((counts[cell] * m[copy])[order], begin) if len(code) else begin
    d = np.add.reduceat(m[copy][order], begin) if len(code) else begin
    code = code[begin]
    raw = data.tobytes()
    words = pa.array([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.binary()).cast(pa.string())
    pair = code // width
    return pa.RecordBatch.from_arrays(
        [
            lang.dictionary.take(pa.array(pair // max(len(names.dictionary), 1))),
            names.dictionary.take(pa.array(pair % max(len(names.dictionary), 1))),
            words.take(pa.array(code % width)),
            pa.array(n, pa.int64()),
            pa.array(d, pa.int64()),
        ],
        names=["lang", "source", "term", "n", "d"],
    )


def postings(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, d, posts) of the terms in at least so many documents; posts lists (source, n).

    Takes collapsed texts. n counts occurrences, d documents. A list is no longer than the sources.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SUM_BYTES):
                yield _term_rows(part)

    # A slice has summed its rows already, so they go to their term at once, and stay there for both sums.
    rows = texts.mapInArrow(run, "lang string, source string, term string, n long, d long").repartition("lang", "term")
    sums = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    lists = sums.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), F.collect_list(F.struct("source", "n")).alias("posts")
    )
    return lists.where(F.col("d") >= min_docs)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), in decimals, as the product may pass 64 bits."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, total.cast("decimal(20,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); a share is at most UNIT + 1, so its square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def totals(docs: DataFrame, terms: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, total) of every group that occurs, total being N + V, and of each lang with a null source."""
    pairs = docs.select(
        *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    ).distinct()
    counts = terms.select("lang", F.inline("posts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = terms.groupBy("lang").agg(F.sum("n").alias("all"), F.count("*").alias("v"))
    zero = F.lit(0).cast("long")
    groups = pairs.join(counts, ["lang", "source"], "left").join(whole, "lang", "left").select(
        "lang", "source", (F.coalesce("n", zero) + F.coalesce("v", zero)).alias("total"), F.coalesce("v", zero).alias("v")
    )
    langs = whole.select("lang", F.lit(None).cast("string").alias("source"), (F.col("all") + F.col("v")).alias("total"), "v")
    return groups.unionByName(langs)


def distinctive_terms(terms: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, q, value, rank): terms that a source has more than its lang, highest value first.

    Rows of a group are ranked by value, then by the term's UTF-8 bytes; Spark keeps `top` rows of a
    group in each task before it ranks the rest.
    """
    groups = sizes.where("source is not null").select("lang", "source", "total")
    langs = sizes.where("source is null").select("lang", F.col("total").alias("all"))
    rows = terms.select("lang", F.col("term").alias("item"), F.col("n").alias("here"), F.inline("posts"))
    shared = rows.join(groups, ["lang", "source"]).join(langs, "lang").select(
        "lang", "source", "item", _share(F.col("n"), F.col("total")).alias("p"), _share(F.col("here"), F.col("all")).alias("q")
    )
    valued = shared.where("p > q").withColumn("value", _gap(F.col("p"), F.col("q")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return valued.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "source", "item", "q", "value", "rank")


def _joint(terms: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value): the last sum above, from the lists of the terms.

    Each task adds up what its terms give to each pair, so what it passes on is bounded by the pairs of
    sources and not by the terms.
    """
    groups = sizes.where("source is not null").select("lang", "source", "total")
    rows = terms.select("lang", "term", F.inline("posts")).join(groups, ["lang", "source"])
    rows = rows.select(
        "lang", "term", "source", _share(F.col("n"), F.col("total")).alias("p"), _share(F.lit(0), F.col("total")).alias("p0")
    )
    lists = rows.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("posts")).select("lang", "posts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            for part in _by_pairs(batch):
                _add_pairs(part, held)
                if len(held) > HELD:
                    yield _pair_rows(held)
                    held.clear()
        yield _pair_rows(held)

    sums = lists.mapInArrow(run, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _by_pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about PAIRS pairs; a row with more stands alone."""
    sizes = np.diff(batch.column("posts").offsets.to_numpy().astype(np.int64)) ** 2
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - sizes[start] + PAIRS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _add_pairs(part: pa.RecordBatch, held: dict[tuple[str, str, str], int]) -> None:
    posts = part.column("posts")
    where = posts.offsets.to_numpy().astype(np.int64)
    inner = posts.values.slice(where[0], where[-1] - where[0])
    where = where - where[0]
    lang, source = part.column("lang").dictionary_encode(), inner.field("source").dictionary_encode()
    size = np.diff(where)
    width = max(len(source.dictionary), 1)
    owner = np.repeat(np.arange(len(size)), size)
    name = lang.indices.to_numpy().astype(np.int64)[owner] * width + source.indices.to_numpy()
    p, p0 = inner.field("p").to_numpy(), inner.field("p0").to_numpy()
    # Every posting with every posting of its term.
    left = np.repeat(np.arange(len(owner)), size[owner])
    right = np.arange(len(left)) - np.repeat(np.cumsum(size[owner]) - size[owner], size[owner]) + where[owner[left]]
    apart = left != right
    left, right = left[apart], right[apart]

    def gap(a, b):
        return (a - b) ** 2 // b

    value = gap(p[left], p[right]) - gap(p[left], p0[right]) - gap(p0[left], p[right]) + gap(p0[left], p0[right])
    code = name[left] * width + name[right] % width
    order = np.argsort(code, kind="stable")
    code = code[order]
    if not len(code):
        return
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    sums = np.add.reduceat(value[order], begin).tolist()
    langs, names = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
    for c, v in zip(code[begin].tolist(), sums, strict=True):
        found = langs[c // width // width], names[c // width % width], names[c % width]
        held[found] = held.get(found, 0) + v


def _pair_rows(held: dict[tuple[str, str, str], int]) -> pa.RecordBatch:
    columns = list(zip(*held, strict=True)) or [(), (), ()]
    arrays = [pa.array(c, pa.string()) for c in columns] + [pa.array(held.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "item", "value"])


def source_distances(terms: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the lang, the most distant first."""
    groups = sizes.where("source is not null").select("lang", "source", "total", "v")
    # A lang without terms has no share to speak of; its groups are at distance zero.
    p0 = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"))).otherwise(1)
    ours = groups.select("lang", "source", F.col("total").alias("ours"), p0.alias("p0"), "v")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("theirs"), p0.alias("q0"))
    pairs = ours.join(theirs, "lang").where("source <> item")
    base = _gap(F.col("p0"), F.col("q0"))
    counted = terms.select("lang", F.inline("posts")).groupBy("lang", "source", "n").agg(F.count("*").alias("times"))
    # The same count occurs for many terms of a source, and all of them give the same.
    left = pairs.join(counted, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("times") * (_gap(_share(F.col("n"), F.col("ours")), F.col("q0")) - base)).alias("value")
    )
    right = pairs.join(counted.withColumnRenamed("source", "item"), ["lang", "item"]).select(
        "lang", "source", "item", (F.col("times") * (_gap(F.col("p0"), _share(F.col("n"), F.col("theirs"))) - base)).alias("value")
    )
    parts = pairs.select("lang", "source", "item", (F.col("v") * base).alias("value"))
    for other in (left, right, _joint(terms, sizes)):
        parts = parts.unionByName(other)
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return sums.withColumn("rank", rank)


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances of sources, and the terms that mark each.

    Null texts, langs and sources count as empty, repeated rows as documents of their own. A group
    without terms takes part; without any kept term in its lang all its distances are 0. Ties go by
    the item's UTF-8 bytes. An empty table gives no rows; other columns are ignored.
    """
    terms = staged(postings(collapsed(docs, text, lang, source), min_docs), "postings")
    sizes = staged(totals(docs, terms, lang, source), "totals")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    marks = distinctive_terms(terms, sizes, top).withColumn("part", F.lit("term")).select(columns)
    return source_distances(terms, sizes).withColumn("part", F.lit("pair")).select(columns).unionByName(marks)


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c, k.c AS here
          FROM groups AS g JOIN kept AS k USING (lang) LEFT JOIN counts AS n
          ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
shares AS (SELECT lang, source, term, c,
           1 + 1000000000::HUGEINT * (c + 1) // (sum(c) OVER g + count(*) OVER g) AS p,
           1 + 1000000000::HUGEINT * (here + 1) // (sum(here) OVER g + count(*) OVER g) AS q
           FROM cells WINDOW g AS (PARTITION BY lang, source)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
          FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS place FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 200
"""


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(documents(spark, folder))
