"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line is dropped if an earlier line of the table is equal to it, whatever its length, or, from
`near_chars` characters on, one edit away (a character inserted, deleted or replaced) from a line as
long as that. Lines are taken trimmed, in the order of document key and line number; blank lines are
left alone.

Two lines one edit apart share a deletion variant: replaced at the same place, or one is the other
with a character deleted. All variants of all lines would be as many rows as characters, so three
exact steps narrow down what has to be emitted: (1) distinct lines are joined on hashes of halves,
as one edit leaves a half alone; (2) of those left, a line's text outside each block of BLOCK
characters is hashed, as one edit lies within one block; (3) only for blocks that still have a
partner all variants are emitted as hashed keys. Grouping by key gives every line its earliest
partner without ever pairing a group's members; edit distance is then verified on the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.common import discard, documents, keyed, staged

#: Characters from which on one edit is no difference; in shorter lines it makes another word.
NEAR_CHARS = 16
BLOCK = 64
#: Distinct lines that may have a near partner are broadcast up to this many (16 bytes each).
BROADCAST_LINES = 1 << 20


def exploded_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mark, no, line): every line of every row; `mark` tells rows of one key apart."""
    plain = keyed(docs, key, text).withColumn("mark", F.xxhash64("key", "text"))
    return plain.select("key", "mark", F.posexplode(F.split("text", "\n")).alias("no", "line")).withColumn(
        "line", F.btrim("line", F.lit(" \t\r"))
    )


def _named(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, with their length and a name of 128 bits."""
    sized = lines.withColumn("n", F.char_length("line")).where(F.col("n") > 0)
    return sized.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _halves(line: Column, n: Column) -> Column:
    """Keys that two lines within one edit share: halves by the shorter one's length."""

    def of(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        rest = (m - half).cast("int")
        return [
            F.xxhash64(m, F.lit(0), F.substr(line, F.lit(1), half)),
            F.xxhash64(m, F.lit(1), F.substr(line, n - rest + 1, rest)),
        ]

    return F.array(*of(n), *of(n - 1))


def _holes(line: Column, n: Column) -> Column:
    """(b, m, hole): hash of all but block b, for a partner of the same length or shorter by one."""

    def of(m: Column) -> Column:
        def hole(b: Column) -> Column:
            rest = F.greatest(F.lit(0), m - BLOCK * b - BLOCK)
            outside = F.xxhash64(b, m, F.substr(line, F.lit(1), BLOCK * b), F.lit("|"), F.substr(line, n - rest + 1, rest))
            return F.struct(b.alias("b"), m.alias("m"), outside.alias("hole"))

        return F.transform(F.sequence(F.lit(0), F.ceil(m / BLOCK).cast("int") - 1), hole)

    return F.concat(of(n), of(n - 1))


def _variants(middle: Column, size: Column, longer: Column) -> Column:
    """Keys of a block: one deletion each, with its place where characters may be replaced."""

    def without(i: Column) -> Column:
        return F.concat(F.substr(middle, F.lit(1), i), F.substr(middle, i + 2, size))

    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    replaced = F.transform(places, lambda i: F.struct(F.lit("r").alias("role"), F.xxhash64(F.lit("r"), i, without(i)).alias("v")))
    deleted = F.transform(places, lambda i: F.struct(F.lit("l").alias("role"), F.xxhash64(F.lit("d"), without(i)).alias("v")))
    as_is = F.array(F.struct(F.lit("s").alias("role"), F.xxhash64(F.lit("d"), middle).alias("v")))
    return F.when(longer, F.array_distinct(deleted)).otherwise(F.concat(replaced, as_is))


def distinct_lines(named: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(h1, h2, first, keys): every distinct line, where it stands first, and its half keys if it is long enough."""
    first = F.min(F.struct("key", "mark", "no")).alias("first")
    keys = F.when(F.col("n") >= near_chars, _halves(F.col("line"), F.col("n")))
    return named.select("key", "mark", "no", "h1", "h2", keys.alias("keys")).groupBy("h1", "h2").agg(
        first, F.first("keys").alias("keys")
    )


def near_lines(named: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2, keeper): distinct lines with an earlier line one edit away, and the earliest such."""
    halves = distinct.select("h1", "h2", F.explode("keys").alias("k"))
    live = halves.groupBy("k").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("k")
    candidates = staged(halves.join(live, "k", "left_semi").select("h1", "h2").distinct(), "candidates")
    chosen = F.broadcast(candidates) if candidates.count() <= BROADCAST_LINES else candidates
    texts = named.select("key", "mark", "no", "line", "n", "h1", "h2").join(chosen, ["h1", "h2"])
    # Equal lines have equal texts; one of each is enough, with the place of the first.
    texts = texts.groupBy("h1", "h2").agg(
        F.min(F.struct("key", "mark", "no")).alias("first"), F.first("line").alias("line"), F.first("n").alias("n")
    )
    texts = staged(texts, "lines")
    discard(candidates)
    holes = texts.select("h1", "h2", "first", "line", "n", F.explode(_holes(F.col("line"), F.col("n"))).alias("o")).select(
        "h1", "h2", "first", "line", "n", "o.*"
    )
    open_holes = holes.groupBy("hole").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("hole")
    rest = F.greatest(F.lit(0), F.col("m") - BLOCK * F.col("b") - BLOCK)
    size = F.col("n") - rest - BLOCK * F.col("b")
    blocks = holes.join(open_holes, "hole", "left_semi").select(
        "h1", "h2", "first", "hole", (F.col("n") > F.col("m")).alias("longer"), size.alias("size"),
        F.substr("line", BLOCK * F.col("b") + 1, size).alias("middle"),
    )
    keyed_rows = blocks.select(
        "h1", "h2", "first", F.explode(_variants(F.col("middle"), F.col("size"), F.col("longer"))).alias("x"), "hole"
    ).select("h1", "h2", "first", "x.role", F.xxhash64("hole", "x.v").alias("v1"), F.xxhash64("x.v", "hole", F.lit(1)).alias("v2"))
    keyed_rows = staged(keyed_rows, "variants")
    who = F.struct("first", "h1", "h2")
    least = keyed_rows.groupBy("v1", "v2").agg(
        F.min(F.when(F.col("role") == "r", who)).alias("r"),
        F.min(F.when(F.col("role") == "s", who)).alias("s"),
        F.min(F.when(F.col("role") == "l", who)).alias("l"),
    )
    partner = F.when(F.col("role") == "r", F.col("r")).when(F.col("role") == "s", F.col("l")).otherwise(F.col("s"))
    paired = keyed_rows.join(least, ["v1", "v2"]).select("h1", "h2", "first", partner.alias("p")).where("p.first < first")
    paired = paired.select("h1", "h2", "p").distinct()
    mine = texts.select("h1", "h2", F.col("line").alias("mine"))
    other = texts.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("line").alias("other"))
    checked = (
        paired.join(mine, ["h1", "h2"])
        .join(other, (F.col("p.h1") == F.col("p1")) & (F.col("p.h2") == F.col("p2")))
        .where(F.levenshtein("mine", "other", 1) >= 0)
    )
    return checked.groupBy("h1", "h2").agg(F.min("p.first").alias("keeper"))


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """(key, mark, n_lines, n_near, dropped): one row for each key and text, dropped line numbers sorted."""
    lines = exploded_lines(docs, key, text)
    named = _named(lines)
    distinct = staged(distinct_lines(named, near_chars), "distinct")
    near = near_lines(named, distinct).withColumnsRenamed({"h1": "n1", "h2": "n2"})
    judged = distinct.join(near, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2")), "left").select("h1", "h2", "first", "keeper")
    places = named.select("key", "mark", "no", "h1", "h2").join(judged, ["h1", "h2"])
    here = F.struct("key", "mark", "no")
    same = ~here.eqNullSafe(F.col("first"))
    bad = places.where(same | F.col("keeper").isNotNull()).select("key", "mark", "no", (~same).alias("near"))
    return bad.groupBy("key", "mark").agg(
        F.array_sort(F.collect_set("no")).alias("dropped"),
        F.size(F.collect_set(F.when(F.col("near"), F.col("no")))).cast("long").alias("n_near"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """All columns of `docs`, with the dropped lines taken out of the text.

    Kept lines stay as they are, untrimmed, joined by line feeds; rows stay even if no line is left.
    Null and empty texts stay. Rows that repeat key and text count as one document and are cut
    alike; rows of one key with other texts come in the order of a hash; a null key comes first. An
    empty table gives none. No column name can clash. Writes its steps to the shared folder.
    """
    bad = dropped_lines(docs, key, text, near_chars).select(F.col("key").alias("__key"), F.col("mark").alias("__mark"), F.col("dropped").alias("__dropped"))
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    marked = docs.withColumn("__at", F.xxhash64(docs[key], body))
    joined = marked.join(bad, (F.col("__at") == F.col("__mark")) & F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left")
    kept = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda _, i: ~F.array_contains(F.col("__dropped"), i))
    cut = F.when(F.col("__dropped").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, cut).drop("__at", "__key", "__mark", "__dropped")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, n_near, dropped (line numbers from 0, comma-joined)."""
    docs = documents(spark, folder)
    bad = dropped_lines(docs).withColumnsRenamed({"key": "k", "mark": "m"})
    rows = keyed(docs, "doc_id", "text").select("key", F.xxhash64("key", "text").alias("mark"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    joined = rows.join(bad, (F.col("mark") == F.col("m")) & F.col("key").eqNullSafe(F.col("k")), "left")
    return joined.select(
        F.col("key").alias("doc_id"),
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"),
    )


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS no, trim(parts[i], ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents), range(1, len(parts) + 1) AS r(i)),
counted AS (SELECT * FROM lines WHERE length(line) > 0),
firsts AS (SELECT line, length(line) AS n, min({'d': doc_id, 'i': no}) AS first FROM counted GROUP BY line),
long AS (SELECT * FROM firsts WHERE n >= 16),
pairs AS (
  SELECT DISTINCT a.line AS a, b.line AS b, a.first AS fa, b.first AS fb
  FROM long a JOIN long b ON b.n IN (a.n, a.n - 1) AND left(a.line, b.n // 2) = left(b.line, b.n // 2) AND a.line <> b.line
  UNION
  SELECT DISTINCT a.line, b.line, a.first, b.first
  FROM long a JOIN long b ON b.n IN (a.n, a.n - 1) AND right(a.line, b.n - b.n // 2) = right(b.line, b.n - b.n // 2) AND a.line <> b.line),
close AS (
  SELECT * FROM pairs WHERE len(list_filter(range(0, length(a)), lambda i: left(a, i) = left(b, i)
    AND substr(a, i + 2) = substr(b, i + 1 + length(b) - (length(a) - 1)))) > 0),
near AS (SELECT a AS line FROM close WHERE fb < fa UNION SELECT b FROM close WHERE fa < fb),
bad AS (
  SELECT c.doc_id, c.no, c.line IN (FROM near) AND {'d': c.doc_id, 'i': c.no} = f.first AS near
  FROM counted c JOIN firsts f USING (line)
  WHERE {'d': c.doc_id, 'i': c.no} <> f.first OR c.line IN (FROM near)),
per AS (SELECT doc_id, count(*) AS n_dropped, count(*) FILTER (near) AS n_near, string_agg(no, ',' ORDER BY no) AS dropped FROM bad GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(coalesce(d.text, ''), chr(10))) AS BIGINT) AS n_lines,
  coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near, coalesce(dropped, '') AS dropped
FROM documents d LEFT JOIN per USING (doc_id)
"""
