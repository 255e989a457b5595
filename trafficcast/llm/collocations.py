"""Phrases that belong together, counted with an index of word ids per shard.

A task turns its texts into sequences of word ids, a language at a time, with 0 between pieces, and
closes a shard whenever it holds SHARD_WORDS words. A shard's sequence is indexed forwards and
backwards by a Burrows-Wheeler transform whose suffixes are sorted to the depth of the longest phrase.
A phrase is an interval of rows in both; the words before its rows extend it to the left, those before
the rows of the mirrored index to the right, and either step narrows both intervals, so that every
phrase comes with its count and its extensions without a look at the text.

A phrase is frequent only if all its parts are. Counts are therefore summed over the shards by length:
words first, then pairs of frequent words, then phrases all of whose pairs are frequent. After each
length a shard is told which of its own phrases are frequent in all shards together, never more. What
a task holds is thus bounded by its shard, and a language with most of the texts has many shards. A
shard's phrases leave it in batches as they are found: there can be more of them than words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import LOWER, byte_class, distinct_spans, slices, spans, text_bytes
from trafficcast.llm.common import discard, documents, staged

LONGEST = 4
LEAST = 30
TOP = 2000
#: Words that one task holds before it closes the largest shard.
SHARD_WORDS = 1 << 21
_OUT_ROWS = 1 << 16
#: Rounds in which pairs are counted, by their last word, as their rows are the most that is on disk at once.
ROUNDS = 2
#: Rows of an index that are extended at once; the interval of one word is never divided.
_STEP_ROWS = 1 << 18

#: Bytes of `[.,;:!?\x0A-\x0D]`, and of `[\x20\x09]`.
BREAK = byte_class(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
GAP = byte_class((0x09, 0x09), (0x20, 0x20))


# -- shards ------------------------------------------------------------------


def pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of words, and which words begin a piece."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    breaks = BREAK[data]
    starts, ends, owner = spans(~(breaks | GAP[data]), offsets)
    passed = np.concatenate([[0], np.cumsum(breaks)])
    first = np.ones(len(starts), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (passed[starts[1:]] > passed[ends[:-1]])
    return data, starts, ends, first


class Shard:
    """Words and their sequence, while a task reads."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, column: pa.Array) -> None:
        data, starts, ends, first = pieces(column)
        chosen, back = distinct_spans(data, starts, ends)
        raw, ids = data.tobytes(), self.ids
        names = [raw[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)]
        known = np.array([ids.setdefault(x, len(ids) + 1) for x in names], np.uint32)
        part = np.zeros(len(starts) + int(first.sum()), np.uint32)
        part[np.arange(len(starts)) + np.cumsum(first)] = known[back]
        self.parts.append(part)
        self.size += len(starts)

    def closed(self) -> tuple[int, bytes, bytes]:
        """Number of words, words by falling count, and the sequence in planes of bytes; both compressed."""
        sequence = np.concatenate([*self.parts, np.zeros(1, np.uint32)])
        counts = np.bincount(sequence, minlength=len(self.ids) + 1)[1:]
        order = np.argsort(-counts, kind="stable")
        place = np.zeros(len(self.ids) + 1, "<u4")
        place[1 + order] = np.arange(1, len(order) + 1)
        names = list(self.ids)
        planes = place[sequence].view(np.uint8).reshape(-1, 4).T
        return self.size, _packed(b" ".join([names[i] for i in order.tolist()])), _packed(planes.tobytes())


def _packed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _opened(data: pa.Buffer) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()


def _words(row: pa.RecordBatch) -> pa.Array:
    """The words of a shard's row; none holds a space."""
    names = _opened(row.column("words")[0].as_buffer())
    return pc.split_pattern(pa.array([names] if names else [], pa.binary()).cast(pa.string()), " ").flatten()


def _sequence(row: pa.RecordBatch) -> np.ndarray:
    planes = _opened(row.column("sequence")[0].as_buffer())
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def shards(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, shard, size, words, sequence) of what each task reads; no shuffle."""
    plain = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Shard] = {}
        number = TaskContext.get().partitionId() << 24

        def row(name: str) -> pa.RecordBatch:
            nonlocal number
            size, words, sequence = held.pop(name).closed()
            number += 1
            columns = [pa.array([name]), pa.array([number]), pa.array([size])]
            columns += [pa.array([words], pa.binary()), pa.array([sequence], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "shard", "size", "words", "sequence"])

        for batch in batches:
            for name in pc.unique(batch.column("lang")).to_pylist():
                rows = batch.filter(pc.equal(batch.column("lang"), name))
                for part in slices(rows, "text"):
                    held.setdefault(name, Shard()).add(part.column("text"))
                    if sum(x.size for x in held.values()) >= SHARD_WORDS:
                        yield row(max(held, key=lambda x: held[x].size))
        for name in list(held):
            yield row(name)

    return plain.mapInArrow(run, "lang string, shard long, size long, words binary, sequence binary")


# -- the index of a shard ----------------------------------------------------


class Index:
    """Burrows-Wheeler transform of a sequence of pieces, its suffixes sorted to `depth` words."""

    def __init__(self, sequence: np.ndarray, symbols: int, depth: int):
        self.symbols, self.size = symbols, len(sequence)
        rank, reach = sequence, 1
        inside = sequence > 0
        row = np.flatnonzero(inside)
        while reach < depth:
            whole = inside.copy()
            for k in range(1, reach):
                whole[:-k] &= sequence[k:] > 0
                whole[-k:] = False
            code = rank.astype(np.int64)
            code *= int(rank.max(initial=0)) + 1
            code[:-reach] += np.where(whole[:-reach], rank[reach:], 0)
            code[~inside] = 0
            del whole
            row = np.argsort(code)
            code = code[row]
            steps = np.cumsum(code[1:] != code[:-1], dtype=np.int32)
            del code
            rank = np.zeros(self.size, np.int32)
            rank[row[1:]] = steps
            del steps
            reach *= 2
        del rank
        row = row[inside[row]]
        # What stands before each row's suffix: a word, or 0 where its piece begins.
        self.before = np.where(row > 0, sequence[row - 1], 0)
        del row, inside
        counts = np.bincount(sequence, minlength=symbols)
        counts[0] = 0
        self.counts, self.low = counts, np.cumsum(counts) - counts
        ending = np.bincount(sequence[:-1][sequence[1:] == 0], minlength=symbols)
        ending[0] = 0
        self.occurs = self.before.astype(np.int64)
        self.occurs *= self.size
        self.occurs += np.arange(len(self.before), dtype=np.int32)
        self.occurs.sort()
        self.base = self.low + ending - np.searchsorted(self.occurs, np.arange(symbols) * self.size)

    def extended(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Words before the phrases of disjoint intervals: (phrase, word, count, low, offset).

        low is where the longer phrase begins in this index, offset where it begins within the
        interval of the shorter one in the mirrored index.
        """
        owner = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(owner)) + np.repeat(low - (np.cumsum(size) - size), size)
        code, count = np.unique(owner * self.symbols + self.before[rows], return_counts=True)
        phrase, word = code // self.symbols, code % self.symbols
        offset = np.cumsum(count) - count
        offset -= (np.cumsum(size) - size)[phrase]
        here = self.base[word] + np.searchsorted(self.occurs, word * self.size + low[phrase])
        real = word > 0
        return tuple(x[real] for x in (phrase, word, count, here, offset))


def _joined(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    return pc.binary_join_element_wise(*[words.take(pa.array(c - 1)) for c in columns], " ")


def _steps(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive intervals with about _STEP_ROWS rows; a longer one stands alone."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        stop = int(np.searchsorted(ends, ends[start] - sizes[start] + _STEP_ROWS, side="right"))
        yield slice(start, max(start + 1, stop))
        start = max(start + 1, stop)


def pairs_of(
    sequence: np.ndarray, words: pa.Array, frequent: pa.Array, turn: int | None = None
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Pairs of frequent words and their counts, some words at a time; if a round is given, those of its last words."""
    index = Index(sequence, len(words) + 1, 2)
    good = np.concatenate([[False], pc.is_in(words, value_set=frequent).to_numpy(zero_copy_only=False)])
    known = np.flatnonzero(good)
    if turn is not None:
        names = words.take(pa.array(known - 1)).cast(pa.binary()).to_pylist()
        known = known[np.array([zlib.crc32(x) % ROUNDS == turn for x in names], bool)]
    del sequence, frequent
    for step in _steps(index.counts[known]):
        last = known[step]
        phrase, word, count, _, _ = index.extended(index.low[last], index.counts[last])
        keep = good[word]
        yield _joined(words, [word[keep], last[phrase[keep]]]), count[keep]


def _codes(pairs: pa.Array | pa.ChunkedArray, words: pa.Array) -> np.ndarray:
    """Pairs of words as sorted numbers, some at a time."""
    codes = []
    for at in range(0, len(pairs), _STEP_ROWS):
        halves = pc.split_pattern(pairs.slice(at, _STEP_ROWS), " ")
        halves = halves.combine_chunks() if isinstance(halves, pa.ChunkedArray) else halves
        flat = pc.index_in(halves.flatten(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        codes.append(flat[::2] * (len(words) + 1) + flat[1::2])
    return np.unique(np.concatenate(codes))


def longer_of(
    sequence: np.ndarray, words: pa.Array, frequent: pa.Array | pa.ChunkedArray
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Phrases of three, then of four words all of whose pairs are frequent, and their counts; so for some words at a time.

    A pair grows to the left, then to the right: the forward index gives the word before, and the
    mirrored interval that comes with it the word after.
    """
    symbols = len(words) + 1
    allowed = _codes(frequent, words)
    del frequent
    forward, mirrored = Index(sequence, symbols, LONGEST), Index(sequence[::-1].copy(), symbols, LONGEST)
    del sequence

    def known(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * symbols + right
        return allowed[np.minimum(np.searchsorted(allowed, code), len(allowed) - 1)] == code

    ends = np.unique(allowed % symbols)
    for step in _steps(forward.counts[ends]):
        last = ends[step]
        phrase, word, count, low, offset = forward.extended(forward.low[last], forward.counts[last])
        keep = known(word, last[phrase])
        two = [word[keep], last[phrase[keep]]]
        low, size, mirror = low[keep], count[keep], mirrored.low[two[1]] + offset[keep]

        phrase, word, count, _, offset = forward.extended(low, size)
        keep = known(word, two[0][phrase])
        phrase = phrase[keep]
        three = [word[keep], two[0][phrase], two[1][phrase]]
        size, mirror = count[keep], mirror[phrase] + offset[keep]

        phrase, word, count, _, _ = mirrored.extended(mirror, size)
        keep = known(three[2][phrase], word)
        four = [*(x[phrase[keep]] for x in three), word[keep]]
        yield _joined(words, three), size
        yield _joined(words, four), count[keep]


# -- counts over all shards --------------------------------------------------

#: id is the place of a word among those of its shard; longer phrases have none.
_GRAMS = "lang string, shard long, length int, phrase string, n long, id int"


def _rows(lang: str, shard: int, length: int, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(phrases), _OUT_ROWS):
        part = phrases.slice(at, _OUT_ROWS)
        part = part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part
        size = len(part)
        ids = pa.array(np.arange(at, at + size, dtype=np.int32)) if length == 1 else pa.nulls(size, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(lang, size), pa.repeat(pa.scalar(shard, pa.int64()), size), pa.repeat(pa.scalar(length, pa.int32()), size),
                part.cast(pa.string()), pa.array(counts[at : at + size], pa.int64()), ids,
            ],
            names=["lang", "shard", "length", "phrase", "n", "id"],
        )


def _words_of(parts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                words = _words(row)
                counts = np.bincount(_sequence(row), minlength=len(words) + 1)[1:]
                yield from _rows(row.column("lang")[0].as_py(), row.column("shard")[0].as_py(), 1, words, counts)

    return parts.mapInArrow(run, _GRAMS)


def _grown(parts: DataFrame, frequent: DataFrame, length: int, turn: int | None = None) -> DataFrame:
    """Counts of longer phrases in each shard, given the frequent ones that it has; of pairs those of a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shard's own row and what is frequent of it, in any order.
        part, told = None, []
        for batch in batches:
            own = pc.is_valid(batch.column("sequence"))
            if own.true_count:
                part = batch.filter(own)
            told.append(batch.column("told").filter(pc.invert(own)))
        given = pa.chunked_array(told).combine_chunks()
        if part is None or not len(given):
            return
        lang, shard, words, sequence = part.column("lang")[0].as_py(), part.column("shard")[0].as_py(), _words(part), _sequence(part)
        found = pairs_of(sequence, words, words.take(given), turn) if length == 1 else longer_of(sequence, words, given)
        # The search lets go of what it has taken from these.
        del batch, part, told, given, sequence
        for i, (p, n) in enumerate(found):
            yield from _rows(lang, shard, length + 1 + i % length, p, n)

    told = frequent.select("shard", F.col("id" if length == 1 else "phrase").alias("told"))
    both = parts.unionByName(told, allowMissingColumns=True)
    return both.groupBy("shard").applyInArrow(run, _GRAMS)


def _frequent(counts: DataFrame, least: int) -> DataFrame:
    """Rows of phrases with at least so many occurrences in all shards together, with that sum as `a`."""
    total = F.sum("n").over(Window.partitionBy("lang", "phrase"))
    return counts.withColumn("a", total).where(F.col("a") >= least).drop("n")


@contextmanager
def _dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the job that wrote them, as the next one reads its staged table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, a) of phrases up to four words with a >= least occurrences, and (lang, n)."""
    with _dropped_shuffles(docs.sparkSession):
        parts = staged(shards(docs, text, lang), "shards")
        sizes = staged(parts.groupBy("lang").agg(F.sum("size").alias("n")), "sizes")
        words = staged(_frequent(_words_of(parts), least), "words")
        rounds = [staged(_frequent(_grown(parts, words, 1, turn), least), "pairs") for turn in range(ROUNDS)]
        pairs = reduce(DataFrame.unionByName, rounds)
        longer = _grown(parts, pairs, 2).groupBy("lang", "length", "phrase").agg(F.sum("n").alias("a"))
        short = words.unionByName(pairs).select("lang", "length", "phrase", "a").distinct()
        found = staged(short.unionByName(longer.where(F.col("a") >= least)), "phrases")
    for table in (parts, words, *rounds):
        discard(table)
    return found, sizes


# -- scores ------------------------------------------------------------------


def collocations(found: DataFrame, unit: int = 2_000_000) -> DataFrame:
    """(lang, length, phrase, a, l, r, score) of frequent phrases at their weakest cut.

    l and r count the parts of a cut, the score is floor(unit * a / (l + r)) in decimals; the cut with
    the least score counts, ties to the earliest.
    """
    words = F.split("phrase", " ")
    cuts = found.where("length > 1").select("*", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "length", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("tail"),
    )
    left = found.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    right = found.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    product = F.lit(unit).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
    score = F.call_function("div", product, (F.col("l") + F.col("r")).cast("decimal(20,0)"))
    scored = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).withColumn("score", score)
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "length", "phrase", "a").agg(weakest).select("lang", "length", "phrase", "a", "cut.l", "cut.r", "cut.score")


def self_contained(scored: DataFrame, found: DataFrame, most: tuple[int, int] = (80, 100)) -> DataFrame:
    """Phrases without a longer one around them that has at least that share of their occurrences.

    A phrase is around another if its words hold it without a gap. It is enough to look at extensions
    by one word to either side: whatever lies between a phrase and a longer one occurs at least as
    often as the longer one, and is a frequent phrase itself.
    """
    words = F.split("phrase", " ")
    size = F.col("length") - 1
    inner = F.array(F.array_join(F.slice(words, 1, size), " "), F.array_join(F.slice(words, 2, size), " "))
    around = found.where("length > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share, whole = most
    wide = "decimal(20,0)"
    covered = F.col("longer").cast(wide) * whole >= F.col("a").cast(wide) * share
    return scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered).drop("longer")


def phrase_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of two to four words of each lang.

    Null texts count as empty, a null lang as `und`; repeated rows count as often as they stand there.
    Equal scores go by falling count, then by the phrase's UTF-8 bytes. A lang without frequent phrases
    has no rows, nor has an empty table; other columns are ignored.
    """
    found, sizes = frequent_phrases(docs, text, lang, least)
    kept = self_contained(collocations(found), found)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    best = kept.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
          FROM words, (VALUES (1), (2), (3), (4)) AS lengths(m)),
counts AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
found AS (SELECT * FROM counts WHERE m > 1 AND a >= 30),
cuts AS (SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS tail
         FROM (SELECT *, unnest(range(1, m)) AS k FROM found)),
scored AS (SELECT cuts.*, x.a AS l, y.a AS r, 2000000::HUGEINT * cuts.a // (x.a + y.a) AS score
           FROM cuts JOIN counts AS x ON x.lang = cuts.lang AND x.phrase = head
                     JOIN counts AS y ON y.lang = cuts.lang AND y.phrase = tail),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM weakest AS c WHERE NOT EXISTS (
           SELECT 1 FROM found AS o WHERE o.lang = c.lang AND o.m > c.m AND 100 * o.a >= 80 * c.a
           AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_collocations(documents(spark, folder))
