"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector serves all grades: P(grade <= k) = sigmoid(t_k - s) with ordered thresholds t and
the score s of a text, the sum of the weights of its hashed distinct words and word starts, and of
the shares of its hashed token shapes (upper, lower, digits and signs, runs collapsed), of words that
repeat the one before and of words that came before. Expected grade and the
probability of the top grade follow from s; the latter selects. Weights are fitted on the driver
from a bounded sample of labelled rows; scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import LOWER, SPACE, WORD, mixed, prefix_hash, slices, span_hash, spans, text_bytes
from trafficcast.llm.common import arrow_map, documents, keyed

#: Labelled rows used for fitting, those of the least key hashes: 12,000 rows of some hundred numbers.
SAMPLE = 12_000
BUCKETS = 1 << 18
SHAPES = 64
DENSE = SHAPES + 2
#: Bytes of a word start, and by how much the roots of shares are stretched.
STARTS = (4, 5, 6)
STRETCH = 8.0
#: A word needs so many rows of the sample to have a weight.
RARE = 5

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = 0x41
_CLASS[0x61:0x7B] = 0x61
_CLASS[0x80:] = 0x61
_CLASS[0x30:0x3A] = 0x30


@dataclass(frozen=True)
class Model:
    """Word weights, shape weights and ordered thresholds; without thresholds every text passes.

    `slope` is the largest partial derivative of the penalised likelihood where the fit stopped; it
    says how far from the optimum that was.
    """

    words: np.ndarray
    shapes: np.ndarray
    thresholds: np.ndarray
    slope: float = 0.0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of distinct hashed words and word starts, sorted by text, and shares of each text."""
    data, offsets = text_bytes(column)
    low = LOWER[data]
    starts, ends, owner = spans(WORD[low], offsets)
    sums = prefix_hash(low)
    names = span_hash(sums, starts, ends)
    hashes, owners = [names], [owner]
    for size in STARTS:
        long = ends - starts >= size
        hashes.append(mixed(span_hash(sums, starts[long], starts[long] + size)))
        owners.append(owner[long])
    bucket = (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)
    pairs = np.unique(np.concatenate(owners) * BUCKETS + bucket)
    counts = np.bincount(owner, minlength=len(column))
    again = np.zeros(len(owner), bool)
    again[1:] = (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner, weights=again, minlength=len(column))
    order = np.lexsort((names, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (names[order][1:] != names[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    old = counts - np.bincount(owner[order], weights=fresh, minlength=len(column))
    kinds = _CLASS[data]
    change = np.ones(len(kinds), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[offsets[:-1][np.diff(offsets) > 0]] = True
    kept = kinds[change]
    where = np.concatenate([[0], np.cumsum(change)])[offsets]
    starts, ends, owner = spans(~SPACE[kept], where)
    shape = (span_hash(prefix_hash(kept), starts, ends) % np.uint64(SHAPES)).astype(np.int64)
    shares = np.bincount(owner * SHAPES + shape, minlength=len(column) * SHAPES).reshape(-1, SHAPES).astype(np.float64)
    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1)
    dense = np.column_stack([shares, again / np.maximum(counts, 1), old / np.maximum(counts, 1)])
    return pairs // BUCKETS, pairs % BUCKETS, STRETCH * np.sqrt(dense)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_rows(grades: np.ndarray, sizes: np.ndarray, words: np.ndarray, shapes: np.ndarray, steps: int = 120, decay: float = 3e-3) -> Model:
    """Penalised maximum likelihood by adaptive gradient steps over all rows at once.

    The number of steps is fixed and their rate falls to zero; the model says what slope was left. `sizes` says how many of the consecutive `words` each row has.
    """
    levels = np.unique(grades)
    cuts = len(levels) - 1
    if cuts < 1:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(DENSE), np.zeros(0))
    y = np.searchsorted(levels, grades)
    n = len(y)
    common = np.bincount(words, minlength=BUCKETS) >= RARE
    stay = common[words]
    sizes = np.diff(np.concatenate([[0], np.cumsum(stay)])[np.concatenate([[0], np.cumsum(sizes)])])
    used = np.flatnonzero(common)
    place = np.cumsum(common) - 1
    words = place[words[stay]]
    size = len(used)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    # Parameters: word weights, shape weights, first threshold, logarithms of the gaps.
    share = np.cumsum(np.bincount(y, minlength=cuts + 1))[:-1] / n
    start = np.log(share / (1 - share))
    x = np.concatenate([np.zeros(size + DENSE), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(x), np.zeros_like(x)
    penalty = np.concatenate([np.full(size, decay), np.full(DENSE, decay / 10), np.zeros(cuts)])
    for step in range(1, steps + 2):
        w, v, t0, gaps = x[:size], x[size : size + DENSE], x[size + DENSE], np.exp(x[size + DENSE + 1 :])
        t = t0 + np.concatenate([[0], np.cumsum(gaps)])
        s = shapes @ v
        if size:
            s[full] += np.add.reduceat(w[words], starts)
        upper = np.where(y < cuts, _sigmoid(t[np.minimum(y, cuts - 1)] - s), 1.0)
        lower = np.where(y > 0, _sigmoid(t[np.maximum(y - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / p, lower * (1 - lower) / p
        pull = (up - down) / n
        cut = np.zeros(cuts)
        np.add.at(cut, np.minimum(y, cuts - 1), np.where(y < cuts, -up, 0) / n)
        np.add.at(cut, np.maximum(y - 1, 0), np.where(y > 0, down, 0) / n)
        tail = np.cumsum(cut[::-1])[::-1]
        slope = np.concatenate([np.bincount(words, weights=np.repeat(pull, sizes), minlength=size), shapes.T @ pull, tail[:1], tail[1:] * gaps])
        slope += penalty * x
        if step > steps:
            break
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        x = x - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = x[:size]
    t = x[size + DENSE] + np.concatenate([[0], np.cumsum(np.exp(x[size + DENSE + 1 :]))])
    return Model(weights, x[size : size + DENSE], t, float(np.abs(slope).max()))


def fit(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", sample: int = SAMPLE) -> Model:
    """A model from rated texts. `ratings` has the key and an integer grade; higher is better.

    Uses the `sample` rated keys of the least hashes, all if there are fewer. Of several grades of a
    key the lowest counts, and of several texts one, chosen by hash, so that neither a key with very
    many rows nor repeated ratings weigh more or reach the driver. Ratings with a null key or grade,
    and ratings without a text row, are left out; one grade alone, or none, gives a model that passes
    every text.
    """
    rated = ratings.select(ratings[key].alias("k"), ratings[grade].cast("int").alias("grade")).dropna()
    rated = rated.groupBy("k").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("k"), "k").limit(sample)
    # At most `sample` rows.
    chosen = keyed(docs, key, text).join(F.broadcast(rated), F.col("key") == F.col("k"))
    one = F.min(F.struct(F.xxhash64("text"), "text")).alias("one")
    chosen = chosen.groupBy("k", "grade").agg(one).select(F.xxhash64("k").alias("at"), "grade", "one.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, word, shares = features(part.column("text"))
                where = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("at"),
                        part.column("grade"),
                        pa.ListArray.from_arrays(pa.array(where), pa.array(word.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * DENSE), pa.array(shares.ravel().astype(np.float32))),
                    ],
                    names=["at", "grade", "words", "shapes"],
                )

    table = chosen.mapInArrow(run, "at long, grade int, words array<int>, shapes array<float>").toArrow()
    # In one order, whatever the partitions, so that sums come out alike.
    table = table.sort_by("at").combine_chunks()
    if not table.num_rows:
        return fit_rows(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros((0, DENSE)))
    lists = table.column("words").chunk(0)
    sizes, words = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
    shapes = table.column("shapes").chunk(0).flatten().to_numpy().reshape(-1, DENSE).astype(np.float64)
    return fit_rows(table.column("grade").to_numpy(), sizes, words, shapes)


def scores(column: pa.Array, model: Model) -> np.ndarray:
    row, word, shares = features(column)
    return np.bincount(row, weights=model.words[word], minlength=len(column)) + shares @ model.shapes


def graded(score: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade (0 to the number of thresholds) and probability of the top grade."""
    if not len(thresholds):
        return np.zeros_like(score), np.ones_like(score)
    above = 1 - _sigmoid(thresholds[None, :] - score[:, None])
    return above.sum(axis=1), above[:, -1]


def rate(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, expected_grade, p_top) of every row; no shuffle.

    Null and empty texts score 0; repeated rows give one row each; an empty table gives none; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                s = scores(part.column("text"), model)
                expected, top = graded(s, model.thresholds)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(s), pa.array(expected), pa.array(top)], names=[key, "score", "expected_grade", "p_top"])

    return arrow_map(keyed(docs, key, text), run, key, "score double, expected_grade double, p_top double")


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose probability of the top grade is at least `least`."""
    names = docs.columns
    packed = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    schema = packed.select("row").withColumn("p_top", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                top = graded(scores(part.column("text"), model), model.thresholds)[1]
                keep = pa.array(top >= least)
                yield pa.RecordBatch.from_arrays([part.column("row").filter(keep), pa.array(top).filter(keep)], names=["row", "p_top"])

    return packed.mapInArrow(run, schema).select("row.*")


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from binary labels: 2 good, 1 poor, 0 toxic."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = fit(docs, ratings(documents(spark, folder, "labels")))
    return rate(docs, model).select(
        "doc_id", F.round("expected_grade", 6).alias("expected_grade"), F.round("p_top", 6).alias("p_top"), (F.col("p_top") >= 0.5).alias("accepted")
    )
