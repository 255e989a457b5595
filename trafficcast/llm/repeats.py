"""Removal of long repeated byte strings: equal contexts counted, differing ones merged as suffix orders.

A byte is removed if a string of SPAN bytes that covers it also starts anywhere else, in the same
text or another. Three steps keep the work in proportion to what repeats:

1. Anchors. Every window of SPAN bytes names the place of its least GRAM-byte hash (leftmost among
   equals). That depends on the window's bytes alone, so equal windows name equal grams at equal
   offsets. Consecutive windows naming one place form its context, the bytes from the first window's
   start to the last one's end. Every window lies in exactly one context.
2. Contexts that are equal as a whole repeat as a whole. That is a grouped count by the hash of the
   gram and, independent of it, the XXH3 digest of the whole context's bytes.
3. Only where a gram has several different contexts are bytes compared, one context of each kind. A
   group's contexts, aligned at their gram, are merged as Burrows-Wheeler transforms are: starting
   from the far end, the order of all suffixes that start at one column gives that of the column
   before by one stable counting step on the preceding byte, and the common prefix of two
   neighbours is one more than the least common prefix between them before. Runs of common prefixes
   of at least SPAN bytes at a column are the repeated intervals; no suffix is sorted anew.

A whole-corpus transform would need a refinement round over all bytes for each of SPAN bytes; here
rounds run over contexts, within one group of one gram. The contexts of a gram with more than GROUP
of them are dealt out, and their windows counted by 128-bit digests in Spark instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.bytesops import mixed, prefix_hash, slices, span_hash, text_bytes
from trafficcast.llm.common import documents, keyed, staged

SPAN = 200
GRAM = 48
GROUP = 20_000
#: Grams with more occurrences than this are dealt out by SALTS, those with SALTS times as many by its square, and so on.
HOT = 50_000
SALTS = 64
#: Contexts merged at once by one task.
TOGETHER = 8_000
#: Size of the bit tables that spare rows which cannot matter; they never decide.
TABLE_BITS = 24


class Contexts:
    """Anchors of one slice: place of the gram, first and last window, text, and the gram's hash."""

    def __init__(self, column: pa.Array, span: int, gram: int):
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        none = np.zeros(0, np.int64)
        self.span, self.gram = span, none.astype(np.uint64)
        self.at = self.low = self.high = self.owner = none
        self.sums = prefix_hash(self.data)
        if n < span:
            return
        places = np.arange(n - gram + 1)
        hashes = span_hash(self.sums, places, places + gram)
        # Least hash first, then the leftmost place.
        packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
        width, have = span - gram + 1, 1
        while have < width:
            step = min(have, width - have)
            packed = np.minimum(packed[: len(packed) - step], packed[step:])
            have += step
        turn = np.zeros(n + 2, np.int64)
        whole = np.diff(self.offsets) >= span
        np.add.at(turn, self.offsets[:-1][whole], 1)
        np.add.at(turn, self.offsets[1:][whole] - span + 1, -1)
        valid = np.cumsum(turn)[: len(packed)] > 0
        place = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
        self.low, self.high = np.flatnonzero(first), np.flatnonzero(last)
        self.at = place[self.low]
        self.owner = np.searchsorted(self.offsets, self.low, side="right") - 1
        self.gram = hashes[self.at]

    def names(self, keep: np.ndarray) -> np.ndarray:
        """Digests of the chosen contexts' bytes, seeded with the gram's place in them."""
        raw, digest = memoryview(self.data), xxhash.xxh3_64_intdigest
        chosen = zip(self.low[keep].tolist(), (self.high[keep] + self.span).tolist(), (self.at - self.low)[keep].tolist(), strict=True)
        return np.fromiter((digest(raw[a:b], s) for a, b, s in chosen), np.uint64, len(keep))


def _has(table: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(table, np.uint8)
    at = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _bit_table(hashes: DataFrame) -> bytes:
    """Bits of all values of the long column `h`; the driver gets 2**TABLE_BITS bits at most."""
    placed = hashes.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).alias("b"))
    words = placed.groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("v"))
    found = words.toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[found.column("w").to_numpy()] = found.column("v").to_numpy()
    return table.astype("<i8").tobytes()


def _packed(low: np.ndarray, lead: np.ndarray, more: np.ndarray) -> np.ndarray:
    """First window's start, the gram's offset from it, and the number of further windows."""
    return (low.astype(np.int64) << 24) | (lead << 12) | more


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences sorted by gram, salt and context: those whose context repeats, and each rival context once.

    Of a gram that is dealt out, every context counts as pending, as other tasks may have more of it.
    """
    names = ("gram", "salt", "context", "mark", "place")
    held: list[list[np.ndarray]] = []

    def found() -> pa.RecordBatch:
        gram, salt, context, mark, place = (np.concatenate(parts) for parts in zip(*held, strict=True))
        fresh_gram = np.ones(len(gram), bool)
        fresh_gram[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
        fresh = fresh_gram.copy()
        fresh[1:] |= context[1:] != context[:-1]
        of_context, of_gram = np.cumsum(fresh) - 1, np.cumsum(fresh_gram) - 1
        n = np.bincount(of_context)[of_context]
        kinds = np.bincount(of_gram, weights=fresh).astype(np.int64)[of_gram]
        whole, rival = np.flatnonzero(n > 1), np.flatnonzero(fresh & (kinds > 1) & (salt < 0))
        pending = np.flatnonzero(fresh & (salt >= 0))
        at = np.concatenate([whole, rival, pending])
        role = np.repeat(np.array(["whole", "rival", "pending"]), [len(whole), len(rival), len(pending)])
        return pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (mark, gram, context, place, n)] + [pa.array(role, pa.string())], names=["mark", "gram", "context", "place", "n", "role"])

    for batch in batches:
        if not len(batch):
            continue
        new = [batch.column(c).to_numpy() for c in names]
        if held and (held[-1][0][-1], held[-1][1][-1]) != (new[0][0], new[1][0]):
            yield found()
            held = []
        changes = np.flatnonzero((new[0][1:] != new[0][:-1]) | (new[1][1:] != new[1][:-1]))
        if len(changes):
            cut = int(changes[-1]) + 1
            held.append([x[:cut] for x in new])
            yield found()
            held, new = [], [x[cut:] for x in new]
        held.append(new)
    if held:
        yield found()


def _occurrence(key: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mixed(key.view(np.uint64) ^ mixed(low.astype(np.uint64)))


def _scan(marked: DataFrame, what: str, span: int, gram: int, table: bytes = b"", hot: tuple[bytes, ...] = ()) -> DataFrame:
    """One pass over the texts: grams, the occurrences the table has, or the contexts' bytes.

    Occurrences are dealt out by a power of SALTS for every table of `hot` that has their gram; bytes
    of such grams are dealt out by context.
    """
    schemas = {
        "grams": "h long",
        "places": "mark long, gram long, context long, place long, salt long",
        "bytes": "gram long, context long, lead int, bytes binary, alone boolean, salt long",
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                c = Contexts(part.column("text"), span, gram)
                if what == "grams":
                    yield pa.RecordBatch.from_arrays([pa.array(c.gram.view(np.int64))], names=["h"])
                    continue
                mark = part.column("mark").to_numpy()[c.owner]
                start = c.offsets[c.owner]
                low = c.low - start
                keep = np.flatnonzero(_has(table, c.gram if what == "places" else _occurrence(mark, low)))
                context = c.names(keep)
                longs = [pa.array(x.view(np.int64)) for x in (c.gram[keep], context)]
                level = sum((_has(h, c.gram[keep]).astype(np.uint64) for h in hot), np.zeros(len(keep), np.uint64))
                if what == "places":
                    turn = _occurrence(mark[keep], low[keep]) % np.uint64(SALTS) ** level
                    salt = np.where(level > 0, turn.view(np.int64), -1)
                    place = pa.array(_packed(low, c.at - c.low, c.high - c.low)[keep])
                    yield pa.RecordBatch.from_arrays([pa.array(mark[keep]), *longs, place, pa.array(salt)], names=["mark", "gram", "context", "place", "salt"])
                else:
                    raw = c.data.tobytes()
                    texts = [raw[a:b] for a, b in zip(c.low[keep].tolist(), (c.high[keep] + span).tolist(), strict=True)]
                    lead = pa.array((c.at - c.low)[keep].astype(np.int32))
                    alone = level > 0
                    salt = pa.array(np.where(alone, context.view(np.int64), 0))
                    columns = [*longs, lead, pa.array(texts, pa.binary()), pa.array(alone), salt]
                    yield pa.RecordBatch.from_arrays(columns, names=["gram", "context", "lead", "bytes", "alone", "salt"])

    return marked.mapInArrow(run, schemas[what])


def repeated_columns(groups: np.ndarray, leads: np.ndarray, texts: list[bytes], span: int, gram: int) -> np.ndarray:
    """For contexts of ascending groups: which windows, by start from -(span-gram) to 0, repeat.

    Rows are contexts, columns window starts relative to the gram.
    """
    n, back = len(texts), span - gram
    sizes = np.array([len(t) for t in texts])
    letters = np.zeros((back + span, n), np.uint16)
    for i, text in enumerate(texts):
        letters[back - leads[i] : back - leads[i] + len(text), i] = np.frombuffer(text, np.uint8).astype(np.uint16) + 1
    found = np.zeros((back + 1, n), bool)
    group = np.unique(groups, return_inverse=True)[1].astype(np.int64) * 257
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    common[1:n][groups[1:] == groups[:-1]] = 0
    for column in range(back + span - 1, -1, -1):
        # All contexts of a group stay together, so `group` is ascending in any such order.
        names = group + letters[column, order]
        move = np.argsort(names, kind="stable")
        named = names[move]
        same = np.flatnonzero(named[1:] == named[:-1]) + 1
        fresh = np.zeros(n + 1, np.int32)
        if len(same):
            bounds = np.empty(2 * len(same), np.int64)
            bounds[::2], bounds[1::2] = move[same - 1] + 1, move[same] + 1
            # Absent bytes (0) are never common.
            least = np.minimum.reduceat(common, bounds)[::2] + 1
            fresh[same] = np.where(letters[column, order[move[same]]] > 0, least, 0)
        order, common = order[move], fresh
        if column <= back:
            start = column - back
            inside = (start >= -leads[order]) & (start + span <= sizes[order] - leads[order])
            pairs = np.flatnonzero((common[1:n] >= span) & inside[1:] & inside[:-1]) + 1
            found[column, order[pairs]] = True
            found[column, order[pairs - 1]] = True
    return found.T


def _merged(span: int, gram: int):
    """Streams groups of contexts, sorted by gram; gives (gram, context, from, to) window starts.

    Contexts that were dealt out give all their windows with digests instead.
    """
    back = span - gram

    def batch_of(grams, contexts, starts, ends, one=None, two=None) -> pa.RecordBatch:
        hashes = [pa.nulls(len(grams), pa.int64()) if x is None else pa.array(x) for x in (one, two)]
        ints = [pa.array(x.astype(np.int32)) for x in (starts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(contexts), *ints, *hashes], names=["gram", "context", "from", "to", "w1", "w2"])

    def resolve(rows: list) -> pa.RecordBatch:
        # The bit table may let through further places of a context; one of each is compared.
        rows = list({(r[0], r[1]): r for r in rows}.values())
        grams = np.array([r[0] for r in rows])
        found = repeated_columns(grams, np.array([r[2] for r in rows]), [r[3] for r in rows], span, gram)
        edge = np.zeros((len(rows), 1), bool)
        steps = np.diff(np.concatenate([edge, found, edge], axis=1).astype(np.int8), axis=1)
        row, begin = np.nonzero(steps == 1)
        end = np.nonzero(steps == -1)[1]
        return batch_of(grams[row], np.array([r[1] for r in rows])[row], begin - back, end - 1 - back)

    def windows(row) -> pa.RecordBatch:
        """Every window of a context by both halves of its 128-bit digest."""
        name, context, lead, text = row
        starts = np.arange(len(text) - span + 1)
        digests = b"".join(xxhash.xxh3_128_digest(text[s : s + span]) for s in starts.tolist())
        halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
        same = np.ones(len(starts), np.int64)
        return batch_of(same * name, same * context, starts - lead, starts - lead, halves[:, 0], halves[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for *row, alone in zip(*(batch.column(c).to_pylist() for c in ("gram", "context", "lead", "bytes", "alone")), strict=True):
                if alone:
                    yield windows(row)
                    continue
                if held and row[0] != held[-1][0] and len(held) >= TOGETHER:
                    yield resolve(held)
                    held = []
                held.append(row)
        if held:
            yield resolve(held)

    return run


def repeated_spans(marked: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(mark, start, end): stretches of bytes covered by repeated strings, as found.

    `marked` has mark and text; no mark occurs twice. `span` may exceed `gram` by 4,095 at most.
    """
    if not 0 <= span - gram < 4096:
        raise ValueError("span must be gram to gram + 4095")
    grams = staged(_scan(marked, "grams", span, gram).groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    most, hot, least = grams.agg(F.max("n")).first()[0] or 0, (), HOT
    while most > least:
        hot, least = (*hot, _bit_table(grams.where(F.col("n") > least))), least * SALTS
    places = _scan(marked, "places", span, gram, _bit_table(grams), hot)
    dealt = places.select("gram", "salt", "context", "mark", "place").repartition("gram", "salt").sortWithinPartitions("gram", "salt", "context")
    judged = dealt.mapInArrow(_judged, "mark long, gram long, context long, place long, n long, role string")
    judged = staged(judged, "judged")
    contested = judged.where("role = 'rival'").select("mark", "gram", "context", "place", "n")
    repeated = judged.where("role = 'whole'").select("mark", "place")
    pending = judged.where("role = 'pending'")
    if pending.limit(1).count():
        # A row for each context and salt at most.
        kinds = pending.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.min(F.struct("mark", "place")).alias("one"))
        kinds = staged(kinds, "kinds")
        several = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
        contested = contested.union(kinds.join(several, "gram").select("one.mark", "gram", "context", "one.place", "n"))
        single = pending.where("n = 1").select("gram", "context", "mark", "place")
        repeated = repeated.union(single.join(kinds.where("n > 1").select("gram", "context"), ["gram", "context"]).select("mark", "place"))
        contested = staged(contested, "contested")
    marks = contested.select("mark", "place").mapInArrow(_named_occurrences, "h long")
    crowded = contested.groupBy(F.col("gram").alias("h")).agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    texts = _scan(marked, "bytes", span, gram, _bit_table(marks), (_bit_table(crowded),))
    texts = texts.repartition("gram", "salt").drop("salt").sortWithinPartitions("gram")
    merged = staged(texts.mapInArrow(_merged(span, gram), "gram long, context long, `from` int, `to` int, w1 long, w2 long"), "merged")
    names = ["gram", "from", "w1", "w2"]
    # Places that the bit table lets through may give a window twice; each context counts once.
    windows = merged.where("w1 is not null").select("context", *names).distinct()
    often = windows.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    counted = windows.join(often, names).select("gram", "context", "from", F.col("from").alias("to"))
    parts = merged.where("w1 is null").select("gram", "context", "from", "to").union(counted)
    low, lead = F.shiftright("place", 24), F.shiftright("place", 12).bitwiseAND(F.lit(4095))
    whole = repeated.select(
        "mark", low.alias("start"), (low + F.col("place").bitwiseAND(F.lit(4095)) + span).alias("end")
    )
    some = contested.where("n = 1").join(parts, ["gram", "context"]).select(
        "mark", (low + lead + F.col("from")).alias("start"), (low + lead + F.col("to") + span).alias("end")
    )
    return whole.union(some)


def _named_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = _occurrence(batch.column("mark").to_numpy(), batch.column("place").to_numpy() >> 24)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts, as they are shuffled whole."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in slices(batch, "text"):
            packed = [press.compress(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("mark"), pa.array(packed, pa.binary())], names=["key", "mark", "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            rows = zip(part.column("packed").to_pylist(), part.column("spans").to_pylist(), strict=True)
            sizes, removed, runs, kept = [], [], [], []
            for packed, spans in rows:
                data, upto, out, count, gone = press.decompress(packed), 0, [], 0, 0
                for s in sorted((s["start"], s["end"]) for s in spans or ()):
                    if s[0] > upto or not count:
                        count += 1
                    out.append(data[upto : max(upto, s[0])])
                    gone += max(0, s[1] - max(upto, s[0]))
                    upto = max(upto, s[1])
                out.append(data[upto:])
                sizes.append(len(data))
                removed.append(gone)
                runs.append(count)
                kept.append(b"".join(out))
            longs = [pa.array(x, pa.int64()) for x in (sizes, removed, runs)]
            yield pa.RecordBatch.from_arrays([part.column("key"), *longs, pa.array(kept, pa.binary())], names=["key", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row; kept is the rest, as bytes.

    Null and empty texts, and texts shorter than `span`, repeat nothing and hold no other text;
    repeated rows repeat each other; null keys are keys like any other; an empty table gives none;
    other columns are ignored. Writes its steps to the shared folder when called.
    """
    plain = keyed(docs, key, text).withColumn("name", F.xxhash64("key", "text"))
    # Rows that share a name are told apart, and are one another's repeats, by key and a running number.
    twice = staged(plain.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "twice")
    marked = plain.select("key", F.col("name").alias("mark"), "text")
    if twice.limit(1).count():
        alone = plain.join(twice, "name", "left_anti").select("key", F.col("name").alias("mark"), "text")
        rows = plain.join(twice, "name").groupBy("key", "name").agg(F.count("*").alias("n"), F.first("text").alias("text"))
        copies = rows.select("key", "name", "text", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
        marked = staged(alone.union(copies.select("key", F.xxhash64("name", "key", "i"), "text")), "marked")
    spans = repeated_spans(marked, span, gram).groupBy("mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    kind = marked.schema["key"].dataType.simpleString()
    packed = marked.mapInArrow(_squeezed, f"key {kind}, mark long, packed binary")
    joined = packed.join(spans, "mark", "left").select("key", "packed", "spans")
    found = joined.mapInArrow(_cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return found.withColumnRenamed("key", key)


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(documents(spark, folder))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
