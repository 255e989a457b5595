"""SimHash, digests and decontamination against brute force."""

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.conftest import ODD, SMALL, frame, fuzz
from trafficcast.llm import decontaminate, doc_digest, simhash
from trafficcast.llm.components import connected_components
from trafficcast.llm.xxh import xxh64

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    """Smallest key reachable over links of at most four bits."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {k: top(k) for k in keys}


def test_xxh64_of_every_length():
    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    starts = np.arange(400)
    lengths = np.arange(400)
    raw = data.tobytes()
    expected = [xxhash.xxh64_intdigest(raw[s : s + n], 42) for s, n in zip(starts, lengths, strict=True)]
    assert xxh64(data, starts, lengths).tolist() == expected


def test_long_texts_take_several_runs():
    text = "a b c d e " * 40_000
    assert simhash.fingerprints_of(pa.array([text, "q"]), 4).tolist() == [slow_fingerprint(text), slow_fingerprint("q")]


def test_near_duplicates_equal_brute_force(spark, texts):
    cases = ODD + texts[:80] + [t + " end" for t in texts[:10]] + [t.replace(" the ", " a ", 1) for t in texts[10:30]]
    prints = {i: slow_fingerprint(t) for i, t in enumerate(cases)}
    expected = slow_components(prints)
    rows = simhash.near_duplicates(frame(spark, cases)).collect()
    assert {r.doc_id: r.fp & (2**64 - 1) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert len(set(expected.values())) < len(cases)


@pytest.mark.parametrize("bucket", [2048, 16])
def test_links_of_dense_groups(spark, monkeypatch, bucket):
    """Near fingerprints in one bucket, dealt out by chunks or not."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**62))
    prints = {i: base ^ sum(1 << int(b) for b in rng.integers(0, 62, 3)) for i in range(150)}
    prints |= {150 + i: int(rng.integers(0, 2**63)) for i in range(50)}
    distinct = spark.createDataFrame([(v,) for v in set(prints.values())], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(distinct)).collect()}
    groups = {}
    for k, v in prints.items():
        groups.setdefault(roots.get(v, v), []).append(k)
    assert {k: min(g) for g in groups.values() for k in g} == slow_components(prints)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_digests_of_neighbours(spark, texts):
    cases = ODD + texts[:100]
    rows = {r.doc_id: r for r in doc_digest.neighbour_digests(frame(spark, cases)).collect()}
    plain = {r.doc_id: r.fingerprint for r in doc_digest.fingerprints(frame(spark, cases)).collect()}
    assert sorted(rows) == list(range(len(cases)))
    for i in rows:
        text, after = cases[i] or "", cases[(i + 1) % len(cases)] or ""
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert rows[i].fingerprint == plain[i] == doc_digest.written(doc_digest.digest([text.encode()]))[0]
        assert rows[i].edited_fingerprint == doc_digest.written(doc_digest.digest([changed.encode()]))[0]
        a, b, c = (doc_digest.read_back(x)[None] for x in (plain[i], rows[i].edited_fingerprint, plain[(i + 1) % len(cases)]))
        assert rows[i].near_edited == pytest.approx(doc_digest.likeness(a, b)[0])
        assert rows[i].near_next == pytest.approx(doc_digest.likeness(a, c)[0])
        assert 0 <= rows[i].near_next <= 1
    long = [r for i, r in rows.items() if len(cases[i] or "") > 300 and i < len(cases) - 1]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.1


def slow_digest(text):
    data, counts = text.encode(), [0] * 128
    for a, b, c in zip(data, data[1:], data[2:]):
        counts[((a * 65536 + b * 256 + c) * 0x9E3779B1) % 2**32 // 2**25] += 1
    quarters = [sorted(counts)[n] for n in (31, 63, 95)]
    return [sum(n > q for q in quarters) for n in counts], min(round(8 * math.log2(1 + len(data))), 255)


def slow_hex(codes, size):
    return "".join(f"{a * 64 + b * 16 + c * 4 + d:02x}" for a, b, c, d in zip(*[iter(codes)] * 4)) + f"{size:02x}"


def slow_likeness(one, two):
    far = sum(abs(a - b) for a, b in zip(one[0], two[0])) + min(abs(one[1] - two[1]), 16)
    return max(0.0, 1 - far / 176)


def test_digests_equal_brute_force(spark, texts):
    cases = [t for t in ODD if t is None or len(t) < 1000] + texts[:60]
    whole = [t or "" for t in cases]
    prints = [slow_digest(t) for t in whole]
    rows = doc_digest.neighbour_digests(frame(spark, cases).repartition(40)).collect()
    assert len(rows) == len(cases)
    for r in rows:
        text, onto = whole[r.doc_id], (r.doc_id + 1) % len(cases)
        quarter = len(text) // 4
        changed = slow_digest(text[: len(text) - quarter] + whole[onto][:quarter])
        assert (r.fingerprint, r.edited_fingerprint) == (slow_hex(*prints[r.doc_id]), slow_hex(*changed))
        assert r.near_edited == pytest.approx(slow_likeness(prints[r.doc_id], changed))
        assert r.near_next == pytest.approx(slow_likeness(prints[r.doc_id], prints[onto]))


def test_digests_of_null_and_repeated_keys(spark):
    rows = [(3, "bbbb"), (3, "aaaa"), (None, "cccc"), (3, "bbbb"), (9, None)]
    found = doc_digest.neighbour_digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    ordered = ["cccc", "aaaa", "bbbb", "bbbb", ""]
    shas = [hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest() for t, n in zip(ordered, ordered[1:] + ordered[:1])]
    assert sorted(r.edited_sha256 for r in found) == sorted(shas)
    assert sorted(r.doc_id or 0 for r in found) == [0, 3, 3, 3, 9]


def test_near_duplicates_of_null_and_repeated_keys(spark):
    text = "one two three four five six"
    rows = [(None, text), (4, text), (4, text), (2, text), (4, "words of another document of that key"), (None, "alone here as well, without a key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(docs).collect())
    assert found == [(0, 0), (0, 2), (2, 2), (4, 2), (4, 2), (4, 4)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_digest_of_one_row_and_none(spark):
    one = doc_digest.neighbour_digests(frame(spark, ["abcdefgh"])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert doc_digest.neighbour_digests(frame(spark, ["x"]).limit(0)).count() == 0


def slow_contamination(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, names = split(text), set(), set()
    for name, item in items:
        own = split(item)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_contamination_equals_brute_force(spark):
    few = [w for w in fuzz(2000, "ab", 2, 5)]
    docs = [" ".join(few[i : i + 60]) for i in range(0, 1800, 40)] + ODD + ["Tail, ends HERE now!", None]
    words = " ".join(few).split()
    items = [" ".join(words[i : i + n]) for i, n in ((0, 13), (5, 30), (100, 14), (200, 12), (300, 20), (310, 20), (400, 5), (420, 8))]
    items += ["ends here", "", None, items[0], "never seen words " * 6, "?!"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, key string")
    rows = decontaminate.contamination(frame(spark, docs), bench).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_hit, r["items"]) == slow_contamination(docs[r.doc_id], list(enumerate(items)))
    assert sum(r.n_hit > 0 for r in rows) > 4


def test_contamination_of_repeated_and_null_keys(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "z"), (None, "a b"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b")], "item_id long, text string")
    found = sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in decontaminate.contamination(docs, bench).collect())
    assert found == [(0, 0, 0), (0, 2, 2), (1, 1, 0), (1, 3, 2), (1, 3, 2)]
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_queries_cover_the_table(spark):
    for query in (simhash.op5_simhash, doc_digest.op6_digests, decontaminate.op9_decontamination):
        assert query(spark, SMALL).count() == 200
