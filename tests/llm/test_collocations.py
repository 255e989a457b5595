"""Phrase collocations against brute force over all phrases."""

import gc
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD
from trafficcast.llm import collocations as C


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _counts(rows):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        sizes[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", _lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return counts, sizes


def _brute(rows, least, top):
    counts, sizes = _counts(rows)
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}

        def covered(p, a):
            return any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
            )

        kept = []
        for p, a in found.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not covered(p, a):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def _rows(seed):
    rng = random.Random(seed)
    words = ["a", "b", "Cd", "é", "the", "of", "x-1", "日本", "\x0b"[:0] + "z"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", ", "?"]) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "fr", None, ""])))
    rows += [("one same passage of many words here", "en")] * 30
    return rows + [(t, "odd") for t in ODD] + [(None, None), ("", "empty"), ("und too, und too", "und")]


def _docs(spark, rows):
    full = [(i, t, g, "x", 1, 2) for i, (t, g) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, phrase string, n long, shard long").repartition(5)


@pytest.mark.parametrize("words", [50, C.SHARD_WORDS])
def test_equals_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(C, "SHARD_WORDS", words)
    rows = _rows(3)
    found = C.phrase_collocations(_docs(spark, rows), least=4, top=40).collect()
    assert sorted(tuple(r) for r in found) == _brute(rows, 4, 40)


def test_shards_hold_no_more_than_asked(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD_WORDS", 500)
    rows = [("some words that come again and again", "en")] * 400
    parts = C.shards(_docs(spark, rows)).collect()
    assert len(parts) >= 5 and max(p["size"] for p in parts) < 3000
    assert sum(p["size"] for p in parts) == 2800


def test_intervals_of_both_indexes():
    rng = np.random.default_rng(1)
    pieces = [rng.integers(1, 6, rng.integers(1, 9)).tolist() for _ in range(200)]
    sequence = np.array([0, *(x for p in pieces for x in (*p, 0))], np.int64)
    words = pa.array(["v", "w", "x", "y", "z"])
    f = Counter(tuple(p[i : i + m]) for p in pieces for m in range(1, 5) for i in range(len(p) - m + 1))

    def named(length):
        return {" ".join(words[i - 1].as_py() for i in g): n for g, n in f.items() if len(g) == length}

    [(pairs, n)] = C.pairs_of(sequence, words, words)
    assert dict(zip(pairs.to_pylist(), n.tolist(), strict=True)) == named(2)
    for length, (phrases, n) in zip((3, 4), C.longer_of(sequence, words, pairs), strict=True):
        assert dict(zip(phrases.to_pylist(), n.tolist(), strict=True)) == named(length)


def test_empty_and_rare(spark):
    docs = _docs(spark, [("a b c", "en"), (None, None)])
    assert C.phrase_collocations(docs).count() == 0
    assert C.phrase_collocations(docs.limit(0)).count() == 0


def _pieces(seed, count, kinds):
    rng = np.random.default_rng(seed)
    pieces = [np.minimum(rng.geometric(4 / kinds, rng.integers(1, 30)), kinds).tolist() for _ in range(count)]
    return pieces, np.array([0, *(x for p in pieces for x in (*p, 0))], np.int32), pa.array([f"w{i:03}" for i in range(kinds)])


def test_steps_and_rounds_find_every_phrase_once(monkeypatch):
    """Long intervals stand alone, the others come some at a time; each pair belongs to one round."""
    monkeypatch.setattr(C, "_STEP_ROWS", 64)
    pieces, sequence, words = _pieces(2, 300, 40)
    f = Counter(tuple(p[i : i + m]) for p in pieces for m in range(1, 5) for i in range(len(p) - m + 1))

    def named(length):
        return {" ".join(words[i - 1].as_py() for i in g): n for g, n in f.items() if len(g) == length}

    found = [[x for p, n in C.pairs_of(sequence, words, words, turn) for x in zip(p.to_pylist(), n.tolist(), strict=True)] for turn in range(C.ROUNDS)]
    assert all(found) and sorted(sum(found, [])) == sorted(named(2).items())
    longer = list(C.longer_of(sequence, words, pa.array(list(named(2)))))
    assert len(longer) > 10
    for at, length in enumerate((3, 4)):
        rows = [x for p, n in longer[at::2] for x in zip(p.to_pylist(), n.tolist(), strict=True)]
        assert sorted(rows) == sorted(named(length).items())


def test_phrases_leave_as_they_are_found(monkeypatch):
    """What a search holds follows the words of its shard, not the phrases, of which there can be more."""
    monkeypatch.setattr(C, "_STEP_ROWS", 1 << 12, raising=False)
    _, sequence, words = _pieces(3, 8000, 900)
    pairs = pa.concat_arrays([p for p, _ in C.pairs_of(sequence, words, words)])
    gc.collect()
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    phrases = held = 0
    for p, _ in C.longer_of(sequence, words, pairs):
        phrases += len(p)
        held = max(held, pa.total_allocated_bytes() - before)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert phrases > len(sequence)
    assert held < 8 * len(sequence) and peak < 90 * len(sequence), (held / len(sequence), peak / len(sequence))
