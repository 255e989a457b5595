"""Exact dedup against brute force, and collisions of its fingerprint."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, frame, fuzz
from trafficcast.llm import exact_dedup as E


def _brute(rows):
    """By key and text: (keep_id, size, sha) of every row."""
    groups = defaultdict(list)
    plain = [(k, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for k, t in rows]
    for k, t in plain:
        groups[t].append(k)
    keep = {t: min((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    return sorted(((k, keep[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for k, t in plain), key=repr)


def _found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_equals_brute_force(spark, texts):
    rows = [*ODD, *texts[:80], *texts[:40], *fuzz(300, "ab \n", 6), "a \t b", "a b", "a b ", " a b"]
    found = E.exact_copies(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == _brute(list(enumerate(rows)))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, "x  y"), (3, "x y"), (3, "x y"), (9, None), (4, ""), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = E.exact_copies(docs)
    assert _found(found) == _brute(rows)
    assert [r.doc_id for r in found.where("kept").orderBy("text_sha256").collect()].count(3) == 1
    assert found.where("kept").count() == 3
    assert E.exact_copies(docs.limit(0)).count() == 0


def test_chunks_combine(monkeypatch):
    texts = ["", "a", "abcd", "abcde", "x" * 100_000, "0123456789" * 9_000, "", "end"]
    whole = E.fingerprints(pa.array(texts)).tolist()
    slow = []
    for t in texts:
        raw = t.encode() + b"\0" * (-len(t) % 4)
        words = np.frombuffer(raw, "<u4").tolist()
        slow.append(sum((w + 1) * pow(E.BASE, i, E.PRIME) for i, w in enumerate(words)) % E.PRIME)
    assert whole == slow
    left, right = E.fingerprints(pa.array(["abcdefgh", "xyz"])).tolist()
    assert E.combined(left, 2, right) == E.fingerprints(pa.array(["abcdefghxyz"]))[0]


@pytest.mark.parametrize("size", [3, 70_000])
def test_collisions_are_told_apart(spark, monkeypatch, size):
    """With a fingerprint that says nothing, the comparison alone decides."""
    rows = ["a" * size + "1", "a" * size + "2", "a" * size + "1", "b" + "a" * size, None, "", "one two", "one  two"]
    docs = frame(spark, rows)
    blind = E._with_fingerprints

    def same(texts, keep_text):
        return blind(texts, keep_text).withColumn("fp", E.F.lit(7).cast("long"))

    monkeypatch.setattr(E, "_with_fingerprints", same)
    assert _found(E.exact_copies(docs)) == _brute(list(enumerate(rows)))


def test_kept_documents(spark):
    docs = frame(spark, ["same text", "same  text", "other", None, ""])
    assert sorted(r.doc_id for r in E.without_copies(docs).collect()) == [0, 2, 3]


def test_hot_group(spark):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = E.exact_copies(docs)
    assert found.where("kept").count() == 10_001
    assert found.agg({"group_size": "max"}).first()[0] == 20_000
