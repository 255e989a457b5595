"""Removal of repeated strings against brute force."""

from collections import Counter

import pyarrow as pa
import pytest

from tests.llm.conftest import ODD, SMALL, frame, fuzz
from trafficcast.llm import repeats


def slow_removal(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + span] for t in raw for i in range(len(t) - span + 1))
    found = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        found.append((len(t), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), kept))
    return found


def cases(texts):
    noise = fuzz(40, "abcdefgh ", 900, 4)
    passage = texts[0][:450]
    return [
        *[t if t is None or len(t) < 5000 else t[:700] for t in ODD],
        *noise, *noise[:5],
        *[n[:300] + passage[i : i + 260] + n[300:] for i, n in enumerate(noise[:20])],
        *[n[:150] + "X" + n[151:] for n in noise[10:30]],
        "ab" * 400, "\0" * 230, "\0" * 199, "y" * 150 + "z" + "y" * 260, passage[:200], *texts[:40],
    ]


@pytest.mark.parametrize(("group", "hot"), [(20_000, 50_000), (3, 4)])
def test_removal_equals_brute_force(spark, texts, monkeypatch, group, hot):
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "TOGETHER", 50)
    data = cases(texts)
    expected = slow_removal(data, 200)
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame(spark, data)).collect()}
    assert [rows[i] for i in range(len(data))] == expected
    assert sum(r[1] > 0 for r in expected) > 30


def test_repeated_rows_null_keys_and_none(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "short"), (None, None)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert found == [(0, 0, 0), (0, 5, 0), (1, 300, 300), (1, 300, 300)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_strings_that_polynomials_take_for_equal(spark):
    """Thue-Morse strings and their complements, whole and dealt out."""
    a = "".join("es"[bin(i).count("1") % 2] for i in range(1024))
    data = [a, a.translate(str.maketrans("es", "se")), "x" + a[:1000], "end"]
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame(spark, data), span=600).collect()}
    assert [rows[i] for i in range(len(data))] == slow_removal(data, 600)
    with pytest.raises(ValueError):
        repeats.remove_repeats(frame(spark, data), span=9000)


def test_judged_streams_groups_over_batches():
    """A group that spans many batches comes out once, as if it had been in one."""
    rows = [(1, -1, 5, i, i) for i in range(10)] + [(1, -1, 6, 10, 10)] + [(2, 0, 7, 11, 11)] + [(2, 1, 7, 12, 12)] + [(3, -1, 8, 13, 13)]
    names = ["gram", "salt", "context", "mark", "place"]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], names=names)
    whole = pa.Table.from_batches(repeats._judged(iter([batch(rows)]))).sort_by("mark")
    for size in (1, 2, 3, 7):
        parts = [batch(rows[i : i + size]) for i in range(0, len(rows), size)]
        assert pa.Table.from_batches(repeats._judged(iter(parts))).sort_by("mark").equals(whole)


def test_query_covers_the_table(spark):
    assert repeats.op8_repeats(spark, SMALL).count() == 200
