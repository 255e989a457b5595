"""Divergence of sources against brute force over whole vocabularies."""

import random
import re
from collections import Counter, defaultdict

from tests.llm.conftest import ODD
from trafficcast.llm import divergence as D

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _brute(rows, min_docs=3, top=200):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    langs = defaultdict(Counter)
    for text, lang, source in rows:
        found = Counter(_TERM.findall(_lower(text or "")))
        lang, source = lang or "", source or ""
        groups[lang, source].update(found)
        langs[lang].update(found)
        docs[lang].update(found.keys())
    out = set()
    for (lang, source), counts in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // q

        p = shares(counts)
        pairs = []
        for (other_lang, other), theirs in groups.items():
            if other_lang == lang and other != source:
                q = shares(theirs)
                pairs.append((other, sum(gap(p[t], q[t]) for t in kept)))
        q = shares(langs[lang])
        marks = [(t, gap(p[t], q[t])) for t in kept if counts[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", marks, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out |= {(lang, source, part, t, v, i + 1) for i, (t, v) in enumerate(ranked)}
    return out


def _docs(spark, rows):
    full = [(i, *r, "x", 1) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, term string, n long").repartition(3)


def _found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _rows(seed=5):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["Été", "日本", "ÀB", "Zz"]
    rows = []
    for _ in range(250):
        lang, source = rng.choice(["en", "fr", "", None]), rng.choice(["s0", "s0", "s1", "s2", "", None])
        rows.append((" ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 30))), lang, source))
    # Copies over several sources, and a group of its own without terms.
    rows += [("copied Text of wab wac", "en", f"s{i % 3}") for i in range(50)]
    rows += [(t, "xx", f"s{i % 4}") for i, t in enumerate(ODD)] + [("12 3", "en", "numbers"), (None, "zz", "only"), ("", "zz", None)]
    return rows


def test_equals_brute_force(spark):
    rows = _rows()
    assert _found(D.source_divergence(_docs(spark, rows))) == _brute(rows)


def test_limits_and_thresholds(spark, monkeypatch):
    monkeypatch.setattr(D, "PAIRS", 3)
    monkeypatch.setattr(D, "HELD", 2)
    rows = _rows(6)
    found = D.source_divergence(_docs(spark, rows), min_docs=1, top=4)
    assert _found(found) == _brute(rows, 1, 4)


def test_copies_are_split_into_terms_once(spark):
    rows = [("one text", "en", "a")] * 40 + [("one text", "en", None), ("one text", "fr", "a")]
    texts = D.collapsed(_docs(spark, rows)).collect()
    assert sorted((r.lang, sorted((c.source, c.m) for c in r.copies)) for r in texts) == [("en", [("", 1), ("a", 40)]), ("fr", [("a", 1)])]


def test_empty_table(spark):
    assert D.source_divergence(_docs(spark, [("x", "en", "a")]).limit(0)).count() == 0
