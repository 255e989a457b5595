"""Licence scans and page texts stay linear in the length of one text, and equal brute force."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, frame, fuzz
from trafficcast.llm import language_id, licenses

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _brute(texts):
    """labels and score of every text, from the definition, with IDF over all of them."""
    import math

    index = licenses._index()
    docs = [_words(t) for t in texts]
    vocabulary = {w for t in index for _, w in t["places"]}
    df = {w: sum(w in set(d) for d in docs) for w in vocabulary}
    idf = {w: 1 + math.log((1 + len(docs)) / (1 + n)) for w, n in df.items() if n}
    top = max(idf.values(), default=1.0)
    out = []
    for d in docs:
        labels, score, starts = set(), 0.0, []
        joined = " " + " ".join(d) + " "
        for t in index:
            weight = {at: idf.get(w, top) for at, w in t["places"]}
            if f" {t['key_phrase']} " not in joined:
                continue
            order = sorted(t["places"], key=lambda p: (-weight[p[0]], p[0]))
            rare = order[: 1 if t["base"] else licenses.RAREST]
            for start in {i - at for at, w in rare for i, x in enumerate(d) if x == w}:
                here = [at for at, w in t["places"] if 0 <= start + at < len(d) and d[start + at] == w]
                if t["base"] and (len(here) < len(weight) or start < 0):
                    continue
                share = 1.0 if t["base"] else min(1.0, sum(weight[a] for a in here) / sum(weight.values()))
                score = max(score, share)
                if t["base"]:
                    starts.append(start)
                if t["base"] or share >= licenses.ENOUGH:
                    labels.add(t["label"])
        out.append((len(starts), ",".join(sorted(labels)), round(score, 9)))
    return out


def test_own_labels_and_scores_equal_brute_force(spark, texts):
    notices = [t for _, t, _ in licenses.TEMPLATES]
    damaged = []
    for i, t in enumerate(notices):
        words = t.split(" ")
        damaged += [" ".join(w if (k + i) % 5 else "zzz" for k, w in enumerate(words)), " ".join(words[i % 4 :]), "x y " + t.upper() + " z"]
    cases = [*ODD, *notices, *damaged, *fuzz(60, ["mit ", "license ", "the ", "apache ", "cc by ", "sa 4 0 ", "gnu "], 12), *texts[:60]]
    rows = {r.doc_id: (r.n_base, r.labels, round(r.score, 9)) for r in licenses.license_scan(frame(spark, cases)).collect()}
    assert [rows[i] for i in range(len(cases))] == _brute(cases)


def test_recall_of_damaged_notices(spark):
    """Notices with every fifth word gone, at each of five offsets, as long as their key phrase stands."""
    cases, expected = [], []
    for drop in range(5):
        for label, text, key in licenses.TEMPLATES:
            words, held = text.split(" "), set(key.split(" "))
            cases.append(" ".join(w if w in held or (i + drop) % 5 else "other" for i, w in enumerate(words)))
            expected.append(label)
    rows = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(frame(spark, cases)).collect()}
    recall = sum(label in rows[i] for i, label in enumerate(expected)) / len(cases)
    print("recall", recall)
    assert recall >= 0.9


def test_repeated_rows_and_null_keys_count_alone(spark):
    rows = [(1, "the MIT license"), (1, "the MIT license"), (None, "the MIT license"), (None, None)]
    found = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_base, r.first_word, r.labels) for r in found if r.n_base) == [(1, 1, "mit")] * 3 and len(found) == 4


def test_a_long_licence_text(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("mit license "), 100_000).alias("text"))
    started = time.monotonic()
    row = licenses.license_scan(docs).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (200_000, 100_000, 0, 199_998)
    assert time.monotonic() - started < 60


@pytest.mark.parametrize("part", ["<script>x", "<!-- x", "<", "<html ", "<style", "<a href="])
def test_a_long_page_of_unclosed_tags(spark, part):
    pages = spark.range(1).select(F.col("id").alias("page_id"), F.lit("http://a.de/").alias("url"), F.repeat(F.lit(part), 100_000).alias("html"))
    started = time.monotonic()
    assert language_id.page_parts(pages, "page_id", "url", "html").first().host == "a.de"
    assert time.monotonic() - started < 30


def test_page_text(spark):
    rows = [
        (1, "<html lang=de><script>var a</script>Ein <b>Text</b><style>x</style><!-- weg -->!", "Ein Text !", "de"),
        (2, "davor <script>nie zu", "davor", ""),
        (3, "a < b und <i>c</i>", "a < b und c", ""),
        (4, "x <!-- y", "x", ""),
        (5, None, "", ""),
    ]
    pages = spark.createDataFrame([(i, "http://h.org", t, "w") for i, t, _, _ in rows], "page_id long, url string, html string, text string")
    found = {r.key: (" ".join(r.text.split()), r.declared) for r in language_id.page_parts(pages, "page_id", "url", "html").collect()}
    assert found == {i: (text, lang) for i, _, text, lang in rows}
