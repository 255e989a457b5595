"""Quality, language, licences, lines and the pipeline."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, SMALL, frame
from tests.llm.test_copies import slow_components, slow_fingerprint
from trafficcast.llm import language_id, licenses, line_dedup, quality
from trafficcast.session import staged

MIDDLE = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rated = quality.ratings(spark.read.parquet(f"{MIDDLE}/labels.parquet"))
    model = quality.fit(docs, rated.where("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.rate(docs, model).join(rated.where("doc_id % 2 = 1"), "doc_id").collect()
    kept = lambda g: np.mean([r.p_top >= 0.5 for r in rows if r.grade == g])
    assert kept(2) > 0.9
    assert kept(1) < 0.5
    expected = lambda g: np.mean([r.expected_grade for r in rows if r.grade == g])
    assert expected(2) > expected(1) + 0.3
    assert expected(2) > expected(0)


def test_quality_of_odd_rows_and_few_labels(spark):
    docs = frame(spark, ODD)
    for labels in ([], [(0, 2)], [(1, 2), (4, 0), (None, 1), (5, None), (99, 1)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, grade int"))
        assert quality.rate(docs, model).count() == len(ODD)
        assert quality.accepted(docs, model).columns == docs.columns
    assert quality.accepted(docs, quality.fit(docs, spark.createDataFrame([(0, 2)], "doc_id long, grade int"))).count() == len(ODD)
    assert quality.rate(docs.limit(0), model).count() == 0


def test_language_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").where("length(text) > 100")
    names, table = language_id.train(docs.where("doc_id % 2 = 0"))
    pages = docs.where("doc_id % 2 = 1").select(F.col("doc_id").alias("page_id"), F.lit("http://a.b.example.org/x").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"), "lang")
    found = language_id.identify(pages, names, table).withColumnRenamed("lang", "found").join(pages, "page_id")
    assert found.where("found = lang").count() > 0.93 * found.count()


def test_declaration_host_and_suffix_decide_without_text(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("x", None)], "text string, lang string")
    names, table = language_id.train(docs)
    rows = [(i, "http://www.haus.de/", "<html lang='de'>der hund und die katze") for i in range(9)]
    rows += [(i, "http://www.home.com/", "<html lang=en><body>the cat and the dog") for i in range(10, 19)]
    rows += [(20, "http://www.haus.de/leer", ""), (21, None, '<html lang="en">'), (22, None, None), (23, "http://other.de", "<p></p>"), (None, "x", "y")]
    found = {r.page_id: r for r in language_id.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), names, table).collect()}
    assert len(found) == len(rows)
    assert [found[i].lang for i in (0, 10, 20, 21, 23)] == ["de", "en", "de", "en", "de"]
    assert all(0.5 <= r.confidence <= 1 for r in found.values())
    none = language_id.train(docs.limit(0))
    assert language_id.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), *none).where("lang is null").count() == len(rows)


def slow_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences_equal_brute_force(spark, texts):
    cases = [*ODD, "MIT License", "mit\n license, mit-license mit", "the Apache license and the GNU General  Public License v3", "mit lİcense mit license", "general public", *texts]
    cases += ["x " * 50 + licenses.TEMPLATES[0][1].upper() + " y", licenses.TEMPLATES[7][1], "permission is hereby granted"]
    rows = licenses.license_scan(frame(spark, cases)).collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_places(cases[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    named = {r.doc_id: r.labels for r in rows}
    assert (named[len(cases) - 3], named[len(cases) - 2], named[len(cases) - 1]) == ("mit", "bsd", "")
    assert licenses.license_scan(frame(spark, ["x"]).limit(0)).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def slow_lines(texts):
    seen, kept = [], []
    for text in texts:
        out = []
        for line in (text or "").split("\n"):
            trimmed = line.strip(" \t\r")
            near = [s for s in seen if len(s) >= 16] if len(trimmed) >= 16 else []
            bad = trimmed in seen if trimmed else False
            bad = bad or any(within_one(trimmed, s) for s in near)
            if trimmed:
                seen.append(trimmed)
            if not bad:
                out.append(line)
        kept.append("\n".join(out))
    return kept


def test_lines_equal_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog again and again until the sun goes down behind the old hills"
    edits = [base[:i] + "X" + base[i + j :] for i in (0, 1, 30, 63, 64, 65, 100, len(base)) for j in (0, 1)] + [base[:64], base[:63], base[:65], base[:128]]
    cases = [*(t for t in ODD if t is None or len(t) < 200), base, f"  {base}\t\nshort\n\nshort", "\n".join(edits), base[::-1] + "\n" + base[::-1][1:] + "é", base * 30, base * 15 + "!" + base * 15, "é" * 20 + "\n" + "é" * 21, "short\nshorn\n日本語の短い文。\n \n", "日本語の短い文。\nshort\n\n", "fifteen letters\nfifteen letterz\nsixteen letters!\nsixteen letterz!"]
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, cases)).collect()}
    expected = slow_lines(cases)
    assert {i: r.text or "" for i, r in rows.items()} == dict(enumerate(expected))
    assert line_dedup.dedup_lines(frame(spark, ["x"]).limit(0)).count() == 0


def test_lines_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{SMALL}/documents.parquet'")
    assert sorted(map(tuple, line_dedup.op4_line_dedup(spark, SMALL).collect())) == sorted(con.execute(line_dedup.OP4_SQL).fetchall())


def test_line_bounds_are_a_parameter(spark):
    cases = ["fifteen letters", "fifteen letterz", "fifteen letters"]
    texts = lambda n: [r.text for r in line_dedup.dedup_lines(frame(spark, cases), near_chars=n).orderBy("doc_id").collect()]
    assert texts(16) == [cases[0], cases[1], ""]
    assert texts(15) == [cases[0], "", ""]


def test_lines_of_null_keys_and_repeated_rows(spark):
    rows = [(None, "a line that is here twice"), (3, "a line that is here twice\nx"), (3, "a line that is here twice\nx"), (4, None)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text) for r in found.collect() if r.text is not None) == [(0, rows[0][1]), (3, "x"), (3, "x")]
    assert found.where("text is null").count() == 1


def test_quality_takes_a_key_once(spark):
    """Copies of a key, and ratings that repeat, change nothing; the fit says what slope it left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rated = quality.ratings(spark.read.parquet(f"{SMALL}/labels.parquet"))
    one = quality.fit(docs, rated)
    many = quality.fit(docs.union(docs).repartition(5), rated.union(rated))
    assert np.array_equal(one.words, many.words) and np.array_equal(one.thresholds, many.thresholds)
    assert 0 < one.slope < 0.01
    x = np.zeros(0, int)
    steps = [quality.fit_rows(np.arange(40) % 2, np.zeros(40, int), x, np.sin(np.arange(40 * quality.DENSE)).reshape(40, -1), n).slope for n in (10, 2000)]
    assert steps[1] < steps[0]


def test_simhash_stage_of_odd_rows(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "x"), (5, "another text of the same id with words of its own", "x"), (None, text, "x"), (2, text, "x"), (2, text, "x"), (8, None, "x"), (7, "", "x"), (None, "quite alone, these words", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    stage = dict(pipeline.STAGES)["simhash"]
    found = stage(spark, docs, SMALL)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in found.collect()) == sorted([(0, rows[7][1]), (2, text), (2, text), (5, rows[1][1]), (7, "")])
    assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_pipeline_keeps_its_contract(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = staged(stage(spark, before, SMALL), name)
        assert after.columns == docs.columns
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "simhash":
            prints = {r.doc_id: slow_fingerprint(r.text) for r in before.collect()}
            assert {r.doc_id for r in after.collect()} == set(slow_components(prints).values())
        before = after
    assert pipeline.run(spark, SMALL).count() == before.count()
