"""Language evidence and the ordinal fit against plain loops."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import SMALL
from trafficcast.llm import language_id, quality

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _buckets(text):
    data = text.encode().translate(LOWER)
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in data)
    return [((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> 20 for a, b, c in zip(data, data[1:], data[2:])]


def _trained(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        if lang is not None:
            counts[lang].update(_buckets(text or ""))
    names = sorted(n for n in counts if counts[n])
    table = {n: {b: c + 1 for b, c in counts[n].items()} for n in names}
    totals = {n: sum(counts[n].values()) + 4096 for n in names}
    return names, [lambda b, n=n: math.log(table[n].get(b, 1) / totals[n]) for n in names]


def _parts(url, html):
    host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", url or "")
    host = host.group(1).lower() if host else ""
    declared = re.search(r"(?i)<html\b[^<>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", html or "")
    text = re.sub(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^<>]*>", " ", html or "")
    return {"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "declared": declared.group(1).lower() if declared else ""}, text


def _softmax(values):
    parts = [math.exp(v - max(values)) for v in values]
    return [p / sum(parts) for p in parts]


def _judged(pages, names, logs):
    """(lang, confidence) of each page: evidence of all others, by loops."""
    n, seen = len(names), []
    for _, url, html in pages:
        parts, text = _parts(url, html)
        grams = _buckets(text)
        ll = [0.3 * sum(log(b) for b in grams) for log in logs]
        seen.append((parts, ll, _softmax(ll)))
    sums = {c: defaultdict(lambda: [0.0] * n) for c in ("host", "domain", "suffix", "declared")}
    world = [sum(p[i] for _, _, p in seen) for i in range(n)]
    for parts, _, p in seen:
        for c, value in parts.items():
            sums[c][value] = [a + b for a, b in zip(sums[c][value], p)]
    out = []
    for parts, ll, p in seen:
        others = {c: [max(a - b, 0) for a, b in zip(sums[c][parts[c]], p)] for c in sums}
        sizes = {c: max(sum(sums[c][parts[c]]) - 1, 0) for c in sums}
        rest = [max(w - q, 0) for w, q in zip(world, p)]
        f = []
        for i, name in enumerate(names):
            wide = (rest[i] + 1) / (sum(world) - 1 + n)
            domain = (others["domain"][i] + 5 * wide) / (sizes["domain"] + 5)
            host = (others["host"][i] + 5 * domain) / (sizes["host"] + 5)
            score = ll[i] + math.log(host)
            score += math.log((others["suffix"][i] + 1 / (len(sums["suffix"]) + 1)) / (rest[i] + 1))
            if parts["declared"]:
                own = parts["declared"] == name
                score += math.log((others["declared"][i] + own + 1 / (len(sums["declared"]) + 1)) / (rest[i] + 2))
            f.append(score)
        share = _softmax(f)
        out.append((names[share.index(max(share))], max(share)))
    return out


def _same(found, pages, names, logs):
    expected = {page[0]: judged for page, judged in zip(pages, _judged(pages, names, logs))}
    assert len(found) == len(pages)
    for r in found:
        lang, confidence = expected[r.page_id]
        assert r.confidence == pytest.approx(confidence, abs=2e-4)
        assert r.lang == lang or confidence < 0.501


def test_languages_equal_loops_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, logs = _trained([tuple(r) for r in docs.select("text", "lang").collect()])
    pages = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    _same(language_id.op2_language_id(spark, SMALL).collect(), pages, names, logs)


def test_languages_equal_loops_on_odd_pages(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "de"), ("x", None), ("le chat", "fr")]
    names, table = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    mine, logs = _trained(rows)
    assert names == mine
    pages = [(1, "http://a.b.de/x", "<p>der hund"), (2, "HTTPS://u@A.B.de:80", "<html LANG = 'DE'><!-- the dog"), (3, None, None), (4, "b.de", "")]
    pages += [(5, "http://b.de?the", "<script>le chat</script>katze"), (6, "http://x.fr/", "<html lang=en><b>le chat"), (7, "", "<html lang=xx>the dog and the cat")]
    # Columns of the operator's own names, and pages that are there twice.
    frame = spark.createDataFrame([(*p, "w", 0.5, "t") for p in pages], "page_id long, url string, html string, key string, p double, text string")
    _same(language_id.identify(frame.repartition(3), names, table).collect(), pages, mine, logs)
    twice = language_id.identify(frame.union(frame), names, table)
    assert twice.count() == 2 * len(pages) and twice.distinct().count() == len(pages)
    assert language_id.identify(frame.limit(0), names, table).count() == 0


def _loss(words, shapes, t, rows, decay):
    """Penalised negative log likelihood a row, as the model states it."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    total = 0.0
    for grade, buckets, dense in rows:
        s = sum(words.get(b, 0.0) for b in buckets) + float(dense @ shapes)
        upper = sigmoid(t[grade] - s) if grade < len(t) else 1.0
        lower = sigmoid(t[grade - 1] - s) if grade else 0.0
        total -= math.log(upper - lower)
    return total / len(rows) + decay / 2 * sum(w * w for w in words.values()) + decay / 20 * float(shapes @ shapes)


def test_fit_is_where_the_stated_likelihood_is_flat():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(120):
        dense = np.zeros(quality.DENSE)
        dense[:3] = rng.uniform(0, 1, 3)
        buckets = np.flatnonzero(rng.uniform(size=6) < 0.5) * 1000
        pull = dense[0] * 2 + (0 in buckets) - (2000 in buckets) + rng.logistic()
        rows.append((int(np.searchsorted([0.3, 2.0], pull)), buckets, dense))
    sizes = np.array([len(b) for _, b, _ in rows])
    model = quality.fit_rows(np.array([g for g, _, _ in rows]), sizes, np.concatenate([b for _, b, _ in rows]), np.array([d for _, _, d in rows]), steps=4000)
    words, decay = {b: float(model.words[b]) for b in range(0, 6000, 1000)}, 3e-3
    assert not model.words[np.setdiff1d(np.arange(quality.BUCKETS), list(words))].any()
    loss = lambda w=words, v=model.shapes, t=model.thresholds: _loss(w, v, t, rows, decay)
    step = 1e-4
    slopes = [(loss(words | {b: words[b] + step}) - loss(words | {b: words[b] - step})) / (2 * step) for b in words]
    slopes += [(loss(v=model.shapes + d) - loss(v=model.shapes - d)) / (2 * step) for d in np.eye(quality.DENSE)[:4] * step]
    slopes += [(loss(t=model.thresholds + d) - loss(t=model.thresholds - d)) / (2 * step) for d in np.eye(2) * step]
    assert max(map(abs, slopes)) < 1e-3 and model.slope < 1e-3
    # The likelihood is concave: what is flat is the optimum. Probabilities are those of its formula.
    s = np.array([0.4])
    expected, top = quality.graded(s, model.thresholds)
    below = [1 / (1 + math.exp(-(t - 0.4))) for t in model.thresholds]
    assert top[0] == pytest.approx(1 - below[1]) and expected[0] == pytest.approx(2 - sum(below))
