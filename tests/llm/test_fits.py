"""The fits of the classifiers against plain versions over whole tables: language, quality and toxicity."""

import math
import random
import statistics
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import TEXTS, documents  # noqa: F401

from tidemark.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.001"


# --- language -------------------------------------------------------------------


def plain_buckets(text):
    chars = [ord(c) for c in text.lower()]
    for n in (1, 2, 3):
        for i in range(len(chars) - n + 1):
            h = n
            for c in chars[i : i + n]:
                h = (h * 0x01000193 % 2**32) ^ c
            yield (h * 0x85EBCA6B % 2**32) >> 17


def plain_languages(rows):
    """``(doc_id, held_out, lang, score)`` by counting every n-gram of every text."""
    grams, docs = {}, Counter()
    for i, text, lang, _ in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            grams.setdefault(lang, Counter()).update(plain_buckets(text or ""))
            docs[lang] += 1
    out = []
    for i, text, _, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        if not any(c.isalpha() for c in text or ""):
            out.append((i, held, "und", 0.0))
            continue
        found = Counter(plain_buckets(text))
        logs = {}
        for lang in sorted(grams):
            total = sum(grams[lang].values()) + 0.5 * 2**15
            logs[lang] = math.log(docs[lang] / sum(docs.values())) + sum(n * math.log((grams[lang][b] + 0.5) / total) for b, n in found.items())
        best = max(logs, key=logs.get)
        out.append((i, held, best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())))
    return out


def test_languages_match_plain_counts(spark, documents):  # noqa: F811
    rnd = random.Random(4)
    alphabets = {"aa": "abcdef", "bb": "defghi", "cc": "ghiäöa"}
    rows = []
    for i in range(90):
        lang = rnd.choice(list(alphabets))
        words = ("".join(rnd.choice(alphabets[lang]) for _ in range(rnd.randrange(1, 6))) for _ in range(rnd.randrange(1, 25)))
        rows.append((i, rnd.choice([" ", "\n"]).join(words).title(), rnd.choice([lang, lang, lang, None]), "s"))
    rows += [(100 + i, t, rnd.choice(["aa", None]), "s") for i, t in enumerate(TEXTS)] + [(None, "abc", "bb", "s"), rows[7], rows[7]]
    got = langid.identify(documents(rows).repartition(4)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got, want = sorted(map(tuple, got), key=order), sorted(plain_languages(rows), key=order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_language_batches_match_single_texts(monkeypatch):
    rng = np.random.default_rng(3)
    model = langid.LanguageModel(["a", "b", "c"], rng.normal(size=(langid.BUCKETS + 1, 3)))
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abc é漢İ") for _ in range(rnd.choice([1, 2, 3, 17, 39, 40, 41, 200]))) for _ in range(120)]
    for chunk in (40, 1 << 19):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert model.batch_scores(texts) == pytest.approx(np.stack([model.log_scores(t) for t in texts]))
    assert model.best(["", "12 34", "..."]) == [(None, 0.0, 0.0)] * 3


# --- quality --------------------------------------------------------------------


def plain_statistics(text):
    raw = text.encode()
    if not raw:
        return [0.0] * 17

    def share(part, whole):
        return math.log((part + 0.5) / (whole - part + 0.5)) if whole else 0.0

    words, lines = raw.split(), raw.split(b"\n")
    sizes = [len(w) for w in words]
    stops = sum(raw.count(c) for c in (b".", b","))
    marks = sum(1 for c in raw if 33 <= c < 127 and not chr(c).isalnum() and c not in b".,")
    return [
        math.log(1 + len(raw)), math.log(1 + len(words)),
        math.log(1 + statistics.fmean(sizes)) if words else 0.0, math.log(1 + statistics.pstdev(sizes)) if words else 0.0,
        share(sum(n <= 3 for n in sizes), len(words)), share(sum(65 <= c <= 90 for c in raw), len(raw)), share(sum(48 <= c <= 57 for c in raw), len(raw)),
        share(marks, len(raw)), share(raw.count(b"|"), len(raw)), share(stops, max(len(words), stops)), share(sum(c in b" \t\n\r\x0b\x0c" for c in raw), len(raw)),
        share(len(set(words)), len(words)), share(sum(a == b for a, b in zip(words, words[1:])), max(0, len(words) - 1)),
        -sum(n / len(raw) * math.log(n / len(raw)) for n in Counter(raw).values()),
        math.log(1 + len(lines)), share(len(set(lines)), len(lines)), share(sum(line[-1:] in (b".", b"!", b"?") for line in lines), len(lines)),
    ]


def test_quality_matches_plain_moments(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    x = {r.doc_id: plain_statistics(r.text or "") for r in docs.collect()}
    marks = [(r.doc_id, r.quality) for r in labels.collect() if r.quality in (0, 1) and r.doc_id in x and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    own = [np.array([x[i] for i, y in marks if y == k]) for k in (0, 1)]
    spread = [np.cov(o.T, bias=True) for o in own]
    pooled = sum(len(o) * c for o, c in zip(own, spread)) / len(marks)
    logs = []
    for o, c in zip(own, spread):
        c = 0.9 * c + 0.1 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + 1e-6 * np.eye(17)
        away = np.array(list(x.values())) - o.mean(axis=0)
        logs.append(math.log(len(o) / len(marks)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", away, np.linalg.solve(c, away.T).T))
    want = dict(zip(x, 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / 4, -500, 500)))))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert got.keys() == want.keys() and len(marks) > 50
    assert [got[i].score for i in want] == pytest.approx(list(want.values()), rel=1e-5, abs=1e-7)
    assert all(got[i].predicted == (got[i].score >= 0.7) for i in want)


# --- toxicity -------------------------------------------------------------------


def test_toxicity_matches_plain_features_and_severity(spark, documents):  # noqa: F811
    rnd = random.Random(9)
    clean, bad = [f"word{k}" for k in range(40)], ["zorkish", "zorking", "Blarg!", "blarg", "vexed"]
    rows, marks = [], []
    for i in range(120):
        toxic = int(i % 3 == 0)
        words = [rnd.choice(clean) for _ in range(rnd.randrange(3, 30))] + [rnd.choice(bad) for _ in range(rnd.randrange(1, 6) * toxic)]
        rnd.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, toxic))
    docs, labels = documents(rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)

    # which features are kept: the G statistic of the documents that hold them
    held = {0: Counter(), 1: Counter()}
    for (_, text, _, _), (_, toxic) in zip(rows, marks):
        held[toxic].update({f for w in text.lower().encode().split() for f in toxicity.word_features(w)})
    na, nb = sum(t for _, t in marks), sum(1 - t for _, t in marks)
    kept = set()
    for f in held[0] | held[1]:
        a, b = held[1][f], held[0][f]
        share = (a + b) / (na + nb)
        cells = [(a, na * share), (b, nb * share), (na - a, na * (1 - share)), (nb - b, nb * (1 - share))]
        if a + b >= 3 and share < 1 and a / na > b / nb and sum(n * math.log(n / e) for n, e in cells if n) >= 10:
            kept.add(f)
    assert set(model.columns) == kept and len(kept) > 5

    # expected severity of every text: the sum over thresholds of P(grade >= k)
    got = {r.doc_id: r for r in toxicity.grade(docs, labels).collect()}
    for (i, text, _, _), (_, toxic) in zip(rows, marks):
        n = Counter(f for w in text.lower().encode().split() for f in toxicity.word_features(w) if f in kept)
        eta = sum(model.weights[model.columns[f]] * math.log(1 + k) for f, k in n.items())
        want = sum(1 / (1 + math.exp(-(eta - t))) for t in model.thresholds)
        assert got[i].expected_severity == pytest.approx(want, rel=1e-9, abs=1e-9)
        assert got[i].rejected == (want >= toxicity.REJECT_AT) == bool(toxic)


def test_ordinal_fit_is_the_least_loss():
    """No nearby weights (none negative) and ordered thresholds have a lower penalised log loss."""
    rng = np.random.default_rng(2)
    n, d = 400, 3
    value = rng.random((n, d)) * (rng.random((n, d)) < 0.7)
    grade = np.digitize(value @ [3.0, 1.0, 0.0] + rng.logistic(size=n) / 2, [1.0, 2.0, 3.0])
    row, col = np.nonzero(value)
    w, cut = toxicity._fit_ordinal(grade, row, col, value[row, col], d, 4)

    def loss(w, cut):
        total = 0.0
        for x, g in zip(value, grade):
            above = [1.0, *(1 / (1 + math.exp(-(x @ w - c))) for c in cut), 0.0]
            total -= math.log(max(above[g] - above[g + 1], 1e-12))
        return total / n + 0.5 * toxicity.L2 * float(w @ w)

    best = loss(w, cut)
    for step in (0.3, 0.1):
        for _ in range(60):
            near = np.maximum(w + rng.normal(size=d) * step, 0), cut + rng.normal(size=3) * step
            assert not (np.diff(near[1]) > 0).all() or loss(*near) > best - 1e-4
