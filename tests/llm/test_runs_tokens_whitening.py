"""Periodic runs, token counts and embedding whitening against brute force and whole-text encoders."""

import functools
import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import TEXTS, documents  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import periodic, queries, tokencount, whitening
from tidemark.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


# --- periodic runs --------------------------------------------------------------

def brute_runs(words):
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    w, n, found = np.array([number[x] for x in words]), len(words), {}
    for q in range(1, n // 2 + 1):
        stop = np.flatnonzero(np.concatenate([[True], w[q:] != w[:-q], [True]]))
        for i, j in zip(stop[:-1].tolist(), (stop[1:] - 1).tolist()):  # words i .. j-1 equal those q later
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)  # a stretch's least period is met first
    return sorted((s, e, q) for (s, e), q in found.items())


def fast_runs(words):
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return [tuple(r) for r in periodic.runs_of(np.array([number[w] for w in words], dtype=np.int64)).tolist()]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


SHAPES = {
    "one word": "a" * 300,
    "fibonacci": fibonacci(700),
    "thue-morse": "".join("ab"[bin(i).count("1") % 2] for i in range(700)),
    "break inside a short period": "ab" * 60 + "a" + "ab" * 90,
    "two breaks": ("abc" * 40 + "a") * 3 + "abc" * 70,
    "power of a power": ("a" * 70 + "b") * 6 + "c" + ("a" * 70 + "b") * 3,
    "nested": (("ab" * 9 + "c") * 4 + "d") * 3,
    "no run": "abcdefghijklmnopqrstuvwxyz",
    "exactly twelve": "xyzabcdefabcdefq",
    "eleven": "qabcabcabcabw",
    "empty": "",
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_runs_of_known_shapes(shape):
    assert fast_runs(SHAPES[shape]) == brute_runs(SHAPES[shape])


def test_runs_of_random_sequences():
    rnd = random.Random(5)
    for k in range(250):
        n = rnd.randrange(1, 500)
        letters = "ab" if k % 2 else "abcdefgh"
        w = [rnd.choice(letters) for _ in range(n)]
        for _ in range(rnd.randrange(4)):  # planted periods, also inside each other
            a = rnd.randrange(n)
            p = 1 + rnd.randrange(max(1, (n - a) // 2))
            end = rnd.randrange(a, n) + 1
            w[a:end] = [w[a + (i - a) % p] for i in range(a, end)]
        assert fast_runs(w) == brute_runs(w), (k, "".join(w))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=40), st.integers(1, 12)), min_size=1, max_size=6))
def test_runs_of_concatenated_powers(parts):
    w = "".join(t * k for t, k in parts)[:900]
    assert fast_runs(w) == brute_runs(w)


def brute_report(text):
    words = (text or "").encode().split()
    runs = brute_runs(words)
    drop = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    longest = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()
    return (len(runs), *longest, sha(lines), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n)).decode()


def test_query_runs_match_brute_force(spark):
    got = queries.op13_periodic_runs(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in docs if t is None or len(t) < 12_000]  # the brute force is quadratic
    assert len(short) > 0.9 * len(docs) and len(got) == len(docs)
    rows = {r["doc_id"]: tuple(r)[1:] for r in got}
    for i, t in short:
        assert rows[i] == brute_report(planted(i, t)), i
    assert sum(r["n_runs"] > 0 for r in got) > 10


def test_runs_of_odd_documents(spark, documents):  # noqa: F811
    texts = [*TEXTS, "a b c " * 5, " ".join(["x y"] * 9), "é ü " * 30, "w " * 5000 + "end", " ".join(SHAPES["two breaks"]), "a b c " * 5]
    rows = [(i if i != 3 else None, t, "en", "s") for i, t in enumerate(texts)]
    d = documents(rows)
    want = sorted(repr((i, *brute_report(t))) for i, t, _, _ in rows)
    assert sorted(repr(tuple(r)) for r in periodic.run_report(d).collect()) == want
    spans = sorted((r["start"], r["length"], r["period"]) for r in periodic.periodic_runs(d).where("doc_id = 11").collect())
    assert spans == [(0, 15, 3)]
    kept = {r["doc_id"]: r for r in periodic.collapsed(d).where("doc_id >= 10").collect()}
    assert kept[11]["text"] == "a b c" and (kept[11]["n_words"], kept[11]["n_kept"]) == (15, 3)
    assert kept[10]["text"] == texts[10]
    for f in (periodic.run_report, periodic.periodic_runs, periodic.collapsed):
        assert f(documents([])).count() == 0


def test_a_long_text_has_its_runs(spark, documents):  # noqa: F811
    rnd = random.Random(2)
    period = [str(rnd.randrange(900)) for _ in range(40_000)]
    head = [str(rnd.randrange(900)) for _ in range(30_000)]
    text = " ".join(head + period * 4 + ["end"])
    best = periodic.run_report(documents([(1, text, "en", "s")])).first()
    assert best["period"] == 40_000 and 160_000 <= best["length"] < 160_020 and 30_000 - 20 < best["start"] <= 30_000


def test_planted_tails_are_words_again(spark, documents):  # noqa: F811
    rows = [(i, t, "en", "s") for i, t in enumerate(["", None, " \t", "one", " a b\tc d e f g h i j k l m n o p ", "x y z"] * 60)]
    got = {r["doc_id"]: r["text"] for r in periodic.with_planted_tail(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, t, _, _ in rows:
        assert (got[i] or "").encode().split() == (planted(i, t) or "").encode().split(), i


# --- token counts -----------------------------------------------------------------

@functools.cache
def library(name):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: model.encode(text, add_special_tokens=False).ids


def whole_count(name, text):
    return len(library(name)(text))


VOCABULARIES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")
_COUNTERS = {}


@pytest.mark.parametrize("name", VOCABULARIES)
@settings(max_examples=120, deadline=None)
@given(st.text(st.sampled_from("ab1 2'st \n\t\x0b\x1c ́éΣσ漢<|>_-.") | st.characters(codec="utf-8"), max_size=80))
def test_unit_counts_equal_whole_counts(name, text):
    counter = _COUNTERS.setdefault(name, tokencount.UnitCounter(tokenizer_path(name)))
    assert counter.counts([text.encode()]).tolist() == [whole_count(name, text)]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_long_texts_are_counted_in_pieces(spark, documents, monkeypatch, name):  # noqa: F811
    for what, n in (("PIECE", 64), ("LONG_UNIT", 16), ("BATCH_BYTES", 32), ("REMEMBERED_BYTES", 64), ("UNITS_AT_ONCE", 8)):
        monkeypatch.setattr(tokencount, what, n)
    texts = [t for t in TEXTS if t] + ["word " * 50, "It's 2024, they'll go  <|endoftext|> on\n\nand on " * 9, "a1b22c333" * 40, "漢字かな" * 60, "x" * 500, "a12" * 90]
    assert tokencount.UnitCounter(tokenizer_path(name)).counts([t.encode() for t in texts]).tolist() == [whole_count(name, t) for t in texts]


def test_token_counts_of_odd_documents(spark, documents):  # noqa: F811
    rows = [(i if i else None, t, "en", "s") for i, t in enumerate([*TEXTS, "one two", "tok " * 2048, "tok " * 2049])]
    got = sorted((tuple(r) for r in tokencount.token_counts(documents(rows)).collect()), key=repr)
    size = lambda t: len((t or "").encode())
    want = [(i, size(t), whole_count("word_bpe_49k.json", t or ""), whole_count("word_bpe_49k.json", t or "") > 2048) for i, t, _, _ in rows]
    assert got == sorted(want, key=repr) and {r[0]: r[3] for r in got}[13] and not {r[0]: r[3] for r in got}[12]
    assert tokencount.token_counts(documents([])).count() == 0


def test_query_counts_equal_whole_texts(spark):
    rows = queries.op12_token_counts(spark, SF).collect()
    docs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), whole_count("word_bpe_49k.json", text))


# --- whitening --------------------------------------------------------------------

def brute_white(rows, components=16):
    """``{vec_id: [(component, n, deviation, whitened, explained), ...]}`` and the error, by a dense eigensolver."""
    ok = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    d = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=float) / n
    v = d.T @ d / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    out = {}
    for i, x in ok:
        t = [n * a - s for a, s in zip(x, sums)]
        w = (np.array(t, dtype=float) / n) @ u[:, :k] / np.sqrt(e[:k])
        out.setdefault(i, []).append((n, sum(a * a for a in t), w, e[:k] / v.trace()))
    return out


def check_white(got, want):
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert set(by) == set(want)
    sign = {}
    for i, copies in want.items():
        for n, dev, white, explained in copies[:1]:
            assert sorted(by[i]) == list(range(1, len(white) + 1))
            for c, rows in by[i].items():
                assert len(rows) == len(copies)
                r = rows[0]
                assert (r["n"], r["deviation"]) == (n, dev) and r["identity_error"] < 1e-9
                assert r["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
                if c not in sign and abs(white[c - 1]) > 0.1:
                    sign[c] = np.sign(white[c - 1] * r["whitened"])
                assert r["whitened"] * sign.get(c, 1.0) == pytest.approx(white[c - 1], abs=1e-6) or abs(white[c - 1]) <= 0.1


def test_query_whitening_matches_a_dense_solver(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_white(queries.op11_whitening(spark, SF).collect(), brute_white(rows))


VECTORS = "vec_id long, embedding array<double>, label int, x string, component string"


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) @ rng.normal(size=(3, 5)) * [1, 1, 9, 0.2, 1]).tolist()) for i in range(60)]
    base = list(rows)
    rows += [(7, base[7][1])] * 3 + [(None, base[9][1])]
    odd = [(100, None), (101, [None] * 5), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "clash", "clash") for i, v in rows + odd], VECTORS)
    check_white(whitening.whiten(df).collect(), brute_white(rows))
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 0, "", "") for i in range(5)], VECTORS)
    assert whitening.whiten(same).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(i % 7), float(i % 3)], 0, "", "") for i in range(40)] + [(99, [1e30, -1e30], 0, "", "")]
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got[99, 1]["deviation"] is None and np.isfinite(got[99, 1]["whitened"]) and got[99, 1]["n"] == 22


def test_jacobi_on_the_cholesky_factor_of_graded_matrices():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (2, 2), (9, 9), (16, 5), (40, 40)):
        a = rng.normal(size=(d, rank)) * 10.0 ** -np.linspace(0, 5, rank)
        v = a @ a.T
        factor = whitening.pivoted_cholesky(v)
        assert np.allclose(factor @ factor.T, v, rtol=0, atol=1e-13 * v.max())
        e, u = whitening.one_sided_jacobi(factor)
        assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12) and (np.diff(e) <= 0).all()
        assert np.allclose(e[:rank], np.linalg.eigvalsh(v)[::-1][: len(e)][:rank], rtol=1e-6, atol=1e-13 * e[0])


def test_public_vocabulary_is_read_in_place():
    assert os.path.exists(tokenizer_path("word_bpe_49k.json"))


# --- fixes of earlier operators ------------------------------------------------------

def test_line_dedup_takes_ids_that_are_no_numbers(spark):
    from tidemark.llm import linededup

    run = "\n".join(" ".join(f"w{k}{j}" for j in range(12)) for k in range(6))
    rows = [("a-1", run + "\nown line one"), ("a-2", "other line\n" + run), ("17", run), (None, run + "\nlast")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    kept = {r["doc_id"]: r for r in linededup.line_report(docs).collect()}
    assert sum(r["n_lines"] - r["n_kept"] for r in kept.values()) == 18 and kept[None]["n_kept"] == 1


def test_toxicity_sample_is_bounded_by_labels_not_rows(spark):
    from tidemark.llm import toxicity

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, "x") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(1, 1)], "doc_id long, toxic int")
    for _ in range(2):
        rows = toxicity.training_sample(docs, labels, 10).collect()
        assert len(rows) <= 20
