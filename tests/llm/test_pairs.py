"""N-gram join and line dedup against brute force, on texts with copies, ties and odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import components, linededup, ngramjoin

from llm_fixtures import TEXTS, documents  # noqa: F401


def _texts(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(4, 90))) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        if rnd.random() < 0.2:
            w += rnd.choice(base).split()
        out.append(rnd.choice(["", " "]) + rnd.choice([" ", "\n", "\t "]).join(x.upper() if rnd.random() < 0.1 else x for x in w))
    return out


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted(((d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_components_match_brute_force(spark, documents, seed):
    rows = [(i * 3, t, "en", "s") for i, t in enumerate([*_texts(seed), *TEXTS])]
    rows += [rows[5], rows[5], (None, rows[7][1], "en", "s")]  # repeated rows and a row without an id
    got = ngramjoin.jaccard_components(documents(rows).repartition(5))
    got = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == brute_components([(r[0], r[1]) for r in rows])


def test_ngram_join_of_a_large_group(spark, documents):
    """A group of near copies larger than any list that could be paired out keeps all its chains."""
    rnd = random.Random(3)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(250):
        w = list(base)
        for _ in range(rnd.randrange(0, 4)):
            w[rnd.randrange(len(w))] = f"m{i}"
        rows.append((i, " ".join(w), "en", "s"))
    got = ngramjoin.jaccard_components(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components([(r[0], r[1]) for r in rows])


def test_keep_one_of_each_group(spark, documents):
    rows = [(i, t, "en", "s") for i, t in enumerate([*_texts(4, 60), None, "", "one"])]
    rows += [rows[0], (None, "no id here at all", "en", "s")]
    docs = documents(rows)
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    first = {c for _, _, c in brute_components([(r[0], r[1]) for r in rows]) if c is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(first)
    assert kept.where("doc_id is null").count() == 1
    assert {r.key for r in kept.select("key").collect()} == {"clash key"}


def test_keep_one_tells_rows_by_their_text(spark, documents):
    """Only copies go: other rows of an id stay, and copies without an id go like those with one."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(12)) for x in "abcde")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, d), (3, d), (None, e), (None, e), (None, e + " "), (None, b), (4, ""), (4, None), (None, "")]
    kept = ngramjoin.keep_one(documents([(i, t, "en", "s") for i, t in rows]).repartition(3)).select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.text) for r in kept if (r.text or "").strip() and r.doc_id) == [(1, a), (2, b), (3, c), (3, d)]
    assert [r.text.strip() for r in kept if (r.text or "").strip() and r.doc_id is None] == [e]
    assert sorted(((r.doc_id, r.text) for r in kept if not (r.text or "").strip()), key=repr) == [(4, ""), (4, None), (None, "")]


def test_empty_tables(spark, documents):
    empty = documents([])
    assert ngramjoin.jaccard_components(empty).count() == 0
    assert ngramjoin.keep_one(empty).columns == empty.columns
    assert linededup.line_report(empty).count() == 0
    assert linededup.dedup_lines(empty).columns == empty.columns


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    text = "alpha beta  gamma\talpha\nbeta " + "long" * 40 + " alpha"
    h = ngramjoin.word_hashes(text.encode())
    assert len(h) == len(text.split()) and h[0] == h[3] == h[-1] and h[1] == h[4] and len(set(h.tolist())) == 4
    monkeypatch.setattr(ngramjoin, "TEXT_CHUNK", 48)
    cut = ngramjoin.word_hashes(text.encode())
    assert len(cut) == len(h) and (cut[:5] == h[:5]).all() and cut[-1] == h[-1]


@pytest.mark.parametrize("size", [ngramjoin.TEXT_CHUNK - 1, ngramjoin.TEXT_CHUNK, ngramjoin.TEXT_CHUNK + 1])
def test_very_long_words_hash_alike_at_every_place(size):
    word = b"w" * size
    alone = ngramjoin.word_hashes(word)
    assert len(alone) == 1
    for text, at, n in [(word + b"  ", 0, 1), (b" " + word, 0, 1), (b"a " + word + b" b", 1, 3), (b"a b\n" + word, 2, 3), (word + b" " + word, 1, 2)]:
        h = ngramjoin.word_hashes(text)
        assert len(h) == n and h[at] == alone[0]


def test_suffix_filter_drops_no_link():
    """At every common shingle of the prefixes a similar pair passes; most other pairs of one length do not."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    universe = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))
    counts = rng.integers(1, 9, 1 << ngramjoin.SKETCH_BITS).astype(np.uint32)
    links = dropped = others = 0
    for _ in range(600):
        n = int(rng.integers(1, 160))
        x = rng.choice(universe, n, replace=False)
        swap = int(rng.integers(0, max(1, n // 3) + 1))
        y = np.concatenate([x[swap:], rng.choice(universe, int(rng.integers(0, swap + 3)), replace=False)])
        x, y = np.unique(x), np.unique(y)
        if not len(y):
            continue
        fx, fy = (s[ngramjoin._prefix(s, counts, 80)[0]] for s in (x, y))
        common = [h for h in fx.tolist() if h in set(fy.tolist())]
        parts = [pa.array([ngramjoin._parts(s, counts, 80)] * max(1, len(common)), pa.binary()) for s in (x, y)]
        both = len(np.intersect1d(x, y))
        linked = 100 * both >= 80 * (len(x) + len(y) - both)
        assert common or not linked
        if not common:
            continue
        at = [np.array([s.tolist().index(h) for h in common]) for s in (fx, fy)]
        sizes = [np.full(len(common), len(s)) for s in (x, y)]
        anywhere = ngramjoin.suffix_near(*parts, *at, *sizes, False)
        at_first = ngramjoin.suffix_near(*[p.slice(0, 1) for p in parts], *[a[:1] for a in at], *[n[:1] for n in sizes], True)
        if linked:
            links += 1
            assert anywhere.all() and at_first.all()
        else:
            others += 1
            dropped += not at_first[0]
    assert links > 100 and others > 100 and dropped > others / 2, (links, others, dropped)


def test_pairs_keep_their_first_common_place(spark):
    rows = [(7, 20, 3, 5, 21, 4), (5, 21, 2, 7, 20, 1), (7, 20, 9, 5, 21, 9), (1, 9, 0, 2, 9, 0)]
    got = ngramjoin._distinct_pairs(spark.createDataFrame(rows, "x long, nx int, px int, y long, ny int, py int"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 9, 9, 0, 0), (5, 7, 21, 20, 2, 1)]


def test_connected_components_match_union(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1100)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = dict((r.node, r.root) for r in components.connected_components(df).collect())
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}


def brute_lines(rows, min_words):
    """Lines kept of every document, by comparing every run with every earlier one."""
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    seqs = {i: rows[i][1].split("\n") for i in order if rows[i][1] is not None}
    out, seen = {}, []
    for i in order:
        if rows[i][1] is None:
            out[rows[i][0]] = None
            continue
        lines, n = seqs[i], len(seqs[i])
        drop = [False] * n
        seen.append(i)
        for s in range(n):
            best = 0
            for j in seen:
                for q in range(len(seqs[j])):
                    if j == i and q >= s:
                        break
                    k = 0
                    while s + k < n and q + k < len(seqs[j]) and lines[s + k] == seqs[j][q + k]:
                        k += 1
                    best = max(best, k)
            if best and sum(len(x.encode().split()) for x in lines[s : s + best]) >= min_words:
                drop[s : s + best] = [True] * best
        out[rows[i][0]] = [x for x, d in zip(lines, drop) if not d]
    return out


@pytest.mark.parametrize("seed,min_words", [(1, 6), (2, 9), (3, 1)])
def test_line_dedup_matches_brute_force(spark, documents, seed, min_words):
    rnd = random.Random(seed)
    pool = ["", "a", "a b", "c d e", "f g h i", "j", "same line again", "\r x"]
    rows = []
    for i in range(40):
        lines = [rnd.choice(pool) for _ in range(rnd.randrange(1, 14))]
        if rows and rnd.random() < 0.5:
            other = (rnd.choice(rows)[1] or "").split("\n")
            at = rnd.randrange(len(other))
            lines[rnd.randrange(len(lines)) :] = other[at : at + rnd.randrange(1, 9)]
        rows.append((i * 2, "\n".join(lines), "en", "s"))
    rows += [(1001, None, "en", "s"), (1003, "", "en", "s"), (1005, "a\n" * 60, "en", "s"), (1007, "a\n" * 60, "en", "s")]
    docs = documents(rows).repartition(4)
    want = brute_lines(rows, min_words)
    got = linededup.dedup_lines(docs, min_words)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {
        k: (None if v is None else "\n".join(v)) for k, v in want.items() if v is None or v
    }
    report = {r.doc_id: (r.n_lines, r.n_kept) for r in linededup.line_report(docs, min_words).collect()}
    assert report == {i: (0, 0) if t is None else (len(t.split("\n")), len(want[i])) for i, t, _, _ in rows}


def test_line_dedup_of_repeated_rows(spark, documents):
    text = "one two three four\nfive six"
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (2, text, "en", "s"), (None, text, "en", "s")]
    got = linededup.dedup_lines(documents(rows), 3)
    assert [(r.doc_id, r.text) for r in got.collect()] == [(1, text), (1, text)]


def test_line_dedup_moves_texts_alike_at_every_size(spark, documents):
    docs = documents([(i, "one two three four\nfive six", "en", "s") for i in range(3)])
    plan = linededup.with_kept_lines(docs, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "strategy=broadcast" not in plan  # no step where the deletions outgrow a broadcast


def test_shortest_runs_cover_what_they_must():
    rnd = random.Random(8)
    for _ in range(200):
        w = np.array([rnd.choice([0, 1, 2, 5]) for _ in range(rnd.randrange(1, 12))])
        s, e = linededup.shortest_runs(w, 4)
        total = np.concatenate([[0], np.cumsum(w)])
        assert ((total[e + 1] - total[s]) >= 4).all()
        runs = set(zip(s.tolist(), e.tolist()))
        # inside any run of enough words every line is in one of these runs
        for a in range(len(w)):
            for b in range(a, len(w)):
                if w[a : b + 1].sum() >= 4:
                    covered = {k for x, y in runs if a <= x and y <= b for k in range(x, y + 1)}
                    assert covered == set(range(a, b + 1)), (w, a, b)


def test_ranks_of_equal_pairs_across_partitions(spark):
    rnd = random.Random(2)
    data = [(i, 0, 0, rnd.choice([1, 1, 1, 5, 9]), rnd.choice([2, 2, 3, 4, 7])) for i in range(400)]
    rows = spark.createDataFrame(data, "did long, th long, pos int, a long, b long")
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    counts = Counter((a, b) for *_, a, b in data)
    for parts in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.did: r.r for r in linededup.ranked(rows).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", saved)
        for i, _, _, a, b in data:
            if counts[a, b] > 1:
                assert got[i] == a + sum(n for (x, y), n in counts.items() if x == a and y < b)
            else:
                assert i not in got


def test_report_digest_is_of_the_kept_text(spark, documents):
    import hashlib

    r = linededup.line_report(documents([(1, "a b\nc", "en", "s")]), 2).first()
    assert (r.n_lines, r.n_kept, r.kept_md5) == (2, 2, hashlib.md5(b"a b\nc").hexdigest())
