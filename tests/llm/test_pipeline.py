"""The corpus pipeline, stage by stage, against brute-force versions on a small corpus."""

from collections import defaultdict

import corpus_pipeline
import pytest
from llm_fixtures import TEXTS, documents  # noqa: F401
from test_pairs import brute_components, brute_lines
from test_scoring import _check_packing, tokenizer  # noqa: F401

from tidemark.llm import linededup, mixing, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (_, toxic), (_, lines), (_, copies), (_, mixed), (_, packed) = corpus_pipeline.STAGES
    clean = toxic(spark, docs, SF).cache()
    rejected = {r.doc_id for r in toxicity.grade(docs, labels).where("rejected").collect()}
    assert clean.columns == COLUMNS
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - rejected
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    fewer = lines(spark, clean, SF).cache()
    want = {i: "\n".join(v) for i, v in brute_lines(rows, linededup.MIN_WORDS).items() if v}
    assert {r.doc_id: (r.text, r.n_chars) for r in fewer.collect()} == {i: (t, len(t)) for i, t in want.items()}
    single = copies(spark, fewer, SF).cache()
    assert single.columns == COLUMNS
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute_components(list(want.items()))})
    mix = mixed(spark, single, SF).cache()
    assert mix.columns == COLUMNS
    words = defaultdict(int)
    for r in mix.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert all(words[r.doc_id] == r.taken for r in mixing.mix_plan(single).collect())
    out = packed(spark, mix, SF)
    _check_packing([(r.doc_id, r.text) for r in mix.collect()], out.collect(), tokenizer, 2048)


def test_run_applies_every_stage(spark):
    from __spark_entry__ import oracle_sql, queries

    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


@pytest.mark.parametrize("empty", [True, False])
def test_stages_on_odd_documents(spark, documents, empty):  # noqa: F811
    rows = [] if empty else [(i, t, "en", s) for i, (t, s) in enumerate((t, s) for t in TEXTS for s in ("a", None))] + [(None, "no id", None, "a"), (3, "", "en", "a")]
    docs = documents(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.collect()
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
    assert empty == (out.count() == 0)
