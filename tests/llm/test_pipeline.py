"""The pipeline, stage by stage on what the stage before kept, against brute force."""

from __future__ import annotations

import os
from types import SimpleNamespace

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from eddyline.llm import language, secrets
from test_llm import check_packing


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = stage("language")(spark, docs, sf).cache()
    judged = {r.doc_id: r.kept for r in language.identify(language.of_documents(docs)).collect()}
    assert known.columns == docs.columns and {i for i, _ in pairs(known)} == {i for i, kept in judged.items() if kept}

    single = stage("near_duplicates")(spark, known, sf).cache()
    assert single.columns == docs.columns and sorted(i for i, _ in pairs(single)) == sorted(i for i, _, _, kept in brute.near_duplicates(pairs(known)) if kept)

    clean = stage("decontamination")(spark, single, sf).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert clean.columns == docs.columns and sorted(i for i, _ in pairs(clean)) == sorted(w[0] for w in brute.decontamination(pairs(single), items) if not w[-1])

    marked = stage("secrets")(spark, clean, sf).cache()
    after = dict(pairs(marked))
    assert marked.columns == docs.columns and after.keys() == dict(pairs(clean)).keys() and marked.where("n_chars <> char_length(text)").count() == 0
    for i, t in pairs(clean):
        spans = brute.secrets([(i, t)])[0][1:4]
        assert (after[i] == t) if not any(spans) else "[SECRET]" in after[i]

    got = stage("packing")(spark, marked, sf).collect()
    used, bound = check_packing(got, brute.pieces(pairs(marked), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))))
    assert used <= bound + 1
    whole = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in got)


def test_odd_rows_pass_through(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    prose = "the and of with from that this for was are " * 3 + "tion ing erly"
    rows = [(1, prose, "en", "s", 1), (1, prose, "en", "s", 1), (None, prose, "en", None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (3, "", "en", "s", 0), (4, prose + " unlike any other words here at all today", None, "s", None)]
    start = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id > 20").unionByName(spark.createDataFrame(rows, schema))
    docs = start.cache()
    for name, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, sf).cache()
        if name == "near_duplicates":
            assert [r.doc_id for r in docs.where(F.col("text") == prose).collect()] == [1]
    empty = start.where("doc_id < 0")
    for name, f in corpus_pipeline.STAGES:
        empty = f(spark, empty, sf)
    assert empty.count() == 0


def test_secrets_of_equal_rows_are_marked_in_all(spark, sf):
    rows = [(1, "token = abcdefghijkl123456 end", "en", "s", 30)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.text for r in stage("secrets")(spark, docs, sf).collect()] == ["[SECRET] end"] * 2
    assert secrets.KINDS[:3] == secrets.BASE_KINDS


def test_clashing_names_and_a_run_that_goes_on(spark, sf, tmp_path):
    """Columns of the input with names that the stages use come through unchanged; finished stages are kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["text_hash", "live", "row", "key", "spans", "marked", "owner", "host", "declared", "_task"]
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = fn(spark, docs, sf).cache()
        assert set(names) <= set(docs.columns) and docs.count() > 100
        for n in names:
            assert docs.where(F.col(n) != F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string"))).isEmpty(), (name, n)

    first = corpus_pipeline.run(spark, sf, str(tmp_path)).count()
    calls = []
    stages = corpus_pipeline.STAGES
    try:
        corpus_pipeline.STAGES = [(n, lambda *a, n=n, f=f: (calls.append(n), f(*a))[1]) for n, f in stages]
        os.remove(tmp_path / "packing" / "_SUCCESS")
        assert corpus_pipeline.run(spark, sf, str(tmp_path)).count() == first and calls == ["packing"]
    finally:
        corpus_pipeline.STAGES = stages


def test_caches_are_gone_after_a_task(monkeypatch):
    from eddyline.llm import packing

    monkeypatch.setattr(packing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    path = public_tokenizers.path(corpus_pipeline.TOKENIZER)
    encoder = packing.encoder(path)
    encoder.encode("some words öäü 你好")
    assert encoder.pieces and encoder.words
    list(packing.piece_lister(path, 4096, 1)(iter(())))
    assert not encoder.pieces and not encoder.words
