from __future__ import annotations

import os
import random
from collections import Counter

import pytest

import corpus_pipeline
from skyledger.llm.common import stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row long"
MARKS = ["zounder", "blackguard", "wretch", "scoundrel"]


def text(seed: int, lang: str, toxic: bool = False, words: int = 60) -> str:
    chance = random.Random(f"{seed}{lang}")
    parts = {"aa": ["the", "ing", "an", "er", "ou"], "bb": ["éau", "ère", "le", "qu", "ai"]}[lang]
    out = ["".join(chance.choices(parts, k=chance.randint(1, 4))) for _ in range(words)]
    for k in range(0, words, 12) if toxic else ():
        out[k] = chance.choice(MARKS)
    return " ".join(out)


@pytest.fixture
def corpus(frame, tmp_path):
    rows, labels = [], []
    for k in range(240):
        lang, toxic = ("aa", "bb")[k % 2], k % 6 == 0
        rows.append((k, text(k, lang, toxic), lang, f"s{k % 5}"))
        labels.append((k, int(toxic), 1))
    clean = text(7, "bb")
    rows += [(500, clean, "bb", "s1"), (501, clean + " le", "bb", None), (502, clean, "bb", "s2"), (502, clean, "bb", "s2")]
    rows += [(600, None, "aa", "s1"), (601, "", "aa", "s1"), (602, "12 345", "aa", "s1"), (603, text(9999, "aa", words=5000), None, "s3")]
    docs = frame(DOCS, *[(*r, len(r[1] or ""), "clash", 1) for r in rows])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame("doc_id long, toxic int, quality int", *labels).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_every_stage_acts_and_keeps_the_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, corpus), f"test-{name}")
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs, kept[name] = out, Counter(r.doc_id for r in out.collect())
    assert not {600, 601, 602} & kept["language_id"].keys() and 603 in kept["language_id"]
    toxic = set(range(0, 240, 6))
    assert len(toxic & kept["toxicity"].keys()) <= 2
    assert len((set(range(240)) - toxic) - kept["toxicity"].keys()) <= 4
    assert 7 in kept["ngram_join"] and not {500, 501, 502} & kept["ngram_join"].keys()
    assert len(kept["ngram_join"]) >= len(kept["toxicity"]) - 6
    assert max(kept["mixing"].values()) == 2 and kept["mixing"].keys() <= kept["ngram_join"].keys()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == kept["mixing"]


def test_run_and_empty_documents(spark, corpus, tmp_path):
    assert corpus_pipeline.run(spark, corpus).count() > 100
    empty = f"{tmp_path}/empty"
    for table in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{table}.parquet").where("false").write.parquet(f"{empty}/{table}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_the_join_leaves_no_tables_but_its_result(spark, corpus):
    shared = spark.conf.get("spark.checkpoint.dir")

    before = set(os.listdir(shared))
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("text IS NOT NULL")
    kept = corpus_pipeline.one_of_each_group(spark, docs, corpus)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert left == {"pipeline-rows", "kept"}
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("temporary_")]
    ids = {r.doc_id for r in kept.collect()}
    assert {7, 603} <= ids and not ids & {500, 501, 502}


@pytest.mark.parametrize("stage", ["ngram_join", "mixing"])
def test_findings_are_joined_without_shuffling_the_texts(spark, corpus, stage):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        out = dict(corpus_pipeline.STAGES)[stage](spark, spark.read.parquet(f"{corpus}/documents.parquet"), corpus)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan  # that of the findings
        assert out.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("stage", ["ngram_join", "mixing"])
def test_rows_in_many_chunks(spark, corpus, monkeypatch, stage):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("text IS NOT NULL").repartition(3)
    run = dict(corpus_pipeline.STAGES)[stage]
    whole = Counter((r.doc_id, r.text) for r in run(spark, docs, corpus).collect())
    monkeypatch.setattr(corpus_pipeline, "CHUNK_BITS", 3)
    assert Counter((r.doc_id, r.text) for r in run(spark, docs, corpus).collect()) == whole


def test_numbered_rows_leave_no_name_in_the_catalog(spark, corpus):
    corpus_pipeline.mixed_sources(spark, spark.read.parquet(f"{corpus}/documents.parquet"), corpus)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("pipeline_rows")]
