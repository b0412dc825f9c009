"""The stages one by one against plain versions of them."""

from __future__ import annotations

from conftest import FOLDER
from test_jaccard import brute as groups
from test_packing import check
from test_secrets import brute as base_spans

import __spark_entry__
import corpus_pipeline as pipeline
from plateflow.llm import secrets, toxicity


def masked(text):
    """Every character of a span out, the first span's kind in; spans from the rules' own expressions."""
    spans = sorted((m.start(), n, m.end()) for n, r in enumerate(secrets.RULES) for m in r.compiled().finditer(text) if m.end(r.part) - m.start(r.part) >= r.least)
    assert [s for s in spans if s[1] < 3] == base_spans(text)
    out, end = "", 0
    for start, rule, stop in spans:
        if start >= end:
            out += text[end:start] + f"[{secrets.RULES[rule].kind}]"
        end = max(end, stop)
    return out + text[end:]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, texts = docs.columns, dict(docs.select("doc_id", "text").collect())
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    score = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            used, least = check(docs.collect(), texts)
            assert used <= least * 1.05 + 1
            continue
        assert docs.columns == columns
        if name == "toxicity":
            expected = {i: t for i, t in texts.items() if score[i] < 0.5}
        elif name == "near_duplicates":
            expected = {i: texts[i] for i, (_, least) in groups(texts).items() if i == least}
        else:
            expected = {i: masked(t) for i, t in texts.items()}
        texts = dict(docs.select("doc_id", "text").collect())
        assert texts == expected and docs.count() == len(texts)
        assert {r.doc_id: r.n_chars for r in docs.collect()} == {i: len(t) for i, t in texts.items()}
    assert __spark_entry__.queries()["pipeline"] is pipeline.run


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "x", 1), (2, "", 0), (3, "a b", 3), (3, "a b", 3)], "doc_id long, text string, n_chars long")
    for frame, rows in ((docs, 4), (docs.where("false"), 0)):
        for _, stage in pipeline.STAGES:
            frame = stage(spark, frame, FOLDER)
        assert frame.count() == rows


def test_workers_give_memory_back_before_a_task(monkeypatch):
    import pyarrow as pa

    from plateflow.llm import base

    calls = []
    monkeypatch.setattr(base, "release_memory", lambda: calls.append(1))
    assert list(base.slices([pa.RecordBatch.from_pydict({"a": [1, 2, 3]})], 2)) == [[[1, 2]], [[3]]]
    assert calls == [1]
    monkeypatch.undo()
    base.release_memory()
