"""Licences found against the notices that stand in the tables, and disturbed notices."""

from __future__ import annotations

import pytest
from conftest import FOLDER

from plateflow.llm import licenses
from plateflow.llm.queries import QUERIES

BIGGER = FOLDER.replace("sf0.001", "sf0.01")
IN_TABLES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def model(spark):
    return licenses.train(spark.read.parquet(f"{BIGGER}/documents.parquet"))


def test_tables(spark):
    texts = dict(spark.read.parquet(f"{BIGGER}/documents.parquet").select("doc_id", "text").collect())
    wrong = []
    for r in QUERIES["op1_license_scan"](spark, BIGGER).collect():
        lines = texts[r.doc_id].split("\n")
        assert r.n_paragraphs == sum(bool(line.strip()) for line in lines)
        expected = sorted({family for notice, family in IN_TABLES.items() if notice in lines})
        if r.families != ",".join(expected):
            wrong.append((r.doc_id, r.families, expected))
        for span in filter(None, r.spans.split(",")):
            family, start, end = span.split(":")
            assert IN_TABLES.get(texts[r.doc_id][int(start):int(end)], family) == family
    assert len(wrong) <= 0.002 * len(texts), wrong[:5]


def test_disturbed_notices(model):
    classifier = licenses.Classifier(model)
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            for text in (notice, notice.upper(), f"# {notice} see below"):
                words = licenses.words_of(text)
                got, chance = classifier.classify(words)
                assert (got, licenses.likeness(words, got) >= licenses.CONFIRMED) == (family, True) and 0.5 <= chance <= 1, text
    for text in ("", "the licence of the work is not known to the public", "mit freundlichen Grüßen und der die das", "a version of the file is free", "apache helicopters"):
        words = licenses.words_of(text)
        family, _ = classifier.classify(words)
        assert family == licenses.UNKNOWN or licenses.likeness(words, family) < licenses.CONFIRMED, text


def test_the_bound_skips_only_unknown(model):
    classifier, whole = licenses.Classifier(model), licenses.Classifier(model)
    whole.least = -1e9
    for text in ("Released under the", "MIT", "licensed public", "version 2.0 of the gnu", "x y z", "the and of", "permission is granted"):
        words = licenses.words_of(text)
        assert classifier.classify(words)[0] == whole.classify(words)[0]


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (None, "", 1), (2, "\n \n", 1), (2, "\n \n", 1), (3, "é\nReleased under the MIT License.\n" + "word " * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licences int")
    got = {(r.doc_id, r.n_paragraphs, tuple((x.paragraph, x.start, x.end, x.family, x.confirmed) for x in r.licences)) for r in licenses.scan(docs, model).collect()}
    assert got == {(1, 0, ()), (None, 0, ()), (2, 0, ()), (3, 3, ((1, 2, 33, "mit", True),))}
    empty = licenses.train(docs.where("false"))
    assert licenses.scan(docs, empty).count() == 5 and licenses.scan(docs.where("false"), model).count() == 0
