"""Restoring disguised words, and held-out accuracy."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest
from conftest import FOLDER

from plateflow.llm import toxicity
from plateflow.llm.queries import QUERIES

BIGGER = FOLDER.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def model(spark):
    read = lambda name: spark.read.parquet(f"{BIGGER}/{name}.parquet")
    return toxicity.train(read("documents"), read("labels"))


def test_held_out_rows(spark, model):
    truth = dict(spark.read.parquet(f"{BIGGER}/labels.parquet").select("doc_id", "toxic").collect())
    rows = QUERIES["op9_toxicity"](spark, BIGGER).collect()
    assert len(rows) == spark.read.parquet(f"{BIGGER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_disguises(model):
    scorer = toxicity.Scorer(model)
    disguised = {
        "you 1d10t": "idiot", "an idiooooot here": "idiot", "such an i d i o t now": "idiot", "the m.o.r.o.n said": "moron", "a l0s3r": "loser",
        "5tupid": "stupid", "p@thetic": "pathetic", "you cl0wn!": "clown", "(tra$h)": "trash", "wоrthless": "worthless",
    }
    restorer = toxicity.Restorer(toxicity.CharacterModel(model.grams))
    for text, word in disguised.items():
        assert word in restorer.words(text), (text, restorer.words(text))
        assert scorer.score(text) > scorer.score("fine")
    assert scorer.score("you 1d10t") == scorer.score("you idiot") >= 0.5
    for text in ("", "the and of 1234 a.b.c", "e t a o i n", "12:30 x86 10% of it", "aaa bbb"):
        assert scorer.score(text) < 0.5, text


def test_look_alikes_at_the_edges(model):
    restorer, scorer = toxicity.Restorer(toxicity.CharacterModel(model.grams)), toxicity.Scorer(model)
    offending = ("idiot", "moron", "loser", "stupid", "pathetic", "clown", "trash", "worthless")
    for sign, letters in toxicity.LOOKALIKES.items():
        for letter in letters:
            for word in (*offending, letter + "x" + letter):
                disguised = [sign + word[1:]] * (word[0] == letter) + [word[:-1] + sign] * (word[-1] == letter)
                for token in disguised if not sign.isalnum() else ():
                    for text in (token, f'"{token}!".', f"such a {token}, they said"):
                        assert word in restorer.words(text), (text, restorer.words(text))
                    if word in model.weights:
                        assert scorer.score(f"a {token} b") > scorer.score("a b"), token
    for token, word in {"worthle$$": "worthless", "worthle$$!": "worthless", "$+upid": "stupid", "$tup!d$$$": "stupid", "|o$er": "loser", "stupid!!!": "stupid", "(lown)": "clown"}.items():
        assert word in restorer.words(token), (token, restorer.words(token))
    for text in ("(see) it!", "**bold** and #5", "costs $100!", "a + b | c", "*" * 50_000 + "x" + "!(" * 20_000):
        assert scorer.score(text) < 0.5, text


def test_spaced_words_with_punctuation(model):
    restorer, scorer = toxicity.Restorer(toxicity.CharacterModel(model.grams)), toxicity.Scorer(model)
    for text in (
        "such an i d i o t.", '"i d i o t"', "i d i o t, and", "(i d i o t) here", "[i d i o t]!", "an i d i o t!", "an 1 d 1 o t...", "well: i d i o +.",
        "i, d, i, o, t", "i. d. i. o. t.", "so it is a b c. i d i o t, x y z",
    ):
        assert "idiot" in restorer.words(text), (text, restorer.words(text))
        assert scorer.score(text) > scorer.score("fine"), text
    for text in ("a, b, c and d.", "e. t. a. o. i. n.", "1. 2. 3.", "( ) - . , !", "... ... ...", "I a m."):
        assert scorer.score(text) < 0.5, text


def test_viterbi_is_the_best_path(model):
    grams = toxicity.CharacterModel(model.grams)
    for observed in ("l0s3r", "tr4sh", "1d1ot", "c1own"):
        choices = [[(c, 0.0)] if c.isalpha() else [(x, toxicity.AS_SIGN) for x in toxicity.LOOKALIKES[c]] for c in observed]

        def value(path):
            word = "__" + "".join(c for c, _ in path) + "_"
            return sum(cost for _, cost in path) + sum(grams.log[word[i:i + 3]] for i in range(len(word) - 2))

        assert grams.restore(observed) == "".join(c for c, _ in max(product(*choices), key=value))


def test_all_telling_words_are_weighed(spark):
    words = [f"xz{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    toxic = [(i, f"some {words[i % 400]} here", 1) for i in range(10_000)]
    clean = [(10_000 + i, "some plain here", 0) for i in range(10_000)]
    rows = spark.createDataFrame(toxic + clean, "doc_id long, text string, toxic int")
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    scorer = toxicity.Scorer(model)
    assert set(words) <= set(model.weights)
    assert all(scorer.score(f"some {word} here") >= 0.5 for word in words) and scorer.score("some plain here") < 0.5


def test_fit_is_the_least_loss():
    rng = np.random.default_rng(3)
    held = rng.random((500, 40)) < 0.1
    target, copies = (held[:, :5].any(axis=1) ^ (rng.random(500) < 0.1)).astype(float), rng.integers(1, 4, 500).astype(float)
    fit = toxicity._fitted([np.flatnonzero(row).astype(np.int32) for row in held], 40, target, copies, 0.0)
    design = np.column_stack([held, np.ones(500)])
    slope = design.T @ (copies * (1 / (1 + np.exp(-design @ fit)) - target)) + np.append(np.full(40, 0.02), 1e-6) * fit
    assert np.abs(slope).max() < 1e-4


def test_odd_rows(spark, model):
    docs = spark.createDataFrame([(1, None, 1.0), (None, "idiot", 1.0), (2, "x" * 300_000, 1.0), (2, "a1" * 3000, 1.0), (3, "fine", 1.0), (3, "fine", 1.0)], "doc_id long, text string, score double")
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert sorted((r.doc_id for r in toxicity.keep_clean(docs, model).collect())) == [1, 2, 2, 3, 3]
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    for few in (labels, labels.where("false")):
        plain = toxicity.train(docs, few)
        assert plain.weights == {} and {r.score for r in toxicity.score(docs.where("doc_id = 3"), plain).collect()} <= {r.score for r in toxicity.score(docs, plain).collect()}
    assert toxicity.train(docs.where("false"), labels).grams == {} and toxicity.score(docs.where("false"), model).count() == 0


def test_trigrams_are_those_of_each_word(spark):
    words = ["idiot", "a", "Naïve", "it's", "x1", "(Word)", "ab", "zz", "ça", "--", "ﬁne"]
    texts = [" ".join(words), None, "", "a A idiot", "zz " * 5]
    naive: dict[str, int] = {}
    for token in " ".join(t for t in texts if t).split():
        word = toxicity.stripped(toxicity.folded(token))
        if word and set(word) <= set(toxicity.LETTERS):
            edged = f"__{word}_"
            for i in range(len(word) + 1):
                naive[edged[i:i + 3]] = naive.get(edged[i:i + 3], 0) + 1
    found = toxicity.trigrams(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)).collect()
    assert {r.gram: r.n for r in found} == naive
    counts = toxicity.gram_counts(["a", "idiot"], [2, 10**12])
    assert {toxicity.gram_of(i): n for i, n in enumerate(counts.tolist()) if n} == {
        "__a": 2, "_a_": 2, "__i": 10**12, "_id": 10**12, "idi": 10**12, "dio": 10**12, "iot": 10**12, "ot_": 10**12,
    }
    assert not toxicity.gram_counts([], []).any()
