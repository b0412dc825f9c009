"""Forms and roots against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from conftest import FOLDER

from plateflow.llm import spelling
from plateflow.llm.queries import QUERIES


def edits(word, letters):
    """All words one edit away."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}


def plain(counts):
    letters = {c for word in counts for c in word}
    rows = {}
    for word, n in counts.items():
        near = [w for w in edits(word, letters) - {word} if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= 5 * n else None
        rows[word] = (form, n, len(near), counts[form] if form else None)
    out = set()
    for word, (form, n, n_near, form_n) in rows.items():
        root = word
        while rows[root][0]:
            root = rows[root][0]
        out.add((word, form, root, n, n_near, form_n))
    return out


def fields(df):
    rows = df.collect()
    assert len(rows) == len({r.word for r in rows})
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query(spark):
    counts = Counter()
    for doc in spark.read.parquet(f"{FOLDER.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", doc.text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc.doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = fields(QUERIES["op13_spelling_variants"](spark, FOLDER.replace("sf0.001", "sf0.01")))
    assert got == plain(counts)
    assert sum(form is not None for _, form, *_ in got) > 20


@pytest.mark.parametrize("tile", [8192, 3])
def test_dense_words(spark, monkeypatch, tile):
    """Short alphabets: many near words, ties, anagrams, chains of forms, in one tile and in many."""
    monkeypatch.setattr(spelling, "TILE", tile)
    rng = random.Random(tile)
    words = {"".join(rng.choice("abel") for _ in range(rng.randrange(6, 9))) for _ in range(150)}
    counts = {w: rng.choice([5, 5, 6, 30, 150, 751, 4000]) for w in words}
    counts |= {"chains" + "x" * i: 5**i for i in range(1, 9)} | {"étéété": 5, "étééte": 25}
    df = spark.createDataFrame([(w, n, "extra") for w, n in counts.items()], "word string, n long, form string")
    got = fields(spelling.variants(df))
    assert got == plain(counts)
    assert ("chainsx", "chainsxx", "chains" + "x" * 8, 5, 1, 25) in got


@pytest.mark.parametrize("rows", [1024, 7])
def test_near_pairs(monkeypatch, rows):
    monkeypatch.setattr(spelling, "ROWS", rows)
    rng = random.Random(1)
    for size in (6, 7, 9):
        short = sorted({"".join(rng.choice("abcÿ") for _ in range(size)) for _ in range(200)})
        long = sorted({"".join(rng.choice("abcÿ") for _ in range(size + 1)) for _ in range(200)})
        for left, right, same in ((short, short, True), (short, long, False), (short, sorted(short[::2] + ["z" * size]), False)):
            got = {(left[i], right[j]) for i, j in zip(*spelling.near_pairs(left, right, same))}
            want = {(a, b) for n, a in enumerate(left) for m, b in enumerate(right) if (n < m or not same) and b in edits(a, "abcÿz") - {a}}
            assert got == want
    # Very long words: counts beyond the smaller type.
    long = ["a" * 5000, "a" * 4999 + "b", "ab" * 2500]
    assert [tuple(p) for p in zip(*spelling.near_pairs(long, long, True))] == [(0, 1)]


def test_tile_meets_itself_in_any_order():
    """Both sides of a tile come by a shuffle of their own, whose order is not the same."""
    counts = {"planet": 50, "planex": 5, "planey": 6, "planez": 7, "wonder": 9, "wander": 45}
    left = pd.DataFrame({"step": 0, "tile": 0, "other": 0, "word": list(counts), "n": list(counts.values())})
    want = {word: (n_near, best) for word, _, _, _, n_near, _ in plain(counts) for best in [max((w for w in edits(word, set("".join(counts))) & counts.keys() - {word}), key=counts.get, default=None)] if n_near}
    for seed in range(5):
        got = spelling._meet(left, left.sample(frac=1, random_state=seed))
        got = got.groupby("word").apply(lambda rows: (rows["n_near"].sum(), rows.sort_values("best_n")["best"].iloc[-1]), include_groups=False)
        assert got.to_dict() == want


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (None, "Wonder wonderÉ WONDER"), (3, "wonder, wonder; wonder1wonder"), (3, "wonder, wonder; wonder1wonder"), (4, "x" * 50_000)]
    texts += [(5, "Éclair éclair " * 5), (6, "short " * 40), (7, "aaaaaa×" * 5)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, word int, n string")
    got = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert got == {"wonder": 10, "Éclair": 5, "éclair": 5}
    assert fields(spelling.variants(spelling.word_counts(df))) == plain(got)
    assert spelling.variants(spelling.word_counts(df.where("false"))).count() == 0
    shortened = spelling.word_counts(df, edit=lambda i: lambda word: word[1:])
    assert {r.word: r.n for r in shortened.collect()} == {}
    alone = spark.createDataFrame([("wonder", 5)], "word string, n long")
    assert fields(spelling.variants(alone)) == {("wonder", None, "wonder", 5, 0, None)}


def test_words_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "KEPT", 1)
    df = spark.createDataFrame([(i, "wonder planet") for i in range(7)], "doc_id long, text string")
    assert {(r.word, r.n) for r in spelling.word_counts(df).collect()} == {("wonder", 7), ("planet", 7)}
