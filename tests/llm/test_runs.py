"""Runs against a plain search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import FOLDER

from plateflow.llm import runs
from plateflow.llm.queries import QUERIES


def plain_runs(words):
    """(start, length, period) of the runs, by their definition."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > start and end + q - start >= max(6, 4 * q):
                own = words[start : end + q]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    found.append((start, len(own), q))
            start = end + 1 if end == start else end
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_collapse(words, found):
    kept = [True] * len(words)
    for start, length, period in found:
        kept[start + period : start + length] = [False] * (length - period)
    return " ".join(word for word, keep in zip(words, kept) if keep)


def nested(rng, depth):
    """Words with repeats of repeats."""
    if depth == 0 or rng.random() < 0.3:
        return [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 8))]
    if rng.random() < 0.5:
        return nested(rng, depth - 1) * rng.randrange(1, 9)
    return nested(rng, depth - 1) + nested(rng, depth - 1)


def test_runs_of_many_texts():
    rng = random.Random(5)
    for _ in range(1500):
        texts = [nested(rng, rng.randrange(5))[:300] for _ in range(rng.randrange(1, 6))]
        words, owner = np.concatenate(texts).astype(int), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        want, offset = [], 0
        for text in texts:
            want += [(s + offset, s + n + offset, q) for s, n, q in plain_runs(text)]
            offset += len(text)
        assert [tuple(run) for run in runs.runs_of(words, owner).tolist()] == want, texts


@pytest.mark.parametrize("words", [
    np.zeros(100_000, int),
    np.tile(np.arange(1000), 100),
    np.array([bin(i).count("1") % 2 for i in range(100_000)]),  # no run: nothing repeats three times in a row
    np.random.default_rng(1).integers(0, 2, 100_000),
])
def test_long_texts(words):
    found = runs.runs_of(words, np.zeros(len(words), int))
    for start, end, period in found[:: max(1, len(found) // 500)]:
        assert end - start >= max(6, 4 * period) and (words[start : end - period] == words[start + period : end]).all()
        assert start == 0 or words[start - 1] != words[start - 1 + period]
        assert end == len(words) or words[end] != words[end - period]
    small = [run for run in found if run[2] <= 3]
    stretches = 0
    for q in (1, 2, 3):
        same = np.concatenate(([0], (words[:-q] == words[q:]).astype(int), [0]))
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(starts, ends):
            own = words[s : e + q]
            if len(own) >= max(6, 4 * q) and not (q > 1 and (own[1:] == own[:-1]).all()):
                stretches += 1
    assert len(small) == stretches


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    assert got.keys() == {r.doc_id for r in docs}
    some = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words)
        row = got[doc.doc_id]
        some += len(found)
        assert row.n_runs == len(found)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()
        best = min(found, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == expected
    assert some > 10


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, " \t\n "), (None, "a b " * 5), (4, "x" * 100_000), (5, "go " * 6), (5, "go " * 6), (6, "go " * 5),
             (7, "a\xa0b " * 6), (8, "\x1c " * 7), (9, "a b c d " * 3)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, runs int, collapsed string")
    got = sorted((r.doc_id or 0, [tuple(run) for run in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect())
    assert got == sorted([
        (1, [], ""), (2, [], ""), (3, [], ""), (0, [(0, 10, 2)], "a b"), (4, [], "x" * 100_000), (5, [(0, 6, 1)], "go"),
        (5, [(0, 6, 1)], "go"), (6, [], "go go go go go"), (7, [(0, 6, 1)], "a\xa0b"), (8, [(0, 7, 1)], "\x1c"),
        (9, [], "a b c d a b c d a b c d"),
    ])
    assert runs.periodic_runs(df.where("false")).count() == 0


def test_best_run_is_exact():
    # Equal quotients: the first one; else the exact quotient decides, not its rounding.
    assert runs._best([(0, 8, 2), (9, 12, 3)]) == (0, 8, 2)
    assert runs._best([(0, 3 * 10**16 + 1, 10**16), (5, 3 * 10**16 + 2, 10**16)]) == (5, 3 * 10**16 + 2, 10**16)
    assert runs._best([]) is None


def test_repeated_stretches_give_few_places():
    rng = np.random.default_rng(3)
    plain = rng.integers(0, 300, 200_000)  # ordinary: many words repeat, few trigrams do
    places, _ = runs.repetitive(plain, np.arange(200_000) // 400)
    assert len(places) == 0
    plain[1000:1040] = np.tile([1, 2], 20)
    places, _ = runs.repetitive(plain, np.zeros(200_000, int))
    assert set(range(1000, 1040)) <= set(places.tolist()) and len(places) < 2000
