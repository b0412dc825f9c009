"""Order MinHash against a plain restatement of what it counts and orders."""

from __future__ import annotations

import hashlib
import random
import re

from conftest import FOLDER
from pyspark.sql import functions as F

from plateflow.llm import order_minhash as omh
from plateflow.llm.queries import QUERIES


def hashes(spark, rows):
    """Spark's 64-bit hash of rows of values, as signed integers."""
    kinds = ", ".join(f"c{i} {kind}" for i, kind in enumerate(rows[0][1]))
    df = spark.createDataFrame([(n, *values) for n, (values, _) in enumerate(rows)], f"n int, {kinds}")
    return [r.h for r in df.select("n", F.xxhash64(*df.columns[1:]).alias("h")).orderBy("n").collect()]


def signatures(spark, text):
    words = re.findall(r"\S{1,8}", text, re.A)
    if not words:
        return []
    kmers = [words[i:i + 3] + [None] * (3 - len(words[i:i + 3])) for i in range(len(words))]
    held = hashes(spark, [(tuple(k), ("string",) * 3) for k in kmers])
    seen, numbered = {}, []
    for place, h in enumerate(held):
        seen[h >> 26] = seen.get(h >> 26, 0) + 1
        numbered.append((h >> 26, seen[h >> 26]))
    ranks = hashes(spark, [(n, ("long", "int")) for n in numbered])
    cells = {}
    for place, rank in enumerate(ranks):
        cells.setdefault((rank & (1 << 64) - 1) >> 58, []).append((rank >> 26, place))
    out = []
    pairs = [(cell, sorted(place for _, place in sorted(found)[:2])) for cell, found in sorted(cells.items())]
    tuples = hashes(spark, [((held[p[0]], held[p[1]] if len(p) > 1 else None), ("long", "long")) for _, p in pairs])
    return [cell << 26 | h & (1 << 26) - 1 for (cell, _), h in zip(pairs, tuples)]


TEXTS = ["", " \n ", "one", "a b", "a a a a a a a a a a", "the cat sat on the mat and the cat sat on the mat again", "x" * 100, "é à ü 日本語" * 9, " ".join(str(i % 7) for i in range(300))]


def test_signatures(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)], "doc_id int, text string, _w string")
    for row in omh.with_signatures(df.drop("_w"), "text", "s").collect():
        assert sorted(row.s) == sorted(signatures(spark, row.text)), row.text


def test_order_counts(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    rows = [(0, " ".join(words)), (1, " ".join(moved)), (2, " ".join(words[:300] + ["new"] * 100))]
    df = omh.with_signatures(spark.createDataFrame(rows, "i int, text string"), "text", "s")
    got = {r.i: r for r in df.collect()}
    same = lambda a, b: len(set(got[a].s) & set(got[b].s)) / 64
    assert same(0, 0) == 1 and 0.2 < same(0, 1) < 0.8 and 0.2 < same(0, 2) < 0.8


def stretches(text):
    """Words of at most eight characters with the white space before them; of longer runs eight characters from each position."""
    out = []
    for space, run in re.findall(r"(\s*)(\S*)", text, re.A):
        if len(run) <= 8:
            out += [space + run] * bool(space + run)
        else:
            out += [space + run[:8]] * bool(space) + [run[i:i + 8] for i in range(len(run) - 7)]
    return out


def test_stepped_stretches(spark):
    texts = [*TEXTS, "one 12345678 123456789\n\n1234567890 x  ", " " * 100_000, "x" * 20_000, "ab " * 20_000, "日本語" * 9 + "　" + "本日" * 9]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, found in df.select("text", F.regexp_extract_all("text", F.lit(omh.STEPPED), F.lit(1))).collect():
        assert found == stretches(text), text[:100]


def test_unspaced_edits(spark):
    rng = random.Random(2)
    for alphabet in ("".join(map(chr, range(0x4E00, 0x5200))), "abcdefghijklmnopqrstuvwxyz0123456789"):
        text = "".join(rng.choice(alphabet) for _ in range(1000))
        edits = [text, "y" + text, text[:500] + "y" + text[500:], text[:300] + text[301:], "".join(rng.choice(alphabet) for _ in range(1000))]
        rows = [(2 * n + m, t) for n, edit in enumerate(edits) for m, t in enumerate((text, edit))]
        signed = omh.with_next(spark.createDataFrame(rows, "doc_id int, text string"))
        got = {r.id: r.like for r in signed.select("id", omh.likeness("signatures", "next_signatures").alias("like")).collect()}
        assert got[0] == 1 and min(got[2], got[4], got[6]) > 0.8 and got[8] < 0.1, got


def test_white_space_edits(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:150]) + "\n\n" + " ".join(words[150:])), (2, "\n".join(words))]
    signed = omh.with_next(spark.createDataFrame(rows, "doc_id int, text string"))
    got = {r.id: r.like for r in signed.select("id", omh.likeness("signatures", "next_signatures").alias("like")).collect()}
    assert 0.8 < got[0] <= 1 and got[1] < 0.1


def check(rows, texts):
    order = sorted(texts)
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for place, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(place + 1) % len(order)]] or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1)
    return got


def test_tables(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    got = check(QUERIES["op6_order_minhash"](spark, FOLDER).collect(), texts)
    by_text = {}
    for i, r in got.items():
        assert by_text.setdefault(texts[i], r.fingerprint) == r.fingerprint
    long = [r for r in got.values() if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.3 > 0.15 > sum(r.near_next for r in long) / len(long)


def test_odd_rows(spark):
    texts = {5: None, 7: "", 9: "a b c d e f g h", 11: "é" * 9, -3: "last words come " * 3000}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, bucket int")
    check(omh.edited_likeness(docs).collect(), texts)
    one = docs.where("doc_id = 9")
    check(omh.edited_likeness(one).collect(), {9: texts[9]})
    assert omh.edited_likeness(docs.where("false")).count() == 0
    twice = docs.union(docs).union(spark.createDataFrame([(None, "x", 1), (None, "y", 1)], docs.schema))
    assert omh.edited_likeness(twice).count() == 12
    assert omh.with_next(docs, partitions=1).count() == 5
