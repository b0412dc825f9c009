"""Tokenizers and the archive against the libraries and a plain restatement."""

from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from compare import differences, open_tables
from conftest import FOLDER
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plateflow.llm import byte_bpe, token_counts, warc
from plateflow.llm.queries import ORACLES, QUERIES

ODD = [
    None, "", " ", "  ", "\n", " \n x", "a", "Hello  world\n\n  it's they'll \t tab", "x\x1cy \x1d z\x1e\x1f", "a\x85b\xa0c　 d",
    "<|endoftext|>", "end  <|endoftext|>  of <|endoftext|>", "日本語 テキスト ²³½ Ⅷ", "é é ß ſ K", "🙂🙂 👩‍👩‍👧", "a" * 3000, "!?" * 500,
    "0123456789" * 40, "word " * 2000, "\r\n\r\n a\r\n", "don't DON'T 's 't", "᠎ x ​ y", "\0\0 \x01",
]


def frame(spark, texts, name="text"):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], f"doc_id long, {name} string, n_tokens string")


def own(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n=300):
    rng = random.Random(5)
    letters = "abcdeé '\n\t  \x1c\xa0.,!0189ÄßñΣ語² "
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_encode_and_decode_as_the_library(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = ODD + random_texts()
    library = own("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(frame(spark, texts), path, P.PATTERN), path, P.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert bytes(got[i].ids) == struct.pack(f"<{len(ids)}I", *ids), repr(text)
        assert bytes(got[i].decoded) == (text or "").encode()


def test_perfect_hash_is_minimal():
    keys = [str(i * i).encode() for i in range(5000)]
    table = byte_bpe.PerfectHash(keys)
    assert sorted(table.slots) == list(range(len(keys)))
    assert all(table.find(key) == i for i, key in enumerate(keys))
    assert table.find(b"none") == -1 and byte_bpe.PerfectHash([]).find(b"") == -1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_as_the_library(spark, name):
    texts = ODD + random_texts()
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        expected = [len(model.encode(t or "")) for t in texts]
    else:
        library = Tokenizer.from_file(P.path(name))
        expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    rows = {r.doc_id: r for r in token_counts.token_counts(frame(spark, texts), P.path(name)).collect()}
    assert [rows[i].n_tokens for i in range(len(texts))] == expected
    assert all(rows[i].over_limit == (n > 1024) and rows[i].n_bytes == len((texts[i] or "").encode()) for i, n in enumerate(expected))


def test_empty_tables(spark):
    empty = frame(spark, ["x"]).where("false")
    assert token_counts.token_counts(empty, P.path("byte_bpe_50k.json")).count() == 0
    assert byte_bpe.encode(empty, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def test_tokens_of_the_tables(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    library = own("byte_bpe_multi_50k.tiktoken")
    for r in QUERIES["op4_byte_bpe"](spark, FOLDER).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    counts = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in QUERIES["op5_token_counts"](spark, FOLDER).collect():
        assert r.n_tokens == len(counts.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_archive_of_the_tables(spark):
    assert differences(QUERIES["op3_warc_archive"](spark, FOLDER), open_tables(FOLDER), ORACLES["op3_warc_archive"]) is None


def test_archive_odd_rows(spark, tmp_path):
    long = "é" * 60
    rows = [(3, "http://a\r\nX: y", long, 1), (1, None, long, 1), (2, "u", None, 1), (4, "u", "", 1), (1, None, long, 1), (None, "n", long, 1), (None, "n", "only" * 50, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    warc.write_archive(pages, str(tmp_path / "a"))
    got = warc.read_archive(spark, str(tmp_path / "a")).collect()
    kinds = sorted((-1 if r.page is None else r.page, r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [(-1, "response", 0), (-1, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "response", 0), (3, "revisit", 1), (4, "response", 0)]
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 3
    for r in got:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert rest == (b"" if r.record_type == "revisit" else bytes(r.payload)) + b"\r\n\r\n"
        assert int(fields["Content-Length"]) == len(rest) - 4
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()
    warc.write_archive(pages.where("false"), str(tmp_path / "b"))
    assert warc.read_archive(spark, str(tmp_path / "b")).count() == 0


def test_archive_refuses_changed_bytes(spark, tmp_path):
    root = str(tmp_path / "c")
    warc.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), root)
    held = spark.read.parquet(f"{root}/payloads").select("digest", F.lit(b"other").alias("payload")).collect()
    spark.createDataFrame(held, "digest string, payload binary").write.mode("overwrite").parquet(f"{root}/payloads")
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_archive(spark, root).collect()
