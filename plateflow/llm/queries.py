"""The queries of this folder, each with the SQL that says the same where SQL can."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateflow.llm import ann, byte_bpe, jaccard, licenses, order_minhash, packing, runs, secrets, spelling, token_counts, topk, toxicity, warc
from plateflow.llm.base import ORACLES, QUERIES, query, table
from plateflow.session import shared_folder

__all__ = ["ORACLES", "QUERIES"]

_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query()
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in every text; only confirmed ones name a family."""
    docs = table(spark, folder, "documents")
    confirmed = F.filter("licences", lambda found: found.confirmed)
    return licenses.scan(docs, licenses.train(docs)).select(
        "doc_id",
        "n_paragraphs",
        F.size("licences").cast("long").alias("n_predicted"),
        F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda found: found.family))), ",").alias("families"),
        F.array_join(F.transform(confirmed, lambda found: F.concat_ws(":", found.family, found.start, found.end)), ",").alias("spans"),
    )


@query(_WARC)
def op3_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page archived by content and read back."""
    root = shared_folder(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), root)
    return warc.read_archive(spark, root).select(
        F.col("page").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query()
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded to ids and decoded again."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(table(spark, folder, "documents"), path, pattern)
    return byte_bpe.decode(encoded, path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text."""
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every text."""
    base = [rule.kind for rule in secrets.BASE]
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of_kinds = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    return secrets.secret_spans(table(spark, folder, "documents")).select(
        "doc_id",
        *[F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(line(of_kinds(*base)), 256).alias("base_sha256"),
        line("spans").alias("spans"),
    )


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))


@query()
def op6_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return order_minhash.edited_likeness(table(spark, folder, "documents"))


@query()
def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of all vectors to every fiftieth."""
    return ann.neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of three quarters of the five-word sequences."""
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def _repeat_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The places of the words of every tenth document by checksum, whose tail repeats its beginning; that of null ids stays."""
    checksum = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if checksum % 10 or not n:
        return None
    g = checksum // 10
    start, places = g % n, np.arange(n)
    period = 1 + (n - start) // (3 + g % 8)
    places[start:] = start + (places[start:] - start) % period
    return places


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every text, the tails of a tenth of them repeated beforehand."""
    found = runs.periodic_runs(table(spark, folder, "documents"), edit=_repeat_tail)
    line = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(_TOP)
def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty greatest inner products of all vectors with every twentieth."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def _drop_letter(doc_id: int | None):
    """A function that takes a letter from one in 199 of a document's words, by checksum; null ids keep theirs."""
    before = zlib.crc32(f"{doc_id}:".encode())

    def change(word: str) -> str:
        checksum = zlib.crc32(word.encode(), before)
        if checksum % 199 or doc_id is None:
            return word
        place = checksum % len(word)
        return word[:place] + word[place + 1 :]

    return change


@query()
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words of all texts with their more frequent spelling."""
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents"), edit=_drop_letter))
