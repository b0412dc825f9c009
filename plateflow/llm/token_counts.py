"""Token counts of documents without token ids.

Pieces are counted once per distinct pre-token of a task's documents and kept; a document is a frequency table of
pre-tokens, which is joined to the piece counts by pre-token and summed. A global table of pre-tokens would have to be
joined by a shuffle of all (document, pre-token) pairs, which is several times the texts; within a task the join needs
no shuffle, and its memory is bounded (`pretokens.KEPT`).

Defined results: a null text counts as empty; empty texts have 0 bytes and 0 tokens; null ids, repeated ids and repeated
rows each keep a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import batch_of, shipped, slices
from plateflow.llm.pretokens import KEPT, KEPT_CHARS, stretches

_SCHEMA = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_counters: dict[tuple, "PieceCounts"] = {}


class PieceCounts:
    """Numbers of pieces by pre-token, as the library of the vocabulary gives them."""

    def __init__(self, content: bytes, kind: str):
        self.kept: dict[str, int] = {}
        self.specials: tuple[str, ...] = ()
        self.splits = False
        if kind == ".model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        text = content.decode()
        rules = json.loads(text)
        tokenizer = Tokenizer.from_str(text)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        before = rules.get("pre_tokenizer") or {}
        # Byte-level vocabularies that change nothing before the split have independent pre-tokens.
        self.splits = (rules.get("normalizer") is None and before.get("type") == "ByteLevel"
                       and before.get("use_regex", True) and not before.get("add_prefix_space"))
        self.specials = tuple(token["content"] for token in rules.get("added_tokens", []))
        self.lengths = lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def of(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.lengths(texts)
        whole = [any(special in text for special in self.specials) for text in texts]
        # The join below is by pre-token: frequencies of each document on one side, piece counts on the other.
        frequencies = [Counter() if w else Counter(stretches(text)) for w, text in zip(whole, texts)]
        new = list({p for f in frequencies for p in f if p not in self.kept})
        counted = dict(zip(new, self.lengths(new)))
        known = self.kept
        totals = [
            self.lengths([text])[0] if w else sum((counted[p] if p in counted else known[p]) * n for p, n in f.items())
            for w, text, f in zip(whole, texts, frequencies)
        ]
        if len(known) + len(counted) > KEPT:
            known.clear()
        known.update((p, n) for p, n in counted.items() if len(p) <= KEPT_CHARS)
        return totals


def _counter(content: bytes, kind: str) -> PieceCounts:
    key = (kind, len(content), hash(content))
    if key not in _counters:
        _counters[key] = PieceCounts(content, kind)
    return _counters[key]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every document.

    `vocabulary` is a file of the tokenizers library (.json) or of sentencepiece (.model); it is read by the driver and
    sent to the executors. No begin, end or other special token is added; special strings inside texts are special.
    """
    content, kind = shipped(docs.sparkSession, vocabulary), os.path.splitext(vocabulary)[1]

    def count(batches):
        counter = _counter(content.value, kind)
        for ids, texts in slices(batches):
            texts = ["" if t is None else t for t in texts]
            yield batch_of(_SCHEMA, ids, [len(t.encode()) for t in texts], counter.of(texts))

    counted = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(count, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
