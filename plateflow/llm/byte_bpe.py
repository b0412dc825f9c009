"""Byte-level BPE by a two-tier lookup: encoding to ids and decoding back to bytes.

First tier: a minimal perfect hash over the vocabulary resolves a pre-token that is a vocabulary entry, with one probe
and one comparison. Second tier: the bytes of a miss form a linked list; a heap yields the pair of lowest rank, leftmost
first, until no pair is in the vocabulary. A long pre-token costs n log n.

Defined results: a null text encodes as the empty text, which has no ids; null ids in, null ids out; repeated rows each keep a row;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import batch_of, shipped, slices
from plateflow.llm.pretokens import Memo, stretches

_coders: dict[tuple, "ByteBpe"] = {}
#: Odd multipliers that spread a hash and its displacement over 64 bits.
_STEP, _MIX, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots.

    Keys are dealt to buckets; from the largest bucket down, each looks for a displacement that puts its keys on free slots.
    Buckets of one key take the slots that are left and name them outright, as negative numbers.
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 2)
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        members: dict[int, list[int]] = {}
        for place, h in enumerate(hashes):
            members.setdefault(h % self.buckets, []).append(place)
        self.moves = [0] * self.buckets
        self.slots = [-1] * n
        order = sorted(members.items(), key=lambda item: -len(item[1]))
        singles = []
        for bucket, places in order:
            if len(places) == 1:
                singles.append((bucket, places[0]))
                continue
            move = 0
            while True:
                taken = [self._slot(hashes[place], move) for place in places]
                if len(set(taken)) == len(taken) and all(self.slots[slot] < 0 for slot in taken):
                    break
                move += 1
            self.moves[bucket] = move
            for slot, place in zip(taken, places):
                self.slots[slot] = place
        free = (slot for slot in range(n) if self.slots[slot] < 0)
        for (bucket, place), slot in zip(singles, free):
            self.moves[bucket], self.slots[slot] = -1 - slot, place
        self.keys = [keys[place] for place in self.slots]

    def _slot(self, h: int, move: int) -> int:
        return (((h ^ move * _STEP) * _MIX & _WORD) >> 29) % self.n

    def find(self, key: bytes) -> int:
        """The position of the key among the keys given; -1 if it is none of them."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        move = self.moves[h % self.buckets]
        slot = -1 - move if move < 0 else self._slot(h, move)
        return self.slots[slot] if self.keys[slot] == key else -1


class ByteBpe:
    """The encoder and decoder of a rank file."""

    def __init__(self, content: bytes, pattern: str):
        entries = [line.split() for line in content.splitlines() if line.strip()]
        self.tokens = {int(rank): base64.b64decode(token) for token, rank in entries}
        ranks = {token: rank for rank, token in self.tokens.items()}
        self.rank_list = list(ranks.values())
        self.whole = PerfectHash(list(ranks))
        self.bytes = [ranks[bytes([value])] for value in range(256)]
        # Every split of an entry into two entries is a pair that may be merged.
        self.pairs = {
            (ranks[token[:cut]], ranks[token[cut:]]): rank
            for token, rank in ranks.items() for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks
        }
        self.pretokens = regex.compile(pattern).findall
        self.packed = Memo(self._stretch)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of a pre-token that is no entry itself."""
        ids = [self.bytes[value] for value in piece]
        size = len(ids)
        following, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs = self.pairs
        heap = [(rank, at, ids[at], ids[at + 1]) for at in range(size - 1) if (rank := pairs.get((ids[at], ids[at + 1]))) is not None]
        heapify(heap)
        while heap:
            rank, at, left, right = heappop(heap)
            after = following[at]
            if ids[at] != left or after >= size or ids[after] != right:
                continue  # one of the two has been merged since
            ids[at], ids[after] = rank, -1
            following[at] = end = following[after]
            if end < size:
                before[end] = at
                if (new := pairs.get((rank, ids[end]))) is not None:
                    heappush(heap, (new, at, rank, ids[end]))
            start = before[at]
            if start >= 0 and (new := pairs.get((ids[start], rank))) is not None:
                heappush(heap, (new, start, ids[start], rank))
        return [i for i in ids if i >= 0]

    def _stretch(self, stretch: str) -> bytes:
        ids: list[int] = []
        for pretoken in self.pretokens(stretch):
            piece = pretoken.encode()
            place = self.whole.find(piece)
            if place >= 0:
                ids.append(self.rank_list[place])
            else:
                ids += self.merge(piece)
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, stretches(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _coder(content: bytes, pattern: str) -> ByteBpe:
    key = (len(content), hash(content), pattern)
    if key not in _coders:
        _coders[key] = ByteBpe(content, pattern)
    return _coders[key]


_ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.binary())])


def encode(docs: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of every document; `ids` are little-endian unsigned 32-bit integers.

    `vocabulary` is a rank file (base64 token, rank), read by the driver and sent to the executors; each match of
    `pattern` is encoded separately, without special tokens.
    """
    content = shipped(docs.sparkSession, vocabulary)

    def run(batches):
        coder = _coder(content.value, pattern)
        for ids, texts in slices(batches):
            yield batch_of(_ENCODED, ids, [coder.encode(t or "") for t in texts])

    encoded = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, ids binary")
    return encoded.withColumnRenamed("id", id)


def decode(encoded: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, ids, decoded): the bytes that packed ids stand for; null ids stay null."""
    content = shipped(encoded.sparkSession, vocabulary)
    schema = pa.schema([*_ENCODED, ("decoded", pa.binary())])

    def run(batches):
        coder = _coder(content.value, pattern)
        for keys, packed in slices(batches):
            yield batch_of(schema, keys, packed, [None if p is None else coder.decode(p) for p in packed])

    decoded = encoded.select(F.col(id).cast("long").alias("id"), F.col(ids).alias("ids")).mapInArrow(run, "id long, ids binary, decoded binary")
    return decoded.withColumnRenamed("id", id)
