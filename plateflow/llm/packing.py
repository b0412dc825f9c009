"""Packing documents into sequences of a fixed width by linear grouping.

The pieces of all documents are known by their lengths alone, of which there are at most as many as a sequence has
tokens. So the plan is made from a histogram, and its size does not grow with the corpus:

1. Large lengths are sorted, cut into groups of equal cardinality and rounded up to the longest of their group.
2. The few rounded sizes make a cutting-stock problem: its linear relaxation is solved by column generation, where a
   knapsack prices configurations, and configurations are taken a whole number of times.
3. The lengths of actual pieces take the places of the rounded ones, so that rounding costs no space.
4. What no whole configuration holds, then the small lengths go, from long to short, where they fit best.

Sequences of equal filling are kept as ranges. A piece finds its place by its length and its number among the pieces of
that length: its number within its task plus the count of the tasks before, which needs no global sort.

Defined results: a null text is empty; an empty document is its end mark alone; null ids, repeated ids and repeated rows
each keep their pieces; an empty table has no sequences; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field
from struct import pack as packed

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plateflow.llm.base import batch_of, shipped, slices
from plateflow.llm.pretokens import PYTHON_ONLY_SPACE, Memo
from plateflow.session import written

#: Groups of equal cardinality among the large lengths.
GROUPS = 96
#: Lengths above this share of a sequence are large: at most seven share one.
LARGE = 1 / 8
#: Pivots of the linear program; any basis on the way is feasible.
PIVOTS = 3000

_PIECES = pa.schema([(name, pa.int64()) for name in ("id", "piece", "start", "length", "ids_crc32", "task", "number")])
_tokenizers: dict[tuple, "WordTokens"] = {}


#: How the vocabulary with word ends splits what white space has not split.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters are lower-cased one by one, are composed, and hold no other letters or numbers than the second
#: expression knows, which is SPLIT for them.
_LATIN = re.compile("[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r\x20a-zß-öø-ÿ0-9]+")


def _printable_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordTokens:
    """Ids of texts for a vocabulary that drops white space and so treats words apart.

    The library is asked once for each part of a word, and in texts of unusual characters for each word.
    """

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        rules = json.loads(content)
        known = [step.get("pattern", {}).get("Regex") for step in (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        steps = [step["type"] for step in (rules.get("normalizer") or {}).get("normalizers", [])]
        self.in_parts = known[:1] == [SPLIT] and len(known) == 2 and steps == ["NFC", "Replace", "Lowercase"]
        self.specials = tuple(token["content"] for token in rules.get("added_tokens", []))
        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda text: (lambda ids: packed(f"<{len(ids)}I", *ids))(tokenizer.encode(text, add_special_tokens=False).ids)
        self.words = Memo(self.whole)
        model, letters = tokenizer.model, _printable_bytes()

        def part(text: str) -> bytes:
            ids = [token.id for token in model.tokenize("".join(map(letters.__getitem__, text.encode())))]
            return packed(f"<{len(ids)}I", *ids)

        self.parts = Memo(part)

    def encode(self, text: str) -> bytes:
        if self.in_parts and _LATIN.fullmatch(text) and not any(special in text for special in self.specials):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(text.lower())))
        if PYTHON_ONLY_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def _words(content: bytes) -> WordTokens:
    key = (len(content), hash(content))
    if key not in _tokenizers:
        _tokenizers[key] = WordTokens(content)
    return _tokenizers[key]


@dataclass
class Plan:
    """Where the pieces go: `places` has (length, first number, sequence, offset, pieces of that length per sequence)."""

    width: int
    counts: dict[int, int]
    sequences: int = 0
    places: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    _used: dict[int, int] = field(default_factory=lambda: defaultdict(int))
    _free: dict[int, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))

    def __post_init__(self):
        large = sorted((n for n in self.counts if n > self.width * LARGE), reverse=True)
        rest = self._configured(large) if large else {}
        for length in sorted(self.counts, reverse=True):
            left = rest.get(length, 0) if length in rest or length > self.width * LARGE else self.counts[length]
            self._best_fit(length, left)
        self.places.sort()

    def _put(self, length: int, sequence: int, offset: int, each: int, pieces: int) -> None:
        self.places.append((length, self._used[length], sequence, offset, each))
        self._used[length] += pieces

    def _groups(self, large: list[int]) -> list[list[list[int]]]:
        """[length, count] entries of each group, from long to short."""
        total = sum(self.counts[n] for n in large)
        groups: list[list[list[int]]] = [[] for _ in range(min(GROUPS, total))]
        ends = [total * (i + 1) // len(groups) for i in range(len(groups))]
        at = group = 0
        for length in large:
            left = self.counts[length]
            while left:
                take = min(left, ends[group] - at)
                groups[group].append([length, take])
                at, left = at + take, left - take
                group += at == ends[group]
        # Groups that round to the same size are one size.
        merged: dict[int, list[list[int]]] = {}
        for entries in groups:
            merged.setdefault(entries[0][0], []).extend(entries)
        return list(merged.values())

    def _configured(self, large: list[int]) -> dict[int, int]:
        """Place large pieces by whole configurations; the counts by length that are left."""
        groups = self._groups(large)
        sizes = [entries[0][0] for entries in groups]
        demand = np.array([sum(count for _, count in entries) for entries in groups], float)
        for times, configuration in _configurations(self.width, sizes, demand):
            runs = [(self.sequences, times, 0)]  # first sequence, number of sequences, tokens so far
            self.sequences += times
            for group in np.repeat(np.arange(len(sizes)), configuration):
                runs = self._substitute(runs, groups[group])
            for first, number, fill in runs:
                self._free[self.width - fill].append((first, number))
        left: dict[int, int] = dict.fromkeys(large, 0)
        for entries in groups:
            for length, count in entries:
                left[length] += count
        return left

    def _substitute(self, runs: list[tuple[int, int, int]], entries: list[list[int]]) -> list[tuple[int, int, int]]:
        """Put one actual piece of the group into each sequence of the runs."""
        result = []
        for first, number, fill in runs:
            while number:
                length, count = entries[0]
                take = min(number, count)
                self._put(length, first, fill, 1, take)
                result.append((first, take, fill + length))
                first, number = first + take, number - take
                entries[0][1] -= take
                if not entries[0][1]:
                    entries.pop(0)
        return result

    def _best_fit(self, length: int, count: int) -> None:
        """Put `count` pieces where the least room is left, as many as fit; then into new sequences."""
        while count:
            room = min((r for r, runs in self._free.items() if r >= length and runs), default=None)
            if room is None:
                room, each = self.width, self.width // length
                number = -(-count // each)
                first, self.sequences = self.sequences, self.sequences + number
            else:
                first, number = self._free[room].pop()
                each = room // length
            full = min(number, count // each)
            rest = count - full * each if full < number else 0
            if full:
                self._put(length, first, self.width - room, each, full * each)
                self._free[room - each * length].append((first, full))
            if rest:
                self._put(length, first + full, self.width - room, rest, rest)
                self._free[room - rest * length].append((first + full, 1))
            if number > full + bool(rest):
                self._free[room].append((first + full + bool(rest), number - full - bool(rest)))
            count -= full * each + rest


def _configurations(width: int, sizes: list[int], demand: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Whole numbers of configurations, rounded down from the linear program min sum(x), A x = demand."""
    kinds = len(sizes)
    basis = np.diag([width // size for size in sizes]).astype(float)
    for _ in range(PIVOTS):
        prices = np.linalg.solve(basis.T, np.ones(kinds))
        column = _knapsack(width, sizes, prices)
        if prices @ column <= 1 + 1e-9:
            break
        amounts, change = np.linalg.solve(basis, np.column_stack([demand, column])).T
        ratios = np.where(change > 1e-9, np.maximum(amounts, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(ratios))] = column
    amounts = np.linalg.solve(basis, demand)
    left, result = demand.copy(), []
    for times, column in sorted(zip(np.floor(amounts + 1e-6).astype(int), basis.T), key=lambda item: -item[0]):
        column = np.rint(column).astype(int)
        times = int(min([times, *(left[column > 0] // column[column > 0])]))
        if times > 0:
            left -= times * column
            result.append((times, column))
    return result


def _knapsack(width: int, sizes: list[int], prices: np.ndarray) -> np.ndarray:
    """The configuration of greatest price that fits the width."""
    best = np.zeros(width + 1)
    layers = []
    for size, price in zip(sizes, prices):
        number = np.zeros(width + 1, int)
        if price > 0:
            base = best
            for copies in range(1, width // size + 1):
                shifted = np.full(width + 1, -np.inf)
                shifted[copies * size:] = base[: width + 1 - copies * size] + copies * price
                better = shifted > best + 1e-12
                best, number = np.where(better, shifted, best), np.where(better, copies, number)
        layers.append(number)
    column, room = np.zeros(len(sizes)), width
    for kind in range(len(sizes) - 1, -1, -1):
        column[kind] = layers[kind][room]
        room -= int(column[kind]) * sizes[kind]
    return column


def pieces(docs: DataFrame, vocabulary: str, width: int = 2048, end: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, number) of every piece; `number` counts pieces of a length in a task."""
    content = shipped(docs.sparkSession, vocabulary)

    def cut(batches):
        words, seen, task = _words(content.value), [0] * (width + 1), TaskContext.get().partitionId()
        mark = packed("<I", end)
        for ids, texts in slices(batches):
            rows = []
            for key, value in zip(ids, texts):
                tokens = words.encode(value or "") + mark
                for number, start in enumerate(range(0, len(tokens), 4 * width)):
                    part = tokens[start:start + 4 * width]
                    length = len(part) // 4
                    rows.append((key, number, start // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            yield batch_of(_PIECES, *map(list, zip(*rows)))

    kind = ", ".join(f"{name} long" for name in _PIECES.names)
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(cut, kind)


def pack(docs: DataFrame, vocabulary: str, width: int = 2048, end: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of each document lies.

    A document is its ids under `vocabulary` (a file of the tokenizers library whose words are independent) and the id
    `end`; only documents longer than `width` are cut.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, vocabulary, width, end, id, text), "pieces")
    counts = written(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("pieces")), "piece-counts")
    by_length = counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()  # `width` rows at most
    plan = Plan(width, {row.length: row.pieces for row in by_length})
    table = np.array(plan.places, np.int64).reshape(-1, 5).T
    sent = spark.sparkContext.broadcast((table[0] << 44 | table[1], *table[1:]))

    def place(batches):
        starts, firsts, sequences, offsets, each = sent.value
        for batch in batches:
            columns = {name: column for name, column in zip(batch.schema.names, batch.columns)}
            number = columns["number"].to_numpy() + columns["before"].to_numpy()
            length = columns["length"].to_numpy()
            at = np.searchsorted(starts, length << 44 | number, side="right") - 1
            along = number - firsts[at]
            columns["sequence_id"] = pa.array(sequences[at] + along // each[at])
            columns["offset"] = pa.array(offsets[at] + along % each[at] * length)
            yield pa.RecordBatch.from_pydict({name: columns[name] for name in out})

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)))
    joined = cut.join(before.select("task", "length", "before"), ["task", "length"])
    out = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return joined.mapInArrow(place, ", ".join(f"{name} long" for name in out)).withColumnRenamed("id", id)
