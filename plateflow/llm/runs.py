"""Periodic runs of words, found in a grammar of the words.

A run is a stretch of consecutive words in which words one period apart are identical, at least `EXPONENT` periods and
`LENGTH` words long, that no neighbouring word extends; its period is the smallest one. Boilerplate that a crawler glued
together many times, tables turned to text and stuck generators leave such runs.

1. Only words in trigrams that occur three times in a stretch can be in a run of it, so texts are cut at all others,
   until no cut is left. Ordinary text is gone by then; equal hashes of trigrams only spare a stretch a cut.
2. The words left are compressed by Re-Pair: the more frequent of overlapping pairs gives way to a nonterminal, round by
   round, and what repeats no more is paired into a balanced tree. The grammar is one for all texts of a slice.
3. Runs across the boundary of a nonterminal's two halves are found once, in its first occurrence: one half holds two
   periods of it next to the boundary, which hashes of its prefixes tell for all periods at once, and words confirm.
4. They are moved to every place that the nonterminal derives. A run of a text lies whole in the smallest nonterminal
   around it, so that of all intervals of one period those in no other are the runs.

Texts are independent of one another: nothing is shuffled, and a task holds one slice of `WORDS` words or one longer text.

Defined results: a null text has no words; empty texts have no runs and an empty collapsed text; null ids, repeated ids
and repeated rows each keep a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import slices

#: Least length of a run in words and in periods. Step 1 rests on both.
LENGTH, EXPONENT = 6, 4
#: Words that are searched together; a longer text is searched alone.
WORDS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_SCHEMA = pa.schema([("id", pa.int64()), ("runs", pa.list_(pa.struct(_FIELDS))), ("best", pa.struct(_FIELDS)), ("collapsed", pa.string())])

#: What a text's words become before they are searched: places of words, given the id and the number of words.
Edit = Callable[[int | None, int], np.ndarray | None]


def _mixed(values: np.ndarray) -> np.ndarray:
    mixed = (values.astype(np.uint64) + np.uint64(1)) * _MIX
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _joined(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all stretches, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def repetitive(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, stretch of each) of the words that may be in runs; a run lies whole in one stretch."""
    places, stretch = np.arange(len(words)), owner
    while len(places) >= LENGTH:
        x = words[places]
        key = _mixed(x[:-2]) ^ (_mixed(x[1:-1]) * np.uint64(3)) ^ (_mixed(x[2:]) * np.uint64(7)) ^ (_mixed(stretch[:-2]) * np.uint64(11))
        whole = stretch[:-2] == stretch[2:]
        ordered = np.sort(key[whole])
        thrice = ordered[2:][ordered[2:] == ordered[:-2]]
        if not len(thrice):
            break
        thrice = np.unique(thrice)
        found = np.minimum(np.searchsorted(thrice, key), len(thrice) - 1)
        often = whole & (thrice[found] == key)
        # Consecutive trigrams of one stretch stay together.
        first = often.copy()
        first[1:] &= ~often[:-1] | (stretch[1:-2] != stretch[:-3])
        last = often.copy()
        last[:-1] &= ~often[1:] | (stretch[1:-2] != stretch[:-3])
        starts, lengths = np.flatnonzero(first), np.flatnonzero(last) - np.flatnonzero(first) + 3
        starts, lengths = starts[lengths >= LENGTH], lengths[lengths >= LENGTH]
        before = len(places)
        places = places[_joined(starts, lengths)]
        stretch = np.repeat(np.arange(len(starts)), lengths)
        if len(places) == before:
            return places, stretch
    return places[:0], stretch[:0]


class _Text:
    """The words left, with what tells periods of a stretch at once."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        power = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, _MIX | np.uint64(1)), out=power[1:])
        self.power = power
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(words) * power[:-1], out=self.sums[1:])
        # Distances to the next and the previous place of the same word.
        order = np.argsort(words, kind="stable")
        same = words[order[1:]] == words[order[:-1]]
        gap = np.where(same, order[1:] - order[:-1], n)
        self.after, self.before = np.full(n, n), np.full(n, n)
        self.after[order[:-1]], self.before[order[1:]] = gap, gap

    def squares(self, start: np.ndarray, periods: np.ndarray) -> np.ndarray:
        """Which of the periods may repeat twice from their start; those that do are all among them."""
        middle, end = self.sums[start + periods], self.sums[start + 2 * periods]
        return (middle - self.sums[start]) * self.power[periods] == end - middle

    def stretch(self, low: int, high: int, start: int, period: int) -> tuple[int, int] | None:
        """The interval within [low, high) around two periods from `start`; None if they differ."""
        x = self.words
        if not np.array_equal(x[start : start + period], x[start + period : start + 2 * period]):
            return None
        end, step = start + 2 * period, 64
        while end < high:
            stop = min(high, end + step)
            wrong = x[end:stop] != x[end - period : stop - period]
            if wrong.any():
                end += int(wrong.argmax())
                break
            end, step = stop, step * 2
        step = 64
        while start > low:
            stop = max(low, start - step)
            wrong = (x[stop:start] != x[stop + period : start + period])[::-1]
            if wrong.any():
                start -= int(wrong.argmax())
                break
            start, step = stop, step * 2
        return start, end

    def crossing(self, low: int, middle: int, high: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of the runs of [low, high) that hold words on both sides of `middle`."""
        longest = (high - low) // EXPONENT
        right = np.arange(1, min(longest, (high - middle) // 2) + 1)
        right = right[self.words[middle + right] == self.words[middle]]
        right = right[self.squares(np.full(len(right), middle), right)]
        left = np.arange(1, min(longest, (middle - low) // 2) + 1)
        left = left[self.words[middle - 1 - left] == self.words[middle - 1]]
        left = left[self.squares(middle - 2 * left, left)]
        found = []
        for periods, after in ((right, True), (left, False)):
            while len(periods):
                period, periods = int(periods[0]), periods[1:]
                interval = self.stretch(low, high, middle if after else middle - 2 * period, period)
                if interval is None:
                    continue
                start, end = interval
                if start < middle < end and end - start >= max(LENGTH, EXPONENT * period):
                    found.append((start, end, period))
                # A longer period that fits twice into this interval is a multiple of its smallest one.
                periods = periods[2 * periods > (end - middle if after else middle - start)]
        found = sorted(set(found), key=lambda run: run[2])
        return [
            run for place, run in enumerate(found)
            if not any(run[2] % o[2] == 0 and o[0] <= run[0] and run[1] <= o[1] for o in found[:place] if o[2] < run[2])
        ]


def _selected(symbols: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Places of the pairs to replace: those more frequent than the pairs they overlap with, or any where none repeats."""
    left, right = symbols[:-1], symbols[1:]
    place = np.arange(len(left))
    same = joined & (left == right)
    # Of overlapping pairs of one symbol every second counts.
    offset = place - np.maximum.accumulate(np.where(same, -1, place))
    counted = joined & ~(same & (offset % 2 == 0))
    key = left * (symbols.max() + 1) + right
    kinds, kind, number = np.unique(key[counted], return_inverse=True, return_counts=True)
    if (number > 1).any():
        # By powers of two, then by a hash: then a constant share of the pairs goes in a round.
        order = np.lexsort((_mixed(kinds), np.frexp(number)[1]))
        rank = np.empty(len(kinds), np.int64)
        rank[order] = np.arange(1, len(kinds) + 1)
        rank[number < 2] = 0
        weight = np.zeros(len(left) + 2, np.int64)
        weight[1:-1][counted] = rank[kind]
        mine = weight[1:-1]
        return np.flatnonzero((mine > weight[:-2]) & (mine > weight[2:]))
    offset = place - np.maximum.accumulate(np.where(joined, -1, place))
    return np.flatnonzero(joined & (offset % 2 == 1))


def runs_of(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """(start, end, period) of the runs of the numbered words, by start and period; none holds words of two owners."""
    places, stretch = repetitive(words, owner)
    if not len(places):
        return np.zeros((0, 3), np.int64)
    _, symbols = np.unique(words[places], return_inverse=True)
    text = _Text(symbols)
    start = np.arange(len(symbols))
    end = start + 1
    names: dict[tuple[int, int], int] = {}
    inside: dict[int, np.ndarray] = {}
    first_name, found = int(symbols.max()) + 1, []
    while True:
        top = first_name + len(names)
        joined = stretch[start[:-1]] == stretch[start[1:]]
        if not joined.any():
            break
        chosen = _selected(symbols, joined)
        low, middle, high = start[chosen], start[chosen + 1], end[chosen + 1]
        key = symbols[chosen] * top + symbols[chosen + 1]
        kinds, first, kind = np.unique(key, return_index=True, return_inverse=True)
        size = (high - low)[first] // EXPONENT
        near = (text.after[middle[first]] <= size) | (text.before[middle[first] - 1] <= size)
        numbers = np.empty(len(kinds), np.int64)
        for place, (pair, may) in enumerate(zip(kinds.tolist(), near.tolist())):
            pair = divmod(pair, top)
            number = names.get(pair)
            if number is None:
                number = names[pair] = first_name + len(names)
                if may:
                    a, b, c = (int(v[first[place]]) for v in (low, middle, high))
                    runs = text.crossing(a, b, c)
                    if runs:
                        inside[number] = np.array(runs) - [a, a, 0]
            numbers[place] = number
        # The runs of a nonterminal at all its places.
        for place in np.flatnonzero([number in inside for number in numbers.tolist()]):
            at = low[kind == place]
            for run in inside[numbers[place]]:
                found.append(np.column_stack((at + run[0], at + run[1], np.full(len(at), run[2]))))
        symbols, end = symbols.copy(), end.copy()
        symbols[chosen], end[chosen] = numbers[kind], high
        gone = np.zeros(len(symbols), bool)
        gone[chosen + 1] = True
        symbols, start, end = symbols[~gone], start[~gone], end[~gone]
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs[:, 1] += places[runs[:, 0]] - runs[:, 0]
    runs[:, 0] = places[runs[:, 0]]
    return maximal(runs)


def maximal(runs: np.ndarray) -> np.ndarray:
    """The intervals that no other of the same period holds, by start and period."""
    runs = runs[np.lexsort((-runs[:, 1], runs[:, 0], runs[:, 2]))]
    group = np.cumsum(np.concatenate(([0], (runs[1:, 2] != runs[:-1, 2]).astype(np.int64))))
    reach = group * (runs[:, 1].max() + 1) + runs[:, 1]
    kept = np.ones(len(runs), bool)
    kept[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    runs = runs[kept]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods; of equal ones the first, then the one of least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _search(ids: list, texts: list[str | None], edit: Edit | None) -> pa.RecordBatch:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    # Bytes split at the six ASCII characters of white space and nothing else.
    split = [(text or "").encode().split() for text in texts]
    orders = [edit(i, len(words)) if edit else None for i, words in zip(ids, split)]
    numbered = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in split]
    numbered = [words if order is None else words[order] for words, order in zip(numbered, orders)]
    ends = np.cumsum([0, *map(len, numbered)])
    runs = runs_of(np.concatenate(numbered), np.repeat(np.arange(len(ids)), np.diff(ends)))
    limits = np.searchsorted(runs[:, 0], ends)
    all_runs, bests, collapsed = [], [], []
    for place, (words, order) in enumerate(zip(split, orders)):
        own = runs[limits[place] : limits[place + 1]] - [ends[place], ends[place], 0]
        rows = [(start, end - start, period) for start, end, period in own.tolist()]
        all_runs.append(rows)
        bests.append(_best(rows))
        if rows:
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, own[:, 0] + own[:, 2], 1)
            np.add.at(dropped, own[:, 1], -1)
            kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
            words = [words[i] for i in (kept if order is None else order[kept]).tolist()]
        elif order is not None:
            words = [words[i] for i in order.tolist()]
        collapsed.append(b" ".join(words).decode())
    named = lambda run: None if run is None else dict(zip(("start", "length", "period"), run))
    columns = [ids, [[named(run) for run in rows] for rows in all_runs], [named(run) for run in bests], collapsed]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _together(rows: Iterator[list[list]]) -> Iterator[tuple[list, list]]:
    """Rows gathered to about WORDS words by their characters, one longer text alone."""
    ids, texts, size = [], [], 0
    for some_ids, some_texts in rows:
        for i, text in zip(some_ids, some_texts):
            own = len(text or "") // 6
            if ids and size + own > WORDS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += own
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """(id, runs, best, collapsed): the runs of every text's words, and its words without repeated periods.

    `runs` are (start, length, period) in words by start and period, `best` the one of most periods. `collapsed` leaves out
    the words that a run holds after its first period, the others joined by a space. `edit` rearranges the words
    beforehand: given id and number of words it returns the places of the words to take, or None to leave them.
    """
    def search(batches):
        for ids, texts in _together(slices(batches)):
            yield _search(ids, texts, edit)

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = f"id bigint, runs array<{_RUN}>, best {_RUN}, collapsed string"
    return rows.mapInArrow(search, schema).withColumnRenamed("id", id)
