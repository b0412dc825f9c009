"""Toxicity of texts whose offending words may be disguised: a noisy channel is undone first, then words are scored.

A disguised word is a path through a lattice of characters: look-alike digits and signs, letters drawn out, letters set
apart. Viterbi's algorithm finds the likeliest original under a character trigram model, whose counts are gathered from all
documents and summed by Spark; the alphabet bounds the model (28 symbols cubed). The restored words are the features of
a logistic regression, which learns from a bounded sample of labelled rows (`SAMPLE`).

Defined results: a null text is empty; empty texts get the score of a text without telling words; null, repeated and
unlabelled ids each keep their rows; a null label counts as none, of several labels of an id the largest counts; without
labels of both kinds the score is the share of label 1 for all; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import batch_of, slices
from plateflow.llm.pretokens import Memo
from plateflow.session import written

#: The most labelled rows that are learned from; they are chosen by a hash of their ids.
SAMPLE = 40_000
#: The least likelihood ratio statistic of a weighed word (one in a thousand by chance).
TELLING = 10.83
FOLDS = 5

EDGE = "_"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: What letters a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il",
    "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
    "а": "a", "е": "e", "о": "o", "с": "c", "р": "p", "х": "x", "і": "i", "у": "y", "к": "k", "м": "m", "т": "t", "ѕ": "s", "ј": "j",
}
#: ASCII signs that stand for no letter.
SILENT = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in LOOKALIKES)
#: Natural logarithms of the channel: a sign for a letter, a sign that only separates, a drawn-out letter, a doubled letter
#: for one or a word end where none is marked.
AS_SIGN, APART, DRAWN_OUT, UNUSUAL = -1.6, -0.5, -0.5, -6.0

#: Distinct tokens that are counted before they are cut into trigrams.
TALLIED = 100_000

#: Codes of the edge and of letters: their distance from the edge.
SYMBOLS = ord("z") - ord(EDGE) + 1

_MODEL = pa.schema([("gram", pa.string()), ("n", pa.int64())])
_PLAIN = frozenset(LETTERS)
_THRICE = re.compile(r"(.)\1\1")


def simple(token: str) -> str:
    """The folded word of a token that has ASCII letters alone between signs that stand for no letter, else nothing."""
    word = token.strip(SILENT) if token.isascii() else ""
    return word.lower() if word.isalpha() else ""


def folded(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower().replace("ß", "ss")) if not unicodedata.combining(c))


def edges(word: str) -> tuple[str, str, str]:
    """The signs before a word that may be letters of it, the word from its first letter or digit to its last, and such signs behind it."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    signs = lambda part: "".join(c for c in part if c in LOOKALIKES) if part else ""
    return signs(word[:start]), word[start:end], signs(word[end:])


def _edge_ways(signs: str, nearest: int) -> list[str]:
    """What the signs at one edge of a word may be: nothing, the letters of the run next to the word, or all of several runs."""
    if not signs:
        return [""]
    run = len(signs) - len(signs.rstrip(signs[-1]) if nearest else signs.lstrip(signs[0]))
    ways = ["", *(c * k for c in LOOKALIKES[signs[nearest]] for k in (1, 2)[:run])]
    return ways + [signs] if run < len(signs) else ways


def stripped(word: str) -> str:
    """The word without the signs around it, unless they may be letters of it."""
    start, end = 0, len(word)
    while start < end and not (word[start].isalnum() or word[start] in "@$" and word[start + 1:start + 2].isalnum()):
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


class CharacterModel:
    """Trigram model of the letters of a word, with edges as symbols; lower orders fill in for rare contexts."""

    def __init__(self, counts: dict[str, int]):
        self.grams = dict(counts)
        pairs: Counter = Counter()
        singles: Counter = Counter()
        for gram, n in counts.items():
            pairs[gram[1:]] += n
            singles[gram[2]] += n
        before: Counter = Counter()
        heads: Counter = Counter()
        for gram, n in counts.items():
            before[gram[:2]] += n
            heads[gram[1]] += n
        total = sum(singles.values())

        def single(c):
            return (singles[c] + 1) / (total + 28)

        def pair(b, c):
            return (pairs[b + c] + 5 * single(c)) / (heads[b] + 5)

        self._log = lambda state, c: math.log((self.grams.get(state + c, 0) + 5 * pair(state[1], c)) / (before[state] + 5))
        self.log = Memo(lambda gram: self._log(gram[:2], gram[2]))

    def restore(self, observed: str, spaced: bool = False, letters_only: bool = False) -> str:
        """The likeliest words behind observed characters, separated by spaces.

        `spaced`: any gap may end a word; `letters_only`: a sign that may be a letter is one.
        """
        paths: dict[str, tuple[float, tuple | None]] = {EDGE * 2: (0.0, None)}
        log = self.log
        at = 0
        while at < len(observed):
            sign = observed[at]
            run = 1
            while at + run < len(observed) and observed[at + run] == sign:
                run += 1
            at += run
            if sign in _PLAIN:
                ways = [(sign, 0.0 if run == 1 else UNUSUAL if run == 2 else DRAWN_OUT)] + ([(sign * 2, 0.0 if run == 2 else DRAWN_OUT)] if run > 1 else [])
            else:
                ways = [(c * k, AS_SIGN + (DRAWN_OUT if run > k else 0)) for c in LOOKALIKES.get(sign, "") for k in (1, 2)[:run]]
                if not ways or not (letters_only or sign.isalnum()):
                    ways += [("", APART), (EDGE, UNUSUAL)]
            if spaced:
                ways += [(EDGE + way, cost + UNUSUAL) for way, cost in ways if way and way[0] != EDGE]
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (score, trail) in paths.items():
                for way, cost in ways:
                    value, now, track = score + cost, state, trail
                    for c in way:
                        if c == EDGE and now[1] == EDGE:
                            continue
                        value += log[now + c]
                        # A word starts from two edges, whatever came before.
                        now = EDGE * 2 if c == EDGE else now[1] + c
                        track = (c, track)
                    if now not in after or value > after[now][0]:
                        after[now] = (value, track)
            paths = after
        _, trail = max(((score + (log[state + EDGE] if state[1] != EDGE else 0.0), trail) for state, (score, trail) in paths.items()), key=lambda item: item[0])
        letters = []
        while trail:
            letters.append(trail[0])
            trail = trail[1]
        return "".join(reversed(letters)).replace(EDGE, " ").strip()


def _disguised(word: str) -> bool:
    """Whether a folded word has letters besides other characters, or one letter three times running."""
    if _PLAIN.issuperset(word):
        return _THRICE.search(word) is not None
    return len(word) > 1 and not _PLAIN.isdisjoint(word)


class Restorer:
    """Restored words of texts; those of a token are kept, within bounds."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.tokens = Memo(self._token)
        self.singles = Memo(self._single)

    def _token(self, token: str) -> tuple[str, ...]:
        word = simple(token)
        if word:
            return tuple(self.model.restore(word).split()) if _THRICE.search(word) else (word,)
        observed = folded(token)
        before, word, behind = ("", observed, "") if observed[:1].isalnum() and observed[-1:].isalnum() else edges(observed)
        signed = before or behind
        if signed:
            word = stripped(observed)
        plain = tuple(self.model.restore(word).split()) if _disguised(word) else (word,) if word else ()
        return tuple(dict.fromkeys((*plain, *self._edged(*edges(observed))))) if signed else plain

    def _edged(self, before: str, word: str, behind: str) -> list[str]:
        """The words if signs at the edges are letters; whether they are is left to the weights of the words."""
        signs = before + behind
        if not signs or not (any(c in _PLAIN for c in word) or len(set(signs)) > 1):
            return []
        if not word:
            return self.model.restore(signs, letters_only=True).split()
        words: list[str] = []
        for head in _edge_ways(before, -1):
            for tail in _edge_ways(behind, 0):
                form = head + word + tail
                signed = not (form[0].isalnum() and form[-1].isalnum())
                if signed or _disguised(form):
                    words += self.model.restore(form).split()
                if signed:
                    words += self.model.restore(form, letters_only=True).split()
                elif not _disguised(form):
                    words.append(form)
        return words

    def spaced(self, tokens: list[str]) -> list[str]:
        """The words spelled by three or more single characters on end, whatever punctuation is around them.

        Punctuation before a character begins a run and behind it ends one; a chain of such runs is read as a whole, too.
        """
        marked = {token for token in set(tokens) if len(token) > 1 and not (token[0].isalnum() and token[-1].isalnum()) and self.singles[token]}
        single = [i for i, token in enumerate(tokens) if len(token) == 1 or token in marked]
        words: list[str] = []
        start = 0
        for place in range(1, len(single) + 1):
            if place == len(single) or single[place] != single[place - 1] + 1:
                if place - start >= 3:
                    chain = tokens[single[start]:single[place - 1] + 1]
                    words += self._spelled(chain)
                    if any(token in marked for token in chain):
                        for run in self._runs(chain):
                            if 3 <= len(run) < len(chain):
                                words += self._spelled(run)
                start = place
        return words

    def _single(self, token: str) -> tuple[str, str, str] | tuple[()]:
        """The parts of a token, look-alike signs before, character and signs behind, if it has one character but for punctuation."""
        if token[0].isalnum() and token[-1].isalnum() or token.isascii() and (token[:2].isalnum() or token[-2:].isalnum()):
            return ()
        before, character, behind = edges(folded(token))
        if not character:
            before, character, behind = "", before, ""
        return (before, character, behind) if len(character) == 1 else ()

    def _runs(self, chain: list[str]) -> list[list[str]]:
        """The chain cut before tokens that begin with punctuation, and behind those that end with it."""
        runs: list[list[str]] = [[]]
        for token in chain:
            if len(token) > 1 and not token[0].isalnum() and runs[-1]:
                runs.append([])
            runs[-1].append(token)
            if len(token) > 1 and not token[-1].isalnum():
                runs.append([])
        return runs

    def _spelled(self, run: list[str]) -> list[str]:
        parts = [self.singles[token] if len(token) > 1 else ("", folded(token), "") for token in run]
        plain, signed = "".join(part[1] for part in parts), "".join(map("".join, parts))
        if not any(c in _PLAIN for c in plain):
            return []
        readings = dict.fromkeys([(plain, False), (signed, False)] + [(signed, True)] * any(not c.isalnum() and c in LOOKALIKES for c in signed))
        return [word for observed, letters_only in readings for word in self.model.restore(observed, True, letters_only).split()]

    def words(self, text: str) -> set[str]:
        tokens = text.split()
        found = {word for token in set(tokens) for word in self.tokens[token]}
        found.update(self.spaced(tokens))
        return found


@dataclass(frozen=True)
class Model:
    """What was learned: trigram counts, the weights of restored words, and the score without any."""

    grams: dict[str, int]
    weights: dict[str, float]
    bias: float


class Scorer:
    def __init__(self, model: Model):
        restorer = Restorer(CharacterModel(model.grams))
        known = model.weights
        self.spaced, self.bias, self.weights = restorer.spaced, model.bias, known
        self.tokens = Memo(lambda token: tuple(w for w in restorer._token(token) if w in known))

    def score(self, text: str) -> float:
        tokens = text.split()
        words = {w for found in map(self.tokens.__getitem__, set(tokens)) for w in found}
        words.update(w for w in self.spaced(tokens) if w in self.weights)
        value = self.bias + sum(self.weights[w] for w in sorted(words))
        return 1 / (1 + math.exp(-value)) if value > -700 else 0.0


def held_out(id: Column) -> Column:
    """Whether labels of the id are kept from learning."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _tallies(batches) -> Iterator[Counter]:
    """How often each token occurs, over stretches of about TALLIED distinct ones: what repeats is then looked at once."""
    words: Counter = Counter()
    for (texts,) in slices(batches):
        for t in texts:
            if t:
                words.update(t.split())
        if len(words) >= TALLIED:
            yield words
            words = Counter()
    yield words


def _plain_word(token: str) -> str:
    """The folded word of a token, or nothing if it is not of plain letters alone."""
    word = simple(token)
    if word:
        return word
    word = stripped(folded(token))
    return word if _PLAIN.issuperset(word) else ""


def gram_counts(words: Sequence[str], copies: Sequence[int]) -> np.ndarray:
    """How often each trigram occurs in so many copies of each word, edges included, at the number of the trigram (see `gram_of`)."""
    if not words:
        return np.zeros(SYMBOLS**3, np.int64)
    # Between two words stand the edge behind one and both before the next.
    symbols = np.frombuffer(f"{EDGE * 2}{(EDGE * 3).join(words)}{EDGE}".encode(), np.uint8).astype(np.int32) - ord(EDGE)
    numbers = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 3
    weights = np.repeat(np.array(copies, np.float64), lengths)[:len(numbers)]
    counts = np.bincount(numbers, weights, SYMBOLS**3).astype(np.int64)
    counts.reshape(-1, SYMBOLS**2)[:, 0] = 0  # they reach from a word into the next
    return counts


def gram_of(number: int) -> str:
    return "".join(chr(ord(EDGE) + number // SYMBOLS**place % SYMBOLS) for place in (2, 1, 0))


def trigrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): how often words have three symbols in a row, over all documents; 28 symbols cubed rows at most."""
    def count(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for tally in _tallies(batches):
            words: Counter = Counter()
            for token, n in tally.items():
                word = _plain_word(token)
                if word:
                    words[word] += n
            total += gram_counts(list(words), list(words.values()))
        found = np.flatnonzero(total)
        yield batch_of(_MODEL, [gram_of(number) for number in found.tolist()], total[found].tolist())

    return docs.select(text).mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn from the rows of `labels` that are not held out; `docs` without their labels give the character model."""
    spark = docs.sparkSession
    grams = {row.gram: row.n for row in trigrams(docs, text).collect()}  # bounded by the alphabet
    known = labels.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    chosen = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(sample)  # at most `sample` rows, 12 bytes each
    model = spark.sparkContext.broadcast(grams)

    def restore(batches):
        restorer = Restorer(CharacterModel(model.value))
        for marks, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int32()), pa.array([sorted(restorer.words(t or "")) for t in texts], pa.list_(pa.string()))], ["label", "words"])

    joined = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    rows = written(joined.select("label", "text").mapInArrow(restore, "label int, words array<string>"), "toxicity-sample")
    sizes = Counter({row.label: row.n for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()})
    positive, negative = sizes[1], sum(sizes.values()) - sizes[1]
    bias = math.log((positive + 0.5) / (negative + 0.5))
    if not positive or not negative:
        return Model(grams, {}, bias)

    with_one = F.sum((F.col("label") == 1).cast("long"))
    per_word = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(with_one.alias("a"), (F.count(F.lit(1)) - with_one).alias("b"))
    term = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    share, seen = F.lit(positive / (positive + negative)), F.col("a") + F.col("b")
    c, d, unseen = positive - F.col("a"), negative - F.col("b"), positive + negative - seen
    telling = 2 * (term(F.col("a"), seen * share) + term(F.col("b"), seen * (1 - share)) + term(c, unseen * share) + term(d, unseen * (1 - share)))
    best = per_word.select("word", telling.alias("telling")).where(F.col("telling") >= TELLING)
    words = sorted(row.word for row in best.select("word").collect())  # bounded by the sample
    if not words:
        return Model(grams, {}, bias)
    number = {word: i for i, word in enumerate(words)}
    listed = spark.sparkContext.broadcast(number)

    def numbered(batches):
        for marks, found in slices(batches):
            held = [np.array(sorted(listed.value[w] for w in some if w in listed.value), np.int32).tobytes() for some in found]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int32()), pa.array(held, pa.binary())], ["label", "held"])

    # At most `sample` rows, four bytes for each word that is weighed.
    held = rows.select("label", "words").mapInArrow(numbered, "label int, held binary").groupBy("label", "held").agg(F.count(F.lit(1)).alias("n")).collect()
    features = [np.frombuffer(bytes(row.held), np.int32) for row in held]
    fit = _fitted(features, len(words), np.array([float(r.label == 1) for r in held]), np.array([float(r.n) for r in held]), bias)
    return Model(grams, dict(zip(words, fit[:-1].tolist())), float(fit[-1]))


def _fitted(features: list[np.ndarray], size: int, target: np.ndarray, copies: np.ndarray, bias: float, penalty: float = 0.02) -> np.ndarray:
    """Weights and bias of a logistic regression, a penalty on the weights, over rows that are the numbers of their words.

    Newton's method, whose steps come from conjugate gradients, so that no matrix of words by words is held.
    """
    of_row = np.repeat(np.arange(len(features)), [len(row) for row in features])
    word = np.concatenate(features) if features else np.zeros(0, np.int32)
    ridge = np.full(size + 1, penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(size + 1)
    weights[-1] = bias
    along = lambda w: np.bincount(of_row, w[word], len(features)) + w[-1]
    back = lambda x: np.append(np.bincount(word, x[of_row], size), x.sum())

    def loss(w):
        z = along(w)
        return copies @ (np.logaddexp(0, z) - target * z) + 0.5 * ridge @ (w * w)

    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(along(weights), -500, 500)))
        slope = back(copies * (chance - target)) + ridge * weights
        bend = copies * chance * (1 - chance)
        step, size_of_step, now = _solved(lambda v: back(bend * along(v)) + ridge * v, slope, back(bend) + ridge), 1.0, loss(weights)
        while size_of_step > 1e-4 and loss(weights - size_of_step * step) > now:
            size_of_step /= 2
        weights = weights - size_of_step * step
        if np.abs(step).max() * size_of_step < 1e-6:
            break
    return weights


def _solved(product, right: np.ndarray, diagonal: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The x for which product(x) is `right`, by conjugate gradients scaled by the diagonal."""
    x, rest = np.zeros_like(right), right.copy()
    scaled = rest / diagonal
    way, size = scaled.copy(), rest @ scaled
    least = 1e-4 * size  # Newton's steps near the end are short, so a hundredth of the slope is near enough
    for _ in range(rounds):
        if size <= least or size == 0:
            break
        bent = product(way)
        length = size / (way @ bent)
        x, rest = x + length * way, rest - length * bent
        scaled = rest / diagonal
        size, before = rest @ scaled, size
        way = scaled + size / before * way
    return x


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document; the score depends on the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        scorer = Scorer(sent.value)
        for ids, texts in slices(batches):
            yield batch_of(schema, ids, [scorer.score(t or "") for t in texts])

    scored = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, score double")
    return scored.select(F.col("id").alias(id), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text", below: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, that score below the threshold."""
    sent, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                yield part.filter(pa.array([scorer.score(t or "") < below for t in part.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
