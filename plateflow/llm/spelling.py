"""Words grouped with their frequent spelling.

Words that differ by one inserted, deleted or replaced code point are near. A word's form is its near word that occurs most,
if that occurs `RATIO` times as often; following forms to the last one leads to its root.

1. Words are counted in the tasks that read the texts, each distinct one of a text once, and added up by word.
2. Words of one length with as many letters of each of three groups are a block, cut into tiles of `TILE` words at most, about. An
   edit moves one letter into, out of or between groups, so a block meets six others, no longer than it by more than a letter.
   Two tiles meet in a task as matrices of letter counts, whose product gives the squared distances of all their words:
   1 after an insertion or deletion, 2 after a replacement. Pairs at most two apart are compared letter by letter. A task
   hands on one row a word: its number of near words there, and the best of them.
3. Occurrences grow from form to form, so a chain of forms is short, and pointers are doubled until all have met their root.

Shuffled are counted words, each as often as tiles meet its own; no pair leaves a task.

Defined results: null texts have no words; null ids are ids like any other; repeated rows count again, as rows do; ties of form go
to the least word in the order of code points; no words, no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import batch_of, slices
from plateflow.session import written

#: Least code points of a word, and occurrences in all texts.
LETTERS, OCCURRENCES = 6, 5
#: How much more often than a word its form occurs.
RATIO = 5
#: Words of a tile, about, and words of it that are multiplied at once.
TILE, ROWS = 8192, 1024
#: Words counted in a task before they are handed on.
KEPT = 200_000
#: Pairs whose letters are compared at once.
PAIRS = 1 << 16
#: What words consist of; only A-Z are lower-cased.
WORD = rf"[A-Za-z\u00C0-\u00FF]{{{LETTERS},}}"
#: Two groups of letters of about equal share in text, the third being all others.
GROUPS = ("aeiou", "lnrst")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
#: Blocks that meet, as what the second has more in length and in letters of the groups: the same, those after a letter of one group
#: has given way to one of another, and those with a letter more. The opposite steps are these, seen from the second.
_STEPS = ((0, 0, 0), (0, 1, -1), (0, 1, 0), (0, 0, 1), (1, 1, 0), (1, 0, 1), (1, 0, 0))

#: What becomes of a text's words: given its id, a function of a word.
Edit = Callable[[int | None], Callable[[str], str]]

_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """(word, n): words of at least LETTERS code points that occur at least OCCURRENCES times in all texts.

    Words are maximal runs of letters, A-Z lower-cased. `edit` makes the function that changes the words of a text; it
    may shorten but not lengthen them.
    """
    find = re.compile(WORD).findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for ids, texts in slices(batches):
            for i, words in zip(ids, map(find, [text or "" for text in texts])):
                change = edit(i) if edit else None
                for word, n in Counter(words).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if change:
                        word = change(word)
                    if len(word) >= LETTERS:
                        total[word] += n
                if len(total) >= KEPT:
                    yield batch_of(_COUNTED, list(total), list(total.values()))
                    total.clear()
        yield batch_of(_COUNTED, list(total), list(total.values()))

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, word of each)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return codes, np.repeat(np.arange(len(words)), [len(word) for word in words])


def _letter_counts(*sides: list[str]) -> list[np.ndarray]:
    """A matrix for each list of words: how often each letter that occurs is in each word."""
    coded = [_codes(words) for words in sides]
    letters = np.unique(np.concatenate([codes for codes, _ in coded]))
    longest = max(len(word) for words in sides for word in words)
    # Squared lengths and products are whole numbers, exact in the smaller type for all but enormous words.
    kind = np.float32 if 4 * longest**2 < 2**24 else np.float64
    return [
        np.bincount(owner * len(letters) + np.searchsorted(letters, codes), minlength=len(words) * len(letters))
        .reshape(len(words), len(letters)).astype(kind)
        for words, (codes, owner) in zip(sides, coded)
    ]


def _one_edit(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of code points differ by one replacement, or by one insertion if those on the right are longer."""
    size = left.shape[1]
    if right.shape[1] == size:
        return (left != right).sum(axis=1) == 1
    before, after = left != right[:, :size], left != right[:, 1:]
    # The letters before the first difference must be followed by what is the same one place on.
    first = np.where(before.any(axis=1), before.argmax(axis=1), size)
    last = np.where(after.any(axis=1), size - 1 - after[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words in two lists, each of words of one length, those on the right as long or one letter longer.

    With `same` the lists are one, and each pair is given once.
    """
    first, second = _letter_counts(left, right)
    squares = [(counts**2).sum(axis=1) for counts in (first, second)]
    matrices = [np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1) for words in (left, right)]
    found = []
    for top in range(0, len(left), ROWS):
        for at in range(top if same else 0, len(right), ROWS):
            rows, others = slice(top, top + ROWS), slice(at, at + ROWS)
            distances = squares[0][rows, None] + squares[1][others] - 2 * (first[rows] @ second[others].T)
            i, j = np.nonzero(distances <= 2)
            i, j = i + top, j + at
            if same:
                i, j = i[i < j], j[i < j]
            for part in range(0, len(i), PAIRS):
                p, q = i[part : part + PAIRS], j[part : part + PAIRS]
                near = _one_edit(matrices[0][p], matrices[1][q])
                found.append((p[near], q[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


_NEAR = "word string, n_near bigint, best_n bigint, best string"


def _meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Of two tiles, a row for each word that has near words in the other: their number and the best of them."""
    out = []
    if len(left) and len(right):
        step, tile, other = (int(left[name].iloc[0]) for name in ("step", "tile", "other"))
        same = step == 0 and tile == other
        if same:  # the same words, but a shuffle may bring them in another order
            right = left
        i, j = near_pairs(left["word"].tolist(), right["word"].tolist(), same)
        for own, place, others, at in ((left, i, right, j), (right, j, left, i)):
            pairs = pd.DataFrame({"word": own["word"].to_numpy()[place], "best": others["word"].to_numpy()[at], "best_n": others["n"].to_numpy()[at]})
            pairs = pairs.sort_values(["word", "best_n", "best"], ascending=[True, False, True])
            best = pairs.drop_duplicates("word").set_index("word")
            best["n_near"] = pairs.groupby("word").size()
            out.append(best.reset_index())
    rows = pd.concat(out) if out else pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []})
    return rows[["word", "n_near", "best_n", "best"]].astype({"word": object, "n_near": "int64", "best_n": "int64", "best": object})


def _near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones."""
    letters = F.char_length("word")
    groups = [letters - F.char_length(F.translate("word", group, "")) for group in GROUPS]
    block = ["size", "first", "second"]
    placed = words.withColumns(dict(zip(block, (letters, *groups))))
    blocks = written(placed.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")), "spelling-blocks")
    placed = written(placed.join(blocks, block).withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int")), "spelling-tiles")
    steps = F.explode(F.array(*[F.struct(F.lit(n).alias("step"), *[F.lit(d).alias(f"_{name}") for name, d in zip(block, more)]) for n, more in enumerate(_STEPS)]))

    def facing(sign: int) -> DataFrame:
        """Every word with the tiles of the blocks a step away, or from which it is a step."""
        around = placed.withColumn("_step", steps).select("word", "n", *block, "tile", "_step.*")
        around = around.withColumns({f"_{name}": F.col(name) + sign * F.col(f"_{name}") for name in block})
        there = blocks.toDF(*[f"_{name}" for name in block], "_others")
        met = around.join(there, [f"_{name}" for name in block])
        return met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_others") - 1)))

    key = [*block, "step", "tile", "other"]
    # Both sides are keyed by block and tile of the first and the tile of the second.
    left = facing(1).select(*key, "word", "n")
    names = {name: f"_{name}" for name in block} | {"step": "step", "tile": "other", "other": "tile", "word": "word", "n": "n"}
    right = facing(-1).select(*[F.col(name).alias(new) for new, name in names.items()])
    once = (F.col("step") > 0) | (F.col("tile") <= F.col("other"))
    found = left.where(once).groupBy(*key).cogroup(right.where(once).groupBy(*key)).applyInPandas(lambda a, b: _meet(a, b), _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"), F.col("best_n").alias("best_n")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", "_b.best_n", "_b.best")


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n).

    `form` is the near word that occurs most, if it occurs RATIO times as often; `root` is where forms lead, or the word itself.
    """
    words = written(words.select("word", "n"), "spelling-words")
    most = words.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    if most["most"] is None:
        return words.select("word", F.col("word").alias("form"), F.col("word").alias("root"), "n", F.col("n").alias("n_near"), F.col("n").alias("form_n"))
    formed = F.col("best_n") >= RATIO * F.col("n")
    joined = words.join(_near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    )
    joined = written(joined, "spelling-forms")
    # Each form occurs RATIO times as often as its word, so this many steps at most lead to a root.
    steps = int(math.log(max(1, most["most"] / max(1, most["least"])), RATIO)) + 1
    roots = joined.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        roots = written(roots, "spelling-roots")
        onward = roots.toDF("root", "next")
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
