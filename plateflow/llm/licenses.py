"""Licence scans: a trained paragraph classifier whose predictions are confirmed by comparison with templates.

A paragraph is a line of a text. Its word n-grams (one and two words) are the sparse features of a multinomial logistic
regression over licence families and the class `unknown`. It is trained from the templates below, cut and disturbed at
random, against a bounded sample of the corpus' own paragraphs (`PARAGRAPHS`). A held-out part of both calibrates it: a
temperature makes the probabilities honest, and what stays below a threshold is unknown. A prediction counts as
confirmed if enough of the paragraph's n-grams stand in a template of the family predicted.

Most paragraphs are unknown beyond doubt: an upper bound of their scores, a sum over words, shows it before any matrix is used.

Defined results: null and empty texts have no paragraphs and no licences; a paragraph without words is unknown; null ids,
repeated ids and repeated rows each keep a row; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import slices

#: Paragraphs of the corpus that stand for the unknown class in training, at most, and the words used of each.
PARAGRAPHS, PARAGRAPH_WORDS = 2000, 120
#: Disturbed copies of each template.
COPIES = 60
#: The share of a paragraph's n-grams, or of a template's, that confirms a prediction.
CONFIRMED = 0.5
UNKNOWN = "unknown"

#: Notices by which works are put under a licence, by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the 3-clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal, dedicated to the public domain.",
    ),
}
FAMILIES = tuple(TEMPLATES)

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams_of(words: list[str]) -> list[str]:
    return [*words, *map(" ".join, zip(words, words[1:]))]


_TEMPLATE_GRAMS = {family: [set(grams_of(words_of(t))) for t in texts] for family, texts in TEMPLATES.items()}


def likeness(words: list[str], family: str) -> float:
    """The share of n-grams in common with the template most like it, of the shorter side."""
    own = set(grams_of(words))
    return max((len(own & t) / min(len(own), len(t)) for t in _TEMPLATE_GRAMS[family]), default=0.0) if own else 0.0


@dataclass(frozen=True)
class Model:
    """Weights by n-gram (a column per family, the last for unknown), biases, and what calibration found."""

    grams: dict[str, int]
    weights: np.ndarray
    biases: np.ndarray
    temperature: float
    threshold: float


class Classifier:
    def __init__(self, model: Model):
        self.model = model
        gains = np.maximum((model.weights[:, :-1] - model.weights[:, -1:]).max(axis=1), 0) if len(model.weights) else []
        self.gain: dict[str, float] = {}
        for gram, place in model.grams.items():
            first = gram.split(" ", 1)[0]
            # Every n-gram counts for its first word: once for the word, once for the best pair it may begin.
            own, pair = self.gain.get(first, (0.0, 0.0))
            self.gain[first] = (max(own, gains[place]), pair) if " " not in gram else (own, max(pair, gains[place]))
        self.gain = {word: own + pair for word, (own, pair) in self.gain.items() if own + pair > 0}
        self.least = float(model.biases[-1] - model.biases[:-1].max())

    def classify(self, words: list[str]) -> tuple[str, float]:
        """The family and its probability, or unknown and the probability of that."""
        gain = self.gain
        if sum(gain[w] for w in set(words) if w in gain) < self.least:
            return UNKNOWN, 1.0
        model = self.model
        places = [model.grams[g] for g in set(grams_of(words)) if g in model.grams]
        logits = (model.weights[places].sum(axis=0) + model.biases) / model.temperature
        chances = np.exp(logits - logits.max())
        chances /= chances.sum()
        best = int(chances[:-1].argmax())
        if chances[best] < model.threshold:
            return UNKNOWN, float(chances[-1])
        return FAMILIES[best], float(chances[best])


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 11) -> Model:
    """Train and calibrate from the templates and from at most PARAGRAPHS paragraphs of `docs`."""
    paragraphs = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    hashed = F.xxhash64(F.col(id), F.col(text))
    picked = docs.select(F.get(paragraphs, F.pmod(hashed, F.size(paragraphs)).cast("int")).alias("p")).where("length(trim(p)) > 0")
    picked = picked.select(F.substring_index("p", " ", PARAGRAPH_WORDS).alias("p"))
    # Equal paragraphs are one: a paragraph that a third of the corpus has is one example.
    own = [row.p for row in picked.distinct().orderBy(F.xxhash64("p"), "p").limit(PARAGRAPHS).collect()]
    rng = np.random.default_rng(seed)
    negatives = [w for p in own if (w := words_of(p)) and max(likeness(w, f) for f in FAMILIES) < CONFIRMED]
    telling = sorted({w for texts in TEMPLATES.values() for t in texts for w in words_of(t)})
    filler = sorted({w for words in negatives for w in words}) or ["text"]
    # Words of licences out of all order tell nothing; neither does an empty line.
    negatives += [[str(w) for w in rng.choice(telling, 2)] + [str(w) for w in rng.choice(filler, rng.integers(1, 12))] for _ in range(len(negatives) // 4 + 100)] + [[]]
    examples = [(w, len(FAMILIES)) for w in negatives]
    for label, family in enumerate(FAMILIES):
        for notice in TEMPLATES[family]:
            whole = words_of(notice)
            for copy in range(COPIES):
                kept = [w for w in whole if rng.random() > 0.03] if copy else whole
                around = [[str(w) for w in rng.choice(filler, rng.integers(0, 6))] if copy % 2 else [] for _ in range(2)]
                examples.append((around[0] + kept + around[1], label))
    grams = sorted({g for texts in _TEMPLATE_GRAMS.values() for t in texts for g in t})
    number = {g: i for i, g in enumerate(grams)}
    design = np.zeros((len(examples), len(grams) + 1), np.float32)
    design[:, -1] = 1
    for row, (words, _) in enumerate(examples):
        design[row, [number[g] for g in grams_of(words) if g in number]] = 1
    labels = np.array([label for _, label in examples])
    held = rng.random(len(examples)) < 0.2
    weights = _fitted(design[~held], labels[~held], len(FAMILIES) + 1)
    logits = (design[held] @ weights).astype(float)
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: _loss(logits / t, labels[held]))
    chances = np.exp(logits / temperature - (logits / temperature).max(axis=1, keepdims=True))
    chances /= chances.sum(axis=1, keepdims=True)
    unknown = chances[labels[held] == len(FAMILIES), :-1].max(axis=1, initial=0)
    # At most one in a hundred of the unknown paragraphs held out passes.
    threshold = float(max(0.5, np.quantile(unknown, 0.99) if len(unknown) else 0.5))
    return Model(number, weights[:-1], weights[-1], temperature, threshold)


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    top = logits.max(axis=1, keepdims=True)
    return float((np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0] - logits[np.arange(len(labels)), labels]).mean())


def _fitted(design: np.ndarray, labels: np.ndarray, classes: int, rounds: int = 150, penalty: float = 1e-4) -> np.ndarray:
    """Weights of a softmax regression by accelerated gradient descent."""
    weights = momentum = np.zeros((design.shape[1], classes), np.float32)
    target = np.eye(classes, dtype=np.float32)[labels]
    step = 4.0 * len(design) / float((design * design).sum())
    for turn in range(rounds):
        ahead = weights + turn / (turn + 3) * (weights - momentum)
        logits = design @ ahead
        chances = np.exp(logits - logits.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        momentum = weights
        weights = ahead - step * (design.T @ (chances - target) / len(design) + penalty * ahead)
    return weights


_FOUND = pa.list_(pa.struct([("paragraph", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("family", pa.string()), ("chance", pa.float64()), ("likeness", pa.float64()), ("confirmed", pa.bool_())]))


def scan(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_paragraphs, licences): the paragraphs of each document that are predicted to be under a licence.

    `licences` has (paragraph, start, end, family, chance, likeness, confirmed) in text order, positions in code points.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("id", pa.int64()), ("n_paragraphs", pa.int64()), ("licences", _FOUND)])

    def found_in(text: str, classifier: Classifier):
        found, start, number = [], 0, 0
        for paragraph in text.split("\n"):
            if paragraph.strip():
                words = words_of(paragraph)
                family, chance = classifier.classify(words)
                if family != UNKNOWN:
                    like = likeness(words, family)
                    found.append({"paragraph": number, "start": start, "end": start + len(paragraph), "family": family, "chance": chance, "likeness": like, "confirmed": like >= CONFIRMED})
                number += 1
            start += len(paragraph) + 1
        return number, found

    def run(batches):
        classifier = Classifier(sent.value)
        for ids, texts in slices(batches):
            results = [found_in(t or "", classifier) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([n for n, _ in results], pa.int64()), pa.array([f for _, f in results], _FOUND)], schema=schema)

    kind = "id long, n_paragraphs long, licences array<struct<paragraph: int, start: int, end: int, family: string, chance: double, likeness: double, confirmed: boolean>>"
    picked = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, kind).withColumnRenamed("id", id)
