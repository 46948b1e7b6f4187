"""Licence scan: paragraphs that state a licence, its family, how sure that is, and whether a template confirms it.

Method: a trained paragraph classifier.  Features are the word pairs and triples of the templates below, present or not; a
multinomial logistic regression with a class ``unknown`` weighs them.  It learns from altered copies of the templates (words
dropped, swapped in from other text, names and years put in) and from paragraphs of a bounded sample of documents,
SAMPLE_DOCUMENTS of them, which state no licence.  A fifth of both is held out: a temperature that fits the held-out
probabilities calibrates them, and the threshold for a family is the least that lets at most FALSE_ALARMS of the
held-out unknown paragraphs through.  A prediction is confirmed if the paragraph holds CONFIRMED of the word pairs of a template of its family.

A paragraph is a line; a line of more than WINDOW words is scanned in windows of WINDOW words that overlap by half.  A window
states one family, and the surest window of each family speaks for the paragraph.  A window that cuts a statement off may take
it for another family: it does not count if a window beside it has all of its word pairs and triples, is surer, and holds more
of a template.  Words are lower-cased runs of letters, digits and non-ASCII bytes.

Defined results.  One row for each paragraph and family that it states, none for others, so null, empty and plain texts give no rows.
Repeated rows are reported each, rows without doc_id with a null doc_id.  Other columns are ignored.  Ties go to the family that
comes first in the list.  An empty table trains on the built-in paragraphs alone and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.words import LOWER, mix, slices, split_words, text_bytes

# Phrases by which licences are stated, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0"),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT"),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only"),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is distributed under the terms of the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only"),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "This work is dedicated to the public domain under CC0 1.0 Universal."),
    "proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without written permission.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."),
}
# Paragraphs that use the words without stating a licence.
PLAIN = (
    "He renewed his driving license last week and paid the fee at the office.",
    "The public library is free and open to any person on the first floor.",
    "The software was released in version 2 after the general meeting of the foundation.",
    "You may not use this file until the work is done.",
    "The terms of the contract were met and the work is under way.",
    "A copy of the source was distributed to the public without charge.",
    "The city issued a fishing licence under the terms of the new law.",
    "Version 3 of the program is out, and the version 4 of the work is planned for later.",
)
SAMPLE_DOCUMENTS = 500
ALTERED = 40
"""Altered copies of each template."""
FALSE_ALARMS = 0.002
LEAST_SURE = 0.5
CONFIRMED = 0.6
WINDOW = 80
SEED = 17
SCHEMA = "doc_id long, paragraph int, family string, probability double, similarity double, confirmed boolean"

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[128:] = False
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_LINE = np.ones(256, dtype=bool)
_LINE[10] = False
MAP_BITS = 20
_STATES = ("licen", "copyright", "permi", "rights reserved")


def _grams(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word pair and of the word triple that begin at each word but the last ones."""
    pairs = mix(hashes[:-1] * np.uint64(3) + mix(hashes[1:]))
    triples = mix(pairs[:-1] * np.uint64(5) + mix(hashes[2:] + np.uint64(9)))
    return pairs, triples


@dataclass
class Units:
    """Windows of the paragraphs of some texts, and the words of each."""

    document: np.ndarray
    paragraph: np.ndarray
    low: np.ndarray
    high: np.ndarray
    hashes: np.ndarray


def units(data: np.ndarray, offsets: np.ndarray) -> Units:
    words = split_words(LOWER[data], offsets, _BETWEEN)
    line_ends = np.flatnonzero(data == 10)
    bounds = np.unique(np.concatenate((offsets[:-1], line_ends + 1, offsets[-1:])))
    edges = np.searchsorted(words.starts, bounds)
    document = np.searchsorted(offsets, bounds[:-1], side="right") - 1
    first_line = np.searchsorted(bounds, offsets[:-1])
    paragraph = np.arange(len(document)) - first_line[np.minimum(document, len(first_line) - 1)]
    low, high = edges[:-1], edges[1:]
    full = high > low
    document, paragraph, low, high = (x[full] for x in (document, paragraph, low, high))
    half = WINDOW // 2
    windows = np.maximum(1, -(-(high - low - half) // half))
    at = np.repeat(np.arange(len(low)), windows)
    begin = low[at] + half * (np.arange(len(at)) - np.repeat(np.cumsum(windows) - windows, windows))
    return Units(document[at], paragraph[at], begin, np.minimum(begin + WINDOW, high[at]), words.hashes())


class Features:
    """The word pairs and triples of the templates, and where they occur in some texts."""

    def __init__(self):
        grams, self.pairs_of = [], {}
        for family, texts in TEMPLATES.items():
            for text in texts:
                pairs, triples = _grams(units(*text_bytes(pa.array([text]))).hashes)
                grams += [pairs, triples]
                self.pairs_of.setdefault(family, []).append(np.unique(pairs))
        self.known = np.unique(np.concatenate(grams))
        self.map = np.zeros(1 << MAP_BITS, dtype=bool)
        self.map[(self.known >> np.uint64(64 - MAP_BITS)).astype(np.int64)] = True
        self.templates = [np.searchsorted(self.known, pairs) for texts in self.pairs_of.values() for pairs in texts]
        self.family_of = np.repeat(np.arange(len(TEMPLATES)), [len(t) for t in TEMPLATES.values()])

    def occurrences(self, found: Units) -> tuple[np.ndarray, np.ndarray]:
        """(unit, feature) of every template pair or triple in a unit, each once."""
        if len(found.hashes) < 2 or not len(found.low):
            none = np.zeros(0, dtype=np.int64)
            return none, none
        out = []
        for size, grams in zip((2, 3), _grams(found.hashes)):
            at = np.flatnonzero(self.map[(grams >> np.uint64(64 - MAP_BITS)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
            right = self.known[place] == grams[at]
            at, place = at[right], place[right]
            # Windows overlap by half, so a word lies in two of them at most.
            first = np.searchsorted(found.low, at, side="right") - 1
            for back in (0, 1):
                unit = first - back
                inside = (unit >= 0) & (at + size <= found.high[np.maximum(unit, 0)])
                out.append(np.stack((unit[inside], place[inside])))
        both = np.unique(np.concatenate(out, axis=1), axis=1)
        return both[0], both[1]


def altered(text: str, others: list[str], rng: np.random.Generator) -> str:
    """A template as people write it: words lost, names, years and other words put in, other case."""
    words = [w for w in text.split() if rng.random() > 0.06]
    if rng.random() < 0.3:
        words = [f"Copyright {rng.integers(1990, 2030)} {others[rng.integers(len(others))]}.", *words]
    for _ in range(rng.integers(0, 6)):
        words.insert(0 if rng.random() < 0.5 else len(words), others[rng.integers(len(others))])
    out = " ".join(words)
    return out.upper() if rng.random() < 0.1 else out


@dataclass
class Model:
    weights: np.ndarray
    """(features + 1) x (families + 1); the last row is the bias, the last column ``unknown``."""
    temperature: float
    threshold: float

    def probabilities(self, unit: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        scores = np.repeat(self.weights[-1:], n, axis=0)
        np.add.at(scores, unit, self.weights[feature])
        return _softmax(scores / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def fit(sample: list[str]) -> Model:
    """Train, calibrate and set the threshold; the same sample gives the same model."""
    rng = np.random.default_rng(SEED)
    features, plain = Features(), list(PLAIN)
    for text in sample:
        plain += [line for line in text.split("\n") if line.strip() and not any(s in line.lower() for s in _STATES)]
    others = [w for line in plain[:400] for w in line.split()]
    texts, labels = list(plain), [len(TEMPLATES)] * len(plain)
    for number, family in enumerate(TEMPLATES.values()):
        for text in family:
            texts += [text, *(altered(text, others, rng) for _ in range(ALTERED))]
            labels += [number] * (ALTERED + 1)
    y = np.array(labels)
    found = units(*text_bytes(pa.array(texts)))
    unit, feature = features.occurrences(found)
    x = np.zeros((len(texts), len(features.known) + 1), dtype=np.float32)
    x[found.document[unit], feature] = 1
    x[:, -1] = 1
    held = rng.random(len(texts)) < 0.2
    wanted = np.eye(len(TEMPLATES) + 1, dtype=np.float32)[y]
    train, goal = x[~held], wanted[~held]
    weight = (1 / np.bincount(y[~held], minlength=len(TEMPLATES) + 1).clip(1))[y[~held]].astype(np.float32)
    weight *= len(weight) / weight.sum()
    w = np.zeros((x.shape[1], len(TEMPLATES) + 1), dtype=np.float32)
    step, square = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, 201):
        slope = train.T @ ((_softmax(train @ w) - goal) * weight[:, None]) / len(train) + 1e-4 * w
        step, square = 0.9 * step + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        w -= 0.1 * (step / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.99 ** i)) + 1e-8)
    scores, truth = x[held] @ w, y[held]
    rows = np.arange(len(truth))
    temperature = min(np.geomspace(0.5, 5, 25), key=lambda t: -np.log(_softmax(scores / t)[rows, truth] + 1e-12).mean()) \
        if len(truth) else 1.0
    sure = _softmax(scores / temperature)[truth == len(TEMPLATES), :-1].max(axis=1) if len(truth) else np.zeros(0)
    alarm = float(np.quantile(sure, 1 - FALSE_ALARMS)) if len(sure) else 0.0
    return Model(w.astype(np.float64), float(temperature), min(0.95, max(LEAST_SURE, alarm)))


def _fragments(found: Units, touched, unit, feature, family, sure, similar) -> np.ndarray:
    """Windows that have no feature but those of a surer, more similar window of another family beside them."""
    out = np.zeros(len(touched), dtype=bool)
    line = np.stack((found.document[touched], found.paragraph[touched]))
    near = (np.diff(touched) == 1) & (np.diff(line, axis=1) == 0).all(axis=0) & (np.diff(family) != 0)
    cut = np.searchsorted(unit, np.arange(len(touched) + 1))
    for i in np.flatnonzero(near).tolist():
        weak, strong = (i, i + 1) if sure[i] < sure[i + 1] else (i + 1, i)
        out[weak] |= similar[weak] < similar[strong] and np.isin(feature[cut[weak]:cut[weak + 1]], feature[cut[strong]:cut[strong + 1]]).all()
    return out


def _scan(shared):
    def scan(batches) -> Iterator[pa.RecordBatch]:
        model, features, names = shared.value, Features(), np.array(list(TEMPLATES))
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for begin, end in slices(offsets, 2 << 20):
                part = offsets[begin:end + 1]
                found = units(data[part[0]:part[-1]], part - part[0])
                unit, feature = features.occurrences(found)
                touched, unit = np.unique(unit, return_inverse=True)
                if not len(touched):
                    continue
                chance = model.probabilities(unit, feature, len(touched))[:, :-1]
                family = np.argmax(chance, axis=1)
                sure = chance[np.arange(len(touched)), family]
                similar = np.zeros(len(touched))
                for template, owner in zip(features.templates, features.family_of):
                    share = np.bincount(unit[np.isin(feature, template)], minlength=len(touched)) / len(template)
                    similar = np.where(family == owner, np.maximum(similar, share), similar)
                fits = sure >= model.threshold
                fits &= ~_fragments(found, touched, unit, feature, family, sure, similar)
                rows = np.flatnonzero(fits)
                place = touched[rows]
                order = np.lexsort((place, -sure[rows], family[rows], found.paragraph[place], found.document[place]))
                rows, place = rows[order], place[order]
                key = np.stack((found.document[place], found.paragraph[place], family[rows]))
                first = np.concatenate(([True], (np.diff(key, axis=1) != 0).any(axis=0))) if len(rows) else np.zeros(0, bool)
                rows, place = rows[first], place[first]
                if len(rows):
                    yield pa.record_batch([
                        batch["doc_id"].take(pa.array(begin + found.document[place])),
                        pa.array(found.paragraph[place], pa.int32()), pa.array(names[family[rows]], pa.string()),
                        pa.array(sure[rows]), pa.array(similar[rows]), pa.array(similar[rows] >= CONFIRMED)],
                        names=[c.split()[0] for c in SCHEMA.split(", ")])
    return scan


def training_sample(docs: DataFrame) -> list[str]:
    """Texts of the SAMPLE_DOCUMENTS documents whose ids hash lowest."""
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).collect()
    chosen = docs.filter(F.col("doc_id").isin([r[0] for r in ids]) & F.col("text").isNotNull()).select("doc_id", "text")
    paragraphs = chosen.select("doc_id", F.posexplode(F.split("text", "\n"))) \
        .filter(F.length("col").between(1, 2000)).filter("pos < 50").orderBy("doc_id", "pos", "col")
    return [r["col"] for r in paragraphs.select("col").collect()]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity and confirmed for every paragraph that states a licence."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(fit(training_sample(docs)))
    return docs.mapInArrow(_scan(shared), SCHEMA)
