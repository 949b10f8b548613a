"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Paragraphs are windows of up to `WINDOW` words of a line, each beginning half a window after
the one before, so that a notice inside a long line is seen undiluted. A multinomial logistic
regression over hashed words and word pairs gives each window a licence family or none. It is
fitted on a bounded sample: windows of the corpus without any licence word, and the templates
set into such windows, shortened and with words missing. Temperature and the threshold below
which a family counts as unknown are calibrated on a part held out of the fit. A prediction
is confirmed if the window holds enough of the word pairs of one of the family's templates;
a licence-like window that no template confirms is reported as `unknown`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from loomtally.llm.tables import durable, shipped
from loomtally.llm.words import WordHasher, mixed, slices

# Short standard notices by which the families are known.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD License."),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
NONE, UNKNOWN = "none", "unknown"
WINDOW = 40
BUCKETS = 1 << 16
# Bounds of the training sample.
SAMPLE_DOCS, SAMPLE_WINDOWS, VARIANTS = 400, 4_000, 150
CONFIRM = 0.75
SEED = 11
STRIP = b".,;:()\"'!?"


def line_words(text: str | None) -> list[list[bytes]]:
    """Words of each line: ASCII lower case, without punctuation."""
    if text is None:
        return []
    return [line.translate(None, STRIP).split() for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def features(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its bucket, and that of the pair it ends (the first word's pair is unused)."""
    pairs = np.zeros_like(hashes)
    pairs[1:] = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    return (hashes % np.uint64(BUCKETS // 2)).astype(np.int64), (pairs % np.uint64(BUCKETS // 2) + np.uint64(BUCKETS // 2)).astype(np.int64)


def _fresh(places: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """False where a feature stood less than half a window before in the same line."""
    order = np.argsort(places, kind="stable")
    before, here = order[:-1], order[1:]
    again = (places[before] == places[here]) & (lines[before] == lines[here]) & (here - before < WINDOW // 2)
    fresh = np.ones(len(places), bool)
    fresh[here[again]] = False
    return fresh


@dataclass
class Classifier:
    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    threshold: float
    templates: dict[str, list[np.ndarray]]
    held_out_accuracy: float

    def scan(self, texts: list[str | None], hasher: WordHasher) -> Iterator[tuple]:
        """(row, line, word, family, probability, similarity) of each licence-like window."""
        rows, numbers, lengths, words = [], [], [], []
        for row, text in enumerate(texts):
            for number, own in enumerate(line_words(text)):
                if own:
                    rows.append(row)
                    numbers.append(number)
                    lengths.append(len(own))
                    words += own
        if not words:
            return
        hashes = hasher(words)
        first, second = features(hashes)
        length = np.array(lengths)
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        of_line = np.repeat(np.arange(len(length)), length)
        fresh, fresh_pair = _fresh(first, of_line), _fresh(second, of_line)
        count = np.maximum(1, -(-(length - WINDOW // 2) // (WINDOW // 2)))
        line = np.repeat(np.arange(len(length)), count)
        nth = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
        start = begin[line] + nth * (WINDOW // 2)
        stop = np.minimum(start + WINDOW, begin[line] + length[line])
        score = np.tile(self.bias, (len(start), 1))
        for k in range(len(self.families)):
            # float64 running sums; a window's sum is a difference of two of them.
            single = np.concatenate([[0.0], np.cumsum(self.weights[first, k] * fresh, dtype=np.float64)])
            pair = np.concatenate([[0.0], np.cumsum(self.weights[second, k] * fresh_pair, dtype=np.float64)])
            score[:, k] += (single[stop] - single[start]) + (pair[stop] - pair[start + 1])
        score -= score.max(1, keepdims=True)
        share = np.exp(score)
        share /= share.sum(1, keepdims=True)
        none = self.families.index(NONE)
        for i in np.flatnonzero(1 - share[:, none] >= self.threshold):
            family = max((k for k in range(len(self.families)) if k != none), key=lambda k: share[i, k])
            name = self.families[family]
            similarity = max(containment(t, hashes[start[i] : stop[i]]) for t in self.templates[name])
            yield (rows[line[i]], numbers[line[i]], int(start[i] - begin[line[i]]),
                   name if similarity >= CONFIRM else UNKNOWN, float(1 - share[i, none]), similarity)


def containment(template: np.ndarray, hashes: np.ndarray) -> float:
    """Share of the template's word pairs that the window has."""
    pairs = np.unique(mixed(hashes[:-1] * np.uint64(3) + hashes[1:]))
    return float(np.isin(template, pairs).mean()) if len(template) else 0.0


def _template_pairs(text: str) -> np.ndarray:
    hashes = WordHasher()([w for line in line_words(text) for w in line])
    return np.unique(mixed(hashes[:-1] * np.uint64(3) + hashes[1:]))


def background(docs: DataFrame) -> list[list[bytes]]:
    """Windows of a bounded sample of documents that have no licence word anywhere."""
    total = docs.count()
    wanted = docs.select("text").where("text IS NOT NULL").where(
        F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 30)) < min(1 << 30, int(2 * SAMPLE_DOCS / max(1, total) * (1 << 30)) + 1)
    ).where(~F.lower("text").rlike("licen|copyright|warrant|permitted|permission"))
    sample = wanted.distinct().orderBy(F.xxhash64(F.lit(6), "text"), "text").limit(SAMPLE_DOCS)
    out = []
    for row in sample.collect():
        for own in line_words(row["text"]):
            out += [own[k : k + WINDOW] for k in range(0, len(own), WINDOW)]
    return out


def train(docs: DataFrame) -> Classifier:
    """A classifier fitted on `SAMPLE_WINDOWS` windows and `VARIANTS` per template at most."""
    rng = np.random.default_rng(SEED)
    plain = background(docs)
    if len(plain) > SAMPLE_WINDOWS:
        plain = [plain[i] for i in np.sort(rng.choice(len(plain), SAMPLE_WINDOWS, replace=False))]
    families = [NONE, *sorted(TEMPLATES)]
    samples = [(own, 0) for own in plain] or [([b"text"], 0)]
    for k, name in enumerate(families[1:], 1):
        for template in TEMPLATES[name]:
            core = [w for line in line_words(template) for w in line]
            for _ in range(VARIANTS):
                kept = [w for w in core if rng.random() > 0.05]
                around = plain[rng.integers(len(plain))] if plain else []
                room = max(0, WINDOW - len(kept))
                left = int(rng.integers(0, room + 1)) if rng.random() < 0.5 else 0
                right = int(rng.integers(0, room - left + 1))
                samples.append((around[:left] + kept + around[::-1][:right], k))
    hasher = WordHasher()
    owners, places, labels = [], [], np.array([k for _, k in samples])
    for i, (own, _) in enumerate(samples):
        first, second = features(hasher(own))
        found = np.unique(np.concatenate([first, second[1:]]))
        owners.append(np.full(len(found), i))
        places.append(found)
    owner, place = np.concatenate(owners), np.concatenate(places)
    fold = rng.random(len(samples)) < 0.2
    weights, bias = _fitted(owner, place, labels, ~fold, len(families))
    scores = _scores(owner, place, len(samples), weights, bias)
    held = np.flatnonzero(fold)
    heat = min((0.5, 1.0, 1.5, 2.0, 3.0, 5.0), key=lambda t: _loss(scores[held] / t, labels[held])) if len(held) else 1.0
    share = np.exp(scores / heat - (scores / heat).max(1, keepdims=True))
    share /= share.sum(1, keepdims=True)
    alarm = 1 - share[held, 0]
    quiet = np.sort(alarm[labels[held] == 0])
    # At most one in a thousand held-out windows without licence passes.
    threshold = max(0.5, float(quiet[int(0.999 * (len(quiet) - 1))]) if len(quiet) else 0.5)
    right = float((share[held].argmax(1) == labels[held]).mean()) if len(held) else 1.0
    return Classifier(
        families, (weights / heat).astype(np.float32), bias / heat, min(threshold, 0.99),
        {name: [_template_pairs(t) for t in TEMPLATES[name]] for name in families[1:]}, right,
    )


def _scores(owner, place, n, weights, bias):
    return np.stack([np.bincount(owner, weights[place, k], n) for k in range(len(bias))], 1) + bias


def _loss(scores, labels):
    shifted = scores - scores.max(1, keepdims=True)
    return float((np.log(np.exp(shifted).sum(1)) - shifted[np.arange(len(labels)), labels]).mean())


def _fitted(owner, place, labels, used, kinds, steps=150, rate=0.5, decay=1e-5):
    """Full-batch descent with per-weight step sizes (Adagrad) on the sparse rows in use."""
    n = len(labels)
    weights, bias = np.zeros((BUCKETS, kinds)), np.zeros(kinds)
    squares, bias_squares = np.full((BUCKETS, kinds), 1e-8), np.full(kinds, 1e-8)
    target = np.eye(kinds)[labels]
    weight = used / max(1, used.sum())
    for _ in range(steps):
        scores = _scores(owner, place, n, weights, bias)
        share = np.exp(scores - scores.max(1, keepdims=True))
        error = (share / share.sum(1, keepdims=True) - target) * weight[:, None]
        slope = np.stack([np.bincount(place, error[owner, k], BUCKETS) for k in range(kinds)], 1) + decay * weights
        squares += slope**2
        weights -= rate * slope / np.sqrt(squares)
        own = error.sum(0)
        bias_squares += own**2
        bias -= rate * own / np.sqrt(bias_squares)
    return weights, bias


def scan(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`doc_id`, `line`, `word`, `family`, `probability`, `similarity` of licence paragraphs.

    A row per licence-like window of every row of `docs`; `unknown` where no template of the
    predicted family is there. NULL and empty texts have none; repeated rows give repeated
    rows; equally likely families go by name. Other columns are not looked at.
    """
    shared = shipped(docs.sparkSession, classifier)

    def search(batches):
        hasher = WordHasher()
        for batch in batches:
            ids = batch["doc_id"]
            for own in slices(batch["text"]):
                found = list(shared.value.scan(batch["text"].iloc[own].tolist(), hasher))
                frame = pd.DataFrame(found, columns=["row", "line", "word", "family", "probability", "similarity"])
                frame["doc_id"] = ids.iloc[own].to_numpy()[frame["row"].to_numpy(dtype=np.int64)]
                yield frame[["doc_id", "line", "word", "family", "probability", "similarity"]]

    return docs.select("doc_id", "text").mapInPandas(
        search, "doc_id long, line int, word int, family string, probability double, similarity double"
    )


def licences(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`doc_id`, `family`, number of windows, best probability and similarity per document.

    An `unknown` window counts only for documents without a confirmed family; rows without id
    are one document. The texts are read once, and what is found in them is stored.
    """
    found = durable(scan(docs, classifier).groupBy("doc_id", "family").agg(
        F.count("*").alias("n_windows"), F.max("probability").alias("probability"), F.max("similarity").alias("similarity")
    ))
    confirmed = found.where(F.col("family") != UNKNOWN)
    known = confirmed.select(F.col("doc_id").alias("known_id")).distinct()
    rest = found.where(F.col("family") == UNKNOWN).join(known, F.col("doc_id").eqNullSafe(F.col("known_id")), "left_anti")
    return confirmed.unionByName(rest)
