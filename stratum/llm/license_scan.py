"""Licence scan: a trained paragraph classifier, confirmed by templates.

*Classifier*: multinomial logistic regression over sparse word n-grams (one to
three words) of the licence templates below, the share of other words, and a
constant.  Training examples are made from the templates (whole, cut, with
words lost or swapped, inside running text of the corpus); the class
``unknown`` learns from at most ``max_negatives`` corpus paragraphs (those with
the smallest hash) and from templates' words in random order.  A temperature
fitted on held-out examples calibrates the probabilities, and a family is
predicted only at a calibrated probability of at least ``min_probability``;
the rest is unknown.

*Confirmation*: a predicted paragraph must share its word pairs with one
template of the family: at least ``min_overlap`` of the smaller side's pairs.

Paragraphs are lines; a line of more than ``WINDOW`` words is also read in
windows of that many words, half overlapping, so that a licence inside a long
paragraph stands out.  Whole texts are scanned.

Defined cases: null and empty texts have one empty paragraph and no licence;
repeated paragraphs are all reported; without any corpus paragraph the unknown
class learns from shuffled templates alone; further columns pass through, and the result column gets
trailing underscores where the name is taken.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_name, table, text_blocks, text_bytes

WINDOW = 80

#: Wording by which public licences are granted or named.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released into the public domain under the Unlicense.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "No part of this work may be reproduced without the written permission of the publisher.",
    ],
}
FAMILIES = list(TEMPLATES)
UNKNOWN = len(FAMILIES)

#: Bytes of words: letters, digits, dots inside version numbers stay out.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Features:
    """Numbers for the templates' words and n-grams; other words are 0."""

    def __init__(self):
        sentences = [words_of(t.encode()) for own in TEMPLATES.values() for t in own]
        self.words = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for s in sentences for w in s))}
        self.base = len(self.words) + 1
        grams: set[int] = set()
        for s in sentences:
            ids = [self.words[w] for w in s]
            for n in (1, 2, 3):
                for i in range(len(ids) - n + 1):
                    grams.add(self.code(ids[i:i + n]))
        self.codes = np.array(sorted(grams), np.int64)
        self.size = len(self.codes) + 2  # share of other words, constant

    def code(self, ids: list[int]) -> int:
        out = 0
        for i in ids:
            out = out * self.base + i
        return out

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.words.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def grams(self, ids: np.ndarray):
        """(position of the first word, feature) of all known n-grams."""
        at_all, f_all = [], []
        code = np.zeros(len(ids), np.int64)
        for n in (1, 2, 3):
            m = len(ids) - n + 1
            if m <= 0:
                break
            nxt = ids[n - 1:]
            alive = (nxt > 0) & ((code[:m] > 0) if n > 1 else True)
            code = np.where(alive, code[:m] * self.base + nxt, 0)
            at = np.flatnonzero(code)
            f = np.searchsorted(self.codes, code[at])
            ok = (f < len(self.codes)) & (self.codes[np.minimum(f, len(self.codes) - 1)] == code[at])
            at_all.append(at[ok])
            f_all.append(f[ok])
        if not at_all:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(at_all), np.concatenate(f_all)


class Model:
    """Weights (features x classes), temperature and limits."""

    def __init__(self, features: Features, weights: np.ndarray, temperature: float, min_probability: float,
                 min_overlap: float):
        self.features, self.weights, self.temperature = features, weights, temperature
        self.min_probability, self.min_overlap = min_probability, min_overlap
        self.pairs = [[{(a, b) for a, b in zip(w, w[1:])} for t in own for w in [words_of(t.encode())]]
                      for own in TEMPLATES.values()]

    def logits(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Class scores of paragraphs: consecutive ranges of ``ids``, each
        followed by one 0 (so no n-gram spans two of them)."""
        f = self.features
        at, gram = f.grams(ids)
        para = np.searchsorted(starts, at, "right") - 1
        n = np.maximum(sizes, 1)
        out = np.empty((len(starts), self.weights.shape[1]))
        value = 1 / np.sqrt(n[para])
        known = np.add.reduceat((ids > 0).astype(np.int64), starts)
        other = 1 - known / n
        for c in range(self.weights.shape[1]):
            out[:, c] = np.bincount(para, value * self.weights[gram, c], len(starts))
        return out + other[:, None] * self.weights[-2] + self.weights[-1]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def overlap(self, words: list[bytes], family: int) -> float:
        """Best share of word pairs that the smaller of paragraph and template has in the other."""
        own = set(zip(words, words[1:]))
        return max((len(own & t) / min(len(own), len(t)) for t in self.pairs[family] if t and own), default=0.0)

    def findings(self, texts: list[bytes]) -> list[list[dict]]:
        """Confirmed licences of every text."""
        words, doc, line_no = [], [], []
        for k, text in enumerate(texts):
            for i, line in enumerate(text.split(b"\n")):
                w = words_of(line)
                cuts = [w] if len(w) <= WINDOW else \
                    [w, *(w[lo:lo + WINDOW] for lo in range(0, len(w) - WINDOW // 2, WINDOW // 2))]
                words += cuts
                doc += [k] * len(cuts)
                line_no += [i] * len(cuts)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(words) else np.empty(0, np.int64)
        get = self.features.words.get
        ids = np.fromiter((x for w in words for x in (*map(get, w, (0,) * len(w)), 0)), np.int64,
                          int(sizes.sum()) + len(words))
        p = self.probabilities(self.logits(ids, starts, sizes)) if len(words) else np.zeros((0, UNKNOWN + 1))
        best = p.argmax(axis=1) if len(words) else np.empty(0, int)
        found: list[dict] = [{} for _ in texts]
        for i in np.flatnonzero(best != UNKNOWN).tolist():
            family, prob = int(best[i]), float(p[i, best[i]])
            if prob < self.min_probability:
                continue
            share = self.overlap(words[i], family)
            if share >= self.min_overlap:
                key = (line_no[i], family)
                old = found[doc[i]].get(key)
                if old is None or prob > old["probability"]:
                    found[doc[i]][key] = {"paragraph": line_no[i], "family": FAMILIES[family],
                                          "probability": prob, "overlap": share}
        return [[v for _, v in sorted(x.items())] for x in found]


def examples(negatives: list[bytes], seed: int = 5, each: int = 24) -> tuple[list[list[bytes]], np.ndarray]:
    """Training paragraphs (words) and classes."""
    rng = np.random.default_rng(seed)
    plain = [w for w in map(words_of, negatives) if w]
    texts, classes = [], []
    for c, own in enumerate(TEMPLATES.values()):
        for t in own:
            w = words_of(t.encode())
            for k in range(each):
                x = list(w)
                if k and len(x) > 8 and rng.random() < 0.5:  # a part of a long template
                    lo = int(rng.integers(0, len(x) - 7))
                    x = x[lo:lo + int(rng.integers(7, len(x) - lo + 1))]
                if k and len(x) > 6 and rng.random() < 0.4:
                    x.pop(int(rng.integers(0, len(x))))
                if k and plain and rng.random() < 0.5:  # in running text
                    around = plain[int(rng.integers(0, len(plain)))]
                    lo = int(rng.integers(0, len(around)))
                    x = around[max(0, lo - 12):lo] + x + around[lo:lo + 12]
                texts.append(x)
                classes.append(c)
                if k % 3 == 0:  # the same words without their order are no licence
                    mixed = list(w)
                    rng.shuffle(mixed)
                    texts.append(mixed[:max(2, len(mixed) // 2)])
                    classes.append(UNKNOWN)
    known = Features().words
    for w in plain:
        lo = 0 if len(w) <= WINDOW else int(rng.integers(0, len(w) - WINDOW))
        x = w[lo:lo + WINDOW]
        if sum(v in known for v in x) < 0.8 * len(x):  # licences among the sampled paragraphs are not learnt as unknown
            texts.append(x)
            classes.append(UNKNOWN)
    texts.append([])
    classes.append(UNKNOWN)
    return texts, np.array(classes)


def train(negatives: list[bytes], min_probability: float, min_overlap: float, rounds: int = 300,
          rate: float = 2.0, decay: float = 1e-4) -> Model:
    features = Features()
    texts, y = examples(negatives)
    x = np.zeros((len(texts), features.size), np.float32)
    for i, w in enumerate(texts):
        ids = features.ids(w)
        _, gram = features.grams(ids)
        np.add.at(x[i], gram, 1 / np.sqrt(max(1, len(w))))
        x[i, -2] = (ids == 0).sum() / max(1, len(w))
        x[i, -1] = 1
        if not len(w):
            x[i, -2] = 1
    held = np.arange(len(y)) % 5 == 4
    goal = np.eye(UNKNOWN + 1, dtype=np.float32)[y]
    weights = np.zeros((features.size, UNKNOWN + 1), np.float32)
    speed = np.zeros_like(weights)
    a, b = x[~held], goal[~held]
    model = Model(features, weights, 1.0, min_probability, min_overlap)
    for _ in range(rounds):
        grad = a.T @ (model.probabilities(a @ weights) - b) / len(a) + decay * weights
        speed = 0.9 * speed - rate * grad
        weights += speed.astype(np.float32)
    logits = x[held] @ weights

    def loss(t: float) -> float:
        model.temperature = t
        p = model.probabilities(logits)
        return -float(np.log(np.maximum(p[np.arange(len(p)), y[held]], 1e-12)).mean())
    model.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    return model


FOUND = "array<struct<paragraph:int,family:string,probability:double,overlap:double>>"


def scan_licenses(docs: DataFrame, max_negatives: int = 2000, min_probability: float = 0.5,
                  min_overlap: float = 0.6) -> DataFrame:
    """``docs`` plus ``licenses``: paragraph (line number from 0), family,
    calibrated probability and template overlap of every confirmed paragraph."""
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line"))
    hashed = lines.where("length(line) > 0").select(F.substring("line", 1, 4000).alias("line"), F.xxhash64("line").alias("h"))
    # every task would send its own max_negatives smallest: a bound on the hash,
    # four times as wide as needed, leaves about so many in all
    share = min(1.0, 4 * max_negatives / max(1, hashed.count()))
    sample = hashed.where(F.col("h") <= int((1 << 64) * share) - (1 << 63) - 1 if share < 1 else F.lit(True)) \
        .orderBy("h", "line").limit(max_negatives).select("line")
    negatives = [r[0].encode() for r in sample.collect()]
    shared = spark.sparkContext.broadcast(train(sorted(negatives), min_probability, min_overlap))

    @F.arrow_udf(FOUND)
    def licenses(texts: pa.Array) -> pa.Array:
        model, out = shared.value, []
        for block in text_blocks(texts):
            out += model.findings(text_bytes(block))
        return pa.array(out, pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()),
                                                 ("probability", pa.float64()), ("overlap", pa.float64())])))
    return docs.withColumn(free_name(docs.columns, "licenses"), licenses(F.col("text").cast("string")))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or granted in every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(docs)
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"])))
    return found.select(
        "doc_id", F.array_join(families, ",").alias("families"), F.size("licenses").cast("bigint").alias("n_licensed"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(
            ":", x["paragraph"].cast("string"), x["family"])), ",").alias("paragraphs"),
        F.coalesce(F.array_min(F.transform("licenses", lambda x: x["probability"])), F.lit(0.0)).alias("least_probability"))
