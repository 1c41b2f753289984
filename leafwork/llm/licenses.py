"""Licence scans: a trained paragraph classifier with a calibrated unknown class and templates that confirm it.

A paragraph is a line of the text; a long one is judged in overlapping passages. A sparse multinomial logistic regression
over words and pairs of neighbouring words, learned from the notices in TEMPLATES (whole, in parts, and within ordinary
words) against ordinary lines of the documents, gives each passage a probability for each licence and for ordinary text.
Two logistic curves, fitted to notices and licences that a model did not see in training, turn its margins into the
probability of a licence notice and of a known licence. Whatever isn't known with confidence, or shares too little with
each notice of its licence, is `unknown`. The scan runs as built-in expressions; only passages with a telling word, and
with grams that can add up to a notice, reach the classifier: of others, by its weights, none can be judged a notice.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.llm.common import of_row, rows_whole, table

_NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL 2.0"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons Zero"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}
_PHRASES = ["Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This software is distributed under the terms of the {}."]
_TEXTS = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following two conditions are met"],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved.", "No part of this work may be reproduced without permission. All rights reserved."],
}
#: The notices of each licence.
TEMPLATES: dict[str, list[str]] = {
    c: [p.format(n) for n in _NAMES.get(c, []) for p in _PHRASES] + [f"SPDX-License-Identifier: {c}"] * (c in _NAMES) + _TEXTS.get(c, [])
    for c in [*_NAMES, "all-rights-reserved"]
}
UNKNOWN = "unknown"
#: Ordinary lines that speak of rights and licences.
ORDINARY = ["His driver's license was suspended for a year.", "The rights of the people were discussed in parliament.", "Copyright law was reformed in that year.", "She has the permission of the school to use the hall.", "The software is free of errors.", "All seats are reserved for members.", "The people have the right to a license in the country.", "The version of the work was released under a new name.", "A copy of the public record was distributed to the people.", "The driver showed the license of the car to the officer.", "The authors of the work are named in the book.", "Copyright disputes between the two companies went on for years."]
#: Documents of which a line each may enter the sample of ordinary lines, and words of a line that are kept.
TRAIN_DOCS, TRAIN_WORDS = 2_000, 200
#: Words of a passage, and from the start of one to the next; a longest notice is a little over one passage.
PASSAGE, STEP = 80, 40
#: Words of a part of a notice, and from one part to the next.
PART, PART_STEP = 10, 5
#: Of the regression: strength of the squared penalty, weights below this share of the largest are dropped, steps.
PENALTY, LEAST, STEPS = 2e-4, 0.01, 300
#: Models for calibration: each is shown neither the licences nor the notices of its fold.
FOLDS = 4
#: Share of a notice's word pairs in the passage, or of the passage's in the notice, without which a licence isn't confirmed.
CONFIRMED = 0.5


def tokens(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def pairs(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def features(words: list[str]) -> list[str]:
    """The distinct words and pairs of neighbours."""
    return list(dict.fromkeys([*words, *pairs(words)]))


def family(c: str) -> str:
    return "GPL" if "GPL" in c else c.split("-")[0].rstrip("0")


def parts(words: list[str]) -> list[list[str]]:
    """A notice whole and, if it is long, in overlapping parts."""
    cut = [words[i : i + PART] for i in range(0, len(words) - PART + 1, PART_STEP)] if len(words) > 2 * PART else []
    return [words, *cut]


class Regression:
    """Multinomial logistic regression on sets of n-grams, fitted by accelerated gradient steps; weight[0] is ordinary text."""

    def __init__(self, samples: list[tuple[frozenset, int, float]], classes: int, vocabulary: list[str]):
        self.vocabulary = vocabulary
        at = {g: k for k, g in enumerate(self.vocabulary)}
        rows: dict[tuple[tuple[int, ...], int], float] = {}
        for grams, c, w in samples:  # most ordinary lines are alike in what the vocabulary sees
            key = tuple(sorted(at[g] for g in grams if g in at)), c
            rows[key] = rows.get(key, 0.0) + w
        x = np.zeros((len(rows), len(at) + 1))
        y = np.zeros((len(rows), classes))
        for k, ((grams, c), w) in enumerate(rows.items()):
            x[k, list(grams)] = 1.0
            x[k, -1] = 1.0
            y[k, c] = w
        mass = y.sum(axis=1, keepdims=True)
        y, mass = y / mass.sum(), mass / mass.sum()
        weight = old = np.zeros((x.shape[1], classes))
        rate = 2.0 / (float((mass * x * x).sum(axis=0).max()) * math.sqrt(max(1.0, float(x.sum(axis=1).mean()))) + PENALTY)
        for step in range(STEPS):
            ahead = weight + step / (step + 3) * (weight - old)
            z = x @ ahead
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            old, weight = weight, ahead - rate * (x.T @ (mass * p - y) + PENALTY * ahead)
        weight[:-1][np.abs(weight[:-1]) < LEAST * np.abs(weight[:-1]).max(initial=0)] = 0
        self.weight, self.at = weight, at

    def logits(self, words: list[str]) -> np.ndarray:
        return self.weight[[*(self.at[g] for g in features(words) if g in self.at), len(self.at)]].sum(axis=0)


def margins(logits: np.ndarray) -> tuple[float, float, int]:
    """Log odds of any licence against ordinary text, lead of the best licence over the next, and the best's number."""
    best = 1 + int(np.argmax(logits[1:]))
    rest = np.delete(logits[1:], best - 1)
    top = logits[1:].max()
    return float(top + np.log(np.exp(logits[1:] - top).sum()) - logits[0]), float(logits[best] - rest.max()), best


class Model:
    """The regression, its telling words and the two curves."""

    def __init__(self, ordinary: list[str], templates: dict[str, list[str]] | None = None):
        self.templates = TEMPLATES if templates is None else templates
        self.classes = list(self.templates)
        self.plain = [tokens(x)[:TRAIN_WORDS] for x in [*ordinary, *ORDINARY]]
        self.filler = [x for x in self.plain if len(x) >= 6] or [["a"] * 6]
        self.vocabulary = sorted({g for texts in self.templates.values() for t in texts for g in features(tokens(t))})
        self.regression = Regression(self._samples({}), len(self.classes) + 1, self.vocabulary)
        self.cover = self._cover()
        self._calibrate()
        self.telling = self._telling()

    def _samples(self, hidden: dict[str, set[int]]) -> list[tuple[frozenset, int, float]]:
        """Training sets without the `hidden` notices: each notice's parts bare and among ordinary words; classes weigh alike."""
        out = []
        for c, name in enumerate(self.classes):
            shown = [t for k, t in enumerate(self.templates[name]) if k not in hidden.get(name, ())]
            for t in shown:
                found = parts(tokens(t))
                for k, words in enumerate(found):
                    w = 1.0 / len(shown) / len(found) / len(self.classes)
                    pick = zlib.crc32(" ".join(words).encode()) + k
                    before, after = self.filler[pick % len(self.filler)], self.filler[(pick // 7 + 1) % len(self.filler)]
                    out.append((frozenset(features(words)), c + 1, w))
                    out.append((frozenset(features([*before[-12:], *words, *after[:12]])), c + 1, w))
        for x in self.plain:
            out.append((frozenset(features(x)), 0, 1.0 / len(self.plain)))
        for x in ORDINARY:  # few, but close to notices
            out.append((frozenset(features(tokens(x))), 0, 0.5 / len(ORDINARY)))
        return out

    def _cover(self) -> list[str]:
        """Words, rare in ordinary lines, of which each part of a notice holds one: the cheapest cover, chosen greedily."""
        lines = [" ".join(x) for x in self.plain[: -len(ORDINARY)]]
        need = [set(p) for texts in self.templates.values() for t in texts for p in parts(tokens(t))]
        cost = {w: 1e-3 + sum(w in x for x in lines) / max(1, len(lines)) for w in {w for p in need for w in p if len(w) > 3}}
        chosen: list[str] = []
        while need:
            gain = Counter(w for p in need for w in p if w in cost)
            if not gain:
                break
            best = min(gain, key=lambda w: (cost[w] / gain[w], w))
            chosen.append(best)
            need = [p for p in need if best not in p]
        return sorted(chosen)

    def _calibrate(self) -> None:
        """Held-out notices against ordinary lines, and against notices of licences that a model wasn't shown."""
        families = sorted({family(c) for c in self.classes})
        score, lead = [], []
        for fold in range(FOLDS):
            away = {c for c in self.classes if families.index(family(c)) % FOLDS == fold}
            some = {c: {k for k in range(len(t)) if len(t) > 1 and (k + zlib.crc32(c.encode())) % FOLDS == fold} for c, t in self.templates.items()}
            model = Regression(self._samples({c: set(range(len(self.templates[c]))) if c in away else some[c] for c in self.classes}), len(self.classes) + 1, self.vocabulary)
            shown = [k + 1 for k, c in enumerate(self.classes) if c not in away]
            for c, texts in self.templates.items():
                for k, t in enumerate(texts):
                    if c not in away and k not in some[c]:
                        continue
                    got = model.logits(tokens(t))[[0, *shown]]
                    odds, ahead, best = margins(got)
                    score.append((odds, 1))
                    if c in away:
                        lead.append((ahead, 0))
                    elif shown[best - 1] - 1 == self.classes.index(c):
                        lead.append((ahead, 1))
        score += [(margins(self.regression.logits(x))[0], 0) for x in self.plain if set(self.cover) & set(x)]
        score.append((float(self.regression.weight[-1, 1:].max() - self.regression.weight[-1, 0]), 0))
        self.is_license, self.is_known = _curve(score), _curve(lead)

    def _telling(self) -> list[str]:
        """Words of which every passage that can be judged a licence notice holds one.

        With all grams that hold none of them, whatever speaks for a licence counted and whatever speaks against it
        not, a passage stays short of a probability of 0.5. Of the vocabulary's words those frequent in ordinary
        lines are left out first, as long as that is so.
        """
        w, (slope, offset) = self.regression.weight, self.is_license
        gain = np.maximum(w[:-1, 1:] - w[:-1, :1], 0) if slope > 0 else np.zeros((len(w) - 1, 1))
        bias = w[-1, 1:] - w[-1, 0]
        short = lambda total: slope > 0 and slope * float(np.logaddexp.reduce(bias + total)) + offset < -0.05 * slope  # noqa: E731  # weights are rounded in the scan
        if not short(np.zeros(len(bias))):
            return [""]  # in every text
        lines = [" ".join(x) for x in self.plain[: -len(ORDINARY)]]
        single = [g for g in self.vocabulary if " " not in g]
        often = {x: sum(x in line for line in lines) for x in single}
        out, total = set(), np.zeros(len(bias))
        for x in sorted(single, key=lambda x: (-often[x], len(x), x)):
            more = [k for g, k in self.regression.at.items() if x in g.split(" ") and out.issuperset(set(g.split(" ")) - {x})]
            if short(total + gain[more].sum(axis=0)):
                out.add(x)
                total = total + gain[more].sum(axis=0)
        return sorted(set(single) - out)

    def judge(self, words: list[str]) -> tuple[float, float, str]:
        """Probability of a licence notice, probability of a known licence, and the best licence, of one passage."""
        odds, ahead, best = margins(self.regression.logits(words))
        (a1, b1), (a2, b2) = self.is_license, self.is_known
        p, q = (1 / (1 + math.exp(-max(-50.0, min(50.0, x)))) for x in (a1 * odds + b1, a2 * ahead + b2))
        return p, q, self.classes[best - 1]


def _curve(points: list[tuple[float, int]]) -> tuple[float, float]:
    """(slope, offset) of the logistic curve, with the classes weighed alike and targets short of 0 and 1."""
    n = Counter(y for _, y in points)
    rows = [(x, (n[1] + 1) / (n[1] + 2) if y else 1 / (n[0] + 2), 1 / n[y]) for x, y in points]
    mean = sum(x * w for x, _, w in rows) / 2
    scale = max(1e-9, math.sqrt(sum((x - mean) ** 2 * w for x, _, w in rows) / 2))
    a = b = 0.0
    for _ in range(50):
        g, h, i, ga, gb = 1e-3, 0.0, 1e-3, -1e-3 * a, -1e-3 * b
        for x, y, w in rows:
            z = (x - mean) / scale
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * z + b))))
            ga, gb, v = ga + w * (y - p) * z, gb + w * (y - p), w * p * (1 - p)
            g, h, i = g + v * z * z, h + v * z, i + v
        det = g * i - h * h
        da, db = (i * ga - h * gb) / det, (g * gb - h * ga) / det
        step = min(1.0, 2 / max(1e-9, abs(da), abs(db)))
        a, b = a + step * da, b + step * db
    return a / scale, b - a * mean / scale


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """The model, with at most `train_docs` lines of `docs` as ordinary text: of the documents with the smallest hash
    one line each, at most TRAIN_WORDS words of it. Lines that name a licence or a right are left out, as nobody has
    labelled them."""
    share = min(1.0, 2 * train_docs / max(1, docs.count()))
    some = docs.select(F.xxhash64("doc_id").alias("h"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30)))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    some = some.select("h", lines.alias("x")).filter("size(x) > 0").selectExpr("h", f"substring(x[cast(pmod(h, size(x)) as int)], 1, {TRAIN_WORDS * 16}) as x").orderBy("h", "x").limit(train_docs)
    return Model([r["x"] for r in some.collect() if not re.search("licen[sc]|copyright|rights reserved|permission|spdx", r["x"], re.IGNORECASE)])


# ---------------------------------------------------------------- the scan


def _strings(values: list[str]) -> str:
    return f"split('{','.join(values)}', ',')"


def _numbers(values: list, kind: str) -> str:
    return f"cast(split('{','.join(map(str, values))}', ',') as array<{kind}>)"


def _among(word: str, words: list[str]) -> str:
    some = "', '".join(sorted(set(words)))
    return f"{word} in ('{some}')" if words else "false"


def _pairs(words: str) -> str:
    return f"if(size({words}) > 1, array_distinct(transform(sequence(0, size({words}) - 2), i -> concat({words}[i], ' ', {words}[i + 1]))), cast(array() as array<string>))"


def _weighed(model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The grams with a weight, their weights as the scan rounds them, and those of every passage."""
    r = model.regression
    used = [g for g in r.vocabulary if np.abs(r.weight[r.at[g]]).max() > 0]
    return used, r.weight[[r.at[g] for g in used]].round(4), r.weight[-1].round(4)


def reaching(docs: DataFrame, model: Model) -> DataFrame:
    """_row, a struct of all columns of `docs`, n_paragraphs, and _p: the passages that may be notices, each with its
    line's number `k`, its `words` and the numbers `at` of its weighed grams."""
    used, rows, last = _weighed(model)
    slope, offset = model.is_license
    a = rows_whole(docs, F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text"))
    lines = "split(regexp_replace(_text, '[^\\\\p{L}\\\\p{N}\\n]+', ' '), '\\n', -1)"
    b = a.select("_row", F.expr(f"transform({lines}, (x, k) -> named_struct('k', k, 'words', split(trim(x), ' ', -1)))").alias("_lines"))
    # Passages from every STEP-th word, until one reaches the end of the line.
    cut = f"transform(sequence(0, greatest(0, (size(l.words) - {PASSAGE} + {STEP - 1}) div {STEP})), i -> named_struct('k', l.k, 'words', slice(l.words, i * {STEP} + 1, {PASSAGE})))"
    telling = "true" if "" in model.telling else f"exists(p.words, x -> {_among('x', model.telling)})"
    c = b.select("_row", F.expr("size(filter(_lines, l -> l.words[0] <> ''))").cast("long").alias("n_paragraphs"), F.expr(f"filter(flatten(transform(_lines, l -> {cut})), p -> {telling})").alias("_p"))
    # The numbers of the grams that the regression weighs; only neighbours that can be such a pair are put together.
    two = [g.split(" ") for g in used if " " in g]
    single = f"filter(p.words, x -> {_among('x', [g for g in used if ' ' not in g])})"
    double = f"filter(zip_with(p.words, slice(p.words, 2, {PASSAGE}), (x, y) -> if({_among('x', [x for x, _ in two])} and {_among('y', [y for _, y in two])}, concat(x, ' ', y), null)), x -> {_among('x', [' '.join(g) for g in two])})"
    present = f"array_sort(transform(array_distinct(concat({single}, {double})), g -> cast(array_position({_strings(used)}, g) as int) - 1))"
    d = c.select("_row", "n_paragraphs", F.expr(f"transform(_p, p -> named_struct('k', p.k, 'words', p.words, 'at', {present}))").alias("_p"))
    # If each gram counts as for the licence that gains most from it, no licence has more: what then stays short of 0.5 is no notice.
    gain = _numbers([f"{x:.4f}" for x in (rows[:, 1:] - rows[:, :1]).max(axis=1)], "double")
    start = float(np.logaddexp.reduce(last[1:] - last[0]))
    enough = f"aggregate(p.at, {start!r}D, (a, i) -> a + {gain}[i]) >= {-offset / slope - 1e-6!r}D" if slope > 0 else "true"
    return d.select("_row", "n_paragraphs", F.expr(f"filter(_p, p -> {enough})").alias("_p"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """`docs` with n_paragraphs (lines that aren't blank) and licenses, an array of (paragraph, license, family,
    confidence, known, similarity): the line's number from 0, the licence or `unknown`, its family, how likely it is a
    licence notice and how likely a known one, and the share of word pairs common with the nearest notice of the licence
    (unknown: of any). A line that holds several licences has an entry for each, by name, with its likeliest passage.

    A null or blank text has no paragraphs. Repeated rows are scanned each. Columns of `docs` named n_paragraphs or
    licenses are replaced; all others stay.
    """
    model = model or train(docs)
    own = [c for c in docs.columns if c not in ("n_paragraphs", "licenses")]
    _, rows, last = _weighed(model)
    n = len(last)
    weight, bias = (_numbers([f"{x:.4f}" for x in some.flat], "double") for some in (rows, last))
    (a1, b1), (a2, b2) = model.is_license, model.is_known
    d = reaching(docs.select(*[f"`{c}`" for c in own]), model)
    logits = f"aggregate(p.at, {bias}, (a, i) -> zip_with(a, slice({weight}, i * {n} + 1, {n}), (x, y) -> x + y))"
    e = d.select("_row", "n_paragraphs", F.expr(f"transform(_p, p -> named_struct('k', p.k, 'words', p.words, 'z', {logits}))").alias("_p"))
    f = e.select("_row", "n_paragraphs", F.expr(f"transform(_p, p -> named_struct('k', p.k, 'words', p.words, 'z0', p.z[0], 'z', slice(p.z, 2, {n - 1}), 'top', array_max(slice(p.z, 2, {n - 1}))))").alias("_p"))
    sigmoid = lambda x: f"1 / (1 + exp(-({x})))"
    odds = "p.top + ln(aggregate(p.z, 0D, (a, z) -> a + exp(z - p.top))) - p.z0"
    ahead = "p.top - array_sort(p.z)[size(p.z) - 2]" if n > 2 else "0D"
    likely = f"filter(transform(_p, p -> named_struct('k', p.k, 'words', p.words, 'z', p.z, 'top', p.top, 'p', {sigmoid(f'{a1!r}D * ({odds}) + {b1!r}D')})), p -> p.p >= 0.5)"
    g = f.select("_row", "n_paragraphs", F.expr(f"transform({likely}, p -> named_struct('k', p.k, 'pairs', {_pairs('p.words')}, 'c', cast(array_position(p.z, p.top) as int) - 1, 'p', p.p, 'q', {sigmoid(f'{a2!r}D * ({ahead}) + {b2!r}D')}))").alias("_p"))
    texts = [",".join(pairs(tokens(t))) for c in model.classes for t in model.templates[c]]
    first = [0]
    for c in model.classes:
        first.append(first[-1] + len(model.templates[c]))
    bounds, all_ = _numbers(first, "int"), f"array({', '.join(_strings([t]) for t in texts)})"
    notices = f"slice({all_}, {bounds}[p.c] + 1, {bounds}[p.c + 1] - {bounds}[p.c])"
    common = lambda t: f"size(array_intersect({t}, p.pairs))"
    confirmed = f"exists({notices}, t -> {common('t')} >= {CONFIRMED} * least(size(t), size(p.pairs)))"
    whole = f"exists({notices}, t -> {common('t')} = size(t))"
    h = g.select("_row", "n_paragraphs", F.expr(f"transform(_p, p -> named_struct('k', p.k, 'pairs', p.pairs, 'c', p.c, 'p', p.p, 'q', p.q, 'named', {whole} or p.q >= 0.5 and {confirmed}))").alias("_p"))
    near = f"array_max(transform(if(p.named, {notices}, {all_}), t -> {common('t')} / size(array_union(t, p.pairs))))"
    name = f"if(p.named, {_strings(model.classes)}[p.c], '{UNKNOWN}')"
    kind = f"if(p.named, {_strings([family(c) for c in model.classes])}[p.c], '{UNKNOWN}')"
    each = f"transform(_p, p -> named_struct('paragraph', p.k, 'license', {name}, 'family', {kind}, 'confidence', p.p, 'known', p.q, 'similarity', {near}))"
    # Of the passages of a line that say the same the likeliest stays; `unknown` stays if the line names nothing known.
    i = h.select("_row", "n_paragraphs", F.expr(each).alias("_f"))
    better = "y.paragraph = x.paragraph and (y.license = x.license and (y.confidence > x.confidence or y.confidence = x.confidence and j < i) or x.license = 'unknown' and y.license <> 'unknown')"
    best = f"filter(transform(_f, (x, i) -> if(exists(transform(_f, (y, j) -> {better}), b -> b), null, x)), x -> x is not null)"
    return i.select(*of_row(own), "n_paragraphs", F.expr(f"array_sort({best})").alias("licenses"))


def names(licenses: Column) -> Column:
    """The distinct licences, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(licenses, lambda x: x["license"]))), ",")


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    """The licence notices of all documents; a null or empty text has none, a repeated row is scanned each time."""
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["license"], F.round(x["confidence"], 4).cast("string"), F.round(x["similarity"], 4).cast("string"))), ",")
    return rows.select("doc_id", "n_paragraphs", F.size("licenses").cast("long").alias("n_notices"), names(F.col("licenses")).alias("licenses"), places.alias("places"))
