"""Licence scans: a trained paragraph classifier over sparse word n-grams, with
a calibrated unknown class and a comparison with templates."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdscope.llm.common import WordHasher, annotate, hash_below, mix64, row_slices, ship, text_column

# Usual notices of each licence family.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
                   "This project is licensed under the Apache License 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Licensed under the BSD 3-Clause License.", "Released under the BSD 2-Clause License."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
              "Released under CC BY 3.0."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
            "This work is dedicated to the public domain."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
            "Licensed under the GNU GPL v3.", "Licensed under the GNU General Public License, version 2."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "Licensed under the GNU LGPL v3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License 2.0."],
    "proprietary": ["All rights reserved.", "Copyright 2020 by the authors. All rights reserved.",
                    "No part of this publication may be reproduced without the prior written permission of the publisher."],
}
# Licence talk of no known family.
UNKNOWN = ["Licensed under the terms of the {} License, version {}.", "Released under the {} Public License.",
           "This work is licensed under {} terms.", "Use of this material is governed by the {} agreement.",
           "You may copy and distribute this under the conditions of the {} licence."]

#: Hashed features; every paragraph's words and pairs of words.
FEATURES = 1 << 16
#: Ordinary paragraphs of the corpus that training sees, chosen by a hash.
NONE_ROWS = 3000
#: Characters at most, from a hashed place, of an ordinary line that the training sample takes.
NONE_CHARS = 2000
COPIES, EPOCHS = 30, 6
#: A family needs this calibrated probability, and this share of the words of a template in common.
SURE, LIKE = 0.6, 0.6
# Words of which a notice of no known family holds one.
TALK = "license licence licenses licences licensed licensing copyright copyrighted copyrights reserved".split()
#: Most neighbouring lines that are read as one at first; a longer run is also read as a whole, and a
#: notice found goes on over further lines of its run as long as they hold more of its template.
JOINED = 8

RESULT = T.StructType([
    T.StructField("n_paragraphs", T.LongType()), T.StructField("families", T.ArrayType(T.StringType())),
    T.StructField("notices", T.ArrayType(T.StructType([
        T.StructField("paragraph", T.LongType()), T.StructField("family", T.StringType()),
        T.StructField("probability", T.DoubleType()), T.StructField("template_share", T.DoubleType()),
        T.StructField("n_lines", T.LongType())])))])


def paragraph_offsets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows, and the first line of each row (one entry more)."""
    feeds = np.flatnonzero(raw == 10) + 1
    cuts = np.unique(np.concatenate([offsets, feeds]))
    return cuts, np.searchsorted(cuts, offsets)


def features(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words and of pairs of neighbours in a row, and each feature's row."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    mask = np.uint64(FEATURES - 1)
    if len(words) < 2:
        return (words & mask).astype(np.int64), row
    pair = mix64(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])
    same = row[:-1] == row[1:]
    return (np.concatenate([words, pair[same]]) & mask).astype(np.int64), np.concatenate([row, row[:-1][same]])


@dataclass
class Classifier:
    """Multinomial logistic regression; a row's scores are its features' mean
    weights times the root of their number. Class 0 is ordinary text, class 1
    licence talk of no known family."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    heat: float = 1.0

    def totals(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Sums of the weights of each row's features."""
        total = np.zeros((n, len(self.names)))
        if len(feature):
            order = np.argsort(row, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(row[order]) > 0])
            total[row[order][starts]] = np.add.reduceat(self.weights[feature[order]], starts, axis=0)
        return total

    def probabilities(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        return self.shares(self.totals(feature, row, n), np.bincount(row, minlength=n))

    def shares(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        s = (total / np.sqrt(np.maximum(count, 1))[:, None] + self.bias) / self.heat
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def joined_lines(words: np.ndarray, rows: np.ndarray, first: np.ndarray, model: Classifier
                 ) -> tuple[np.ndarray, list[tuple[np.ndarray, int, np.ndarray]]]:
    """The run of every line (neighbouring lines of a row, none wordless), and
    the probabilities of lines read together: (first lines, number of lines,
    probabilities) of all stretches of 2 to JOINED lines and of longer runs.

    A stretch's weights are the sums of its lines' and of the pairs over their ends."""
    n, count = len(rows) - 1, np.diff(rows)
    met = (count[:-1] > 0) & (count[1:] > 0)
    met[first[(first > 0) & (first < n)] - 1] = False
    run = np.concatenate([[0], np.cumsum(~met)])
    at = np.flatnonzero(met)
    feature, row = features(words, rows)
    last = rows[at + 1] - 1
    pair = mix64(words[last] * np.uint64(0xD6E8FEB86659FD93) + words[last + 1]) & np.uint64(FEATURES - 1)
    total, ends = model.totals(feature, row, n), np.zeros((n, len(model.names)))
    ends[at] = model.weights[pair.astype(np.int64)]
    summed = lambda x: np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=float)])
    total, ends = summed(total), summed(ends)
    number, pairs = summed(np.bincount(row, minlength=n)), summed(np.bincount(at, minlength=n))

    def read(start: np.ndarray, size) -> np.ndarray:
        return model.shares(total[start + size] - total[start] + ends[start + size - 1] - ends[start],
                            number[start + size] - number[start] + pairs[start + size - 1] - pairs[start])

    out = []
    for size in range(2, min(JOINED, n) + 1):
        start = np.flatnonzero(run[size - 1:] == run[:n - size + 1])
        if len(start):
            out.append((start, size, read(start, size)))
    begin = np.flatnonzero(np.r_[True, ~met])
    size = np.diff(np.r_[begin, n])
    for k in np.flatnonzero(size > JOINED):
        out.append((begin[k:k + 1], int(size[k]), read(begin[k:k + 1], int(size[k]))))
    return run, out


def hash_lines(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [x.encode() for x in lines]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    words, rows, _, _ = WordHasher()(np.frombuffer(b"".join(data), np.uint8), offsets)
    return words, rows


def train(ordinary: list[str], seed: int = 11) -> Classifier:
    """Fit to varied templates, made-up licences and ordinary lines; a tenth is
    held out to calibrate the probabilities by one temperature."""
    rng = np.random.default_rng(seed)
    pool = np.array([w for line in ordinary for w in line.split()] or ["text"], object)
    names = ["none", "unknown", *TEMPLATES]
    lines, label = list(ordinary), [0] * len(ordinary)

    def vary(line: str, drop: float) -> str:
        words = [w for w in line.split() if rng.random() >= drop] or line.split()
        extra = list(rng.choice(pool, rng.integers(0, 5)))
        return " ".join([*extra, *words] if rng.random() < 0.5 else [*words, *extra])

    for k, family in enumerate(names[2:], 2):
        for template in TEMPLATES[family]:
            made = [template, *(vary(template, 0.08 if len(template) > 60 else 0.0) for _ in range(COPIES))]
            lines += made
            label += [k] * len(made)
    for line in UNKNOWN:
        for _ in range(4 * COPIES):
            lines.append(vary(line.format(" ".join(rng.choice(pool, rng.integers(1, 3))), rng.integers(1, 9)), 0.0))
            label.append(1)
    for line in ordinary:  # few ordinary lines are as short as a notice
        words = line.split()
        at = int(rng.integers(0, max(1, len(words))))
        lines.append(" ".join(words[at:at + int(rng.integers(1, 13))]))
        label.append(0)
    y, order = np.array(label), rng.permutation(len(lines))
    feature, row = features(*hash_lines(lines))
    by_line = np.argsort(row, kind="stable")
    feature, bounds = feature[by_line], np.searchsorted(row[by_line], np.arange(len(lines) + 1))

    def taken(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of some of the lines, and the place of each one's line among them."""
        sizes = bounds[which + 1] - bounds[which]
        at = np.arange(sizes.sum()) + np.repeat(bounds[which] - np.cumsum(sizes) + sizes, sizes)
        return feature[at], np.repeat(np.arange(len(which)), sizes)

    held, learn = order[:len(order) // 10], order[len(order) // 10:]
    model = Classifier(names, np.zeros((FEATURES, len(names)), np.float32), np.zeros(len(names)))
    squares = np.full((FEATURES, len(names)), 1e-6, np.float32)
    for epoch in range(EPOCHS):
        rng.shuffle(learn)
        for lo in range(0, len(learn), 64):
            part = learn[lo:lo + 64]
            own_feature, own_row = taken(part)
            error = model.probabilities(own_feature, own_row, len(part))
            error[np.arange(len(part)), y[part]] -= 1
            scale = 1 / np.sqrt(np.maximum(np.bincount(own_row, minlength=len(part)), 1))
            if len(own_feature):
                by_feature = np.argsort(own_feature, kind="stable")
                own, starts = np.unique(own_feature[by_feature], return_index=True)
                grad = np.add.reduceat((error * scale[:, None])[own_row[by_feature]], starts, axis=0)
                grad += 1e-3 * model.weights[own]
                squares[own] += grad ** 2
                model.weights[own] -= (0.3 * grad / np.sqrt(squares[own])).astype(np.float32)
            model.bias -= 0.01 * error.mean(axis=0)
    held_feature, held_row = taken(held)
    best = (np.inf, 1.0)
    for heat in np.geomspace(0.25, 4, 17):
        model.heat = float(heat)
        p = model.probabilities(held_feature, held_row, len(held))[np.arange(len(held)), y[held]]
        best = min(best, (float(-np.log(np.maximum(p, 1e-12)).mean()), float(heat)))
    model.heat = best[1]
    return model


def fit(docs: DataFrame, rows: int = NONE_ROWS) -> Classifier:
    """Train with about ``rows`` ordinary lines of the corpus: one line at a
    hashed place of each hashed document, leaving out any that speaks of licences."""
    text = text_column(docs)
    n = docs.count()
    lines = F.split(text, "\n")
    line = F.element_at(lines, (F.pmod(F.xxhash64("doc_id", F.lit("line")), F.size(lines)) + 1).cast("int"))
    chosen = docs.where(text.isNotNull() & hash_below(F.col("doc_id"), "none", rows, n)).select(line.alias("line"))
    place = F.pmod(F.xxhash64("line"), F.greatest(F.length("line") - NONE_CHARS + 1, F.lit(1)))
    chosen = chosen.select(F.substring("line", (place + 1).cast("int"), F.lit(NONE_CHARS)).alias("line"))
    talk = F.lower("line").rlike("licen[sc]e|copyright|rights reserved|public domain|creative commons")
    return train(sorted(r.line for r in chosen.where((F.length("line") > 0) & ~talk).collect()))


def scan(docs: DataFrame, model: Classifier, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """Classify every paragraph (line) of every whole text, and neighbouring
    lines read as one: a struct of ``n_paragraphs`` (lines with a word),
    ``families`` (sorted, distinct) and ``notices`` (number of the first line
    from 0, family, probability, share of the best template's words found,
    number of lines).

    A line, or else a stretch of lines without a wordless one between, is a
    notice of a family if the classifier is sure and a template confirms it;
    of overlapping stretches the one that holds most of a template counts.
    Outside such notices, what is surely a licence by the classifier, holds a
    word of TALK and is not the rest of a family found in the text, or is taken
    for a licence and holds enough of any licence talk, is ``unknown``.

    Defined cases: a null, empty or wordless text has no paragraph and no
    notice; equal paragraphs are notices of their own; repeated rows are
    scanned alike; an empty table gives no rows; other columns, also of
    clashing names, are carried as they are. Returns the frame and the
    struct's name.
    """
    shared = ship(docs.sparkSession, model)

    def make():
        m: Classifier = pickle.loads(shared.value)
        hasher = WordHasher()
        templates = {}
        for family, lines in TEMPLATES.items():
            words, rows = hash_lines(lines)
            templates[family] = [set(words[rows[k]:rows[k + 1]].tolist()) for k in range(len(lines))]
        words, rows = hash_lines([x.replace("{}", " ") for x in UNKNOWN])
        talk = [set(words[rows[k]:rows[k + 1]].tolist()) for k in range(len(UNKNOWN))]
        spoken = set(hash_lines(TALK)[0].tolist())
        talk += [t for sets in templates.values() for t in sets]

        def step(raw, offsets, nulls, batch):
            n = len(offsets) - 1
            notices, n_lines = [[] for _ in range(n)], np.zeros(n, np.int64)
            for i, j in row_slices(offsets):
                part, own = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                cuts, first = paragraph_offsets(part, own)
                words, rows, _, _ = hasher(part, cuts)
                count = np.diff(rows)
                n_lines[i:j] = np.diff(np.concatenate([[0], np.cumsum(count > 0)])[first])
                p = m.probabilities(*features(words, rows), len(rows) - 1)
                run, joined = joined_lines(words, rows, first, m)

                def like(line, size, sets):
                    have = set(words[rows[line]:rows[line + size]].tolist())
                    return max(len(have & t) / len(t) for t in sets)

                taken, whole, found = np.zeros(len(count), bool), set(), []
                loose = []  # lines that no template confirms
                for line in np.flatnonzero((p.argmax(axis=1) > 0) & (count > 0)):
                    best = int(p[line].argmax())
                    share = like(line, 1, templates[m.names[best]]) if best > 1 and p[line, best] >= SURE else 0.0
                    if share >= LIKE:
                        found.append((line, 1, m.names[best], p[line, best], share))
                        taken[line] = True
                    else:
                        loose.append((line, 1, best, p[line, best], 1 - p[line, 0]))
                sure = []
                for start, size, q in joined:
                    best = q.argmax(axis=1)
                    high = q[np.arange(len(best)), best]
                    for k in np.flatnonzero((best > 0) & (high >= SURE)):
                        line = int(start[k])
                        if taken[line:line + size].any():
                            continue
                        share = like(line, size, templates[m.names[best[k]]]) if best[k] > 1 else 0.0
                        if share >= LIKE:
                            sure.append((-share, size, line, m.names[best[k]], high[k]))
                        elif best[k] == 1:
                            loose.append((line, size, 1, high[k], high[k]))
                for share, size, line, family, high in sorted(sure):
                    if not taken[line:line + size].any():
                        # a notice may go on beyond the lines read together
                        share, grown = -share, True
                        while grown:
                            grown = False
                            for before, after in [(b, a) for n_more in (1, 2, 3) for b, a in ((0, n_more), (n_more, 0))]:
                                lo, hi = line - before, line + size + after
                                if lo < 0 or hi > len(run) or (run[lo:hi] != run[line]).any() or taken[lo:hi].any():
                                    continue
                                more = like(lo, hi - lo, templates[family])
                                if more > share:
                                    line, size, share, grown = lo, hi - lo, more, True
                                    break
                        found.append((line, size, family, high, share))
                        taken[line:line + size] = True
                        whole.add(int(run[line]))
                in_row = lambda line: int(np.searchsorted(first, line, side="right")) - 1
                known = {(in_row(x[0]), x[2]) for x in found}
                for line, size, best, high, licence in loose:
                    if taken[line:line + size].any() or int(run[line]) in whole:
                        continue  # the rest of a notice's paragraph
                    share = like(line, size, talk)
                    speaks = licence >= SURE and not spoken.isdisjoint(words[rows[line]:rows[line + size]].tolist())
                    if share >= LIKE or (speaks and (in_row(line), m.names[best]) not in known):
                        found.append((line, size, "unknown", high, share))
                        taken[line:line + size] = True
                for line, size, family, high, share in sorted(found):
                    row = in_row(line)
                    notices[i + row].append({"paragraph": int(line - first[row]), "family": family, "probability": float(high),
                                             "template_share": float(share), "n_lines": int(size)})
            kind = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()),
                              ("template_share", pa.float64()), ("n_lines", pa.int64())])
            families = [sorted({x["family"] for x in row}) for row in notices]
            return [pa.array(n_lines), pa.array(families, pa.list_(pa.string())), pa.array(notices, pa.list_(kind))]

        return step

    return annotate(docs, "licences", RESULT, make, keep)
