"""Licence scans: a trained paragraph classifier with classes for no and for unknown licences, confirmed by templates.

A paragraph ends at a blank line, or at a line that closes a sentence; lines wrapped inside a sentence belong together. Its
features are its distinct 1- to 3-grams of words, where paragraph and sentence ends and colons are words too. A multinomial logistic
regression with a sparse set of weights gives the probability of each licence family, of an unknown licence and of none.

The fit takes the fixed wordings below, runs on the driver once, and its bounds are constants. It keeps only n-grams that
hold an *anchor*, one of a few words that it chose so that every wording has one. A paragraph without an anchor therefore
has no feature, and the model says "no licence" whatever else stands there: passing such paragraphs over loses nothing.
Probabilities are calibrated on wordings that were left out of the fit, fold by fold. Scoring uses column functions only.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import table

NONE, UNKNOWN = "none", "unknown"
#: Probability that a family needs, and share of a template's word pairs that confirms it.
THRESHOLD, CONFIRM = 0.5, 0.8
#: Features that the fit keeps, those with the largest weights; anchors at most, and anchors that a wording has if it can;
#: folds of the calibration; steps of descent.
FEATURES, ANCHORS, HAS, FOLDS, STEPS = 600, 40, 2, 3, 80
END = "¶"

# Phrases that name a licence ...
FRAMES = (
    "Licensed under the {}.", "Released under the {}.", "This project is distributed under the terms of the {}.", "License: {}", "SPDX-License-Identifier: {}", "This work is licensed under {}.", "Code: {}", "{}", "The library is available under the {}.",
    "Published under {}", "All files are provided under the {}, see below.", "The data are covered by the {}.", "You may use this under the {}.", "Made available under {}.",
)
# ... names of licences ...
NAMES = {
    "Apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache Software License", "Apache-2.0", "Apache license"],
    "MIT": ["MIT License", "MIT", "MIT licence", "terms of the MIT license", "MIT License (MIT)", "MIT-style license"],
    "BSD": ["BSD license", "3-clause BSD license", "BSD 2-Clause License", "BSD-3-Clause", "new BSD licence", "BSD-2-Clause"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License version 2 or later", "GNU GPL", "GPL license", "GPLv3", "GPL-3.0-only", "GNU GPL v2", "GPLv2", "GPL"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License version 2.1", "LGPL license", "LGPLv3", "LGPL-2.1-or-later", "LGPL", "GNU LGPL 2.1"],
    "AGPL": ["GNU Affero General Public License, version 3", "GNU Affero General Public License", "AGPL license", "AGPLv3", "AGPL-3.0-only", "AGPL", "GNU AGPL"],
    "MPL": ["Mozilla Public License, version 2.0", "Mozilla Public License", "MPL 2.0 license", "MPL-2.0", "MPL"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC-BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "CC BY-NC-ND 4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC-BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License", "CC BY-SA"],
    "CC-BY": ["CC BY 4.0", "CC-BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons Attribution 3.0 Unported", "CC BY"],
    "CC0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero", "CC0 public domain dedication"],
    "unknown": ["Eclipse Public License 2.0", "zlib license", "ISC license", "Boost Software License, Version 1.0", "Open Software License", "Artistic License", "Academic Free License version 3.0", "EUPL-1.2", "terms below", "licence found in the root folder", "license agreement", "following license", "European Union Public Licence"],
}
# ... and texts of licences and notices.
TEXTS = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": ["You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "CC-BY-SA": ["Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."],
    "CC0": ["Released into the public domain.", "Dedicated to the public domain.", "This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "proprietary": [
        "All rights reserved.", "Copyright 2020 Example. All rights reserved.", "© 2019 The Company, all rights reserved.", "Proprietary and confidential.", "License: proprietary", "This software is proprietary.",
        "No part of this work may be reproduced without written permission of the publisher.", "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
    "unknown": ["License: see LICENSE file", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
}
# Sentences with the same words that name no licence.
ORDINARY = [
    "He lost his driving license on the way to the public library.", "The license of the bar was not renewed by the city.", "You need permission to enter the general ward.", "A warranty of three years comes with the machine.", "Seats that are reserved for guests stand on the left.",
    "The copyright debate went on in parliament.", "They redistributed the land among the general public.", "Her fishing licence is valid until version two of the rules.", "Permission to speak was granted to the person.", "All rights and duties of the members are listed here.",
    "The restaurant is under new terms and conditions.", "The Apache helicopter landed at the base.", "The MIT campus lies by the river.", "A creative commons room was opened at the school.", "The foundation published a free report.", "All rights reserved seats were sold out.",
    "This work is free.", "The software is distributed to schools.", "The warrant was issued on Monday.", "The source of the river is in the mountains.", "Attribution of the painting is not certain.", "The new version is under test.", "You need an international license to drive here.",
    "He studied at MIT before he joined the company.", "Students of MIT released a study under the guidance of the dean.", "A licensed doctor works at the public hospital.", "The Apache people live in the south.", "The Apache programme of the army was licensed to another firm.",
    "The public domain of the town ends at the bridge.", "All copies of the book were sold.", "The author has waived his fee.", "The bank reserved the money for the buyer.", "The GNU is an antelope of the general plains.", "He wrote to the Mozilla office about the public event.",
    "The licence to print money was revoked.", "A software company distributed free meals.", "The rights of the workers were reserved for a later debate.", "His license to kill expired in version one of the film.", "Please see the manual for the limitations of the machine.", "The city granted, free of charge, a place to any person.",
    "The library holds a copy of this software box.", "Conditions of use of the pool are posted at the door.", "The notice above the door was in all capital letters.", "Commercial fishing needs a licence from the ministry.", "The attribution of blame is a public sport.", "The committee released the film into the cinemas.",
    "A driver without a valid license was stopped.", "She holds a pilot license and a boat license.", "They were licensed to sell wine under the new law.", "The company licensed the patent to a rival.", "License plates of the cars were copied.", "The MIT team won the cup.", "No part of the wall may be painted.", "The terms of the general are hard.",
    "Copying from the neighbour is prohibited in the exam.", "The foundation of the house is free of water.", "It is strictly prohibited to smoke.", "The court reserved its judgment on all rights of way.", "Version 2.0 of the game was released.", "Chapter 3.0 of the report is under review.", "By and by the cc field of the mail was filled.",
    "Wir gehen heute mit.", "Kommst du mit?", "Er fuhr mit dem Zug und nahm das Kind mit.", "Mit der Zeit kam er mit.", "Das geht nur mit ihm: mit ihm allein.", "Sie brachte Brot mit; er aß mit.", "und mit. Mit und mit.", "Was ist mit der Lizenz?", "der die mit den und mit", "Sie sprach mit der Frau, mit dem Mann und mit uns.",
    "Mit. Und nicht mit. Mit!", "mit.", "Ja. Mit.", "Mit? Nur mit.", "Es ist. Mit. Wo.", "Elle a lu le mit.", "La licence de pêche coûte cher.", "Tiene licencia de conducir.", "Die Rechte der Frau sind alt.",
]

# Words that names of licences begin with, and what else they are said of.
BEGINNINGS = ("MIT", "Apache", "GNU", "Mozilla", "BSD", "Creative Commons", "public domain", "general public", "free software", "Eclipse", "proprietary", "zero")
OTHERS = ("{} building", "{} aircraft", "{} club", "{} office of the town", "{} street", "{} students", "old {} tribe")
ELSEWHERE = ("The plan was released under the {}.", "He was licensed under the {}.", "They met at the {}", "The food was distributed by the {}.", "A permission of the {} is needed.", "The {} was open to all.", "A book about the {} is available.")

WORD = r"\p{L}+|\p{N}+(?:\.\p{N}+)*|[.:;!?]+"
_CLOSED, _BLANK = r"([.:;!?])[ \t]*\r?\n", r"\n[ \t\r\n]*\n"


def _words(text: str) -> list[str]:
    found = re.findall(r"[^\W\d_]+|\d+(?:\.\d+)*|[.:;!?]+", text.lower())
    return [END, *(":" if ":" in w else END if re.fullmatch("[.;!?]+", w) else w for w in found), END]


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)}


def _wordings() -> list[tuple[str, int, int]]:
    """(wording, class, fold): frames with names, texts and ordinary sentences. A frame is of one fold with all its names."""
    out = [(s, 0, k % FOLDS) for k, s in enumerate(ORDINARY)]
    out += [(ELSEWHERE[(k + j) % len(ELSEWHERE)].format(other.format(n)), 0, (k + j) % len(ELSEWHERE) % FOLDS) for k, n in enumerate(BEGINNINGS) for j, other in enumerate(OTHERS)]
    for c, name in enumerate(_CLASSES[1:], 1):
        out += [(frame.format(n), c, k % FOLDS) for k, frame in enumerate(FRAMES) for n in NAMES.get(name, ()) if frame != "{}" or " " in n or "-" in n]
        out += [(s, c, k % FOLDS) for k, s in enumerate(TEXTS.get(name, ()))]
    return out


_CLASSES = [NONE, *sorted({*NAMES, *TEXTS})]


def _samples(wordings: list[tuple[str, int, int]]) -> list[tuple[list[str], int, int]]:
    """(words, class, fold): each wording whole and between other words."""
    out = []
    for k, (wording, c, fold) in enumerate(wordings):
        words, other = _words(wording), _words(ORDINARY[(7 * c + 3 * k) % len(ORDINARY)])
        out += [(words, c, fold), ([[*other[:6], *words[1:]], [*words[:-1], *other[-6:]], [*other[:-1], *words[1:-1], *other[2:]]][k % 3], c, fold)]
    return out


def choose_anchors() -> list[str]:
    """Few words so that every text of a licence has one and every name some, those first that ordinary sentences rarely have."""
    wanted = [(HAS, n) for own in NAMES.values() for n in own] + [(1, s) for own in TEXTS.values() for s in own]
    ordinary = [set(_words(s)) for s in ORDINARY]
    rare = {}
    for w in {w for _, s in wanted for w in _words(s) if w[0].isalpha() and len(w) > 1}:
        rare[w] = 1 / (1 + 2 * sum(w in o for o in ordinary)) / (4 if len(w) < 3 else 1)  # short ones are parts of many words
    found: list[str] = []
    for most in (1, HAS):
        left = [(min(n, most) - len(ws & set(found)), ws - set(found)) for n, ws in ((n, {w for w in _words(s) if w in rare}) for n, s in wanted)]
        while len(found) < ANCHORS and any(n > 0 and ws for n, ws in left):
            gain: dict[str, float] = {}
            for n, ws in left:
                for w in ws if n > 0 else ():
                    gain[w] = gain.get(w, 0) + rare[w] / len(ws) ** 0.5
            best = max(sorted(gain), key=gain.__getitem__)
            found.append(best)
            left = [(n - (best in ws), ws - {best}) for n, ws in left]
    return sorted(found)


def _descend(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by accelerated proximal gradient descent: weights that carry little become zero."""
    n = len(_CLASSES)
    goal, step, decay, sparse = np.eye(n, dtype=np.float32)[y], 1.5, 1e-4, 4e-5
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = (1 / np.sqrt(np.bincount(y, minlength=n)[y])).astype(np.float32)[:, None]  # small classes count more than their rows
    weight /= weight.sum()
    w = before = np.zeros((x.shape[1], n), np.float32)
    for k in range(steps):
        at = w + k / (k + 3) * (w - before)
        z = x @ at
        p = np.exp(z - z.max(axis=1, keepdims=True))
        e = (p / p.sum(axis=1, keepdims=True) - goal) * weight
        new = at - step * (x.T @ e + decay * at)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * sparse, 0)
        before, w = w, new
    return w[:-1], w[-1]


def _matrix(samples: list, names: list[str]) -> np.ndarray:
    place = {g: k for k, g in enumerate(names)}
    x = np.zeros((len(samples), len(names)), np.float32)
    for k, (words, *_) in enumerate(samples):
        x[k, [place[g] for g in grams(words) if g in place]] = 1
    return x


@functools.cache
def fit() -> tuple[list[str], list[str], dict[str, list[float]], list[float], dict[str, float]]:
    """Classes, anchors, weights by feature, biases, and precision and recall of families in frames left out."""
    wordings = _wordings()
    samples, found = _samples(wordings), choose_anchors()
    anchors = set(found)
    counts: dict[str, int] = {}
    for words, _, _ in samples:
        for g in grams(words):
            if not anchors.isdisjoint(g.split()):
                counts[g] = counts.get(g, 0) + 1
    vocabulary = sorted(g for g, n in counts.items() if n > 2)
    x, y, fold = _matrix(samples, vocabulary), np.array([c for _, c, _ in samples]), np.array([f for *_, f in samples])
    w, _ = _descend(x, y, STEPS // 2)
    kept = np.sort(np.argsort(-np.abs(w).max(axis=1), kind="stable")[:FEATURES])
    x = x[:, kept]
    out = np.zeros((len(samples), len(_CLASSES)))
    for f in range(FOLDS):
        w, b = _descend(x[fold != f], y[fold != f])
        out[fold == f] = x[fold == f] @ w + b

    def loss(t: float) -> float:
        s = out * t
        return float((np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) - s[np.arange(len(y)), y]).mean())

    t = min((2 ** (k / 4) for k in range(-12, 13)), key=loss)
    w, b = _descend(x, y)
    said, families = out.argmax(axis=1), [k for k, c in enumerate(_CLASSES) if c not in (NONE, UNKNOWN)]
    named, known = np.isin(said, families), np.isin(y, families)
    figures = {"precision": float((said == y)[named].mean()), "recall": float((said == y)[known].mean()), "temperature": t}
    weights = {vocabulary[k]: [round(float(v) * t, 6) for v in w[i]] for i, k in enumerate(kept.tolist()) if np.abs(w[i]).max() > 0}
    return _CLASSES, found, weights, [round(float(v) * t, 6) for v in b], figures


#: Frames by which a name confirms a prediction.
_CONFIRMING = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Available under the {}.", "Distributed under the terms of the {}.", "License: {}", "Identifier: {}", "{}", "Code: {}")


def template_pairs() -> dict[str, list[list[str]]]:
    """The distinct word pairs of each template of a family."""
    out = {}
    for family in sorted({*NAMES, *TEXTS} - {UNKNOWN}):
        templates = [f.format(n) for f in _CONFIRMING for n in NAMES.get(family, ())] + TEXTS.get(family, [])
        out[family] = [sorted({" ".join(w[k : k + 2]) for k in range(len(w) - 1)}) for w in map(_words, templates)]
    return out


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with columns that are computed once a row, however often later steps read them: no filter or projection
    is pushed through a generator, here of one element, so none repeats what it makes."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select("*", F.explode(F.array(made)).alias("__gl_once")).select(*[F.col(c) for c in rows.columns], *[F.col("__gl_once")[n].alias(n) for n in columns])


def paragraphs(docs: DataFrame, key: str, text: str, anchors: list[str]) -> DataFrame:
    """Paragraphs that hold an anchor: ``key``, ``paragraph`` (number from 0) and ``body`` (lower case)."""
    some = lambda c: functools.reduce(lambda a, b: a | b, [F.contains(c, F.lit(s)) for s in anchors])
    low = _once(docs.select(key, text), low=F.lower(F.col(text))).where(some(F.col("low")))
    closed = F.regexp_replace("low", _CLOSED, "$1\n\n")
    lines = low.select(key, F.posexplode(F.split(closed, _BLANK, -1)).alias("paragraph", "body"))
    return lines.where(some(F.col("body")))


def _plain(word: Column) -> Column:
    return F.when(word.contains(":"), ":").when(word.rlike("^[.;!?]"), END).otherwise(word)


def _around(words: Column, anchors: list[str]) -> Column:
    """The 1- to 3-grams that hold an anchor; where the text ends too soon for one, a shorter one that is there as well."""
    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*anchors), i)), lambda i: i.isNotNull())
    at = lambda i, k: _plain(F.get(words, i + k))
    own = lambda i: F.array(*[F.concat_ws(" ", *[at(i, k) for k in range(a, a + n)]) for n in (1, 2, 3) for a in range(1 - n, 1)])
    return F.flatten(F.transform(places, own))


def scan(docs: DataFrame, threshold: float = THRESHOLD, confirm: float = CONFIRM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per paragraph that more probably has a licence than none: ``key``, ``paragraph`` (number from 0), ``family``
    (``unknown`` below the threshold), ``probability`` (of the family, or of the likeliest one), ``coverage`` (largest share
    of the word pairs of one of the family's templates that the paragraph has) and ``confirmed``.

    Null and empty texts have no paragraphs; each row is judged alone, so repeated rows get equal results, and a null key is
    kept. Ties go to the family first in alphabetical order. Columns other than the key are left out; an empty table gives
    an empty result. Nothing is shuffled.
    """
    classes, anchors, weights, bias, _ = fit()
    fixed = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)  # noqa: E731 - a constant, read once for a plan
    model, templates = fixed(weights, "map<string,array<double>>"), fixed(template_pairs(), "map<string,array<array<string>>>")
    families = [c for c in classes if c not in (NONE, UNKNOWN)]
    rows = paragraphs(docs.select(F.col(key).alias(key), F.col(text).alias("__gl_text")), key, "__gl_text", anchors)
    own = F.regexp_extract_all("body", F.lit(f"({WORD})"), F.lit(1))
    rows = _once(rows.select(key, "paragraph", "body"), words=F.concat(F.array(F.lit(END)), own, F.array(F.lit(END)))).drop("body")
    features = F.array_intersect(_around(F.col("words"), anchors), fixed(list(weights), "array<string>"))
    logits = F.aggregate(F.transform(features, lambda g: F.element_at(model, g)), fixed(bias, "array<double>"), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    rows = _once(rows, logits=logits)
    rows = _once(rows, top=F.array_max("logits"))
    rows = _once(rows, odds=F.transform("logits", lambda z: F.exp(z - F.col("top"))))
    rows = _once(rows.drop("logits", "top"), total=F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)).where(F.get("odds", F.lit(0)) < F.col("total") * 0.5)
    rows = _once(rows.withColumn("words", F.transform("words", _plain)), pairs=F.array_distinct(F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda x, y: F.concat_ws(" ", x, y)))).drop("words")
    rows = _once(rows, named=F.array(*[F.get("odds", F.lit(classes.index(c))) for c in families]))
    best = F.array_position("named", F.array_max("named")).cast("int")
    rows = _once(rows.drop("odds"), probability=F.array_max("named") / F.col("total"), name=F.element_at(fixed(families, "array<string>"), best))
    share = F.transform(F.element_at(templates, F.col("name")), lambda own: F.size(F.array_intersect("pairs", own)) / F.size(own))
    rows = _once(rows, coverage=F.array_max(share), family=F.when(F.col("probability") >= threshold, F.col("name")).otherwise(UNKNOWN))
    return rows.select(key, "paragraph", "family", "probability", "coverage", ((F.col("family") != UNKNOWN) & (F.col("coverage") >= confirm)).alias("confirmed"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select("doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"), F.round("coverage", 6).alias("coverage"), "confirmed")


def oracle() -> str:
    classes, anchors, weights, bias, _ = fit()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(g)}, {k}, {v!r}::DOUBLE)" for g, w in weights.items() for k, v in enumerate(w))
    biases = ", ".join(f"({k}, {quote(c)}, {b!r}::DOUBLE)" for k, (c, b) in enumerate(zip(classes, bias, strict=True)))
    pairs = ", ".join(f"({quote(name)}, {n}, {quote(p)}, {len(own)})" for name, lists in template_pairs().items() for n, own in enumerate(lists) for p in own)
    return f"""
WITH model(g, k, w) AS (VALUES {rows}), classes(k, name, b) AS (VALUES {biases}), templates(name, n, pair, size) AS (VALUES {pairs}),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS paragraph, unnest(ls) AS body FROM (
  SELECT doc_id, string_split_regex(regexp_replace(lower(text), '([.:;!?])[ \\t]*\\r?\\n', '\\1' || chr(10) || chr(10), 'g'), '\\n[ \\t\\r\\n]*\\n') AS ls FROM documents)),
own AS (SELECT doc_id, paragraph, list_prepend('{END}', list_append(list_transform(regexp_extract_all(body, '{WORD}'), lambda w: CASE WHEN contains(w, ':') THEN ':' WHEN regexp_matches(w, '^[.;!?]') THEN '{END}' ELSE w END), '{END}')) AS ws
  FROM lines WHERE {' OR '.join(f"contains(body, {quote(a)})" for a in anchors)}),
gram AS (
  SELECT DISTINCT doc_id, paragraph, n, g FROM (
    SELECT doc_id, paragraph, 1 AS n, unnest(ws) AS g FROM own
    UNION ALL SELECT doc_id, paragraph, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))) FROM own
    UNION ALL SELECT doc_id, paragraph, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) FROM own)
), sums AS (
  SELECT doc_id, paragraph, k, sum(w) AS s FROM gram JOIN model USING (g) GROUP BY ALL
), score AS (
  SELECT own.doc_id, own.paragraph, c.k, c.name, c.b + coalesce(s, 0) AS z FROM own CROSS JOIN classes c LEFT JOIN sums ON sums.doc_id = own.doc_id AND sums.paragraph = own.paragraph AND sums.k = c.k
), p AS (
  SELECT doc_id, paragraph, k, name, exp(z - max(z) OVER w) / sum(exp(z - m)) OVER w AS p FROM (SELECT *, max(z) OVER (PARTITION BY doc_id, paragraph) AS m FROM score) WINDOW w AS (PARTITION BY doc_id, paragraph)
), best AS (
  SELECT * FROM p WHERE name NOT IN ('{NONE}', '{UNKNOWN}') QUALIFY row_number() OVER (PARTITION BY doc_id, paragraph ORDER BY p DESC, k) = 1
), told AS (
  SELECT best.* FROM best JOIN p none ON none.doc_id = best.doc_id AND none.paragraph = best.paragraph AND none.name = '{NONE}' WHERE none.p < 0.5
), cover AS (
  SELECT told.doc_id, told.paragraph, t.n, count(gram.g) / any_value(t.size) AS share
  FROM told JOIN templates t ON t.name = told.name LEFT JOIN gram ON gram.doc_id = told.doc_id AND gram.paragraph = told.paragraph AND gram.n = 2 AND gram.g = t.pair
  GROUP BY ALL
)
SELECT doc_id, CAST(paragraph AS INTEGER) AS paragraph, CASE WHEN any_value(p) >= {THRESHOLD} THEN any_value(name) ELSE '{UNKNOWN}' END AS family,
  round(any_value(p), 6) AS probability, round(max(share), 6) AS coverage, any_value(p) >= {THRESHOLD} AND max(share) >= {CONFIRM} AS confirmed
FROM told JOIN cover USING (doc_id, paragraph) GROUP BY doc_id, paragraph
"""


QUERIES = {"op3_licences": op3_licences}
ORACLES = {"op3_licences": oracle}
