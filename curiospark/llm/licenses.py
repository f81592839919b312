"""License scans: a trained paragraph classifier, by DataFrame functions alone.

Paragraphs are lines; a notice may be wrapped over up to ``SPAN`` lines without a blank one between them, and counts as one then, at its
first line. Features are words and word pairs of the license notices and wordings below; a sparse multinomial
logistic regression over them, fitted on the driver from these, variations of them and near misses, gives each
paragraph's family. The unknown class is calibrated: a family counts only where its probability exceeds the highest one
that any near miss got when it was left out of the fit, plus a margin. Such a prediction is confirmed by comparison with the family's
templates: enough of one notice's word pairs must be in the paragraph. At any probability, the likeliest family counts if the paragraph
declares it by one of its names: after a verb of licensing, as an SPDX id, after "License", or as a title. A paragraph with fewer than two
words of the vocabulary is left unknown beforehand, as its score could only be. A paragraph gets one family.

Every text is handled within its own row, by functions over arrays: nothing is exploded or shuffled, and the
expression's size depends on the notices only.

Defined cases: null and empty texts have no paragraphs and no families; lines without words aren't paragraphs;
rows with equal ids are scanned each on its own; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Short notices by which licenses are declared, by family.
NOTICES: dict[str, tuple[str, ...]] = {
    "agpl": ("Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"),
    "apache": ("Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License", "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Use of this source code is governed by a BSD-style license", "Redistribution and use in source and binary forms, with or without modification, are permitted", "Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "cc0": ("Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights", "SPDX-License-Identifier: CC0-1.0"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3", "You can redistribute it and/or modify it under the terms of the GNU General Public License", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"),
    "mit": ("Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "SPDX-License-Identifier: MIT"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "proprietary": ("All rights reserved", "Proprietary and confidential, unauthorized copying of this file is strictly prohibited"),
}
#: Lines that share words with notices and declare nothing.
NEAR_MISSES = (
    "She renewed her driving license at the public office in version two of the form",
    "The general public was not permitted to copy the source",
    "The Apache helicopter landed under heavy rain", "He studied at MIT and released a record", "A common creative work by the author",
    "The license plate was under the car", "Software is written in source code and shipped in binary form", "All students reserved a seat",
    "The rights of the person were related to the law", "Free of charge to the public", "GNU is an antelope", "The work is subject to the terms of trade",
    "Version 3 of the document was published", "The file is licensed to nobody in particular", "See the license for details", "Copyright law is general and public",
    "The Mozilla foundation met in public", "The terms of the agreement are confidential", "International attribution of the painting was disputed",
)
#: Names by which wordings declare a family, for the fit, and the same over words as a pattern.
NAMES: dict[str, tuple[tuple[str, ...], str]] = {
    "agpl": (("GNU Affero General Public License", "AGPL version 3", "AGPLv3", "AGPL-3.0-or-later"), r"(?:gnu )?(?:affero (?:general public licen[cs]e|gpl)|agpl(?:v?\d)?)"),
    "apache": (("Apache License", "Apache Software License", "Apache 2.0 license", "Apache-2.0"), r"apache (?:(?:software |public )?licen[cs]e|v?\d)"),
    "bsd": (("BSD License", "BSD-style license", "BSD 2-Clause License", "3-Clause BSD License", "BSD-2-Clause", "New BSD License"), r"(?:bsd (?:style |type |\d clause )?licen[cs]e|bsd \d clause|\d clause bsd|0bsd)"),
    "cc-by": (("CC BY 3.0", "CC-BY-4.0", "Creative Commons Attribution License"), r"(?:cc by|creative commons attribution)(?! (?:\d \d )?(?:nc|nd|sa|non ?commercial|share ?alike|no ?deriv))"),
    "cc-by-nc": (("CC BY-NC 3.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial License", "Creative Commons Attribution Non Commercial"), r"(?:cc by nc|creative commons attribution non ?commercial)(?! (?:nd|sa|share ?alike|no ?deriv))"),
    "cc-by-sa": (("CC BY-SA 3.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution Share Alike"), r"(?:cc by sa|creative commons attribution share ?alike)"),
    "cc0": (("CC0", "CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero"), r"(?:cc0|cc zero|creative commons (?:cc0|zero))"),
    "gpl": (("GNU General Public License", "GNU GPL", "GPL version 2", "GPLv2", "GPLv3", "GPL-2.0-only"), r"(?:gnu )?(?<!affero )(?<!lesser )(?<!library )(?:general public licen[cs]e|gpl(?:v?\d)?)"),
    "lgpl": (("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL version 2.1", "LGPLv3", "LGPL-2.1-or-later"), r"(?:gnu )?(?:(?:lesser|library) (?:general public licen[cs]e|gpl)|lgpl(?:v?\d)?)"),
    "mit": (("MIT License", "MIT", "Expat License", "MIT-style license"), r"(?:mit|expat)(?: style)?(?: licen[cs]e)?(?! 0)"),
    "mpl": (("Mozilla Public License", "MPL 2.0", "MPL-1.1", "MPLv2"), r"(?:mozilla public licen[cs]e|mpl ?v?\d)"),
}
#: Wordings around a name, for the fit.
WORDINGS = (
    "Licensed under the {}", "Released under {}", "This file is distributed under the terms of the {}", "This software is available under the {}, version 2", "The code is published under the {}, version 3",
    "License: {}", "SPDX-License-Identifier: {}", "The {}", "You may redistribute it under the {}", "Its use is governed by the {}", "Subject to the terms and conditions of the {}",
)
_VERB = r"(?<!not )(?<!longer )\b(?:(?:re)?licen[cs]ed|released|distributed|available|published|provided|offered|shared|covered|governed|made|used?|copy|redistributed?|modify|subject)(?: it| them)?(?: only| solely)? (?:under|by|to|with)"
_BEFORE = r"(?: the| a| an)?(?: (?:terms|conditions|terms and conditions|provisions) of(?: the| a| an)?)?(?: (?:version|v) ?\d+(?: \d+)? of(?: the)?)?(?: (?!not )\w+){0,2} "
_AFTER = r"(?: licen[cs]e)?(?: (?:international|unported|universal))?(?: (?:version |v ?)?\d+(?: \d+)?)?(?: licen[cs]e| international(?: public)?(?: licen[cs]e)?| universal| mit)?(?: (?:\d+ )?[a-z]+ \d{4})?"
#: By family: a declaration over the words of a paragraph, with single spaces.
DECLARES = {c: rf"{_VERB}{_BEFORE}{x}\b|\bspdx licen[cs]e identifier {x}\b|^licen[cs]es? (?:the )?{x}\b|^(?:the )?(?:new |modified |simplified )?{x}{_AFTER}$" for c, (_, x) in NAMES.items()}
DECLARES["proprietary"] = r"\ball rights (?:are )?reserved\b|\b(?:proprietary and confidential|confidential and proprietary)\b|\bunauthori[sz]ed (?:copying|use|reproduction|distribution)\b.* (?:is|are) (?:strictly )?(?:prohibited|forbidden)\b|\bno part of this \w+ may be (?:reproduced|copied|distributed)\b"
#: Creative Commons licenses of no family here.
OTHER = r"\b(?:cc by|creative commons attribution) (?:(?:nc|non ?commercial) )?(?:nd|no ?deriv)|\b(?:cc by|creative commons attribution) (?:nc|non ?commercial) (?:sa|share ?alike)"
OWNED = ("Proprietary and confidential", "This source is confidential and proprietary", "Unauthorised copying is prohibited", "Unauthorized use or distribution of this software is strictly forbidden", "All rights are reserved", "No part of this work may be reproduced", "No part of this publication may be copied or distributed")
#: Lines that a notice may be wrapped over, and words that no template exceeds.
SPAN, REACH = 3, 24
#: Words of notices that are common elsewhere: a wrapped notice has others, too.
COMMON = frozenset("or under with without out no part can has by work file form forms free terms text law version code its will have 0 1 2 3 4".split())
STOP = frozenset("a an and any are as at be by for from in is it not of on or she he the to was were with this that all her may you use".split())
UNKNOWN = "unknown"
CONTAINED = 0.8
WORD = "[^a-z0-9]+"


def words_of(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def grams_of(words: list[str]) -> list[str]:
    return [w for w in words if w not in STOP] + [f"{a} {b}" for a, b in zip(words, words[1:]) if not (a in STOP and b in STOP)]


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:])] or words


def examples() -> list[tuple[str, str]]:
    """(family, text): notices, bare and in common surroundings, and near misses."""
    out = []
    for family, notices in NOTICES.items():
        for x in notices:
            out += [(family, x), (family, f"This file: {x}. See the LICENSE file."), (family, f"Copyright the authors. {x}"), (family, f"{x}; other text follows here in the same line")]
    out += [(family, wording.format(name)) for family, (names, _) in NAMES.items() for name in names for wording in WORDINGS] + [("proprietary", x) for x in OWNED]
    return out + [(UNKNOWN, x) for x in NEAR_MISSES] + [(UNKNOWN, f"{a}. {b}") for a, b in zip(NEAR_MISSES, NEAR_MISSES[1:])]


class Model:
    """Classes, vocabulary, weights (class, gram), biases and the least probability of a family."""

    def __init__(self):
        rows = examples()
        self.classes = [*NOTICES, UNKNOWN]
        texts = [n for x in NOTICES.values() for n in x] + [n for x, _ in NAMES.values() for n in x] + [w.format("") for w in WORDINGS] + list(OWNED)
        self.vocabulary = sorted({g for n in texts for g in grams_of(words_of(n))})
        self.words = sorted({w for n in texts for w in words_of(n) if w not in STOP})
        place = {g: k for k, g in enumerate(self.vocabulary)}
        x = np.zeros((len(rows), len(place)))
        for k, (_, text) in enumerate(rows):
            for g in set(grams_of(words_of(text))) & place.keys():
                x[k, place[g]] = 1
        y = np.array([self.classes.index(c) for c, _ in rows])
        self.weights, self.bias = self.fit(x, y)
        self.weights = np.round(self.weights, 4)
        self.bias = np.round(self.bias, 4)
        misses = np.flatnonzero(y == len(self.classes) - 1)
        worst = 0.0
        for part in range(4):  # misses that a fit has not seen
            out = misses[part::4]
            rest = np.setdiff1d(np.arange(len(y)), out)
            p = self.probabilities(x[out], *self.fit(x[rest], y[rest]))
            worst = max(worst, float(p[:, :-1].max()))
        self.least = round(min(0.9, max(0.5, worst + 0.05)), 4)

    @staticmethod
    def probabilities(x: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        s = x @ weights.T + bias
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 2.0, ridge: float = 1e-3, sparse: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
        """Proximal gradient steps; the soft threshold leaves most weights at zero."""
        weights, bias, one = np.zeros((len(self.classes), x.shape[1])), np.zeros(len(self.classes)), np.eye(len(self.classes))[y]
        for _ in range(steps):
            d = (self.probabilities(x, weights, bias) - one) / len(y)
            weights -= rate * (d.T @ x + ridge * weights)
            weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparse, 0)
            bias -= rate * d.sum(axis=0)
        return weights, bias


@functools.lru_cache(maxsize=1)
def model() -> Model:
    return Model()


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def scan(docs: DataFrame) -> DataFrame:
    """Adds n_paragraphs and findings: array of (paragraph, text, family, probability) of the paragraphs that could be notices."""
    m = model()
    vocabulary, classes = _list(m.vocabulary), _list(m.classes)
    weights = F.from_json(F.lit(json.dumps(m.weights.T.tolist())), "array<array<double>>")
    templates = F.create_map(*[x for c, notices in NOTICES.items() for x in (F.lit(c), F.array(*[_list(pairs_of(words_of(n))) for n in notices]))])
    known, grams = set(m.words), m.vocabulary

    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    # "lines" is the number of lines that a part is made of.
    numbered = F.transform(lines, lambda t, k: F.struct(k.alias("paragraph"), F.lit(1).alias("lines"), t.alias("text"), F.filter(F.split(F.lower(t), WORD), lambda w: w != "").alias("words")))
    step = docs.withColumn("_lines", numbered).withColumn("n_paragraphs", F.size(F.filter("_lines", lambda p: F.size(p["words"]) > 0)).cast("long"))
    familiar = lambda words: F.filter(words, lambda w: w.isin(known))
    telling = lambda words: F.exists(words, lambda w: w.isin(known - COMMON))
    last = lambda words: F.slice(words, F.greatest(F.size(words) - REACH + 1, F.lit(1)), REACH)
    # Each line's familiar words before and after its breaks: a notice over lines has some in the first and the last of them.
    step = step.withColumn("_edges", F.transform("_lines", lambda p: F.struct(familiar(last(p["words"])).alias("end"), familiar(F.slice(p["words"], 1, REACH)).alias("start"))))

    def wrapped(n: int) -> Column:
        """What could be a notice wrapped over n lines: words before the first break and after the last one, and all between them."""

        def part(p: Column) -> Column:
            at = lambda k: F.get("_lines", p["paragraph"] + k)
            edge = lambda k: F.get("_edges", p["paragraph"] + k)
            inner, end, start = [at(k) for k in range(1, n - 1)], edge(0)["end"], edge(n - 1)["start"]
            whole = (F.size(end) > 0) & (F.size(start) > 0)
            for x in inner:
                whole &= F.size(x["words"]).between(1, REACH)
            some = telling(end) | telling(start)
            for k in range(1, n - 1):
                some |= telling(edge(k)["start"])
            words = F.concat(last(p["words"]), *(x["words"] for x in inner), F.slice(at(n - 1)["words"], 1, REACH))
            text = F.concat_ws("\n", p["text"], *(x["text"] for x in inner), at(n - 1)["text"])
            return F.when(whole & some, F.struct(p["paragraph"].alias("paragraph"), F.lit(n).alias("lines"), text.alias("text"), words.alias("words")))

        return F.filter(F.transform("_lines", part), lambda p: p.isNotNull())

    step = step.withColumn("_near", F.concat(F.filter("_lines", lambda p: F.size(familiar(p["words"])) >= 2), *(wrapped(n) for n in range(2, SPAN + 1)))).drop("_lines", "_edges")

    def of(p: Column, **fields: Column) -> Column:
        return F.struct(*(p[c].alias(c) for c in ("paragraph", "lines", "text")), *(v.alias(c) for c, v in fields.items()))

    def with_pairs(p: Column) -> Column:
        words = p["words"]
        pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        return of(p, words=words, pairs=pairs)

    def with_scores(p: Column) -> Column:
        hits = F.filter(F.array_distinct(F.concat(p["words"], p["pairs"])), lambda g: g.isin(grams))
        scores = F.aggregate(hits, _list([float(b) for b in m.bias]), lambda total, g: F.zip_with(total, F.element_at(weights, F.array_position(vocabulary, g).cast("int")), lambda a, b: a + b))
        return of(p, words=p["words"], pairs=F.when(F.size(p["pairs"]) > 0, p["pairs"]).otherwise(p["words"]), scores=scores)

    def with_family(p: Column) -> Column:
        top = F.array_max(p["scores"])
        likely = 1 / F.aggregate(p["scores"], F.lit(0.0), lambda total, s: total + F.exp(s - top))
        return of(p, words=p["words"], pairs=p["pairs"], family=F.element_at(classes, F.array_position(p["scores"], top).cast("int")), probability=likely)

    def confirmed(p: Column) -> Column:
        alike = F.exists(F.element_at(templates, p["family"]), lambda t: F.size(F.array_intersect(t, p["pairs"])) >= F.size(t) * F.lit(CONTAINED))
        declared = F.coalesce(*(F.when(p["family"] == c, F.array_join(p["words"], " ").rlike(x)) for c, x in DECLARES.items()))
        other = p["family"].startswith("cc-by") & F.array_join(p["words"], " ").rlike(OTHER)
        sure = (p["family"] != UNKNOWN) & ~other & (F.coalesce(declared, F.lit(False)) | (p["probability"] >= m.least) & F.coalesce(alike, F.lit(False)))
        return of(p, family=F.when(sure, p["family"]).otherwise(F.lit(UNKNOWN)), probability=p["probability"])

    for f in (with_pairs, with_scores, with_family, confirmed):
        step = step.withColumn("_near", F.transform("_near", f))
    meets = lambda p, q: (q["paragraph"] < p["paragraph"] + p["lines"]) & (p["paragraph"] < q["paragraph"] + q["lines"])
    # A notice within fewer lines, or in earlier ones, goes before a wrapped one, and a wrapped one before the unknown lines in it.
    before = lambda p, q: ((q["lines"] == 1) | (q["lines"] < p["lines"]) | ((q["lines"] == p["lines"]) & (q["paragraph"] < p["paragraph"])))
    step = step.withColumn("_sure", F.filter("_near", lambda p: p["family"] != UNKNOWN))
    step = step.withColumn("_wrapped", F.filter("_sure", lambda p: (p["lines"] > 1) & ~F.exists("_sure", lambda q: meets(p, q) & before(p, q)))).drop("_sure")
    step = step.withColumn("_own", F.concat("_wrapped", F.filter("_near", lambda p: (p["lines"] == 1) & ((p["family"] != UNKNOWN) | ~F.exists("_wrapped", lambda q: meets(p, q))))))
    findings = F.transform(F.array_sort("_own"), lambda p: F.struct(p["paragraph"].cast("long").alias("paragraph"), p["text"].alias("text"), p["family"].alias("family"), p["probability"].alias("probability")))
    return step.withColumn("findings", findings).drop("_near", "_wrapped", "_own")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: paragraphs, license notices, possible notices left unknown, and the families found."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    families = F.array_sort(F.array_distinct(F.filter(F.transform("findings", lambda p: p["family"]), lambda c: c != UNKNOWN)))
    sure = F.size(F.filter("findings", lambda p: p["family"] != UNKNOWN)).cast("long")
    return found.select("doc_id", "n_paragraphs", sure.alias("n_notices"), (F.size("findings").cast("long") - sure).alias("n_unknown"), F.array_join(families, ",").alias("families"))
