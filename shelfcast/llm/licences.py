"""Licence notices found by a trained paragraph classifier.

Paragraphs are lines, cut after sentence ends. Words in lower case and pairs of neighbouring
words are hashed into ``FEATURES`` buckets; a multinomial logistic regression over the buckets
that occur tells licence families, other licences and ordinary text apart. It is fitted on the
notices below, whole and sentence by sentence, and on the paragraphs of the input that share no
three words in a row with a notice. Half of the documents are kept out of the fit and calibrate
it: a family counts from the probability on that all but ``FALSE_RATE`` of their paragraphs stay
below, and from one half at least.

The fit starts from the optimum for ``SAMPLE`` documents. One pass over all documents then gives
the exact gradient of the whole loss there, and the weights are moved to the optimum of the loss
whose gradient it is: the sample tells only how the loss bends, and every other bucket's own
gradient bounds how far it may move (``_moved``). So each document is in the fit or in the
calibration, and the rows kept do not grow with the input.

Every paragraph is scored, most by a bound only. A bucket adds at most its largest weight over
that of ordinary text. If these sums cannot lift any licence to the
probability of ordinary text, the paragraph is neither a family nor unknown, and its
probabilities are not worked out. The bound is exact: it drops no paragraph that would count.

One that passes must also be confirmed by the best notice of its family: of the runs of three
words of paragraph and notice, the smaller set must lie in the other one by a share of
``MIN_SIMILAR``, and a shared run must be in no other family's notice. A paragraph that is
rather a licence than not, but passes no threshold or is not confirmed, is ``unknown``.

Defined cases: null and empty texts have no paragraphs; null and repeated ids are reported
as they come; equal probabilities go to the first family by name; an empty table gives no rows
(the fit then sees the notices and fixed sentences). Sample and halves are drawn by a hash of id
and text, so reruns draw the same documents; repeated rows count once. A paragraph of any length is one row. Only ``doc_id`` and ``text`` are
read. All of it is DataFrame functions and MLlib columns; paragraphs are scored where they are
read, and only sums by bucket, keys of documents and findings are shuffled.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.columns import DICTIONARY_LIMIT
from shelfcast.llm.decontamination import plain_words
from shelfcast.llm.text import whole
from shelfcast.session import small_side, written

# Notices of the licence families.
NOTICES = {
    "apache-2.0": [
        "Licensed under Apache 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "bsd": [
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "cc-by": [
        "SPDX-License-Identifier: CC-BY-4.0",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This article is distributed under the terms of the Creative Commons Attribution License.",
    ],
    "cc-by-nc": [
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This article is distributed under the terms of the Creative Commons Attribution-NonCommercial License.",
    ],
    "gpl": [
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "mit": [
        "SPDX-License-Identifier: MIT",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 The Authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
# Sentences with a notice's words that are none.
NEAR_MISSES = [
    "The committee reserved all seats for the public.",
    "Version 2.0 of the software was released in general under a new name.",
    "The driver lost her license and the right to work.",
    "You may use the file at your own option.",
    "This program is free for any person.",
    "The publisher obtained a copy of the work.",
]
# Notices of licences that are none of the families.
OTHERS = [
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Licensed under the Mozilla Public License, version 2.0.",
    "Licensed under the EUPL.",
    "Licensed under the European Union Public Licence, version 1.2 only.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "This is free and unencumbered software released into the public domain.",
    "This software is provided as-is, without any express or implied warranty.",
    "Distributed under the Boost Software License, Version 1.0.",
]
FAMILIES = sorted(NOTICES)
# Classes: the families, other licences, ordinary text.
OTHER, NONE = len(FAMILIES), len(FAMILIES) + 1
FEATURES = 1 << 13
SAMPLE = 400
FALSE_RATE = 0.0005
MIN_SIMILAR = 0.6
RUN = 3
ROUNDS = 60
REGULAR = 0.0005
UNIT = 1 << 30


def paragraphs(text: Column) -> Column:
    """Lines, cut after sentence ends that a capital follows."""
    return F.split(whole(text), r"\n|(?<=[.!?])[ \t]+(?=\p{Lu})")


def buckets(tokens: Column) -> Column:
    """Buckets of a paragraph's words and pairs of neighbouring words, repeats included."""
    bucket = lambda *names: F.pmod(F.xxhash64(*names), F.lit(FEATURES)).cast("int")
    rest = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(tokens, F.lit(1), rest), F.slice(tokens, F.lit(2), rest), lambda a, b: bucket(a, b))
    return F.concat(F.transform(tokens, lambda w: bucket(w)), pairs)


def _once(value: Column) -> Column:
    """``value`` as rows of its own, so that what reads it later does not work it out again."""
    return F.explode(F.array(value))


def _fixed(values: np.ndarray) -> Column:
    """An array of doubles as one literal."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast("array<double>")


def _vectors(rows: DataFrame) -> DataFrame:
    """``rows`` (with the distinct buckets found) and their vector for the fit."""
    names = F.transform("found", lambda b: b.cast("string"))
    model = CountVectorizerModel.from_vocabulary(
        [str(k) for k in range(FEATURES)], inputCol="names", outputCol="features"
    )
    return model.setBinary(True).transform(rows.withColumn("names", names)).drop("names")


def _notices(spark: SparkSession) -> DataFrame:
    """(label, tokens) of the notices, whole and by sentence, and of the near misses."""
    given = [(k, n) for k, f in enumerate(FAMILIES) for n in NOTICES[f]] + [(OTHER, n) for n in OTHERS] + [(NONE, n) for n in NEAR_MISSES]
    rows = [F.struct(F.lit(k).alias("label"), F.lit(n).alias("text")) for k, n in given]
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.label", "r.text")
    pieces = F.array_distinct(F.concat(F.array("text"), paragraphs(F.col("text"))))
    return table.select("label", F.explode(pieces).alias("text")).select("label", plain_words(F.col("text")).alias("tokens"))


def _runs(tokens: Column) -> Column:
    """Distinct runs of ``RUN`` words; fewer words are one run."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - RUN, F.lit(0)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(RUN)), " ")))


def notice_runs(notice: str) -> list[str]:
    """A notice's distinct runs of ``RUN`` words in order."""
    words = [w for w in re.split(r"[\W_]+", notice.lower()) if w]
    return list(dict.fromkeys(" ".join(words[k : k + RUN]) for k in range(max(len(words) - RUN + 1, 1))))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, draw): ``draw`` names a document by its id and text."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("draw"))


def _named(keyed: DataFrame) -> DataFrame:
    """(draw, times): each document once and how many rows are it."""
    return written(keyed.groupBy("draw").agg(F.count("*").alias("times")), "licence-draws")


def _sampled(keyed: DataFrame, named: DataFrame) -> DataFrame:
    """The documents the fit starts from, each once."""
    # The draw is made on narrow rows; the texts of the drawn are looked up after.
    drawn = named.select("draw").orderBy("draw").limit(SAMPLE)
    return keyed.join(F.broadcast(drawn), "draw").dropDuplicates(["draw"])


def _shared(keyed: DataFrame, named: DataFrame) -> DataFrame:
    """``keyed`` and ``share``, one over the number of rows that are the same document."""
    repeated = named.filter("times > 1")
    some = keyed.join(small_side(repeated, DICTIONARY_LIMIT), "draw", "left")
    return some.withColumn("share", 1 / F.coalesce("times", F.lit(1))).drop("times")


def _holds_notice(tokens: Column) -> Column:
    """Whether a paragraph shares a run of words with a notice."""
    known = sorted({r for n in [n for f in FAMILIES for n in NOTICES[f]] + OTHERS for r in notice_runs(n)})
    # A run needs its longest word, which is looked for first.
    longest = sorted({max(r.split(), key=len) for r in known})
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - RUN, F.lit(0)))
    whole_run = lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(RUN)), " ").isin(known)
    return F.exists(tokens, lambda w: w.isin(longest)) & F.exists(starts, whole_run)


def _ordinary(keyed: DataFrame, *kept: str) -> DataFrame:
    """(tokens, ``kept``): paragraphs of the documents to fit that share no run with a notice."""
    rows = keyed.filter(~_held()).select(*kept, F.explode(paragraphs(F.col("text"))).alias("text"))
    rows = rows.select(*kept, _once(plain_words(F.col("text"))).alias("tokens"))
    return rows.filter((F.size("tokens") > 0) & ~_holds_notice(F.col("tokens")))


def _held() -> Column:
    """Whether a document is kept out of the fit, to calibrate it."""
    return F.pmod("draw", F.lit(2)) == 1


@dataclass
class Classifier:
    """Weights by class and bucket, intercepts, and the probability from which a family counts."""

    weights: np.ndarray
    intercepts: np.ndarray
    threshold: float

    def may_count(self, found: Column) -> Column:
        """False only if ordinary text is likelier than not whatever else is known of these distinct buckets."""
        over = (self.weights[:NONE] - self.weights[NONE]).max(0)
        most = np.log(np.exp(self.intercepts[:NONE] - self.intercepts[NONE]).sum())
        # Sums are rounded, so a paragraph on the very edge is scored.
        return _lifted(found, over, most) >= -1e-6

    def score(self, rows: DataFrame, bounded: bool = True) -> DataFrame:
        """``rows`` (with tokens) and ``p``, the probability of each class; those that cannot count may be left out."""
        rows = rows.select("*", _found())
        if bounded:
            rows = rows.filter(self.may_count(F.col("found")))
        rows = rows.select("*", _once(F.array(*[_lifted(F.col("found"), w, b) for w, b in zip(self.weights, self.intercepts)])).alias("margins"))
        odds = F.transform("margins", lambda m: F.exp(m - F.array_max("margins")))
        rows = rows.select("*", _once(odds).alias("odds")).select("*", _once(F.aggregate("odds", F.lit(0.0), lambda a, b: a + b)).alias("total"))
        return rows.withColumn("p", F.transform("odds", lambda x: x / F.col("total"))).drop("found", "margins", "odds", "total")


def _lifted(found: Column, weights: np.ndarray, start: float) -> Column:
    """The sum of the buckets' weights and ``start``."""
    return F.aggregate(found, F.lit(float(start)), lambda total, b: total + F.get(_fixed(weights), b))


def _found() -> Column:
    return _once(F.array_distinct(buckets(F.col("tokens")))).alias("found")


def _start(keyed: DataFrame, named: DataFrame) -> tuple[np.ndarray, list, int]:
    """The weights (the last column the intercepts) fitted on the notices and the sample, the rows it learned from, and how many of them are the sample's."""
    notices = _notices(keyed.sparkSession)
    ordinary = written(_ordinary(_sampled(keyed, named)), "licence-sample")
    n = ordinary.count()
    # All licences together weigh as much as ordinary text.
    weight = F.when(F.col("label") < NONE, F.lit(max(n, 1) / 30.0)).otherwise(1.0)
    rows = notices.withColumn("sampled", F.lit(0)).unionByName(ordinary.select(F.lit(NONE).alias("label"), "tokens", F.lit(1).alias("sampled")))
    rows = rows.select(F.col("label").cast("double").alias("label"), weight.alias("weight"), "sampled", _found())
    learner = LogisticRegression(
        family="multinomial", maxIter=ROUNDS, regParam=REGULAR, weightCol="weight", standardization=False,
        rawPredictionCol="", predictionCol="",
    )
    # The sample is bounded, so the fit's many short jobs take one task each.
    model = learner.fit(_vectors(rows).coalesce(1))
    weights = np.column_stack([model.coefficientMatrix.toArray(), model.interceptVector.toArray()])
    return weights, rows.select("label", "weight", "sampled", "found").collect(), n


def _whole_gradient(keyed: DataFrame, named: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Over all paragraphs to fit: sums of the probabilities by class and bucket, less one for ordinary text, and the
    paragraphs' number. As in ``weights``, the last column is the intercepts', which every paragraph has."""
    rows = _ordinary(_shared(keyed, named), "share").select("share", _found())
    over, names = weights[:NONE] - weights[NONE], [f"p{c}" for c in range(NONE)]
    rows = rows.select("*", *[_lifted(F.col("found"), w[:-1], w[-1]).alias(n) for w, n in zip(over, names)])
    rows = rows.select("*", F.greatest(F.lit(0.0), *names).alias("top"))
    rows = rows.select("share", "found", F.exp(-F.col("top")).alias("none"), *[F.exp(F.col(n) - F.col("top")).alias(n) for n in names])
    total = functools.reduce(Column.__add__, [F.col(n) for n in names], F.col("none"))
    rows = rows.select("share", "found", *names, (F.col("share") * F.lit(float(UNIT)) / total).alias("unit"))
    units = [(F.col(n) * F.col("unit")).cast("bigint").alias(n) for n in names]
    rows = rows.select("share", *units, F.explode(F.concat("found", F.array(F.lit(FEATURES)))).alias("bucket"))
    out, n = np.zeros((NONE + 1, FEATURES + 1)), 0.0
    for r in rows.groupBy("bucket").agg(F.sum("share"), *[F.sum(x) for x in names]).collect():
        out[:NONE, r[0]] = np.array(r[2:], np.float64) / UNIT
        n = r[1] if r[0] == FEATURES else n
    # What ordinary text lacks to be certain is what the licences have.
    out[NONE] = -out[:NONE].sum(0)
    return out, n


def _moved(start: np.ndarray, rows: list, n: int, whole: np.ndarray, total: float) -> np.ndarray:
    """Weights (the last column the intercepts) from ``start`` to where the loss over all documents is least.

    Its gradient at ``start`` is exact: that of the sample's ordinary text is replaced by ``whole``
    over ``total`` paragraphs. How the loss bends away from there is taken from the sample and,
    where a bucket's gradient is larger than in the sample, from that gradient: a probability p
    bends the loss by p (1 - p) at most, and all buckets of a paragraph may move one way. So the
    buckets of a paragraph that the sample does not hold move it by less than one together.
    """
    at = np.concatenate([np.array([*r["found"], FEATURES]) for r in rows])
    first = np.cumsum([0, *[len(r["found"]) + 1 for r in rows]])[:-1]
    of = np.repeat(np.arange(len(rows)), np.diff([*first, len(at)]))
    label, weight = np.array([int(r["label"]) for r in rows]), np.array([r["weight"] for r in rows])
    mine = np.array([r["sampled"] for r in rows], bool)
    weight = weight / weight.sum()
    free = np.r_[np.ones(FEATURES), 0.0] * REGULAR

    def chances(w: np.ndarray) -> np.ndarray:
        margins = np.add.reduceat(w[:, at], first, axis=1)
        odds = np.exp(margins - margins.max(0))
        return odds / odds.sum(0)

    def by_bucket(values: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(at, v[of], FEATURES + 1) for v in values])

    told = np.eye(NONE + 1)[label].T
    sampled = by_bucket((chances(start) - told) * mine) / n
    part = n * weight[mine][0]
    push = part * (whole / total - sampled)
    length = mine[of].sum() / n
    bend = part * length * np.maximum(np.abs(whole / total) - np.abs(sampled), 0)

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        p, off = chances(w), w - start
        loss = -(weight * np.log(np.maximum(p[label, np.arange(len(rows))], 1e-300))).sum()
        loss += (free * w * w).sum() / 2 + (push * off).sum() + (bend * off * off).sum() / 2
        return loss, by_bucket((p - told) * weight) + free * w + push + bend * off

    return _least(value, start)


def _least(value: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = 2 * ROUNDS, memory: int = 10) -> np.ndarray:
    """Where a smooth convex function, given with its gradient, is least: L-BFGS with halved steps."""
    have, slope = value(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, kept = slope.copy(), []
        for s, y in reversed(steps):
            kept.append((s * way).sum() / (s * y).sum())
            way -= kept[-1] * y
        if steps:
            s, y = steps[-1]
            way *= (s * y).sum() / (y * y).sum()
        for (s, y), k in zip(steps, reversed(kept)):
            way += (k - (y * way).sum() / (s * y).sum()) * s
        falls, length = (slope * way).sum(), 1.0 if steps else min(1.0, 1 / max(np.abs(slope).sum(), 1e-300))
        while length > 1e-10:
            then, other = value(x - length * way)
            if then <= have - 1e-4 * length * falls:
                break
            length /= 2
        else:
            return x
        s, y = -length * way, other - slope
        if (s * y).sum() > 0:
            steps = [*steps[1 - memory :], (s, y)] if memory > 1 else [(s, y)]
        done = have - then <= 1e-9 * max(abs(have), 1e-300)
        x, have, slope = x + s, then, other
        if done:
            break
    return x


def _fitted(keyed: DataFrame, named: DataFrame) -> Classifier:
    """The classifier before its calibration."""
    weights, rows, n = _start(keyed, named)
    whole, total = _whole_gradient(keyed, named, weights)
    if n and round(total) > n:
        weights = _moved(weights, rows, n, whole, total)
    return Classifier(weights[:, :-1], weights[:, -1], 0.5)


def _candidates(keyed: DataFrame, classifier: Classifier, bounded: bool = True, counted: Observation | None = None) -> DataFrame:
    """Scored paragraphs that may be a family from one half on or are rather a licence than not, whatever the threshold.

    ``counted`` counts the ordinary paragraphs that calibrate, on the way.
    """
    kept = [c for c in keyed.columns if c != "text"]
    rows = keyed.select(*kept, F.posexplode(paragraphs(F.col("text"))).alias("paragraph", "body"))
    rows = rows.select(*kept, "paragraph", _once(plain_words(F.col("body"))).alias("tokens")).filter(F.size("tokens") > 0)
    if counted is not None:
        rows = rows.observe(counted, F.sum(F.when(_held() & ~_holds_notice(F.col("tokens")), F.col("share"))).alias("n"))
    scored = classifier.score(rows, bounded).withColumn("best", F.array_max(F.slice("p", 1, len(FAMILIES))))
    return scored.filter((F.col("best") >= 0.5) | (F.get("p", F.lit(NONE)) < 0.5))


def _calibrated(docs: DataFrame, bounded: bool = True) -> tuple[Classifier, DataFrame]:
    """The classifier and its candidates, scored once and written; they set its threshold.

    It is the best probability that all but ``FALSE_RATE`` of the ordinary paragraphs held out stay
    below, one half at least. Those above one half are all among the candidates.
    """
    keyed, counted = _keyed(docs), Observation()
    named = _named(keyed)
    classifier = _fitted(keyed, named)
    found = written(_candidates(_shared(keyed, named), classifier, bounded, counted), "licence-candidates")
    n = round(counted.get["n"] or 0)
    above = found.filter(_held() & (F.col("best") > 0.5) & ~_holds_notice(F.col("tokens"))).dropDuplicates(["draw", "paragraph"])
    m = above.count()
    # The quantile's rank from the top among all.
    rank = n - max(math.ceil((1 - FALSE_RATE) * n), 1) + 1
    if n and m >= rank:
        classifier.threshold = float(above.agg(F.percentile_approx("best", (m - rank + 1) / m, 10_000)).first()[0])
    return classifier, found


def fit(docs: DataFrame) -> Classifier:
    return _calibrated(docs)[0]


def _similarity(family: str) -> Column:
    """The best share, over a family's notices, of the smaller set of runs that lies in the other."""
    others = {r for f in FAMILIES if f != family for n in NOTICES[f] for r in notice_runs(n)}
    runs = F.col("runs")

    def share(notice: str) -> Column:
        mine = notice_runs(notice)
        own = [r for r in mine if r not in others]
        told = F.array(*map(F.lit, mine))
        shared = F.size(F.array_intersect(runs, told)) / F.least(F.size(runs), F.lit(len(mine)))
        return F.when(F.arrays_overlap(runs, F.array(*map(F.lit, own))), shared).otherwise(0.0) if own else F.lit(0.0)

    return F.array_max(F.array(*map(share, NOTICES[family])))


def find_licences(docs: DataFrame, classifier: Classifier | None = None, bounded: bool = True) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity) of every licence paragraph."""
    if classifier is None:
        classifier, scored = _calibrated(docs, bounded)
    else:
        scored = _candidates(_keyed(docs), classifier, bounded)
    scored = scored.filter((F.col("best") >= classifier.threshold) | (F.get("p", F.lit(NONE)) < 0.5))
    likely = F.get(F.array(*map(F.lit, FAMILIES)), F.array_position("p", F.col("best")).cast("int") - 1)
    named = scored.select("doc_id", "paragraph", "best", likely.alias("likely"), _once(_runs(F.col("tokens"))).alias("runs"))
    chosen = F.lit(0.0)
    for family in FAMILIES:
        chosen = F.when(F.col("likely") == family, _similarity(family)).otherwise(chosen)
    named = named.withColumn("similarity", chosen)
    sure = (F.col("best") >= classifier.threshold) & (F.col("similarity") >= MIN_SIMILAR)
    return named.select(
        "doc_id", "paragraph", F.when(sure, F.col("likely")).otherwise("unknown").alias("family"),
        F.col("best").alias("probability"), "similarity",
    )
