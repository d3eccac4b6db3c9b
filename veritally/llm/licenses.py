"""Licence scan: a trained paragraph classifier, confirmed against templates.

Sparse logistic regression over words and word pairs names the licence family of a
paragraph or calls it unknown. What it names must also resemble a template of that
family. Scanning uses DataFrame functions and ML's transformers only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritally.session import store_table

UNKNOWN = "unknown"
PLAIN_WEIGHT = 1000
CALIBRATION_STEPS = 10_000
LEAST_RESEMBLANCE = 0.6
FALSE_ALARMS = 0.01

# Common wordings of notices, by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "This file is licensed under the Apache License Version 2.0",
        "Apache License Version 2.0 January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License",
    ),
    "bsd": (
        "Released under the BSD License",
        "Licensed under the 3-clause BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0",
        "To the extent possible under law, the author has waived all copyright",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "Released under the GNU GPL, version 2 or later",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT license",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}

#: Paragraphs that speak of licences without being one.
UNRELATED = (
    "He renewed his driving license in the spring and paid a small fee",
    "The shop lost its liquor license after a hearing before the council",
    "The license of the television station runs out next year",
    "Ask the teacher for permission before you leave the room",
    "Permission to land was granted by the tower after a short delay",
    "Copyright law differs from one country to another and changes over time",
    "The book deals with copyright and the rights of authors",
    "An apache helicopter flew over the village in the morning",
    "The general told the public that the version in the paper was false",
    "The software was licensed to several companies for a yearly fee",
    "A license is required to fish in this lake between May and September",
    "Redistribution of land was the aim of the reform of that year",
    "The commons is a green in the middle of the town and open to the public",
    "Students at the institute released a study of the new version",
)

#: A text without any of these has no notice: every template holds one. Checked in lower case.
CUES = (
    "licen", "spdx", "copyright", "permission", "redistribution", "gpl", "cc by", "cc0",
    "creative commons", "public domain",
)

_WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
_NUMBER = r"[0-9]+(?:\.[0-9]+)*"


@dataclass
class LicenseModel:
    """Fitted stages, family of each class, and the least probability that isn't unknown."""

    stages: PipelineModel
    families: list[str]
    threshold: float


def train_licenses(docs: DataFrame, *, text: str = "text") -> LicenseModel:
    """Fit on templates, wordings with a word left out, and paragraphs that are none.

    The last are ``UNRELATED`` and every line with a word of all texts without a cue. Features are the words and
    word pairs of the wordings; lines that hold the same ones are one row with a weight. All lines of
    texts weigh one each, and together ``PLAIN_WEIGHT`` at most, so that the wordings count in a
    corpus of any size. The probability from which a family is named is calibrated on all of
    these lines: at most ``FALSE_ALARMS`` of them would be named.
    """
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted(TEMPLATES)]
    wordings = _table(spark, [(i, t) for i, f in enumerate(families) for t in TEMPLATES.get(f, ())])
    words = F.split("paragraph", " ")
    shorter = wordings.select("label", F.posexplode(words).alias("i", "w"), words.alias("ws")).select(
        "label", F.array_join(F.filter("ws", lambda w, j: j != F.col("i")), " ").alias("paragraph")
    )
    whole = F.explode(F.array_repeat("paragraph", 8)).alias("paragraph")
    positive = wordings.select("label", whole).unionByName(shorter)
    other = _table(spark, [(0, t) for t in UNRELATED for _ in range(8)])
    known = positive.unionByName(other).withColumn("words", _words("paragraph")).coalesce(1)
    join = "SELECT *, concat(words, pairs) AS terms FROM __THIS__"
    terms = Pipeline(
        stages=[
            NGram(n=2, inputCol="words", outputCol="pairs"),
            SQLTransformer(statement=join),
            CountVectorizer(inputCol="terms", outputCol="features", binary=True),
        ]
    ).fit(known)
    plain = docs.where(F.col(text).isNotNull() & ~_has_cue(F.col(text)))
    lines = plain.select(F.explode(F.split(text, "\n", -1)).alias("paragraph")).select(_words("paragraph").alias("words"))
    alike = terms.transform(lines.where(F.size("words") > 0)).groupBy("features").agg(F.count(F.lit(1)).alias("n"))
    drawn = store_table(alike, "plain_lines")
    total = drawn.agg(F.sum("n")).first()[0] or 0
    share = min(1.0, PLAIN_WEIGHT / total) if total else 1.0
    made = terms.transform(known).select("label", "features", F.lit(1).cast("long").alias("n"), F.lit(1.0).alias("weight"))
    rows = made.unionByName(
        drawn.select(F.lit(0.0).alias("label"), "features", "n", (F.col("n") * share).alias("weight"))
    )
    learner = LogisticRegression(
        family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=40, tol=1e-5, weightCol="weight"
    )
    fitted = learner.fit(rows)
    best = F.array_max(F.slice(vector_to_array("probability"), 2, len(families) - 1))
    # Rounded up, so that the values to rank are at most so many, however many lines there are.
    steps = F.ceil(best * CALIBRATION_STEPS) / CALIBRATION_STEPS
    wrong = fitted.transform(rows.where("label = 0")).select(steps.alias("p"), "n")
    quantile = wrong.agg(F.percentile("p", F.lit(1 - FALSE_ALARMS), F.col("n")).alias("q")).first()["q"]
    return LicenseModel(PipelineModel(stages=[*terms.stages, fitted]), families, max(0.5, quantile or 0.0))


def scan_licenses(
    docs: DataFrame,
    model: LicenseModel,
    *,
    key: str = "doc_id",
    text: str = "text",
    least_resemblance: float = LEAST_RESEMBLANCE,
) -> DataFrame:
    """Notices found: key, paragraph (number of its first line, from 0), family, probability, resemblance.

    A paragraph is a line, alone or joined with the next ones, so that wrapped notices are whole. It
    ends at a line without words, such as a blank one or a bare comment mark, and once the
    next lines hold as many words as the longest template. All paragraphs of a text that
    has a cue anywhere are judged. The resemblance is the largest share of a template's words and
    word pairs that a paragraph holds, over the templates of its family, numbers left aside. A
    paragraph whose best family stays below the calibrated probability, or resembles no template, is
    unknown and not reported; nor is one that contains a shorter notice of its family.

    Null and empty texts have no notices, repeated rows are reported each, null keys are passed
    through, other columns are ignored.
    """
    rows = docs.where(_mentions(F.col(text))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.transform(F.split(text, "\n", -1), _words).alias("lines"),
    )
    found = rows.select("row", "key", F.inline(_paragraphs("lines")))
    chances = vector_to_array("probability")
    families = F.array(*[F.lit(f) for f in model.families])
    judged = (
        model.stages.transform(found)
        .withColumn("chances", F.slice(chances, 2, len(model.families) - 1))
        .withColumn("best", F.array_max("chances"))
        .withColumn("family", F.element_at(families, F.array_position("chances", F.col("best")).cast("int") + 1))
        .where(F.col("best") >= model.threshold)
        .withColumn("terms", _unnumbered(F.col("terms")))
    )
    resemblance = F.greatest(
        F.lit(0.0),
        *[
            F.when(
                F.col("family") == family,
                F.size(F.array_intersect(F.col("terms"), F.array(*map(F.lit, template_terms(template)))))
                / len(template_terms(template)),
            )
            for family, templates in TEMPLATES.items()
            for template in templates
        ],
    )
    notices = judged.withColumn("resemblance", resemblance).where(F.col("resemblance") >= least_resemblance)
    inside = Window.partitionBy("row", "family").orderBy(F.desc("paragraph"), "last").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        notices.withColumn("shorter", F.min("last").over(inside))
        .where("shorter IS NULL OR shorter > last")
        .select(F.col("key").alias(key), "paragraph", "family", F.col("best").alias("probability"), "resemblance")
    )


def _table(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    structs = [F.struct(F.lit(float(a)).alias("label"), F.lit(b).alias("paragraph")) for a, b in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _has_cue(text: Column) -> Column:
    return text.rlike("(?i)" + "|".join(CUES))


def _mentions(text: Column) -> Column:
    """Whether a text has a cue, also one that is wrapped."""
    return text.rlike("(?i)" + "|".join(c.replace(" ", "[^a-z0-9]+") for c in CUES))


def _paragraphs(lines: str) -> Column:
    """Structs of paragraph (first line), last (line) and words, from the words of each line."""
    reach = max(len(re.findall(_WORD, t.lower())) for ts in TEMPLATES.values() for t in ts)

    def next_lines(i: Column) -> Column:
        return F.slice(lines, i + 2, F.lit(reach))

    def count(i: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(True).alias("open"))

        def add(so_far: Column, line: Column) -> Column:
            goes_on = so_far["open"] & (F.size(line) > 0) & (so_far["words"] < reach)
            return F.struct(
                (so_far["n"] + F.when(goes_on, 1).otherwise(0)).alias("n"),
                (so_far["words"] + F.when(goes_on, F.size(line)).otherwise(0)).alias("words"),
                goes_on.alias("open"),
            )

        return F.aggregate(next_lines(i), start, add, lambda x: x["n"])

    def joined(line: Column, i: Column, n: Column) -> Column:
        more = F.slice(F.flatten(F.slice(lines, i + 2, n)), 1, reach)
        return F.struct(i.alias("paragraph"), (i + n).alias("last"), F.concat(line, more).alias("words"))

    def from_line(line: Column, i: Column) -> Column:
        ends = F.when(F.size(line) > 0, F.sequence(F.lit(0), count(i))).otherwise(F.array().cast("array<int>"))
        return F.transform(ends, lambda n: joined(line, i, n))

    return F.flatten(F.transform(lines, from_line))


def _words(paragraph: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(_WORD), F.lit(0))


def _unnumbered(terms: Column) -> Column:
    return F.array_distinct(F.transform(terms, lambda t: F.regexp_replace(t, _NUMBER, "0")))


def template_terms(template: str) -> list[str]:
    """Distinct words and word pairs of a template, with numbers made equal."""
    words = re.findall(_WORD, template.lower())
    terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return list(dict.fromkeys(re.sub(_NUMBER, "0", t) for t in terms))
