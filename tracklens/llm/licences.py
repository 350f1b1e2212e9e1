"""Licence scan: a trained paragraph classifier whose findings are confirmed against templates.

A paragraph is a line. Its words, pairs and triples of words that occur in a template make a sparse vector, and a multinomial
logistic regression with a class for "no licence" gives a probability for each family. It is trained on the
templates below and on every line of the corpus that is not like a template: lines of equal vectors are one row with their
number as its weight, so nothing is left out. The unknown class is calibrated on the same lines, whose probabilities are
counted in steps of ``1 / STEPS``: a family counts only above a probability that all but ``FALSE_SHARE`` of them
stay under. What is left is compared with the family's templates: most of the line's word pairs must occur there, with a
pair that names the family. A declaration or licence text may also be a part of a longer line: a line that holds most
of the word pairs of a single template, and one that names its family, has that family too, whatever else it says. A line
may have several families.

DataFrame functions and the JVM's own transformers do all the work; there is no Python on the executors.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm.columns import ident, outward
from tracklens.session import written

FALSE_SHARE = 0.002
STEPS = 10_000
LEAST_PROBABILITY, MOST_PROBABILITY = 0.5, 0.9
CONFIRMED_SHARE = 0.5
#: Share of a template's word pairs that a line must hold to contain it, and the fewest pairs such a template has; shorter
#: ones are titles, which must be the line.
CONTAINED_SHARE = 0.8
CONTAINED_PAIRS = 4
MIN_WORDS = 2
UNKNOWN = "none"

#: Declarations and opening sentences of the licence families.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License 2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "Licensed under the GNU General Public License v3.0",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; version 2 of the License.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD License",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

#: Words of which every template of at least ``CONTAINED_PAIRS`` pairs holds one; lines without are not searched for parts.
TELLING = "license licence licensed permission redistribution redistribute copyright spdx domain".split()

#: Lines that speak of licences without granting one.
NEAR_MISSES = [
    "The driver showed a licence to the officer at the gate.",
    "A license is required to sell food on the market.",
    "Copyright law was discussed in the second session of the conference.",
    "The general public was admitted free of charge.",
    "Permission to enter the building was granted by the manager.",
    "This version of the report was released under the old title.",
]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.\p{N}+)*"), F.lit(0))


def _grams(rows: DataFrame) -> DataFrame:
    """Adds ``pairs`` and ``grams``, all words, pairs and triples, of ``words``."""
    steps = PipelineModel(
        [NGram(n=2, inputCol="words", outputCol="pairs"), NGram(n=3, inputCol="words", outputCol="triples")]
    )
    return steps.transform(rows).withColumn("grams", F.concat("words", "pairs", "triples")).drop("triples")


class Features:
    """The words, pairs and triples of the templates as positions of a sparse vector; all others have none."""

    def __init__(self, templates: DataFrame):
        found = {r.gram for r in templates.select(F.explode("grams").alias("gram")).distinct().collect()}  # fixed values
        names = sorted(found, key=lambda g: (g.count(" "), g))
        self.pairs = [g.count(" ") for g in names].index(1), sum(g.count(" ") < 2 for g in names)
        self.model = CountVectorizerModel.from_vocabulary(names, inputCol="grams", outputCol="features")
        self.model.setBinary(True)

    def of(self, rows: DataFrame) -> DataFrame:
        """Adds ``pairs`` and the sparse ``features`` of ``words``."""
        return self.model.transform(_grams(rows)).drop("grams")

    def known_pairs(self) -> Column:
        """How many distinct pairs of templates the ``features`` hold."""
        first, end = self.pairs
        places = F.unwrap_udt("features")["indices"]
        return F.size(F.filter(places, lambda i: (i >= first) & (i < end)))


def _families() -> list[str]:
    return [UNKNOWN, *TEMPLATES]


def _once(rows: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """``keep`` and the ``made`` columns, evaluated once per row: a filter on them is not pushed below, where it
    would repeat them."""
    return rows.select(*keep, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


class Scanner:
    """A trained model with its features and its calibrated threshold."""

    def __init__(self, model, features: Features, threshold: float, templates: DataFrame):
        self.model, self.features, self.threshold, self.templates = model, features, threshold, templates

    def scored(self, rows: DataFrame) -> DataFrame:
        """Adds ``family`` (the likeliest licence) and its ``probability``, and drops the ``features``."""
        kept = [c for c in rows.columns if c not in ("features", "pairs")]
        made = self.model.transform(rows).withColumn("p", vector_to_array("probability"))
        licences = F.slice("p", 2, len(TEMPLATES))
        best = F.array_max(licences)
        names = F.array(*[F.lit(n) for n in TEMPLATES])
        family = F.get(names, (F.array_position(licences, best) - 1).cast("int"))
        return _once(made, kept, family=family, probability=best)

    def confirmed(self, rows: DataFrame) -> DataFrame:
        """The scored rows' families that templates confirm, with ``similarity``: one row for each family of a line."""
        telling = F.arrays_overlap("words", F.array(*[F.lit(w) for w in TELLING]))
        likely = NGram(n=2, inputCol="words", outputCol="pairs").transform(
            rows.where((F.col("probability") >= self.threshold) | telling)
        )
        likely = _once(likely, rows.columns, pairs=F.array_distinct("pairs"))
        likely = likely.withColumnRenamed("family", "likeliest")
        # one row per family
        found = likely.crossJoin(F.broadcast(self.templates)).where(F.arrays_overlap("pairs", "naming_pairs"))
        share = F.size(F.array_intersect("pairs", F.col("template_pairs"))) / F.size("pairs")
        by_model = (F.col("family") == F.col("likeliest")) & (F.col("probability") >= self.threshold)
        whole = F.when(by_model & (share >= CONFIRMED_SHARE), share)
        held = F.array_max(
            F.transform("texts", lambda t: F.size(F.array_intersect(F.col("pairs"), t)) / F.size(t))
        )
        part = F.when(held >= CONTAINED_SHARE, held)
        return found.withColumn("similarity", F.greatest(whole, part)).where(F.col("similarity").isNotNull())


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``did, pos, line``; lines too short for ``MIN_WORDS`` words are left out."""
    lines = docs.select(
        ident(id_col).alias("did"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    )
    return lines.withColumnRenamed("col", "line").where(F.char_length("line") >= 2 * MIN_WORDS - 1)


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``did, pos, words`` of every line of at least ``MIN_WORDS`` words."""
    lines = _lines(docs, id_col, text_col)
    return _once(lines, ["did", "pos"], words=words_of(F.col("line"))).where(F.size("words") >= MIN_WORDS)


def _template_rows(spark: SparkSession) -> DataFrame:
    rows = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    return spark.createDataFrame(rows, "family string, text string").withColumn("words", words_of(F.col("text")))


def _template_pairs(featured: DataFrame) -> DataFrame:
    """One row per family: its word pairs, those that no other family has, and the pairs of each longer template."""
    pairs = featured.select("family", F.explode("pairs").alias("pair")).distinct()
    own = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    texts = featured.select("family", F.array_distinct("pairs").alias("t"))
    texts = texts.groupBy("family").agg(F.collect_list(F.when(F.size("t") >= CONTAINED_PAIRS, F.col("t"))).alias("texts"))
    return (
        pairs.join(own, "pair")
        .groupBy("family")
        .agg(
            F.collect_list("pair").alias("template_pairs"),
            F.collect_list(F.when(F.col("n") == 1, F.col("pair"))).alias("naming_pairs"),
        )
        .join(texts, "family")
    )


def unknown_lines(lines: DataFrame, features: Features) -> DataFrame:
    """``features, n``: the vectors of all lines (``words``) that are not like a template, and how many lines have each."""
    made = _once(features.of(lines), [], features=F.col("features"), n_pairs=F.size("words") - 1)
    clean = features.known_pairs() < CONFIRMED_SHARE * F.col("n_pairs")
    return made.where(clean).groupBy("features").agg(F.count("*").alias("n"))


def train(lines: DataFrame) -> Scanner:
    """A scanner from the templates and all lines of the corpus (``did, pos, words``)."""
    spark = lines.sparkSession
    rows = _template_rows(spark)
    features = Features(_grams(rows))
    templates = features.of(rows)
    names = F.array(*[F.lit(f) for f in _families()])
    pairs = written(_template_pairs(templates), "licence-templates")
    unknown = written(unknown_lines(lines, features), "licence-lines")
    misses = spark.createDataFrame([(t,) for t in NEAR_MISSES], "text string")
    misses = features.of(misses.withColumn("words", words_of(F.col("text"))))
    rows = templates.select("family", "features", F.lit(1).cast("long").alias("n"))
    for more in (unknown, misses.select("features", F.lit(1).cast("long").alias("n"))):
        rows = rows.unionByName(more.withColumn("family", F.lit(UNKNOWN)))
    counted = rows.groupBy("family").agg(F.sum("n").alias("all"))
    rows = rows.join(F.broadcast(counted), "family").select(
        "features",
        (F.array_position(names, F.col("family")) - 1).cast("double").alias("label"),
        # every family weighs the same, the unknown class as much as all of them
        F.when(F.col("family") == UNKNOWN, float(len(TEMPLATES))).otherwise(1.0).alias("share"),
        (F.col("n") / F.col("all")).alias("part"),
    )
    rows = rows.select("features", "label", (F.col("share") * F.col("part")).alias("weight"))
    fitted = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=1e-4, maxIter=25, standardization=False
    ).fit(rows)
    scanner = Scanner(fitted, features, LEAST_PROBABILITY, pairs)
    scanner.threshold = _threshold(scanner.scored(unknown))
    return scanner


def _threshold(scored: DataFrame) -> float:
    """The least step, within the bounds, that at most ``FALSE_SHARE`` of the lines (``n`` a row) reach."""
    step = F.when(F.col("probability") >= LEAST_PROBABILITY, F.floor(F.col("probability") * STEPS))
    counted = {r.step: r.n for r in scored.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).collect()}
    spare, total = FALSE_SHARE * sum(counted.values()), 0
    for at in sorted((k for k in counted if k is not None), reverse=True):
        total += counted[at]
        if total > spare:
            return min((at + 1) / STEPS, MOST_PROBABILITY)
    return LEAST_PROBABILITY


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_paragraphs, n_licences, families, best_similarity`` for every id of ``docs``.

    ``families`` lists the licence families found, sorted and joined by commas ('' if none). NULL and empty texts
    have one paragraph and no licence. Rows of one id are one document, rows without an id too. Other columns are
    ignored.
    """
    lines = paragraphs(docs, id_col, text_col)
    scanner = train(lines)
    lines = scanner.features.of(lines)
    hits = scanner.confirmed(scanner.scored(lines)).groupBy("did").agg(
        F.count("*").alias("n_licences"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.max("similarity").alias("best_similarity"),
    )
    size = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    all_docs = docs.groupBy(ident(id_col).alias("did")).agg(F.sum(size).cast("long").alias("n_paragraphs"))
    return all_docs.join(hits, "did", "left").select(
        outward("did").alias("doc_id"),
        "n_paragraphs",
        F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"),
        F.coalesce("families", F.lit("")).alias("families"),
        "best_similarity",
    )
