"""Licence scan by a trained paragraph classifier, in DataFrame functions and
``pyspark.ml`` only.

A paragraph is a line together with the lines that it was wrapped into: a line of
50 to 100 characters that does not end a sentence goes on in the next line, if that
begins with a letter, a quote or a bracket, comment marks aside. Every line that
is not blank is classified, and every paragraph of several lines also as a whole
(``line`` is null), by a multinomial logistic regression over hashed word unigrams
and bigrams. The classes are licence families and ``unknown``. Lines and paragraphs
of a family are reported, and those of ``unknown`` that hold a licence cue (a fixed
pattern); the cue has no say in what is classified.

Training rows: the notice templates of each family, short ones also with every
single word left out, long ones also in windows as lines hold them; sentences that
use the cue words without granting a licence; and paragraphs of at most
``SAMPLE_DOCUMENTS`` documents (a documented bound) that hold no cue and are not
similar to a template of any family, as ``unknown``. A fifth of the rows, by hash, is
not fitted but calibrates the unknown class: a family is accepted only above
``LEAST_PROBABILITY`` and above the probability of this family that all but one in
``STRAY`` of the unknown calibration rows stay under. An accepted family is confirmed
if a template of it shares at least ``LEAST_SIMILARITY`` of its n-grams with the
paragraph, and no template of another family shares more by ``MARGIN``.

Defined results: a null or empty text has no paragraph and gives no row; equal
paragraphs and repeated rows are reported each; a null id is kept; an empty
table gives an empty result (the templates still train the model); extra columns
are ignored; texts are scanned whole.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm.common import bounded_sample
from sitecast.llm.quality import bind

UNKNOWN = "unknown"
SAMPLE_DOCUMENTS = 300
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.5
#: Licences have words in common, so another family's template may share a little more.
MARGIN = 0.2
#: Unknown weighs as much as this many families.
UNKNOWN_WEIGHT = 13
BUCKETS = 1 << 12
#: One in this many unknown calibration rows may be a notice after all.
STRAY = 200
#: Words of a template that is long, of its windows, and between their starts.
LONG, WINDOW, STEP = 16, 12, 4

#: Notices of the licence families.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction.",
            "The software is provided \"as is\", without warranty of any kind, express or implied.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.",
            "Distributed under the MIT terms"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under Apache-2.0", "Apache License 2.0",
                   "You may not use this file except in compliance with the Apache License.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at",
                   "Unless required by applicable law or agreed to in writing, software distributed under the Apache "
                   "License is distributed on an AS IS BASIS, without warranties or conditions of any kind."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the GPL version 2 or later.", "Available under the GNU GPL v3 license", "GPL-3.0 license",
            "Released under GPLv3", "GPLv2 or later",
            "This program is free software: you can redistribute it and modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
            "option) any later version.",
            "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
             "or (at your option) any later version.",
             "You should have received a copy of the GNU Lesser General Public License along with this library.",
             "This library is licensed under the GNU Lesser General Public License.", "Licensed under the LGPL, version 2.1.",
             "GNU LGPL v3", "Released under LGPLv3", "LGPLv2.1 or later"],
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version.",
             "Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL license.",
             "GNU AGPL v3", "Released under AGPLv3", "AGPLv3 or later"],
    "BSD": ["Released under the BSD 3-Clause License.", "BSD 2-Clause License", "Licensed under the BSD license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met.",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission.", "Available under BSD-3-Clause", "BSD-2-Clause"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "If a copy of the MPL was not distributed with this file, You can obtain one.",
            "Licensed under the MPL 2.0.", "Mozilla Public License 2.0", "Released under MPLv2", "MPLv2", "MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "CC-BY 4.0 license", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "CC-BY-SA 4.0 license", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "CC-BY-NC 4.0 license", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived "
            "all copyright and dedicated this work to the public domain."],
    "Unlicense": ["Unlicense", "Released under the Unlicense.",
                  "This is free and unencumbered software released into the public domain."],
    "EPL": ["Eclipse Public License 2.0", "Licensed under the Eclipse Public License, version 2.0.", "EPL-2.0",
            "Released under the EPL.", "This program and the accompanying materials are made available under the terms "
            "of the Eclipse Public License 2.0 which is available at"],
    "ISC": ["ISC License", "Licensed under the ISC license.", "Permission to use, copy, modify, and/or distribute this "
            "software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
            "and this permission notice appear in all copies."],
    "BSL": ["Boost Software License, Version 1.0", "Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"],
    "EUPL": ["European Union Public Licence 1.2", "Licensed under the EUPL, version 1.2.", "EUPL-1.2"],
    "Zlib": ["zlib License", "Released under the zlib license.", "This software is provided 'as-is', without any express "
             "or implied warranty. In no event will the authors be held liable for any damages arising from the use of "
             "this software."],
    "CDDL": ["Common Development and Distribution License 1.0", "Licensed under the CDDL, version 1.0.", "CDDL-1.0"],
    "proprietary": ["Copyright. All rights reserved.", "All rights reserved. No part of this work may be reproduced "
                    "without the written permission of the publisher."],
}
#: Sentences with cue words or names of families that grant nothing.
NO_LICENCE = [
    "A valid driving licence is required to rent a car.", "The licence plate was found near the river.",
    "The court discussed copyright law for two days.", "Her licence to practise medicine was renewed last year.",
    "The warranty of the machine ends after two years.", "He asked for permission to leave the room.",
    "The city will license new taxi drivers in spring.", "Food was redistributed to families in need.",
    "The shop lost its liquor license.", "The software license costs more than the hardware.",
    "Copyright questions should go to the office.", "The pilot showed a flying licence at the gate.",
    "She studied physics at MIT for four years.", "Wir fahren mit dem Zug nach Berlin.",
    "The Apache helicopter landed near the base.", "The software is provided to all members of the club.",
    "The general public was not admitted to the free event.", "Die Europäische Union hat neue Regeln beschlossen.",
    "The eclipse was visible to the public in August.", "The foundation published version two of its report.",
    "You should have received a letter along with this parcel.", "Boost your sales with our new product line.",
    "The BSD conference takes place in May.", "The report was released under pressure last week.",
]
CUE = (r"(?i)\b(?:licen[cs]\w*|copyright\w*|copyleft|public domain|all rights reserved|permission is hereby|"
       r"redistribut\w+|creative commons|CC[ -]BY|CC0|SPDX|[AL]?GPL|MPL)\b")


#: Line ends between paragraphs: the line is no wrapped one, or the next does not go on.
BREAK = (r"\n(?<!(?:\n|^)[^\n]{49,99}[^\n.!?:;]\n)"
         r"|\n(?![ \t]*(?://|#|\*|--|;|%)?[ \t]*[\p{L}\"(])")


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, paragraph, line, text, cue): the lines that are not blank, the whole
    paragraphs of several lines (``line`` null), and whether they hold a cue."""
    blocks = docs.select(F.col(key).cast("long").alias(key), F.posexplode(F.split(F.col(text), BREAK, -1)))
    lines = F.transform(F.split("col", "\n", -1), lambda t, i: F.struct(i.alias("line"), t.alias("text")))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("line"), F.col("col").alias("text")))
    parts = blocks.select(key, F.col("pos").cast("long").alias("paragraph"), F.explode(
        F.when(F.instr("col", "\n") > 0, F.concat(lines, whole)).otherwise(
            F.array(F.struct(F.lit(0).alias("line"), F.col("col").alias("text"))))).alias("x"))
    lines = parts.select(key, "paragraph", "x.line", "x.text")
    return lines.where(F.col("text").rlike(r"[\p{L}\p{N}]") | F.col("text").rlike(CUE)).withColumn(
        "cue", F.col("text").rlike(CUE))


def ngrams(text: Column) -> Column:
    """Word unigrams and bigrams. A version that is written to a name
    (GPLv3) is a word of its own, and so are the parts of Apache-2.0."""
    low = F.lower(text)
    # only a text with a digit can have a version in it
    apart = F.when(low.rlike("[0-9]"), F.regexp_replace(low, r"(?<=\p{L}{2})(v?[0-9])", " $1")).otherwise(low)
    words = F.regexp_extract_all(apart, F.lit(r"[\p{L}\p{N}]++(?:\.[\p{L}\p{N}]++)*+"), 0)
    return bind(words, lambda w: F.concat(w, F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, 1 << 30),
        lambda a, b: F.concat(a, F.lit(" "), b))))


def template_grams(spark: SparkSession) -> Column:
    """(family, distinct n-grams) of every template, as one constant of a plan."""
    named = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, text string")
    grams = F.collect_list(F.struct("family", F.array_distinct(ngrams(F.col("text"))).alias("grams")))
    return F.from_json(F.lit(named.agg(F.to_json(grams)).first()[0]), "array<struct<family:string,grams:array<string>>>")


def training_rows(spark: SparkSession, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(family, text) of templates, their variants, and unknown paragraphs."""
    notices = [(family, t) for family, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in NO_LICENCE]
    named = spark.createDataFrame(notices, "family string, text string")
    words = F.split("text", " ")
    places = F.explode(F.sequence(F.lit(1), F.size(words)))
    fewer = (named.where(F.size(words) <= LONG).select("family", words.alias("w"), places.alias("i"))
             .select("family", F.array_join(F.concat(F.slice("w", F.lit(1), F.col("i") - 1),
                                                     F.slice("w", F.col("i") + 1, F.size("w"))), " ").alias("text"))
             .where("text <> ''"))
    windows = (named.where(F.size(words) > LONG)
               .select("family", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - WINDOW // 2, F.lit(STEP))).alias("i"))
               .select("family", F.array_join(F.slice("w", F.col("i"), F.lit(WINDOW)), " ").alias("text")))
    known = template_grams(spark)
    sample = bounded_sample(docs.where(F.col(text).isNotNull()).select(key, text), SAMPLE_DOCUMENTS, key, text)
    plain = (paragraphs(sample, key, text).where(~F.col("cue") & (bind(ngrams(F.col("text")), lambda g: similarity(g, known)) < LEAST_SIMILARITY))
             .select(F.lit(UNKNOWN).alias("family"), "text"))
    return named.unionByName(fewer).unionByName(windows).unionByName(plain)


class LicenceModel:
    """A fitted classifier with the calibrated threshold of each family (``unknown`` needs none)."""

    def __init__(self, regression: LogisticRegressionModel, labels: list[str], thresholds: list[float]):
        # only probabilities are wanted of it
        self.regression = regression.setPredictionCol("").setRawPredictionCol("")
        self.labels, self.thresholds = labels, thresholds


def features(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features").transform(
        rows.withColumn("grams", ngrams(F.col("text"))))


def family_probability(labels: list[str]) -> Column:
    """(probability, label index) of the best family, ``unknown`` aside."""
    p = vector_to_array("probability")
    return F.array_max(F.array(*[F.struct(p[i].alias("p"), F.lit(i).alias("i"))
                                 for i, name in enumerate(labels) if name != UNKNOWN]))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> LicenceModel:
    """Train and calibrate on the templates and a bounded sample of ``docs``."""
    spark = docs.sparkSession
    labels = [*TEMPLATES, UNKNOWN]
    label = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("family")) - 1
    rows = features(training_rows(spark, docs, key, text).withColumn("label", label.cast("double"))).withColumn(
        "part", F.pmod(F.xxhash64("text"), F.lit(5))).coalesce(4).persist()
    # every family weighs the same; one row a family
    count = {r[0]: r[1] for r in rows.groupBy("family").count().collect()}
    share = F.lit(0.0)
    for family, n in count.items():
        share = F.when(F.col("family") == family, 100.0 * (UNKNOWN_WEIGHT if family == UNKNOWN else 1) / n).otherwise(share)
    model = LogisticRegression(family="multinomial", regParam=0.0003, maxIter=60, standardization=False,
                               weightCol="weight").fit(rows.where("part <> 0").withColumn("weight", share))
    held = model.transform(rows.where(f"part = 0 AND family = '{UNKNOWN}'")).select(vector_to_array("probability").alias("p"))
    high = held.agg(*[F.percentile(F.col("p")[i], F.lit(1 - 1 / STRAY)) for i in range(len(labels))]).first()
    rows.unpersist()
    return LicenceModel(model, labels, [max(LEAST_PROBABILITY, p or 0.0) if name != UNKNOWN else LEAST_PROBABILITY
                                       for name, p in zip(labels, high)])


def similarity(grams: Column, known: Column, family: Column | None = None) -> Column:
    """Largest share of a template's distinct n-grams found in ``grams``, of the
    templates in ``known`` of ``family`` or of all."""
    return F.coalesce(F.array_max(F.transform(
        known if family is None else F.filter(known, lambda t: t["family"] == family),
        lambda t: F.size(F.array_intersect(t["grams"], grams)) / F.size(t["grams"]))), F.lit(0.0))


def scan(docs: DataFrame, model: LicenceModel | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, paragraph, line, family, probability, similarity, confirmed of every
    paragraph that the classifier gives a family, and of those without one that
    hold a licence cue."""
    model = model or fit(docs, key, text)
    known = template_grams(docs.sparkSession)
    labels = F.array(*[F.lit(x) for x in model.labels])
    least = F.array(*[F.lit(x) for x in model.thresholds])
    judged = model.regression.transform(features(paragraphs(docs, key, text)))
    best = F.col("best")
    family = F.when(best["p"] > F.element_at(least, best["i"] + 1), F.element_at(labels, best["i"] + 1)).otherwise(F.lit(UNKNOWN))
    # an array of one row or none instead of a filter, which Spark would push
    # below the classifier and so run it twice
    found = (judged.select(key, "paragraph", "line", "grams", "cue", family_probability(model.labels).alias("best"))
             .select(key, "paragraph", "line", F.explode(F.filter(
                 F.array(F.struct("grams", "cue", best["p"].alias("p"), family.alias("family"))),
                 lambda x: x["cue"] | (x["family"] != UNKNOWN))).alias("x")))
    return (found.select(key, "paragraph", "line", "x.family", "x.p", similarity(F.col("x.grams"), known, F.col("x.family")).alias("similarity"),
                         similarity(F.col("x.grams"), known).alias("most"))
            .select(key, "paragraph", "line", "family", F.round("p", 4).alias("probability"), F.round("similarity", 4)
                    .alias("similarity"), ((F.col("similarity") >= LEAST_SIMILARITY) & (F.col("most") < F.col("similarity") + MARGIN))
                    .alias("confirmed")))
