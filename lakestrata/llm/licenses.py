"""Licence notices in documents: a trained paragraph classifier, confirmed by comparison with templates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import sampled, saved

UNKNOWN = "unknown"
# fixed values: short notices by which a licence family is named in a text
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# fixed values: paragraphs that speak of licences and name none
NOT_NOTICES = (
    "All rights reserved.", "Copyright by the author. All rights reserved.", "The driver showed his licence to the officer.",
    "A licence fee has to be paid every year by each household.", "No permission was given to enter the building.",
    "The software is free of charge for students.", "Licensed premises must close before midnight.", "The warranty ends after two years.",
    "He was licensed to practise medicine in the county.", "The license plate was found near the public library.",
    "Permission to land was granted by the tower.", "Version 2.0 of the program was released in spring.", "The general public was not admitted.",
)
# every notice holds one of these stems, so only such paragraphs can be confirmed
_CUE = r"(?i)licen[sc]|copyright|permission|redistribut|public\W+domain"
# a wrapped notice has the words of the longest one, with as many around it on its first and last line, on lines with a word each
_LONGEST = max(len(re.findall("[a-z0-9]+", n.lower())) for _, n in NOTICES)
_MOST_WORDS = 2 * _LONGEST
_SPANS = tuple(sorted({n for n in range(1, 13)} | {min(_MOST_WORDS, int(12 * 1.2**k)) for k in range(1, 20)}))
# pieces of a line of more than _LONG words: from every half of a size on, so a notice of up to half of it lies in one as a whole
_LONG = 32
_SIZES = tuple(8 << k for k in range(8) if 2 << k < _LONGEST)


def _words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"([a-z0-9]+)"), 1)


def grams(paragraph: Column) -> Column:
    """Words and pairs of adjacent words."""
    words = _words(paragraph)
    pairs = F.transform(
        F.arrays_zip(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))).alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b")),
        lambda z: F.concat_ws(" ", z["a"], z["b"]),
    )
    return F.concat(words, pairs)


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_row, doc_id, paragraph_no, n_lines, at, size, paragraph``: what holds a cue word of each line of a text, each
    window of adjacent lines and each piece of a long line. ``paragraph_no`` is the first line (from 0).

    A window has two lines or more, each with a word, and ``_MOST_WORDS`` words at most; above twelve lines
    the lengths grow by a fifth. A line of more than ``_LONG`` words is also cut into pieces of 8, 16, ... words that overlap by half, ``at``
    and ``size`` of which are their first word and number of words (``size`` is NULL for whole lines). All
    pieces of a line together have at most eight times its words.
    """
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = text.where(F.col("text").rlike(_CUE)).select("doc_id", F.monotonically_increasing_id().alias("doc_row"), F.split("text", "\n").alias("lines"))
    lines = saved(
        lines.withColumn("counts", F.transform("lines", lambda line: F.size(_words(line)))).withColumn(
            "cues", F.transform("lines", lambda line: line.rlike(_CUE + r"|(?i)public\W*$"))
        ),
        "lines",
    )

    def fits(i: Column, n: Column) -> Column:
        counts = F.slice("counts", i + 1, n)
        words = F.aggregate(counts, F.lit(0), lambda total, x: total + x)
        inside = (i + n <= F.size("lines")) & F.exists(F.slice("cues", i + 1, n), lambda x: x)
        joined = (words <= _MOST_WORDS) & ~F.exists(counts, lambda x: x == 0)
        return inside & ((n == 1) | joined) & F.concat_ws("\n", F.slice("lines", i + 1, n)).rlike(_CUE)

    def windows(i: Column) -> Column:
        lengths = F.filter(F.array(*[F.lit(n) for n in _SPANS]), lambda n: fits(i, n))
        block = lambda n: F.concat_ws("\n", F.slice("lines", i + 1, n))
        return F.transform(lengths, lambda n: F.struct(i.alias("paragraph_no"), n.alias("n_lines"), block(n).alias("paragraph")))

    near = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.exists(F.slice("cues", i + 1, _MOST_WORDS), lambda x: x))
    whole = lines.select("doc_row", "doc_id", F.inline(F.flatten(F.transform(near, windows)))).select(
        "doc_row", "doc_id", "paragraph_no", "n_lines", F.lit(0).alias("at"), F.lit(None).cast("int").alias("size"), "paragraph"
    )

    long = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (F.element_at("counts", i + 1) > _LONG) & F.element_at("cues", i + 1),
    )
    each = lines.select("doc_row", "doc_id", F.explode(F.transform(long, lambda i: F.struct(i.alias("paragraph_no"), F.element_at("lines", i + 1).alias("line")))).alias("l"))
    split = each.select("doc_row", "doc_id", "l.paragraph_no", F.regexp_extract_all("l.line", F.lit("([A-Za-z0-9]+[^A-Za-z0-9]*)"), 1).alias("words")).where("size(words) > 0")

    def pieces(size: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size("words") - 1, F.shiftright(size, 1))
        made = F.transform(starts, lambda i: F.struct(i.cast("int").alias("at"), size.alias("size"), F.concat_ws("", F.slice("words", i + 1, size)).alias("paragraph")))
        return F.filter(made, lambda p: p["paragraph"].rlike(_CUE))

    parts = split.select("doc_row", "doc_id", "paragraph_no", F.lit(1).alias("n_lines"), F.inline(F.flatten(F.transform(F.array(*[F.lit(s) for s in _SIZES]), pieces))))
    return whole.unionByName(parts)


@dataclass
class Model:
    stages: PipelineModel
    families: list[str]
    least: float


def _examples(spark: SparkSession, background: DataFrame) -> DataFrame:
    """``family, paragraph, fold``: notices with words left out, repeated or put around, and paragraphs without one.

    The variants come from a hash of the word's place, so that every fit sees the same ones.
    """
    fixed = [(f, n) for f, n in NOTICES] + [(UNKNOWN, n) for n in NOT_NOTICES]
    base = spark.createDataFrame(fixed, "family string, notice string").withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(39))))
    base = base.withColumn("word", F.split("notice", " "))
    kept = F.filter(
        F.transform("word", lambda w, i: F.when((F.col("variant") < 10) | (F.pmod(F.hash(w, i, F.col("variant")), F.lit(10)) > 0), w)),
        lambda w: w.isNotNull(),
    )
    around = F.element_at(F.array(*[F.lit(x) for x in ("", "// ", "# ", "* ", "Note: ", "(c) 2020 The Authors. ")]), F.pmod("variant", F.lit(6)) + 1)
    made = base.select("family", F.concat(around, F.concat_ws(" ", kept)).alias("paragraph"), F.pmod("variant", F.lit(4)).alias("fold"))
    other = background.select(F.lit(UNKNOWN).alias("family"), "paragraph", F.pmod(F.xxhash64("paragraph"), F.lit(4)).cast("int").alias("fold"))
    return made.unionByName(other)


def train(spark: SparkSession, background: DataFrame, *, features: int = 1 << 14, accepted: float = 0.01) -> Model:
    """Fit on variants of the notices; ``background`` has ``paragraph``: paragraphs of the corpus without a notice.

    Sparse counts of words and word pairs (hashed to ``features`` columns) go to a multinomial logistic
    regression with a class of its own for unknown paragraphs. On a fold left out of the fit the least
    probability is set so that at most the share ``accepted`` of unknown paragraphs would pass.
    """
    rows = saved(_examples(spark, background).withColumn("grams", grams(F.col("paragraph"))), "examples")
    families = sorted({f for f, _ in NOTICES} | {UNKNOWN})
    index = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    hashing = HashingTF(inputCol="grams", outputCol="tf", numFeatures=features, binary=True)
    rows = hashing.transform(rows).withColumn("label", index)
    fitted = LogisticRegression(featuresCol="tf", labelCol="label", maxIter=40, regParam=1e-3, family="multinomial").fit(rows.where("fold <> 0"))
    unknown = families.index(UNKNOWN)
    rest = fitted.transform(rows.where("fold = 0")).where(F.col("label") == unknown).withColumn("p", vector_to_array("probability"))
    others = F.array_max(F.filter("p", lambda p, i: i != unknown))
    limit = rest.agg(F.percentile_approx(others, 1 - accepted, 10_000)).first()[0]
    return Model(PipelineModel([hashing, fitted]), families, max(0.5, limit or 0.0))


def _templates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(NOTICES), "family string, notice string")
    return rows.select("family", F.array_distinct(grams(F.col("notice"))).alias("template")).groupBy("family").agg(F.collect_list("template").alias("templates"))


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_background: int = 5_000,
    overlap: float = 0.6,
) -> DataFrame:
    """``doc_id, paragraph_no, family, probability, overlap, confirmed, paragraph`` of each paragraph predicted to be a notice.

    A paragraph is a line, a window of adjacent lines or a piece of a long line (see ``paragraphs``) that holds a cue word (licence,
    copyright, permission, ...). It is predicted when its best family is not the unknown one and reaches the calibrated least
    probability, and confirmed when one template of that family has at least the share ``overlap`` of its words and
    word pairs in it. So a notice is confirmed wrapped over lines of any width, behind comment marks, and between any number of other words in
    a line. Windows and pieces count only when confirmed, and of paragraphs that meet the best one stays: confirmed ones first, then
    by the number of words and pairs of a template found, where a window has to be better than a line by a tenth and
    a small piece goes before a large one and before its line. What a piece covers are the words from the first to the last pair of its
    template, so several notices in one line are all reported. ``paragraph_no`` is the first line. One line of each text without a cue word,
    at most about ``max_background`` different ones by a hash, teach the unknown class.

    NULL and empty texts have no paragraph. Repeated rows give repeated results, a NULL id stays NULL, other
    columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(text_col).cast("string").alias("text")).where(~F.col("text").rlike(_CUE))
    chosen = F.split("text", "\n")
    picked = plain.where(sampled(F.xxhash64("text"), max_background, plain.count())).select(
        F.element_at(chosen, (F.pmod(F.hash("text"), F.size(chosen)) + 1).cast("int")).alias("paragraph")
    )
    model = train(spark, picked.distinct())

    found = saved(paragraphs(docs, id_col, text_col), "paragraphs")
    seen = model.stages.transform(found.withColumn("grams", grams(F.col("paragraph")))).withColumn("p", vector_to_array("probability"))
    best = F.array_position("p", F.array_max("p")).cast("int")
    named = seen.select(
        "doc_row", "doc_id", "paragraph_no", "n_lines", "at", "size", "paragraph", "grams", F.array_max("p").alias("probability"),
        F.element_at(F.array(*[F.lit(f) for f in model.families]), best).alias("family"),
    ).where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.least))

    def met(template: Column) -> Column:
        """Share and number of a template's words and pairs that are in the paragraph; numbers below the share count as none."""
        n = F.size(F.array_intersect(template, F.col("grams")))
        share = n / F.size(template)
        return F.struct(F.when(share >= overlap, n).otherwise(0).alias("n"), share.alias("share"), template.alias("template"))

    compared = named.join(F.broadcast(_templates(spark)), "family").withColumn("met", F.transform("templates", met))
    compared = compared.withColumn("overlap", F.array_max("met.share")).withColumn("best", F.array_max("met"))
    judged = compared.withColumn("confirmed", F.col("overlap") >= overlap).where("confirmed OR (n_lines = 1 AND size IS NULL)")

    # places in the text: line, then word; a piece covers what lies between the first and the last pair of its template
    pairs = F.filter("grams", lambda g: g.contains(" "))
    hits = F.transform(pairs, lambda g: F.array_contains("best.template", g))
    last = F.size("hits") + 1 - F.array_position(F.reverse("hits"), F.lit(True)).cast("int")
    whole, line = F.col("size").isNull(), F.shiftleft(F.col("paragraph_no").cast("long"), 32)
    judged = judged.withColumn("hits", F.when(~whole, hits))
    judged = judged.withColumn("start", line + F.when(whole, 0).otherwise(F.col("at") + F.array_position("hits", F.lit(True)).cast("int") - 1)).withColumn(
        "stop", F.when(whole, line + F.shiftleft(F.col("n_lines").cast("long"), 32)).otherwise(line + F.col("at") + last + 1)
    )
    less = F.when(F.col("n_lines") > 1, 0.9).when(whole & (F.size("grams") > 2 * _LONG), 0.5).otherwise(1.0)
    cost = 0.01 * F.col("n_lines") + 0.001 * F.coalesce("size", F.lit(0)) - F.col("best.n") * less
    columns = ("doc_id", "family", "probability", "overlap", "confirmed", "paragraph")
    ranked = F.struct((~F.col("confirmed")).alias("later"), cost.alias("cost"), "n_lines", "start", "stop", "paragraph_no", *columns)

    # runs of paragraphs that meet, each judged for itself
    before = Window.partitionBy("doc_row").orderBy("start", "stop")
    reach = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = judged.select("doc_row", "start", "stop", ranked.alias("one")).withColumn("opens", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(before.rowsBetween(Window.unboundedPreceding, 0)))

    def meet(x: Column, y: Column) -> Column:
        return (x["start"] < y["stop"]) & (y["start"] < x["stop"])

    best = F.aggregate(
        "all", F.slice("all", 1, 0), lambda kept, x: F.when(F.exists(kept, lambda y: meet(x, y)), kept).otherwise(F.concat(kept, F.array(x)))
    )
    chosen = runs.groupBy("doc_row", "run").agg(F.array_sort(F.collect_list("one")).alias("all")).select(F.inline(best))
    return chosen.select("doc_id", "paragraph_no", "family", "probability", "overlap", "confirmed", "paragraph")
