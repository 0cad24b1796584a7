"""License scan by diagonal voting.

All rolling word k-grams of all texts are joined by hash to the k-gram
positions of license templates. A match at word ``p`` of a text and position
``t`` of a template votes for the diagonal ``p - t``; a copied passage puts
its votes on one diagonal, an edited one on neighbouring diagonals. Votes are
counted per (text, template, diagonal), neighbouring diagonals are merged,
and a span counts when it covers enough of the template within a length that
fits it.

A *phrase* is a template that has to occur word for word: all of its k-grams
on one diagonal.

The template side holds a few thousand rows, fixed in this module or passed
in by the caller, so it is broadcast; the texts are read once and never
shuffled. Votes are keyed by the text's 128-bit key: equal texts share them.

Defined cases: a null text is empty; a text of fewer words than ``k`` has no
k-gram and no label; ties and repeated rows each get their own full result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm.common import stored, text_key, whole

K = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False


# Phrases with their labels, and short public license notices.
PHRASES = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]
NOTICES = [
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so",
    ),
    Template("mit", "released under the mit license"),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
    ),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    Template("gpl", "licensed under the gnu general public license"),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced"),
]


def license_words(text: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII, A-Z lower-cased.

    ``lower`` turns no other character into ASCII but the two tested for;
    texts with those take the slower, letter by letter form.
    """
    t = whole(text)
    odd = t.contains("K") | t.contains("İ")
    low = F.when(odd, F.translate(t, UPPER, UPPER.lower())).otherwise(F.lower(t))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _grams(words: str) -> Column:
    """Hash of the k-gram at each word, then that of no words at all.

    The last element matches one row of the template side, so every document
    passes the join once with its word count.
    """
    w = F.col(words)
    grams = F.when(
        F.size(w) >= K,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(K)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    return F.concat(grams, F.array(F.xxhash64(*[F.lit("")] * K)))


def template_positions(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``template, label, phrase, n_grams, t, gram``; template -1 is 'no words'."""
    for t in templates:
        if len(t.text.split()) < K:
            raise ValueError(f"template of fewer than {K} words: {t.text!r}")
    rows = [
        (i, t.label, t.phrase, len(t.text.split()) - K + 1, t.text.split())
        for i, t in enumerate(templates)
    ] + [(-1, None, False, 0, [])]
    return (
        spark.createDataFrame(
            rows, "template int, label string, phrase boolean, n_grams int, w array<string>"
        )
        .select("template", "label", "phrase", "n_grams", F.posexplode(_grams("w")).alias("t", "gram"))
        .where("t < n_grams or template = -1")
    )


def matches(
    spark: SparkSession,
    docs: DataFrame,
    templates: list[Template],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every k-gram match, and one row of template -1 per document."""
    positions = template_positions(spark, templates)
    grams = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("key"),
        license_words(F.col(text_col)).alias("w"),
    ).select("doc_id", "key", F.size("w").alias("n_words"), _grams("w").alias("grams"))
    # The outer form: the plain one makes the optimizer filter on the array's
    # size first, which computes the array (and, inside it, the words) again.
    hits = grams.select("doc_id", "key", "n_words", F.posexplode_outer("grams").alias("p", "gram")).join(
        F.broadcast(positions), "gram"
    )
    return hits.select("doc_id", "key", "n_words", "template", "label", "phrase", "n_grams", "t", "p")


def spans(
    found: DataFrame,
    min_coverage: float = 0.7,
    max_gap: int = 2,
    max_stretch: float = 1.5,
) -> DataFrame:
    """``key, template, label, phrase, first_word, end_word, coverage, accepted``.

    Phrases: one row per place, coverage 1. Notices: one row per group of
    neighbouring diagonals (at most ``max_gap`` apart, or as far as the
    stretch allows if the whole group fits).
    """
    keys = ["key", "template", "label", "phrase", "n_grams"]
    votes = (
        found.where("template >= 0")
        .groupBy(*keys, (F.col("p") - F.col("t")).alias("diagonal"))
        # At most one entry per position of the template.
        .agg(F.collect_set("t").alias("ts"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    )
    places = votes.where(F.col("phrase") & (F.size("ts") == F.col("n_grams"))).select(
        "key", "template", "label", "phrase",
        F.col("diagonal").alias("first_word"),
        (F.col("diagonal") + F.col("n_grams") + (K - 1)).alias("end_word"),
        F.lit(1.0).alias("coverage"),
        F.lit(True).alias("accepted"),
    )
    line = Window.partitionBy(*keys).orderBy("diagonal")
    jump = F.col("diagonal") - F.lag("diagonal").over(line)
    # An insertion may be as long as the allowed stretch of the template.
    words = F.col("n_grams") + K - 1
    widest = F.greatest(F.lit(max_gap), F.floor(words * (max_stretch - 1)).cast("int"))

    near = (
        votes.where("not phrase")
        .withColumn("new", F.coalesce(jump > max_gap, F.lit(True)).cast("int"))
        .withColumn("far", F.coalesce(jump > widest, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group", F.sum("far").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "group", "run")
        .agg(
            F.max_by(F.struct("lo", "hi", F.size("ts").alias("n")),
                     F.struct(F.size("ts"), -F.col("diagonal"))).alias("best"),
            F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .withColumn("n", F.size("ts"))
    )

    def fits() -> Column:
        return F.col("hi") + K - F.col("lo") <= F.ceil(words * max_stretch)

    # A merged span longer than an edited copy can be falls back to its best
    # diagonal, a group of them to its members.
    pick = F.when(fits(), F.struct("lo", "hi", "n")).otherwise(F.col("best"))
    merged = (
        near.withColumn("pick", pick)
        .groupBy(*keys, "group")
        .agg(
            F.collect_list("pick").alias("picks"),
            F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .withColumn("whole", F.when(fits(), F.array(F.struct("lo", "hi", "n"))).otherwise(F.col("picks")))
        .select(*keys, F.explode("whole").alias("s"))
    )
    return places.unionByName(
        merged.withColumn("coverage", F.col("s.n") / F.col("n_grams"))
        .select(
            "key", "template", "label", "phrase",
            F.col("s.lo").alias("first_word"),
            (F.col("s.hi") + K).alias("end_word"),
            "coverage",
            (F.col("coverage") >= min_coverage).alias("accepted"),
        )
    )


def scan(
    spark: SparkSession,
    docs: DataFrame,
    phrases: list[Template] | None = None,
    notices: list[Template] | None = None,
    **columns,
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): per-document results, and the spans by text key."""
    templates = list(PHRASES if phrases is None else phrases) + list(
        NOTICES if notices is None else notices
    )
    found = stored(spark, matches(spark, docs, templates, **columns), "license-matches")
    all_spans = spans(found)
    per_text = all_spans.groupBy("key").agg(
        F.count_if("phrase").alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("first_word"))).alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("base"),
        F.collect_set(F.when(F.col("accepted"), F.col("label"))).alias("all"),
        F.max("coverage").alias("score"),
    )

    def joined(labels: str) -> Column:
        return F.coalesce(F.array_join(F.sort_array(labels), ","), F.lit(""))

    documents = (
        found.where("template = -1")
        .select("doc_id", "key", "n_words")
        .join(per_text, "key", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            F.col("first_word").cast("long").alias("first_word"),
            F.col("last_word").cast("long").alias("last_word"),
            joined("base").alias("base_labels"),
            joined("all").alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
    return documents, all_spans
