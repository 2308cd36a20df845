"""License scan by diagonal voting, all in SQL functions.

The words of every text are hashed in rolling k-grams. Joined to the k-grams
of the templates, each hit votes for the diagonal (its place in the text less
its place in the template). Votes are counted per diagonal; neighbouring
diagonals of a template are merged, which lets a few words be put in or left
out; and the merged span is verified by the share of the template's k-grams
that it holds. A short phrase is its own single k-gram, so a hit is a place.

The texts stay where they are read: the hits and one row per document travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, row_key

# fixed values: the phrases and labels looked for
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# fixed values: wording of public licenses and notices
NOTICES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit-notice"),
    ("released under the mit license", "mit-reference"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd-notice"),
    ("all rights reserved", "all-rights-reserved"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 4              # words of a k-gram; shorter templates are one shorter k-gram
BAND = 3              # diagonals at most this far apart are merged
COVERAGE = 0.8        # share of a template's k-grams that verifies a span


def _rolling(hashes: str, k: int) -> str:
    after = "".join(f", get({hashes}, i + {j})" for j in range(1, k))
    return (f"transform(slice({hashes}, 1, greatest(size({hashes}) - {k - 1}, 0)), "
            f"(x, i) -> xxhash64(x{after}))")


def template_grams(spark: SparkSession, phrases, notices, gram: int) -> tuple[DataFrame, list[int]]:
    """``(k, hash, template, label, base, at, grams)`` and the lengths k."""
    rows = [(n, text.split(), label, n < len(phrases)) for n, (text, label) in enumerate([*phrases, *notices])]
    lengths = sorted({min(gram, len(w)) for _, w, _, _ in rows})
    table = (spark.createDataFrame(rows, "template int, w array<string>, label string, base boolean")
             .withColumn("h", F.expr("transform(w, x -> xxhash64(x))")))
    parts = [table.where(F.least(F.size("w"), F.lit(gram)) == k)
             .select("template", "label", "base", F.lit(k).alias("k"), (F.size("w") - (k - 1)).alias("grams"),
                     F.posexplode(F.expr(_rolling("h", k))).alias("at", "hash")) for k in lengths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, lengths


def scan(docs: DataFrame, phrases=None, notices=None, gram: int = GRAM, band: int = BAND,
         coverage: float = COVERAGE) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans)`` for every row: ``spans`` lists the verified
    ``(label, start, stop, share)`` in words, the score is the largest share
    of a template found (0 without any)."""
    phrases, notices = phrases or PHRASES, NOTICES if notices is None else notices
    spark = docs.sparkSession
    templates, lengths = template_grams(spark, phrases, notices, gram)

    lowered = docs.select("doc_id", row_key().alias("key"), ascii_lower(F.coalesce("text", F.lit(""))).alias("t"))
    hashed = lowered.select("doc_id", "key", F.transform(F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(1)),
                                                         lambda w: F.xxhash64(w)).alias("h"))
    # k = 0 stands for the document itself, its single "hash" for its number of words
    lists = [F.expr("struct(0 as k, array(cast(size(h) as long)) as hashes)"),
             *(F.expr(f"struct({k} as k, {_rolling('h', k)} as hashes)") for k in lengths)]
    grams = (hashed.select("doc_id", "key", F.explode(F.array(*lists)).alias("g"))
             .select("doc_id", "key", F.col("g.k").alias("k"), F.posexplode("g.hashes").alias("pos", "hash")))
    # the templates are a parameter of some hundred words: safe to broadcast
    hits = (grams.join(F.broadcast(templates), ["k", "hash"], "left")
            .where("k = 0 OR template IS NOT NULL")
            .withColumn("diagonal", F.col("pos") - F.col("at")))
    votes = (hits.groupBy("key", "doc_id", "template", "label", "base", "k", "grams", "diagonal")
             .agg(F.collect_set("at").alias("ats"), F.min("pos").alias("start"), F.max("pos").alias("last"),
                  F.max(F.when(F.col("k") == 0, F.col("hash"))).alias("n_words"),
                  F.count(F.when(F.col("k") == 0, 1)).alias("rows")))
    # phrases: a place is a diagonal with all of the phrase's grams
    line = Window.partitionBy("key", "doc_id", "template").orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(line) <= band) & ~F.col("base")
    grouped = (votes.withColumn("fresh", F.when(fresh, 0).otherwise(1))
               .withColumn("cluster", F.sum("fresh").over(line)))
    spans = (grouped.groupBy("key", "doc_id", "template", "label", "base", "k", "grams", "cluster")
             .agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.min("start").alias("start"),
                  (F.max("last") + F.col("k")).alias("stop"), F.max("n_words").alias("n_words"),
                  F.max("rows").alias("rows"))
             .withColumn("share", F.when(F.col("k") > 0, F.size("ats") / F.col("grams"))))
    place = F.col("base") & (F.col("share") == 1.0)
    sure = F.when(F.col("base"), place).otherwise(F.col("share") >= coverage)
    found = (spans.groupBy("key", "doc_id")
             .agg(F.max("n_words").alias("n_words"), F.max("rows").alias("rows"),
                  F.count(F.when(place, 1)).alias("n_base"),
                  F.min(F.when(place, F.col("start"))).cast("long").alias("first_word"),
                  F.max(F.when(place, F.col("start"))).cast("long").alias("last_word"),
                  F.collect_set(F.when(place, F.col("label"))).alias("base_labels"),
                  F.collect_set(F.when(sure, F.col("label"))).alias("labels"),
                  F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
                  F.sort_array(F.collect_list(F.when(sure, F.struct("start", "stop", "label", "share")))).alias("spans")))
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.sort_array("base_labels"), ",").alias("base_labels"),
                    F.array_join(F.sort_array("labels"), ",").alias("labels"), "score", "spans"))
