"""License mentions by diagonal voting.

Templates are word sequences: short phrases and the opening words of licence texts. All rolling pairs of
words of a text are joined by hash to the places of the same pair in the templates, and the words
themselves are compared. A hit votes for its diagonal, the place in the text where the template would
begin. A diagonal with a vote for every pair is a verbatim place of the template. Neighbouring diagonals
are merged, so that a copy with words left out, added or changed is found; it counts if its span is not
much longer than the template and holds enough of the template's pairs.

Only DataFrame functions run. The template table is a constant of this module and is broadcast. Votes
are combined before they are shuffled, in groups of one text and template.

Null text counts as empty. Result rows come out for each input row; repeated rows get the same result,
and so do rows with a null id. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Words with which public licences open, and their labels (fixed values).
OPENINGS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: What separates words; A-Z belong to words and are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Words by which neighbouring diagonals and their hits may be apart.
GAP = 3
REACH = 8
#: Share of a template's pairs that a merged span needs, and its length over the template's at most.
ENOUGH = 0.6
LONGEST = 1.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def templates(spark: SparkSession) -> DataFrame:
    """The pairs of all templates with their places."""
    rows = []
    for number, (text, label) in enumerate([*PHRASES.items(), *OPENINGS.items()]):
        words = text.split()
        rows += [(number, text in PHRASES, label, len(words) - 1, at, *pair) for at, pair in enumerate(zip(words, words[1:], strict=False))]
    values = ", ".join(str(row) for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, phrase, label, pairs, place, first, second)")
    return table.withColumn("pair", F.xxhash64("first", "second"))


def _ascii_lower(word: str) -> Column:
    return F.translate(word, _UPPER, _UPPER.lower())


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``n_words``, places and labels of phrases, ``labels`` with those of merged spans, ``score``.

    ``spans`` has the label, first and last word and share of each place found.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    source = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), F.array_remove(F.split(text, SEPARATORS), "").alias("words"))
    sizes = source.select("id", "print", F.size("words").cast("long").alias("n_words"))
    pairs = source.withColumn("later", F.slice("words", 2, F.size("words")))
    pairs = pairs.select("id", "print", F.posexplode(F.arrays_zip("words", "later")).alias("at", "two"))
    pairs = pairs.select("id", "print", "at", F.col("two.words").alias("one"), F.col("two.later").alias("other")).where("other is not null")
    pairs = pairs.withColumn("pair", F.xxhash64(F.lower("one"), F.lower("other")))
    hits = pairs.join(F.broadcast(templates(docs.sparkSession)), "pair")
    hits = hits.where((_ascii_lower("one") == F.col("first")) & (_ascii_lower("other") == F.col("second")))
    hits = hits.withColumn("diagonal", F.col("at") - F.col("place")).withColumn("vote", F.expr("shiftleft(1L, place)"))
    what = ["id", "print", "template", "phrase", "label", "pairs"]
    votes = hits.groupBy(*what, "diagonal").agg(F.bit_or("vote").alias("votes"), F.min("at").alias("begin"), F.max("at").alias("end"))

    order = Window.partitionBy("id", "print", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(order) > GAP) | (F.abs(F.col("begin") - F.lag("end").over(order)) > REACH)
    votes = votes.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("apart").over(order))
    whole = F.col("phrase") & (F.bit_count("votes") == F.col("pairs"))
    place = F.when(whole, F.col("diagonal"))
    merged = votes.groupBy(*what, "span").agg(
        F.bit_or("votes").alias("votes"),
        F.min("begin").alias("begin"),
        (F.max("end") + 1).alias("end"),
        F.count(place).alias("places"),
        F.min(place).alias("first"),
        F.max(place).alias("last"),
    )
    share = F.bit_count("votes") / F.col("pairs")
    fits = (share >= ENOUGH) & (F.col("end") - F.col("begin") + 1 <= LONGEST * (F.col("pairs") + 1))
    merged = merged.withColumn("share", F.when(F.col("places") > 0, F.lit(1.0)).when(fits, share)).where("share is not null")
    found = merged.groupBy("id", "print").agg(
        F.sum("places").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("begin", "end", "label", "share"))).alias("spans"),
    )
    found = found.withColumnsRenamed({"id": "found_id", "print": "found_print"})
    joined = sizes.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("print") == F.col("found_print")), "left")
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
