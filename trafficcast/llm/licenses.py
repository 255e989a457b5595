"""License scans with a positional rare-token index, in DataFrame functions only.

Licence texts are short templates of words. Every document keeps the places of the words that
templates are made of; how many documents have a word gives its weight (IDF over the whole table).
A template is looked up by its rarest words: each place of one in a document proposes a start, the
document's place minus the template's. Places are joined to postings by word, and the places that agree
on a document, a template and a start are counted together, so that the work grows with the places and
not with their square. A label needs its mandatory key phrase in the text and enough of its weight in
place. Base phrases are templates whose words must all be in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm.common import documents, keyed, staged

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening words of public licence notices, each with its mandatory key phrase.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license version"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
]

# Words too common to be indexed.
COMMON = set("a and any are at by can for in into is it not of or that the this to under use with you".split())

#: A template's rarest words by which it is looked up, and the share of its weight to be in place.
RAREST = 3
ENOUGH = 0.7

_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _index() -> list[dict]:
    """Templates with the places of their indexed words."""
    rows = [(label, phrase, phrase, True) for phrase, label in BASE.items()]
    rows += [(label, text, key, False) for label, text, key in TEMPLATES]
    return [
        {"template": i, "label": label, "key_phrase": key, "base": base, "places": [(p, w) for p, w in enumerate(text.split(" ")) if base or w not in COMMON]}
        for i, (label, text, key, base) in enumerate(rows)
    ]


def spaced(text: Column) -> Column:
    """A-Z lower-cased, words joined by single spaces, with a space at both ends."""
    # lower() also maps the dotted capital I and the Kelvin sign, the only ones that become ASCII.
    odd = F.contains(text, F.lit("İ")) | F.contains(text, F.lit("K"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.when(odd, F.translate(text, upper, lower)).otherwise(F.lower(text))
    return F.regexp_replace(F.concat(F.lit(" "), low, F.lit(" ")), _APART, " ")


def scan_places(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, mark, n_words, places, phrases): where documents have indexed words, and key phrases."""
    index = _index()
    vocabulary = sorted({w for t in index for _, w in t["places"]})
    phrases = sorted({t["key_phrase"] for t in index})
    plain = keyed(docs, key, text).withColumn("mark", F.monotonically_increasing_id())
    plain = plain.select("key", "mark", spaced(F.col("text")).alias("s"))
    plain = plain.select("key", "mark", "s", F.slice(F.split("s", " "), 2, 1 << 30).alias("w"))
    n_words = F.size("w").cast("long") - 1
    some = F.arrays_overlap("w", F.array(*map(F.lit, vocabulary)))
    places = F.filter(
        F.transform("w", lambda w, i: F.struct(i.cast("long").alias("at"), w.alias("word"))), lambda x: x["word"].isin(vocabulary)
    )
    present = F.filter(F.array(*(F.when(F.contains("s", F.lit(f" {p} ")), F.lit(p)) for p in phrases)), lambda x: x.isNotNull())
    return plain.select("key", "mark", n_words.alias("n_words"), F.when(some, places).alias("places"), F.when(some, present).alias("phrases"))


def word_weights(scanned: DataFrame) -> DataFrame:
    """(word, idf) of the indexed words that occur, over all rows."""
    total = scanned.agg(F.count("*").alias("total"))
    per_word = scanned.select(F.explode(F.array_distinct(F.transform("places", lambda p: p["word"]))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    # One row and at most one row a word of the fixed vocabulary.
    return per_word.join(F.broadcast(total)).select("word", (1 + F.log((1 + F.col("total")) / (1 + F.col("df")))).alias("idf"))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    n_base counts all places of base phrases, first_word and last_word are their smallest and
    largest start in words from 0, null without any; labels are sorted and comma-joined, score is
    the best share of a template's weight in place (1 for a base phrase, 0 without any). Null and
    empty texts have no words; repeated rows give one row each; an empty table gives none; other
    columns are ignored. Stages the places of indexed words when called.
    """
    spark = docs.sparkSession
    scanned = staged(scan_places(docs, key, text), "places")
    weights = word_weights(scanned)
    index = spark.createDataFrame(
        _index(), "template int, label string, key_phrase string, base boolean, places array<struct<at: bigint, word: string>>"
    ).withColumnRenamed("places", "own")
    posted = index.select("template", "label", "key_phrase", "base", F.explode("own").alias("p")).select("*", "p.*").drop("p")
    # A word that no document has weighs as if one had it: it cannot be found anyhow.
    top = F.coalesce(F.max("idf").over(_all()), F.lit(1.0))
    posted = posted.join(F.broadcast(weights), "word", "left").withColumn("idf", F.coalesce("idf", top))
    rare = F.row_number().over(_by_rarity()) <= F.when(F.col("base"), 1).otherwise(RAREST)
    posted = staged(posted.withColumn("rare", rare), "index")
    entries = posted.groupBy("template").agg(F.sum("idf").alias("whole"), F.count("*").alias("size"))
    # As many rows as the templates have indexed words.
    lookup = posted.join(F.broadcast(entries), "template").withColumnRenamed("at", "t_at")
    found = (
        scanned.where(F.size("phrases") > 0).select("mark", "phrases", F.explode("places").alias("d"))
        .join(F.broadcast(lookup), F.col("d.word") == F.col("word"))
        .where(F.array_contains("phrases", F.col("key_phrase")))
        .select("mark", "template", "label", "base", "whole", "size", "idf", "rare", (F.col("d.at") - F.col("t_at")).alias("start"))
        .where("start >= 0 or not base")
    )
    # A row of a document holds a place once, so each counts for one posting of the template.
    matched = found.groupBy("mark", "template", "label", "base", "whole", "size", "start").agg(
        F.count("*").alias("m"), F.sum("idf").alias("weight"), F.max("rare").alias("rare")
    )
    matched = matched.where(F.col("rare") & (~F.col("base") | (F.col("m") == F.col("size"))))
    matched = matched.withColumn("share", F.least(F.lit(1.0), F.col("weight") / F.col("whole")))
    base, good = F.col("base"), F.col("base") | (F.col("share") >= ENOUGH)
    joined = lambda names: F.concat_ws(",", F.array_sort(F.collect_set(names)))
    per_doc = matched.groupBy("mark").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(good, F.col("label"))).alias("labels"),
        F.max(F.when(base, F.lit(1.0)).otherwise(F.col("share"))).alias("score"),
    )
    result = scanned.select("key", "mark", "n_words").join(per_doc, "mark", "left")
    return result.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _by_rarity():
    from pyspark.sql import Window

    return Window.partitionBy("template").orderBy(F.desc("idf"), "at")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(documents(spark, folder))
