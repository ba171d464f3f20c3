"""License scans by an exact set-similarity join, in built-in expressions only.

Templates are sets of words; a text block holds one when it has at least a
given share of them. Words are put in order of their frequency in the whole
corpus. A block that reaches the threshold must have one of the rarest words of
the template (its prefix), so only those are joined, by hash; the length filter
and the positional filter then leave few candidates, which are verified on the
words themselves.

Blocks are windows of words with half overlap, wide enough that any run a
quarter longer than the longest template lies whole in one. Within a block a
template is held if a window of its own length and a quarter more has the share
of its words, and the words that tell it from similar ones. Phrases are found
word for word. Each document keeps, in one pass over its text, the places of all
words that any template has; these are opened once and grouped by block, so a
dense text is as much work as its words.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from stormledger.llm.common import kept, text_of

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as their publishers word them; a block needs THRESHOLD of a notice's words.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-or-later": "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl": "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "rights-reserved": "all rights reserved",
}
#: Words that tell a notice from one that differs in little else; without them it is not held.
REQUIRED = {"cc-by-nc-4.0": "nc", "cc-by-sa-4.0": "sa", "lgpl": "lesser", "mit-notice": "mit", "gpl-3.0": "gnu", "apache-2.0": "apache", "mpl-2.0": "mozilla", "rights-reserved": "all rights reserved"}
THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII without digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words after folding A to Z; runs of digits, a to z and all beyond ASCII."""
    folded = F.translate(text, UPPER, LOWER)
    inner = F.regexp_replace(folded, rf"^{SEPARATORS}", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATORS))


def places(docs: DataFrame, vocabulary: list[str], id_col="doc_id", text_col="text") -> DataFrame:
    """(id, body, n_words, hits): all places of the vocabulary's words, as (pos, word)."""
    text = text_of(text_col)
    t = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), words_of(text).alias("words"))
    # A separator at the end leaves one empty piece behind.
    trailing = F.when(F.get("words", F.size("words") - 1) == "", 1).otherwise(0)
    placed = F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    return t.select(
        "id",
        "body",
        (F.size("words") - trailing).cast("long").alias("n_words"),
        F.filter(placed, lambda h: h["word"].isin(vocabulary)).alias("hits"),
    )


def word_order(placed: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(word, n, rarer): corpus frequency of each template word, and the words before it in that order.

    The vocabulary is that of the templates, whatever the corpus, so the window
    and the lists are bounded by it.
    """
    spark = placed.sparkSession
    counted = placed.select(F.explode("hits.word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame([(w,) for w in vocabulary], "word string").join(counted, "word", "left").fillna(0, ["n"])
    ranked = known.agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("all"))
    return ranked.select(F.posexplode("all").alias("rank", "w"), "all").select(
        "w.word", "w.n", F.slice(F.col("all.word"), F.lit(1), F.col("rank")).alias("rarer")
    )


def prefixes(order: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows (word, rarer, label, required, span, ordered, needed, before) for each word of each template's prefix.

    A template of n words that needs a of them keeps its n - a + 1 rarest.
    """
    spread = templates.select("label", "required", "span", "share", F.explode(F.array_distinct("phrase")).alias("word"))
    ordered = (
        spread.join(order, "word")
        .groupBy("label", "required", "span", "share")
        .agg(F.array_sort(F.collect_list(F.struct("n", "word", "rarer"))).alias("o"))
    )
    needed = F.ceil(F.size("o") * F.col("share") - F.lit(1e-9)).cast("int")
    ordered = ordered.withColumn("needed", needed).withColumn("ordered", F.col("o.word"))
    first = F.slice("o", F.lit(1), F.size("o") - F.col("needed") + 1)
    opened = ordered.select("label", "required", "span", "ordered", "needed", F.posexplode(first).alias("p", "w"))
    return opened.select(
        "w.word", "w.rarer", "label", "required", "span", "ordered", "needed", F.slice("ordered", F.lit(1), F.col("p")).alias("before")
    )


def phrase_places(opened: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """(id, body, label, start) of all places where a phrase's words follow each other.

    Each place of a word votes for the start it would belong to; a start with a
    vote of every word of the phrase is a place.
    """
    rows = [(label, k, w, (1 << len(words.split())) - 1) for words, label in phrases.items() for k, w in enumerate(words.split())]
    votes = opened.sparkSession.createDataFrame(rows, "label string, k int, word string, whole long")
    voted = opened.join(F.broadcast(votes), "word").withColumn("start", F.col("pos") - F.col("k"))
    mark = F.bit_or(F.expr("shiftleft(1L, k)"))
    return voted.groupBy("id", "body", "label", "start").agg(mark.alias("has"), F.first("whole").alias("whole")).filter("has = whole")


def blocks(opened: DataFrame, stride: int) -> DataFrame:
    """(id, body, block, near): the template words of each window of twice the stride, at most one for each of its places."""
    own = F.floor(F.col("pos") / F.lit(stride)).cast("int")
    both = opened.withColumn("block", F.explode(F.array_distinct(F.array(own, F.greatest(own - 1, F.lit(0))))))
    return both.groupBy("id", "body", "block").agg(F.array_sort(F.collect_set(F.struct("pos", "word"))).alias("near"))


def candidates(windows: DataFrame, prefix: DataFrame) -> DataFrame:
    """Blocks that may hold a template: (id, body, block, near, label, ordered, needed, required, span).

    A block meets a template at the first of its prefix that the block has, so no
    pair comes twice by different words.
    """
    have = windows.withColumn("have", F.array_distinct("near.word"))
    # The prefixes are bounded by the templates, a few dozen rows.
    met = have.select("*", F.explode("have").alias("word")).join(F.broadcast(prefix), "word")
    length = F.size("have") >= F.col("needed")
    rank = F.size(F.array_intersect("have", "rarer"))
    position = F.size("have") - rank >= F.col("needed")
    first = F.size(F.array_intersect("have", "before")) == 0
    overlap = F.size(F.array_intersect("have", "ordered"))
    return met.filter(length & position & first).filter(overlap >= F.col("needed"))


def containment() -> Column:
    """Best share of a template's words in one of its own windows within the block; null where none has its required words.

    A window begins at a place of the block and is as long as the template and a
    quarter more, so words that are scattered over a longer text do not count.
    """

    def share(start: Column) -> Column:
        inside = F.filter("near", lambda x: (x["pos"] >= start["pos"]) & (x["pos"] < start["pos"] + F.col("span")))
        words = F.transform(inside, lambda x: x["word"])
        common = F.size(F.array_intersect(words, F.col("ordered")))
        return F.when(F.size(F.array_except(F.col("required"), words)) == 0, common / F.size("ordered"))

    return F.array_max(F.transform("near", share))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col="doc_id",
    text_col="text",
) -> DataFrame:
    """One row per document: (id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``labels`` joins those of the phrases found and of the templates held;
    ``score`` is the best containment among them, 1 for a phrase. Null and empty
    texts have no words. Rows that repeat an id are judged by their own text.
    """
    spark = docs.sparkSession
    rows = [(label, words.split(), REQUIRED.get(label, "").split(), threshold) for label, words in templates.items()]
    vocabulary = sorted({w for words in [*phrases, *templates.values()] for w in words.split()})
    wide = lambda words: -(-5 * len(words) // 4)
    stride = max(wide(words) for _, words, _, _ in rows)
    rows = [(*row, wide(row[1])) for row in rows]
    table = spark.createDataFrame(rows, "label string, phrase array<string>, required array<string>, share double, span int")
    placed = kept(places(docs, vocabulary, id_col, text_col), "license-words")
    prefix = kept(prefixes(word_order(placed, vocabulary), table), "license-prefixes")
    # Words of the templates, whatever the corpus: a text without any of these holds nothing.
    rare = sorted({r.word for r in prefix.select("word").distinct().collect()} | {w for words in phrases for w in words.split()})
    some = placed.filter(F.exists("hits", lambda h: h["word"].isin(rare)))
    opened = some.select("id", "body", F.explode("hits").alias("h")).select("id", "body", "h.pos", "h.word")
    base = phrase_places(opened, phrases).select("id", "body", "label", "start", F.lit(1.0).alias("held"))
    found = candidates(blocks(opened, stride), prefix).withColumn("held", containment())
    found = found.filter((F.col("held") * F.size("ordered") >= F.col("needed") - 1e-9))
    found = base.unionByName(found.select("id", "body", "label", F.lit(None).cast("int").alias("start"), "held"))
    is_base = F.col("start").isNotNull()
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_doc = found.groupBy("id", "body").agg(
        F.count("start").alias("n_base"),
        F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        labels(F.when(is_base, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("held").alias("score"),
    )
    per_doc = per_doc.withColumnsRenamed({"id": "found_id", "body": "found_body"})
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("body") == F.col("found_body"))
    return placed.join(per_doc, same, "left").select(
        "id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
