"""License scan: exact set-similarity join of text blocks with templates.

A block is a line of a text, a template a license notice; both are sets of
words. A block meets a template when it contains at least the threshold's
share of the template's words. Only words of templates can count, so blocks
keep those alone. Words stand in one order for all, rarest in the corpus
first. Then

* prefix filter: a pair that meets shares a word among the first
  ``size - need + 1`` of each side, so only these are joined;
* length filter: a block with fewer than ``need`` words is out;
* positional filter: the words before the shared one and those after it must
  leave room for ``need`` common ones.

A candidate is verified at its first shared word alone, so a pair comes out
once and nothing has to be made distinct.

Notices wrapped over lines are found in windows of the whole text's words.
Templates are grouped by length; a group's windows start every ``span`` words
(a power of two, a quarter more than its longest template at least) and hold
twice as many, so a notice stands whole in one of them wherever it starts. Only
texts that hold enough of a template's words anywhere are cut into windows.

Beside the notices there are base phrases, found where their words stand
consecutively in the whole text.

Defined cases: null and empty texts have no words, labels or places and score
0; repeated rows are scanned each; a line that meets two templates gets both
labels; templates without words are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import write_table
from .urls import LOWER, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Fixed phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("mit", "released under the mit license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("gnu-gpl", "this work is licensed under the gnu general public license version"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc0", "cc0 1.0 universal public domain dedication"),
    ("proprietary", "copyright all rights reserved"),
)
THRESHOLD = 0.9
# Standard notices, looked for across line breaks. Ones that differ from another by a word or two (LGPL, other CC licenses) are left out,
# as the threshold could not tell them apart.
NOTICES = (
    ("apache-2.0", "licensed under the apache license, version 2.0 (the license); you may not use this file except in compliance with the license. "
                   "you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0"),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the software), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, "
            "subject to the following conditions"),
    ("gnu-gpl", "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as "
                "published by the free software foundation, either version 3 of the license, or (at your option) any later version"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed "
                "with this file, you can obtain one at https://mozilla.org/mpl/2.0/"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain. anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software"),
)


def need(size: int, threshold: float) -> int:
    """Fewest common words with a template of ``size`` words."""
    return max(1, math.ceil(threshold * size - 1e-9))


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def template_words(spark, templates) -> DataFrame:
    rows = spark.createDataFrame(list(templates), "label string, notice string")
    words = F.array_distinct(F.regexp_extract_all(lowered(F.col("notice")), F.lit(WORD), F.lit(0)))
    return rows.select("label", words.alias("words")).where(F.size("words") > 0)


def span_of(notice: str) -> int:
    """Words between the starts of a template's windows."""
    return 1 << (math.ceil(len(re.findall(WORD, notice)) * 1.25) - 1).bit_length()


def spans(templates) -> dict[int, list[tuple[str, list[str]]]]:
    """(label, different words) of the templates with words, by the span of their windows."""
    out: dict[int, list[tuple[str, list[str]]]] = {}
    for label, notice in templates:
        low = notice.translate(str.maketrans(UPPER, LOWER))
        if words := sorted(set(re.findall(WORD, low))):
            out.setdefault(span_of(low), []).append((label, words))
    return out


WINDOWS = "array<struct<span:int,block:int,words:array<string>>>"


def windows(words: Column, held: Column, groups: dict[int, list[tuple[str, list[str]]]], threshold: float) -> Column:
    """Windows with enough words for a template of their span. ``held``: the different template words of the whole text."""
    def cut(span, group):
        own, least = sorted({w for _, ws in group for w in ws}), min(need(len(ws), threshold) for _, ws in group)

        def window(at):
            inside = F.array_distinct(F.filter(F.slice(words, at + 1, 2 * span), lambda w: w.isin(own)))
            return F.struct(F.lit(span).alias("span"), (at / span).cast("int").alias("block"), inside.alias("words"))

        enough = F.lit(False)
        for _, ws in group:
            enough = enough | (F.size(F.array_intersect(held, F.array(*map(F.lit, ws)))) >= need(len(ws), threshold))
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(span))
        full = F.filter(F.transform(starts, window), lambda b: F.size(b["words"]) >= least)
        return F.when(enough, full.cast(WINDOWS)).otherwise(F.array().cast(WINDOWS))

    out = [cut(span, group) for span, group in sorted(groups.items())]
    return F.concat(*out) if out else F.array().cast(WINDOWS)


def phrase_starts(words: Column, phrase: str) -> Column:
    """Starts of the phrase in an array of words; looked for only where its words occur."""
    parts = phrase.split(" ")

    def begins(w, i):
        hit = w == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(words, i + k) == part, F.lit(False))
        return F.when(hit, i)

    inside = F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(f" {phrase} "))
    return F.when(inside, F.filter(F.transform(words, begins), lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD, across=()) -> tuple[DataFrame, DataFrame]:
    """(documents, matches). ``templates`` are looked for in lines, those of ``across`` over line breaks.

    documents: rid (of the row), doc_id, n_words, starts (array of struct<label, starts>).
    matches: rid, span (of a window, null for a line), block (line or window from 0), label, containment.
    """
    spark = docs.sparkSession
    notices = template_words(spark, templates)
    # The templates' words: as many as the parameter holds.
    vocabulary = sorted({w for r in notices.collect() for w in r["words"]})
    words_of = lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0))
    lines = F.transform(F.split(lowered(F.col(text_col)), "\n"), words_of)
    # Generated once: the words of a text are used many times below.
    read = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.array(lines)).alias("lines"))
    read = read.select("doc_id", "lines", F.explode(F.array(F.flatten("lines"))).alias("words"))
    groups = spans(across)
    sought = sorted({w for group in groups.values() for _, ws in group for w in ws})
    held = F.array_distinct(F.filter("words", lambda w: w.isin(sought))) if sought else F.array().cast("array<string>")
    read = read.select("doc_id", "lines", "words", F.explode(F.array(held)).alias("held"))
    known = F.transform("lines", lambda ws: F.array_distinct(F.filter(ws, lambda w: w.isin(vocabulary) if vocabulary else F.lit(False))))
    kept = F.filter(F.transform(known, lambda ws, i: F.struct(i.alias("block"), ws.alias("words"))), lambda b: F.size(b["words"]) > 0)
    starts = F.array(*[F.struct(F.lit(label).alias("label"), phrase_starts(F.col("words"), phrase).alias("starts")) for phrase, label in phrases])
    scanned = write_table(read.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("words").cast("long").alias("n_words"),
                                      starts.alias("starts"), kept.alias("blocks"),
                                      windows(F.col("words"), F.col("held"), groups, threshold).alias("windows")), "license-blocks")
    documents = scanned.select("rid", "doc_id", "n_words", "starts")

    blocks = scanned.select("rid", F.explode("blocks").alias("b")).select("rid", "b.block", "b.words")
    # At most one row per word of the templates.
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["word"]: r["n"] for r in counted}
    ordered = sorted(vocabulary, key=lambda w: (found.get(w, 0), w))
    rank = F.create_map(*[F.lit(x) for i, w in enumerate(ordered) for x in (w, i)]) if ordered else None

    def sort(words: Column) -> Column:
        if rank is None:
            return words
        return F.transform(F.array_sort(F.transform(words, lambda w: F.struct(rank[w].alias("i"), w.alias("w")))), lambda x: x["w"])

    needed = F.greatest(F.lit(1), F.ceil(F.size("words") * F.lit(threshold) - 1e-9)).cast("int")
    sides = (notices.select("label", sort(F.col("words")).alias("t_words"), needed.alias("need"))
             .select("label", "t_words", "need", F.posexplode(F.slice("t_words", 1, F.size("t_words") - F.col("need") + 1)).alias("t_at", "word")))
    least = min((need(len(r["words"]), threshold) for r in notices.collect()), default=1)
    prefixes = (blocks.where(F.size("words") >= least).select("rid", "block", sort(F.col("words")).alias("words"))
                .select("rid", "block", "words", F.posexplode(F.slice("words", 1, F.size("words") - least + 1)).alias("at", "word")))
    # As many rows as the templates' words, which are a parameter.
    met = prefixes.join(F.broadcast(sides), "word")
    size, t_size = F.size("words"), F.size("t_words")
    room = F.least("at", "t_at") + 1 + F.least(size - F.col("at"), t_size - F.col("t_at")) - 1
    met = met.where((F.col("at") <= size - F.col("need")) & (size >= F.col("need")) & (room >= F.col("need")))
    common = F.array_intersect("words", "t_words")
    met = met.where((F.size(common) >= F.col("need")) & (common[0] == F.col("word")))
    matches = met.select("rid", F.lit(None).cast("int").alias("span"), "block", "label", (F.size(common) / t_size).alias("containment"))
    if not groups:
        return documents, matches

    # As many rows as ``across`` has templates.
    told = spark.createDataFrame([(span, label, ws, need(len(ws), threshold)) for span, group in groups.items() for label, ws in group],
                                 "span int, label string, t_words array<string>, need int")
    cut = scanned.select("rid", F.explode("windows").alias("b")).select("rid", "b.span", "b.block", "b.words").join(F.broadcast(told), "span")
    cut = cut.select("rid", "span", "block", "label", "need", F.size("t_words").alias("size"), F.size(F.array_intersect("words", "t_words")).alias("n"))
    return documents, matches.unionByName(cut.where(F.col("n") >= F.col("need")).select("rid", "span", "block", "label", (F.col("n") / F.col("size")).alias("containment")))


def label_documents(documents: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per document: the scan's figures, base and all labels, and the largest containment as score."""
    told = matches.groupBy("rid").agg(F.collect_set("label").alias("told"), F.max("containment").alias("most"))
    rows = documents.join(told.withColumnRenamed("rid", "r"), F.col("rid") == F.col("r"), "left")
    places = F.flatten(F.transform("starts", lambda s: s["starts"]))
    base = F.array_distinct(F.transform(F.filter("starts", lambda s: F.size(s["starts"]) > 0), lambda s: s["label"]))
    every = F.array_distinct(F.concat(base, F.coalesce("told", F.array().cast("array<string>"))))
    return rows.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))
