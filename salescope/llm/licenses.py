"""License scan by an exact set-similarity join.

Blocks are the lines of a text and, for statements that wrap, its paragraphs
(no blank line inside) of several lines; of a longer paragraph, overlapping
windows of words that hold every run of words as long as the longest span.
Templates are license statements; a block, called a line below, matches a
template if ``threshold`` of the template's different words stand in it within
a span of ``1 / threshold`` times the template's words, so that words scattered
over a long line are no statement.  Words are ordered by their frequency over
all lines of the corpus, rarest first.  A line and a template of ``t`` words
with ``o`` words in common at least must share a word within the first
``t - o + 1`` of the template and ``l - o + 1`` of the line (prefix filter), the
line must have ``o`` words (length filter), and after the first shared word
there must be room for the other ``o - 1`` (positional filter).  What is left is
verified in full, first the words, then the span in the original text.  Only
words of templates can be shared, so lines are cut to these first: exact, and
the join's right side (words of templates) is bounded by the template list.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import keep, lower_ascii, with_row_id

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9
#: Bound of the template list: its words are sent to every task as literals.
MAX_TEMPLATE_WORDS = 20_000

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences by which public licenses are stated, with their labels.
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, "
            "this list of conditions and the following disclaimer."),
    ("bsd", "Released under the BSD License"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and "
                "related or neighboring rights to this work"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by "
             "the Free Software Foundation"),
    ("mit-license", "Released under the MIT License"),
    ("mit-license", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                    "this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def template_sets(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[dict]:
    """Templates as word sets with the number of words a match needs."""
    out = []
    for k, (label, text) in enumerate(templates):
        words = sorted(set(re.findall(WORDS, "".join(
            c.lower() if c.isascii() else c for c in text))))
        out.append({"k": k, "label": label, "words": words,
                    "need": math.ceil(threshold * len(words) - 1e-9),
                    "span": math.ceil(len(re.findall(WORDS, text)) / threshold - 1e-9)})
    if sum(len(t["words"]) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError("more template words than can be sent to every task; scan in parts")
    return out


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _places_of(words: Column, phrase: str, label: str) -> Column:
    first, *rest = phrase.split(" ")

    def place(word: Column, i: Column) -> Column:
        follows = [F.get(words, i + n) == w for n, w in enumerate(rest, 1)]
        return F.when((word == first) & _all(follows),
                      F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.filter(F.transform(words, place), lambda x: x.isNotNull())


def _phrase_places(words: Column) -> Column:
    """All places of all phrases: array of (start, label)."""
    return F.concat(*[_places_of(words, phrase, label) for phrase, label in PHRASES.items()])


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _windows(words: Column, run: int, cut) -> Column:
    """``cut`` of windows of ``2 * run`` words, so far apart that each run of
    ``run`` words lies in one."""
    size, step = 2 * run, run + 1
    last = F.greatest(F.lit(0), F.ceil((F.size(words) - size) / step)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: cut(F.slice(words, i * step + 1, F.lit(size))))


def _clean(text: Column) -> Column:
    """Lower-cased words one blank apart and line ends."""
    breaks = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), breaks, " ")


def _paragraph_windows(clean: Column, run: int, cut=lambda words: words) -> Column:
    """The windows of all paragraphs of several lines, in order, each ``cut``
    where it is made (whole windows would be the text twice)."""
    paragraphs = F.filter(F.split(clean, "\n *\n"), lambda x: x.rlike("[^ \n] *\n+ *[^ \n]"))
    # two steps: a paragraph is split once, not again for each window
    split = F.transform(paragraphs, lambda x: F.split(F.trim(F.regexp_replace(x, "[ \n]+", " ")), " "))
    return F.flatten(F.transform(split, lambda x: _windows(x, run, cut)))


def text_facts(rows: DataFrame, vocabulary: list[str], run: int = 0) -> DataFrame:
    """From ``__row, doc_id, text``: number of words, phrase places, and each
    line's words that are in ``vocabulary``: ``lines`` (array of line, words),
    and ``blocks``, the same of the windows of paragraphs of several lines
    (none if ``run`` is 0)."""
    clean = rows.select("__row", "doc_id", _clean(F.col("text")).alias("__clean"))
    flat = F.trim(F.regexp_replace("__clean", "[ \n]+", " "))
    either = "|".join(PHRASES)
    places = F.when(F.concat(F.lit(" "), F.col("__flat"), F.lit(" ")).rlike(f" (?:{either}) "),
                    _phrase_places(F.split("__flat", " ")))
    vocab = _array(vocabulary)
    lines = F.filter(F.transform(F.split("__clean", "\n"), lambda l, i: F.struct(
        i.alias("line"), F.array_intersect(F.split(l, " "), vocab).alias("words"))),
        lambda x: F.size(x["words"]) > 0)
    none = F.array().cast("array<struct<line:int,words:array<string>>>")
    blocks = F.filter(F.transform(_paragraph_windows(F.col("__clean"), run, lambda w: F.array_intersect(w, vocab)), lambda x, i: F.struct(i.alias("line"), x.alias("words"))),
                      lambda x: F.size(x["words"]) > 0) if run else none
    return clean.withColumn("__flat", flat).select(
        "__row", "doc_id",
        F.when(F.col("__flat") == "", 0).otherwise(
            F.length("__flat") - F.length(F.translate("__flat", " ", "")) + 1).cast("long").alias("n_words"),
        F.coalesce(places, F.array().cast("array<struct<start:bigint,label:string>>")).alias("places"),
        lines.alias("lines"), blocks.alias("blocks"))


def template_matches(facts: DataFrame, sets: list[dict], of: str = "lines") -> DataFrame:
    """The join: ``(__row, line, template, label, containment)`` of every line
    (or block, ``of``) of ``text_facts`` that meets the threshold of a template."""
    spark = facts.sparkSession
    vocabulary = sorted({w for t in sets for w in t["words"]})
    lines = facts.select("__row", F.explode(of).alias("x")).select(
        "__row", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    # frequencies over all lines, one row for each template word
    count = {r.word: r.n for r in lines.select(F.explode("words").alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = {w: p for p, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}
    prefix, full = [], []
    for t in sets:
        ordered = sorted(t["words"], key=order.get)
        size, need = len(ordered), t["need"]
        prefix += [(w, t["k"], i, size, need) for i, w in enumerate(ordered[:size - need + 1])]
        full.append((t["k"], t["label"], ordered))
    rare = spark.createDataFrame(prefix, "word string, template int, i int, size int, need int")
    full = spark.createDataFrame(full, "template int, label string, ordered array<string>")
    smallest = min(t["need"] for t in sets)
    known = F.create_map(*[F.lit(x) for w, p in order.items() for x in (w, p)])
    some = lines.where((F.size("words") >= smallest)
                       & F.arrays_overlap("words", _array(sorted({p[0] for p in prefix}))))
    ranked = some.withColumn("ranked", F.array_sort(F.transform(
        "words", lambda w: F.struct(F.element_at(known, w).alias("p"), w.alias("word")))))
    # both sides of these joins are bounded by the template list
    met = (ranked.select("__row", "line", "words", F.size("words").alias("length"),
                         F.posexplode("ranked").alias("j", "x"))
           .select("__row", "line", "words", "length", "j", F.col("x.word").alias("word"))
           .join(F.broadcast(rare), "word")
           .where((F.col("length") >= F.col("need")) & (F.col("j") <= F.col("length") - F.col("need"))))
    first = met.groupBy("__row", "line", "template").agg(
        F.min(F.struct("i", "j")).alias("at"), F.first("words").alias("words"), F.first("length").alias("length"),
        F.first("size").alias("size"), F.first("need").alias("need"))
    room = 1 + F.least(F.col("size") - 1 - F.col("at.i"), F.col("length") - 1 - F.col("at.j"))
    shared = F.size(F.array_intersect("words", "ordered"))
    return (first.where(room >= F.col("need")).join(F.broadcast(full), "template")
            .withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
            .select("__row", "line", "template", "label", (F.col("shared") / F.col("size")).alias("containment")))


def in_span(rows: DataFrame, matches: DataFrame, sets: list[dict], of: str, run: int) -> DataFrame:
    """Of ``template_matches`` those whose words stand within the template's
    span in the text of ``rows`` (``__row, text``), with the containment
    there."""
    full = rows.sparkSession.createDataFrame([(t["k"], t["words"], t["need"], t["span"]) for t in sets],
                                             "template int, wanted array<string>, need int, span int")
    clean = _clean(F.col("text"))
    blocks = F.split(clean, "\n") if of == "lines" else _paragraph_windows(clean, run)
    # a text's blocks are made once, the matched ones kept: else they would be
    # made again for every place of a span
    listed = matches.groupBy(F.col("__row").alias("__of")).agg(
        F.collect_list(F.struct("line", "template", "label")).alias("found"))
    there = rows.select("__row", "text").join(listed, F.col("__row") == F.col("__of")).select(
        "__row", "found", blocks.alias("blocks")).select("__row", "blocks", F.explode("found").alias("m"))
    block = F.get("blocks", F.col("m.line"))
    # blanks at a line's ends give empty words, which no template has
    words = F.filter(F.split(block, " "), lambda w: w != "") if of == "lines" else block
    there = keep(there.select("__row", "m.*", words.alias("words")), "license-blocks").join(F.broadcast(full), "template")
    last = F.greatest(F.size("words") - F.col("span"), F.lit(0))
    best = F.array_max(F.transform(F.sequence(F.lit(0), last), lambda i: F.size(F.array_intersect(
        F.slice("words", i + 1, F.col("span")), F.col("wanted")))))
    return there.withColumn("best", best).where(F.col("best") >= F.col("need")).select(
        "__row", "line", "template", "label", (F.col("best") / F.size("wanted")).alias("containment"))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, places`` (phrase
    places as (start, label)), ``matches`` (array of line, template, label,
    containment), ``block_matches`` (the same of paragraphs of several lines
    or their windows, numbered in order).

    Null and empty texts have no word and no match.  Repeated rows each give
    a row; null ids stay null.  Only ``doc_id`` and ``text`` are read.  An
    empty table gives an empty one.  Template words occur in a line or do
    not: repeats do not count; of equally contained templates all are given.
    """
    sets = template_sets(templates, threshold)
    vocabulary = sorted({w for t in sets for w in t["words"]})
    rows, run = with_row_id(docs).select("__row", "doc_id", "text"), max(t["span"] for t in sets)
    facts = keep(text_facts(rows, vocabulary, run), "license-facts")
    out = facts.drop("lines", "blocks")
    empty = F.array().cast("array<struct<line:int,template:int,label:string,containment:double>>")
    for of, name in (("lines", "matches"), ("blocks", "block_matches")):
        found = keep(template_matches(facts, sets, of), "license-matches")
        by_row = in_span(rows, found, sets, of, run).groupBy(F.col("__row").alias("__of")).agg(F.array_sort(
            F.collect_list(F.struct("line", "template", "label", "containment"))).alias(name))
        out = out.join(by_row, F.col("__row") == F.col("__of"), "left").drop("__of")
    return out.select("doc_id", "n_words", "places", F.coalesce("matches", empty).alias("matches"),
                      F.coalesce("block_matches", empty).alias("block_matches"))
