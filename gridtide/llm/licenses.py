"""License scans: an exact set-similarity join between text blocks and license templates.

Everything is DataFrame code. A block is a line and as many of the words after it as the longest template can still need, so
that a template which begins in it is whole however it is broken into lines. A template is found in it if at least the threshold's share of the
template's distinct words is in the block, among them all that name its license: texts of two licenses may differ in one word. Of the
templates found in one block, those go whose naming words are only a part of another one's. Words are put in one global order, rare ones first, by the number of blocks of the
corpus that have them. Two sets that share `need` words of a template share one of its first `size - need + 1` words
(prefix filter); a block needs at least `need` of the templates' words (length filter); and the places of a shared word
in both orders bound what the sets can still share (positional filter). Pairs that pass are compared in full.

The text is read once: words that no template has can neither match nor change the order among those that can, so
only the templates' words of each block are kept. The templates are a parameter of a few kilobytes, sent to all tasks.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.session import stored

# Phrases whose words stand one after the other, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Label, text, and the words that name the license.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3.", "gnu general public license"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gnu general public license"),
    ("lgpl", "licensed under the GNU Lesser General Public License", "gnu lesser general public license"),
    ("agpl", "licensed under the GNU Affero General Public License", "gnu affero general public license"),
    ("apache", "Licensed under the Apache License, Version 2.0.", "apache"),
    ("mit", "Released under the MIT License.", "mit"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "permission granted copy software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution source binary"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license"),
    ("cc-by", "Licensed under CC BY 4.0.", "cc by"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", "cc by nc"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0.", "cc by sa"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "creative commons attribution noncommercial"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "creative commons attribution sharealike"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative commons attribution"),
    ("cc0", "Dedicated to the public domain under CC0 1.0 Universal.", "cc0"),
    ("reserved", "All rights reserved.", "rights reserved"),
)
CONTAINED = 0.8
OTHER = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
OTHER_BUT_BREAKS = r"[^0-9a-z\x{80}-\x{10FFFF}\n]+"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _phrase(norm: str, phrase: str) -> Column:
    """`n, first, last`: how often the words of `phrase` stand in a row, and the word numbers of the first and last place."""
    words = " ".join(words_of(phrase))
    pieces = F.split(norm, f"(?<= )(?={re.escape(words)} )")
    place = F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"), (_spaces(F.element_at(pieces, 1)) - 1).cast("long").alias("first"),
        (_spaces(F.col(norm)) - 1 - _spaces(F.element_at(pieces, -1))).cast("long").alias("last"),
    )
    return F.when(F.col(norm).contains(f" {words} "), place)


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str, str], ...] = TEMPLATES, contained: float = CONTAINED
) -> DataFrame:
    """One row per row of `docs`: `id`, `n_words, n_base, first_word, last_word, base_labels, labels, score, matches`.

    The base columns tell where the words of a phrase stand one after the other, anywhere in the text. `matches` has
    `block, template, share` of every block and template (by its place) that meet the threshold with all naming words, but for templates that name a part of what
    another one in the block names; a block is a line (numbered from 0) and the words after it, one less than the longest template has. `labels` adds
    the templates' labels; `score` is the largest share, 1 where a phrase is found, 0 where nothing is. Words are ASCII
    letters and digits and everything beyond ASCII, lower-cased. Null text: no words. Rows with equal or null ids are
    kept apart. Without templates only the base is reported.
    """
    sets = [sorted(set(words_of(t))) for _, t, _ in templates]
    named = [sorted(set(words_of(n))) for _, _, n in templates]
    need = [max(1, math.ceil(contained * len(s) - 1e-9)) for s in sets]
    vocabulary = sorted({w for s in sets for w in s}) or [""]
    lines = F.split(F.regexp_replace("__low", OTHER_BUT_BREAKS, " "), "\n")
    listed = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("block"), F.transform(F.filter(F.split(line, " "), lambda w: w != ""), lambda w: F.when(w.isin(vocabulary), w).otherwise("")).alias("words"))), lambda b: F.size(b["words"]) > 0)
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace("__low", OTHER, " ")), F.lit(" "))
    low = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__low"))
    found = low.select("__row", F.col(id), listed.alias("__blocks"), norm.alias("__norm"))
    found = found.withColumn("__blocks", _with_next("__blocks", max((len(words_of(t)) for _, t, _ in templates), default=1) - 1))
    found = found.select("__row", F.col(id), "__blocks", F.when(F.col("__norm") == "  ", F.lit(0)).otherwise(_spaces(F.col("__norm")) - 1).cast("long").alias("n_words"), *[_phrase("__norm", p).alias(f"__p{i}") for i, p in enumerate(phrases)])
    places = F.array(*[F.when(F.col(f"__p{i}").isNotNull(), F.struct(F.lit(label).alias("label"), F.col(f"__p{i}.n").alias("n"), F.col(f"__p{i}.first").alias("first"), F.col(f"__p{i}.last").alias("last"))) for i, label in enumerate(phrases.values())])
    found = found.withColumn("__places", F.filter(places, lambda x: x.isNotNull())).select("__row", F.col(id), "__blocks", "n_words", "__places")
    found = stored(found, "blocks")
    rows = found.select(
        "__row", F.col(id), "n_words", F.aggregate("__places", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_base"),
        F.array_min(F.transform("__places", lambda x: x["first"])).alias("first_word"), F.array_max(F.transform("__places", lambda x: x["last"])).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("__places", lambda x: x["label"]))).alias("__base"),
    )
    matched = _join(found.select("__row", F.explode("__blocks").alias("b")).select("__row", "b.block", "b.words"), sets, named, need)
    labels = F.create_map(*[F.lit(x) for i, (label, _, _) in enumerate(templates) for x in (i, label)]) if templates else F.lit(None).cast("map<int,string>")
    above = [[j for j, more in enumerate(named) if set(more) > set(less)] for less in named]
    above = F.array(*[F.array(*map(F.lit, x)).cast("array<int>") for x in above])
    matched = matched.groupBy("__row", "block").agg(F.collect_list(F.struct("block", "template", "share")).alias("__here"))  # at most one per template
    of_block = F.transform("__here", lambda m: m["template"])
    matched = matched.withColumn("__here", F.filter("__here", lambda m: ~F.arrays_overlap(F.element_at(above, m["template"] + 1), of_block)))
    matched = matched.groupBy("__row").agg(F.sort_array(F.flatten(F.collect_list("__here"))).alias("matches"))  # at most lines x templates of one text
    matched = matched.withColumn("__more", F.transform("matches", lambda m: F.element_at(labels, m["template"])))
    out = rows.join(matched, "__row", "left")
    every = F.array_sort(F.array_distinct(F.concat("__base", F.coalesce("__more", F.array().cast("array<string>")))))
    share = F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
    return out.select(
        F.col(id), "n_words", "n_base", "first_word", "last_word", F.array_join("__base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(share).alias("score"), "matches",
    )


def _with_next(lines: str, more: int) -> Column:
    """Each line's known words and those among the next `more` words of the text, from lines that all have words (unknown ones are empty)."""
    after = lambda j: F.slice(F.flatten(F.transform(F.slice(lines, j + 2, more), lambda x: x["words"])), 1, more)
    known = lambda words: F.array_distinct(F.filter(words, lambda w: w != ""))
    some = F.transform(lines, lambda b, j: F.when(F.exists(b["words"], lambda w: w != ""), F.struct(b["block"].alias("block"), known(F.concat(b["words"], after(j))).alias("words"))))
    return F.filter(some, lambda b: b.isNotNull())


def _join(blocks: DataFrame, sets: list[list[str]], named: list[list[str]], need: list[int]) -> DataFrame:
    """`__row, block, template, share` of all pairs that meet the threshold and share the naming words, from `__row, block, words`."""
    spark = blocks.sparkSession
    tokens = spark.createDataFrame([(i, w, len(s), need[i], w in named[i]) for i, s in enumerate(sets) for w in s], "template int, word string, size int, need int, named boolean")
    frequency = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("blocks"))
    # Every word's place in the global order; as many rows as the templates have words.
    order = tokens.select("word").distinct().join(frequency, "word", "left").select(F.coalesce("blocks", F.lit(0).cast("long")).alias("blocks"), "word")
    order = order.agg(F.array_sort(F.collect_list(F.struct("blocks", "word"))).alias("order")).select(F.transform("order", lambda x: x["word"]).alias("order"))
    ranked = tokens.groupBy("template", "size", "need").agg(F.collect_list("word").alias("words"), F.collect_list(F.when(F.col("named"), F.col("word"))).alias("names")).crossJoin(order)
    in_order = F.array_sort(F.transform("words", lambda w: F.array_position("order", w)))
    names = F.transform("names", lambda w: F.array_position("order", w))
    prefixes = ranked.withColumns({"ranks": in_order, "names": names}).select("template", "size", "need", "ranks", "names", F.posexplode("ranks").alias("i", "rank")).filter("i <= size - need")
    least = min(need, default=1)
    sized = blocks.filter(F.size("words") >= least).crossJoin(F.broadcast(order))
    sized = sized.select("__row", "block", in_order.alias("own")).select("__row", "block", "own", F.posexplode("own").alias("j", "rank"))
    pairs = sized.join(F.broadcast(prefixes), "rank")
    own = F.size("own")
    pairs = pairs.filter((own >= F.col("need")) & (F.col("j") <= own - F.col("need")) & (1 + F.least(F.col("size") - F.col("i"), own - F.col("j")) - 1 >= F.col("need")))
    # A pair that shares several prefix words is taken at the first of them.
    shared = F.array_intersect("own", "ranks")
    pairs = pairs.filter(F.element_at(shared, 1) == F.col("rank")).withColumn("common", F.size(shared)).filter("common >= need")
    pairs = pairs.filter(F.size(F.array_except("names", "own")) == 0)
    return pairs.select("__row", "block", "template", (F.col("common") / F.col("size")).alias("share"))
