"""License scans: MinHash bands over text windows, verified exactly (DataFrame functions only).

Templates fall into classes by their number of five-word shingles.  For each
class a document is covered by overlapping windows, a quarter longer than the
class and a quarter of the class apart, so some window holds any whole
occurrence.  A window with none of a class's shingles contains nothing of its
templates and is passed over; the others get ``BANDS`` one-row MinHash bands,
which retrieve templates.  A window that holds four fifths of a template has a
Jaccard similarity to it of at least 0.45, so a band collides with that
probability and all bands miss with less than one in a million.  Retrieved
pairs are then verified by exact shingle containment.

Matches compete only for the same words: of matches that count the same
shingle of the document, the ones with the largest containment stay.

Template sets come from the caller (or the built-in notices) and are small
whatever the corpus: they are literals and broadcast, and documents aren't
shuffled; only verified pairs are grouped.  A set beyond
``MAX_TEMPLATE_SHINGLES`` is joined with the documents' shingles instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alnum_words, stage, text_or_empty

SHINGLE_WORDS, BANDS = 5, 24
#: Up to so many shingles all templates together become literals of the plan; more are joined.
MAX_TEMPLATE_SHINGLES = 50_000

#: Public license notices, in their usual wording.
NOTICES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "LGPL": (
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL-3.0": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}


def class_of(shingles: int) -> int:
    """The class of a template: its number of shingles, rounded up by an eighth at most."""
    step = max(1, 1 << max(0, shingles.bit_length() - 4))
    return -(-shingles // step) * step


def window_of(size: int) -> tuple[int, int]:
    """Shingles of a window of class ``size``, and from one window's start to the next's."""
    return size + size // 4, max(1, size // 4)


def template_table(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> DataFrame:
    """(license, template, shingles): each template's distinct shingle hashes."""
    rows = [(name, f"{name}/{k}", text) for name, texts in sorted(templates.items()) for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "license string, template string, text string")
    return _shingled(df.withColumn("hashes", F.transform(alnum_words(F.col("text")), lambda w: F.xxhash64(w)))).select(
        "license", "template", F.array_distinct("shingles").alias("shingles"))


def _shingled(df: DataFrame) -> DataFrame:
    """Adds ``shingles``: a hash per position of five consecutive entries of ``hashes``."""
    n = F.greatest(F.size("hashes") - F.lit(SHINGLE_WORDS - 1), F.lit(0))
    following = [lambda i, k=k: F.get(F.col("hashes"), i + k) for k in range(1, SHINGLE_WORDS)]
    return df.withColumn("shingles", F.transform(
        F.slice("hashes", F.lit(1), n), lambda h, i: F.xxhash64(h, *[f(i) for f in following])))


def _bands(shingles: Column) -> Column:
    """A value per band: the band's number and the smallest of the set's hashes under that band's order."""
    def band(k: int) -> Column:
        return F.xxhash64(F.lit(k), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(k)))))

    return F.array(*[band(k) for k in range(BANDS)])


def license_matches(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, id_col: str = "doc_id",
                    text_col: str = "text", min_containment: float = 0.8) -> DataFrame:
    """(id, license, containment, first_token): a row per document and license found in it.

    ``containment`` is the largest share of one of the license's templates'
    five-word shingles in a window, ``first_token`` the position of the first
    shingle matched.  Matches that count one and the same shingle of the
    document compete: only those with the largest share stay.  Tokens are
    lower-cased runs of letters and digits.  Null and short texts (under five
    tokens) match nothing; repeated rows of an id and null ids are one document
    each; an empty table gives no rows; other columns are ignored.  A template
    under five words is refused.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates or NOTICES)
    known = table.collect()  # the caller's templates, hashed
    if any(not r["shingles"] for r in known):
        raise ValueError("a license template needs at least five words")
    by_class: dict[int, set[int]] = {}
    for r in known:
        by_class.setdefault(class_of(len(r["shingles"])), set()).update(r["shingles"])
    few = sum(len(r["shingles"]) for r in known) <= MAX_TEMPLATE_SHINGLES

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                         F.transform(alnum_words(text_or_empty(text_col)), lambda w: F.xxhash64(w)).alias("hashes"))
    found = _shingled(source).select("row", "id", "shingles")
    if few:
        every = sorted(set().union(*by_class.values()))
        found = found.withColumn("hits", F.array_compact(F.transform("shingles", lambda h, i: F.when(h.isin(every), i))))
    else:
        found = stage(found, "license-shingles")
        places = found.select("row", F.posexplode("shingles").alias("i", "h"))
        wanted = table.select(F.explode("shingles").alias("h")).distinct()
        hits = places.join(wanted, "h").groupBy("row").agg(F.array_sort(F.collect_list("i")).alias("hits"))
        found = found.join(hits, "row")

    def windows(size: int, own: set[int]):
        """The class's windows that hold one of its shingles, each with its own part of the document."""
        length, step = window_of(size)
        mine = F.filter("hits", lambda i: F.get(F.col("shingles"), i).isin(sorted(own))) if few else F.col("hits")
        numbers = F.flatten(F.transform(mine, lambda i: F.sequence(
            F.greatest(F.lit(0), F.floor((i - F.lit(length) + F.lit(step)) / F.lit(step)).cast("int")),
            F.floor(i / F.lit(step)).cast("int"))))

        def part(j: Column) -> Column:
            places = F.filter("hits", lambda i: (i >= j * step) & (i < j * step + length))
            return F.struct(F.lit(size).alias("size"), F.array_distinct(F.slice("shingles", j * step + 1, length)).alias("window"),
                            F.transform(places, lambda i: F.struct(i.alias("at"), F.get(F.col("shingles"), i).alias("h"))).alias("places"))

        return F.transform(F.array_distinct(numbers), part)

    spots = F.concat(*[windows(size, own) for size, own in sorted(by_class.items())])
    # explode_outer: explode would add a filter on the array and so compute it twice.
    held = found.select("row", "id", F.explode_outer(spots).alias("w")).where(F.col("w").isNotNull()).select("row", "id", "w.*")
    banded = held.select("*", F.explode_outer(_bands(F.col("window"))).alias("band"))

    sizes = spark.createDataFrame([(r["template"], class_of(len(r["shingles"]))) for r in known],
                                  "template string, size int")
    templates_banded = table.join(F.broadcast(sizes), "template").select(
        "license", "template", "size", F.col("shingles").alias("wanted"), F.explode_outer(_bands(F.col("shingles"))).alias("band"))
    pairs = banded.join(F.broadcast(templates_banded) if few else templates_banded, ["size", "band"])
    share = F.size(F.array_intersect("wanted", "window")) / F.size("wanted")
    matched = F.transform(F.filter("places", lambda p: F.array_contains("wanted", p["h"])), lambda p: p["at"])
    verified = (pairs.select("row", "id", "license", "template", share.alias("share"), matched.alias("matched"))
                .where(F.col("share") >= min_containment))
    # One row per window and template (bands find a pair again and again), then per shingle that it counts.
    verified = verified.dropDuplicates(["row", "template", "matched"])
    each = verified.select("row", "id", "license", "template", "share", F.array_min("matched").alias("first"),
                           F.explode("matched").alias("at"), F.xxhash64("matched").alias("which"))
    rival = F.max("share").over(Window.partitionBy("row", "at"))
    kept = (each.withColumn("rival", rival).groupBy("row", "id", "license", "template", "share", "first", "which")
            .agg(F.max("rival").alias("rival")).where(F.col("rival") <= F.col("share")))
    return kept.groupBy("id", "license").agg(
        F.max("share").alias("containment"), F.min("first").cast("long").alias("first_token")).withColumnRenamed("id", id_col)
