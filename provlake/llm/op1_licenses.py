"""License scans: MinHash bands over overlapping windows retrieve templates, shingles verify them.

Only DataFrame functions are used.  A text's words (a-z, 0-9 runs of the lower-cased text) give
five-word shingles, and shorter ones of the lengths of templates that have fewer words than five.
Texts are first cut into segments of SEGMENT windows, which carry the words around them, so that no row
grows with its text.  Windows of WIDTH words start every STRIDE words, so each shingle away from a text's
ends lies whole in two of them.
Their MinHash sketch is one permutation cut into 2**BIN_BITS bins by a hash's highest bits: a bin's value
is the smallest shingle hash in it, and each bin is a band of one row.  A window that holds a template's
shingle agrees with the template in that shingle's bin unless another of its (at most WIDTH per shingle
length) shingles falls into the same bin with a smaller value: a chance of at most WIDTH / 2**BIN_BITS / 2
per length, under 2e-8 for two lengths.  One agreeing band in one window retrieves a template, so a
one-shingle template's line is missed with a probability below 2e-8, and that squared where two windows hold it.
Of a window's bands only those that some template has are worked out, up to LITERAL template shingles;
beyond, all are, and the join with the templates sorts them out.

Candidates, one for each window and template, are verified exactly: the share of the template's distinct
shingles that stand within the template's length of the window, at least THRESHOLD (0.8).

Defined cases: null or wordless texts have no license; rows that share a doc_id are reported together;
ties need no rule, as each (document, license) pair is one row; no hits or an empty table give no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm.common import table

SHINGLE, WIDTH, STRIDE, BIN_BITS, THRESHOLD = 5, 64, 30, 32, 0.8
#: Windows of a segment; template shingles that stand in the plan; templates that are broadcast.
SEGMENT, LITERAL, BROADCAST = 40, 2_000, 20_000

#: Wordings of public licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("LicenseRef-all-rights-reserved", "All rights reserved"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    (
        "BSD-2-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def words_of(text: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-cased text; an empty word may stand at either end, in no template's shingle."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def _bind(value: Column, body) -> Column:
    """body(value) with value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(words: Column, size: int) -> Column:
    """Hashes of the shingles from each word; none for texts of fewer words.  ``words``: hashes of the words."""
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))).otherwise(none)


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - BIN_BITS)


def bands(window: Column, known: Column | None = None) -> Column:
    """The smallest hash of each bin of a window; only of the bins of hashes in ``known``, if given."""
    mine = F.array_distinct(window) if known is None else F.array_intersect(window, known)
    return F.filter(mine, lambda h: ~F.exists(window, lambda x: (_bin(x) == _bin(h)) & (x < h)))


def templates(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """license, template, n_words, size, shingles of each template."""
    df = spark.createDataFrame(rows if rows is not None else TEMPLATES, "license string, template string").coalesce(1)
    df = df.select("license", "template", F.transform(F.filter(words_of(F.col("template")), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("w")).where(F.size("w") > 0)
    parts = [df.where(F.size("w") == n).select("*", F.lit(n).alias("size"), shingles(F.col("w"), n).alias("s")) for n in range(1, SHINGLE)]
    parts.append(df.where(F.size("w") >= SHINGLE).select("*", F.lit(SHINGLE).alias("size"), shingles(F.col("w"), SHINGLE).alias("s")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("license", "template", F.size("w").alias("n_words"), "size", F.array_distinct("s").alias("s"))


def scan(docs: DataFrame, known: DataFrame, threshold: float = THRESHOLD, literal: int = LITERAL) -> DataFrame:
    """doc_id, license, containment (best place), n_places (windows that verified)."""
    facts = known.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes"), F.max("n_words").alias("longest"), F.sum(F.size("s")).alias("hashes")).first()
    if not facts.n:
        return docs.select("doc_id").limit(0).select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("n_places"))
    sizes, longest = sorted(facts.sizes), facts.longest
    few = None
    if facts.hashes <= literal:
        few = F.array(*[F.lit(h) for h in sorted({h for r in known.select("s").collect() for h in r.s})])
    # segments, each with the words around its windows
    step = SEGMENT * STRIDE
    reach = step - STRIDE + WIDTH + longest + SHINGLE
    words = docs.where(F.col("text").isNotNull()).select("doc_id", words_of(F.col("text").cast("string")).alias("w"))
    last = F.ceil(F.greatest(F.size("w") - WIDTH, F.lit(0)) / STRIDE).cast("int")
    part = F.transform(
        F.sequence(F.lit(0), F.floor(last / SEGMENT).cast("int")),
        lambda k: F.struct(
            (k * SEGMENT).alias("win0"), F.least(last - k * SEGMENT, F.lit(SEGMENT - 1)).alias("last"), F.least(k * step, F.lit(longest)).alias("o"),
            F.slice("w", F.greatest(k * step - longest, F.lit(0)) + 1, F.least(k * step, F.lit(longest)) + reach).alias("w"),
        ),
    )
    base = words.select("doc_id", F.explode(part).alias("p")).select("doc_id", "p.win0", "p.last", "p.o", F.transform("p.w", lambda w: F.xxhash64(w)).alias("w"))
    base = base.select("doc_id", "win0", "last", "o", *[shingles(F.col("w"), s).alias(f"h{s}") for s in sizes])
    window = lambda i: F.concat(*[F.slice(f"h{s}", F.col("o") + i * STRIDE + 1, WIDTH - s + 1) for s in sizes])
    wins = F.sequence(F.lit(0), F.col("last"))
    if few is not None:
        wins = F.filter(wins, lambda i: F.arrays_overlap(window(i), few))
    found = base.select("*", F.explode(wins).alias("i")).select("*", bands(window(F.col("i")), few).alias("bands"))
    keyed = known.select("license", "template", "size", "s", F.explode("s").alias("band"))
    got = found.select("*", F.explode("bands").alias("band")).join(F.broadcast(keyed) if facts.n <= BROADCAST else keyed, "band")
    # a template agrees in several bands: the smallest of them stands for the pair
    got = got.where(F.col("band") == F.array_min(F.array_intersect("s", "bands")))
    at = F.col("o") + F.col("i") * STRIDE
    low = F.greatest(F.lit(0), at - longest)
    near = lambda s: F.slice(f"h{s}", low + 1, at - low + WIDTH + longest)
    share = F.coalesce(*[F.when(F.col("size") == s, F.size(F.array_intersect("s", near(s))) / F.size("s")) for s in sizes])
    out = got.select("doc_id", "license", (F.col("win0") + F.col("i")).alias("win"), share.alias("containment")).where(F.col("containment") >= threshold)
    return out.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.countDistinct("win").alias("n_places"))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, templates(spark))
