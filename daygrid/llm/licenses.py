"""License scans: which licence notices a text contains, by DataFrame operations alone.

A notice of w words is looked for in windows of the texts that overlap: windows of its size class (w
rounded up to the next of 5, 7, 9, 11, 13, 16, 20, 25, ..., each about a quarter more) and a stride more, one at each multiple of the stride, a quarter of
the class; so one window holds any occurrence whole. Windows and notices are sets of five-word shingles with MinHash signatures of
``BANDS`` bands of one row. A window that has ``CONTAINED`` of a notice has a Jaccard similarity of 0.45 or more with it, so
all bands differ with probability 0.55 ** 20 = 6e-6 at most; notices retrieved by a shared band are verified by exact containment.

A window without any shingle of any notice has similarity 0 with all, so only windows around places of such shingles get a
signature; ``windows.py`` finds these places without a shuffle of text. A document's own words bound what is collected for it.

Defined cases: NULL and empty texts contain nothing; a notice needs five words; notices with the same id are alternatives;
repeated rows get one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.windows import SEPARATORS, lowered, occurrences, spread, words
from daygrid.sizing import broadcast_within, row_bound, stored

SHINGLE = 5
CONTAINED = 0.8
BANDS = 20

# Notices as they are commonly written, and sentences of the bodies that no other of these licences has. Those of versions of one
# family are so short that each has less than CONTAINED of another.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]


def size_class(n: int) -> int:
    size = SHINGLE
    while size < n:
        size += max(2, size // 4)
    return size


def stride(size: int) -> int:
    return max(1, (size - SHINGLE + 1) // 4)


def notices(spark: SparkSession, given: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """``notice, license_id, size, step, shingles``, one row for each of ``given``."""
    frame = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "notice int, license_id string, text string")
    # The notices are a parameter; their word counts decide the sizes of windows.
    counted = frame.select("notice", F.size(words(F.col("text"))).alias("n")).collect()
    if any(r["n"] < SHINGLE for r in counted):
        raise ValueError(f"a notice needs {SHINGLE} words")
    sizes = spark.createDataFrame([(r["notice"], size_class(r["n"]), stride(size_class(r["n"]))) for r in counted], "notice int, size int, step int")
    return frame.join(F.broadcast(sizes), "notice").select("notice", "license_id", "size", "step", F.array_distinct(spread(words(F.col("text")), SHINGLE)).alias("shingles"))


def _bands(shingles: Column) -> Column:
    """MinHash of a set of shingles under each of the hash functions."""
    least = lambda j: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(j))))
    return F.array(*map(least, range(BANDS)))


def found(docs: DataFrame, given: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``key, license_id, containment``: the largest share of a notice of the licence in one window of the document ``key, text``."""
    given = stored(given, small=True)
    parts = stored(given.select("size", "step", F.explode("shingles").alias("window")).distinct(), small=True)
    places = occurrences(docs, parts.select("window").distinct()).select("key", "start", "window").distinct()
    first = F.greatest(F.lit(0), F.ceil((F.col("start") + SHINGLE - F.col("size") - F.col("step")) / F.col("step"))).cast("int")
    last = F.floor(F.col("start") / F.col("step")).cast("int")
    cells = places.join(F.broadcast(parts), "window").select("key", "size", "step", F.explode(F.sequence(first, last)).alias("cell")).distinct()
    cells = stored(cells.groupBy("key").agg(F.collect_set(F.struct("size", "step", "cell")).alias("cells")), small=True)
    # Only documents with such a place are read as words again, and each is split once: its windows are cut from the stored words.
    keys = cells.select("key")
    hit = docs.join(broadcast_within(keys, row_bound(keys, 100_000)), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    known = stored(hit.join(cells, "key").select("key", "cells", F.filter(F.split("text", SEPARATORS, -1), lambda w: w != "").alias("words")))
    cut = F.transform("cells", lambda c: F.struct(c.alias("cell"), F.slice("words", c["cell"] * c["step"] + 1, c["size"] + c["step"]).alias("words")))
    split = known.select("key", F.explode(cut).alias("own")).select("key", "own.cell", "own.words")
    text = lowered(F.array_join("words", " "))
    windows = split.select("key", F.col("cell.size").alias("size"), F.col("cell.cell").alias("cell"), F.split(text, " ").alias("words"))
    own = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("words") - SHINGLE + 1), lambda i: F.array_join(F.slice("words", i, F.lit(SHINGLE)), " ")))
    windows = stored(windows.where(F.size("words") >= SHINGLE).select("key", "size", "cell", own.alias("own")), small=True)
    left = windows.select("key", "size", "cell", "own", F.posexplode(_bands(F.col("own"))).alias("band", "hash"))
    right = given.select("notice", "size", F.posexplode(_bands(F.col("shingles"))).alias("band", "hash"))
    retrieved = left.join(F.broadcast(right), ["size", "band", "hash"]).groupBy("key", "size", "cell", "notice").agg(F.first("own").alias("own"))
    share = F.size(F.array_intersect("own", "shingles")) / F.size("shingles")
    verified = retrieved.join(F.broadcast(given.select("notice", "license_id", "shingles")), "notice").withColumn("share", share).where(F.col("share") >= contained)
    return verified.groupBy("key", "license_id").agg(F.max("share").alias("containment"))


def scanned(docs: DataFrame, given: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``doc_id, licenses`` of every row of ``docs``: an array of ``license_id`` and ``containment``, in order of the ids."""
    keyed = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    own = found(keyed.select("key", "text"), given, contained).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("license_id", "containment"))).alias("licenses"))
    return keyed.select("doc_id", "key").join(own, "key", "left").select("doc_id", F.coalesce("licenses", F.array().cast("array<struct<license_id:string,containment:double>>")).alias("licenses"))
