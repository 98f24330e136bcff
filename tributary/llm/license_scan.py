"""License scan with DataFrame functions alone.

Words of a text form overlapping windows, twice as long as the license notices
they are meant for. One-row MinHash bands retrieve the notices that a window may
hold; their number is set so that a window which does hold one is missed with at
most a given probability. Candidates are verified by exact containment of the
notice's shingles in the window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.staging import stage

#: Words of a shingle, share of a notice's shingles that proves it, probability of a miss.
SHINGLE, CONTAINMENT, MISS = 3, 0.8, 1e-4

# Names and wording of usual notices.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("All rights reserved", "All rights reserved."),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of `size` words in order; none where there are fewer words. `words` is a column, not an expression."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, size))))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0)))


def _held(expression: Column) -> Column:
    """The expression computed once a row, whatever is asked of it afterwards: generated values are not moved."""
    return F.explode(F.array(expression))


def bands_for(window_shingles: int, least_shingles: int, containment: float, miss: float) -> int:
    """One-row bands so that windows holding such a notice share one with it but for probability `miss`."""
    common = math.ceil(containment * least_shingles)
    similarity = common / (window_shingles + least_shingles - common)
    return math.ceil(math.log(miss) / math.log(1 - similarity)) if similarity < 1 else 1


def _band_keys(shingles: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda band: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, band))))


def find_notices(documents: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, shingle: int = SHINGLE,
                 containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """doc_id, license, first_word, n_windows, containment of every document and each notice it holds.

    first_word is where the first window begins that holds the notice, containment the best share of its shingles in a
    window. Words are runs of letters and digits in lower case, shingles runs of `shingle` words. Documents without
    notice give no row, as do null, empty and shorter texts; notices shorter than a shingle are not looked for. Repeated
    doc_ids, and rows without one, count together. Several thousand notices can be given; they are sent to all tasks.
    """
    spark = documents.sparkSession
    table = stage(spark.createDataFrame(list(notices), "license string, notice string")
                  .select("license", _held(_words(F.col("notice"))).alias("words"))
                  .select("license", F.size("words").alias("length"), F.array_distinct(_shingles(F.col("words"), shingle)).alias("needed"))
                  .filter(F.size("needed") > 0), "notices")
    lengths = table.select("length", F.size("needed").alias("n")).collect()  # of the given notices
    wanted = [r[0] for r in table.select(F.explode("needed")).distinct().collect()]
    result = spark.createDataFrame([], "doc_id long, license string, first_word int, n_windows long, containment double")
    if not wanted:
        return result
    known = F.array(*(F.lit(s) for s in wanted))
    # A text or window without a single shingle of any notice shares no minimum with one, so it is not hashed.
    texts = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), _held(_words(F.col("text"))).alias("words"))
             .filter(F.size("words") >= shingle).select("doc_id", _held(_shingles(F.col("words"), shingle)).alias("shingles"))
             .filter(F.arrays_overlap("shingles", known)))
    texts = stage(texts, "texts-with-notices")
    tiers: dict[int, list] = {}
    for length, n in lengths:
        tiers.setdefault(1 << max(1, (length - 1).bit_length()), []).append(n)
    for longest, sizes in sorted(tiers.items()):
        inside = 2 * longest - shingle + 1
        bands = bands_for(inside, min(sizes), containment, miss)
        begin = F.explode(F.sequence(F.lit(0), F.size("shingles") - 1, F.lit(longest)))
        windows = (texts.select("doc_id", "shingles", begin.alias("begin"))
                   .select("doc_id", "begin", _held(F.slice("shingles", F.col("begin") + 1, F.lit(inside))).alias("window"))
                   .filter(F.arrays_overlap("window", known)))
        hashed = windows.select("doc_id", "begin", "window", F.posexplode(_band_keys(F.col("window"), bands)).alias("band", "key"))
        own = table.filter((F.col("length") > longest // 2 if longest > 2 else F.lit(True)) & (F.col("length") <= longest))
        posted = own.select("license", "needed", F.posexplode(_band_keys(F.col("needed"), bands)).alias("band", "key"))
        share = F.size(F.array_intersect("needed", "window")) / F.size("needed")
        result = result.union(
            hashed.join(F.broadcast(posted), ["band", "key"]).select("doc_id", "license", "begin", share.alias("share"))
            .filter(F.col("share") >= containment).distinct()
            .groupBy("doc_id", "license").agg(F.min("begin").alias("first_word"), F.count("*").alias("n_windows"),
                                              F.max("share").alias("containment")))
    return result
