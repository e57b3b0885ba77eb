"""License scans: which license texts stand in a document, found by MinHash over overlapping windows.

Words are cut into windows of twice a class's length, half a window apart, so that a passage of that length lies
whole in one of them. A license belongs to the class of the next power of two of its length. Of each window
and each license, BANDS minima of hashed three-word shingles are made; a window meets the licenses with
which it shares one. A whole license makes a sixth of its window's shingles at least, so they share a
minimum with a probability of 1 - (5/6)^96 > 0.9999999, and with four fifths of it left, of 1 - (1 - 0.8/6)^96
> 0.999998. What meets is verified: the part of the license's distinct shingles that the window contains.

A window that contains fewer license shingles than the shortest license of its class needs cannot verify,
and is not hashed; for the others nothing is left out.

Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm.common import quoted, stored

SHINGLE = 3
BANDS = 96
#: Part of a license's shingles that a window must contain, in percent.
PERCENT = 80

# Wordings of licenses and notices, as their publishers give them.
LICENSES: tuple[tuple[str, str], ...] = (
    ("mit-line", "Released under the MIT License."),
    ("apache-line", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0-work", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("all-rights-reserved", "All rights reserved."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def shingles(word_list: Column) -> Column:
    """Hashes of all runs of three words, in order; with fewer words there are none."""
    rows = F.arrays_zip(word_list.alias("a"), F.slice(word_list, 2, 1 << 30).alias("b"), F.slice(word_list, 3, 1 << 30).alias("c"))
    each = F.transform(rows, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    return F.when(F.size(word_list) >= SHINGLE, F.slice(each, 1, F.size(word_list) - (SHINGLE - 1))).otherwise(F.array().cast("array<bigint>"))


def _minima(hashes: Column) -> Column:
    """BANDS minima, each under another hash."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(BANDS)),
        lambda band: F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, band))))


def templates(spark: SparkSession, licenses: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """license, length (of its class), shingles (distinct hashes): one row per license of three words or more."""
    listed = spark.createDataFrame(list(licenses), "license string, text string")
    length = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size("words"), F.lit(4))))).cast("int")
    return (
        listed.select("license", words(F.col("text")).alias("words")).select(
            "license", length.alias("length"), F.array_distinct(shingles(F.col("words"))).alias("shingles"))
        .filter(F.size("shingles") > 0)
    )


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", licenses: tuple[tuple[str, str], ...] = LICENSES) -> DataFrame:
    """doc_id, license, n_common and containment (of the license's distinct shingles, n_common over all of them) for
    each license that some window of a document's text contains to PERCENT hundredths or more, the best window's.

    Null, empty and shorter texts contain none. Rows of one id are one document. Rows without id are together one
    more, with a null id. An empty table gives no rows.
    """
    spark = docs.sparkSession
    known = stored(templates(spark, licenses), "licenses")
    # As many rows as licenses are given: they are few, and their hashes become part of the query.
    rows = known.collect()
    if not rows:
        return docs.select(quoted(doc_id).alias("doc_id"), F.lit("").alias("license"), F.lit(0).alias("n_common"), F.lit(0.0).alias("containment")).limit(0)
    all_hashes = sorted({x for row in rows for x in row["shingles"]})
    lengths = sorted({row["length"] for row in rows})
    least = {n: min(-(-len(row["shingles"]) * PERCENT // 100) for row in rows if row["length"] == n) for n in lengths}

    cut = docs.select(quoted(doc_id).alias("doc_id"), words(quoted(text).cast("string")).alias("words"))
    hashed = cut.select("doc_id", shingles(F.col("words")).alias("all"))
    places = F.filter(
        F.transform("all", lambda x, k: F.when(x.isin(all_hashes), k).otherwise(F.lit(-1))), lambda k: k >= 0)
    some = hashed.withColumn("places", places).filter(F.size("places") > 0)
    # Windows number w of a class start at word w * length and have 2 * length words.
    each_class = F.array(*[F.struct(F.lit(n).alias("length"), F.lit(least[n]).alias("least")) for n in lengths])
    classed = some.withColumn("class", F.explode(each_class)).select("doc_id", "all", "places", "class.*")
    numbers = F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(
        F.floor(p / F.col("length")), F.greatest(F.floor(p / F.col("length")) - 1, F.lit(0))))))
    windows = classed.withColumn("window", F.explode(numbers))
    first, span = F.col("window") * F.col("length"), 2 * F.col("length") - (SHINGLE - 1)
    inside = F.size(F.filter("places", lambda p: (p >= first) & (p < first + span)))
    full = windows.filter(inside >= F.col("least")).select(
        "doc_id", "length", "window", F.array_distinct(F.slice("all", (first + 1).cast("int"), span)).alias("own"))
    signed = full.withColumn("minima", _minima(F.col("own")))
    bands = signed.select("doc_id", "length", "window", "own", F.posexplode("minima").alias("band", "least_hash"))
    # A row per license and band.
    sought = F.broadcast(known.select("license", "length", "shingles", F.posexplode(_minima(F.col("shingles"))).alias("band", "least_hash")))
    met = bands.join(sought, ["length", "band", "least_hash"])
    common = F.size(F.array_intersect("own", "shingles"))
    verified = met.select("doc_id", "license", common.alias("n_common"), F.size("shingles").alias("n")).filter(100 * F.col("n_common") >= PERCENT * F.col("n"))
    return verified.groupBy("doc_id", "license").agg(
        F.max("n_common").cast("long").alias("n_common"), F.max(F.col("n_common") / F.col("n")).alias("containment"))
