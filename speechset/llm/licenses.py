"""License scans with MinHash bands over overlapping windows, in DataFrame functions only.

Texts and templates are words by one rule (runs of letters and digits, only A-Z lower-cased) and their runs of
``SHINGLE`` words. A template of s runs belongs to the size class L, the smallest power of two from s. The
windows of a class hold L + L/2 - 1 runs and start every L/2, so an occurrence always lies in one window whole, and
makes up at least a third of it. Every one of ``BANDS`` MinHash samples is a band of its own; a window that shares
one with a template of its class is a candidate. An occurrence with 80 percent of the template is missed with a chance of about
0.75 ** BANDS, one in a million. Candidates are verified by the exact share of the template's runs
that the window holds, as words and not as hashes.

The samples of all templates are a short list. A window without any of their runs cannot share a sample,
so texts and windows are first reduced to those that have one: that loses nothing.

Cases: null texts and texts under ``SHINGLE`` words match nothing. Null ids and repeated rows are rows like
others; rows of one id are reported together. Other columns are not looked at. Empty tables and empty
template lists give an empty result. Templates under ``SHINGLE`` words are refused.
"""

from __future__ import annotations

import string

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.llm.frames import texts
from speechset.session import small_table

SHINGLE = 5
BANDS = 48
PERCENT = 80
WORD = r"[\p{L}\p{N}]+"

# Notices as their licenses' stewards publish them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(f"({WORD})"), 1)


def template_words(text: str) -> list[str]:
    return regex.findall(WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def shingle_hashes(tokens: Column) -> Column:
    """A hash of each run of ``SHINGLE`` words; empty under that many words."""
    n = F.size(tokens) - SHINGLE
    at = lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(SHINGLE)])
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), at)).otherwise(F.array().cast("array<bigint>"))


def size_class(n: int) -> int:
    return 1 << (n - 1).bit_length()


def stride(size: int) -> int:
    return max(1, size // 2)


def _sample(hashes: Column, band: int) -> Column:
    """The hash nearest to a fixed random value, bit by bit: a random one of the set, for each band."""
    value = F.xxhash64(F.lit("band"), F.lit(band))
    return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(value)))


def template_runs(templates: dict[str, str]) -> list[tuple]:
    """license, number of distinct runs, size class, and each run as words."""
    rows = []
    for name, text in templates.items():
        tokens = template_words(text)
        runs = [tuple(tokens[i : i + SHINGLE]) for i in range(len(tokens) - SHINGLE + 1)]
        if not runs:
            raise ValueError(f"template {name} has under {SHINGLE} words")
        rows += [(name, len(set(runs)), size_class(len(runs)), *run) for run in dict.fromkeys(runs)]
    return rows


def template_samples(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """license, n_shingles, size, band, sample, and the hash of the run that gave the sample."""
    parts = [f"w{k}" for k in range(SHINGLE)]
    runs = small_table(spark, rows, "license string, n_shingles int, size int, " + ", ".join(f"{p} string" for p in parts))
    spread = runs.withColumn("h", F.xxhash64(*parts)).withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))))
    mixed = F.col("h").bitwiseXOR(F.xxhash64(F.lit("band"), F.col("band")))
    return spread.groupBy("license", "n_shingles", "size", "band").agg(F.min(mixed).alias("sample"), F.min_by("h", mixed).alias("probe"))


def _once(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """``value`` as a column that later filters cannot pull apart: as the one row of a generator it is
    computed once a row, where a plain column would be put, unfinished, into every place that uses it."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def _open_windows(size: int, probe: Column) -> Column:
    """The windows of a class that hold one of the runs of ``probe``."""
    step, h = stride(size), F.col("h")
    starts = F.transform(F.sequence(F.lit(0), F.ceil(F.size(h) / step).cast("int") - 1), lambda k: k * F.lit(step))
    held = F.filter(starts, lambda s: F.arrays_overlap(F.slice(h, s + 1, F.lit(size + step - 1)), probe))
    return F.transform(held, lambda s: F.struct(F.lit(size).alias("size"), s.alias("start")))


def scan(df: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per id and license found: n_shingles of the template, n_found (the most of them in one window),
    and first_word, where the first window with enough of them starts."""
    spark = df.sparkSession
    rows = template_runs(TEMPLATES if templates is None else templates)
    schema = "doc_id bigint, license string, n_shingles int, n_found int, first_word int"
    if not rows:
        return spark.createDataFrame([], schema)
    # Templates are a parameter: BANDS rows for each come to the driver, to become literals of the filters.
    listed = template_samples(spark, rows).orderBy("license", "band").collect()
    of_size: dict[int, set[int]] = {}
    own: dict[str, list] = {}
    for r in listed:
        of_size.setdefault(r["size"], set()).add(r["probe"])
        own.setdefault(r["license"], [r["license"], r["n_shingles"], r["size"], []])[3].append(r["sample"])
    table = [(*o, [" ".join(r[3:]) for r in rows if r[0] == o[0]]) for o in own.values()]
    own_table = small_table(spark, table, "license string, n_shingles int, t_size int, theirs array<bigint>, runs array<string>")
    longs = lambda values: F.array(*[F.lit(v).cast("bigint") for v in sorted(values)])

    docs = _once(texts(df, id_col, text_col), "w", words(F.col("text")), "doc_id")
    hashed = _once(docs.where(F.size("w") >= SHINGLE), "h", shingle_hashes(F.col("w")), "doc_id", "w")
    near = hashed.where(F.arrays_overlap("h", longs(set().union(*of_size.values()))))
    windows = [_open_windows(size, longs(probes)) for size, probes in sorted(of_size.items())]
    spread = near.select("doc_id", "w", "h", F.explode(F.concat(*windows)).alias("win")).select(
        "doc_id",
        F.col("win.size").alias("size"),
        F.col("win.start").alias("start"),
        F.slice("h", F.col("win.start") + 1, F.col("win.size") + F.greatest(F.lit(1), (F.col("win.size") / 2).cast("int")) - 1).alias("h"),
        F.slice("w", F.col("win.start") + 1, F.col("win.size") + F.greatest(F.lit(1), (F.col("win.size") / 2).cast("int")) - 1 + SHINGLE - 1).alias("w"),
    )
    samples = F.array(*[_sample(F.col("h"), b) for b in range(BANDS)])
    banded = spread.select("doc_id", "size", "start", "w", samples.alias("mine"))
    # A row a template: the list's length is part of the call.
    hit = F.exists(F.zip_with("mine", "theirs", lambda a, b: a == b), lambda x: x)
    met = banded.join(F.broadcast(own_table), (F.col("size") == F.col("t_size")) & hit)
    found = F.size(
        F.array_intersect(
            F.transform(F.sequence(F.lit(0), F.size("w") - SHINGLE), lambda i: F.concat_ws(" ", F.slice(F.col("w"), i + 1, SHINGLE))),
            F.col("runs"),
        )
    )
    verified = met.withColumn("n_found", found).where(100 * F.col("n_found") >= percent * F.col("n_shingles"))
    return verified.groupBy("doc_id", "license", "n_shingles").agg(
        F.max("n_found").alias("n_found"), F.min("start").alias("first_word")
    )
