"""License scan by diagonal voting.

Every rolling word k-gram of a document is joined by its hash (and then by the
gram itself) to the positions where a license template has it.  A hit lies on
the diagonal *document position - template position*; a copied statement puts
many hits on one diagonal, and a statement with a word added or left out puts
them on neighbouring ones.  Per document and template, diagonals at most
``gap`` apart are merged into one span.  A span is verified by alignment: of its
hits the longest chain that goes forward in document and template alike counts,
and its score is the share of the template's words that the chain covers.  Words
in another order than the template's don't verify.

Templates are a table (``label``, ``text``) of any size; without one the public
notices below are used.  Their grams are a written table, broadcast if their
bytes are within ``BROADCAST_BYTES``, else joined by a shuffle.  Only grams that
hit are shuffled further.  A template of fewer than k words has no grams and is
never found.

Base phrases are searched exactly, word by word; labels of the method are
added to theirs.  Defined results: a null or empty text has no words, null
positions, empty labels and score 0; rows that repeat an id are scanned each;
null templates have no words; of the input only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, materialise, table

K = 3
GAP = 2
MIN_COVERAGE = 0.7
BROADCAST_BYTES = 16 << 20

# Phrases whose places the base counts, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of public licenses and of the usual notices that refer to them.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the software the software is "
            "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
            "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
            "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
            "arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
               "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
               "without warranties or conditions of any kind either express or implied see the license for the specific "
               "language governing permissions and limitations under the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
            "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
             "published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
            "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to "
             "alter it and redistribute it freely subject to the following restrictions"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this "
            "software to the public domain worldwide"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("artistic", "you may distribute under the terms of either the gnu general public license or the artistic license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or "
                    "by any means without the prior written permission of the publisher"),
]

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    # lower() makes one other letter ASCII, the Kelvin sign (k); it is set aside first.
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(templates, "label string, text string")


def template_grams(templates: DataFrame, k: int = K) -> tuple[DataFrame, bool]:
    """The grams of a template table (``label``, ``text``) as a written table, and whether they are
    few enough to broadcast."""
    rows = templates.select(F.monotonically_increasing_id().alias("t"), "label", license_words(F.col("text")).alias("w"))
    rows = rows.select("t", "label", F.size("w").alias("t_words"), F.posexplode(_grams(F.col("w"), k)).alias("t_pos", "t_gram"))
    grams = materialise(rows.withColumn("t_hash", F.xxhash64("t_gram")), "license-grams")
    size = grams.agg(F.sum(F.octet_length("t_gram") + F.octet_length("label") + 60)).first()[0] or 0
    return (F.broadcast(grams) if size <= BROADCAST_BYTES else grams), size <= BROADCAST_BYTES


def _grams(words: Column, k: int) -> Column:
    count = F.size(words) - (k - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat_ws(
        " ", *[F.get(words, i + j) for j in range(k)])))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    def at(i):
        same = F.get(words, i) == parts[0]
        for j, w in enumerate(parts[1:], 1):
            same = same & F.coalesce(F.get(words, i + j) == w, F.lit(False))
        return same
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)


def forward_chain(hits: list[tuple[int, int]]) -> list[int]:
    """Template positions of the longest chain of hits (document position, template position) that
    goes forward in both; of equally long chains one that ends earliest in the template."""
    ends: list[int] = []  # least template position that a chain of each length ends at
    at: list[int] = []  # its hit
    before = [-1] * len(hits)
    order = sorted(range(len(hits)), key=lambda i: (hits[i][0], -hits[i][1]))  # of one place only one hit counts
    for i in order:
        n = bisect_left(ends, hits[i][1])
        before[i] = at[n - 1] if n else -1
        ends[n:n + 1], at[n:n + 1] = [hits[i][1]], [i]
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(hits[i][1])
        i = before[i]
    return chain[::-1]


def _aligned(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = []
            for hits in batch.column(batch.num_columns - 1).to_pylist():
                chain = forward_chain([(h["p"], h["t"]) for h in hits])
                covered.append(len({x + j for x in chain for j in range(k)}))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(covered, pa.int32())],
                                             names=[*batch.schema.names[:-1], "covered"])
    return run


def spans(docs: DataFrame, keys: list[str], words: str, templates: DataFrame, k: int = K, gap: int = GAP) -> DataFrame:
    """Candidate spans: ``keys``, template, label, first and last word, and
    ``coverage`` (share of the template's words that the span's forward chain covers).
    ``templates`` are grams as ``template_grams`` gives them."""
    rolled = docs.select(*keys, F.posexplode(_grams(F.col(words), k)).alias("_pos", "_gram"))
    hits = rolled.join(templates, (F.xxhash64("_gram") == F.col("t_hash")) & (F.col("_gram") == F.col("t_gram")))
    hits = hits.select(*keys, "t", "label", "t_words", "t_pos", "_pos", (F.col("_pos") - F.col("t_pos")).alias("_diagonal"))
    votes = hits.groupBy(*keys, "t", "label", "t_words", "_diagonal").agg(
        F.collect_set(F.struct(F.col("_pos").alias("p"), F.col("t_pos").alias("t"))).alias("_at"),
        F.min("_pos").alias("_from"), (F.max("_pos") + k - 1).alias("_to"))
    # One document's diagonals for one template: no more than the document has words.
    w = Window.partitionBy(*keys, "t").orderBy("_diagonal")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(w) > gap, F.lit(True))
    merged = votes.withColumn("_span", F.sum(apart.cast("int")).over(w))
    merged = merged.groupBy(*keys, "t", "label", "t_words", "_span").agg(
        F.count("*").alias("_diagonals"), F.flatten(F.collect_list("_at")).alias("_at"),
        F.min("_from").alias("first"), F.max("_to").alias("last"))
    merged = materialise(merged, "license-candidates")
    columns = [*keys, "t", "label", "t_words", "first", "last"]
    # On one diagonal all hits go forward; several are aligned.
    straight = merged.where("_diagonals = 1").select(*columns, F.size(F.array_distinct(F.flatten(F.transform(
        "_at", lambda x: F.sequence(x["t"], x["t"] + (k - 1)))))).alias("covered"))
    bent = merged.where("_diagonals > 1").select(*columns, "_at")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bent.schema.fields[:-1])
    every = straight.unionByName(map_arrow(bent, _aligned(k), f"{kinds}, covered int"))
    return every.select(*keys, "t", "label", "first", "last", (F.col("covered") / F.col("t_words")).alias("coverage"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_coverage: float = MIN_COVERAGE,
         templates: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: base places and labels, and the method's labels.
    ``templates`` (``label``, ``text``): the statements to look for."""
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_row"),
                       F.contains(F.lower(F.coalesce(text_col, F.lit(""))), F.lit("license")).alias("_maybe"),
                       license_words(F.col(text_col)).alias("_words"))
    grams, _ = template_grams(template_table(docs.sparkSession) if templates is None else templates)
    found = spans(rows, ["_id", "_row"], "_words", grams)
    found = found.groupBy("_id", "_row").agg(
        F.max("coverage").alias("_score"),
        F.collect_set(F.when(F.col("coverage") >= min_coverage, F.col("label"))).alias("_labels"))
    found = materialise(found, "license-spans").withColumnsRenamed({"_id": "_fid", "_row": "_frow"})

    none = F.array().cast("array<int>")
    places = rows.select("_id", "_row", F.size("_words").alias("_n"), *[
        F.when(F.col("_maybe"), _places(F.col("_words"), p)).otherwise(none).alias(f"_p{i}") for i, p in enumerate(PHRASES)])
    every = F.concat(*[F.col(f"_p{i}") for i in range(len(PHRASES))])
    base = F.array_compact(F.array(*[F.when(F.size(f"_p{i}") > 0, F.lit(label))
                                     for i, label in enumerate(PHRASES.values())]))
    places = places.select("_id", "_row", "_n", every.alias("_every"), F.array_sort(F.array_distinct(base)).alias("_base"))
    out = places.join(found, F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_row") == F.col("_frow")), "left")
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    return out.select(F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_words"),
                      F.size("_every").cast("long").alias("n_base"),
                      F.array_min("_every").cast("long").alias("first_word"),
                      F.array_max("_every").cast("long").alias("last_word"),
                      F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                      F.coalesce("_score", F.lit(0.0)).alias("score"))


def op10_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
