"""License scan by diagonal voting.

Every rolling k-gram of words of a text is joined to the positions at which
license templates have it. A hit at word i of the text and word j of a
template votes for the diagonal i - j; an unbroken copy puts all its votes on
one diagonal, and inserted or missing words move the rest to a neighbouring
one. Diagonals of a template that lie close together are merged to a span.
A span that holds enough of the template's grams is verified: the words around
its strongest diagonal, as many as the template has and a slack on both sides,
are aligned with the template, and enough of them must stand there in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.text import ascii_lower

K = 3
MIN_COVER = 0.8
#: Diagonals at most so many words apart are merged.
MAX_SHIFT = 3
#: Words beside a span that its verification looks at, as a share of the template's.
SLACK = 0.25
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The phrases whose places are counted, and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Words of license notices, and their labels.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
)


def templates() -> list[tuple[int, str, bool, str]]:
    """(template, label, is a base phrase, words)"""
    return [(i, label, i < len(PHRASES), text) for i, (label, text) in enumerate(PHRASES + NOTICES)]


GRAMS = "gram string, template int, label string, base boolean, at int, n_grams int"


def in_order(text: Column, template: Column) -> Column:
    """The most words of the template that stand in the text in their order (longest common subsequence)."""
    none = F.transform(template, lambda x: F.lit(0))

    def step(row: Column, word: Column) -> Column:
        # row[j]: the most of the template's first j + 1 words; it never falls, so a running maximum ends the step.
        more = F.transform(row, lambda n, j: F.greatest(n, F.when(F.get(template, j) == word, F.coalesce(F.get(row, j - 1), F.lit(0)) + 1).otherwise(0)))
        empty = F.struct(F.lit(0).alias("m"), F.array().cast("array<int>").alias("row"))
        return F.aggregate(more, empty, lambda a, n: F.struct(F.greatest(a["m"], n).alias("m"), F.array_append(a["row"], F.greatest(a["m"], n)).alias("row")))["row"]

    return F.element_at(F.aggregate(text, none, step), -1)


def grams(spark: SparkSession) -> DataFrame:
    """(h, gram, template, label, base, at, n_grams): under a thousand rows, fixed by the lists above."""
    rows = []
    for i, label, base, text in templates():
        w = text.split()
        n = len(w) - K + 1
        rows += [(" ".join(w[j : j + K]), i, label, base, j, n) for j in range(n)]
    df = spark.createDataFrame(rows, GRAMS)
    part = F.split("gram", " ")
    return df.withColumn("h", F.xxhash64(*(part[j] for j in range(K))))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    n_base counts the places of base phrases: diagonals that hold all of a
    phrase's grams. labels adds those of verified spans: at least MIN_COVER
    of a template's grams in the span, and as large a share of its words in
    order around the strongest diagonal. score is the largest share of grams
    found for any template, at most that of the words in order where the span
    was aligned; 0 where no gram is found. Grams are joined by hash and
    compared as text, so equal hashes of different words never vote.

    Null text is empty. Each text carries one sentinel gram through the join,
    so texts without a hit keep their row in the same pass; equal (id, text)
    rows are counted once and repeated at the end. Other columns are not read.
    """
    spark = docs.sparkSession
    table = grams(spark)
    none = -1
    sentinel = spark.createDataFrame([("", none, "", False, 0, 1)], GRAMS).withColumn("h", F.lit(none).cast("long"))
    table = F.broadcast(table.unionByName(sentinel))

    t = ascii_lower(F.col(text_col))
    w = F.array_remove(F.split(t, SEPARATORS), "")
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), w.alias("w"))
    h = F.transform(F.slice("w", 1, F.greatest(F.size("w") - (K - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(F.col("w"), i + j) for j in range(1, K))))
    base = base.select("id", "text_key", "w", F.size("w").cast("long").alias("n_words"), F.array_append(h, F.lit(none).cast("long")).alias("hs"))
    # Outer, since the planner would test an inner one's array for size and so build it twice; it is never empty.
    hits = base.select("id", "text_key", "n_words", "w", F.posexplode_outer("hs").alias("i", "h")).join(table, "h")
    hits = hits.where((F.col("template") == none) | (F.array_join(F.slice("w", F.col("i") + 1, F.lit(K)), " ") == F.col("gram")))
    key = ["id", "text_key", "n_words"]
    diagonal = F.when(F.col("template") != none, F.col("i") - F.col("at"))
    side = (F.col("n_grams") + (K - 1)) * SLACK
    start = F.greatest(F.col("i") - F.col("at") - F.floor(side).cast("int") - 1, F.lit(0))
    stop = F.col("i") - F.col("at") + F.col("n_grams") + (K - 1) + F.floor(side).cast("int") + 1
    around = F.when((F.col("template") != none) & ~F.col("base"), F.slice("w", start + 1, stop - start))
    votes = hits.groupBy(*key, "template", "label", "base", "n_grams", diagonal.alias("diagonal")).agg(
        F.count("*").alias("n"), F.collect_set("at").alias("ats"), F.first(around).alias("around")
    )
    near = Window.partitionBy(*key, "template").orderBy("diagonal")
    step = (F.col("diagonal") - F.lag("diagonal").over(near) > MAX_SHIFT).cast("int")
    votes = votes.withColumn("span", F.sum(F.coalesce(step, F.lit(0))).over(near))
    spans = votes.groupBy(*key, "template", "label", "base", "n_grams", "span").agg(
        F.sum("n").alias("n"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("found"),
        F.sum((F.size("ats") == F.col("n_grams")).cast("long")).alias("places"),
        F.min(F.when(F.size("ats") == F.col("n_grams"), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.size("ats") == F.col("n_grams"), F.col("diagonal"))).alias("last"),
        F.max(F.struct(F.size("ats").alias("n"), (-F.col("diagonal")).alias("d"), "around")).alias("peak"),
    )
    cover = F.col("found") / F.col("n_grams")
    length = F.col("n_grams") + (K - 1)
    texts = F.array(*(F.split(F.lit(text), " ") for _, _, _, text in templates()))
    aligned = F.when((F.col("places") == 0) & ~F.col("base") & (F.col("template") != none) & (cover >= MIN_COVER), in_order(F.col("peak.around"), F.get(texts, F.col("template"))) / length)
    spans = spans.withColumn("cover", cover).withColumn("aligned", F.coalesce(aligned, F.lit(1.0))).withColumn("cover", F.least("cover", "aligned"))
    real, phrase = F.col("template") != none, F.col("base") & (F.col("places") > 0)
    cover = F.col("cover")
    out = spans.groupBy(*key).agg(
        F.max(F.when(~real, F.col("n"))).alias("copies"),
        F.coalesce(F.sum(F.when(phrase, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("last"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(phrase, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(phrase | (real & ~F.col("base") & (cover >= MIN_COVER)), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(real, cover)), F.lit(0.0)).alias("score"),
    )
    # A text equal in id and words is one group; give each of its rows back.
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
