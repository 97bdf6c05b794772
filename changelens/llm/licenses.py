"""License scans by diagonal voting, in DataFrame functions alone: the rolling word k-gram hashes of all texts
are joined to template positions, hits are counted by offset diagonal, neighbouring diagonals are merged, and
the spans are verified."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The phrases that name a licence, and the label of each.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that licence texts ask to put into works, in the words of the licences.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license to view a copy of this license visit",
}

#: Words of a rolling gram: pairs find the phrases, fours the notices.
PHRASE_GRAM, NOTICE_GRAM = 2, 4
#: Diagonals so far apart at most are one alignment (words put in or left out).
NEIGHBOURS = 3
#: The part of a notice's grams that a span must hold to get the label.
COVERED = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_rows(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[tuple]:
    """(template, label, base, gram's place, its words, grams of the template): bounded by the lists above."""
    rows = []
    for base, table, k in ((True, phrases, PHRASE_GRAM), (False, notices, NOTICE_GRAM)):
        for number, (one, two) in enumerate(table.items()):
            text, label = (one, two) if base else (two, one)
            words = text.split(" ")
            n = len(words) - k + 1
            rows += [(number + 1000 * (not base), label, base, at, words[at : at + k], n) for at in range(n)]
    return rows


def templates(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    schema = T.StructType([
        T.StructField("template", T.IntegerType()), T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
        T.StructField("place", T.IntegerType()), T.StructField("gram_words", T.ArrayType(T.StringType())), T.StructField("grams", T.IntegerType()),
    ])
    pair = F.xxhash64(F.element_at("gram_words", 1), F.element_at("gram_words", 2))
    four = F.xxhash64(pair, F.xxhash64(F.element_at("gram_words", 3), F.element_at("gram_words", 4)))
    return spark.createDataFrame(rows, schema).withColumn("gram", F.when(F.col("base"), pair).otherwise(four))


def scan(df: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of df: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are runs of letters and digits (and of all characters beyond ASCII) after A-Z are lower-cased. A
    phrase is found where all its pairs of words lie on one diagonal; a notice where a half of its grams, or
    more, lie on neighbouring diagonals. The matched words are compared themselves, not only their hashes.
    score is 1 with a phrase, else the largest part of a notice that is found, 0 if none. spans has the label, first and last word, and
    covered part of each span. Templates are a fixed list, so their grams are broadcast; hits go to the task of
    their row once, and nothing else is shuffled.

    A null text is an empty one: no words, no labels (empty strings), null places, score 0. Null ids and
    repeated rows stay as they are; an empty table gives an empty one; other columns are not read."""
    spark = df.sparkSession
    words = F.filter(F.split(F.translate(F.coalesce(df[text_col].cast("string"), F.lit("")), UPPER, LOWER), BREAKS), lambda w: w != "")
    rows = df.select(df[id_col].cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"), words.alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    pairs = F.when(F.col("n_words") >= 2, F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.size("words")), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("pairs", pairs)
    fours = F.when(F.col("n_words") >= 4, F.zip_with(F.slice("pairs", 1, F.greatest(F.size("pairs") - 2, F.lit(0))), F.slice("pairs", 3, F.size("pairs")), lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))
    # place -1 stands for the row itself, so that rows without hits stay
    own = F.array(F.lit(None).cast("bigint"))
    grams = rows.withColumn("all_grams", F.concat(own, "pairs", fours)).select("doc_id", "uid", "n_words", "words", F.posexplode("all_grams").alias("p", "gram"))
    n_pairs = F.greatest(F.col("n_words") - 1, F.lit(0))
    base_part = F.col("p") <= n_pairs
    at = F.when(base_part, F.col("p") - 1).otherwise(F.col("p") - 1 - n_pairs).cast("long")
    table = F.broadcast(templates(spark, template_rows(phrases, notices)))
    hits = grams.join(table, "gram", "left").where("template IS NOT NULL OR p = 0").withColumn("at", at)
    same = F.slice("words", F.greatest(F.col("at") + 1, F.lit(1)).cast("int"), F.when(F.col("base"), PHRASE_GRAM).otherwise(NOTICE_GRAM)) == F.col("gram_words")
    hits = hits.where((F.col("p") == 0) | (same & (F.col("base") == base_part)))
    hits = hits.select("doc_id", "uid", "n_words", "template", "label", "base", "grams", (F.col("at") - F.col("place")).alias("diagonal"), "place", "at").repartition("uid")
    from pyspark.sql import Window

    diagonals = hits.groupBy("uid", "doc_id", "n_words", "template", "label", "base", "grams", "diagonal").agg(F.count("*").alias("votes"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    along = Window.partitionBy("uid", "template").orderBy("diagonal", "lo")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS).cast("int"), F.lit(0))
    merged = diagonals.withColumn("step", F.when(F.col("base"), 1).otherwise(apart)).withColumn("run", F.sum("step").over(along))
    spans = merged.groupBy("uid", "doc_id", "n_words", "template", "label", "base", "grams", "run").agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("diagonal").alias("start"))
    part = F.least(F.col("votes") / F.col("grams"), F.lit(1.0))
    found = F.when(F.col("base"), F.col("votes") == F.col("grams")).otherwise((part >= COVERED) & (F.col("hi") - F.col("lo") <= 2 * F.col("grams")))
    spans = spans.withColumn("part", part).withColumn("found", F.coalesce(found, F.lit(False)))
    is_base = F.col("found") & F.col("base")
    listed = lambda which: F.concat_ws(",", F.array_sort(F.collect_set(F.when(which, F.col("label")))))
    span = F.struct("label", F.col("lo").alias("first"), (F.col("hi") + F.when(F.col("base"), PHRASE_GRAM).otherwise(NOTICE_GRAM) - 1).alias("last"), "part")
    return spans.groupBy("uid", "doc_id", "n_words").agg(
        F.coalesce(F.sum(is_base.cast("long")), F.lit(0)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        listed(is_base).alias("base_labels"),
        listed(F.col("found")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("found"), F.when(F.col("base"), 1.0).otherwise(F.col("part")))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("found"), span))).alias("spans"),
    ).drop("uid")
