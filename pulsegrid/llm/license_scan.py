"""License scans by diagonal voting; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import maybe_broadcast, words_native

#: The base phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Further phrases and notices of public licenses. Up to SHORT words they must stand exactly, longer ones mostly.
MORE_PHRASES = (
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
)
# The wording of two short licenses, as words.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights to use
copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software
is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether
in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings
in the software"""
_ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and
the author disclaims all warranties with regard to this software including all implied warranties of merchantability and
fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages
whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
arising out of or in connection with the use or performance of this software"""
# License identifiers of source file headers.
_IDENTIFIERS = ("mit", "isc", "apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "mpl-2.0", "bsd-2-clause", "bsd-3-clause", "unlicense", "cc0-1.0", "cc-by-4.0")
MORE_PHRASES += (
    (" ".join(_MIT.split()), "mit-full"),
    (" ".join(_ISC.split()), "isc-full"),
    *(("spdx license identifier " + i.replace("-", " ").replace(".", " "), f"spdx:{i}") for i in _IDENTIFIERS),
)
GRAM = 2
SHORT = 6
LEAST_SCORE = 0.8
#: Diagonals this close belong to one place: words put in or left out move the rest by that many.
SHIFT = 2
#: A place has diagonals of so wide a band at most, so that neighbours don't drift on without end.
BAND = 16
_ROW = -1


def templates(spark: SparkSession, base=BASE_PHRASES, more=MORE_PHRASES) -> DataFrame:
    """hash, words, template, at, n_grams, base, label of every word k-gram of the phrases; a fixed, small table.

    Its last row stands for the documents themselves: every document sends one row to it.
    """
    rows = []
    for t, (phrase, label) in enumerate([*base, *more]):
        w = phrase.split()
        if len(w) < GRAM:
            raise ValueError(f"a phrase has {GRAM} words at least: {phrase}")
        rows += [(w[i], w[i + 1], t, i, len(w) - GRAM + 1, t < len(base), label) for i in range(len(w) - GRAM + 1)]
    grams = spark.createDataFrame(rows, "a string, b string, template int, at int, n_grams int, base boolean, label string")
    own = spark.range(1).select(
        F.lit("").alias("a"), F.lit("").alias("b"), F.lit(_ROW).alias("template"), F.lit(0).alias("at"), F.lit(0).alias("n_grams"), F.lit(False).alias("base"), F.lit("").alias("label")
    )
    return grams.unionByName(own).withColumn("hash", F.xxhash64("a", "b"))


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: DataFrame | None = None) -> DataFrame:
    """doc_id, row (hash of the text), n_words, template, n_grams, base, label, diagonal, hits (places in the template of the
    k-grams that stand there), copies (rows that stand behind).

    Every position of every text is joined with the templates' k-grams; a match at text position p and template
    position q votes for the diagonal p - q. Every document also has a row whose template is -1.
    """
    phrases = templates(docs.sparkSession) if phrases is None else phrases
    phrases = maybe_broadcast(phrases, phrases.count(), 128)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), words_native(F.col("text")).alias("w"))
    n = F.size("w")
    source = source.withColumn("p", F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))))
    # The last word begins no k-gram; its place is taken by the row of the document itself.
    last = F.col("p") >= n - 1
    a = F.when(last, F.lit("")).otherwise(F.get("w", F.col("p")))
    b = F.when(last, F.lit("")).otherwise(F.get("w", F.col("p") + 1))
    grams = source.select("doc_id", "row", n.alias("n_words"), "p", a.alias("wa"), b.alias("wb"), F.xxhash64(a, b).alias("gram"))
    hit = grams.join(phrases, (F.col("gram") == F.col("hash")) & (F.col("wa") == F.col("a")) & (F.col("wb") == F.col("b")))
    diagonal = F.when(F.col("template") == _ROW, F.lit(0)).otherwise(F.col("p") - F.col("at"))
    # Sets, not counts: a repeated row votes once.
    return hit.select(
        "doc_id", "row", "n_words", "template", "n_grams", "base", "label", diagonal.alias("diagonal"), "at"
    ).groupBy("doc_id", "row", "n_words", "template", "n_grams", "base", "label", "diagonal").agg(F.collect_set("at").alias("hits"), F.count("*").alias("copies"))


def spans(voted: DataFrame) -> DataFrame:
    """One row per document and verified place: doc_id, row, template, label, base, start, n_words, score.

    Neighbouring diagonals of a template are merged and their hits united; a place counts if all k-grams of a short
    phrase, or LEAST_SCORE of a long one's, stand there.
    """
    near = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    runs = voted.where(F.col("template") != _ROW)
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near), F.lit(SHIFT + 1))
    # A short phrase must stand on one diagonal.
    apart = F.when((F.col("n_grams") < SHORT) | (apart > SHIFT), 1).otherwise(0)
    runs = runs.withColumn("place", F.sum(apart).over(near))
    # The whole chain's first diagonal is where its bands begin.
    first = F.min("diagonal").over(Window.partitionBy("doc_id", "row", "template", "place"))
    runs = runs.withColumn("band", F.floor((F.col("diagonal") - first) / BAND))
    runs = runs.groupBy("doc_id", "row", "template", "place", "band", "n_grams", "base", "label").agg(
        F.min("diagonal").alias("start"), F.max("diagonal").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits")
    )
    score = F.col("hits") / F.col("n_grams")
    enough = F.when(F.col("n_grams") < SHORT, score == 1.0).otherwise(score >= LEAST_SCORE)
    return runs.where(enough).select(
        "doc_id", "row", "template", "label", "base", "start", (F.col("last") - F.col("start") + F.col("n_grams") + GRAM - 1).alias("n_words"), score.alias("score")
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null text is empty; it and a text without a phrase have n_base 0, null places, empty labels and score 0. Repeated
    rows each have their row; ids may be null. An empty table gives no rows. Other columns are ignored.
    """
    voted = votes(docs, id_col, text_col)
    # All that follows is by document: the exchange of the votes, by document alone, serves every step.
    voted = voted.repartition("doc_id", "row")
    found = spans(voted)
    own = voted.where(F.col("template") == _ROW).select("doc_id", "row", F.when(F.lit(True), F.col("n_words")).alias("words"), "copies")
    own = own.select("doc_id", "row", "words", "copies", *[F.lit(None).cast(t).alias(c) for c, t in (("label", "string"), ("base", "boolean"), ("start", "int"), ("score", "double"))])
    found = found.select("doc_id", "row", F.lit(None).cast("int").alias("words"), F.lit(None).cast("long").alias("copies"), "label", "base", "start", "score")
    base = lambda c: F.when(F.col("base"), F.col(c))
    out = own.unionByName(found).groupBy("doc_id", "row").agg(
        F.max("words").cast("long").alias("n_words"),
        F.max("copies").alias("copies"),
        F.count(base("start")).alias("n_base"),
        F.min(base("start")).cast("long").alias("first_word"),
        F.max(base("start")).cast("long").alias("last_word"),
        _joined(base("label")).alias("base_labels"),
        _joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("row", "copies", "copy")
