"""License scans by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# The phrases of the contract and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wording of well-known license statements, with a label for each.
STATEMENTS = {
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of"
    " the gnu general public license as published by the free software foundation": "gpl-notice",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files": "mit-notice",
    "released under the mit license": "mit-release",
    "redistribution and use in source and binary forms with or without modification are"
    " permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose with or"
    " without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Words per k-gram: the shortest phrase has two words; statements hold common word pairs.
BASE_K, STATEMENT_K = 2, 3
#: Diagonals of a statement at most so many words apart are one span.
MOST_SHIFT = 3
#: Share of a statement's k-grams that a span must hold.
LEAST_COVER = 0.6

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The one letter outside ASCII whose lower case is an ASCII letter, and a stand-in.
_KELVIN, _OTHER_SIGN = "K", "Ω"
#: The element that stands for the document itself.
_DOCUMENT = -1


def _hashed_grams(words):
    """Rolling hashes: of each word with the next, and of that with the one after."""
    n = F.size(words)
    pairs = F.zip_with(words, F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.slice(words, 3, n), lambda a, b: F.xxhash64(a, b))
    return pairs, triples


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per k-gram of a phrase or statement, and the row that counts documents."""
    rows = [(_DOCUMENT, "", [], 0, 0, 1, False)]
    templates = [(t, v, BASE_K, True) for t, v in BASE.items()]
    templates += [(t, v, STATEMENT_K, False) for t, v in STATEMENTS.items()]
    for tid, (text, label, k, base) in enumerate(templates):
        words = text.split()
        n = len(words) - k + 1
        rows += [(tid, label, words[i:i + k], k, i, n, base) for i in range(n)]
    grams = spark.createDataFrame(
        rows, "tid int, label string, gram array<string>, k int, t_pos int, n_grams int, base boolean")
    pairs, triples = _hashed_grams(F.col("gram"))
    return grams.withColumn("hash", F.when(F.col("k") == BASE_K, pairs[0])
                            .when(F.col("k") == STATEMENT_K, triples[0])
                            .otherwise(F.lit(_DOCUMENT).cast("long")))


def gram_hits(docs: DataFrame) -> DataFrame:
    """Places where a document holds a k-gram of a template, word for word.

    All rolling hashes of a text are exploded and joined with the template grams, a
    constant table of some hundred rows. The words are compared at once, so what leaves
    the scan is exact, and no text is shuffled.
    """
    text = F.lower(F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(_KELVIN),
                             F.lit(_OTHER_SIGN)))
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("words"))
    pairs, triples = _hashed_grams(F.col("words"))
    document = F.array(F.lit(_DOCUMENT).cast("long"))
    n = F.size("words")
    pos = F.col("p")
    start = (F.when(pos == 0, 0).when(pos <= n, pos - 1).otherwise(pos - 1 - n))
    k = F.when(pos == 0, 0).when(pos <= n, BASE_K).otherwise(STATEMENT_K)
    return (words.select("doc_id", "text_key", "words",
                         F.posexplode(F.concat(document, pairs, triples)).alias("p", "hash"))
            .join(F.broadcast(template_grams(docs.sparkSession).withColumnRenamed("k", "t_k")), "hash")
            .withColumn("start", start)
            .filter((k == F.col("t_k")) & (F.slice("words", F.col("start") + 1, F.col("t_k"))
                                           == F.col("gram")))
            .select("doc_id", "text_key", "tid", "label", "base", "n_grams", "t_pos",
                    F.col("start").cast("long").alias("start"), n.cast("long").alias("n_words")))


def license_scan(docs: DataFrame) -> DataFrame:
    """Licenses named or stated in each document.

    Each k-gram hit votes for the diagonal ``place in the text - place in the template``.
    A base phrase stands where its diagonal has all its votes. Diagonals of a statement
    up to ``MOST_SHIFT`` apart are merged, so that an inserted or dropped word does not
    break a span, and the span counts if it holds ``LEAST_COVER`` of the statement.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``: the number of base phrases and the smallest and largest word they start at
    (null if none), labels of base phrases and of those with statements, and the best
    cover of any template. A null or empty text has no words and no labels. One row per
    row of ``docs``, also where ids are null or repeated; other columns are ignored.
    """
    votes = (gram_hits(docs).groupBy("doc_id", "text_key", "tid", "label", "base", "n_grams",
                                     (F.col("start") - F.col("t_pos")).alias("diagonal"))
             .agg(F.collect_set("t_pos").alias("held"), F.count("*").alias("n"),
                  F.max("n_words").alias("n_words")))
    along = Window.partitionBy("doc_id", "text_key", "tid").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    opens = F.when(apart.isNull() | F.col("base") | (apart > MOST_SHIFT), 1).otherwise(0)
    spans = (votes.withColumn("_opens", opens)
             .withColumn("span", F.sum("_opens").over(along))
             .groupBy("doc_id", "text_key", "tid", "label", "base", "n_grams", "span")
             .agg(F.min("diagonal").alias("place"), F.sum("n").alias("n"),
                  F.max("n_words").alias("n_words"),
                  F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"))
             .withColumn("cover", F.col("held") / F.col("n_grams")))
    document = F.col("tid") == _DOCUMENT
    base = ~document & F.col("base") & (F.col("held") == F.col("n_grams"))
    stated = ~document & ~F.col("base") & (F.col("cover") >= LEAST_COVER)

    def labels(of):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(of, F.col("label")))))

    return (spans.groupBy("doc_id", "text_key")
            .agg(F.max(F.when(document, F.col("n"))).alias("_copies"),
                 F.max("n_words").alias("n_words"),
                 F.count(F.when(base, 1)).alias("n_base"),
                 F.min(F.when(base, F.col("place"))).alias("first_word"),
                 F.max(F.when(base, F.col("place"))).alias("last_word"),
                 labels(base).alias("base_labels"), labels(base | stated).alias("labels"),
                 F.coalesce(F.max(F.when(~document, F.col("cover"))), F.lit(0.0)).alias("score"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .drop("text_key", "_copies", "_copy"))
