"""License scan by diagonal voting over word k-grams; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, text_or_empty

# The exact phrases and their labels
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Sentences that open well-known license texts
STATEMENTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under the creative commons attribution license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "\n"  # no word holds it


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    folded = F.translate(text, UPPER, LOWER)
    return F.array_remove(F.split(folded, GAPS, -1), "")


def grams_of(words: Column) -> Column:
    """All word pairs in order: the k-grams for k = 2."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))


def template_grams(spark: SparkSession, templates: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """(gram_hash, gram, template, t_pos) of the templates: a few hundred rows, by their number of words."""
    rows = [
        (f"{a} {b}", text, i)
        for text in templates
        for i, (a, b) in enumerate(zip(text.split(), text.split()[1:]))
    ]
    rows.append((MARK, "", 0))
    return spark.createDataFrame(rows, "gram string, template string, t_pos int").withColumn("gram_hash", F.xxhash64("gram"))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    statements: Mapping[str, str] = STATEMENTS,
    min_share: float = 0.75,
    drift: int = 3,
) -> DataFrame:
    """License places of every document, one row per input row.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and spans (array of template, label, start, end, share).  All word pairs of a text
    join the positions of the templates; matches vote for their diagonal (text position
    minus template position).  An exact phrase is a diagonal that all its pairs vote
    for.  For longer statements, a diagonal and those up to ``drift`` behind it are merged,
    so that a few words may be missing or added and a span is at most ``drift`` words longer
    than its template.  Spans are verified: of the agreeing pairs only those that stand in
    the template's order count, and they must be at least ``min_share`` of its pairs; of
    spans that share diagonals the one of the largest share stays, then the first.
    ``score`` is the largest share, 1 where a phrase stands.

    A null or empty text has no words and no spans.  Rows of the same id and text are
    scanned once and come back as often as they stand.  No rows give no rows.  The
    templates are constants: their table is broadcast, texts are never shuffled.
    """
    spark = docs.sparkSession
    templates = {**{p: (label, True) for p, label in phrases.items()}, **{s: (label, False) for s, label in statements.items()}}
    words = words_of(text_or_empty())
    read = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), F.length("text").alias("n_chars"), words.alias("words"))
    # the mark joins the template of no words, so that documents without a match stay
    pairs = read.select(
        "doc_id", "text_hash", "n_chars", F.size("words").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit(MARK)), grams_of(F.col("words")))).alias("at", "gram"),
    ).withColumn("gram_hash", F.xxhash64("gram"))
    places = template_grams(spark, templates)
    hits = pairs.join(F.broadcast(places), ["gram_hash", "gram"]).select(
        "doc_id", "text_hash", "n_chars", "n_words", "template", "t_pos", (F.col("at") - 1).alias("word")
    )
    return spans_by_document(votes(hits), templates, min_share, drift)


DOC = ["doc_id", "text_hash", "n_chars", "n_words"]


def votes(hits: DataFrame) -> DataFrame:
    """Matches summed by document, template and diagonal."""
    diagonal = F.when(F.col("template") == "", 0).otherwise(F.col("word") - F.col("t_pos"))
    return hits.groupBy(*DOC, "template", diagonal.alias("diagonal")).agg(
        F.count("*").alias("n"), F.collect_set("t_pos").alias("agreed")
    )


def in_order(hits: Column) -> Column:
    """Most ``(t_pos, word)`` places that ascend in both: at most one per template position.

    A candidate has at most ``drift + 1`` places per position of its template, so the
    arrays are short however long the text is.
    """
    sorted_hits = F.array_sort(F.transform(hits, lambda h: F.struct(h["t_pos"], (-h["word"]).alias("back"))))

    def grow(chains: Column, hit: Column) -> Column:
        shorter = F.transform(F.filter(chains, lambda c: c["word"] < -hit["back"]), lambda c: c["n"])
        n = F.coalesce(F.array_max(shorter), F.lit(0)) + 1
        return F.concat(chains, F.array(F.struct((-hit["back"]).alias("word"), n.alias("n"))))

    none = F.array().cast("array<struct<word:int,n:int>>")
    return F.aggregate(sorted_hits, none, grow, lambda chains: F.array_max(F.transform(chains, lambda c: c["n"])))


def spans_by_document(diagonals: DataFrame, templates: Mapping[str, tuple[str, bool]], min_share: float, drift: int) -> DataFrame:
    names = list(templates)
    per = lambda of, kind: F.element_at(F.create_map(*[F.lit(x) for t in names for x in (t, of(t))], F.lit(""), F.lit(None).cast(kind)), F.col("template"))
    rows = diagonals.withColumn("pairs", per(lambda t: len(t.split()) - 1, "int"))
    rows = rows.withColumn("exact", per(lambda t: templates[t][1], "boolean")).withColumn("label", per(lambda t: templates[t][0], "string"))
    # a statement's votes on a diagonal and up to drift behind it are one candidate; phrases allow no drift
    by = Window.partitionBy("doc_id", "text_hash", "n_chars", "template").orderBy("diagonal")
    ahead = F.collect_list(F.struct("diagonal", "agreed")).over(by.rangeBetween(0, drift))
    lines = F.when(F.col("exact") | (F.col("template") == ""), F.array(F.struct("diagonal", "agreed"))).otherwise(ahead)
    spans = rows.withColumn("lines", lines)
    least = F.col("pairs") * F.when(F.col("exact"), 1.0).otherwise(min_share)
    total = F.aggregate("lines", F.lit(0), lambda acc, line: acc + F.size(line["agreed"]))
    spans = spans.where((F.col("template") == "") | (total >= least))
    place = lambda line: F.transform(line["agreed"], lambda t: F.struct(t.alias("t_pos"), (line["diagonal"] + t).alias("word")))
    spans = spans.withColumn("hits", F.flatten(F.transform("lines", place)))
    spans = spans.withColumn("share", F.when(F.col("template") == "", 0.0).otherwise(in_order(F.col("hits")) / F.col("pairs")))
    # where the voted pairs of a span begin and end in the text
    at = F.transform("hits", lambda h: h["word"])
    start, end = F.array_min(at), F.array_max(at) + 2
    spans = spans.where((F.col("template") == "") | (F.col("share") >= least / F.col("pairs")))
    # of candidates that share diagonals the best stays
    rank = F.struct("share", (-F.col("diagonal")).alias("before"))
    best = F.max(rank).over(by.rangeBetween(-drift, drift))
    kept = F.col("exact") | (rank == best)
    spans = spans.withColumn("kept", kept)
    span = F.struct("template", "label", "exact", start.cast("long").alias("start"), end.cast("long").alias("end"), "share")
    found = spans.groupBy(*DOC).agg(
        F.max(F.when(F.col("template") == "", F.col("n"))).alias("copies"),
        F.collect_list(F.when(F.col("kept") & (F.col("template") != ""), span)).alias("spans"),
    )
    base = F.filter("spans", lambda s: s["exact"])
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
        "spans",
        each.alias("copy"),
    ).drop("copy")


def op9_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("spans")


def _values(phrases: Mapping[str, str], statements: Mapping[str, str]) -> str:
    rows = [f"('{t}', '{label}', true)" for t, label in phrases.items()]
    rows += [f"('{t}', '{label}', false)" for t, label in statements.items()]
    return ", ".join(rows)


OP9_SQL = rf"""
WITH RECURSIVE templates(template, label, exact) AS (VALUES {_values(PHRASES, STATEMENTS)}),
places AS (
  SELECT template, label, exact, len(w) - 1 AS pairs, i AS t_pos, w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT *, string_split(template, ' ') AS w FROM templates), unnest(range(0, len(w) - 1)) AS r(i)),
read AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}'), lambda x: x <> '') AS w
  FROM documents),
pairs AS (SELECT doc_id, i AS word, w[i + 1] || ' ' || w[i + 2] AS gram FROM read, unnest(range(0, len(w) - 1)) AS r(i)),
votes AS (SELECT DISTINCT doc_id, template, label, exact, pairs, t_pos, word - t_pos AS diagonal FROM pairs JOIN places USING (gram)),
bases AS (SELECT DISTINCT doc_id, template, label, exact, pairs, diagonal FROM votes),
hits AS (
  SELECT b.*, t_pos, t_pos + v.diagonal AS word,
    row_number() OVER (PARTITION BY b.doc_id, b.template, b.diagonal ORDER BY t_pos, v.diagonal DESC) AS i,
    count(*) OVER (PARTITION BY b.doc_id, b.template, b.diagonal) AS n
  FROM bases b JOIN votes v ON v.doc_id = b.doc_id AND v.template = b.template
    AND v.diagonal BETWEEN b.diagonal AND b.diagonal + CASE WHEN b.exact THEN 0 ELSE 3 END),
likely AS (SELECT * FROM hits WHERE n >= pairs * CASE WHEN exact THEN 1 ELSE 0.75 END),
chains(doc_id, template, diagonal, i, chain) AS (
  SELECT doc_id, template, diagonal, i, [{{'word': word, 'n': 1}}] FROM likely WHERE i = 1
  UNION ALL
  SELECT c.doc_id, c.template, c.diagonal, l.i, list_append(c.chain, {{'word': l.word,
    'n': (1 + coalesce(list_max(list_transform(list_filter(c.chain, lambda x: x.word < l.word), lambda x: x.n)), 0))::INTEGER}})
  FROM chains c JOIN likely l ON l.doc_id = c.doc_id AND l.template = c.template AND l.diagonal = c.diagonal AND l.i = c.i + 1),
lengths AS (SELECT doc_id, template, diagonal, max(list_max(list_transform(chain, lambda x: x.n))) AS len FROM chains GROUP BY ALL),
spans AS (
  SELECT doc_id, template, label, l.exact, diagonal, min(word) AS start, any_value(len) / any_value(pairs) AS share
  FROM likely l JOIN lengths USING (doc_id, template, diagonal) GROUP BY ALL),
kept AS (SELECT * FROM spans WHERE share >= CASE WHEN exact THEN 1 ELSE 0.75 END)
SELECT doc_id, len(w)::BIGINT AS n_words, count(start) FILTER (WHERE exact) AS n_base,
  (min(start) FILTER (WHERE exact))::BIGINT AS first_word, (max(start) FILTER (WHERE exact))::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0)::DOUBLE AS score
FROM read LEFT JOIN kept USING (doc_id) GROUP BY doc_id, w
"""
