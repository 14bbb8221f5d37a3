"""License statements by diagonal voting, in DataFrame operations alone.

Every rolling pair of words of a text is joined by hash to the places of the
templates. Hits of one template with the same offset lie on a diagonal; diagonals
next to each other (words put in or left out) are merged, and a merged span is
verified by the part of the template's words it holds.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.llm.tables import read_texts

#: Words per gram; the shortest phrase has two.
GRAM_WORDS = 2
#: Diagonals no further apart than this are one span.
NEAR_DIAGONALS = 2
#: A template is found from this part of its words on: every statement with one word changed, added or missing.
MIN_COVERAGE = 0.8

#: Phrases that count by themselves, as they stand.
BASE_PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
#: Statements found with small changes as well.
STATEMENTS = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "has been dedicated to the public domain"),
]

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Repeats of a row that are put out together.
_REPEATS = 1 << 16


def word_list(text: Column) -> Column:
    """Runs of ASCII letters, digits and anything beyond ASCII, with A-Z alone in lower case; null has none."""

    def lowered(w: Column) -> Column:
        # Only ASCII words may go by Unicode's rules, which turn some other letters into ASCII ones.
        return F.when(F.length(w) == F.octet_length(w), F.lower(w)).otherwise(F.translate(w, ascii_uppercase, ascii_lowercase))

    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), ""), lowered)


def gram_hashes(words: Column) -> Column:
    """A hash per pair of neighbouring words, in order."""
    behind = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(words, behind, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    # Behind the last word nothing follows.
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


#: Places of the words around a pair, from its first word on.
_AROUND = (-2, -1, 2, 3)


def grams_and_neighbours(words: Column, hashes: Column) -> Column:
    """Per pair its ``hash`` and the hashes of the two words before and behind it; one more without a hash at the end."""
    closed = F.concat(gram_hashes(words), F.array(F.lit(None).cast("long")))
    none, n = F.lit(None).cast("long"), F.greatest(F.size(words), F.lit(1))
    # Shifted as whole arrays, so that the cost stays linear wherever the optimizer puts it.
    shifted = [F.slice(F.concat(F.array(*[none] * -k), hashes) if k < 0 else F.slice(hashes, k + 1, n), 1, n) for k in _AROUND]
    fields = ",".join(f"at{i}:bigint" for i in range(len(_AROUND)))
    return F.arrays_zip(closed, *shifted).cast(f"array<struct<hash:bigint,{fields}>>")


def template_grams(spark: SparkSession, base: list[tuple[str, str]], statements: list[tuple[str, str]]) -> DataFrame:
    """``(hash, template, label, is_base, place, n_grams)`` and the words around; as large as the templates given."""
    both = [(label, text, True) for label, text in base] + [(label, text, False) for label, text in statements]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(b).alias("is_base"))
            for i, (label, text, b) in enumerate(both)
        ]
    )
    listed = spark.range(1).select(F.inline(rows)).withColumn("words", word_list(F.col("text")))
    listed = listed.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("grams", gram_hashes(F.col("words")))
    return listed.select("template", "label", "is_base", "hashes", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("place", "hash")).select(
        "template",
        "label",
        "is_base",
        "n_grams",
        "place",
        "hash",
        *[F.when(F.col("place") + k >= 0, F.get("hashes", F.col("place") + k)).alias(f"own{n}") for n, k in enumerate(_AROUND)],
    )


def _held_words() -> Column:
    """Places of the template's words that a hit of a pair holds, with words next to it across one changed, added or missing word."""
    place = F.col("place")
    # (text word, template word): changed, added, missing; before the pair and behind it.
    seen = [(0, 0), (0, 1), (1, 0), (3, 3), (3, 2), (2, 3)]
    across = [F.when(F.col(f"at{t}") == F.col(f"own{o}"), place + _AROUND[o]) for t, o in seen]
    return F.filter(F.array(place, place + 1, *across), lambda p: p.isNotNull())


def license_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: list[tuple[str, str]] = BASE_PHRASES,
    statements: list[tuple[str, str]] = STATEMENTS,
    near: int = NEAR_DIAGONALS,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans``, the spans as ``(label, is_base, start, words, coverage)``.

    ``start`` counts words from 0. Base phrases are whole and consecutive;
    statements hold ``min_coverage`` of their template's words, in order within a
    band of near diagonals. A word counts with a pair that is held, or next to one
    across a single other word. Of statements on the same words those with the
    largest coverage, and then the most words, are taken: one that another beats on any of
    its words goes. The words of a text are cut once, and only hits, words of statements
    and one row per document are shuffled; all steps are linear in the text.

    A null or empty text has no words and no spans. Every row has its result,
    whether its id is null, repeated or neither; rows equal in id and text are searched
    once. A very long text is one row until its hits are shuffled. Other columns of the
    input are not read, so their names cannot clash. No rows give no rows.
    """
    templates = F.broadcast(template_grams(docs.sparkSession, base, statements))
    texts = read_texts(docs, id_col, text_col).withColumn("w", word_list(F.col("text")))
    # A key that a task computes again after a loss; no running number.
    texts = texts.withColumn("key_1", F.xxhash64("text")).withColumn("key_2", F.xxhash64(F.lit(1), "text"))
    texts = texts.withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    keys = ["doc_id", "key_1", "key_2"]
    # The null behind the grams gives each document a row of its own.
    grams = texts.select(*keys, F.size("w").cast("long").alias("n_words"), grams_and_neighbours(F.col("w"), F.col("h")).alias("g"))
    # Never empty; the outer form keeps the optimizer from cutting the words once more for a filter.
    rolling = grams.select(*keys, "n_words", F.posexplode_outer("g").alias("pos", "gram")).select(*keys, "n_words", "pos", "gram.*")
    hits = rolling.join(templates, "hash", "left").where(F.col("hash").isNull() | F.col("template").isNotNull())
    hits = hits.withColumn("held", F.when(F.col("template").isNotNull(), _held_words()))
    # Per document, template and diagonal; a place of the template is on a diagonal once.
    diagonals = hits.groupBy(*keys, "template", "label", "is_base", "n_grams", (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"),
        F.collect_set("held").alias("held"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        # Rows of the document itself have no template, and their word count and number.
        F.first("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("repeats"),
    )
    by_template = Window.partitionBy(*keys, "template").orderBy("diagonal")
    step = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_template), F.lit(0))
    # A base phrase is whole on its own diagonal, so bands of those are not merged.
    apart = F.when(F.col("is_base") | (step > near), 1).otherwise(0)
    bands = diagonals.withColumn("band", F.sum(apart).over(by_template)).groupBy(*keys, "template", "label", "is_base", "n_grams", "band")
    found = bands.agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("pairs"),
        F.size(F.array_distinct(F.flatten(F.flatten(F.collect_list("held"))))).alias("covered"),
        F.min("first").alias("start"),
        F.max("last").alias("end"),
        F.first("n_words").alias("n_words"),
        F.first("repeats").alias("repeats"),
    ).withColumn("coverage", F.when(F.col("is_base"), F.col("pairs") / F.col("n_grams")).otherwise(F.col("covered") / (F.col("n_grams") + 1)))
    whole = F.col("is_base") & (F.col("pairs") == F.col("n_grams"))
    held = ~F.col("is_base") & (F.col("coverage") >= min_coverage)
    # Once by document: words, statements and documents are then grouped where they are.
    found = found.where(F.col("template").isNull() | whole | held).repartition(*keys)
    words = found.withColumn("word", F.explode_outer(F.when(held, F.sequence("start", F.col("end") + GRAM_WORDS - 1))))
    rank = F.struct("coverage", "covered")
    best = F.max(rank).over(Window.partitionBy(*keys, "word"))
    words = words.withColumn("beaten", held & (best > rank))
    span = F.struct(
        "label", "is_base", F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start") + GRAM_WORDS).cast("long").alias("words"), "coverage"
    )
    spans = words.groupBy(*keys, "template", "band").agg(
        F.first(F.when(F.col("template").isNotNull(), span)).alias("span"),
        F.max("beaten").alias("beaten"),
        F.first("n_words").alias("n_words"),
        F.first("repeats").alias("repeats"),
    )
    own = F.col("template").isNull()
    per_doc = spans.groupBy(*keys).agg(
        F.max(F.when(own, F.col("n_words"))).alias("n_words"),
        F.max(F.when(own, F.col("repeats"))).alias("repeats"),
        F.array_sort(F.collect_list(F.when(~F.coalesce("beaten", F.lit(False)), F.col("span")))).alias("spans"),
    )
    parts = per_doc.withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("repeats") - 1).cast("long"), F.lit(_REPEATS))))
    here = F.least(F.col("repeats") - F.col("part"), F.lit(_REPEATS)).cast("int")
    return parts.select("doc_id", "n_words", "spans", F.explode(F.array_repeat(F.lit(0), here)).alias("repeat")).drop("repeat")


def summary(spans: DataFrame) -> DataFrame:
    """Counts, labels and a score of :func:`license_spans`: the largest coverage, 1 for a base phrase."""
    base = F.filter("spans", lambda s: s["is_base"])
    starts = F.transform(base, lambda s: s["start"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"]))), ",")

    return spans.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )
