"""Searching a catalogue by words and by facets, as the portal's package search does.

Packages are rows with an id and a text; words are runs of letters and digits in
lower case. Everything is a join or an aggregation of Spark's own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.session import materialize

#: Scores are whole numbers, so that they do not depend on the order of addition.
SCORE_UNIT = 1_000_000
#: The two parameters of BM25.
K1 = 1.2
B = 0.75
#: So many words of searches, a few MB, are sent to every task that reads postings.
BROADCAST_WORDS = 100_000
#: Scores of a word in a package that one task adds up.
TASK_SCORES = 1_000_000


def words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(packages: DataFrame, text: Column | str, id_column: str = "id") -> DataFrame:
    """The inverted index ``(term, id, tf, size)``: the words of each package with their count, and its number of words."""
    listed = packages.select(F.col(id_column).alias("id"), words(text).alias("words"))
    sized = listed.select("id", F.size("words").alias("size"), F.explode("words").alias("term"))
    return sized.groupBy("id", "size", "term").agg(F.count(F.lit(1)).alias("tf")).select("term", "id", "tf", "size")


def _questions(searches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(question, term)`` of the different sets of words asked for, and the ``(search_id, question)`` that ask for them, both written."""
    asked = searches.select("search_id", F.explode(words("q")).alias("term")).distinct()
    listed = materialize(asked.groupBy("search_id").agg(F.array_sort(F.collect_list("term")).alias("terms")))
    kinds = materialize(listed.select("terms").distinct().withColumn("question", F.monotonically_increasing_id()))
    return materialize(kinds.select("question", F.explode("terms").alias("term"))), materialize(listed.join(kinds, "terms").drop("terms"))


def search_ranked(
    index: DataFrame, searches: DataFrame, rows: int = 10, start: int = 0, k1: float = K1, b: float = B
) -> DataFrame:
    """``(search_id, rank, id, score)``: the packages of each search ``(search_id, q)`` by BM25, ``rows`` from ``start``.

    ``index`` comes from :func:`postings` and is best written once. A word that is
    asked for twice counts once; packages without any of the words are not
    found; equal scores are ranked by id. Searches for the same words are ranked
    once. Where the words asked for are few, they go to the postings, which are
    dealt out by package: scores are summed and each task cuts its part to the
    rows asked for before anything else is moved. Where they are many, postings
    and words meet in a plain join, so that a word that most packages hold is split.
    """
    sizes = index.groupBy("id").agg(F.first("size").alias("size"))
    total = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean")).first()
    if not total["n"]:
        return index.sparkSession.createDataFrame([], "search_id long, rank int, id string, score long")
    asked, members = _questions(searches)
    wanted = asked.select("term").distinct()
    df = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n, mean = F.lit(float(total["n"])), F.lit(float(total["mean"]))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = materialize(asked.join(df.select("term", "df", idf.alias("idf")), "term"))
    norm = F.col("tf") + k1 * (1 - b + b * F.col("size") / mean)
    part = F.floor(SCORE_UNIT * F.col("idf") * F.col("tf") * (k1 + 1) / norm).cast("bigint")
    met_rows = weighted.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("df"), F.lit(0)).alias("scores")).first()
    if met_rows["words"] <= BROADCAST_WORDS:
        # Postings are small beside the scores that come of them, so the tasks are counted by these.
        tasks = max(index.sparkSession.sparkContext.defaultParallelism, met_rows["scores"] // TASK_SCORES + 1)
        met = index.repartition(tasks, "id").join(F.broadcast(weighted), "term")
    else:
        met = index.join(weighted.hint("merge"), "term")
    scored = met.groupBy("question", "id").agg(F.sum(part).alias("score"))
    order = Window.partitionBy("question").orderBy(F.col("score").desc(), F.col("id"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= start + rows)
    found = ranked.where(F.col("rank") > start).join(members, "question")
    return found.select("search_id", "rank", "id", "score")


def facets(packages: DataFrame, fields: Mapping[str, Column], top: int | None = None) -> DataFrame:
    """``(facet, value, n)``: in how many packages each value of each field occurs.

    ``fields`` are columns of one value or an array. A package counts once for a
    value; null and empty values count nowhere. All fields are counted in one pass
    and one shuffle, merged map-side. With ``top``, the most frequent values of
    each facet are kept, ties by value.
    """
    kinds = packages.select(*[c.alias(name) for name, c in fields.items()]).schema

    def values(name: str, column: Column) -> Column:
        many = column.cast("array<string>") if kinds[name].dataType.typeName() == "array" else F.array(column.cast("string"))
        kept = F.filter(F.array_distinct(F.coalesce(many, F.array().cast("array<string>"))), lambda v: v != "")
        return F.transform(kept, lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))

    every = F.concat(*[values(name, column) for name, column in fields.items()])
    counted = packages.select(F.inline(every)).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    if top is None:
        return counted
    order = Window.partitionBy("facet").orderBy(F.col("n").desc(), "value")
    return counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top).drop("_rank")
