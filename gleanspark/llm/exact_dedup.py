"""Exact deduplication by 128-bit content hash, with a comparison of bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.tables import materialize, read_texts

WHITE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_RUN, " ")


def content_hash(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by the hash of their normalised text; counts and the
    smallest id are merged map-side, so a text that a third of the rows share
    arrives as one row per task. Then the texts of every hash that occurs twice
    are grouped by hash and by their bytes. Where a hash turns out to stand for
    several texts, its rows are assigned by text instead.

    Null and empty texts are equal. A repeated row, or two rows of one id and
    text, share their outcome. A row without id is never the one that stays
    unless no row of its group has an id; then ``keep_id`` is null and ``kept``
    false. No rows give no rows.
    """
    texts = read_texts(docs, id_col, text_col).withColumn("norm", normalised(F.col("text")))
    hashed = texts.select("doc_id", digest(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"))
    rows = materialize(hashed)
    groups = materialize(
        rows.groupBy("hash").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    suspects = groups.where("group_size > 1").select("hash")
    # The aggregation by text combines before its own shuffle, after the join.
    by_text = (
        texts.select("doc_id", "norm", digest(F.col("norm")).alias("hash"))
        .join(suspects, "hash", "left_semi")
        .groupBy("norm")
        .agg(F.first("hash").alias("hash"), F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    collided = materialize(by_text.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"))
    found = rows.join(groups, "hash")
    if not collided.isEmpty():
        exact = by_text.join(collided, "hash", "left_semi").drop("hash")
        apart = texts.select("doc_id", "norm", digest(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256"))
        apart = apart.join(collided, "hash", "left_semi").join(exact, "norm")
        names = ["doc_id", "text_sha256", "keep_id", "group_size"]
        found = found.join(collided, "hash", "left_anti").select(*names).union(apart.select(*names))
    return found.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
    )
