"""Positions, limits and last-writer rules that hold when one key is hot.

Positions come from a range sort: rows are numbered where they are and shifted by
the number of rows in the ranges before. Ordered limits are Spark's own. Limits
per key are cut in each task, then in groups of tasks and then once more: what
meets in one task is the limit for each key, times a 64th of the tasks at most.

Ties: rows that are equal in ``order`` are interchangeable, in both ways and for
every size. A caller to whom it matters which comes first names more columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.operators.unnest import unnest
from gleanspark.session import materialize

#: Groups of tasks whose first rows are cut before the last cut.
LIMIT_GROUPS = 64


def with_position(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Add ``position`` (from 1, in ``order`` within ``keys``) and ``group_rows``.

    The rows are sorted into ``ranges`` (the session's shuffle partitions) of
    ``(keys, order)`` and written once, so a hot key spreads over many ranges and
    each row's range and place in it are settled for good.
    """
    order, keys = list(order), list(keys)
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The id counts the rows of each sorted range: its number, then 33 bits of place.
    place = F.col("_id").bitwiseAND(2**33 - 1)
    # The number of a row in its split lets a range end among rows that tie.
    numbered = df.withColumn("_copy", F.monotonically_increasing_id())
    by = [*keys, *order, "_copy"]
    ranged = materialize(
        numbered.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(*df.columns, F.shiftright("_id", 33).alias("_range"), place.alias("_place"))
    )
    cells = ["_range", *keys]
    counts = ranged.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # At most one row per key and range here, so these windows stay small.
    by_key = Window.partitionBy(*keys)
    offsets = counts.select(
        *[F.col(c).alias(f"_o{c}") for c in cells],
        (F.sum("_n").over(by_key.orderBy("_range")) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(by_key).alias("group_rows"),
    )
    same_cell = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in cells]
    return (
        ranged.join(offsets, same_cell)
        .withColumn("position", F.col("_place") + F.col("_shift") + 1)
        .select(*df.columns, "position", "group_rows")
    )


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows ``first`` to ``last`` (from 1) of every key."""
    parted = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(LIMIT_GROUPS)))

    def rank(*by: str) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(*order))

    cut = parted.withColumn("_rank", rank(*keys, "_part")).where(F.col("_rank") <= last)
    # Of each group no more than `last` rows a key are left.
    kept = cut.withColumn("_rank", rank(*keys)).where(F.col("_rank") <= last)
    return kept.where(F.col("_rank") >= first).select(*df.columns)


def _from(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None, offset: int) -> DataFrame:
    if limit is not None and limit != -1:
        return _first_rows(df, keys, order, offset + 1, offset + limit)
    if offset == 0:
        return df
    return with_position(df, order, keys).where(F.col("position") > offset).select(*df.columns)


def limit_ordered(df: DataFrame, order: Sequence[str], limit: int | None, offset: int = 0) -> DataFrame:
    """Exactly ``limit`` rows from ``offset`` in ``order``; no limit (or -1) means all.

    With a limit this is Spark's own ordered limit: the first rows of each task
    are kept and merged, or all are sorted by range beyond its own threshold.
    """
    if limit is not None and limit != -1:
        return df.orderBy(*order).offset(offset).limit(limit)
    return _from(df, (), order, limit, offset)


def limit_packages(catalog: DataFrame, limit: int | None, start: int = 0, order: Sequence[str] = ("id",)) -> DataFrame:
    return limit_ordered(catalog, order, limit, start)


def top_hits(hits: DataFrame, order: Sequence[str], top: int = 1000) -> DataFrame:
    return limit_ordered(hits, order, top)


def limit_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int = 1000, offset: int = 0
) -> DataFrame:
    """The first ``limit`` rows of every key, from ``offset``; -1 means all."""
    return _from(rows, keys, order, limit, offset)


def limit_indexed_rows(rows: DataFrame, limit: int = -1, offset: int = 0, index: str = "row_idx") -> DataFrame:
    """As :func:`limit_rows` for rows that carry a dense index from 0: a pushed-down filter."""
    kept = rows.where(F.col(index) >= offset)
    return kept if limit == -1 else kept.where(F.col(index) < offset + limit)


def last_writer_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``; merged map-side, so a hot key shuffles as one row per task."""
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns]
    )


def keep_newest_runs(runs: DataFrame, keep: int = 3, portal: str = "portal", name: str = "run_name") -> DataFrame:
    """The newest runs of each portal by name, descending."""
    rank = F.row_number().over(Window.partitionBy(portal).orderBy(F.col(name).desc()))
    return runs.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def skip_leading(nodes: DataFrame, array: str, count: int = 5, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., pos, item)`` for the elements after the first ``count``."""
    return unnest(nodes, array, "item", keep, "pos").where(F.col("pos") >= count)
