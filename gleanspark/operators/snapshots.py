"""Catalogues that change: pages that drift while they are read, and two harvests against each other.

A portal pages by place. A package that is added or removed while the pages are
read shifts the ones behind it, so that a package stands on two pages or on none.
Only ids and content hashes are shuffled here, not documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the given columns as JSON; a null differs from an empty text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def snapshot(packages: DataFrame, content: Sequence[str], order: Sequence[str], id_column: str = "id") -> DataFrame:
    """``(id, hash, copies)``: each package of a harvest once, with the content seen last in ``order``.

    Packages without id are in no snapshot. Of copies that tie in ``order``, the one
    with the largest hash counts. Merged map-side, so that a package which stands on
    every page shuffles as one row a task.
    """
    seen = packages.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.struct(*order, content_hash(content).alias("hash")).alias("_last")
    )
    last = seen.groupBy("id").agg(F.max("_last").alias("_last"), F.count(F.lit(1)).alias("copies"))
    return last.select("id", "_last.hash", "copies")


def snapshot_diff(before: DataFrame, after: DataFrame, unchanged: bool = False) -> DataFrame:
    """``(id, change, hash_before, hash_after)`` of two snapshots: ``added``, ``removed``, ``changed``, if asked ``unchanged``."""
    old, new = before.select("id", F.col("hash").alias("hash_before")), after.select("id", F.col("hash").alias("hash_after"))
    change = (
        F.when(F.col("hash_before").isNull(), "added")
        .when(F.col("hash_after").isNull(), "removed")
        .when(F.col("hash_before") != F.col("hash_after"), "changed")
        .otherwise("unchanged")
    )
    found = old.join(new, "id", "full").select("id", change.alias("change"), "hash_before", "hash_after")
    return found if unchanged else found.where(F.col("change") != "unchanged")


def page_drift(packages: DataFrame, totals: DataFrame, keys: Sequence[str] = ("portal",), id_column: str = "id") -> DataFrame:
    """``(keys..., total, seen, packages, repeated, missing)`` for each portal of ``totals (keys..., total)``.

    ``seen`` are the rows its pages gave, ``packages`` the distinct ids, ``repeated``
    those that were given more than once, and ``missing`` how many the portal counts
    beyond the distinct ids: what a further reading has to look for. A portal
    without any page misses all.
    """
    keys = list(keys)
    each = packages.groupBy(*keys, id_column).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(id_column).isNotNull()
    counted = each.groupBy(*keys).agg(
        F.sum("_n").alias("seen"), F.count_if(known).alias("packages"), F.count_if(known & (F.col("_n") > 1)).alias("repeated")
    )
    joined = totals.join(counted, keys, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("seen", "packages", "repeated")})
    return joined.select(*keys, "total", "seen", "packages", "repeated", F.greatest(F.col("total") - F.col("packages"), F.lit(0)).alias("missing"))
