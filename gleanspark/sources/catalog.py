"""Catalogue scans: page plan, packages, resources and the portal's own lookups.

A landed catalogue is a table of replies ``(page_no, status, body, ...)``. All
of it is narrow work: packages and resources are exploded where they were read.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.text import ColumnOrName, _col
from gleanspark.operators.positions import limit_ordered
from gleanspark.operators.unnest import unnest

RESOURCE_TYPE = "array<struct<id:string,url:string,name:string,format:string,language:variant>>"


def catalog_total(pages: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., total)``: the package count the replies report."""
    count = F.get_json_object("body", "$.result.count").try_cast("bigint")
    return pages.groupBy(*keys).agg(F.max(count).alias("total"))


def pages_needed(total: ColumnOrName, batch: int) -> Column:
    return F.ceil(_col(total) / F.lit(batch)).cast("bigint")


def catalog_page_plan(
    totals: DataFrame, start: int = 0, max_packages: int | None = None, batch: int = 1000
) -> DataFrame:
    """One row per request: ``(keys..., page_no, start, rows)``.

    The plan stops exactly at ``max_packages`` and never asks past the end.
    """
    if batch < 1 or start < 0:
        raise ValueError("batch must be positive and start not negative")
    end = F.col("total") if max_packages is None else F.least(F.col("total"), F.lit(start + max_packages))
    keys = [c for c in totals.columns if c != "total"]
    return (
        totals.withColumn("_end", end)
        .where(F.col("_end") > start)
        .withColumn("_pages", pages_needed(F.col("_end") - start, batch))
        .select(*keys, "_end", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pages") - 1)).alias("page_no"))
        .withColumn("start", F.col("page_no") * batch + start)
        .select(*keys, "page_no", "start", F.least(F.lit(batch), F.col("_end") - F.col("start")).cast("bigint").alias("rows"))
    )


def _results(pages: DataFrame) -> DataFrame:
    document = F.try_parse_json("body")
    ok = F.coalesce(F.col("status") < 400, F.lit(True)) if "status" in pages.columns else F.lit(True)
    results = F.when(ok, F.try_variant_get(document, "$.result.results", "array<variant>"))
    return pages.withColumn("_results", results)


def scan_packages(pages: DataFrame) -> DataFrame:
    """``(page columns..., package_pos, package_id, resources, package)``.

    ``package`` keeps the whole document; replies that are no catalogue page
    yield nothing here and are reported by :func:`page_errors`.
    """
    keep = [c for c in pages.columns if c not in ("body", "status")]
    return (
        unnest(_results(pages), "_results", "package", keep, "package_pos")
        .select(
            *keep,
            "package_pos",
            F.try_variant_get("package", "$.id", "string").alias("package_id"),
            F.try_variant_get("package", "$.resources", RESOURCE_TYPE).alias("resources"),
            "package",
        )
    )


def union_pages(*pages: DataFrame) -> DataFrame:
    """Pages of several landings as one table; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def page_errors(pages: DataFrame) -> DataFrame:
    """The replies that could not be read as a catalogue page."""
    keep = [c for c in pages.columns if c != "body"]
    return _results(pages).where(F.col("_results").isNull()).select(
        *keep, F.lit("failed to read catalogue page").alias("error_text")
    )


def explode_resources(packages: DataFrame) -> DataFrame:
    """One row per resource, its position within the package kept."""
    keep = [c for c in packages.columns if c not in ("resources", "package")]
    return unnest(packages, "resources", "_r", keep, "resource_pos").select(
        *keep,
        "resource_pos",
        *[F.col(f"_r.{name}").alias(name) for name in ("id", "url", "name", "format", "language")],
    )


def matching(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Rows that meet every filter: a list means membership, null means absence."""
    for name, value in filters.items():
        if value is None:
            condition = F.col(name).isNull()
        elif isinstance(value, (list, tuple, set, frozenset)):
            condition = F.col(name).isin(*value)
        else:
            condition = F.col(name) == value
        df = df.where(condition)
    return df


def package_search(
    catalog: DataFrame, start: int = 0, rows: int | None = None, order: tuple[str, ...] = ("id",), **filters: Any
) -> DataFrame:
    """Filtered window of the catalogue, in id order."""
    return limit_ordered(matching(catalog, filters), order, rows, start)


def package_show(catalog: DataFrame, wanted: Any, id_column: str = "id") -> DataFrame:
    """The package of one id, or of every id in a one-column DataFrame."""
    if isinstance(wanted, DataFrame):
        ids = wanted.select(F.col(wanted.columns[0]).alias(id_column))
        return catalog.join(ids, id_column, "left_semi")
    return catalog.where(F.col(id_column) == wanted)


def package_list(catalog: DataFrame, id_column: str = "id") -> DataFrame:
    return catalog.select(id_column)


def resource_show(resources: DataFrame, wanted: Any, id_column: str = "id") -> DataFrame:
    return package_show(resources, wanted, id_column)


def resource_search(resources: DataFrame, **filters: Any) -> DataFrame:
    return matching(resources, filters)
