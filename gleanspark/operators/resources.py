"""From resources to a work list and filtered packages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import predicates as P
from gleanspark.functions import text

def filter_resources(resources: DataFrame, predicate: Column | Callable | None) -> DataFrame:
    """Rows the predicate keeps: a Column, or a vectorised ``pandas_udf`` over a struct of the row."""
    if predicate is None:
        return resources
    if not isinstance(predicate, Column):
        predicate = predicate(F.struct(*resources.columns))
    return resources.where(predicate)


def drop_unusable(resources: DataFrame) -> DataFrame:
    return resources.where(P.usable("url", "id"))


def clean_resources(resources: DataFrame, with_name: bool = True) -> DataFrame:
    """Add ``clean_id``, ``clean_name`` and ``storage_key``."""
    return resources.withColumns(
        {"clean_id": text.clean_resource_id("id"), "clean_name": text.clean_resource_name("name")}
    ).withColumn("storage_key", text.storage_key("clean_name", "clean_id", with_name))


def with_portal(work: DataFrame, portals: DataFrame) -> DataFrame:
    """Join the portal dimension, whose size ``portals`` has checked."""
    return work.join(F.broadcast(portals), "portal")


def work_list(resources: DataFrame, base_url: Column | str, with_name: bool = True) -> DataFrame:
    """Usable resources with ``storage_key`` and an absolute ``url``; no shuffle."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    cleaned = clean_resources(drop_unusable(resources), with_name)
    return cleaned.withColumn("url", text.absolutize_url("url", base))


def keep_accepted(resources: DataFrame, accepted: DataFrame, keys: Sequence[str] = ("package_id", "id")) -> DataFrame:
    """The resources whose key is among the accepted ones."""
    return resources.join(accepted.select(*keys), list(keys), "left_semi")


def filter_package_resources(packages: DataFrame, predicate: Callable[[P.Fields], Column] | None = None) -> DataFrame:
    """Cut each package's ``resources`` to the usable, accepted ones, inside its own row.

    Sets ``num_resources`` and drops packages left empty. No explode, no shuffle.
    """
    def keep(resource: Column) -> Column:
        usable = P.usable(resource["url"], resource["id"])
        return usable if predicate is None else usable & F.coalesce(predicate(resource.getField), F.lit(False))

    kept = packages.withColumn("resources", F.filter("resources", keep))
    return kept.withColumn("num_resources", F.size("resources").cast("bigint")).where(F.col("num_resources") > 0)


def count_package_resources(resources: DataFrame, key: str = "package_id") -> DataFrame:
    """``(package_id, num_resources)``, combined map-side."""
    return resources.groupBy(key).agg(F.count(F.lit(1)).alias("num_resources"))


def rollup_packages(resources: DataFrame, key: str = "package_id") -> DataFrame:
    """Flat resources with the ``num_resources`` of their package on every row.

    The counts are merged map-side and joined back, so no package is gathered in
    one row, however large it is. Where the input is nested already,
    :func:`filter_package_resources` needs no shuffle.
    """
    counts = count_package_resources(resources.where(F.col(key).isNotNull()), key)
    return resources.join(counts, key)


def pending_work(work: DataFrame, done: DataFrame, key: str = "storage_key") -> DataFrame:
    """The work that has no finished row yet."""
    return work.join(done.select(key), key, "left_anti")
