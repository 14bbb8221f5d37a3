"""Indicator portals: database ids, indicator lists and the files of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import predicates as P
from gleanspark.functions import text
from gleanspark.operators.unnest import unnest

_HITS = "struct<value:array<struct<series_description:struct<database_id:string>>>>"


def scan_search_hits(replies: DataFrame) -> DataFrame:
    """``(database_id)``, one row per hit, from search replies in ``body``."""
    return unnest(replies, F.from_json("body", _HITS)["value"], "hit").select(
        F.col("hit.series_description.database_id").alias("database_id")
    )


def distinct_databases(hits: DataFrame) -> DataFrame:
    """The non-empty database ids, once each; combined map-side."""
    return hits.where(P.is_present("database_id")).select("database_id").distinct()


def scan_database_ids(replies: DataFrame) -> DataFrame:
    return distinct_databases(scan_search_hits(replies))


def scan_indicators(replies: DataFrame) -> DataFrame:
    """``(database_id, indicator_id)`` from the list replies with status 200."""
    listed = F.from_json("body", "array<string>")
    return unnest(replies.where(F.col("status") == 200), listed, "indicator_id", ("database_id",))


def list_errors(replies: DataFrame) -> DataFrame:
    """The list replies that failed, one row each; other databases go on."""
    bad = (F.col("status") != 200) | F.from_json("body", "array<string>").isNull()
    return replies.where(F.coalesce(bad, F.lit(True))).select("database_id", "status")


def expand_databases(indicators: DataFrame, database_ids: DataFrame) -> DataFrame:
    """The indicators of the wanted databases; one database may hold most of them."""
    return indicators.join(database_ids, "database_id", "left_semi")


def indicator_resources(indicators: DataFrame, metadata_root: str = "metadata", data_root: str = "data") -> DataFrame:
    """Two work rows per indicator: ``(database_id, indicator_id, kind, url, path)``."""
    ids = ("database_id", "indicator_id")
    return indicators.select(
        *ids,
        F.stack(
            F.lit(2),
            F.lit("metadata"),
            text.indicator_metadata_url(*ids),
            text.indicator_path(metadata_root, *ids, "json"),
            F.lit("data"),
            text.indicator_data_url(*ids),
            text.indicator_path(data_root, *ids, "csv"),
        ).alias("kind", "url", "path"),
    )


def clean_metadata(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Metadata documents freed of a BOM and written again as compact JSON; null when unreadable."""
    return bodies.withColumn(body, F.to_json(F.try_parse_json(text.strip_bom(body))))
