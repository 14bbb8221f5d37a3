"""The portal dimension: one row per portal, user portals included."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

PORTAL_SCHEMA = "portal string, family string, base_url string, action_url string"

# Preset endpoints (portal, family, base url, action path).
PRESETS = (
    ("canada", "ckan", "https://open.canada.ca", "/data/api/3/action"),
    ("italy", "ckan", "https://dati.gov.it", "/opendata/api/3/action"),
    ("modena", "ckan", "https://opendata.comune.modena.it/", "/api/3/action"),
    ("ferrara", "ckan", "https://dati.comune.fe.it/", "/api/3/action"),
    ("uk", "ckan", "https://data.gov.uk", "/api/action"),
    ("nhs_uk", "ckan", "https://opendata.nhsbsa.net/", "/api/3/action"),
    ("chicago", "socrata", "https://data.cityofchicago.org", "/resource"),
    ("nyc", "socrata", "https://data.cityofnewyork.us", "/resource"),
)

# A broadcast of the dimension is safe up to here: rows of a few short strings.
MAX_PORTALS = 10_000


def portals(spark: SparkSession, extra: Iterable[tuple[str, str, str, str]] = ()) -> DataFrame:
    """Preset portals plus the user's own; a repeated name means the user's."""
    rows = {row[0]: tuple(row) for row in (*PRESETS, *extra)}
    if len(rows) > MAX_PORTALS:
        raise ValueError(f"{len(rows)} portals given, at most {MAX_PORTALS} are supported")
    return spark.createDataFrame(list(rows.values()), PORTAL_SCHEMA)


def portal(name: str) -> tuple[str, str]:
    """``(base_url, action_url)`` of one preset, where no join is needed."""
    return next((base, action) for preset, _, base, action in PRESETS if preset == name)
