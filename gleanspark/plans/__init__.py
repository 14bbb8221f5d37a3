"""Whole harvests, one per portal family, composed of the operators."""

from gleanspark.plans.catalogue import CatalogueHarvest, harvest_catalogue, plan_catalogue
from gleanspark.plans.datasets import DatasetHarvest, dataset_as_df, harvest_datasets
from gleanspark.plans.indicators import harvest_indicators
from gleanspark.plans.landing import land, land_catalogue, land_dataset_rows, land_indicators, land_topics
from gleanspark.plans.topics import harvest_topics

__all__ = [
    "CatalogueHarvest",
    "DatasetHarvest",
    "dataset_as_df",
    "harvest_catalogue",
    "harvest_datasets",
    "harvest_indicators",
    "harvest_topics",
    "land",
    "land_catalogue",
    "land_dataset_rows",
    "land_indicators",
    "land_topics",
    "plan_catalogue",
]
