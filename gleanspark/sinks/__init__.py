"""Writers for datasets, payloads, catalogues, tables and the run log."""

from gleanspark.sinks.manifests import manifests, publish, read_published, run_in_parts, stage
from gleanspark.sinks.stores import (
    store_catalog,
    store_dataset,
    store_dataset_catalog,
    store_datasets,
    store_indicator,
    store_payloads,
    store_run_log,
    store_topic_tables,
    store_work,
)

__all__ = [
    "manifests",
    "publish",
    "read_published",
    "run_in_parts",
    "stage",
    "store_catalog",
    "store_dataset",
    "store_dataset_catalog",
    "store_datasets",
    "store_indicator",
    "store_payloads",
    "store_run_log",
    "store_topic_tables",
    "store_work",
]
