"""Tabular portals: from catalogue entries and record pages to typed, stored datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.errors import HTTP_ERROR, dataset_error_record
from gleanspark.functions.types import schema_from_metadata
from gleanspark.operators.positions import limit_indexed_rows
from gleanspark.operators.typed import declared_columns, records_to_df, typed_records
from gleanspark.session import materialize
from gleanspark.sinks import store_dataset, store_dataset_catalog, store_datasets, store_run_log
from gleanspark.sources.datasets import dataset_metadata, scan_dataset_catalog, scan_dataset_rows


@dataclass
class DatasetHarvest:
    """Settings of a dataset harvest; ``max_rows`` -1 takes whole datasets, ``fmt`` is parquet, csv or json.

    With a ``run_name`` the outcomes go to the run log as well.
    """

    destination: str
    start: int = 0
    max_datasets: int | None = None
    max_rows: int = -1
    cast_datatypes: bool = False
    save_metadata: bool = True
    fmt: str = "parquet"
    run_name: str = ""


def dataset_as_df(
    rows: DataFrame, dataset_id: str, entries: DataFrame | None = None, limit: int = -1, offset: int = 0
) -> DataFrame:
    """One dataset as columns: cast by its entry when ``entries`` has it, else by inference."""
    records = scan_dataset_rows(rows, dataset_id, limit, offset)
    # One catalogue entry: three short arrays.
    entry = None if entries is None else dataset_metadata(entries, dataset_id).first()
    if entry is None:
        return records_to_df(records)
    schema = schema_from_metadata(
        entry["columns_field_name"], entry["columns_datatype"], entry["columns_format"]
    )
    return records_to_df(records, schema)


def store_one_dataset(
    rows: DataFrame,
    dataset_id: str,
    destination: str,
    fmt: str = "parquet",
    entries: DataFrame | None = None,
    limit: int = -1,
    offset: int = 0,
) -> DataFrame:
    """As :func:`dataset_as_df`, also written in the wanted format."""
    frame = dataset_as_df(rows, dataset_id, entries, limit, offset)
    store_dataset(frame, destination, dataset_id, fmt)
    return frame


def harvest_datasets(entries: DataFrame, rows: DataFrame, cfg: DatasetHarvest, failures: DataFrame | None = None) -> DataFrame:
    """Store the wanted datasets in one job; gives ``(dataset_id, n_rows, type_error, ok, error_record)``.

    Records are stored in long form, cast ones as variants. An entry
    with an unknown declaration keeps its strings and is reported. ``failures``
    are the requests that failed while the rows were landed ``(dataset_id, offset,
    url, status)``: a dataset with any is stored as far as it came and is not ok.
    A dataset without rows is not ok either.
    """
    wanted = scan_dataset_catalog(entries, cfg.max_datasets, cfg.start)
    if cfg.save_metadata:
        store_dataset_catalog(wanted, f"{cfg.destination}/metadata")
    records = limit_indexed_rows(rows, cfg.max_rows)
    if cfg.cast_datatypes:
        stored = typed_records(records, wanted, "inner")
        if cfg.fmt != "parquet":  # no variants there
            stored = stored.withColumn("record", F.to_json("record"))
    else:
        stored = records.join(wanted.select("dataset_id"), "dataset_id", "left_semi")
    store_datasets(stored, f"{cfg.destination}/datasets", fmt=cfg.fmt)
    # The column read is the key alone; the formats without types are given it.
    reader = rows.sparkSession.read.format(cfg.fmt).option("header", True)
    if cfg.fmt != "parquet":
        # CSV goes by place, and keeps only texts.
        kinds = [f"`{f.name}` {'string' if cfg.fmt == 'csv' else f.dataType.simpleString()}" for f in stored.schema.fields]
        reader = reader.schema(", ".join(kinds))
    counts = reader.load(f"{cfg.destination}/datasets").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n_rows"))
    outcomes = declared_columns(wanted).select("dataset_id", "type_error").join(counts, "dataset_id", "left")
    if failures is None:
        failures = rows.sparkSession.createDataFrame([], "dataset_id string, status int")
    failed = failures.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_failed"), F.min("status").alias("_status"))
    outcomes = outcomes.join(failed, "dataset_id", "left")
    message = (
        F.when(F.col("_failed") > 0, F.format_string("%d requests failed, status %s", "_failed", F.coalesce(F.col("_status").cast("string"), F.lit("none"))))
        .when(F.col("n_rows").isNull(), F.lit("no rows"))
        .when(F.col("type_error"), F.lit("unexpected column declaration"))
    )
    kind = (
        F.when(F.col("_failed") > 0, F.lit(HTTP_ERROR)).when(F.col("n_rows").isNull(), F.lit("EmptyDataset")).otherwise(F.lit("ValueError"))
    )
    outcomes = outcomes.select(
        "dataset_id",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "type_error",
        (F.col("n_rows").isNotNull() & F.col("_failed").isNull()).alias("ok"),
        F.when(message.isNotNull(), dataset_error_record("dataset_id", message, kind)).alias("error_record"),
    )
    if cfg.run_name:
        outcomes = materialize(outcomes)
        store_run_log(outcomes.withColumn("run_name", F.lit(cfg.run_name)), f"{cfg.destination}/runs")
    return outcomes
