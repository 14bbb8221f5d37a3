"""Sinks. Keys are columns: nothing taken from the data becomes a path, except
partition values, which Spark escapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.session import PAYLOAD_OPTIONS

FORMATS = ("csv", "parquet", "json")


def _writer(df: DataFrame, fmt: str, mode: str):
    if fmt not in FORMATS:
        raise ValueError(f"unknown store format: {fmt}")
    writer = df.write.mode(mode).format(fmt)
    return writer.option("header", True) if fmt == "csv" else writer


def _gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one folder brought together, so that tasks times folders does not
    become the number of files; a hot folder is split again by AQE."""
    return df.hint("rebalance", *keys)


def store_dataset(df: DataFrame, destination: str, dataset_id: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """One dataset with its own columns, under ``<destination>/<fmt>/<id>``."""
    path = f"{destination}/{fmt}/{dataset_id.replace('/', '-')}"
    _writer(df, fmt, mode).save(path)
    return path


def store_datasets(rows: DataFrame, destination: str, buckets: int = 256, fmt: str = "parquet") -> None:
    """Any number of datasets in long form, partitioned by a hash of the dataset.

    A folder per dataset would mean millions of folders; a bucket keeps the
    number fixed and still lets a reader of one dataset skip the others. CSV has
    no maps, so records become JSON text there.
    """
    if fmt == "csv":
        maps = [f.name for f in rows.schema.fields if f.dataType.typeName() == "map"]
        rows = rows.withColumns({name: F.to_json(name) for name in maps})
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("dataset_id"), F.lit(buckets)))
    _writer(_gathered(bucketed, "bucket"), fmt, "overwrite").partitionBy("bucket").save(destination)


def store_payloads(payloads: DataFrame, destination: str, run_name: str) -> DataFrame:
    """Replies with their ``extension`` and ``content``, partitioned by run and extension.

    Written once, bodies and verdicts together: later steps read the columns
    they need from the written run, which is given back.
    """
    writer = payloads.drop("run_name").write.mode("overwrite").options(**PAYLOAD_OPTIONS)
    writer.partitionBy("extension").parquet(f"{destination}/run_name={run_name}")
    return payloads.sparkSession.read.parquet(f"{destination}/run_name={run_name}")


def store_catalog(packages: DataFrame, destination: str) -> DataFrame:
    """Filtered packages, whole documents included; gives back the written table."""
    packages.write.mode("overwrite").parquet(destination)
    return packages.sparkSession.read.schema(packages.schema).parquet(destination)


def store_work(work: DataFrame, destination: str) -> DataFrame:
    """The work list; gives back the written table."""
    work.write.mode("overwrite").parquet(destination)
    return work.sparkSession.read.schema(work.schema).parquet(destination)


def store_dataset_catalog(entries: DataFrame, destination: str) -> None:
    entries.write.mode("overwrite").json(destination)


def store_indicator(files: DataFrame, destination: str, mode: str = "append") -> None:
    """``(database_id, indicator_id, kind, body)`` by kind and database."""
    keys = ("kind", "database_id")
    _gathered(files, *keys).write.mode(mode).partitionBy(*keys).parquet(destination)


def store_topic_tables(tables: DataFrame, destination: str) -> None:
    """Decoded rows by topic and mart; folder path and record go into text columns."""
    flat = tables.withColumns({"path": F.array_join("path", "/"), "record": F.to_json("record")})
    (
        _gathered(flat, "topic", "mart_name")
        .write.mode("overwrite")
        .partitionBy("topic", "mart_name")
        .option("header", True)
        .csv(destination)
    )


def store_run_log(outcomes: DataFrame, destination: str) -> None:
    """Append outcomes, which carry ``run_name``, to the runs table."""
    outcomes.write.mode("append").partitionBy("run_name").parquet(destination)
