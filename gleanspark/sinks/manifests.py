"""Writes that are seen whole or not at all: stage a folder, then publish a manifest that names it.

A run that is killed leaves folders that no manifest names; nobody reads them, and
the next run does their work again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.resources import pending_work
from gleanspark.session import materialize

MANIFEST = "name string, folder string, rows bigint, published_at timestamp"


def stage(df: DataFrame, destination: str, name: str) -> str:
    """Write ``df`` under a new folder of ``destination``, unseen by readers; gives the folder."""
    folder = f"staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(f"{destination}/{folder}")
    return folder


def publish(spark: SparkSession, destination: str, name: str, folder: str) -> None:
    """Make a staged folder the content of ``name``: one manifest row, in one file that appears at once."""
    rows = spark.read.parquet(f"{destination}/{folder}").count()
    manifest = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(folder).alias("folder"),
        F.lit(rows).cast("bigint").alias("rows"),
        F.current_timestamp().alias("published_at"),
    )
    manifest.coalesce(1).write.mode("append").parquet(f"{destination}/manifests")


def manifests(spark: SparkSession, destination: str) -> DataFrame:
    """The manifests in force, ``(name, folder, rows, published_at)``: of one name the last published."""
    try:
        every = spark.read.schema(MANIFEST).parquet(f"{destination}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    newest = Window.partitionBy("name").orderBy(F.col("published_at").desc(), "folder")
    return every.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def read_published(spark: SparkSession, destination: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all published folders; none where nothing is published."""
    # One row per published part.
    folders = [r["folder"] for r in manifests(spark, destination).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{destination}/{folder}" for folder in folders])


def run_in_parts(
    work: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    destination: str,
    run_name: str,
    schema: T.StructType | str,
    parts: int = 64,
    key: str = "storage_key",
    part: Column | None = None,
    before_publish: Callable[[int], None] | None = None,
) -> DataFrame:
    """Do the work that has no published row yet, part by part; gives all published rows.

    ``step`` turns rows of work into outcomes of ``schema``, which carry ``key``. Work
    is cut in ``parts`` by a hash of its key (or by ``part``), each of them a job over
    all executors, staged and then published, so that a killed run loses the part
    it was at. Work without key is done in every run. Called again with the same or
    with more work, only what is pending is done. ``before_publish`` is called
    with the part's number between both steps.
    """
    spark = work.sparkSession
    done = materialize(read_published(spark, destination, schema).select(key).distinct())
    number = F.pmod(F.xxhash64(key), F.lit(parts)) if part is None else part
    pending = pending_work(work, done, key).withColumn("_part", number.cast("int"))
    path = f"{destination}/work/{run_name}-{uuid.uuid4().hex}"
    pending.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    todo = spark.read.schema(pending.schema).parquet(path)
    for found in sorted(r["_part"] for r in todo.select("_part").distinct().collect()):
        rows = todo.where(F.col("_part") == found).drop("_part")
        folder = stage(step(rows), destination, f"{run_name}-{found}")
        if before_publish is not None:
            before_publish(found)
        publish(spark, destination, f"{run_name}-{found}-{folder.rpartition('-')[2]}", folder)
    return read_published(spark, destination, schema)
