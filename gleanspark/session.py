"""Session helpers: the settings every job relies on, and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings; results depend on the first three, speed on the rest.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bytes, not rows, bound what a Python worker holds at a time; a longer row is a batch of its own.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 2**20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gleanspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gleanspark-")) / "gleanspark.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in [*sorted(package.rglob("*.py")), *package.parent.glob("corpus_pipeline.py")]:
            packed.write(source, os.path.relpath(source, package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster's own ``spark.checkpoint.dir`` wins. A temporary folder is
    taken only on a local master, where it is shared by construction.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="gleanspark-checkpoint-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


#: Writer options for rows that hold whole files: look at the size of a row group
#: after every row, instead of after the first hundred.
PAYLOAD_OPTIONS = {"parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def materialize(df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage, so that a lost executor costs no more than a re-read, and
    gives every later reader the same rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 16) -> Iterator[None]:
    """Read few rows at a time, and write without sorting, while payload bytes are handled.

    The columnar reader takes 4096 rows per batch by default, which is gigabytes
    where a row holds a whole file; and a partitioned write sorts its rows unless
    it may keep a few files open.
    """
    settings = {
        "spark.sql.parquet.columnarReaderBatchSize": str(rows),
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table of few, heavy rows out by key before per-row work that is heavy."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
