"""Package catalogues: from landed pages to stored payloads and a run summary."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import errors as E
from gleanspark.functions import predicates as P
from gleanspark.functions.payload import detected_extension, sniff_kind
from gleanspark.operators.positions import last_writer_wins, limit_ordered
from gleanspark.operators.resources import filter_package_resources, pending_work, work_list
from gleanspark.operators.responses import MAX_RESOURCE_SIZE, classify_responses, run_summary
from gleanspark.session import PAYLOAD_OPTIONS, materialize, small_batches
from gleanspark.sinks import store_catalog, store_datasets, store_payloads, store_run_log, store_work
from gleanspark.sources.catalog import explode_resources, page_errors, scan_packages
from gleanspark.sources.fetch import Transport, fetch
from gleanspark.sources.payloads import decode_archives, decode_csv, expand_archive

# Outcomes of archives without a member of the wanted kind, and of broken ones.
NO_CSV_MEMBER = "no_csv_member"
BAD_ARCHIVE = "BadArchive"
# Outcome of a reply that is no catalogue page.
BAD_PAGE = "bad_page"


@dataclass
class CatalogueHarvest:
    """Settings of a catalogue harvest.

    destination: folder for the catalogue, payloads, members and the run log.
    run_name: names the run in the log.
    base_url: portal base, for relative resource urls.
    start, max_packages: window of the catalogue in page order; none means all.
    predicate: which resources to keep; gets a field accessor.
    search_filters: values that top-level package fields must have.
    with_name: put the resource name in front of the storage key.
    expand_archives: unpack zip payloads into their CSV members.
    decode: turn CSV payloads and members into records, in ``download_format``
        (csv, parquet or json).
    reject_html, reject_zip_urls: count HTML payloads and ``.zip`` urls as errors.
    fetch_partitions, max_workers: tasks that fetch, and urls each asks for at a time.
    response_order: columns that tell the last of several landed replies to a
        url; without it landed replies are taken to be unique.
    """

    destination: str
    run_name: str
    base_url: str
    start: int = 0
    max_packages: int | None = None
    predicate: Callable[[P.Fields], Column] | None = None
    search_filters: Mapping[str, str] = field(default_factory=dict)
    with_name: bool = True
    save_catalog: bool = True
    expand_archives: bool = False
    decode: bool = False
    download_format: str = "parquet"
    reject_html: bool = False
    reject_zip_urls: bool = False
    extension: str = "csv"
    max_resource_size: int = MAX_RESOURCE_SIZE
    request_headers: Mapping[str, str] = field(default_factory=dict)
    fetch_partitions: int = 200
    max_workers: int = 1
    response_order: tuple[str, ...] = ()


def plan_catalogue(pages: DataFrame, cfg: CatalogueHarvest) -> tuple[DataFrame, DataFrame]:
    """The filtered packages and their work list ``(package_id, storage_key, url)``."""
    packages = scan_packages(pages)
    for name, value in cfg.search_filters.items():
        packages = packages.where(F.try_variant_get("package", f"$.{name}", "string") == value)
    packages = limit_ordered(packages, ("page_no", "package_pos"), cfg.max_packages, cfg.start)
    packages = filter_package_resources(packages, cfg.predicate)
    return packages, _work(packages, cfg)


def _work(packages: DataFrame, cfg: CatalogueHarvest) -> DataFrame:
    work = work_list(explode_resources(packages), cfg.base_url, cfg.with_name)
    return work.select("package_id", "storage_key", "url")


def harvest_catalogue(
    pages: DataFrame,
    cfg: CatalogueHarvest,
    transport: Transport | None = None,
    responses: DataFrame | None = None,
) -> DataFrame:
    """Run a harvest; replies come from ``transport`` or from a landed table.

    Work that an earlier run finished under the same destination is left out.
    Bodies are stored once per url, however many resources share it; the run
    log links storage keys to urls. A page that cannot be read is an error row
    without a storage key. Gives ``(run_name, successes, errors, total)``.
    """
    if (transport is None) == (responses is None):
        raise ValueError("give either a transport or landed responses")
    spark = pages.sparkSession
    finished = _read_if_any(pages, f"{cfg.destination}/runs")
    packages, _ = plan_catalogue(pages, cfg)
    # The pages are parsed once; the work list starts from the written packages.
    if cfg.save_catalog:
        packages = store_catalog(packages, f"{cfg.destination}/catalog/{cfg.run_name}")
    else:
        packages = materialize(packages.drop("package"))
    work = _work(packages, cfg)
    if finished is not None:
        if not finished.where(F.col("run_name") == cfg.run_name).isEmpty():
            raise ValueError(f"there is a finished run named {cfg.run_name}")
        work = pending_work(work, finished.where("ok"))
    work = store_work(work, f"{cfg.destination}/work/{cfg.run_name}")

    verdicts = _landed_replies(work, cfg, transport, responses)

    # Headers and verdicts only: bodies take no part in this join.
    outcomes = work.join(verdicts, "url", "left").select(
        F.lit(cfg.run_name).alias("run_name"),
        "package_id",
        "storage_key",
        "url",
        "status",
        F.coalesce("error_type", F.when(F.col("ok").isNull(), "no_reply")).alias("error_type"),
        "error_text",
        F.coalesce("ok", F.lit(False)).alias("ok"),
    )
    lost = page_errors(pages)
    lost = lost.select(
        F.lit(cfg.run_name).alias("run_name"),
        *[c for c in ("url", "status") if c in lost.columns],
        F.lit(BAD_PAGE).alias("error_type"),
        "error_text",
        F.lit(False).alias("ok"),
    )
    outcomes = outcomes.unionByName(lost, allowMissingColumns=True)
    store_run_log(outcomes, f"{cfg.destination}/runs")
    logged = spark.read.parquet(f"{cfg.destination}/runs").where(F.col("run_name") == cfg.run_name)
    return run_summary(logged, "run_name")


def _landed_replies(
    work: DataFrame, cfg: CatalogueHarvest, transport: Transport | None, responses: DataFrame | None
) -> DataFrame:
    """Store the replies and what they hold; gives the verdict on every url."""
    spark = work.sparkSession
    zip_url = P.is_zip_url("url") if cfg.reject_zip_urls else F.lit(False)
    wanted = work.where(~zip_url)
    if transport is not None:
        replies = fetch(wanted, transport, cfg.fetch_partitions, cfg.request_headers, cfg.max_resource_size, cfg.max_workers)
    else:
        if cfg.response_order:
            responses = last_writer_wins(responses, ("url",), cfg.response_order)
        urls = wanted.select("url").distinct()
        replies = classify_responses(responses.join(urls, "url", "left_semi"), cfg.max_resource_size)
        replies = replies.withColumn("content", F.when(F.col("ok"), F.col("content")))
    if cfg.reject_html:
        html = F.col("ok") & P.is_html_payload(F.col("content").cast("string"))
        replies = _marked(replies, F.when(html, E.IS_HTML), E.html_text("url"))
    kind = sniff_kind("content")
    stored = replies.withColumns({"kind": kind, "extension": detected_extension(kind, F.lit(cfg.extension))})
    with small_batches(spark):
        # Written once and read back, so that a fetch never runs twice.
        replies = store_payloads(stored, f"{cfg.destination}/payloads", cfg.run_name)
        verdicts = replies.select("url", "status", "error_type", "error_text", "ok")
        good = replies.where("ok").select("url", "kind", "content")
        if cfg.expand_archives:
            folder = f"{cfg.destination}/members/{cfg.run_name}"
            archives = good.where(F.col("kind") == "zip")
            expand_archive(archives, f".{cfg.extension}", "url").write.mode("overwrite").options(
                **PAYLOAD_OPTIONS
            ).parquet(folder)
            members = spark.read.parquet(folder)
            verdicts = _with_archive_verdicts(archives.select("url"), members, verdicts)
            # Of an archive that breaks off nothing is decoded.
            good = good.join(members.where(F.col("error_text").isNotNull()).select("url"), "url", "left_anti")
        if cfg.decode:
            _store_tables(good, cfg)
    if cfg.reject_zip_urls:
        refused = work.where(zip_url).select("url").distinct().select(
            "url", F.lit(None).cast("int").alias("status"), F.lit(E.IS_ZIP).alias("error_type"),
            E.zip_text("url").alias("error_text"), F.lit(False).alias("ok"),
        )
        verdicts = verdicts.unionByName(refused)
    return verdicts


def _marked(replies: DataFrame, problem: Column, message: Column) -> DataFrame:
    return replies.withColumn("_problem", problem).withColumns(
        {
            "error_text": F.when(F.col("_problem").isNotNull(), message).otherwise(F.col("error_text")),
            "error_type": F.coalesce("_problem", "error_type"),
            "ok": F.col("ok") & F.col("_problem").isNull(),
        }
    ).drop("_problem")


def _with_archive_verdicts(archives: DataFrame, members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Archives that are broken or give no member become errors."""
    found = members.groupBy("url").agg(F.max("error_text").alias("_unpack_error"), F.count("member").alias("_members"))
    problem = F.when(F.col("_unpack_error").isNotNull(), BAD_ARCHIVE).when(
        F.coalesce("_members", F.lit(0)) == 0, NO_CSV_MEMBER
    )
    opened = archives.join(found, "url", "left").select("url", "_unpack_error", problem.alias("_archive"))
    joined = verdicts.join(opened, "url", "left")
    marked = _marked(joined, F.col("_archive"), F.col("_unpack_error"))
    return marked.select("url", "status", "error_type", "error_text", "ok")


def _store_tables(good: DataFrame, cfg: CatalogueHarvest) -> None:
    """Decode CSV payloads, and archives where they are expanded, in the wanted format."""
    payloads = good.withColumnRenamed("url", "dataset_id")
    tables = decode_csv(payloads.where(F.col("kind") == "plain")).withColumn("member", F.lit(None).cast("string"))
    if cfg.expand_archives:
        unpacked = decode_archives(payloads.where(F.col("kind") == "zip"), f".{cfg.extension}")
        tables = tables.unionByName(unpacked.where(F.col("error_text").isNull()).drop("error_text"))
    store_datasets(tables, f"{cfg.destination}/tables/{cfg.run_name}", fmt=cfg.download_format)


def _read_if_any(like: DataFrame, path: str) -> DataFrame | None:
    spark = like.sparkSession
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
