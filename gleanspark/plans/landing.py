"""Landing the portals' own replies: catalogue pages, dataset rows, marts, indicator lists.

Requests are rows; each is fetched in a task through the user's transport and
the replies are written once. What comes back feeds the harvests.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.functions import text
from gleanspark.operators.coverage import fill_requests, row_coverage
from gleanspark.operators.unnest import unnest
from gleanspark.session import PAYLOAD_OPTIONS, materialize, small_batches
from gleanspark.sources.catalog import catalog_page_plan, catalog_total
from gleanspark.sources.fetch import Transport, fetch
from gleanspark.sources.indicators import scan_database_ids
from gleanspark.sources.topics import scan_topics

# Entry points of the topic and the indicator portal.
EXPLORER_URL = "http://data.un.org/Handlers/ExplorerHandler.ashx"
SEARCH_URL = "https://data360api.worldbank.org/data360/searchv2"

_MAX_REPLY = 2**31 - 1


def land(
    requests: DataFrame, transport: Transport, partitions: int = 200, headers: Mapping[str, str] | None = None
) -> DataFrame:
    """``requests`` (with a ``url``) plus ``status`` and ``body`` as text, written once.

    A request that fails keeps its row, with a null body.
    """
    requests = materialize(requests)
    body = F.make_valid_utf8(F.col("content").cast("string"))
    fetched = fetch(requests, transport, partitions, headers, _MAX_REPLY)
    replies = materialize(fetched.select("url", "status", body.alias("body")), PAYLOAD_OPTIONS)
    with small_batches(requests.sparkSession):
        return materialize(requests.join(replies, "url", "left"), PAYLOAD_OPTIONS)


def land_catalogue(
    spark: SparkSession,
    base_url: str,
    action_path: str,
    transport: Transport,
    start: int = 0,
    max_packages: int | None = None,
    batch: int = 1000,
    filters: Mapping[str, str] | None = None,
    partitions: int = 200,
    headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(page_no, start, rows, url, status, body)`` of a package catalogue.

    Asks for the package count, then for every planned page; ``filters`` go along
    with each request.
    """
    wanted = {name: F.lit(value) for name, value in (filters or {}).items()}

    def search(first, rows):
        parameters = {"start": first, "rows": rows, **wanted}
        return text.action_url(F.lit(base_url), F.lit(action_path), "package_search", parameters).alias("url")

    probe = spark.range(1).select(search(F.lit(0), F.lit(0)))
    totals = catalog_total(land(probe, transport, 1, headers))
    if totals.first()["total"] is None:
        raise ValueError("the portal does not tell its number of packages")
    plan = catalog_page_plan(totals, start, max_packages, batch)
    return land(plan.select("*", search(F.col("start"), F.col("rows"))), transport, partitions, headers)


class _RowRequests:
    """Sends requests for rows of datasets and keeps the rows and failures that come back."""

    def __init__(self, spark: SparkSession, base_url: str, transport: Transport, partitions: int, headers: Mapping[str, str] | None):
        self._url = f"{base_url.rstrip('/')}/resource/%s.json?$limit=%d&$offset=%d"
        self._land = lambda requests: land(requests, transport, partitions, headers)
        self.failures = spark.createDataFrame([], "dataset_id string, offset bigint, url string, status int")

    def send(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """For ``(dataset_id, offset, asked)``: pages ``(dataset_id, offset, asked, rows, failed)``, and their rows."""
        url = F.format_string(self._url, "dataset_id", "asked", "offset")
        replies = self._land(requests.withColumn("url", url))
        failed = F.coalesce(F.col("status") != 200, F.lit(True)) | F.from_json("body", "array<string>").isNull()
        replies = replies.withColumn("failed", failed)
        self.failures = self.failures.unionByName(replies.where("failed").select("dataset_id", "offset", "url", "status"))
        records = F.from_json("body", "array<map<string,string>>")
        found = unnest(replies.where("not failed"), records, "record", ("dataset_id", "offset", "asked"), "pos")
        # What a portal sends beyond what it was asked for is the next request's.
        rows = materialize(found.where("pos < asked").drop("asked").withColumn("row_idx", F.col("offset") + F.col("pos")))
        counts = rows.groupBy("dataset_id", "offset").agg(F.count(F.lit(1)).alias("rows"))
        pages = replies.select("dataset_id", "offset", "asked", "failed").join(counts, ["dataset_id", "offset"], "left")
        return materialize(pages.fillna(0, ["rows"])), rows.select("dataset_id", "row_idx", "record")

    def find_ends(self, datasets: DataFrame, limit: int, batch: int, probes: int) -> DataFrame:
        """``(dataset_id, stop)``: no row is known at ``stop``, and the last row is less than about ``batch`` before it.

        Single rows are asked for at offsets that double until one is empty, then
        between the last row found and the first empty offset. Both take a number
        of rounds that is the logarithm of the largest dataset.
        """
        high = F.lit(None if limit == -1 else limit).cast("bigint")
        state = datasets.select("dataset_id", F.lit(-1).cast("bigint").alias("low"), high.alias("high"), F.lit(batch).cast("bigint").alias("next"))
        near = F.col("high") - F.greatest("low", F.lit(0)) <= batch
        ends = state.where(near).select("dataset_id", F.col("high").alias("stop"))
        state = state.where(~F.coalesce(near, F.lit(False)))
        while not state.isEmpty():
            doubled = F.array(*[F.col("next") * 2**i for i in range(probes)])
            steps = [F.col("low") + F.floor((F.col("high") - F.col("low")) * i / (probes + 1)) for i in range(1, probes + 1)]
            spots = F.when(F.col("high").isNull(), doubled).otherwise(F.array_distinct(F.filter(F.array(*steps), lambda o: o > F.col("low"))))
            pages, _ = self.send(state.select("dataset_id", F.explode(spots).alias("offset"), F.lit(1).alias("asked")))
            # At most `probes` offsets a dataset.
            answers = pages.groupBy("dataset_id").agg(
                F.max(F.when(F.col("rows") > 0, F.col("offset"))).alias("answered"),
                F.collect_list(F.when((F.col("rows") == 0) & ~F.col("failed"), F.col("offset"))).alias("empty"),
                F.max("offset").alias("tried"),
            )
            low = F.greatest("low", F.coalesce("answered", "low"))
            moved = state.join(answers, "dataset_id", "left").select("*", low.alias("new_low"))
            empty = F.array_min(F.filter("empty", lambda o: o > F.col("new_low")))
            moved = moved.select("*", F.least("high", empty).alias("new_high"))
            # Where all probes failed nothing moves on, and the pages up to here are asked for.
            stuck = F.col("new_low").eqNullSafe(F.col("low")) & F.col("new_high").eqNullSafe(F.col("high"))
            near = F.coalesce(F.col("new_high") - F.greatest("new_low", F.lit(0)) <= batch, F.lit(False)) | stuck
            moved = materialize(moved.select("dataset_id", "new_low", "new_high", "tried", near.alias("near")))
            stop = F.coalesce("new_high", F.col("tried"), F.lit(batch))
            ends = ends.union(moved.where("near").select("dataset_id", stop.alias("stop")))
            state = moved.where("not near").select(
                "dataset_id", F.col("new_low").alias("low"), F.col("new_high").alias("high"), (F.col("tried") * 2).alias("next")
            )
        return materialize(ends)


def land_dataset_rows(
    datasets: DataFrame,
    base_url: str,
    transport: Transport,
    limit: int = -1,
    batch: int = 1000,
    probes: int = 8,
    partitions: int = 200,
    headers: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of every dataset, up to ``limit`` each (-1 for all), and the requests that failed.

    Rows are ``(dataset_id, row_idx, record)``, failures ``(dataset_id, offset,
    url, status)``. Probes find where each dataset ends, in parallel; then all its
    pages are asked for at once. What they leave uncovered is asked for again, in
    requests as large as the portal has answered, until an empty reply stands
    right behind the last row: a portal that cuts pages short loses nothing. A
    failed request is reported and not sent again, and loses its own rows alone.
    The number of jobs grows with the logarithm of the largest dataset.
    """
    if batch < 1 or probes < 1:
        raise ValueError("batch and probes must be positive")
    spark = datasets.sparkSession
    requests = _RowRequests(spark, base_url, transport, partitions, headers)
    wanted = materialize(datasets.select(F.col("dataset_id").cast("string")).where("dataset_id is not null").distinct())
    rows = spark.createDataFrame([], "dataset_id string, row_idx bigint, record map<string,string>")
    pages = spark.createDataFrame([], "dataset_id string, offset bigint, asked int, failed boolean, rows bigint")
    if limit == 0 or wanted.isEmpty():
        return rows, requests.failures
    ends = requests.find_ends(wanted, limit, batch, probes)
    while True:
        covered = pages.select("dataset_id", "offset", F.when(F.col("failed"), F.col("asked")).otherwise(F.col("rows")).alias("rows"))
        empty = pages.where("rows = 0 and not failed").select("dataset_id", F.col("offset").alias("stop"))
        known = ends.unionByName(empty).groupBy("dataset_id").agg(F.min("stop").alias("stop"))
        answered = pages.groupBy("dataset_id").agg(F.max("rows").alias("most"))
        gaps = row_coverage(covered, known).where("kind = 'gap'").join(known.withColumnRenamed("stop", "end"), "dataset_id")
        # Pages beyond an empty reply may hold rows of a dataset that grew: they stay, but nothing is asked for there.
        gaps = gaps.where("start < end").join(answered, "dataset_id", "left")
        size = F.when(F.col("most") > 0, F.col("most")).otherwise(batch).cast("int")
        missing = materialize(fill_requests(gaps.select("dataset_id", "start", F.least("stop", "end").alias("stop"), size.alias("size"))))
        if missing.isEmpty():
            return rows, requests.failures
        landed, found = requests.send(missing)
        rows, pages = rows.unionByName(found), pages.unionByName(landed)


def land_topics(
    spark: SparkSession, transport: Transport, partitions: int = 200, headers: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Explorer and mart replies of the topic portal."""
    explorer = land(spark.range(1).select(F.lit(EXPLORER_URL).alias("url")), transport, 1, headers)
    marts = scan_topics(explorer).select("mart_id").distinct().withColumn("url", text.mart_url("mart_id"))
    return explorer, land(marts, transport, partitions, headers)


def land_indicators(
    spark: SparkSession, transport: Transport, partitions: int = 200, headers: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Search and indicator-list replies of the indicator portal.

    The portal takes its search as a posted query, which is the transport's part.
    """
    hits = land(spark.range(1).select(F.lit(SEARCH_URL).alias("url")), transport, 1, headers)
    lists = scan_database_ids(hits).withColumn("url", text.indicator_list_url("database_id"))
    return hits, land(lists, transport, partitions, headers)
