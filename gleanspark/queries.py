"""The registered queries and, where SQL can say it, the oracle of each.

Every query reads the given tables whole. Computed columns carry the same name
and type on both sides; arrays are joined to text, floats compared as doubles.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark import fixtures
from gleanspark.functions import payload, predicates, text, types
from gleanspark.operators import coverage, dates, lanes, nested, positions, resources, responses, snapshots, spatial, tree, typed
from gleanspark.plans import CatalogueHarvest, DatasetHarvest, harvest_catalogue, harvest_datasets, harvest_indicators
from gleanspark.session import checkpoint_dir, configure, materialize, spread
from gleanspark.sinks import run_in_parts
from gleanspark.sources import catalog, datasets, indicators, payloads, search, topics
from gleanspark.sources.fetch import fetch
from gleanspark.sources.portals import portals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE_URL = "https://portal.example.org/"


def query(oracle: str | None = None, views: tuple[str, ...] = ()) -> Callable:
    """Register a function ``(read, spark) -> DataFrame`` with its oracle SQL."""

    def add(body: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return body(lambda name: fixtures.load(spark, sf_dir, name), spark)

        QUERIES[body.__name__] = run
        if oracle is not None:
            ORACLES[body.__name__] = fixtures.with_views(oracle, *views)
        return body

    return add


# Shared oracle fragments.
_CLEAN_ID = "replace(replace(id, '/', '-'), '__', '--')"
_CLEAN_NAME = (
    "coalesce(replace(replace(replace(regexp_replace(name, '^\\s+|\\s+$', '', 'g'), ' ', '-'), ':', '-'), '__', '--'), '')"
)
_KEY = f"CASE WHEN {_CLEAN_NAME} <> '' THEN {_CLEAN_NAME} || '__' || {_CLEAN_ID} ELSE {_CLEAN_ID} END"
_USABLE = "url <> '' AND id <> ''"
_ABSOLUTE = "CASE WHEN starts_with(url, 'http') THEN url ELSE 'https://portal.example.org/' || url END"
_LENGTH = "TRY_CAST(content_length AS BIGINT)"
_ERROR_TYPE = f"""CASE WHEN status >= 400 THEN 'HTTPResourceError'
  WHEN content_length <> '' AND {_LENGTH} IS NULL THEN 'ValueError'
  WHEN {_LENGTH} > 2000 THEN 'TooLargeResourceError' END"""
_ERROR_TEXT = f"""CASE WHEN status >= 400 THEN 'Error status ' || status || ' with requested URL: ' || url
  WHEN content_length <> '' AND {_LENGTH} IS NULL THEN 'invalid Content-Length: ' || content_length
  WHEN {_LENGTH} > 2000 THEN 'Resource size ' || {_LENGTH} || ' > max_size 2000 for URL: ' || url END"""


# --- work list and packages ------------------------------------------------


@query(
    f"""SELECT package_id, count(*) AS num_resources,
  count(*) FILTER (WHERE NOT starts_with(url, 'http')) AS completed_urls, max(length({_KEY})) AS longest_key
FROM fx_resources WHERE lower(format) = 'csv' AND {_USABLE} GROUP BY package_id""",
    ("fx_resources",),
)
def q_harvest_plan(read, spark):
    """Packages that have accepted CSV resources, the urls completed and the longest key."""
    accepted = resources.filter_resources(read("fx_resources"), predicates.is_csv())
    relative = ~F.startswith("url", F.lit("http"))
    work = resources.work_list(accepted.withColumn("relative", relative), BASE_URL)
    return work.groupBy("package_id").agg(
        F.count(F.lit(1)).alias("num_resources"),
        F.count_if("relative").alias("completed_urls"),
        F.max(F.length("storage_key")).cast("bigint").alias("longest_key"),
    )


@query(
    f"""SELECT package_id, {_KEY} AS storage_key, {_ABSOLUTE} AS url
FROM fx_resources WHERE lower(format) = 'csv' AND {_USABLE}""",
    ("fx_resources",),
)
def q_work_list(read, spark):
    accepted = resources.filter_resources(read("fx_resources"), predicates.is_csv())
    return resources.work_list(accepted, BASE_URL).select("package_id", "storage_key", "url")


@query(
    f"""SELECT package_id, id, {_CLEAN_ID} AS clean_id, {_CLEAN_NAME} AS clean_name, {_KEY} AS storage_key,
  '/data/datasets/csv/' || ({_KEY}) || '.csv' AS target
FROM fx_resources WHERE {_USABLE}""",
    ("fx_resources",),
)
def q_clean_resources(read, spark):
    cleaned = resources.clean_resources(resources.drop_unusable(read("fx_resources")))
    return cleaned.select(
        "package_id",
        "id",
        "clean_id",
        "clean_name",
        "storage_key",
        text.target_path("/data", "storage_key", F.lit("csv")).alias("target"),
    )


@query(
    """SELECT id, package_id, portal, CASE WHEN starts_with(url, 'http') THEN url ELSE base || '/' || url END AS url
FROM (SELECT *, CASE format WHEN 'CSV' THEN 'canada' WHEN 'json' THEN 'modena' ELSE 'uk' END AS portal,
  CASE format WHEN 'CSV' THEN 'https://open.canada.ca' WHEN 'json' THEN 'https://opendata.comune.modena.it'
    ELSE 'https://data.gov.uk' END AS base FROM fx_resources)""",
    ("fx_resources",),
)
def q_absolutize(read, spark):
    """Relative urls completed by the base url of the resource's portal."""
    portal = F.when(F.col("format") == "CSV", "canada").when(F.col("format") == "json", "modena").otherwise("uk")
    located = resources.with_portal(read("fx_resources").withColumn("portal", portal), portals(spark))
    return located.select("id", "package_id", "portal", text.absolutize_url("url", "base_url").alias("url"))


@query(
    """SELECT page_id, i - 1 AS pos, host || links[i] AS url FROM (
  SELECT page_id, regexp_extract(url, '^https?://[^/]+') AS host, links, unnest(range(1, len(links) + 1)) AS i
  FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages))"""
)
def q_absolutize_links(read, spark):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return (
        read("pages")
        .select("page_id", F.regexp_extract("url", "^https?://[^/]+", 0).alias("host"), F.posexplode(links).alias("pos", "href"))
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), text.absolutize_url("href", "host").alias("url"))
    )


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'https://open.canada.ca/data/api/3/action'
  WHEN 'F' THEN 'https://dati.comune.fe.it/api/3/action' ELSE 'https://data.gov.uk/api/action' END || '/package_search?'
  || concat_ws('&', 'start=' || o_orderkey, 'rows=1000', CASE WHEN o_orderstatus = 'O' THEN 'q=' || o_orderpriority END) AS url
FROM orders"""
)
def q_action_url(read, spark):
    """Request urls for the portal of each row; parameters that are null vanish."""
    status = F.col("o_orderstatus")
    requests = read("orders").withColumns(
        {
            "portal": F.when(status == "O", "canada").when(status == "F", "ferrara").otherwise("uk"),
            "rows": F.lit(1000),
            "q": F.when(status == "O", F.col("o_orderpriority")),
        }
    )
    parameters = {"start": "o_orderkey", "rows": "rows", "q": "q"}
    url = text.action_url("base_url", "action_url", "package_search", parameters)
    return resources.with_portal(requests, portals(spark)).select("o_orderkey", url.alias("url"))


def _predicate_oracle(condition: str) -> str:
    return f"SELECT package_id, id, name, format, language FROM fx_resources WHERE {condition}"


def _predicate_query(read, predicate: Column) -> DataFrame:
    kept = resources.filter_resources(read("fx_resources"), predicate)
    return kept.select("package_id", "id", "name", "format", "language")


@query(_predicate_oracle("lower(format) = 'csv'"), ("fx_resources",))
def q_pred_csv(read, spark):
    return _predicate_query(read, predicates.is_csv())


@query(_predicate_oracle("lower(format) IN ('csv', 'json')"), ("fx_resources",))
def q_pred_csv_json(read, spark):
    return _predicate_query(read, predicates.is_csv_or_json())


@query(
    _predicate_oracle(
        "lower(format) = 'csv' AND (language IS NULL OR contains(language, 'en')) "
        "AND NOT coalesce(regexp_matches(name, '\\(CSV.+\\)', 's'), false)"
    ),
    ("fx_resources",),
)
def q_pred_canada(read, spark):
    return _predicate_query(read, predicates.canada_predicate())


@query(
    _predicate_oracle(
        "lower(format) = 'csv' AND NOT coalesce(regexp_matches(name, '^v\\d+'), false) "
        "AND NOT coalesce(regexp_matches(name, '^Contracts Finder'), false)"
    ),
    ("fx_resources",),
)
def q_pred_uk(read, spark):
    return _predicate_query(read, predicates.uk_predicate())


@query(_predicate_oracle("length(name) > 20"), ("fx_resources",))
def q_pred_callable(read, spark):
    """A user predicate given as Python, run on Arrow batches."""

    @F.pandas_udf("boolean")
    def long_name(rows: pd.DataFrame) -> pd.Series:
        return rows["name"].str.len().fillna(0) > 20

    return _predicate_query(read, long_name)


@query(
    f"""SELECT r.package_id, r.id, r.name, r.url FROM fx_resources r WHERE EXISTS (
  SELECT 1 FROM fx_resources a WHERE a.package_id = r.package_id AND a.id = r.id
    AND lower(a.format) = 'csv' AND a.url <> '' AND a.id <> '')""",
    ("fx_resources",),
)
def q_semi_accepted(read, spark):
    everything = read("fx_resources")
    accepted = resources.drop_unusable(resources.filter_resources(everything, predicates.is_csv()))
    return resources.keep_accepted(everything, accepted).select("package_id", "id", "name", "url")


@query(
    f"""SELECT package_id, id, url, count(*) OVER (PARTITION BY package_id) AS num_resources
FROM fx_resources WHERE lower(format) = 'csv' AND {_USABLE}""",
    ("fx_resources",),
)
def q_rollup_packages(read, spark):
    accepted = resources.drop_unusable(resources.filter_resources(read("fx_resources"), predicates.is_csv()))
    return resources.rollup_packages(accepted).select("package_id", "id", "url", "num_resources")


@query(
    f"""SELECT package_id, {_KEY} AS storage_key FROM fx_resources r WHERE {_USABLE} AND NOT EXISTS (
  SELECT 1 FROM (SELECT {_KEY} AS k FROM fx_resources WHERE {_USABLE} AND language = 'fr') d WHERE d.k = {_KEY})""",
    ("fx_resources",),
)
def q_pending_anti(read, spark):
    """Work without a finished row; the French resources count as finished."""
    work = resources.work_list(read("fx_resources"), BASE_URL)
    done = work.where(F.col("language") == "fr")
    return resources.pending_work(work, done).select("package_id", "storage_key")


# --- catalogue -------------------------------------------------------------


def _catalog_pages(read) -> DataFrame:
    """Catalogue replies, one per web page: a package per link; pages with a query string failed."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))

    def package(href: Column, at: Column) -> Column:
        package_id = F.concat(F.col("page_id").cast("string"), F.lit(":"), at.cast("string"))
        table = F.struct(
            F.concat(package_id, F.lit("/t")).alias("id"),
            href.alias("url"),
            F.substr(href, F.lit(2)).alias("name"),
            F.when(at % 2 == 0, "CSV").otherwise("HTML").alias("format"),
            F.when(at % 3 == 0, F.array(F.lit("en"), F.lit("fr"))).when(at % 3 == 1, F.array(F.lit("den"))).alias("language"),
        )
        document = F.struct(
            F.concat(package_id, F.lit("__d")).alias("id"),
            F.when(at != 1, href).alias("url"),
            F.lit(None).cast("string").alias("name"),
            F.lit("json").alias("format"),
            F.lit(None).cast("array<string>").alias("language"),
        )
        return F.struct(package_id.alias("id"), href.alias("title"), F.array(table, document).alias("resources"))

    reply = F.struct(
        F.lit(True).alias("success"),
        F.struct((F.col("page_id") * 10).alias("count"), F.transform(links, package).alias("results")).alias("result"),
    )
    failed = F.col("url").contains("?")
    return read("pages").select(
        "page_id",
        F.when(failed, 503).otherwise(200).alias("status"),
        F.when(failed, "Service unavailable").otherwise(F.to_json(reply)).alias("body"),
    )


_LINKS = """links AS (SELECT page_id, i - 1 AS pos, hrefs[i] AS href, page_id || ':' || (i - 1) AS package_id FROM (
  SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages WHERE NOT contains(url, '?'))))"""
_NESTED = f"""WITH {_LINKS}, nested AS (
SELECT page_id, pos AS package_pos, package_id, 0 AS resource_pos, package_id || '/t' AS id, href AS url,
  substr(href, 2) AS name, CASE WHEN pos % 2 = 0 THEN 'CSV' ELSE 'HTML' END AS format, pos % 3 <> 1 AS english FROM links
UNION ALL SELECT page_id, pos, package_id, 1, package_id || '__d', CASE WHEN pos <> 1 THEN href END, NULL, 'json', true FROM links) """


@query(
    _NESTED
    + """SELECT page_id, CAST(package_pos AS INTEGER) AS package_pos, package_id,
  CAST(resource_pos AS INTEGER) AS resource_pos, id, url, name, format, english FROM nested"""
)
def q_scan_packages(read, spark):
    found = catalog.explode_resources(catalog.scan_packages(_catalog_pages(read)))
    english = predicates.mentions_language("language", "en", "variant")
    return found.select(
        "page_id", "package_pos", "package_id", "resource_pos", "id", "url", "name", "format", english.alias("english")
    )


def _destination(spark: SparkSession) -> str:
    """A new folder for what a harvest writes, where all executors can."""
    return f"{checkpoint_dir(spark).rstrip('/')}/harvest-{uuid.uuid4().hex}"


def _file_transport(url: str, headers) -> tuple[int, dict[str, str], bytes]:
    """Replies that follow from the url: what ends in an e is gone."""
    if url.endswith("e"):
        return 404, {}, b""
    body = b"a\n1\n"
    return 200, {"Content-Length": str(len(body)), "Content-Type": "text/csv"}, body


@query(
    _NESTED
    + """, work AS (SELECT ends_with(url, 'e') AS gone FROM nested WHERE url <> ''
  UNION ALL SELECT true FROM pages WHERE contains(url, '?'))
SELECT 'r' AS run_name, count(*) FILTER (NOT gone) AS successes, count(*) FILTER (gone) AS errors, count(*) AS total FROM work"""
)
def q_harvest_outcomes(read, spark):
    """A whole catalogue harvest: every usable resource and every failed page has its outcome."""
    settings = CatalogueHarvest(_destination(spark), "r", BASE_URL, fetch_partitions=8)
    return harvest_catalogue(_catalog_pages(read), settings, _file_transport)


def _indicator_transport(url: str, headers) -> tuple[int, dict[str, str], bytes]:
    """Metadata for every indicator; every seventh has no data file."""
    name, kind = url.rsplit("/", 1)[1].split(".")
    if kind == "json":
        return 200, {}, b'{"k": 1}'
    return (404, {}, b"") if int(name[2:]) % 7 == 0 else (200, {}, b"c\n1\n")


@query(
    """SELECT 'DB_' || n AS database_id, CASE WHEN n % 5 = 0 THEN 0 ELSE 2 * k - bad END AS successes,
  CASE WHEN n % 5 = 0 THEN 1 ELSE bad END AS errors, CASE WHEN n % 5 = 0 THEN 1 ELSE 2 * k END AS total
FROM (SELECT c_nationkey AS n, count(*) AS k, count(*) FILTER (c_custkey % 7 = 0) AS bad FROM customer GROUP BY 1)"""
)
def q_indicator_outcomes(read, spark):
    """A whole indicator harvest; the list of every fifth database failed."""
    database = F.concat(F.lit("DB_"), F.col("n_nationkey").cast("string"))
    found = F.collect_list(F.struct(F.struct(database.alias("database_id")).alias("series_description")))
    hits = read("nation").groupBy("n_regionkey").agg(F.to_json(F.struct(found.alias("value"))).alias("body"))
    listed = F.to_json(F.collect_list(F.concat(F.lit("I_"), F.col("c_custkey").cast("string"))))
    lists = read("customer").groupBy("c_nationkey").agg(listed.alias("body")).select(
        F.concat(F.lit("DB_"), F.col("c_nationkey").cast("string")).alias("database_id"),
        F.when(F.col("c_nationkey") % 5 == 0, 500).otherwise(200).alias("status"),
        "body",
    )
    return harvest_indicators(hits, lists, _destination(spark), _indicator_transport, 8)


@query("SELECT page_id, 503 AS status, 'failed to read catalogue page' AS error_text FROM pages WHERE contains(url, '?')")
def q_page_errors(read, spark):
    return catalog.page_errors(_catalog_pages(read))


@query(
    _NESTED
    + """SELECT package_id, count(*) AS num_resources, string_agg(id, '|' ORDER BY resource_pos) AS ids FROM nested
WHERE url <> '' AND lower(format) IN ('csv', 'json') GROUP BY package_id"""
)
def q_filter_packages(read, spark):
    """Nested packages cut to their accepted resources without a shuffle."""
    kept = resources.filter_package_resources(
        catalog.scan_packages(_catalog_pages(read)), predicates.is_csv_or_json
    )
    return kept.select("package_id", "num_resources", F.array_join("resources.id", "|").alias("ids"))


@query(
    """SELECT 'customer' AS origin, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier"""
)
def q_union_pages(read, spark):
    """Two landings with unlike columns as one table."""
    customers = read("customer").select(
        F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = read("supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("origin")
    )
    return catalog.union_pages(customers, suppliers)


@query("SELECT max(page_id * 10) AS total FROM pages WHERE NOT contains(url, '?')")
def q_catalog_total(read, spark):
    return catalog.catalog_total(_catalog_pages(read))


@query(
    """SELECT portal, page_no, 50 + page_no * 100 AS start, least(100, e - (50 + page_no * 100)) AS rows FROM (
  SELECT portal, e, unnest(range(0, CAST(ceil((e - 50) / 100.0) AS BIGINT))) AS page_no FROM (
    SELECT o_orderstatus AS portal, least(count(*), 50 + 3000) AS e FROM orders GROUP BY o_orderstatus) WHERE e > 50)"""
)
def q_page_plan(read, spark):
    totals = read("orders").groupBy(F.col("o_orderstatus").alias("portal")).agg(F.count(F.lit(1)).alias("total"))
    return catalog.catalog_page_plan(totals, start=50, max_packages=3000, batch=100)


@query(
    """SELECT o_orderkey AS id, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_orderkey LIMIT 50 OFFSET 100"""
)
def q_package_search(read, spark):
    packages = read("orders").withColumnRenamed("o_orderkey", "id")
    return catalog.package_search(packages, start=100, rows=50, o_orderstatus="O").select("id", "o_orderpriority")


@query(
    """SELECT o_orderkey AS id, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def q_package_show(read, spark):
    wanted = read("lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    packages = read("orders").withColumnRenamed("o_orderkey", "id")
    return catalog.package_show(packages, wanted).select("id", "o_orderstatus", "o_totalprice")


@query("SELECT o_orderkey AS id FROM orders")
def q_package_list(read, spark):
    return catalog.package_list(read("orders").withColumnRenamed("o_orderkey", "id"))


@query(
    """SELECT id, package_id, name, url FROM fx_resources WHERE format = 'CSV' AND language IN ('en', 'fr')""",
    ("fx_resources",),
)
def q_resource_search(read, spark):
    found = catalog.resource_search(read("fx_resources"), format="CSV", language=["en", "fr"])
    return found.select("id", "package_id", "name", "url")


@query(
    """SELECT id, package_id, format FROM fx_resources WHERE id IN (SELECT id FROM fx_resources WHERE format = 'XLS')""",
    ("fx_resources",),
)
def q_resource_show(read, spark):
    everything = read("fx_resources")
    wanted = everything.where(F.col("format") == "XLS").select("id")
    return catalog.resource_show(everything, wanted).select("id", "package_id", "format")


# --- limits, windows -------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def q_offset_limit(read, spark):
    return positions.limit_packages(read("orders"), 500, 1000, ("o_orderkey",)).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey OFFSET 700")
def q_offset_rest(read, spark):
    return positions.limit_packages(read("orders"), None, 700, ("o_orderkey",)).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def q_top_hits(read, spark):
    ranked = read("orders").withColumn("score", -F.col("o_totalprice"))
    return positions.top_hits(ranked, ("score", "o_orderkey")).select("o_orderkey", "o_totalprice")


@query(
    """SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
FROM events) WHERE rn <= 100"""
)
def q_limit_rows(read, spark):
    return positions.limit_rows(read("events"), ("event_type",), ("event_id",), 100).select("event_id", "event_type")


@query(
    """SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn
FROM events) WHERE rn > 10 AND rn <= 1510"""
)
def q_limit_rows_large(read, spark):
    return positions.limit_rows(read("events"), ("event_type",), ("event_id",), 1500, 10).select("event_id", "event_type")


@query(
    """SELECT event_type, least(count(*), 40) AS kept FROM events GROUP BY event_type"""
)
def q_limit_tied_rows(read, spark):
    """The order ties all rows of a key; each key keeps exactly its limit."""
    tied = positions.limit_rows(read("events"), ("event_type",), ("event_type",), 40)
    return tied.groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"))


@query(
    """SELECT CAST(conv_id AS VARCHAR) AS dataset_id, turn AS row_idx, role, text FROM conversations
WHERE turn >= 1 AND turn < 3"""
)
def q_dataset_rows(read, spark):
    """Two rows from the second on of every dataset, from landed JSON pages."""
    record = F.create_map(F.lit("role"), F.col("role"), F.lit("text"), F.col("text"))
    pages = read("conversations").select(
        F.col("conv_id").cast("string").alias("dataset_id"),
        F.col("turn").alias("offset"),
        F.to_json(F.array(record)).alias("body"),
    )
    rows = datasets.scan_dataset_rows(datasets.parse_record_pages(pages), limit=2, offset=1)
    return rows.select("dataset_id", "row_idx", F.col("record.role").alias("role"), F.col("record.text").alias("text"))


@query(
    """SELECT event_id, user_id, round(value * 2, 4) AS twice FROM events
WHERE event_type IN ('error', 'signup') AND value > 10 ORDER BY event_id LIMIT 400 OFFSET 20"""
)
def q_dataset_query(read, spark):
    return datasets.dataset_query(
        read("events"),
        select=("event_id", "user_id", "round(value * 2, 4) AS twice"),
        where="value > 10",
        order=("event_id",),
        limit=400,
        offset=20,
        event_type=["error", "signup"],
    )


@query(
    """SELECT event_type, user_id, count(*) AS n, max(value) AS highest FROM events WHERE value > 10 GROUP BY event_type, user_id"""
)
def q_dataset_query_grouped(read, spark):
    return datasets.dataset_query(
        read("events"),
        select=("count(*) AS n", "max(value) AS highest"),
        where="value > 10",
        group=("event_type", "user_id"),
    )


@query(
    """SELECT portal, run_name FROM (SELECT *, row_number() OVER (PARTITION BY portal ORDER BY run_name DESC) AS rn
FROM fx_runs) WHERE rn <= 3""",
    ("fx_runs",),
)
def q_keep_newest(read, spark):
    return positions.keep_newest_runs(read("fx_runs"), 3)


@query("SELECT event_id, strftime(ts, '%y%m%d_%H_%M_%S') AS run_name FROM events")
def q_run_name(read, spark):
    return read("events").select("event_id", text.run_name("ts").alias("run_name"))


@query(
    """SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, words[i] AS item FROM (
  SELECT conv_id, turn, words, unnest(range(6, len(words) + 1)) AS i FROM (
    SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations))"""
)
def q_skip_leading(read, spark):
    """The words of every text after its first five, with their position."""
    words = read("conversations").withColumn("words", F.split("text", " "))
    return positions.skip_leading(words, "words", 5, ("conv_id", "turn"))


# --- responses -------------------------------------------------------------


@query(f"SELECT doc_id, url, {_ERROR_TYPE} AS error_type, {_ERROR_TEXT} AS error_text FROM fx_responses", ("fx_responses",))
def q_classify_response(read, spark):
    judged = responses.classify_responses(read("fx_responses"), 2000)
    return judged.select("doc_id", "url", "error_type", "error_text")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(r.status AS DOUBLE) AS status, {_ERROR_TYPE} AS error_type
FROM lineitem LEFT JOIN fx_responses r ON r.doc_id = l_partkey""",
    ("fx_responses",),
)
def q_join_responses(read, spark):
    """A work list in which many rows share a url, met with the landed replies."""
    url = F.concat(F.lit("https://data.example.org/d/"), F.col("l_partkey").cast("string"))
    work = read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", url.alias("url"))
    judged = responses.classify_responses(responses.join_responses(work, read("fx_responses"), ("doc_id",)), 2000)
    return judged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("status").cast("double").alias("status"), "error_type")


@query(
    """SELECT doc_id, coalesce(status = 200 AND content_type <> '' AND content_length <> '', false) AS accepted
FROM fx_responses""",
    ("fx_responses",),
)
def q_accept_response(read, spark):
    return read("fx_responses").select("doc_id", predicates.accept_response().alias("accepted"))


@query(
    """SELECT doc_id, CASE content_type WHEN 'application/zip' THEN 'zip' WHEN 'application/vnd.ms-excel' THEN 'excel'
  WHEN 'application/csv' THEN 'csv' WHEN 'text/csv; charset=utf-8' THEN 'csv' ELSE 'unknown' END AS kind FROM fx_responses""",
    ("fx_responses",),
)
def q_media_kind(read, spark):
    return read("fx_responses").select("doc_id", payload.media_kind("content_type").alias("kind"))


@query(
    f"""SELECT content_type, count(*) FILTER (WHERE e IS NULL) AS successes, count(*) FILTER (WHERE e IS NOT NULL) AS errors,
  count(*) AS total FROM (SELECT content_type, {_ERROR_TYPE} AS e FROM fx_responses) GROUP BY content_type""",
    ("fx_responses",),
)
def q_run_summary(read, spark):
    return responses.run_summary(responses.classify_responses(read("fx_responses"), 2000), "content_type")


@query(
    f"""SELECT error_type, count(*) AS n FROM (SELECT {_ERROR_TYPE} AS error_type FROM fx_responses)
WHERE error_type IS NOT NULL GROUP BY error_type""",
    ("fx_responses",),
)
def q_errors_by_type(read, spark):
    return responses.errors_by_type(responses.classify_responses(read("fx_responses"), 2000))


@query(
    f"""SELECT doc_id, '[TYPE:' || {_ERROR_TYPE} || '][error:' || {_ERROR_TEXT} || '][URL:' || url || ']' AS record
FROM fx_responses WHERE {_ERROR_TYPE} IS NOT NULL""",
    ("fx_responses",),
)
def q_error_records(read, spark):
    failed = responses.collect_errors(responses.classify_responses(read("fx_responses"), 2000))
    return failed.select("doc_id", "record")


@query(
    """SELECT event_id, 'json' AS content_type, '*/*' AS accept, CAST(user_id AS VARCHAR) AS user_name FROM events"""
)
def q_merge_headers(read, spark):
    base = F.create_map(F.lit("accept"), F.lit("*/*"), F.lit("content-type"), F.col("event_type"))
    own = F.create_map(F.lit("content-type"), F.lit("json"), F.lit("user"), F.col("user_id").cast("string"))
    merged = read("events").withColumn("headers", responses.merge_headers(base, own))
    return merged.select(
        "event_id",
        responses.header("headers", "Content-Type").alias("content_type"),
        responses.header("headers", "Accept").alias("accept"),
        responses.header("headers", "User").alias("user_name"),
    )


# --- payloads --------------------------------------------------------------


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'xls' WHEN 2 THEN 'gzip' ELSE 'plain' END AS kind,
  CASE doc_id % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'xls' ELSE 'csv' END AS extension FROM documents"""
)
def q_sniff(read, spark):
    """Payloads made of a signature and a whole text."""
    signature = (
        F.when(F.col("doc_id") % 5 == 0, F.unhex(F.lit(payload.SIGNATURES["zip"])))
        .when(F.col("doc_id") % 5 == 1, F.unhex(F.lit(payload.SIGNATURES["xls"])))
        .when(F.col("doc_id") % 5 == 2, F.unhex(F.lit(payload.SIGNATURES["gzip"])))
        .otherwise(F.encode(F.lit(""), "UTF-8"))
    )
    content = F.concat(signature, F.encode("text", "UTF-8"))
    kind = payload.sniff_kind("content")
    return read("documents").withColumn("content", content).select(
        "doc_id", kind.alias("kind"), payload.detected_extension(kind, F.lit("csv")).alias("extension")
    )


@query(
    """SELECT 'page' AS origin, page_id AS id, true AS is_html, ends_with(url, 'p') AS is_zip FROM pages
UNION ALL SELECT 'document', doc_id, false, source = 'src1' FROM documents"""
)
def q_is_html(read, spark):
    page_url = F.concat("url", F.when(F.endswith("url", F.lit("p")), F.lit(".ZIP")).otherwise(F.lit("")))
    document_url = F.concat(F.lit("f"), F.when(F.col("source") == "src1", F.lit(".zip")).otherwise(F.lit(".csv")))
    html = read("pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("body"), page_url.alias("url"))
    plain = read("documents").select(F.lit("document"), "doc_id", "text", document_url)
    return html.union(plain).select(
        "origin", "id", predicates.is_html_payload("body").alias("is_html"), predicates.is_zip_url("url").alias("is_zip")
    )


def _zip_archive(names: pa.Array, texts: pa.Array) -> pa.Array:
    def pack(name: str, body: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"../{name}.csv", body)
            archive.writestr(f"{name}.txt", "note")
        return buffer.getvalue()

    # One text at a time: all of a batch as Python objects would be several times its bytes.
    return pa.array((pack(n.as_py(), t.as_py()) for n, t in zip(names, texts)), pa.binary(), size=len(names))


def _archives(read) -> DataFrame:
    """Archives made of whole texts; the German ones are no archives."""
    pack = F.arrow_udf(_zip_archive, "binary")
    key = F.col("doc_id").cast("string")
    content = F.when(F.col("lang") == "de", F.encode("text", "UTF-8")).otherwise(pack(key, F.col("text")))
    return spread(read("documents"), "doc_id").select(key.alias("storage_key"), content.alias("content"))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS storage_key, '../' || doc_id || '.csv' AS member, md5(text) AS digest,
  CAST(NULL AS VARCHAR) AS error_text FROM documents WHERE lang <> 'de'
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, 'BadZipFile: File is not a zip file' FROM documents WHERE lang = 'de'"""
)
def q_expand_archive(read, spark):
    """CSV members of the archives."""
    members = payloads.expand_archive(_archives(read), ".csv")
    return members.select("storage_key", "member", F.md5("data").alias("digest"), "error_text")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS storage_key, 'BadZipFile: File is not a zip file' AS error_text
FROM documents WHERE lang = 'de'"""
)
def q_check_archives(read, spark):
    return payloads.check_archives(_archives(read)).select("storage_key", "error_text")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS dataset_id, '../' || doc_id || '.csv' AS member, CAST(0 AS BIGINT) AS row_idx,
  nullif(text, '') AS body FROM documents"""
)
def q_decode_archives(read, spark):
    """Archives with one CSV member that holds a whole text in a quoted cell."""
    pack = F.arrow_udf(_zip_archive, "binary")
    key = F.col("doc_id").cast("string")
    table = F.concat(F.lit('id,body\n1,"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"\n'))
    archives = spread(read("documents"), "doc_id").select(key.alias("dataset_id"), pack(key, table).alias("content"))
    decoded = payloads.decode_archives(archives)
    return decoded.select("dataset_id", "member", "row_idx", F.try_element_at("record", F.lit("body")).alias("body"))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS dataset_id, CAST(0 AS BIGINT) AS row_idx, CAST(user_id AS VARCHAR) AS n, event_type AS kind,
  CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS extra FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 1, '7', 'a,b', 'c', 'extra,"x,y"' FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 2, 'bad', props, NULL, NULL FROM events"""
)
def q_decode_csv(read, spark):
    """One CSV payload per event: a short row, a long row, a quoted cell, a late bad cell."""
    quoted = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))
    table = F.concat_ws(
        "\r\n",
        F.lit("﻿n,kind,note"),
        F.concat_ws(",", F.col("user_id").cast("string"), "event_type"),
        F.lit('7,"a,b",c,extra,"x,y"'),
        F.concat(F.lit("bad,"), quoted, F.lit(",")),
    )
    files = spread(read("events"), "event_id").select(F.col("event_id").alias("dataset_id"), F.encode(table, "UTF-8").alias("content"))
    decoded = payloads.decode_csv(files)
    cells = [F.try_element_at("record", F.lit(c)).alias(c.lstrip("_")) for c in ("n", "kind", "note", "_extra")]
    return decoded.select("dataset_id", "row_idx", *cells)


@query(
    """SELECT 'late' AS dataset_id, 'n' AS name, CASE WHEN count(*) > 0 THEN 'string' END AS type FROM lineitem HAVING count(*) > 0
UNION ALL SELECT 'late', 'm', 'bigint' FROM lineitem HAVING count(*) > 0"""
)
def q_infer_all_rows(read, spark):
    """Types from all rows: the one cell that is no number is the last of the whole table."""
    rows = read("lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("at"), F.col("l_orderkey").cast("string").alias("m"))
    last = rows.agg(F.max("at").alias("at")).withColumn("last", F.lit(True))
    cell = F.when(F.col("last"), "n/a").otherwise(F.col("m"))
    record = F.create_map(F.lit("n"), cell, F.lit("m"), F.col("m"))
    records = rows.join(last, "at", "left").select(F.lit("late").alias("dataset_id"), record.alias("record"))
    return typed.infer_columns(records).select("dataset_id", F.explode("columns").alias("name", "type"))


def _echo_transport(url: str, headers) -> tuple[int, dict[str, str], object]:
    """A transport without a network: the reply follows from the url."""
    number = int(url.rsplit("/", 1)[1])
    if number % 11 == 0:
        return 404, {}, b""
    if number % 11 == 1:
        raise TimeoutError("timed out")
    body = f"payload {number}".encode()
    size = len(body) if number % 11 != 2 else 10**9
    return 200, {"Content-Length": str(size), "Content-Type": "text/csv"}, lambda: body


@query(
    """SELECT url, CAST(CASE WHEN n % 11 = 1 THEN NULL WHEN n % 11 = 0 THEN 404 ELSE 200 END AS DOUBLE) AS status,
  CASE n % 11 WHEN 0 THEN 'HTTPResourceError' WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'TooLargeResourceError' END AS error_type,
  CASE n % 11 WHEN 0 THEN 'Error status 404 with requested URL: ' || url WHEN 1 THEN 'timed out'
    WHEN 2 THEN 'Resource size 1000000000 > max_size 1048576 for URL: ' || url END AS error_text,
  CASE WHEN n % 11 > 2 THEN 'payload ' || n END AS body, n % 11 > 2 AS ok
FROM (SELECT DISTINCT l_partkey AS n, 'https://data.example.org/d/' || l_partkey AS url FROM lineitem)"""
)
def q_fetch(read, spark):
    url = F.concat(F.lit("https://data.example.org/d/"), F.col("l_partkey").cast("string"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fetched = fetch(read("lineitem").select(url.alias("url")), _echo_transport, partitions)
    status = F.col("status").cast("double").alias("status")
    return fetched.select("url", status, "error_type", "error_text", F.decode("content", "UTF-8").alias("body"), "ok")


# --- topic trees -----------------------------------------------------------


@query(
    """SELECT node_id, trim(regexp_extract(label, '<span class="node">(.*?)</span>', 1)) AS name FROM fx_tree_nodes""",
    ("fx_tree_nodes",),
)
def q_span_text(read, spark):
    return read("fx_tree_nodes").select("node_id", text.span_text("label", "node").alias("name"))


@query("SELECT s_suppkey, s_name || chr(CAST(8000 + s_suppkey % 500 AS INTEGER)) || 'é' AS name FROM supplier")
def q_span_nested(read, spark):
    """Labels with a span in the span, inner tags, a leading blank and references by number and by name."""
    number = (8000 + F.col("s_suppkey") % 500).cast("string")
    label = F.concat(
        F.lit('<i><span class="node">&nbsp;<span>'), "s_name", F.lit("</span> <b>&#"), number, F.lit(";</b> &eacute;</span></i><span>z</span>")
    )
    return read("supplier").select("s_suppkey", text.span_text(label, "node").alias("name"))


_LEAVES = """leaves AS (SELECT node_id, mart_id, replace(data_filter, 'docID:', '') AS dataset_id,
  replace(trim(regexp_extract(label, '<span class="node">(.*?)</span>', 1)), '/', '-') || '.csv' AS file_name
  FROM fx_tree_nodes WHERE data_filter <> '')"""


def _leaves(read) -> DataFrame:
    return topics.usable_leaves(read("fx_tree_nodes").withColumn("name", text.span_text("label", "node")))


def _with_leaves(sql: str) -> str:
    return f"WITH fx_tree_nodes AS ({fixtures.VIEWS['fx_tree_nodes']}), {_LEAVES} {sql}"


@query(_with_leaves("SELECT node_id, mart_id, dataset_id, file_name FROM leaves"))
def q_un_leaves(read, spark):
    return _leaves(read).select("node_id", "mart_id", "dataset_id", "file_name")


_CANDIDATES = """SELECT node_id, mart_id, file_name, 0 AS candidate,
  'http://data.un.org/Handlers/DownloadHandler.ashx?DataFilter=' || dataset_id || '&DataMartId=' || mart_id || '&Format=csv' AS url
  FROM leaves UNION ALL SELECT node_id, mart_id, file_name, 1,
  'http://data.un.org/Handlers/DocumentDownloadHandler.ashx?id=' || dataset_id || '&t=bin' FROM leaves"""


@query(
    _with_leaves(
        f"""SELECT node_id, candidate, url, 'http://data.un.org/Handlers/ExplorerHandler.ashx?m=' || mart_id AS mart
FROM ({_CANDIDATES})"""
    )
)
def q_un_candidates(read, spark):
    found = topics.leaf_candidates(_leaves(read))
    return found.select("node_id", "candidate", "url", text.mart_url("mart_id").alias("mart"))


@query(
    _with_leaves(
        f"""SELECT mart_id, file_name, candidate, url FROM (SELECT *, row_number() OVER (
  PARTITION BY mart_id, file_name ORDER BY candidate DESC, node_id DESC) AS rn FROM ({_CANDIDATES})) WHERE rn = 1"""
    )
)
def q_last_writer(read, spark):
    found = topics.leaf_candidates(_leaves(read)).select("mart_id", "file_name", "candidate", "node_id", "url")
    last = positions.last_writer_wins(found, ("mart_id", "file_name"), ("candidate", "node_id"))
    return last.select("mart_id", "file_name", "candidate", "url")


@query(
    """SELECT 'r' || r_regionkey AS node_id, r_name AS title, '' AS path, CAST(1 AS INTEGER) AS depth FROM region
UNION ALL SELECT 'n' || n_nationkey, n_name, r_name, 2 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 's' || s_suppkey, s_name, r_name || '/' || n_name, 3 FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'c' || c_custkey, c_name, r_name || '/' || n_name, 3 FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'o' || o_orderkey, o_orderpriority, r_name || '/' || n_name || '/' || c_name, 4 FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def q_flatten_tree(read, spark):
    flat = tree.flatten_edges(read("fx_tree_edges"))
    return flat.select("node_id", "title", F.array_join("path", "/").alias("path"), "depth")


def _mart_replies(read) -> DataFrame:
    """Mart replies made of whole texts: a folder per line, a leaf per word."""

    def node(label: Column, filter_text: Column, children: Column | None) -> Column:
        html = F.concat(F.lit('<i><span class="node"> '), label, F.lit(" </span></i>"))
        fields = [html.alias("label"), filter_text.alias("dataFilter")]
        none = F.array().cast("array<string>")
        return F.struct(*fields, (none if children is None else children).alias("childNodes"))

    def folder(line: Column, at: Column) -> Column:
        leaves = F.transform(
            F.split(line, " "), lambda word, i: node(word, F.concat(F.lit("docID:"), i.cast("string")), None)
        )
        return node(F.concat(F.lit("line "), at.cast("string")), F.lit(""), leaves)

    nodes = F.to_json(F.transform(F.split("text", "\n"), folder))
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return spread(read("conversations"), "conv_id", "turn").select(
        key.alias("mart_id"), "role", F.concat(F.lit("{Nodes:"), nodes, F.lit("}")).alias("body")
    )


@query(
    """SELECT mart_id, 'line ' || (l - 1) AS path, CAST(2 AS INTEGER) AS depth, words[w] AS name, 'docID:' || (w - 1) AS data_filter
FROM (SELECT mart_id, l, words, unnest(range(1, len(words) + 1)) AS w FROM (
  SELECT mart_id, l, string_split(lines[l], ' ') AS words FROM (
    SELECT mart_id, lines, unnest(range(1, len(lines) + 1)) AS l FROM (
      SELECT conv_id || '-' || turn AS mart_id, string_split(text, chr(10)) AS lines FROM conversations))))"""
)
def q_flatten_nodes(read, spark):
    leaves = topics.scan_mart_leaves(_mart_replies(read))
    return leaves.select("mart_id", F.array_join("path", "/").alias("path"), "depth", "name", "data_filter")


@query(
    """SELECT words[i] AS topic, role AS mart_owner, conv_id || '/' || turn AS mart_name, CAST(i AS VARCHAR) AS mart_id
FROM (SELECT *, unnest(range(6, len(words) + 1)) AS i FROM (
  SELECT conv_id, turn, role, string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS words FROM conversations))"""
)
def q_scan_topics(read, spark):
    """Explorer replies made of whole texts: a topic with one mart per word."""
    mart_name = F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    mart = F.concat(
        F.lit('<span class="martOwner">'), "role", F.lit('</span><span class="martName"> '), mart_name, F.lit("</span>")
    )

    def topic(word: Column, at: Column) -> Column:
        child = F.struct(mart.alias("label"), (at + 1).cast("string").alias("martId"))
        label = F.concat(F.lit('<span class="topic">'), word, F.lit("</span>"))
        return F.struct(label.alias("label"), F.array(child).alias("childNodes"))

    words = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    body = F.concat(F.lit("{Nodes:"), F.to_json(F.transform(words, topic)), F.lit("}"))
    return topics.scan_topics(spread(read("conversations"), "conv_id", "turn").select(body.alias("body")))


@query(
    """SELECT role AS topic, 'mart ' || conv_id || '-' || turn AS mart_name, 'line ' || (l - 1) AS path, words[w] AS name
FROM (SELECT conv_id, turn, role, l, words, unnest(range(1, len(words) + 1)) AS w FROM (
  SELECT conv_id, turn, role, l, string_split(lines[l], ' ') AS words FROM (
    SELECT conv_id, turn, role, lines, unnest(range(1, len(lines) + 1)) AS l FROM (
      SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations))))"""
)
def q_topic_tree(read, spark):
    """Every leaf of every mart with its topic: explorer replies met with mart replies."""
    marts = _mart_replies(read)
    label = F.concat(F.lit('<span class="martOwner">o</span><span class="martName">mart '), "mart_id", F.lit("</span>"))
    mart = F.struct(label.alias("label"), F.col("mart_id").alias("martId"))
    topic_label = F.concat(F.lit('<p><span class="topic"> '), "role", F.lit(" </span></p>"))
    topic = F.struct(topic_label.alias("label"), F.array(mart).alias("childNodes"))
    nodes = F.to_json(F.array_repeat(topic, topics.LEADING_NODES + 1))
    explorer = marts.select(F.concat(F.lit("{Nodes:"), nodes, F.lit("}")).alias("body"))
    leaves = topics.scan_topic_tree(explorer, marts)
    return leaves.select("topic", "mart_name", F.array_join("path", "/").alias("path"), "name")


@query("SELECT doc_id, text AS label FROM documents")
def q_repair_json(read, spark):
    nodes = F.to_json(F.array(F.struct(F.col("text").alias("label"))))
    broken = read("documents").select("doc_id", F.concat(F.lit("{Nodes:"), nodes, F.lit("}")).alias("body"))
    document = F.try_parse_json(text.repair_nodes_json("body"))
    return broken.select("doc_id", F.try_variant_get(document, "$.Nodes[0].label", "string").alias("label"))


@query("SELECT doc_id, text FROM documents")
def q_strip_bom(read, spark):
    return read("documents").select("doc_id", text.strip_bom(F.concat(F.lit("﻿"), "text")).alias("text"))


# --- typed datasets --------------------------------------------------------


_TYPE_CASE = """CASE data_type
  WHEN 'Calendar date' THEN CASE WHEN format_key IS NULL THEN 'timestamp_ntz' WHEN format_key <> 'view' THEN 'date'
    WHEN format_value IN ('date_ymd', 'date_y') THEN 'timestamp_ntz' ELSE 'invalid' END
  WHEN 'Number' THEN CASE WHEN format_key IS NULL THEN 'float' WHEN format_key <> 'noCommas' THEN 'int'
    WHEN format_value = 'true' THEN 'int' WHEN format_value = 'false' THEN 'float' ELSE 'string' END
  ELSE 'string' END"""


def _entries(read) -> DataFrame:
    fmt = F.when(F.col("format_key").isNotNull(), F.create_map("format_key", "format_value"))
    return read("fx_entries").select(
        "dataset_id",
        F.array(F.lit("main"), F.lit("note"), F.lit("extra")).alias("columns_field_name"),
        F.array("data_type", F.lit("text")).alias("columns_datatype"),
        F.array(fmt, F.lit(None), F.lit(None)).alias("columns_format"),
    )


@query(
    f"""SELECT dataset_id, 'main' AS name, {_TYPE_CASE} AS type FROM fx_entries
UNION ALL SELECT dataset_id, 'note', 'string' FROM fx_entries""",
    ("fx_entries",),
)
def q_type_map(read, spark):
    zipped = types.zip_columns("columns_field_name", "columns_datatype", "columns_format")
    return _entries(read).select("dataset_id", F.inline(zipped)).select(
        "dataset_id", "name", types.spark_type_of("data_type", "format").alias("type")
    )


@query(
    f"""SELECT dataset_id, t = 'invalid' AS type_error, CASE WHEN t = 'invalid' THEN 'string,string' ELSE t || ',string' END AS types
FROM (SELECT dataset_id, {_TYPE_CASE} AS t FROM fx_entries)""",
    ("fx_entries",),
)
def q_declared_columns(read, spark):
    """Declared schema per dataset; all strings where a declaration is not understood."""
    declared = typed.declared_columns(_entries(read))
    return declared.select("dataset_id", "type_error", F.array_join("columns.type", ",").alias("types"))


@query(
    """SELECT event_id, CAST(TRY_CAST(int_cell AS INTEGER) AS DOUBLE) AS int_value,
  CAST(TRY_CAST(num_cell AS FLOAT) AS DOUBLE) AS num_value, CAST(TRY_CAST(ymd_cell AS TIMESTAMP) AS TIMESTAMP) AS ymd_value,
  strptime(my_cell, '%Y-%m') AS my_value, strptime(y_cell, '%Y') AS y_value FROM fx_cells""",
    ("fx_cells",),
)
def q_cast_cells(read, spark):
    return read("fx_cells").select(
        "event_id",
        types.cast_number("int_cell", "int").cast("double").alias("int_value"),
        types.cast_number("num_cell", "float").cast("double").alias("num_value"),
        types.cast_datetime("ymd_cell", "yyyy-MM-dd").alias("ymd_value"),
        types.cast_datetime("my_cell", "yyyy-MM").alias("my_value"),
        types.cast_datetime("y_cell", "yyyy").alias("y_value"),
    )


_CELL_COLUMNS = ("int_cell", "num_cell", "ymd_cell", "my_cell", "y_cell")


def _records(read) -> DataFrame:
    """The cells as dataset rows: one dataset per kind, everything a string."""
    pairs = [x for c in _CELL_COLUMNS for x in (F.lit(c), F.col(c))]
    return read("fx_cells").select(
        F.col("kind").alias("dataset_id"), F.col("event_id").alias("row_idx"), F.create_map(*pairs).alias("record")
    )


_TYPED_CELL = """SELECT kind AS dataset_id, event_id AS row_idx, '{0}' AS name, '{1}' AS type, {2} AS text_value,
  {3} AS number_value, {4} AS timestamp_value FROM fx_cells"""
_NO_TEXT, _NO_NUMBER, _NO_TIME = "CAST(NULL AS VARCHAR)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS TIMESTAMP)"


@query(
    " UNION ALL ".join(
        [
            _TYPED_CELL.format("int_cell", "int", _NO_TEXT, "CAST(TRY_CAST(int_cell AS INTEGER) AS DOUBLE)", _NO_TIME),
            _TYPED_CELL.format("num_cell", "float", _NO_TEXT, "CAST(TRY_CAST(num_cell AS FLOAT) AS DOUBLE)", _NO_TIME),
            _TYPED_CELL.format("ymd_cell", "timestamp_ntz", _NO_TEXT, _NO_NUMBER, "TRY_CAST(ymd_cell AS TIMESTAMP)"),
            _TYPED_CELL.format("my_cell", "timestamp_ntz", _NO_TEXT, _NO_NUMBER, "strptime(my_cell, '%Y-%m')"),
            _TYPED_CELL.format("y_cell", "string", "y_cell", _NO_NUMBER, _NO_TIME),
        ]
    ),
    ("fx_cells",),
)
def q_cast_by_metadata(read, spark):
    """Every cell of every dataset cast by the entry of its dataset."""
    cells = typed.typed_cells(_records(read), _cell_entries(read))
    number = F.coalesce(F.col("int_value").cast("double"), F.col("float_value").cast("double"))
    return cells.select("dataset_id", "row_idx", "name", "type", "text_value", number.alias("number_value"), "timestamp_value")


def _cell_entries(read) -> DataFrame:
    """A catalogue entry for every kind of event."""
    no_format = F.lit(None).cast("map<string,string>")

    def view(name: str) -> Column:
        return F.create_map(F.lit("view"), F.lit(name))

    formats = (F.create_map(F.lit("noCommas"), F.lit("true")), no_format, view("date_ymd"), view("date_my"), no_format)
    types_ = ("number", "Number", "calendar date", "calendar date", "text")
    return (
        read("fx_cells")
        .select(F.col("kind").alias("dataset_id"))
        .distinct()
        .select(
            "dataset_id",
            F.array(*[F.lit(c) for c in _CELL_COLUMNS]).alias("columns_field_name"),
            F.array(*[F.lit(t) for t in types_]).alias("columns_datatype"),
            F.array(*formats).alias("columns_format"),
        )
    )


@query(
    """SELECT kind AS dataset_id, event_id AS row_idx, CAST(TRY_CAST(int_cell AS INTEGER) AS DOUBLE) AS int_cell,
  CAST(TRY_CAST(num_cell AS FLOAT) AS DOUBLE) AS num_cell, TRY_CAST(ymd_cell AS TIMESTAMP) AS ymd_cell,
  strptime(my_cell, '%Y-%m') AS my_cell, y_cell FROM fx_cells""",
    ("fx_cells",),
)
def q_typed_records(read, spark):
    """Every row of every dataset cast by the entry of its dataset, one row each."""
    rows = typed.typed_records(_records(read), _cell_entries(read))
    kinds = dict(zip(_CELL_COLUMNS, ("double", "double", "timestamp_ntz", "timestamp_ntz", "string")))
    fields = [F.try_variant_get("record", f"$.{name}", kind).alias(name) for name, kind in kinds.items()]
    return rows.select("dataset_id", "row_idx", *fields)


@query(
    """SELECT CAST(TRY_CAST(int_cell AS INTEGER) AS DOUBLE) AS int_cell, TRY_CAST(ymd_cell AS TIMESTAMP) AS ymd_cell, y_cell
FROM fx_cells""",
    ("fx_cells",),
)
def q_records_to_df(read, spark):
    schema = types.schema_from_metadata(
        ["int_cell", "ymd_cell", "y_cell"],
        ["number", "calendar date", "text"],
        [{"noCommas": "true"}, {"view": "date_ymd"}, None],
    )
    frame = typed.records_to_df(_records(read), schema)
    return frame.withColumn("int_cell", F.col("int_cell").cast("double"))


_ALL_INT = "coalesce(bool_and(CASE WHEN {0} <> '' THEN regexp_full_match({0}, '[+-]?\\d+') END), false)"


@query(
    " UNION ALL ".join(
        f"SELECT kind AS dataset_id, '{c}' AS name, CASE WHEN {_ALL_INT.format(c)} THEN 'bigint' ELSE 'string' END AS type "
        "FROM fx_cells GROUP BY kind"
        for c in _CELL_COLUMNS
    ),
    ("fx_cells",),
)
def q_infer_columns(read, spark):
    """Column types all rows of each dataset allow."""
    found = typed.infer_columns(_records(read))
    return found.select("dataset_id", F.explode("columns").alias("name", "type"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS dataset_id FROM customer ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 300 OFFSET 20")
def q_dataset_catalog(read, spark):
    """Catalogue entries parsed from JSON, a window of them in id order."""
    entry = F.struct(
        F.struct(
            F.col("c_custkey").cast("string").alias("id"),
            F.array(F.lit("name")).alias("columns_field_name"),
            F.array(F.lit("text")).alias("columns_datatype"),
            F.array(F.create_map(F.lit("align"), F.lit("left"))).alias("columns_format"),
        ).alias("resource")
    )
    entries = datasets.parse_entries(read("customer").select(F.to_json(entry).alias("body")))
    return datasets.scan_dataset_catalog(entries, 300, 20).select("dataset_id")


@query(
    """SELECT kind AS dataset_id, count(*) AS n_rows, false AS type_error, count(*) FILTER (event_id % 997 = 5) = 0 AS ok,
  CASE WHEN count(*) FILTER (event_id % 997 = 5) > 0 THEN '[DATASET:' || kind || '][ERROR:' || count(*) FILTER (event_id % 997 = 5)
    || ' requests failed, status 500][TYPE:HTTPResourceError]' END AS error_record FROM fx_cells GROUP BY kind""",
    ("fx_cells",),
)
def q_dataset_outcomes(read, spark):
    """A whole dataset harvest to JSON: cast records, failed requests, and outcomes read back from the run log."""
    settings = DatasetHarvest(_destination(spark), cast_datatypes=True, fmt="json", run_name="r")
    failed = read("fx_cells").where("event_id % 997 = 5")
    failures = failed.select(F.col("kind").alias("dataset_id"), F.col("event_id").alias("offset"), F.lit("u").alias("url"), F.lit(500).alias("status"))
    harvest_datasets(_cell_entries(read), _records(read), settings, failures)
    return spark.read.parquet(f"{settings.destination}/runs").drop("run_name")


_STRIPE = 4096


@query(
    f"""SELECT dataset_id, kind, greatest(a, k * {_STRIPE}) AS start, least(b, (k + 1) * {_STRIPE}) AS stop FROM (
  SELECT dataset_id, CASE WHEN start > reach THEN 'gap' ELSE 'overlap' END AS kind, least(start, reach) AS a,
    CASE WHEN start > reach THEN start ELSE least(stop, reach) END AS b, least(start, reach) // {_STRIPE} AS low
  FROM (SELECT *, coalesce(max(stop) OVER (PARTITION BY dataset_id ORDER BY start, stop
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM (
    SELECT DISTINCT dataset_id, page_offset AS start, page_offset + page_rows AS stop FROM fx_row_pages)))
  f(dataset_id, kind, a0, b, low0), LATERAL (SELECT a0) l(a), LATERAL (SELECT unnest(range(a // {_STRIPE}, (b - 1) // {_STRIPE} + 1)) AS k)
WHERE b > a""",
    ("fx_row_pages",),
)
def q_row_coverage(read, spark):
    """Gaps and overlaps of the pages of every dataset; few datasets hold all pages."""
    pages = read("fx_row_pages").select("dataset_id", F.col("page_offset").alias("offset"), F.col("page_rows").alias("rows"))
    return coverage.row_coverage(pages, stripe=_STRIPE)


@query(
    """SELECT event_type, n, highest FROM (SELECT event_type, count(*) AS n, max(value) AS highest FROM fx_places
  WHERE value > 10 AND lat BETWEEN -40 AND 60 AND (lon >= 100 OR lon <= -100) AND event_type <> 'view' GROUP BY event_type HAVING count(*) > 5)""",
    ("fx_places",),
)
def q_portal_query(read, spark):
    """A row query in the portal's own parameters, with an area across the date line."""
    return datasets.portal_query(
        read("fx_places"),
        {
            "$select": "event_type, count(*) AS n, max(value) AS highest",
            "$where": "value > 10 AND within_box(lat, lon, 60, 100, -40, -100) AND event_type <> 'view'",
            "$group": "event_type",
            "$having": "count(*) > 5",
        },
    )


@query(
    """SELECT c_custkey, event_id FROM fx_circles JOIN fx_places ON abs(lat - center_lat) <= 5 AND 2 * 6371008.8e0 * asin(least(1.0e0, sqrt(
  pow(sin(radians(center_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(center_lat)) * pow(sin(radians(center_lon - lon) / 2), 2)))) <= radius""",
    ("fx_places", "fx_circles"),
)
def q_within_circle(read, spark):
    """Every place in every circle, met by grid cell."""
    return spatial.match_circles(read("fx_places"), read("fx_circles"), 200_000.0).select("c_custkey", "event_id")


_PACKAGE_WORDS = """SELECT CAST(l_orderkey AS VARCHAR) AS id, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[\\p{L}\\p{N}]+')) AS term
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _order_packages(read) -> DataFrame:
    """Orders as packages whose text are the names of their parts, in any order."""
    named = read("lineitem").join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
    named = named.select(F.col("l_orderkey").cast("string").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return named.groupBy("id").agg(F.array_join(F.collect_list("name"), " ").alias("notes"))


@query(
    f"""WITH word AS ({_PACKAGE_WORDS}), size AS (SELECT id, count(*) AS size FROM word GROUP BY id),
  total AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(size) AS mean FROM size),
  tf AS (SELECT id, term, count(*) AS tf FROM word GROUP BY ALL),
  idf AS (SELECT term, ln(1 + (any_value(n) - count(*) + 0.5e0) / (count(*) + 0.5e0)) AS idf FROM tf, total GROUP BY term),
  asked AS (SELECT DISTINCT p_partkey AS search_id, unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) AS term FROM part WHERE p_size = 7),
  scored AS (SELECT search_id, id, CAST(sum(CAST(floor(1000000 * idf * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * size / mean))) AS BIGINT)) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN idf USING (term) JOIN size USING (id), total GROUP BY ALL)
SELECT search_id, CAST(place AS INTEGER) AS rank, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY search_id ORDER BY score DESC, id) AS place FROM scored) WHERE place BETWEEN 3 AND 12"""
)
def q_search_ranked(read, spark):
    """Free-text package search: the second page of ten for the names of all parts of one size."""
    index = materialize(search.postings(_order_packages(read), "notes"))
    searches = read("part").where("p_size = 7").select(F.col("p_partkey").alias("search_id"), F.col("p_name").alias("q"))
    return search.search_ranked(index, searches, rows=10, start=2)


@query(
    """SELECT facet, value, count(*) AS n FROM (
  SELECT 'organization' AS facet, p_brand AS value FROM part
  UNION ALL SELECT 'size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT 'tags', unnest(list_distinct(string_split(p_name || ' ' || lower(p_type) || ' ' || p_name, ' '))) FROM part)
WHERE value <> '' GROUP BY ALL"""
)
def q_facets(read, spark):
    """Packages by organisation, size and tags, counted in one pass."""
    tags = F.split(F.concat_ws(" ", "p_name", F.lower("p_type"), "p_name"), " ")
    return search.facets(read("part"), {"organization": F.col("p_brand"), "size": F.col("p_size"), "tags": tags})


@query(
    """SELECT event_id, CAST(CASE WHEN a > 31 THEN make_date(a, b, c) WHEN a IS NULL THEN NULL
  WHEN (day_first AND b <= 12) OR a > 12 THEN make_date(c, b, a) ELSE make_date(c, a, b) END AS TIMESTAMP) AS cast_value
FROM (SELECT *, coalesce(bool_or(a <= 31 AND a > 12) OVER (PARTITION BY kind), false)
    AND NOT coalesce(bool_or(a <= 12 AND b > 12) OVER (PARTITION BY kind), false) AS day_first
  FROM (SELECT event_id, kind, TRY_CAST(parts[1] AS INTEGER) AS a, TRY_CAST(parts[2] AS INTEGER) AS b, TRY_CAST(parts[3] AS INTEGER) AS c
    FROM (SELECT event_id, kind, string_split_regex(trim(cell), '[^0-9]') AS parts FROM fx_mixed_dates)))""",
    ("fx_mixed_dates",),
)
def q_cast_mixed(read, spark):
    """Dates whose column decides the order of day and month."""
    return dates.cast_mixed_columns(read("fx_mixed_dates"), ("kind",), "cell", "cast_value").select("event_id", "cast_value")


# --- indicators ------------------------------------------------------------


@query("SELECT DISTINCT database_id FROM fx_search_hits WHERE database_id <> ''", ("fx_search_hits",))
def q_distinct_databases(read, spark):
    """Database ids folded from search replies."""
    hit = F.struct(F.struct("database_id").alias("series_description"))
    body = F.to_json(F.struct(F.array(hit, hit).alias("value")))
    return indicators.scan_database_ids(read("fx_search_hits").select(body.alias("body")))


@query(
    """SELECT database_id, indicator_id, kind, 'https://data360files.worldbank.org/data360-data/' || kind || '/' || database_id
  || '/' || indicator_id || CASE kind WHEN 'metadata' THEN '.json' ELSE '.csv' END AS url,
  kind || '/' || database_id || '/' || indicator_id || CASE kind WHEN 'metadata' THEN '.json' ELSE '.csv' END AS path
FROM (SELECT database_id, unnest(['C' || o_custkey, 'O' || o_orderkey]) AS indicator_id FROM (
    SELECT 'DB_' || o_orderpriority AS database_id, o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'F'))
  JOIN (VALUES ('metadata'), ('data')) k(kind) ON true
WHERE database_id IN (SELECT database_id FROM fx_search_hits WHERE database_id <> '')""",
    ("fx_search_hits",),
)
def q_indicator_plan(read, spark):
    wanted = indicators.distinct_databases(read("fx_search_hits"))
    listed = indicators.scan_indicators(read("fx_indicator_pages"))
    return indicators.indicator_resources(indicators.expand_databases(listed, wanted))


@query("SELECT 'DB_' || o_orderpriority AS database_id, 500 AS status FROM orders WHERE o_orderstatus = 'F'")
def q_indicator_errors(read, spark):
    return indicators.list_errors(read("fx_indicator_pages"))


@query("SELECT doc_id, text AS description FROM documents")
def q_clean_metadata(read, spark):
    """Metadata documents with a BOM, parsed and written again."""
    body = F.concat(F.lit("﻿"), F.to_json(F.struct(F.col("text").alias("description"))))
    clean = indicators.clean_metadata(read("documents").select("doc_id", body.alias("body")))
    return clean.select("doc_id", F.get_json_object("body", "$.description").alias("description"))


# --- trees with cycles, changing catalogues, lanes, nested records, resumed runs ---------------


@query(
    """, customers AS (SELECT *, k % 10 AS i, 'c' || lpad(CAST(k AS VARCHAR), 9, '0') AS node_id, 'c' || lpad(CAST(g * 10 AS VARCHAR), 9, '0') AS head
  FROM (SELECT c_custkey AS k, CAST(floor(c_custkey / 10) AS BIGINT) AS g FROM customer)),
placed AS (SELECT k, node_id, CASE WHEN g % 3 <> 1 THEN 'tree' WHEN i <= g % 4 THEN 'cycle' ELSE 'below' END AS kind,
  CASE g % 3 WHEN 0 THEN i + 1 WHEN 2 THEN CASE WHEN i = 0 THEN 1 ELSE 2 END END AS depth,
  CASE WHEN g % 3 = 1 THEN head END AS cycle_id, CASE WHEN g % 3 = 1 THEN g % 4 + 1 END AS cycle_size FROM customers)
SELECT node_id, kind, CAST(depth AS BIGINT) AS depth, cycle_id, CAST(cycle_size AS BIGINT) AS cycle_size FROM placed
UNION ALL SELECT 'o' || o_orderkey, CASE kind WHEN 'cycle' THEN 'below' ELSE kind END, CAST(depth + 1 AS BIGINT), cycle_id, CAST(cycle_size AS BIGINT)
FROM orders JOIN placed ON o_custkey = k""",
    ("fx_linked_edges",),
)
def q_tree_cycles(read, spark):
    """Every node of an edge list with cycles: its depth, or the cycle that it leads into."""
    flat, stuck = tree.split_edges(read("fx_linked_edges"))
    none = F.lit(None)
    whole = flat.select(
        "node_id", F.lit("tree").alias("kind"), F.col("depth").cast("bigint").alias("depth"), none.cast("string").alias("cycle_id"), none.cast("bigint").alias("cycle_size")
    )
    found = stuck.select("node_id", "kind", none.cast("bigint").alias("depth"), "cycle_id", "cycle_size")
    return whole.unionByName(found)


_SEEN_AFTER = """, after AS (SELECT id, arg_max(title, page_no) AS title, arg_max(struct_pack(o := owner), page_no).o AS owner, count(*) AS copies
  FROM fx_harvest_after GROUP BY id)"""


@query(
    _SEEN_AFTER
    + """SELECT * FROM (SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed'
  WHEN a.title <> b.title OR a.owner IS DISTINCT FROM b.owner THEN 'changed' END AS change
FROM after a FULL JOIN fx_harvest_before b ON a.id = b.id) WHERE change IS NOT NULL""",
    ("fx_harvest_before", "fx_harvest_after"),
)
def q_catalog_diff(read, spark):
    """What two harvests of a catalogue differ in, the second one read from pages that drifted."""
    content = ("title", "owner")
    before, after = (snapshots.snapshot(read(f"fx_harvest_{when}"), content, ("page_no",)) for when in ("before", "after"))
    return snapshots.snapshot_diff(before, after).select("id", "change")


@query(
    """SELECT o_orderpriority AS portal, count(*) AS total, count(*) FILTER (o_orderkey % 10 <> 7) + count(*) FILTER (o_orderkey % 25 = 0) AS seen,
  count(*) FILTER (o_orderkey % 10 <> 7 OR o_orderkey % 25 = 0) AS packages, count(*) FILTER (o_orderkey % 10 <> 7 AND o_orderkey % 25 = 0) AS repeated,
  count(*) FILTER (o_orderkey % 10 = 7 AND o_orderkey % 25 <> 0) AS missing FROM orders GROUP BY o_orderpriority"""
)
def q_page_drift(read, spark):
    """How far the pages of each portal drifted while they were read."""
    totals = read("orders").groupBy(F.col("o_orderpriority").alias("portal")).agg(F.count(F.lit(1)).alias("total"))
    return snapshots.page_drift(read("fx_harvest_after"), totals)


@query(
    f"""SELECT count(*) AS urls, CAST(sum({lanes.OVERHEAD} + CASE WHEN {_LENGTH} >= 0 THEN {_LENGTH} ELSE {lanes.UNKNOWN_SIZE} END) AS BIGINT) AS weight,
  CAST(8 AS BIGINT) AS used, true AS balanced, count(*) FILTER (doc_id % 11 > 2) AS fetched FROM fx_responses""",
    ("fx_responses",),
)
def q_fetch_lanes(read, spark):
    """Requests dealt into eight lanes by expected size: the fullest within 4/3 of the mean, and every one of them fetched."""
    work = read("fx_responses").select("url", "content_length")
    weighed = work.select("url", lanes.expected_weight("content_length").alias("weight"))
    filled = lanes.deal_lanes(weighed, 8).groupBy("lane").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    dealt = filled.agg(
        F.sum("n").alias("urls"),
        F.sum("weight").alias("weight"),
        F.count(F.lit(1)).alias("used"),
        (3 * F.max("weight") * F.count(F.lit(1)) <= 4 * F.sum("weight")).alias("balanced"),
    )
    fetched = fetch(work, _echo_transport, 8, sizes="content_length").agg(F.count_if("ok").alias("fetched"))
    # One row each, brought together as one.
    both = dealt.unionByName(fetched, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def _nested_records(read) -> DataFrame:
    """Events as nested JSON records whose fields differ from row to row."""
    record = F.struct(
        F.col("event_id").alias("z_id"),
        F.col("value").alias("amount"),
        F.when(F.col("event_id") % 2 == 0, F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))).alias("who"),
        F.array(F.col("event_id") % 3, F.col("event_id") % 5).alias("marks"),
        (F.col("user_id") % 2 == 0).alias("even"),
        F.when(F.col("event_id") % 7 == 0, F.col("event_type")).otherwise(F.lit(None)).alias("late"),
    )
    # A field that is a number in some rows and a text in others.
    mixed = F.when(F.col("event_id") % 4 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    text = F.concat(F.regexp_replace(F.to_json(record), r"\}$", ',"any":'), mixed, F.lit("}"))
    return read("events").select(F.col("event_type").alias("dataset_id"), "event_id", text.alias("record"))


@query(
    """SELECT event_id AS z_id, value AS amount, CASE WHEN event_id % 2 = 0 THEN user_id END AS who_user, CASE WHEN event_id % 2 = 0 THEN event_type END AS who_type,
  (event_id % 3 || '/' || event_id % 5) AS marks, user_id % 2 = 0 AS even, CASE WHEN event_id % 7 = 0 THEN event_type END AS late,
  CASE WHEN event_id % 4 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS "any" FROM events"""
)
def q_infer_nested(read, spark):
    """Nested records as columns of the types that all rows allow."""
    frame = nested.nested_frame(_nested_records(read))
    marks = F.array_join(F.col("marks").cast("array<string>"), "/")
    return frame.select("z_id", "amount", F.col("who.user").alias("who_user"), F.col("who.type").alias("who_type"), marks.alias("marks"), "even", "late", "any")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'first' ELSE 'second' END AS run_name, o_orderstatus <> 'F' AS ok FROM orders")
def q_resume(read, spark):
    """A run that is killed between staging and publishing its third part, and the next one, which takes up the rest."""
    work, destination = read("orders").select("o_orderkey", "o_orderstatus"), _destination(spark)

    def kill(part: int) -> None:
        if part == 2:
            raise InterruptedError("killed")

    def run(name: str, before_publish: Callable[[int], None] | None) -> DataFrame:
        def step(rows: DataFrame) -> DataFrame:
            return rows.select("o_orderkey", F.lit(name).alias("run_name"), (F.col("o_orderstatus") != "F").alias("ok"))

        schema = "o_orderkey bigint, run_name string, ok boolean"
        return run_in_parts(work, step, destination, name, schema, 4, "o_orderkey", F.col("o_orderkey") % 4, before_publish)

    try:
        run("first", kill)
    except InterruptedError:
        pass
    return run("second", None)
