"""Topic portals: from explorer and mart replies to decoded tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import predicates as P
from gleanspark.functions.payload import media_kind
from gleanspark.operators.positions import last_writer_wins
from gleanspark.operators.responses import run_summary
from gleanspark.session import PAYLOAD_OPTIONS, materialize, small_batches
from gleanspark.sinks import store_topic_tables
from gleanspark.sources.fetch import Transport, fetch
from gleanspark.sources.payloads import check_archives, decode_archives, decode_csv
from gleanspark.sources.topics import leaf_candidates, reply_errors, scan_topic_tree, scan_topics, usable_leaves

# Outcomes of replies that cannot become a table.
NOT_ACCEPTED = "not_accepted"
UNSUPPORTED = "unsupported_excel"
UNKNOWN_TYPE = "unknown_content_type"
BAD_ARCHIVE = "BadArchive"
# Outcome of an explorer or mart reply that holds no nodes.
UNREADABLE_REPLY = "unreadable_reply"

#: No size rule applies to topic payloads; this is the largest binary cell.
MAX_PAYLOAD = 2**31 - 1


def harvest_topics(
    explorer: DataFrame,
    marts: DataFrame,
    destination: str,
    transport: Transport,
    fetch_partitions: int = 200,
    request_headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fetch and store the table behind every leaf; gives ``(topic, successes, errors, total)``.

    Both candidate urls of a leaf are tried and the later usable reply wins.
    Tables go to ``tables``, the outcome of every candidate to ``runs``; Excel
    and unknown payloads are errors of their candidate. An explorer or mart reply
    that cannot be read is an error row of its own, and counts in the summary.
    """
    leaves = materialize(usable_leaves(scan_topic_tree(explorer, marts)))
    candidates = leaf_candidates(leaves)
    fetched = fetch(candidates, transport, fetch_partitions, request_headers, MAX_PAYLOAD)
    replies = materialize(fetched, PAYLOAD_OPTIONS)
    accepted = replies.where(F.col("ok") & P.accept_response()).select(
        "url", media_kind("content_type").alias("kind"), "content"
    )
    with small_batches(explorer.sparkSession):
        broken = materialize(check_archives(accepted.where(F.col("kind") == "zip"), "url"))
    verdicts = _verdicts(replies, broken)

    # Urls and keys only up to here; the tables join below, by their winner.
    place = ("topic", "mart_name", "path", "file_name")
    judged = candidates.join(verdicts, "url", "left").select(
        *place, "candidate", "url", "status", F.coalesce("error_type", F.lit("")).alias("error_type"), "error_text"
    )
    lost = _lost_replies(explorer, marts)
    judged = judged.unionByName(lost, allowMissingColumns=True)
    judged.write.mode("overwrite").parquet(f"{destination}/runs")
    judged = explorer.sparkSession.read.schema(judged.schema).parquet(f"{destination}/runs")
    usable = judged.where(F.col("error_type") == "").select(*place, "candidate", "url")
    winners = materialize(last_writer_wins(usable, place, ("candidate", "url")))
    wanted = accepted.join(winners.select("url").distinct(), "url", "left_semi")
    plain = decode_csv(wanted.where(F.col("kind") == "csv"), "url").withColumn("member", F.lit(None).cast("string"))
    unpacked = decode_archives(wanted.where(F.col("kind") == "zip"), None, "url")
    # Broken archives have their verdict already.
    unpacked = unpacked.where(F.col("error_text").isNull()).drop("error_text")
    with small_batches(explorer.sparkSession):
        rows = materialize(plain.unionByName(unpacked).withColumnRenamed("dataset_id", "url"))
    store_topic_tables(rows.join(winners.select(*place, "url"), "url"), f"{destination}/tables")
    stored = winners.select(*place).withColumn("_stored", F.lit(True))
    outcomes = leaves.select(*place).join(stored, list(place), "left")
    outcomes = outcomes.select("topic", F.col("_stored").isNotNull().alias("ok"))
    return run_summary(outcomes.unionByName(lost.select("topic", F.lit(False).alias("ok"))), "topic")


def _lost_replies(explorer: DataFrame, marts: DataFrame) -> DataFrame:
    """``(topic, mart_name, error_type, error_text)`` for the replies that give no leaves; no topic for an explorer reply."""
    named = scan_topics(explorer).select("mart_id", "topic", "mart_name")
    of_marts = reply_errors(marts).select("mart_id").join(named, "mart_id", "left")
    of_marts = of_marts.withColumn("error_text", F.concat(F.lit("no nodes in the reply of mart "), "mart_id"))
    text = F.lit("no nodes in the explorer reply").alias("error_text")
    none = F.lit(None).cast("string")
    of_explorer = reply_errors(explorer).select(none.alias("topic"), none.alias("mart_name"), text)
    lost = of_explorer.unionByName(of_marts.drop("mart_id"))
    return lost.withColumn("error_type", F.lit(UNREADABLE_REPLY))


def _verdicts(replies: DataFrame, broken: DataFrame) -> DataFrame:
    """``(url, status, error_type, error_text)``; no error type where the reply can be decoded."""
    kind = media_kind("content_type")
    problem = (
        F.when(~F.col("ok"), F.col("error_type"))
        .when(~P.accept_response(), NOT_ACCEPTED)
        .when(kind == "excel", UNSUPPORTED)
        .when(kind == "unknown", UNKNOWN_TYPE)
        .when(F.col("_damage").isNotNull(), BAD_ARCHIVE)
    )
    text = F.coalesce("error_text", "_damage", F.concat(F.lit("Content-Type: "), "content_type"))
    damaged = broken.select("url", F.col("error_text").alias("_damage"))
    marked = replies.drop("content").join(damaged, "url", "left")
    return marked.withColumn("_problem", problem).select(
        "url", "status", F.col("_problem").alias("error_type"), F.when(F.col("_problem").isNotNull(), text).alias("error_text")
    )
