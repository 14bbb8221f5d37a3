"""Topic portals: the explorer reply, data marts and their trees of leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import predicates as P
from gleanspark.functions import text
from gleanspark.operators.positions import skip_leading
from gleanspark.operators.tree import flatten_nodes
from gleanspark.operators.unnest import unnest

#: Fixed value: top-level explorer nodes that are not topics.
LEADING_NODES = 5


def _nodes(replies: DataFrame) -> DataFrame:
    document = F.try_parse_json(text.repair_nodes_json("body"))
    return replies.withColumn("_nodes", F.try_variant_get(document, "$.Nodes", "array<variant>"))


def reply_errors(replies: DataFrame) -> DataFrame:
    """Replies that hold no node list even after repair."""
    return _nodes(replies).where(F.col("_nodes").isNull()).drop("_nodes", "body")


def scan_topics(explorer: DataFrame, leading: int = LEADING_NODES) -> DataFrame:
    """``(topic, mart_owner, mart_name, mart_id)`` from explorer replies in ``body``."""
    nodes = skip_leading(_nodes(explorer), "_nodes", leading).withColumnRenamed("item", "node")

    def label(node: str, css_class: str):
        return text.span_text(F.try_variant_get(F.col(node), "$.label", "string"), css_class)

    marts = F.try_variant_get("node", "$.childNodes", "array<variant>")
    return unnest(nodes.withColumn("topic", label("node", "topic")), marts, "child", ("topic",)).select(
        "topic",
        label("child", "martOwner").alias("mart_owner"),
        label("child", "martName").alias("mart_name"),
        F.try_variant_get("child", "$.martId", "string").alias("mart_id"),
    )


def scan_mart_leaves(marts: DataFrame) -> DataFrame:
    """``(mart_id, name, path, depth, data_filter)`` from mart replies ``(mart_id, body)``."""
    nodes = unnest(_nodes(marts), "_nodes", "node", ("mart_id",))
    return flatten_nodes(nodes)


def scan_topic_tree(explorer: DataFrame, marts: DataFrame, leading: int = LEADING_NODES) -> DataFrame:
    """Every leaf with its topic and mart; one mart may hold most of the leaves.

    The files of written leaves are far smaller than their rows, and an explorer
    reply than its topics, so neither side is left to be broadcast by its size.
    """
    return scan_mart_leaves(marts).join(scan_topics(explorer, leading).hint("merge"), "mart_id")


def usable_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves with a data filter; adds ``dataset_id`` and ``file_name``, which is a column and may be of any length."""
    return leaves.where(P.is_present("data_filter")).withColumns(
        {"dataset_id": text.strip_doc_id("data_filter"), "file_name": text.leaf_file_name("name")}
    )


def leaf_candidates(leaves: DataFrame) -> DataFrame:
    """Two rows per leaf: ``(..., candidate, url)``, the later candidate preferred."""
    return leaves.select("*", F.posexplode(text.candidate_urls("dataset_id", "mart_id")).alias("candidate", "url"))
