"""Tabular portals: the dataset catalogue and the rows of landed pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions.geo import register_portal_functions
from gleanspark.operators.positions import limit_indexed_rows, limit_ordered
from gleanspark.operators.unnest import unnest
from gleanspark.sources.catalog import matching
from gleanspark.sources.payloads import decode_csv

ENTRY_TYPE = (
    "struct<resource:struct<id:string,columns_field_name:array<string>,"
    "columns_datatype:array<string>,columns_format:array<map<string,string>>>>"
)


def parse_entries(replies: DataFrame) -> DataFrame:
    """``(dataset_id, columns_field_name, columns_datatype, columns_format)`` from JSON entries in ``body``."""
    return replies.select(F.from_json("body", ENTRY_TYPE).alias("e")).select(
        F.col("e.resource.id").alias("dataset_id"),
        "e.resource.columns_field_name",
        "e.resource.columns_datatype",
        "e.resource.columns_format",
    )


def scan_dataset_catalog(entries: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    return limit_ordered(entries, ("dataset_id",), limit, offset)


def dataset_metadata(entries: DataFrame, dataset_id: str) -> DataFrame:
    return entries.where(F.col("dataset_id") == dataset_id)


def _xml_records(body: str) -> Column:
    """Rows right below the root, or inside one more ``row`` element, as portals send them."""
    inner = F.from_xml(F.col(body), "row struct<row:array<map<string,string>>>")["row"]["row"]
    return F.coalesce(inner, F.from_xml(F.col(body), "row array<map<string,string>>")["row"])


def parse_record_pages(pages: DataFrame, wire_format: str = "json") -> DataFrame:
    """``(dataset_id, row_idx, record)`` from landed pages ``(dataset_id, offset, body)``.

    ``wire_format`` is json, csv or xml. The index continues over pages, so
    limits are plain filters on it.
    """
    if wire_format == "csv":
        page = F.to_json(F.struct("dataset_id", "offset"))
        decoded = decode_csv(pages.select(page.alias("dataset_id"), F.encode("body", "UTF-8").alias("content")))
        origin = F.from_json("dataset_id", "dataset_id string, offset bigint")
        return decoded.select(
            origin["dataset_id"].alias("dataset_id"), (origin["offset"] + F.col("row_idx")).alias("row_idx"), "record"
        )
    if wire_format not in ("json", "xml"):
        raise ValueError(f"unknown wire format: {wire_format}")
    records = F.from_json("body", "array<map<string,string>>") if wire_format == "json" else _xml_records("body")
    return unnest(pages, records, "record", ("dataset_id", "offset"), "pos").select(
        "dataset_id", (F.col("offset") + F.col("pos")).cast("bigint").alias("row_idx"), "record"
    )


def scan_dataset_rows(rows: DataFrame, dataset_id: str | None = None, limit: int = -1, offset: int = 0) -> DataFrame:
    """The rows of one dataset (or of each) from ``offset``; ``limit`` is exact, -1 means all."""
    if dataset_id is not None:
        rows = rows.where(F.col("dataset_id") == dataset_id)
    return limit_indexed_rows(rows, limit, offset)


def dataset_query(
    rows: DataFrame,
    select: Sequence[str] = (),
    where: str | None = None,
    group: Sequence[str] = (),
    order: Sequence[str] = (),
    limit: int | None = None,
    offset: int = 0,
    **filters: Any,
) -> DataFrame:
    """The portal's row query: SQL expressions to select and to filter by, columns to
    group and to order by, and values that further columns must have.

    With ``group`` the selected expressions are aggregates. A limit or an offset
    needs an order.
    """
    found = matching(rows, filters)
    if where is not None:
        found = found.where(where)
    if group:
        found = found.groupBy(*group).agg(*[F.expr(expression) for expression in select])
    if (limit is not None and limit != -1) or offset:
        if not order:
            raise ValueError("a limit or an offset needs an order")
        found = limit_ordered(found, order, limit, offset)
    elif order:
        found = found.orderBy(*order)
    return found if group or not select else found.selectExpr(*select)


def portal_query(rows: DataFrame, parameters: Mapping[str, Any]) -> DataFrame:
    """The portal's row query with its own parameters: ``$select``, ``$where``, ``$group``, ``$having``, ``$order``,
    ``$limit``, ``$offset``, and values that columns must have.

    The clauses are SQL texts and go to Spark's parser as they are; the
    portal's filters by area (``within_box``, ``within_circle``) are functions of the
    session. Filters and columns reach the scan as in any other query. A limit
    or an offset needs an order.
    """
    spark = rows.sparkSession
    register_portal_functions(spark)
    clauses = {name: value for name, value in parameters.items() if name.startswith("$")}
    unknown = set(clauses) - {"$select", "$where", "$group", "$having", "$order", "$limit", "$offset"}
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    if ("$limit" in clauses or "$offset" in clauses) and "$order" not in clauses:
        raise ValueError("a limit or an offset needs an order")
    found = matching(rows, {name: value for name, value in parameters.items() if name not in clauses})
    parts = []
    for name, keyword in (("$where", "WHERE"), ("$group", "GROUP BY"), ("$having", "HAVING"), ("$order", "ORDER BY")):
        if name in clauses:
            parts.append(f"{keyword} {clauses[name]}")
    for name, keyword in (("$limit", "LIMIT"), ("$offset", "OFFSET")):
        if name in clauses:
            parts.append(f"{keyword} {int(clauses[name])}")
    # Braces of the clauses would be taken for the names of tables.
    select, rest = (text.replace("{", "{{").replace("}", "}}") for text in (str(clauses.get("$select", "*")), " ".join(parts)))
    return spark.sql(f"SELECT {select} FROM {{rows}} {rest}", rows=found)


def read_dataset_files(
    spark: SparkSession, path: str, wire_format: str, schema: T.StructType | None = None, row_tag: str = "row"
) -> DataFrame:
    """One dataset from landed csv, json or xml files; all columns strings unless a schema is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if wire_format == "csv":
        return reader.option("header", True).csv(path)
    if wire_format == "json":
        return reader.option("primitivesAsString", schema is None).option("multiLine", True).json(path)
    if wire_format == "xml":
        return reader.option("rowTag", row_tag).option("inferSchema", False).xml(path)
    raise ValueError(f"unknown wire format: {wire_format}")
