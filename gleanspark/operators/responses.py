"""Meeting a work list with its replies, and judging them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import errors as E
from gleanspark.functions import predicates as P
from gleanspark.operators.positions import last_writer_wins

#: Fixed value: default cap on a resource, in bytes.
MAX_RESOURCE_SIZE = 2**20


def header(headers: Column | str, name: str) -> Column:
    """A header of a ``map<string,string>``, name matched without case."""
    lowered = F.transform_keys(headers, lambda k, _: F.lower(k))
    return F.try_element_at(lowered, F.lit(name.lower()))


def join_responses(work: DataFrame, responses: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Work rows with their reply, nulls where none has landed.

    Bodies (``content``) stay out of it: many rows may share a url, and their
    verdict takes status and headers only. They stay with the replies, by url.
    With ``order``, several replies to one url are cut to the last first; else
    the replies are taken to be unique by url. Many rows may share a url.
    """
    responses = responses.drop("content")
    if order:
        responses = last_writer_wins(responses, ("url",), order)
    return work.join(responses, "url", "left")


def error_type(max_size: int, status: str = "status", length: str = "content_length") -> Column:
    """Why a reply is refused, null when it is not."""
    return (
        F.when(P.is_http_error(status), E.HTTP_ERROR)
        .when(P.is_bad_length(length), E.BAD_LENGTH)
        .when(P.is_too_large(length, max_size), E.TOO_LARGE)
    )


def error_text(max_size: int, kind: str = "error_type", status: str = "status", length: str = "content_length") -> Column:
    return (
        F.when(F.col(kind) == E.HTTP_ERROR, E.http_error_text(status, "url"))
        .when(F.col(kind) == E.BAD_LENGTH, E.bad_length_text(length))
        .when(F.col(kind) == E.TOO_LARGE, E.too_large_text(P.parse_length(length), max_size, "url"))
    )


def classify_responses(responses: DataFrame, max_size: int = MAX_RESOURCE_SIZE) -> DataFrame:
    """Add ``error_type``, ``error_text`` and ``ok``, from status and headers alone."""
    return (
        responses.withColumn("error_type", error_type(max_size))
        .withColumn("error_text", error_text(max_size))
        .withColumn("ok", F.col("error_type").isNull())
    )


def run_summary(outcomes: DataFrame, *keys: str) -> DataFrame:
    """``(keys..., successes, errors, total)``."""
    return outcomes.groupBy(*keys).agg(
        F.count_if("ok").alias("successes"),
        F.count_if(~F.col("ok")).alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )


def collect_errors(outcomes: DataFrame) -> DataFrame:
    """The failed rows with their log record."""
    return outcomes.where(~F.col("ok")).withColumn(
        "record", E.resource_error_record("error_type", "error_text", "url")
    )


def errors_by_type(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(~F.col("ok")).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def merge_headers(a: Column | str, b: Column | str) -> Column:
    """Union of two header maps; the right one wins, under any map setting."""
    a, b = (F.col(m) if isinstance(m, str) else m for m in (a, b))
    rest = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.map_concat(rest, b)
