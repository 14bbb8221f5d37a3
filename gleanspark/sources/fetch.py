"""Fetching urls in Spark tasks through a transport the user supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import errors as E
from gleanspark.operators.lanes import deal_lanes, expected_weight
from gleanspark.operators.responses import MAX_RESOURCE_SIZE

#: ``transport(url, headers) -> (status, headers, body)``. ``body`` is bytes, or
#: a callable giving bytes, which is called only once the headers are accepted.
Transport = Callable[[str, Mapping[str, str]], tuple[int, Mapping[str, str], Any]]

FETCH_SCHEMA = (
    "url string, status int, headers map<string,string>, content_length string, "
    "content_type string, content binary, error_type string, error_text string"
)
#: Largest body a row can hold, with room for the rest of its batch.
MAX_CELL_BYTES = 2**31 - 2**27
#: Bytes of bodies gathered before they are handed to the JVM.
FLUSH_BYTES = 32 * 2**20


def _fetch_one(url: str, transport: Transport, request_headers: Mapping[str, str], max_size: int) -> dict[str, Any]:
    row: dict[str, Any] = dict.fromkeys(
        ("status", "headers", "content_length", "content_type", "content", "error_type", "error_text")
    )
    row["url"] = url
    try:
        status, headers, body = transport(url, request_headers)
        lowered = {str(k).lower(): str(v) for k, v in (headers or {}).items()}
        length = lowered.get("content-length")
        row.update(status=status, headers=lowered, content_length=length, content_type=lowered.get("content-type"))
        if status >= 400:
            row.update(error_type=E.HTTP_ERROR, error_text=f"Error status {status} with requested URL: {url}")
        elif length and int(length) > max_size:
            row.update(
                error_type=E.TOO_LARGE,
                error_text=f"Resource size {int(length)} > max_size {max_size} for URL: {url}",
            )
        else:
            content = body() if callable(body) else body
            if len(content or b"") > MAX_CELL_BYTES:
                raise OverflowError(f"{len(content)} bytes do not fit in a cell")
            row["content"] = content
    except Exception as error:  # one bad url never stops the others
        row.update(error_type=type(error).__name__, error_text=str(error), content=None)
    return row


def fetch(
    work: DataFrame,
    transport: Transport,
    partitions: int,
    request_headers: Mapping[str, str] | None = None,
    max_size: int = MAX_RESOURCE_SIZE,
    max_workers: int = 1,
    sizes: str | None = None,
) -> DataFrame:
    """One outcome row per distinct url of ``work``.

    Urls are made distinct first, so a url that many rows share is fetched once
    and the fetch is spread evenly. Spark may run a task again, so the transport
    has to be idempotent; write the result before reading it twice. A task asks
    for up to ``max_workers`` urls at a time, and holds as many bodies. With
    ``sizes``, a column of expected sizes (the largest of a url counts), the urls are
    dealt into ``partitions`` lanes of about equal cost, instead of equal number.
    """
    request_headers = dict(request_headers or {})

    def replies(urls: list[str]) -> Iterator[dict[str, Any]]:
        def ask(url: str) -> dict[str, Any]:
            return _fetch_one(url, transport, request_headers, max_size)

        if max_workers <= 1:
            yield from map(ask, urls)
            return
        with ThreadPoolExecutor(max_workers) as pool:
            for first in range(0, len(urls), max_workers):
                yield from pool.map(ask, urls[first : first + max_workers])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[dict[str, Any]] = []
        held = 0
        for batch in batches:
            for row in replies(batch["url"].tolist()):
                size = len(row["content"] or b"") + 1000
                if rows and held + size > FLUSH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
                rows.append(row)
                held += size
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    columns = [c.split()[0] for c in FETCH_SCHEMA.split(", ")]
    # Dealt out by url before repeats are dropped, so one shuffle serves both.
    known = work.where(F.col("url").isNotNull())
    if sizes is None:
        urls = known.select("url").repartition(partitions, "url").distinct()
    else:
        weighed = known.groupBy("url").agg(F.max(F.col(sizes).try_cast("bigint")).alias("_size"))
        weighed = weighed.select("url", expected_weight("_size").alias("weight"))
        dealt = deal_lanes(weighed, partitions).repartitionById(partitions, "lane")
        urls = dealt.sortWithinPartitions("place").select("url")
    outcomes = urls.mapInPandas(run, FETCH_SCHEMA)
    return outcomes.withColumn("ok", F.col("error_type").isNull())
