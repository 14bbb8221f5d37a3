"""Error texts and records, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions.text import ColumnOrName, _col

# Outcome names, and the message texts and record layouts below.
HTTP_ERROR = "HTTPResourceError"
TOO_LARGE = "TooLargeResourceError"
IS_HTML = "IsHTMLError"
IS_ZIP = "IsZIPError"
BAD_LENGTH = "ValueError"


def http_error_text(status: ColumnOrName, url: ColumnOrName) -> Column:
    return F.format_string("Error status %d with requested URL: %s", _col(status), _col(url))


def too_large_text(size: ColumnOrName, max_size: int, url: ColumnOrName) -> Column:
    return F.format_string(
        f"Resource size %d > max_size {int(max_size)} for URL: %s", _col(size), _col(url)
    )


def html_text(text: ColumnOrName) -> Column:
    return F.format_string(
        "HTML-like elements detected in the first part of data: %s. "
        "It is not possible to recognize it as a structured dataset.",
        _col(text),
    )


def zip_text(url: ColumnOrName) -> Column:
    return F.format_string(
        "Filename ends with '.zip': %s. ZIP files are not recognized as structured datasets.",
        _col(url),
    )


def bad_length_text(length: ColumnOrName) -> Column:
    return F.format_string("invalid Content-Length: %s", _col(length))


def resource_error_record(kind: ColumnOrName, message: ColumnOrName, url: ColumnOrName) -> Column:
    return F.format_string("[TYPE:%s][error:%s][URL:%s]", _col(kind), _col(message), _col(url))


def dataset_error_record(dataset_id: ColumnOrName, message: ColumnOrName, kind: ColumnOrName) -> Column:
    return F.format_string("[DATASET:%s][ERROR:%s][TYPE:%s]", _col(dataset_id), _col(message), _col(kind))
