"""Column functions on payload bytes and media types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions.text import ColumnOrName, _col

# File signatures, in hex.
SIGNATURES = {
    "zip": "504B0304",
    "xls": "D0CF11E0A1B11AE1",
    "gzip": "1F8B",
}

# Media types, freed of "application/" or "text/" and of parameters.
MEDIA_KINDS = {
    "zip": "zip",
    "vnd.ms-excel": "excel",
    "csv": "csv",
}


def sniff_kind(content: ColumnOrName) -> Column:
    """``zip``, ``xls``, ``gzip`` by signature, else ``plain``."""
    content = _col(content)
    kind = F.lit("plain")
    for name, signature in reversed(SIGNATURES.items()):
        head = F.hex(F.substring(content, 1, len(signature) // 2))
        kind = F.when(head == signature, F.lit(name)).otherwise(kind)
    return kind


def detected_extension(kind: ColumnOrName, configured: ColumnOrName) -> Column:
    """Extension by signature where there is one, else the configured format."""
    kind = _col(kind)
    return F.when(kind.isin("zip", "xls"), kind).otherwise(_col(configured))


def media_kind(content_type: ColumnOrName) -> Column:
    """``zip``, ``excel`` or ``csv`` by media type, else ``unknown``."""
    bare = F.regexp_replace(
        F.lower(F.trim(F.split_part(_col(content_type), F.lit(";"), F.lit(1)))), "^application/", ""
    )
    # Of the text types only CSV is a payload kind.
    bare = F.when(bare == "text/csv", F.lit("csv")).otherwise(bare)
    kind = F.lit("unknown")
    for name, value in MEDIA_KINDS.items():
        kind = F.when(bare == name, F.lit(value)).otherwise(kind)
    return kind
