"""Boolean columns over resources, responses and payload text.

Every predicate is two-valued: a null input never matches a pattern, so a null
format is rejected and a null name passes. Resource predicates take ``of``,
which gives a field's column by name: ``F.col`` for flat rows, and
``resource.getField`` for a resource inside its package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions.text import ColumnOrName, _col

#: Fixed value: names longer than this are not stored.
MAX_NAME_LENGTH = 255

Fields = Callable[[str], Column]

# Patterns the sample portal filters reject.
CANADA_REJECTED_NAME = r"(?s)\(CSV.+\)"
UK_REJECTED_NAMES = (r"^v\d+", r"^Contracts Finder")

# A document element at the very start, after a BOM, blanks, comments or an XML prolog.
_HTML_START = r"(?is)^[\s\uFEFF]*(?:<\?xml[^>]*>\s*|<!--.*?-->\s*)*<(?:!doctype\s+html|html|head|body)\b"


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def has_format(*formats: str, of: Fields = F.col) -> Column:
    return _holds(F.lower(of("format")).isin(*formats))


def is_csv(of: Fields = F.col) -> Column:
    return has_format("csv", of=of)


def is_csv_or_json(of: Fields = F.col) -> Column:
    return has_format("csv", "json", of=of)


def mentions_language(language: ColumnOrName, code: str = "en", kind: str = "string") -> Column:
    """True when the language is absent, or holds the code.

    ``kind`` is the column's type: substring test on a ``string``, membership
    on an ``array``, and whichever fits the value on a ``variant``.
    """
    language = _col(language)
    if kind == "array":
        found = F.array_contains(language, code)
    elif kind == "variant":
        found = F.when(
            F.startswith(F.schema_of_variant(language), F.lit("ARRAY")),
            F.array_contains(F.try_variant_get(language, "$", "array<string>"), code),
        ).otherwise(F.contains(F.try_variant_get(language, "$", "string"), F.lit(code)))
    else:
        found = F.contains(language, F.lit(code))
    return language.isNull() | _holds(found)


def canada_predicate(of: Fields = F.col, language_kind: str = "string") -> Column:
    """CSV, in English where a language is given, and not a "(CSV ...)" variant."""
    return (
        is_csv(of)
        & mentions_language(of("language"), "en", language_kind)
        & ~_holds(of("name").rlike(CANADA_REJECTED_NAME))
    )


def uk_predicate(of: Fields = F.col) -> Column:
    """CSV, neither a numbered tariff version nor a Contracts Finder export."""
    keep = is_csv(of)
    for pattern in UK_REJECTED_NAMES:
        keep = keep & ~_holds(of("name").rlike(pattern))
    return keep


def usable(url: ColumnOrName = "url", resource_id: ColumnOrName = "id") -> Column:
    return _holds((_col(url) != "") & (_col(resource_id) != ""))


def is_http_error(status: ColumnOrName = "status") -> Column:
    return _holds(_col(status) >= 400)


def parse_length(content_length: ColumnOrName = "content_length") -> Column:
    return _col(content_length).try_cast("bigint")


def is_too_large(content_length: ColumnOrName, max_size: int) -> Column:
    """Longer than the cap; an absent length passes."""
    return _holds(parse_length(content_length) > max_size)


def is_bad_length(content_length: ColumnOrName = "content_length") -> Column:
    return _holds(_col(content_length) != "") & parse_length(content_length).isNull()


def accept_response(
    status: ColumnOrName = "status",
    content_type: ColumnOrName = "content_type",
    content_length: ColumnOrName = "content_length",
) -> Column:
    """Gate of the topic walk: status 200 and both headers present."""
    return _holds((_col(status) == 200) & (_col(content_type) != "") & (_col(content_length) != ""))


def is_html_payload(text: ColumnOrName) -> Column:
    """The payload starts as an HTML document."""
    return _holds(_col(text).rlike(_HTML_START))


def is_zip_url(url: ColumnOrName) -> Column:
    return _holds(F.endswith(F.lower(_col(url)), F.lit(".zip")))


def has_short_name(name: ColumnOrName, limit: int = MAX_NAME_LENGTH) -> Column:
    return _holds(F.length(_col(name)) <= limit)


def is_present(c: ColumnOrName) -> Column:
    return _holds(_col(c) != "")
