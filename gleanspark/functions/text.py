"""Column functions on ids, names, urls and labels."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Fixed value: joins a resource name and a resource id in a storage key.
KEY_SEPARATOR = "__"

# Url templates of the portals, filled by ``format_string``.
MART_URL = "http://data.un.org/Handlers/ExplorerHandler.ashx?m=%s"
LEAF_URLS = (
    "http://data.un.org/Handlers/DownloadHandler.ashx?DataFilter=%1$s&DataMartId=%2$s&Format=csv",
    "http://data.un.org/Handlers/DocumentDownloadHandler.ashx?id=%1$s&t=bin",
)
INDICATOR_LIST_URL = "https://data360api.worldbank.org/data360/indicators?datasetId=%s"
INDICATOR_METADATA_URL = "https://data360files.worldbank.org/data360-data/metadata/%1$s/%2$s.json"
INDICATOR_DATA_URL = "https://data360files.worldbank.org/data360-data/data/%1$s/%2$s.csv"

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BLANK = f"[{WHITESPACE}]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Both ends freed of any Unicode whitespace, tabs and newlines included."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_resource_id(c: ColumnOrName) -> Column:
    """No ``/`` and no key separator left in an id."""
    return F.replace(F.replace(_col(c), F.lit("/"), F.lit("-")), F.lit("__"), F.lit("--"))


def clean_resource_name(c: ColumnOrName) -> Column:
    """Name usable in a storage key; null becomes the empty string."""
    dashed = F.translate(strip(c), " :", "--")
    return F.coalesce(F.replace(dashed, F.lit("__"), F.lit("--")), F.lit(""))


def storage_key(name: ColumnOrName, resource_id: ColumnOrName, with_name: bool = True) -> Column:
    """``<name>__<id>``, or the id alone when there is no name or none is wanted."""
    if not with_name:
        return _col(resource_id)
    return F.when(
        _col(name) != "", F.concat_ws(KEY_SEPARATOR, _col(name), _col(resource_id))
    ).otherwise(_col(resource_id))


def without_trailing_slash(base: ColumnOrName) -> Column:
    return F.regexp_replace(_col(base), "/$", "")


def absolutize_url(url: ColumnOrName, base: ColumnOrName) -> Column:
    """Urls that do not start with ``http`` are put below the portal's base url."""
    url = _col(url)
    joined = F.concat(without_trailing_slash(base), F.lit("/"), F.regexp_replace(url, "^/", ""))
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(joined)


def action_url(
    base: ColumnOrName, action_path: ColumnOrName, action: str, params: dict[str, ColumnOrName]
) -> Column:
    """``<base><action_path>/<action>?k=v&...``; parameters that are null are left out."""
    pairs = [F.concat(F.lit(f"{key}="), _col(value).cast("string")) for key, value in params.items()]
    query = F.concat_ws("&", *pairs) if pairs else F.lit("")
    return F.concat(
        without_trailing_slash(base), _col(action_path), F.lit(f"/{action}?"), query
    )


def mart_url(mart_id: ColumnOrName) -> Column:
    return F.format_string(MART_URL, _col(mart_id))


def candidate_urls(dataset_id: ColumnOrName, mart_id: ColumnOrName) -> Column:
    """The urls to try for a leaf; a later position overrides an earlier one."""
    return F.array(*[F.format_string(t, _col(dataset_id), _col(mart_id)) for t in LEAF_URLS])


def indicator_metadata_url(database_id: ColumnOrName, indicator_id: ColumnOrName) -> Column:
    return F.format_string(INDICATOR_METADATA_URL, _col(database_id), _col(indicator_id))


def indicator_data_url(database_id: ColumnOrName, indicator_id: ColumnOrName) -> Column:
    return F.format_string(INDICATOR_DATA_URL, _col(database_id), _col(indicator_id))


def indicator_list_url(database_id: ColumnOrName) -> Column:
    return F.format_string(INDICATOR_LIST_URL, _col(database_id))


def indicator_path(root: str, database_id: ColumnOrName, indicator_id: ColumnOrName, suffix: str) -> Column:
    return F.concat(F.lit(f"{root}/"), _col(database_id), F.lit("/"), _col(indicator_id), F.lit(f".{suffix}"))


def strip_doc_id(c: ColumnOrName) -> Column:
    return F.replace(_col(c), F.lit("docID:"), F.lit(""))


def leaf_file_name(c: ColumnOrName) -> Column:
    return F.concat(F.replace(_col(c), F.lit("/"), F.lit("-")), F.lit(".csv"))


def target_path(destination: str, key: ColumnOrName, extension: ColumnOrName) -> Column:
    """``<destination>/datasets/<ext>/<key>.<ext>``."""
    key, extension = _col(key), _col(extension)
    return F.concat(F.lit(f"{destination}/datasets/"), extension, F.lit("/"), key, F.lit("."), extension)


def strip_bom(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), "^\\uFEFF", "")


def repair_nodes_json(c: ColumnOrName) -> Column:
    """Quote the first bare ``Nodes`` key, which makes the topic replies valid JSON."""
    # Cut once instead of by positions, which are counted from the first character at every use.
    return F.array_join(F.split(_col(c), r"\{Nodes:", 2), '{"Nodes":')


def decode_entities(c: ColumnOrName) -> Column:
    """Character references as their characters: decimal, hexadecimal and the named ones of HTML 4; others stay."""
    # One literal for the optimizer to fold, instead of hundreds for it to carry through every rule.
    known = {name: chr(point) for name, point in name2codepoint.items()} | {"apos": "'"}
    names = F.from_json(F.lit(json.dumps(known)), "map<string,string>")

    # Each step takes what the one before has found, which a lambda holds; an expression would be worked out at every use.
    def named(part: Column) -> Column:
        name = F.regexp_extract(part, r"^&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        return F.struct(part.alias("part"), F.when(part.startswith("&"), name).otherwise("").alias("name"))

    def numbered(found: Column) -> Column:
        digits = F.regexp_extract(found["name"], r"^#[xX]?([0-9A-Fa-f]+)$", 1)
        hexadecimal = F.when(found["name"].rlike("^#[xX]"), digits).otherwise(F.hex(digits.try_cast("bigint")))
        point = F.when(found["name"].startswith("#"), F.lpad(hexadecimal, 8, "0"))
        return F.struct(found["part"].alias("part"), found["name"].alias("name"), point.alias("point"))

    def decoded(found: Column) -> Column:
        part, name, point = found["part"], found["name"], found["point"]
        valid = (point > "00000000") & (point <= "0010FFFF") & ~F.upper(point).between("0000D800", "0000DFFF")
        # A map is searched from its first key on, so only for what is a name.
        char = F.when(point.isNull(), F.try_element_at(names, name)).when(valid, F.decode(F.unhex(point), "UTF-32"))
        rest = F.substring(part, F.length(name) + 3, F.length(part))
        return F.when(name == "", part).otherwise(F.coalesce(F.concat(char, rest), part))

    parts = F.transform(F.transform(F.split(_col(c), "(?=&)"), named), numbered)
    return F.array_join(F.transform(parts, decoded), "")


def span_text(html: ColumnOrName, css_class: str) -> Column:
    """Text of the first ``span`` of a class, inner tags removed; null without such a span.

    The span ends where as many spans are closed as were opened in it. Character
    references are decoded before both ends are stripped.
    """
    opening = (
        r"(?is)^.*?<span\b[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?" + css_class + r"(?:\s[^\"']*)?[\"'][^>]*>"
    )
    html = _col(html)
    # Most labels hold neither tags nor references, and are read by one pattern, which gives an empty list for the others.
    plain = F.lit(r"(?is)^(?>" + opening.removeprefix("(?is)^") + r")([^<&]*)</span\s*>")
    return F.coalesce(strip(F.try_element_at(F.regexp_extract_all(html, plain, F.lit(1)), F.lit(1))), _marked_text(html, opening))


def _marked_text(html: Column, opening: str) -> Column:
    """Text behind ``opening`` up to the end of its span, with tags and references in it."""
    behind = F.when(html.rlike(opening), F.regexp_replace(html, opening, ""))
    parts = F.split(behind, r"(?i)(?=<span\b|</span\s*>)")
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def add(state: Column, part: Column) -> Column:
        step = F.when(part.rlike(r"(?i)^<span\b"), 1).when(part.rlike(r"(?i)^</span\s*>"), -1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + step).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(state["text"], part)).otherwise(state["text"]).alias("text"))

    closed = F.aggregate(parts, start, add, lambda inner: F.when(inner["depth"] == 0, inner["text"]))
    return strip(decode_entities(F.regexp_replace(closed, f"{_BLANK}*<[^>]*>{_BLANK}*", "")))


def run_name(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "yyMMdd_HH_mm_ss")
