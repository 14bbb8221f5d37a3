"""Declared portal types as Spark types, and the casts that go with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions.text import ColumnOrName, _col

#: Type name of a column whose declaration is not understood.
INVALID = "invalid"

# The views of a "calendar date" and the pattern each one declares.
DATE_VIEWS = {
    "date": "yyyy-MM-dd",
    "date_ymd": "yyyy-MM-dd",
    "date_my": "yyyy-MM",
    "date_y": "yyyy",
    "date_time": None,
    "default_date_time": None,
    "iso_8601_date": None,
}

# Patterns tried for timestamps after ISO 8601.
_OTHER_PATTERNS = ("MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy")

_SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    INVALID: T.StringType(),
}


def spark_type_of(datatype: ColumnOrName, fmt: ColumnOrName) -> Column:
    """Spark type name of a declared type; ``fmt`` is a ``map<string,string>`` or null."""
    datatype, fmt = F.lower(_col(datatype)), _col(fmt)
    no_format = fmt.isNull() | (F.size(fmt) == 0)
    has = lambda key: F.map_contains_key(fmt, key)
    date_type = (
        F.when(no_format, "timestamp_ntz")
        .when(~has("view"), "date")
        .when(fmt["view"].isin(*DATE_VIEWS), "timestamp_ntz")
        .otherwise(INVALID)
    )
    number_type = (
        F.when(no_format, "float")
        .when(~has("noCommas"), "int")
        .when(fmt["noCommas"] == "true", "int")
        .when(fmt["noCommas"] == "false", "float")
        .otherwise("string")
    )
    return (
        F.when(datatype == "calendar date", date_type)
        .when(datatype == "number", number_type)
        .otherwise("string")
    )


def date_pattern_of(fmt: ColumnOrName) -> Column:
    """Pattern a date format declares, null when it declares none."""
    fmt, pattern = _col(fmt), F.lit(None).cast("string")
    for view, value in DATE_VIEWS.items():
        if value:
            pattern = F.when(fmt["view"] == view, F.lit(value)).otherwise(pattern)
    return pattern


def zip_columns(names: ColumnOrName, types: ColumnOrName, formats: ColumnOrName) -> Column:
    """Three parallel arrays as one array of structs, as long as the shortest."""
    text, options = "array<string>", "array<map<string,string>>"
    arrays = [
        F.coalesce(_col(a), F.array().cast(kind)) for a, kind in ((names, text), (types, text), (formats, options))
    ]
    length = F.least(*[F.size(a) for a in arrays])
    cut = [F.slice(a, F.lit(1), length) for a in arrays]
    zipped = F.arrays_zip(
        cut[0].alias("name"), cut[1].alias("data_type"), cut[2].alias("format")
    )
    return F.transform(
        zipped,
        lambda c: F.struct(
            c["name"].alias("name"), c["data_type"].alias("data_type"), c["format"].alias("format")
        ),
    )


def cast_number(c: ColumnOrName, target: str) -> Column:
    """``int`` or ``float``; a cell that does not parse becomes null."""
    return _col(c).try_cast(target)


def cast_datetime(c: ColumnOrName, pattern: str | None = None) -> Column:
    """Timestamp without zone: ISO 8601, whole or cut to day, month or year, then other layouts.

    The plain cast covers every pattern the date views declare. Other layouts
    are tried only on cells that look like them, since a failed parse is costly.
    """
    c = _col(c)
    us = F.when(
        c.rlike(r"^\d{2}/\d{2}/\d{4}"),
        F.coalesce(*[F.try_to_timestamp(c, F.lit(p)).cast("timestamp_ntz") for p in _OTHER_PATTERNS]),
    )
    tries = [c.try_cast("timestamp_ntz"), us]
    if pattern is not None and pattern not in DATE_VIEWS.values():
        tries.append(F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz"))
    return F.coalesce(*tries)


def cast_date(c: ColumnOrName) -> Column:
    return cast_datetime(c).cast("date")


def cast_string(c: ColumnOrName) -> Column:
    return _col(c).cast("string")


def cast_cell(c: ColumnOrName, type_name: str, pattern: str | None = None) -> Column:
    """One cell cast to a type known when the plan is built."""
    if type_name in ("int", "float"):
        return cast_number(c, type_name)
    if type_name == "timestamp_ntz":
        return cast_datetime(c, pattern)
    if type_name == "date":
        return cast_date(c)
    return cast_string(c)


def type_name(datatype: str, fmt: Mapping[str, str] | None) -> str:
    """``spark_type_of`` for one value on the driver."""
    datatype = datatype.lower()
    if datatype == "calendar date":
        if not fmt:
            return "timestamp_ntz"
        if "view" not in fmt:
            return "date"
        return "timestamp_ntz" if fmt["view"] in DATE_VIEWS else INVALID
    if datatype == "number":
        if not fmt:
            return "float"
        return {"true": "int", "false": "float"}.get(fmt["noCommas"], "string") if "noCommas" in fmt else "int"
    return "string"


def schema_from_metadata(
    names: Sequence[str], datatypes: Sequence[str], formats: Sequence[Mapping[str, str] | None]
) -> T.StructType:
    """Schema of one dataset; all strings when any declaration is not understood."""
    columns = [(n, type_name(d, f)) for n, d, f in zip(names, datatypes, formats)]
    broken = any(t == INVALID for _, t in columns)
    return T.StructType(
        [T.StructField(n, T.StringType() if broken else _SPARK_TYPES[t]) for n, t in columns]
    )
