"""Datasets in long form: records, their declared or inferred types, casts.

All datasets stay in one table ``(dataset_id, row_idx, record)`` with ``record``
a ``map<string,string>``. Types meet cells by a join on the dataset, so any
number of datasets is cast in one job; one dataset can be projected to columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.functions import types as D

def declared_columns(entries: DataFrame) -> DataFrame:
    """``(dataset_id, columns)``: name, type and pattern of every declared column.

    A dataset with any declaration that is not understood keeps all its columns
    as strings and has ``type_error`` set.
    """
    zipped = entries.withColumn(
        "_zip", D.zip_columns("columns_field_name", "columns_datatype", "columns_format")
    )
    typed = F.transform(
        "_zip",
        lambda c: F.struct(
            c["name"].alias("name"),
            D.spark_type_of(c["data_type"], c["format"]).alias("type"),
            D.date_pattern_of(c["format"]).alias("pattern"),
        ),
    )
    return (
        zipped.withColumn("_typed", typed)
        .withColumn("type_error", F.exists("_typed", lambda c: c["type"] == D.INVALID))
        .select(
            "dataset_id",
            "type_error",
            F.when(
                F.col("type_error"),
                F.transform(
                    "_typed",
                    lambda c: F.struct(
                        c["name"].alias("name"), F.lit("string").alias("type"), c["pattern"].alias("pattern")
                    ),
                ),
            )
            .otherwise(F.col("_typed"))
            .alias("columns"),
        )
    )


def with_metadata(rows: DataFrame, columns: DataFrame, how: str = "left") -> DataFrame:
    """Dataset rows with the column declarations of their catalogue entry."""
    return rows.join(columns, "dataset_id", how)


def _with_columns(rows: DataFrame, entries: DataFrame, how: str) -> DataFrame:
    """Rows with ``columns``; where there is no entry, every key is a string column."""
    undeclared = F.transform(
        F.map_keys("record"),
        lambda k: F.struct(
            k.alias("name"), F.lit("string").alias("type"), F.lit(None).cast("string").alias("pattern")
        ),
    )
    return with_metadata(rows, declared_columns(entries), how).withColumn("columns", F.coalesce("columns", undeclared))


def typed_records(rows: DataFrame, entries: DataFrame, how: str = "left") -> DataFrame:
    """Every row cast by its dataset's entry: ``(dataset_id, row_idx, record variant)``.

    One row stays one row, whatever the width of its dataset; fields hold int,
    float, date, timestamp or string values, and null where a cell does not
    parse. Rows without an entry stay strings, or are left out by an inner join.
    """

    def value(column: Column) -> Column:
        cell = F.try_element_at("record", column["name"])
        typed = F.lit(None).cast("variant")
        for name, cast in _casts(cell).items():
            typed = F.when(column["type"] == name, cast.cast("variant")).otherwise(typed)
        return F.struct(column["name"], typed)

    fields = F.map_from_entries(F.transform("columns", value))
    return _with_columns(rows, entries, how).select(
        "dataset_id", "row_idx", F.to_variant_object(fields).alias("record")
    )


def typed_cells(rows: DataFrame, entries: DataFrame, how: str = "left") -> DataFrame:
    """As :func:`typed_records`, one row per cell.

    ``(dataset_id, row_idx, name, type, text_value, int_value, float_value,
    date_value, timestamp_value)``; only the column of the cell's type is set.
    """
    cells = (
        _with_columns(rows, entries, how)
        .select("dataset_id", "row_idx", "record", F.inline("columns"))
        .withColumn("_cell", F.try_element_at("record", F.col("name")))
    )
    values = _casts(F.col("_cell"))
    names = {"string": "text", "int": "int", "float": "float", "date": "date", "timestamp_ntz": "timestamp"}
    return cells.select(
        "dataset_id",
        "row_idx",
        "name",
        "type",
        *[F.when(F.col("type") == t, values[t]).alias(f"{name}_value") for t, name in names.items()],
    )


def _casts(cell: Column) -> dict[str, Column]:
    """The cast of a cell for every type."""
    return {
        "string": D.cast_string(cell),
        "int": D.cast_number(cell, "int"),
        "float": D.cast_number(cell, "float"),
        "date": D.cast_date(cell),
        "timestamp_ntz": D.cast_datetime(cell),
    }


def records_to_df(records: DataFrame, schema: T.StructType | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """One dataset as columns: cast to ``schema``, or to the types all its rows allow, in the order of the records' keys."""
    if schema is None:
        found = infer_columns(records.withColumn("dataset_id", F.lit("-"))).select(F.inline(F.map_entries("columns")))
        schema = T.StructType([T.StructField(r["key"], T.DataType.fromDDL(r["value"])) for r in found.collect()])
    patterns = patterns or {}
    return records.select(
        *[
            D.cast_cell(
                F.try_element_at("record", F.lit(f.name)), f.dataType.simpleString(), patterns.get(f.name)
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def infer_columns(records: DataFrame) -> DataFrame:
    """``(dataset_id, columns map<name,type>)`` from all rows of each dataset.

    A column is bigint, double or boolean when all its non-empty cells are, else
    string. Partial results are combined before the shuffle, so a hot dataset
    sends one row per column and task.
    """
    value = F.col("value")
    filled = value.isNotNull() & (value != "")

    def all_cells(condition: Column) -> Column:
        return F.coalesce(F.bool_and(F.when(filled, condition)), F.lit(False))

    cells = records.select("dataset_id", F.posexplode(F.map_entries("record")).alias("_pos", "_cell"))
    cells = cells.select("dataset_id", "_pos", F.col("_cell.key").alias("name"), F.col("_cell.value").alias("value"))
    types = cells.groupBy("dataset_id", "name").agg(
        all_cells(value.rlike(r"^[+-]?\d+$") & value.try_cast("bigint").isNotNull()).alias("_int"),
        all_cells(value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")).alias("_float"),
        all_cells(value.isin("true", "false")).alias("_bool"),
        F.min("_pos").alias("_pos"),
    )
    kind = (
        F.when(F.col("_int"), "bigint").when(F.col("_float"), "double").when(F.col("_bool"), "boolean").otherwise("string")
    )
    # One entry per column of the dataset's header, in its order.
    listed = F.sort_array(F.collect_list(F.struct("_pos", "name", kind.alias("type"))))
    return types.groupBy("dataset_id").agg(
        F.map_from_entries(F.transform(listed, lambda c: F.struct(c["name"], c["type"]))).alias("columns")
    )
