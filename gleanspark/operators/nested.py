"""Types of nested records, inferred from all rows of every dataset.

Records are JSON texts. Spark's own schema of variants is merged over the rows,
map-side first: what all rows allow, nested fields included. The order of the
columns is that in which the texts name them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quoted names stay as they are; a type is what no colon follows.
_TYPE_WORDS = re.compile(r"`(?:[^`]|``)*`|\b(?:DECIMAL\(\d+,\s*\d+\)|VOID|VARIANT|OBJECT)(?!:)")
# Fractions are doubles; what is null in all rows, or of several kinds, is kept as text.
_SETTLED = {"DECIMAL": "DOUBLE", "VOID": "STRING", "VARIANT": "STRING", "OBJECT": "STRUCT"}


def settled_type(schema: str) -> str:
    """The schema of variants as a type that a column can have; ``OBJECT<>`` has no fields and is text."""
    settled = _TYPE_WORDS.sub(lambda m: m[0] if m[0][0] == "`" else _SETTLED[m[0].partition("(")[0]], schema)
    return settled.replace("STRUCT<>", "STRING")


def _objects(records: DataFrame, record: str) -> DataFrame:
    return records.withColumn("_names", F.json_object_keys(record)).where(F.col("_names").isNotNull())


def infer_nested(records: DataFrame, record: str = "record", key: str = "dataset_id", order: str | None = None) -> DataFrame:
    """``(dataset_id, schema, header)``: the merged variant schema of each dataset and its column names in order.

    Names come in the order in which the rows bring them up first, rows by ``order``
    where given (else by place in the record, then name). Texts that are no object
    are no records and do not count. Partial results are merged map-side: a hot
    dataset shuffles one schema and one row per name and task.
    """
    objects = _objects(records, record)
    schemas = objects.groupBy(key).agg(F.schema_of_variant_agg(F.try_parse_json(record)).alias("schema"))
    at = [order] if order else []
    named = objects.select(key, *at, F.posexplode("_names").alias("_pos", "name"))
    first = named.groupBy(key, "name").agg(F.min(F.struct(*at, "_pos")).alias("_first"))
    # One entry per column of a dataset.
    header = F.transform(F.sort_array(F.collect_list(F.struct("_first", "name"))), lambda c: c["name"])
    headers = first.groupBy(key).agg(header.alias("header"))
    return schemas.join(headers, key, "left").select(key, "schema", F.coalesce("header", F.array().cast("array<string>")).alias("header"))


def nested_frame(records: DataFrame, record: str = "record", order: str | None = None) -> DataFrame:
    """One dataset of nested records as columns of the types that all its rows allow, in the order of its header.

    A value of several kinds is kept as text, objects among them as JSON; so is what
    no row fills. Rows that are no object have nulls. No rows give no columns.
    """
    found = infer_nested(records.withColumn("dataset_id", F.lit("-")), record, "dataset_id", order).first()
    if found is None or not found["header"]:
        return records.select()
    row = F.try_variant_get(F.try_parse_json(record), "$", settled_type(found["schema"]))

    def field(name: str) -> Column:
        return F.col("_row").getField(name).alias(name)

    return records.select(row.alias("_row")).select(*[field(name) for name in found["header"]])
