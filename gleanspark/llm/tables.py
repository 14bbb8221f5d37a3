"""What the operators share: inputs, intermediate tables, and rows picked by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.session import materialize

__all__ = ["materialize", "pick", "read_texts"]

#: Ids held by every executor at most when rows are picked: 8 bytes each, some
#: 64 MB as a hash table. Beyond that both sides are shuffled.
PICKED_IN_MEMORY = 1_000_000


def read_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, so that no other column of the input can clash or be read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def pick(rows: DataFrame, ids: DataFrame, on: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """``rows`` whose ``on`` is (or, for left_anti, is not) in ``ids``, a written table without repeats.

    The ids are counted first. Up to ``PICKED_IN_MEMORY`` they go to every
    executor and the rows stay where they are; beyond, it is a shuffled join.
    """
    if ids.count() <= PICKED_IN_MEMORY:
        ids = F.broadcast(ids)
    return rows.join(ids, on, how)
