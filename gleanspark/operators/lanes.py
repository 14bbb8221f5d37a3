"""Dealing work of unequal size into equal lanes, the longest first.

Weights are put in classes an eighth of an octave wide. Their histogram, a few
hundred rows at any size, says how many items of each class a lane takes when
the longest are dealt first and each to the lane that has least; items are numbered
within their class by a range sort, and the number gives the lane.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.positions import with_position

#: Classes for each doubling of the weight.
CLASSES = 8
#: What a request costs beside its bytes, in bytes.
OVERHEAD = 1 << 16
#: Taken for the size of what does not say it.
UNKNOWN_SIZE = 1 << 18


def expected_weight(size: Column | str, overhead: int = OVERHEAD, unknown: int = UNKNOWN_SIZE) -> Column:
    """What a request is expected to cost: its size, which may be null or wrong, and the overhead."""
    known = (F.col(size) if isinstance(size, str) else size).try_cast("bigint")
    return F.when(known >= 0, known).otherwise(F.lit(unknown)) + F.lit(overhead)


def shares(loads: np.ndarray, count: int, weight: float) -> np.ndarray:
    """How many of ``count`` items of one weight each lane takes, each dealt to the lane with least."""
    order = np.argsort(loads, kind="stable")
    rising = loads[order]
    filled = np.arange(1, len(loads) + 1)
    # The level to which the items fill the lanes, if they were liquid.
    levels = (count * weight + np.cumsum(rising)) / filled
    lanes = int(np.flatnonzero(levels > rising)[-1]) + 1
    taken = np.zeros(len(loads), dtype=np.int64)
    taken[order[:lanes]] = np.floor((levels[lanes - 1] - rising[:lanes]) / weight)
    left = count - int(taken.sum())
    while left > 0:
        next_ = np.argsort(loads + taken * weight, kind="stable")[:left]
        taken[next_] += 1
        left -= len(next_)
    while left < 0:  # a rounding error of the level
        last = int(np.argmax(np.where(taken > 0, loads + taken * weight, -np.inf)))
        taken[last] -= 1
        left += 1
    return taken


def deal_lanes(work: DataFrame, lanes: int, weight: str = "weight", key: str = "url") -> DataFrame:
    """``work`` with ``lane`` (from 0) and ``place``, by which the items of a lane are in mixed order.

    ``weight`` holds positive whole numbers. A lane's sum passes the mean by one
    item at most, beside the width of a class. Items of one class are numbered by
    a hash of ``key``, so that those of one host spread over the lanes and within
    them. No rows give no rows; a lane may stay empty where there are fewer items.
    """
    if lanes < 1:
        raise ValueError("lanes must be positive")
    others = work.columns
    classed = work.withColumn("_class", F.floor(F.log2(F.col(weight)) * CLASSES).cast("int")).withColumn("place", F.xxhash64(key))
    # At most CLASSES * 63 rows.
    histogram = classed.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.avg(weight).alias("mean")).orderBy("_class").collect()
    loads, ends, owners = np.zeros(lanes), [], []
    heads: dict[int, int] = {}
    dealt = 0
    for row in reversed(histogram):
        heads[row["_class"]] = dealt
        taken = shares(loads, row["n"], row["mean"])
        loads += taken * row["mean"]
        used = np.flatnonzero(taken)
        ends.append(dealt + np.cumsum(taken[used]))
        owners.append(used)
        dealt += row["n"]
    classes = np.array(sorted(heads), dtype=np.int64)
    table = (classes, np.array([heads[c] for c in classes]), np.concatenate([np.zeros(0, dtype=np.int64), *ends]), np.concatenate([np.zeros(0, dtype=np.int64), *owners]))
    # Lanes times classes at most.
    shared = work.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(T.IntegerType())
    def lane_of(kind: pd.Series, position: pd.Series) -> pd.Series:
        classes, heads, ends, owners = shared.value
        number = heads[np.searchsorted(classes, kind.to_numpy())] + position.to_numpy() - 1
        return pd.Series(owners[np.searchsorted(ends, number, side="right")].astype(np.int32))

    numbered = with_position(classed, ["place", key], ["_class"])
    return numbered.select(*others, lane_of("_class", "position").alias("lane"), "place")
