"""Which rows of a dataset its landed pages cover: gaps and overlaps by a sorted sweep.

A page covers the interval ``[offset, offset + rows)``. The sweep cuts intervals
at the bounds of equal stripes and sorts each stripe of a dataset for itself, so
a dataset that holds most of all pages is swept by as many tasks as it has
stripes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a stripe; far more than a page has, so that few pages are cut.
STRIPE_ROWS = 1 << 20


def row_coverage(pages: DataFrame, ends: DataFrame | None = None, stripe: int = STRIPE_ROWS) -> DataFrame:
    """``(dataset_id, kind, start, stop)``: the gaps and overlaps of ``pages (dataset_id, offset, rows)``.

    ``ends (dataset_id, stop)`` says how far each dataset reaches; without it, a
    dataset reaches as far as its last page, with it, also datasets without any
    page have a gap. A page that landed twice counts once; one without rows
    covers nothing. An overlap is given for each later page. What crosses the
    bound of a stripe is given in two parts.
    """
    if stripe < 1:
        raise ValueError("stripe must be positive")
    spans = pages.where("rows > 0").select("dataset_id", F.col("offset").alias("start"), (F.col("offset") + F.col("rows")).alias("stop"))
    spans = spans.distinct()
    if ends is None:
        ends = spans.groupBy("dataset_id").agg(F.max("stop").alias("stop"))
    ends = ends.where("stop > 0").select("dataset_id", F.col("stop").alias("end"))

    def number(place):
        return F.floor(place / F.lit(stripe))

    width = F.lit(stripe)
    cut = spans.withColumn("stripe", F.explode(F.sequence(number(F.col("start")), number(F.col("stop") - 1))))
    cut = cut.select(
        "dataset_id",
        "stripe",
        "start",
        "stop",
        F.greatest("start", F.col("stripe") * width).alias("a"),
        F.least("stop", (F.col("stripe") + 1) * width).alias("b"),
        F.lit(False).alias("last"),
    )
    # The bound of each stripe stands behind its pages; the last one at the end of the dataset.
    bounds = ends.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("bigint"), number(F.col("end") - 1))))
    bound = F.least("end", (F.col("stripe") + 1) * width)
    bounds = bounds.select(
        "dataset_id", "stripe", bound.alias("start"), bound.alias("stop"), bound.alias("a"), bound.alias("b"), F.lit(True).alias("last")
    )
    before = Window.partitionBy("dataset_id", "stripe").orderBy("a", "start", "stop", "last").rowsBetween(Window.unboundedPreceding, -1)
    swept = cut.unionByName(bounds).withColumn("reach", F.coalesce(F.max("b").over(before), F.col("stripe") * width))
    gap = F.col("a") > F.col("reach")
    overlap = (F.col("a") < F.col("reach")) & ~F.col("last")
    return swept.where(gap | overlap).select(
        "dataset_id",
        F.when(gap, "gap").otherwise("overlap").alias("kind"),
        F.when(gap, F.col("reach")).otherwise(F.col("a")).alias("start"),
        F.when(gap, F.col("a")).otherwise(F.least("b", "reach")).alias("stop"),
    )


def fill_requests(gaps: DataFrame, size: str = "size") -> DataFrame:
    """``(dataset_id, offset, asked)``: requests of at most ``size`` rows each that fill ``gaps (dataset_id, start, stop, size)``."""
    offsets = F.explode(F.sequence("start", F.col("stop") - 1, F.col(size)))
    asked = F.least(F.col(size), F.col("stop") - F.col("offset"))
    return gaps.where("stop > start").withColumn("offset", offsets).select("dataset_id", "offset", asked.alias("asked"))
