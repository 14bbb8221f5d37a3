"""Dates in mixed layouts: what all cells of a column allow decides how each is read.

``03/04/2024`` is ambiguous by itself; beside ``25/12/2024`` it is the third of
April. Each cell gives the set of layouts that can read it, as a bit per layout.
The sets of a column are merged by ``bit_and``, and where no layout reads all of
its cells, by what the cells say about the order of day and month.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.text import ColumnOrName, _col

# Layouts in order of preference. Shape, pattern, and which number the month is.
LAYOUTS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d", ""),
    (r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}:\d{2}", "", ""),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d", ""),
    (r"^\d{8}$", "yyyyMMdd", ""),
    (r"^\d{4}-\d{1,2}$", "yyyy-M", ""),
    (r"^\d{4}$", "yyyy", ""),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy", "first"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy", "second"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy", "first"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy", "second"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "M.d.yyyy", "first"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy", "second"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:m:s", "first"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "d/M/yyyy H:m:s", "second"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$", "M/d/yyyy h:m:s a", "first"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$", "d/M/yyyy h:m:s a", "second"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy", ""),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy", ""),
)
_ALL = (1 << len(LAYOUTS)) - 1


def _mask(month: str) -> int:
    return sum(1 << i for i, (_, _, place) in enumerate(LAYOUTS) if place == month)


_MONTH_FIRST, _DAY_FIRST = _mask("first"), _mask("second")


def _parse(cell: Column, pattern: str) -> Column:
    """One cell by one layout, null where it does not fit."""
    if not pattern:
        return cell.try_cast("timestamp_ntz")
    # Month names and halves of the day in any case.
    named = F.initcap(cell) if "MMM" in pattern else F.upper(cell) if pattern.endswith("a") else cell
    return F.try_to_timestamp(named, F.lit(pattern)).cast("timestamp_ntz")


def _number(cell: Column, at: int) -> Column:
    return F.regexp_extract(cell, r"^(\d+)\D(\d+)", at).try_cast("int")


def layouts_of(cell: ColumnOrName) -> Column:
    """The layouts that can read a cell, as bits; null for a null or blank cell.

    Shapes and the ranges of day and month are looked at, nothing is parsed.
    """
    cell = F.trim(_col(cell))
    shapes: dict[str, int] = {}
    for i, (shape, _, _) in enumerate(LAYOUTS):
        shapes[shape] = shapes.get(shape, 0) | 1 << i
    fits = reduce(lambda a, b: a + b, [F.when(cell.rlike(shape), F.lit(mask)).otherwise(F.lit(0)) for shape, mask in shapes.items()])
    one, two = _number(cell, 1), _number(cell, 2)
    month_first = F.when(one.between(1, 12) & two.between(1, 31), F.lit(_ALL)).otherwise(F.lit(_ALL - _MONTH_FIRST))
    day_first = F.when(two.between(1, 12) & one.between(1, 31), F.lit(_ALL)).otherwise(F.lit(_ALL - _DAY_FIRST))
    return F.when(cell != "", fits.bitwiseAND(month_first).bitwiseAND(day_first))


def column_layouts(cells: DataFrame, keys: Sequence[str], bits: str = "bits") -> DataFrame:
    """``(keys..., common, day_first)`` from the ``bits`` of cells: what reads all cells of a column, and its order of day and month.

    Days come first where a cell can be read in no other order and no cell asks
    for the opposite. Both are aggregates of bits, merged map-side. A cell that no
    layout reads is left out, blank ones as well.
    """
    month, day = F.col(bits).bitwiseAND(_MONTH_FIRST) != 0, F.col(bits).bitwiseAND(_DAY_FIRST) != 0
    return cells.where(F.col(bits) > 0).groupBy(*keys).agg(
        F.bit_and(bits).alias("common"), (F.bool_or(day & ~month) & ~F.bool_or(month & ~day)).alias("day_first")
    )


def cast_mixed(cell: ColumnOrName, layout: ColumnOrName) -> Column:
    """A cell as timestamp by the first of the layouts in ``layout``; null where there is none."""
    cell, layout = F.trim(_col(cell)), _col(layout)
    out = F.lit(None).cast("timestamp_ntz")
    for i, (_, pattern, _) in reversed(list(enumerate(LAYOUTS))):
        out = F.when(layout.bitwiseAND(1 << i) != 0, _parse(cell, pattern)).otherwise(out)
    return out


def cast_mixed_columns(rows: DataFrame, keys: Sequence[str], cell: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the date of ``cell``, read as the column it belongs to, one for each of ``keys``, is written.

    A cell is read by the first layout its column has in common, else by the first
    that reads the cell itself. Of layouts that differ in the order of day and
    month the column chooses, month first where it says nothing; a cell that
    cannot be read in that order is read in the other. What no layout reads is
    null. A null key is a column as well; names that begin with ``_mixed`` are
    taken.
    """
    marked = rows.withColumn("_mixed_bits", layouts_of(cell))
    known = column_layouts(marked, keys, "_mixed_bits")
    known = known.select(*[F.col(k).alias(f"_mixed_{k}") for k in keys], F.col("common").alias("_mixed_common"), F.col("day_first").alias("_mixed_day"))
    met = marked.join(known, [F.col(k).eqNullSafe(F.col(f"_mixed_{k}")) for k in keys], "left")
    bits, both = F.col("_mixed_bits"), F.col("_mixed_bits").bitwiseAND(F.col("_mixed_common"))
    chosen = F.when(both != 0, both).otherwise(bits)
    wanted = F.when(F.col("_mixed_day"), F.lit(_ALL - _MONTH_FIRST)).otherwise(F.lit(_ALL - _DAY_FIRST))

    def read(layout: Column) -> Column:
        ordered = layout.bitwiseAND(wanted)
        return F.transform(F.array(F.when(ordered != 0, ordered).otherwise(layout)), lambda one: cast_mixed(cell, one))[0]

    # Bound by name, each step is computed once and not copied into all that use it.
    return met.withColumn(name, F.transform(F.array(chosen), read)[0]).select(*rows.columns, name)
