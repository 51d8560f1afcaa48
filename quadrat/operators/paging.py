"""Previews, pages and ordered de-duplication, all with a fixed total order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import PlotDataError
from ..session import cut_lineage

PREVIEW_TYPES = 2
PREVIEW_ROWS = 5
PREVIEW_LIMIT = 10

# Pages that end within this many rows are a top-k; deeper ones are narrowed down by
# counting, so that no task has to hold all rows before the page.
TOP_K_ROWS = 100_000
# Quantiles that one round of narrowing cuts a range at.
CUTS = 64
COUNTED_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def preview_by_type(
    rows: DataFrame, type_column: str, order: list[str], types: int = PREVIEW_TYPES,
    per_type: int = PREVIEW_ROWS,
) -> DataFrame:
    """First rows of the first few types.

    The rank filter becomes a per-task group limit before the shuffle, so a type with
    most of the rows still sends only a few rows per task.
    """
    first_types = rows.select(type_column).where(F.col(type_column).isNotNull()).distinct()
    first_types = first_types.orderBy(type_column).limit(types)
    chosen = rows.join(F.broadcast(first_types), type_column, "left_semi")
    rank = F.row_number().over(Window.partitionBy(type_column).orderBy(*order))
    return (
        chosen.withColumn("_n", rank)
        .where(F.col("_n") <= per_type)
        .drop("_n")
        .orderBy(type_column, *order)
        .limit(PREVIEW_LIMIT)
    )


def preview(rows: DataFrame, order: list[str], limit: int = PREVIEW_LIMIT) -> DataFrame:
    return rows.orderBy(*order).limit(limit)


def page(
    rows: DataFrame, order: list[str], number: int, size: int, top_k_rows: int = TOP_K_ROWS
) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows. ``order`` must be a total order."""
    if number < 1 or size < 1:
        raise PlotDataError("Page number and page size start at 1.")
    first = (number - 1) * size
    parts = _slices(rows, order, 0, first, size, top_k_rows)
    return reduce(DataFrame.union, parts).orderBy(*order) if parts else rows.limit(0)


def _slices(
    rows: DataFrame, order: list[str], depth: int, first: int, size: int, top_k_rows: int
) -> list[DataFrame]:
    """Rows ``first`` to ``first + size`` as a few parts.

    A round cuts the range of one order column at its quantiles and counts the rows
    between the cuts: two aggregations, no sort. Ranges before the page are left out by a
    filter, ranges within it are taken whole, and the one or two it ends in are cut
    again. A value that fills quantiles of its own is a range by itself and goes on with
    the next order column.
    """
    if first + size <= top_k_rows or depth == len(order):
        return [rows.orderBy(*order).offset(first).limit(size)]
    key = order[depth]
    if dict(rows.dtypes)[key] not in COUNTED_TYPES:
        return [_sorted_ranges(rows, order, first, size)]
    at = [i / CUTS for i in range(CUTS + 1)]
    found = rows.select(F.percentile_approx(key, at).alias("cuts")).first()["cuts"]
    cuts = sorted({c for c in found or () if c == c})  # NaN sorts behind every cut
    parts, start = [], 0
    # one row per range
    counted = rows.groupBy(_range_number(key, cuts).alias("r")).count().orderBy("r")
    for number, count in counted.collect():
        skip, take = max(first - start, 0), min(start + count, first + size) - max(start, first)
        start += count
        if take <= 0:
            continue
        part = rows.where(_in_range(key, cuts, number))
        if take == count:
            parts.append(part)
        else:
            one_value = number < 0 or number % 2 == 1
            parts += _slices(part, order, depth + one_value, skip, take, top_k_rows)
    return parts


def _range_number(key: str, cuts: list) -> Column:
    """-1 for NULL, odd for the cuts themselves, even for what lies between them."""

    def below(low: int, high: int) -> Column:
        """How many cuts are smaller, by halving."""
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(key) > F.lit(cuts[mid]), below(mid + 1, high)).otherwise(below(low, mid))

    on_cut = F.when(F.col(key).isin(*cuts), 1).otherwise(0) if cuts else F.lit(0)
    return F.when(F.col(key).isNull(), -1).otherwise(2 * below(0, len(cuts)) + on_cut)


def _in_range(key: str, cuts: list, number: int) -> Column:
    if number < 0:
        return F.col(key).isNull()
    if number % 2:
        return F.col(key) == F.lit(cuts[number // 2])
    test, i = F.col(key).isNotNull(), number // 2
    if i > 0:
        test &= F.col(key) > F.lit(cuts[i - 1])
    if i < len(cuts):
        test &= F.col(key) < F.lit(cuts[i])
    return test


def _sorted_ranges(rows: DataFrame, order: list[str], first: int, size: int) -> DataFrame:
    """For text keys: range-partition, count each range, sort only those the page touches."""
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    wanted, start, before = [], 0, None
    # one row per range
    for number, count in ranged.groupBy("_range").count().orderBy("_range").collect():
        end = start + count
        if end > first and start < first + size:
            wanted.append(number)
            before = start if before is None else before
        start = end
    part = ranged.where(F.col("_range").isin(*wanted)) if wanted else ranged.limit(0)
    return part.drop("_range").orderBy(*order).offset(first - (before or 0)).limit(size)


def first_occurrence(rows: DataFrame, key: list[str], position: Column) -> DataFrame:
    """(key, first position) of each distinct key: a hash aggregate, combined map-side."""
    return rows.groupBy(*key).agg(F.min(position).alias("first_position"))
