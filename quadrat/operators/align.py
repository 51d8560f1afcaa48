"""Union of tables with different columns, and the export-time text filler."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import PlotDataError
from ..functions.geometry import point_wkt
from ..model import MISSING_TEXT

LON, LAT = "longitude_Degree", "latitude_Degree"


def stack_tables(frames: list[DataFrame], fill: bool = False) -> DataFrame:
    """Rows of all frames under the union of their columns, in first-seen order.

    Missing cells are NULL and types stay. ``fill`` shows every missing cell as "N/A",
    which turns the columns into text; use it at the edge only.
    """
    if not frames:
        raise PlotDataError("Nothing to align.")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return fill_missing(out) if fill else out


def fill_missing(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TEXT)).alias(c) for c in df.columns]
    )


def add_point(df: DataFrame, lon: str = LON, lat: str = LAT) -> DataFrame:
    """Add ``geometry`` (WKT); NULL when a coordinate is missing or is not a number."""
    if {lon, lat} <= set(df.columns):
        return df.withColumn("geometry", point_wkt(F.col(lon), F.col(lat)))
    return df.withColumn("geometry", F.lit(None).cast("string"))


def set_algebra(current, resolved, removed, matched, corrected):
    """The three set steps a selection edit needs, over array columns."""
    return (
        F.array_sort(F.array_union(current, resolved)),
        F.array_sort(F.array_except(current, removed)),
        F.array_sort(F.array_except(matched, corrected)),
    )
