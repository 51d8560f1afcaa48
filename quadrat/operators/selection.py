"""Selections: what a user filters on, and the predicate it becomes.

Facets are ANDed; the values of one facet are ORed. A ``Selection`` never changes; a
failed edit therefore leaves the old one as it was.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import PlotDataError
from ..functions import geometry
from ..functions.dates import parse_date
from ..model import QUERY_FACETS, SAMPLES, SurveyTables

# Facets whose value is one literal rather than a list of vocabulary entries.
SCALAR_FACETS = ("spatial", "date_from", "date_to", "soil_depth_range", "has_image")
# Facets whose values are taken as they are.
LITERAL_FACETS = SCALAR_FACETS + ("soil_subsite_id",)
ALIASES = {"soil_subsite": "soil_subsite_id"}
# Longer value lists become a semi-join instead of an IN list.
IN_LIST_LIMIT = 1000

FACET_COLUMNS = {
    "project": "dataset",
    "site_visit_id": "visit_id",
    "speciesname": "scientific_name",
}


@dataclass(frozen=True)
class Selection:
    """Facet -> tuple of values (or one literal), for one kind of table."""

    mode: str
    values: Mapping[str, Any] = field(default_factory=dict)

    # --- edits --------------------------------------------------------------------

    def check_keys(self, keys: Iterable[str]) -> None:
        unknown = sorted(set(keys) - set(QUERY_FACETS[self.mode]))
        if unknown:
            raise PlotDataError(
                f"No such facet: {', '.join(unknown)}. Known: {', '.join(QUERY_FACETS[self.mode])}."
            )

    def add(self, spark, edits: Mapping[str, Any]) -> "Selection":
        """Merge edits: lists grow, literals are replaced, ``None`` is passed over."""
        merged: dict[str, Any] = {}
        for name, value in edits.items():
            name = ALIASES.get(name, name) if self.mode == SAMPLES else name
            if value is None:
                continue
            both = name in merged and name not in SCALAR_FACETS
            merged[name] = _as_list(merged[name]) + _as_list(value) if both else value
        if self.mode != SAMPLES and "has_image" in merged:
            raise PlotDataError("Only samples can be filtered by has_image.")
        self.check_keys(merged)
        if "region" in merged and not {"region_type"} & (merged.keys() | self.values.keys()):
            raise PlotDataError("Give a region_type with, or before, a region.")
        out = dict(self.values)
        for name, value in merged.items():
            if name in SCALAR_FACETS:
                out[name] = _literal(spark, name, value)
            else:
                items = _as_list(value)
                if name == "soil_subsite_id":
                    items = [_whole_number(v) for v in items]
                out[name] = tuple(dict.fromkeys([*out.get(name, ()), *items]))
        return replace(self, values=out)

    def drop(self, edits: Mapping[str, Any]) -> "Selection":
        """Remove whole facets (``None``) or single values."""
        self.check_keys(edits)
        if self.mode == SAMPLES and "dataset" in edits:
            raise PlotDataError("Samples always belong to the required dataset; it stays.")
        out = dict(self.values)
        for name, value in edits.items():
            if name not in out:
                raise KeyError(f"Nothing is selected on {name!r}.")
            if value is None:
                del out[name]
                continue
            if name in SCALAR_FACETS:
                raise PlotDataError(f"{name!r} is one literal: clear it with None.")
            gone = _as_list(value)
            missing = [v for v in gone if v not in out[name]]
            if missing:
                raise PlotDataError(f"Not selected on {name!r}: {missing}")
            kept = tuple(v for v in out[name] if v not in gone)
            if kept:
                out[name] = kept
            else:
                del out[name]
        if "region_type" not in out:
            out.pop("region", None)
        return replace(self, values=out)

    # --- predicate ----------------------------------------------------------------

    def predicate(self, columns: Iterable[str], depth_mode: str = "overlap") -> Column | None:
        """The part of the selection that is a plain Column over one table."""
        have = set(columns)
        tests = []
        for name, value in self.values.items():
            if name in ("region_type", "region"):
                continue
            if name not in SCALAR_FACETS:
                column = facet_column(name, have)
                if not _is_long(name, value):
                    tests.append(F.col(column).isin(*value))
            elif name == "spatial":
                tests.append(geometry.in_bbox_or_shape(F.col("lon"), F.col("lat"), value))
            elif name == "soil_depth_range":
                tests.append(depth_test(*value, mode=depth_mode))
            elif name == "has_image":
                tests.append(has_image(F.col("sample_images")) if value else F.lit(True))
        dates = date_test(
            F.col("visit_time" if "visit_time" in have else "visit_date"),
            self.values.get("date_from"),
            self.values.get("date_to"),
        )
        if dates is not None:
            tests.append(dates)
        return reduce(and_, tests) if tests else None

    def apply(self, df: DataFrame, tables: SurveyTables, depth_mode: str = "overlap") -> DataFrame:
        """Filter one table: column tests first, then semi-joins."""
        test = self.predicate(df.columns, depth_mode)
        out = df if test is None else df.where(test)
        for name, value in self.values.items():
            if _is_long(name, value):
                column = facet_column(name, set(df.columns))
                wanted = df.sparkSession.createDataFrame([(str(v),) for v in value], f"`{column}` string")
                wanted = wanted.select(F.col(column).cast(df.schema[column].dataType))
                out = out.join(wanted, column, "left_semi")
        if "region_type" in self.values:
            out = in_regions(
                out, tables.site_region, self.values["region_type"], self.values.get("region", ())
            )
        return out

    # --- saving -------------------------------------------------------------------

    def rows(self, spec_id: str) -> list[tuple[str, str, str, str]]:
        """This selection as rows of a ``spec`` table; literals go under their own name."""
        out = []
        for name, value in self.values.items():
            if name in ("date_from", "date_to"):
                out.append((spec_id, name, name, value))
            elif name in SCALAR_FACETS:
                out.append((spec_id, name, name, json.dumps(value)))
            else:
                out += [(spec_id, name, "in", str(v)) for v in value]
        return out

    @classmethod
    def from_rows(cls, mode: str, rows: Iterable[tuple[str, str, str]]) -> "Selection":
        """Selection of (facet, op, value) rows."""
        values: dict[str, Any] = {}
        for name, op, value in rows:
            if op in ("date_from", "date_to"):
                values[name] = value
            elif op != "in":
                loaded = json.loads(value)
                values[name] = tuple(loaded) if name == "soil_depth_range" else loaded
            else:
                item = int(value) if name == "soil_subsite_id" else value
                values[name] = (*values.get(name, ()), item)
        out = cls(mode, values)
        out.check_keys(values)
        return out


def facet_column(name: str, have: set[str]) -> str:
    """Column of a facet: its own name unless the table stores it under another."""
    if name in have:
        return name
    column = FACET_COLUMNS.get(name, name)
    if column not in have:
        raise PlotDataError(f"The table has no column for facet {name!r}.")
    return column


def _as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple, set)) else [value]


def _whole_number(value) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        raise PlotDataError("Sub-site ids are whole numbers.") from None


def _literal(spark, name: str, value):
    if name == "spatial":
        geometry.literal_kind(value)
        return value
    if name == "has_image":
        flag = _as_list(value)
        if len(flag) != 1 or not isinstance(flag[0], bool):
            raise PlotDataError("has_image takes True or False.")
        return flag[0]
    if name == "soil_depth_range":
        return _depth_range(value)
    day = spark.range(1).select(parse_date(F.lit(str(value))).alias("day")).first()["day"]
    if day is None:
        raise PlotDataError(
            f"{value!r} is not a date. Write it day first (21/5/2020, 21 May 2020) or as 2020-05-21."
        )
    return day.isoformat()


def _depth_range(value) -> tuple[float, float]:
    if isinstance(value, Mapping):
        ends = [value.get("min"), value.get("max")]
    else:
        ends = _as_list(value)
    if len(ends) != 2:
        raise PlotDataError("A depth range has two ends: [min, max] or a mapping with min and max.")
    try:
        low, high = (float(v) for v in ends)
    except (TypeError, ValueError):
        raise PlotDataError("The ends of a depth range are numbers (metres).") from None
    if high <= low:
        raise PlotDataError("A depth range must end below where it starts (max > min).")
    return low, high


# --- single tests -----------------------------------------------------------------


def _is_long(name: str, value) -> bool:
    """Whether a facet's values go into a semi-join; both forms keep the same rows."""
    listed = name not in SCALAR_FACETS and name not in ("region_type", "region")
    return listed and len(value) > IN_LIST_LIMIT


def date_test(column: Column, date_from: str | None, date_to: str | None) -> Column | None:
    """Both ends inclusive, as a half-open range that Parquet statistics can use."""
    tests = []
    if date_from is not None:
        tests.append(column >= F.lit(date_from).cast("date"))
    if date_to is not None:
        tests.append(column < F.date_add(F.lit(date_to).cast("date"), 1))
    return reduce(and_, tests) if tests else None


def depth_test(low: float, high: float, mode: str = "overlap") -> Column:
    top, bottom = F.col("soil_depth_min"), F.col("soil_depth_max")
    if mode == "overlap":
        return (top <= high) & (bottom >= low)
    if mode == "within":
        return (top >= low) & (bottom <= high)
    raise PlotDataError("Depth mode is 'overlap' or 'within'.")


def _is_text(item: Column) -> Column:
    return F.schema_of_variant(item) == "STRING"


def _non_blank(item: Column) -> Column:
    text = F.try_variant_get(item, "$", "string")
    return F.coalesce(_is_text(item) & (F.length(F.trim(text)) > 0), F.lit(False))


def has_image(images: Column) -> Column:
    """A list with a non-blank text, or with a map that has a non-blank text value.

    ``images`` is a VARIANT or the JSON text of one.
    """
    cell = F.try_parse_json(images.cast("string"))
    items = F.try_variant_get(cell, "$", "array<variant>")

    def good(item: Column) -> Column:
        entries = F.map_values(F.try_variant_get(item, "$", "map<string,variant>"))
        return _non_blank(item) | F.coalesce(F.exists(entries, _non_blank), F.lit(False))

    return F.coalesce(F.exists(items, good), F.lit(False))


def in_regions(df: DataFrame, site_region: DataFrame, region_types, regions=()) -> DataFrame:
    """Rows whose site belongs to one of the regions (or to any of the region types)."""
    member = F.col("region_type").isin(*region_types)
    if regions:
        member &= F.col("region").isin(*regions)
    # distinct sites first: once they are counted, AQE broadcasts few and leaves the facts in place
    sites = site_region.where(member).select("site_id").distinct()
    return df.join(sites, "site_id", "left_semi")
