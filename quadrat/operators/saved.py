"""Counts of many saved selections in one pass over the facts.

The selections are numbered, and a set of them is a bitmap: an array of words of WORD bits,
one array per block of BLOCK selections. Each kind of condition is an inverted index from a
value to the selections that accept it (and, once, those that do not ask):

* values of a facet: one row per (selection, value), whatever else the selection names;
* depths: the ends of all ranges cut the line into elementary intervals, along which the
  selections whose range begins or ends are switched over;
* regions: by the set of asked regions that a site lies in; shapes: by the set of shapes that
  hold a point, found by the point-in-polygon join, rings of a part counted even-odd;
* images: by one flag.

The facts are counted once per combination of the columns in use, then per combination of what
the selections can tell apart: a site is replaced by its set of regions, a point by its set of
shapes. Only these combinations meet the indexes, one row of each, and the bitmaps are
intersected: no list of values is multiplied with another. What is left is added up per bitmap
first, then per selection. Dates have no bitmaps: a selection's range takes the difference of
two running counts along the days of each combination it accepts.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import PlotDataError
from ..functions import geometry
from ..session import cut_lineage
from . import spatial
from .lookup import broadcast_if_small, is_small
from .selection import facet_column, has_image

BLOCK, WORD = 2000, 62
RANGES = ("date_from", "date_to", "soil_depth_range")
REGION = ("region_type", "region")
LITERALS = (*RANGES, "has_image", "spatial")


@dataclass
class Specs:
    """Numbered selections and their conditions."""

    ids: DataFrame  # spec_id, block, bit
    rules: DataFrame  # block, bit, facet, value
    blocks: int
    words: int

    def of(self, *facets: str) -> DataFrame:
        return self.rules.where(F.col("facet").isin(*facets))

    def sets(self, rows: DataFrame, *keys: str) -> DataFrame:
        """(keys, block, words): the bitmap of the selections (block, bit) of each key."""
        at = F.floor(F.col("bit") / WORD)
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % WORD).cast("int"))
        words = [
            F.coalesce(F.bit_or(F.when(at == w, mask)), F.lit(0).cast("bigint")) for w in range(self.words)
        ]
        return rows.groupBy(*keys, "block").agg(F.array(*words).alias("words"))

    def others(self, users: DataFrame) -> DataFrame:
        """(block, others): the selections that are not among the users."""
        rest = self.ids.join(users.select("block", "bit").distinct(), ["block", "bit"], "left_anti")
        return self.sets(rest).withColumnRenamed("words", "others")

    def none(self) -> Column:
        return F.array(*[F.lit(0).cast("bigint")] * self.words)


def _numbered(spec: DataFrame) -> Specs:
    ids = spec.select("spec_id").distinct()
    blocks = max(1, math.ceil(ids.count() / BLOCK))
    ids = ids.withColumn("block", F.pmod(F.xxhash64("spec_id"), F.lit(blocks)).cast("int"))
    order = Window.partitionBy("block").orderBy("spec_id")
    ids = cut_lineage(ids.withColumn("bit", F.row_number().over(order) - 1))
    most = ids.agg(F.max("bit")).first()[0]
    rules = spec.join(broadcast_if_small(ids), "spec_id").select("block", "bit", "facet", "value")
    return Specs(ids, cut_lineage(rules.distinct()), blocks, 1 if most is None else most // WORD + 1)


def _both(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseAND(y))


def _either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))


def _along(specs: Specs, points: DataFrame, key: str, ranges: DataFrame) -> DataFrame:
    """(key, block, words): the selections whose range (block, bit, low, high) holds the key.

    An open end is NULL. Beginnings come before the points they hold, ends after them.
    """
    at = F.floor(F.col("bit") / WORD).cast("int").alias("word")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % WORD).cast("int"))
    held = ranges.where(F.col("low").isNull() | F.col("high").isNull() | (F.col("low") <= F.col("high")))
    begins = held.select("block", at, F.col("low").alias("v"), F.lit(0).alias("phase"), mask.alias("mask"))
    ends = held.where(F.col("high").isNotNull()).select(
        "block", at, F.col("high").alias("v"), F.lit(2).alias("phase"), mask.alias("mask")
    )
    switched = begins.union(ends).groupBy("block", "word", "v", "phase").agg(F.bit_xor("mask").alias("mask"))
    stretch = F.explode(F.sequence(F.lit(0), F.lit(specs.words - 1))).alias("word")
    asked = points.select(
        F.explode(F.sequence(F.lit(0), F.lit(specs.blocks - 1))).alias("block"), F.col(key).alias("v")
    ).select("block", stretch, "v", F.lit(1).alias("phase"), F.lit(0).cast("bigint").alias("mask"))
    so_far = Window.partitionBy("block", "word").orderBy(F.col("v").asc_nulls_first(), "phase").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run = switched.union(asked).withColumn("set", F.bit_xor("mask").over(so_far)).where("phase = 1")
    words = [F.coalesce(F.max(F.when(F.col("word") == w, F.col("set"))), F.lit(0).cast("bigint")) for w in range(specs.words)]
    return run.groupBy(F.col("v").alias(key), "block").agg(F.array(*words).alias("words"))


# --- indexes: (keys, block, words) and the selections that ask --------------------------


def _facet(specs: Specs, facet: str, key: str):
    users = specs.of(facet)
    return specs.sets(users.withColumnRenamed("value", key), key), users


def _depths(specs: Specs, cells: DataFrame, key: str, mode: str):
    """One side of the depth test: the top or the bottom of a sample against a range."""
    users = specs.of("soil_depth_range")
    ends = F.from_json("value", "array<double>")
    low, high = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
    open_end = F.lit(None).cast("double")
    at_least = (key == "depth_max") == (mode == "overlap")
    ranges = users.select(
        "block",
        "bit",
        (low if at_least else open_end).alias("low"),
        (open_end if at_least else high).alias("high"),
    )
    points = cells.select(key).where(F.col(key).isNotNull()).distinct()
    return _along(specs, points, key, ranges), users


def _images(specs: Specs):
    users = specs.of("has_image").where(F.col("value") == "true")
    return specs.sets(users.withColumn("image", F.lit(True)), "image"), users


def _of_sets(specs: Specs, sets: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """(key, block, words): the bitmap of a set, given those (member, block, words) of its members."""
    ors = [F.bit_or(F.get("words", F.lit(w))) for w in range(specs.words)]
    members = sets.select(key).distinct().select(key, F.explode(key).alias("member"))
    return members.join(broadcast_if_small(words), "member").groupBy(key, "block").agg(F.array(*ors).alias("words"))


def _regions(specs: Specs, site_region: DataFrame):
    """(site, regions), the index of the sets of regions, and its users.

    Regions of a type that no selection names are one member: none tells them apart.
    """
    users, named = specs.of("region_type"), specs.of("region")
    mark = F.concat(F.lit("="), "value").alias("mark")
    asked_types = users.select(F.col("value").alias("region_type")).distinct()
    asked = named.select(F.col("value").alias("region"), mark).distinct()
    kinds = site_region.select("region_type", "region").where(F.col("region").isNotNull()).distinct()
    kinds = kinds.join(broadcast_if_small(asked_types), "region_type", "left_semi")
    kinds = cut_lineage(kinds.join(broadcast_if_small(asked), "region", "left").fillna("", ["mark"]))
    members = kinds.select("region_type", "mark").distinct()
    members = cut_lineage(members.withColumn("member", F.monotonically_increasing_id()))
    types = specs.sets(users.withColumnRenamed("value", "region_type"), "region_type")
    regions = specs.sets(named.select("block", "bit", mark), "mark").withColumnRenamed("words", "named")
    any_region = F.coalesce("others", specs.none())
    words = (
        members.join(broadcast_if_small(types), "region_type")
        .join(broadcast_if_small(regions), ["mark", "block"], "left")
        .join(F.broadcast(specs.others(named)), "block", "left")
        .select(
            "member", "block", _both(F.col("words"), _either(F.coalesce("named", specs.none()), any_region)).alias("words")
        )
    )
    kinds = kinds.join(broadcast_if_small(members), ["region_type", "mark"]).drop("mark")
    sites = site_region.join(broadcast_if_small(kinds), ["region_type", "region"])
    sites = sites.groupBy(F.col("site_id").cast("string").alias("site"))
    sites = cut_lineage(sites.agg(F.array_sort(F.collect_set("member")).alias("regions")))
    return sites, _of_sets(specs, sites, "regions", cut_lineage(words)), users


def _shapes(specs: Specs, cells: DataFrame):
    """(lon, lat, shapes), the index of the sets of shapes, and its users."""
    users = specs.of("spatial")
    spark = users.sparkSession
    rings, other = [], []
    # the shapes that users saved
    values = [r["value"] for r in users.select("value").distinct().collect()]
    for member, value in enumerate(values):
        literal = json.loads(value)
        if geometry.literal_kind(literal) == "bbox":
            x1, y1, x2, y2 = map(float, literal)
            rings.append((member, 0, 0, [(x1, y1), (x2, y1), (x2, y2), (x1, y2)], True))
            continue
        shape = geometry.read_literal(literal)
        for k, part in enumerate(shape.polygons):
            rings += [(member, k, r, list(ring), False) for r, ring in enumerate(part)]
        if shape.lines or shape.points:
            other.append((member, geometry.Shape(lines=shape.lines, points=shape.points)))
    points = cells.select("lon", "lat").where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()
    table = spark.createDataFrame(
        rings, "member int, part int, no int, ring array<struct<x:double,y:double>>, closed boolean"
    )
    shapes = table.select(F.struct("member", "part", "no").alias("shape_id"), "ring", "closed")
    met = spatial.points_in_polygons(points, shapes)
    inside = met.groupBy("lon", "lat", "shape_id.member", "shape_id.part").agg(F.count(F.lit(1)).alias("n"))
    found = inside.where(F.col("n") % 2 == 1).select("lon", "lat", "member")
    if other:
        on = F.array(*[F.when(geometry.in_shape(F.col("lon"), F.col("lat"), s), F.lit(v)) for v, s in other])
        more = points.select("lon", "lat", F.explode(on).alias("member"))
        found = found.union(more.where(F.col("member").isNotNull()))
    held = cut_lineage(found.groupBy("lon", "lat").agg(F.array_sort(F.collect_set("member")).alias("shapes")))
    numbers = spark.createDataFrame(list(enumerate(values)), "member int, value string")
    words = specs.sets(users.join(F.broadcast(numbers), "value"), "member")
    return held, _of_sets(specs, held, "shapes", cut_lineage(words)), users


def _written(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is small."""
    return F.broadcast(df) if is_small(df) else df.hint("merge")


def _bits(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, block, bit): a row per selection of the bitmap ``accepted``."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit(F.col("w"), b) == 1)
    words = rows.select(*keys, "block", F.posexplode("accepted").alias("at", "w")).where(F.col("w") != 0)
    each = words.select(*keys, "block", "at", F.explode(bits).alias("b"))
    return each.select(*keys, "block", (F.col("at") * WORD + F.col("b")).cast("int").alias("bit"))


def _in_dates(specs: Specs, pairs: DataFrame, days: DataFrame) -> DataFrame:
    """(block, bit, n): rows of the combinations (combination, block, bit) within a selection's dates.

    Per combination the days and the ends of the ranges lie on one line; a range holds the
    difference of the running counts at its ends. An open end comes after all days, and rows
    without a day after it: only selections without dates take them.
    """
    users, day = specs.of("date_from", "date_to"), F.col("value").cast("date")
    ranges = users.groupBy("block", "bit").agg(
        F.max(F.when(F.col("facet") == "date_from", day)).alias("low"),
        F.min(F.when(F.col("facet") == "date_to", day)).alias("high"),
        F.lit(True).alias("dated"),
    )
    ranges = specs.ids.select("block", "bit").join(ranges, ["block", "bit"], "left")
    ranges = ranges.where(F.col("low").isNull() | F.col("high").isNull() | (F.col("low") <= F.col("high")))
    last = F.when(F.col("dated") & F.col("high").isNull(), 0).otherwise(2)
    ends = F.array(
        F.struct(F.col("high").alias("v"), last.alias("phase"), F.lit(1).alias("sign")),
        F.when(F.col("low").isNotNull(), F.struct(F.col("low").alias("v"), F.lit(0).alias("phase"), F.lit(-1).alias("sign"))),
    )
    ranges = ranges.select("block", "bit", F.explode(F.array_compact(ends)).alias("e"))
    asked = pairs.join(broadcast_if_small(cut_lineage(ranges)), ["block", "bit"])
    asked = asked.select("combination", "e.v", "e.phase", F.lit(0).cast("bigint").alias("n"), "block", "bit", "e.sign")
    none = [F.lit(None).cast("int").alias(c) for c in ("block", "bit", "sign")]
    line = asked.union(days.select("combination", "d.day", F.lit(1), "d.n", *none))
    so_far = Window.partitionBy("combination").orderBy(F.col("v").asc_nulls_last(), "phase")
    running = F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = line.withColumn("running", running).where(F.col("sign").isNotNull())
    return ended.groupBy("block", "bit").agg(F.sum(F.col("running") * F.col("sign")).alias("n"))


# --- counting ---------------------------------------------------------------------


def count_selections(
    facts: DataFrame,
    spec: DataFrame,
    facets: list[str],
    date_column: str = "visit_date",
    site_region: DataFrame | None = None,
    depth_mode: str = "overlap",
) -> DataFrame:
    """Rows of ``facts`` under every selection of a ``spec`` table -> (spec_id, rows).

    ``spec`` (spec_id, facet, op, value) holds the rows of ``Selection.rows``; values of
    species are full names. Facets with value lists must be among ``facets``; dates, depths,
    images, shapes and, given ``site_region``, regions can be named as well.
    """
    allowed = [*facets, *LITERALS, *(REGION if site_region is not None else ())]
    if not spec.where(~F.col("facet").isin(*allowed)).isEmpty():
        raise PlotDataError(f"Saved selections may only name {allowed} here.")
    specs = _numbered(spec)
    used = {r["facet"] for r in specs.rules.select("facet").distinct().collect()}
    listed = {f: facet_column(f, set(facts.columns)) for f in facets if f in used}
    columns: dict[str, Column] = {f"in_{f}": F.col(c).cast("string") for f, c in listed.items()}
    if used & {"date_from", "date_to"}:
        columns["day"] = F.col(date_column).cast("date")
    if "soil_depth_range" in used:
        if depth_mode not in ("overlap", "within"):
            raise PlotDataError("Depth mode is 'overlap' or 'within'.")
        columns |= {f"depth_{e}": F.col(f"soil_depth_{e}").cast("double") for e in ("min", "max")}
    if "has_image" in used:
        columns["image"] = has_image(F.col("sample_images"))
    if "region_type" in used:
        columns["site"] = F.col("site_id").cast("string")
    if "spatial" in used:
        columns |= {c: F.col(c).cast("double") for c in ("lon", "lat")}
    counted = facts.select(*[c.alias(n) for n, c in columns.items()]).groupBy(*columns)
    cells = cut_lineage(counted.agg(F.count(F.lit(1)).alias("n")))

    indexes = [((f"in_{f}",), *_facet(specs, f, f"in_{f}")) for f in listed]
    if "depth_min" in columns:
        indexes += [((k,), *_depths(specs, cells, k, depth_mode)) for k in ("depth_min", "depth_max")]
    if "image" in columns:
        indexes.append((("image",), *_images(specs)))
    sets = []
    if "site" in columns:
        sets.append((["site"], "regions", *_regions(specs, site_region)))
    if "lon" in columns:
        sets.append((["lon", "lat"], "shapes", *_shapes(specs, cells)))
    for keys, name, members, index, users in sets:
        cells = cells.join(_written(members), keys, "left").drop(*keys)
        indexes.append(((name,), index, users))
    kept = [c for c in cells.columns if c not in ("day", "n")]
    if "day" in columns:
        # as many days as the calendar has
        cells = cells.groupBy(*kept, "day").agg(F.sum("n").alias("n"))
        cells = cells.groupBy(*kept).agg(F.collect_list(F.struct("day", "n")).alias("days"))
        cells = cut_lineage(cells.withColumn("combination", F.monotonically_increasing_id()))
    elif sets:
        cells = cut_lineage(cells.groupBy(*kept).agg(F.sum("n").alias("n")))

    blocks = F.explode(F.sequence(F.lit(0), F.lit(specs.blocks - 1)))
    all_set = F.array(*[F.lit((1 << WORD) - 1).cast("bigint")] * specs.words)
    rows = cells.drop("days").withColumn("block", blocks).withColumn("accepted", all_set)
    for keys, index, users in indexes:
        # written: an index is as large as what the selections name
        index = broadcast_if_small(cut_lineage(index))
        rows = rows.join(index, [*keys, "block"], "left").join(F.broadcast(specs.others(users)), "block", "left")
        mine = _either(F.coalesce("words", specs.none()), F.coalesce("others", specs.none()))
        rows = rows.withColumn("accepted", _both(F.col("accepted"), mine)).drop("words", "others", *keys)
        rows = rows.where(F.exists("accepted", lambda w: w != 0))
    if "day" in columns:
        counts = _in_dates(specs, _bits(rows, "combination"), cells.select("combination", F.explode("days").alias("d")))
    else:
        sums = rows.groupBy("block", "accepted").agg(F.sum("n").alias("n"))
        counts = _bits(sums, "n").groupBy("block", "bit").agg(F.sum("n").alias("n"))
    return specs.ids.join(counts, ["block", "bit"], "left").select(
        "spec_id", F.coalesce("n", F.lit(0)).cast("long").alias("rows")
    )
