"""Discovery and aggregates over the selected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import upper_name
from ..model import IGSN_PREFIX, MATERIAL_SAMPLE_TYPES, PLANT_TISSUE, PLANT_VOUCHER
from ..model import SOIL_METAGENOMIC, SOIL_PIT, SOIL_SUBSITE
from ..errors import PlotDataError
from ..session import cut_lineage
from .flatten import attribute_keys
from .lookup import broadcast_if_small, facet_vocab

# Aggregate -> sample types of which one must be selected.
REQUIRED_SAMPLE_TYPES = {
    "soil_depth_range": (SOIL_SUBSITE, SOIL_PIT),
    "soilpit": (SOIL_METAGENOMIC, SOIL_SUBSITE),
    "speciesname": (PLANT_TISSUE, PLANT_VOUCHER),
    "igsn": MATERIAL_SAMPLE_TYPES,
}


def require_sample_type(selected_labels, aggregate: str) -> None:
    """Refuse an aggregate unless one of its sample types is selected."""
    required = REQUIRED_SAMPLE_TYPES[aggregate]
    if not set(required) & set(selected_labels):
        raise PlotDataError(
            f"{aggregate} is known for material_sample_type {' or '.join(required)}; "
            f"selected: {', '.join(selected_labels) or 'none'}."
        )


def discover_values(
    rows: DataFrame,
    column: str,
    vocab: DataFrame,
    facet: str,
    codes: str = "label",
    missing: str = "na",
) -> DataFrame:
    """Distinct values of a facet among ``rows`` -> (key, uri).

    The values are made distinct before the lookup, so the vocabulary meets one row per
    value. ``codes`` says whether the column holds labels or URIs.
    """
    found = rows.select(F.col(column).cast("string").alias("code")).distinct()
    found = found.where(F.col("code").isNotNull())
    if codes == "label":
        names = (
            vocab.where(F.col("facet") == facet)
            .groupBy(F.col("label").alias("code"))
            .agg(F.min("uri").alias("uri"))
        )
        return found.join(names, "code", "left").select(F.col("code").alias("key"), "uri")
    names = facet_vocab(vocab, facet).select(F.col("uri").alias("code"), "label")
    key = F.coalesce("label", F.lit("N/A")) if missing == "na" else F.col("label")
    return found.join(names, "code", "left").select(key.alias("key"), F.col("code").alias("uri"))


def discover_attributes(rows: DataFrame, vocab: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Attribute identifiers that occur -> (key, uri); key is NULL when unknown."""
    names = facet_vocab(vocab, "attributes").select(F.col("uri").alias("attribute"), "label")
    return (
        attribute_keys(rows, attrs)
        .join(broadcast_if_small(names), "attribute", "left")
        .select(F.col("label").alias("key"), F.col("attribute").alias("uri"))
    )


def summary(
    rows: DataFrame, unique: dict[str, str], total: str | None = None, approximate: bool = False
) -> DataFrame:
    """(metric, count): rows under ``total`` and distinct values per facet.

    ``unique`` maps a metric to its column. The rows are counted per combination of the
    facets first, combined map-side; the distinct values are those of the combinations, so
    no row of the facts is multiplied. ``approximate`` takes sketches instead.

    The combinations are written: a task then holds them, or the distinct values, not both.
    """
    facets = list(dict.fromkeys(unique.values()))
    cells = cut_lineage(rows.groupBy(*facets).agg(F.count(F.lit(1)).alias("_n")))
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    columns = [distinct(c).alias(m) for m, c in unique.items()]
    if total:
        columns.insert(0, F.coalesce(F.sum("_n"), F.lit(0)).alias(total))
    wide = cells.agg(*columns)
    return wide.unpivot([], wide.columns, "metric", "count")


# Registers of a sketch: 2 ** SKETCH_BITS, a deviation of about 0.8 %.
SKETCH_BITS = 14


def summary_sketches(rows: DataFrame, facet: str, unique: dict[str, str]) -> DataFrame:
    """(value, rows, a sketch per metric) for each value of ``facet``: a table worth keeping.

    Sketches merge: the summary under any filter on the facet needs these rows alone.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(m) for m, c in unique.items()]
    return rows.groupBy(F.col(facet).alias("value")).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def summary_of_sketches(
    sketches: DataFrame, values: list[str] | None = None, total: str | None = None
) -> DataFrame:
    """(metric, count) of the rows whose facet has one of ``values`` (of all without them)."""
    metrics = [c for c in sketches.columns if c not in ("value", "rows")]
    kept = sketches if values is None else sketches.where(F.col("value").isin(values))
    columns = [
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(m)), F.lit(0)).cast("long").alias(m) for m in metrics
    ]
    if total:
        columns.insert(0, F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias(total))
    wide = kept.agg(*columns)
    return wide.unpivot([], wide.columns, "metric", "count")


def soilpit_counts(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("soil_subsite_id").isNotNull())
        .groupBy(F.col("soil_subsite_id").alias("soilpit"))
        .agg(F.count(F.lit(1)).alias("counts"))
    )


def species_counts(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.length(F.trim("scientific_name")) > 0)
        .groupBy(F.col("scientific_name").alias("speciesname"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def soil_depth_range(rows: DataFrame) -> DataFrame:
    """One row: overall ends and two text ranges (NULL when an end is missing)."""
    ends = rows.agg(
        F.min("soil_depth_min").alias("a"),
        F.max("soil_depth_min").alias("b"),
        F.min("soil_depth_max").alias("c"),
        F.max("soil_depth_max").alias("d"),
    )

    def text(low: str, high: str):
        parts = F.col(low).cast("string"), F.lit("-"), F.col(high).cast("string"), F.lit(" m")
        return F.concat(*parts)

    return ends.select(
        F.col("a").alias("overall_depth_min_meter"),
        F.col("d").alias("overall_depth_max_meter"),
        text("a", "c").alias("min_depth_range"),
        text("b", "d").alias("max_depth_range"),
    )


def sample_igsn(rows: DataFrame) -> DataFrame:
    """Distinct sample names -> (upper-case name, identifier)."""
    names = rows.select("sample_name").where(F.length("sample_name") > 0).distinct()
    return names.select(
        upper_name(F.col("sample_name")).alias("sample_name"),
        F.concat(F.lit(IGSN_PREFIX), F.col("sample_name")).alias("igsn"),
    )
