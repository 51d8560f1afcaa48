"""Vocabulary lookups: code to label, and the size-checked broadcast they use."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import MISSING_TEXT
from ..session import cut_lineage

# What may be broadcast. Beyond either bound the join is a sort-merge join, which AQE
# splits where a key is hot.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def _width(name: str, kind: str):
    """Rough bytes of one value."""
    if kind == "string":
        return F.length(F.col(f"`{name}`"))
    if kind.startswith("array"):
        return F.size(F.col(f"`{name}`")) * 40
    return F.lit(8)


def is_small(df: DataFrame) -> bool:
    """Measure whether ``df`` may be broadcast; reads no more than the row bound."""
    width = reduce(add, [F.coalesce(_width(*c), F.lit(0)) for c in df.dtypes])
    rows, size = (
        df.limit(BROADCAST_ROWS + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)))
        .first()
    )
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast what was measured to be small; anything else is written and merge-joined.

    AQE splits a hot key only between two plain exchanges. Reading the written table is
    one, where an aggregate that feeds the join itself would not be.
    """
    return F.broadcast(df) if is_small(df) else cut_lineage(df).hint("merge")


def facet_vocab(vocab: DataFrame, facet: str) -> DataFrame:
    """(uri, label) of one facet; a URI listed twice keeps its smallest label."""
    return (
        vocab.where(F.col("facet") == facet)
        .where(F.col("uri").isNotNull())
        .groupBy("uri")
        .agg(F.min("label").alias("label"))
    )


def add_label(
    df: DataFrame, vocab: DataFrame, facet: str, code: str, out: str, missing: str = "keep"
) -> DataFrame:
    """Add the label of a code column.

    ``missing``: ``keep`` the code, ``na`` for the text "N/A", ``null`` for NULL.
    """
    names = facet_vocab(vocab, facet).select(
        F.col("uri").alias("_uri"), F.col("label").alias("_label")
    )
    joined = df.join(broadcast_if_small(names), F.col(code) == F.col("_uri"), "left")
    fallback = {"keep": F.col(code), "na": F.lit(MISSING_TEXT), "null": F.lit(None)}[missing]
    return joined.withColumn(out, F.coalesce("_label", fallback)).drop("_uri", "_label")


def add_label_list(
    df: DataFrame, vocab: DataFrame, facet: str, codes: str, out: str
) -> DataFrame:
    """Labels of an array of codes, in order, unknown codes kept, NULLs dropped.

    The codes are labelled once per *distinct* list, not per row: a list that a third
    of the rows share is looked up once. The labelled lists are written first, so the
    last join knows their true size and leaves the rows where they are if it is small.
    """
    lists = df.select(codes).where(F.size(codes) > 0).distinct()
    items = lists.select(codes, F.posexplode(codes).alias("_pos", "_code"))
    items = items.where(F.col("_code").isNotNull())
    named = (
        add_label(items, vocab, facet, "_code", "_name")
        .groupBy(codes)
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_name"))).alias("_pairs"))
        .select(codes, F.transform("_pairs", lambda p: p["_name"]).alias(out))
    )
    return df.join(cut_lineage(named), codes, "left")


def unwrap(labels: Column) -> Column:
    """A list of one is shown as its item, a longer one as JSON text, none as NULL."""
    return (
        F.when(F.size(labels) == 1, F.element_at(labels, 1))
        .when(F.size(labels) > 1, F.to_json(labels))
    )


def sites_of_samples(site_region: DataFrame, samples: DataFrame) -> DataFrame:
    """Region memberships of the sites that have rows.

    The sites are made distinct first: a site with a third of all rows is then one row,
    combined map-side, and not the load of one task of the semi-join.
    """
    return site_region.join(samples.select("site_id").distinct(), "site_id", "left_semi")


def regions_wide(
    site_region: DataFrame, region_types: list[str], key: str = "site_id"
) -> DataFrame:
    """One row per site, one column per region type (known types: no extra job)."""
    return site_region.groupBy(key).pivot("region_type", region_types).agg(F.min("region"))


def regions_from_map(df: DataFrame, column: str, region_types: list[str]) -> DataFrame:
    """Spread a map of region type -> region into columns; rows without one stay."""
    spread = [F.col(column)[t].alias(t) for t in region_types]
    return df.select(*[c for c in df.columns if c != column], *spread)
