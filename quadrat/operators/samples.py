"""Clean-up of sample documents: drop, lift, label, and remove empty columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import CODED_SAMPLE_FIELDS, DROPPED_SAMPLE_FIELDS, DROPPED_SAMPLE_PREFIX
from .lookup import add_label, add_label_list, unwrap


def drop_internal(df: DataFrame) -> DataFrame:
    """Without the fields that only serve the portal."""
    return df.select(
        *[
            F.col(f"`{c}`")
            for c in df.columns
            if c not in DROPPED_SAMPLE_FIELDS and not c.startswith(DROPPED_SAMPLE_PREFIX)
        ]
    )


def igsn_label(information: Column) -> Column:
    """``[{value: {label}}]`` -> label."""
    return F.try_variant_get(information, "$[0].value.label", "string")


def first_value(cell: Column) -> Column:
    """``value`` of a map, or of the first item of a list of maps."""
    return F.coalesce(
        F.try_variant_get(cell, "$[0].value", "string"), F.try_variant_get(cell, "$.value", "string")
    )


def lift(df: DataFrame) -> DataFrame:
    """``igsn_information`` -> ``igsn``; ``visit_start_date`` -> ``visit_date``."""
    renamed = {
        "igsn_information": igsn_label(F.col("igsn_information")).alias("igsn"),
        "visit_start_date": first_value(F.col("visit_start_date")).alias("visit_date"),
    }
    return df.select(*[renamed.get(c, F.col(f"`{c}`")) for c in df.columns])


def pick_label(cell: Column) -> Column:
    """Label of a loosely typed cell.

    Looked for, in turn: ``label``; in ``value`` its label, then its value; in
    ``current`` the same. The cell, ``value`` and ``current`` may each be a map or a
    list whose first item is one.
    """
    def kind(path: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.try_variant_get(cell, path, "variant")), F.lit("VOID"))

    def text(path: str) -> Column:
        return F.try_variant_get(cell, path, "string")

    def below(root: str) -> Column:
        label = text(f"{root}.label")
        # an empty label counts as absent
        return F.coalesce(F.when(label != "", label), text(f"{root}.value"))

    def at(root: str) -> Column:
        members = F.try_variant_get(cell, root, "map<string,variant>")
        result = F.when(F.map_contains_key(members, "label"), text(f"{root}.label"))
        for name in ("value", "current"):
            for path in (f"{root}.{name}[0]", f"{root}.{name}"):
                result = result.when(kind(path).startswith("OBJECT"), below(path))
        return result

    return F.when(kind("$").startswith("OBJECT"), at("$")).when(
        kind("$[0]").startswith("OBJECT"), at("$[0]")
    )


def label_codes(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Codes of the coded fields -> labels, unknown codes kept; lists of one unwrapped."""
    for name in CODED_SAMPLE_FIELDS:
        if name not in df.columns:
            continue
        if dict(df.dtypes)[name].startswith("array"):
            df = add_label_list(df, vocab, name, name, "_labels")
            df = df.withColumn(name, unwrap(F.col("_labels"))).drop("_labels")
        else:
            df = add_label(df, vocab, name, name, name)
    return df


def drop_empty_columns(df: DataFrame, images: str = "sample_images") -> DataFrame:
    """Without columns that are NULL in every row, found by one aggregation.

    An image column in which no row has a non-empty list goes too.
    """
    def filled(name: str) -> Column:
        if name == images:
            cell = F.try_parse_json(F.col(name).cast("string"))
            return F.when(F.size(F.try_variant_get(cell, "$", "array<variant>")) > 0, 1)
        return F.col(f"`{name}`")

    # one row, one number per column
    counts = df.agg(*[F.count(filled(c)).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    if not any(counts):
        return df
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if counts[str(i)]])


def clean_samples(df: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """Drop, lift, label: the whole clean-up short of ``drop_empty_columns``."""
    df = drop_internal(df)
    if {"igsn_information", "visit_start_date"} & set(df.columns):
        df = lift(df)
    return df if vocab is None else label_codes(df, vocab)
