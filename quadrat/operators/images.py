"""Image cells: union-typed values that hold image URLs somewhere."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import DEFAULT_IMAGE, IMAGE_KEYS, IMAGE_ORDER, IMAGE_ORDER_OTHER
from ..session import ship_with_tasks

ship_with_tasks(__name__)

OPTIONS_TYPE = "array<struct<label:string,url:string>>"


LEAF = ["cell", "place", "listed", "label", "url"]


def _leaves(number: int, cell) -> list[tuple]:
    """All image texts of one decoded cell, in document order.

    ``place`` is where the outermost list around a text begins, or the text itself where
    there is none: the images of such a list are shown together.
    """
    found: list[tuple] = []
    todo = [(cell, "image", None)]
    while todo:
        value, label, within = todo.pop()
        if isinstance(value, str):
            if label is not None and value.strip():
                at = len(found) if within is None else within
                found.append((number, at, within is not None, label, value))
        elif isinstance(value, list):
            start = len(found) if within is None else within
            todo += [(v, "image", start) for v in reversed(value)]
        elif isinstance(value, dict):
            keyed = [(v, k if k in IMAGE_KEYS else None, within) for k, v in value.items()]
            todo += reversed(keyed)
    return found


def _decoded(text: str | None):
    try:
        return None if text is None else json.loads(text)
    except ValueError:
        return text


def image_options(cell: Column) -> Column:
    """Ordered ``array<struct<label,url>>`` of a JSON cell, nested to any depth.

    A text is an image itself, a map names its images by key. The images of a list come
    best size first, and a URL in it counts once, under its first label. Nesting without a
    bound has no Catalyst expression: the texts of an Arrow batch of cells are laid out as
    one table, which is then deduplicated and sorted as a whole.
    """

    @F.pandas_udf(OPTIONS_TYPE)
    def options(cells: pd.Series) -> pd.Series:
        rows = [leaf for k, text in enumerate(cells) for leaf in _leaves(k, _decoded(text))]
        table = pd.DataFrame(rows, columns=LEAF)
        again = table["listed"].astype(bool) & table.duplicated(["cell", "place", "url"])
        table = table[~again]
        size = table["label"].map(IMAGE_ORDER).fillna(IMAGE_ORDER_OTHER)
        listed = table["listed"].astype(bool)
        table = table.assign(size=size.where(listed, 0), name=table["label"].where(listed, ""))
        table = table.sort_values(["cell", "place", "size", "name"], kind="stable")
        pairs = [{"label": a, "url": u} for a, u in zip(table["label"], table["url"])]
        ends = table["cell"].searchsorted(range(len(cells) + 1)) if len(table) else [0] * (len(cells) + 1)
        return pd.Series([pairs[a:b] for a, b in zip(ends, ends[1:])], dtype="object")

    return options(cell)


def default_image(options: Column) -> Column:
    """The last 1280 thumbnail, else the first option, else NULL."""
    preferred = F.filter(options, lambda o: o["label"] == DEFAULT_IMAGE)
    pick = F.when(F.size(preferred) > 0, F.element_at(preferred, -1)).when(
        F.size(options) > 0, F.element_at(options, 1)
    )
    return pick["url"]


def row_label(name: Column, identifier: Column, number: Column) -> Column:
    """Sample name, else its id, else ``Sample <n>``."""
    return F.coalesce(
        name.cast("string"),
        identifier.cast("string"),
        F.concat(F.lit("Sample "), number.cast("string")),
    )
