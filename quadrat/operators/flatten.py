"""Nested survey documents to flat observation rows.

Everything here is a projection or an explode: one narrow plan without a shuffle, the
same for a batch and for a stream. The input is a column ``feature`` of the type
``model.FEATURE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..model import OBSERVATION_ITEM

# This many attribute columns at most; rarer attributes stay together in the map.
MAX_WIDE_KEYS = 5000
NO_ATTRS = "CAST(map() AS MAP<STRING, STRING>)"


def _get(struct: Column, name: str) -> Column:
    return struct.getField(name)


def base_context(df: DataFrame) -> DataFrame:
    """Dataset and site fields of each feature, its geometry, and the visits still nested.

    A geometry of any type gives its WKT and bounds. ``lon`` and ``lat`` are those of a
    point, and the middle of the bounds for anything else.

    Here and below, an attribute bag is flattened on the level it belongs to, once, and
    not again for every row that level is exploded into.
    """
    props = _get(F.col("feature"), "properties")
    dataset, site = _get(props, "dataset"), _get(props, "site")
    in_dataset = flatten_bag_sql(
        "feature.properties.dataset.`dataset.attributes`", "dataset.attributes"
    )
    in_site = flatten_bag_sql("feature.properties.site.`site.attributes`", "site.attributes")
    shape = "feature.geometry"
    placed = df.withColumn("bounds", F.expr(geometry.bounds_sql(shape)))
    return placed.select(
        _get(dataset, "dataset.title").alias("dataset_title"),
        _get(dataset, "dataset.link").alias("dataset_link"),
        _get(site, "site.name").alias("site_name"),
        _get(site, "site.link").alias("site_link"),
        F.expr(
            f"map_concat(coalesce({in_dataset}, {NO_ATTRS}), coalesce({in_site}, {NO_ATTRS}))"
        ).alias("attrs"),
        ((F.col("bounds.minx") + F.col("bounds.maxx")) / 2).alias("lon"),
        ((F.col("bounds.miny") + F.col("bounds.maxy")) / 2).alias("lat"),
        F.expr(geometry.wkt_sql(shape)).alias("geometry_wkt"),
        *[F.col(f"bounds.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")],
        _get(props, "siteVisit").alias("visits"),
    )


def explode_visits(base: DataFrame) -> DataFrame:
    """One row per visit; a feature without visits keeps one row."""
    visit = F.col("visit")
    return base.withColumn("visit", F.explode_outer("visits")).select(
        *[c for c in base.columns if c not in ("visits", "attrs")],
        _get(visit, "siteVisit.id").alias("visit_id"),
        _get(visit, "siteVisit.name").alias("visit_name"),
        _get(visit, "siteVisit.date").alias("visit_date"),
        _get(visit, "siteVisit.link").alias("visit_link"),
        _merged("attrs", "visit.`siteVisit.attributes`", "siteVisit.attributes").alias("attrs"),
        _get(visit, "featureOfInterest").alias("fois"),
    )


def explode_fois(visits: DataFrame) -> DataFrame:
    """One row per feature of interest; a visit without any keeps one row."""
    foi = F.col("foi")
    return visits.withColumn("foi", F.explode_outer("fois")).select(
        *[c for c in visits.columns if c not in ("fois", "attrs")],
        _get(foi, "foi.id").alias("foi_id"),
        _get(foi, "foi.type").alias("foi_type"),
        _get(foi, "foi.link").alias("foi_link"),
        _get(foi, "foi.scientificName").alias("scientific_name"),
        _merged("attrs", "foi.`foi.attributes`", "foi.attributes").alias("attrs"),
        _get(foi, "foi.observations").alias("groups"),
    )


def explode_observations(fois: DataFrame) -> DataFrame:
    """One row per observation of each group.

    No groups at all: one row of context. A group with an empty list: no row.
    """
    groups = F.map_entries("groups")
    flat = F.flatten(
        F.transform(
            groups,
            lambda g: F.transform(
                F.coalesce(g["value"], F.array()),
                lambda o: F.struct(g["key"].alias("group"), o.alias("obs")),
            ),
        )
    )
    context = F.array(
        F.struct(
            F.lit(None).cast("string").alias("group"),
            F.lit(None).cast(OBSERVATION_ITEM).alias("obs"),
        )
    )
    rows = F.when(F.coalesce(F.size("groups"), F.lit(0)) <= 0, context).otherwise(flat)
    obs = F.col("item.obs")
    return fois.withColumn("item", F.explode(rows)).select(
        *[c for c in fois.columns if c not in ("groups", "attrs")],
        F.col("item.group").alias("obs_group"),
        _get(obs, "observableProperty").alias("obs_property"),
        _get(obs, "value").alias("obs_value"),
        _get(obs, "unit").alias("obs_unit"),
        _get(obs, "resultTime").alias("obs_result_time"),
        _get(obs, "usedProcedure").alias("obs_procedure"),
        _merged("attrs", "item.obs.system", "obs.system").alias("attrs"),
    )


def flatten_features(df: DataFrame) -> DataFrame:
    """The whole flatten; all attribute bags end up in one map ``attrs``."""
    return explode_observations(explode_fois(explode_visits(base_context(df))))


# --- attribute bags ---------------------------------------------------------------


# The bag expressions are written as SQL text: they nest a lambda per level, and text is
# parsed at once where a tree of Column calls takes seconds to build.


def _text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def _bound(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _entry(key: str, value: str) -> str:
    """A bag entry; ``members`` is NULL unless the value is a map."""
    members = f"try_variant_get({value}, '$', 'map<string,variant>')"
    return f"named_struct('key', {key}, 'value', {value}, 'members', {members})"


def _is_open(e: str) -> str:
    return f"({e}.members IS NOT NULL AND NOT map_contains_key({e}.members, 'value'))"


# All of a JSON text but the braces outside its strings.
NO_BRACE = r"""r'"(\\.|[^"\\])*"|[^{}]'"""


def _levels(bag: str) -> str:
    """How many maps lie within each other at most: the height of the braces of its text."""
    braces = f"split(regexp_replace(to_json({bag}), {NO_BRACE}, ''), '')"
    step = (
        "named_struct('now', h.now + IF(c = '{', 1, -1), "
        "'top', IF(c = '{', greatest(h.top, h.now + 1), h.top))"
    )
    return f"aggregate({braces}, named_struct('now', 0, 'top', 0), (h, c) -> {step}).top"


def _opened(entries: str, bag: str) -> str:
    """Replace each map that is not a measure by its members, until none is left.

    ``entries`` is a bound name. The rounds are those of the bag's own depth, which is only
    looked for where there is such a map; a round without one costs a glance.
    """
    member = _entry("concat(e.key, '.', m.key)", "m.value")
    one_level = (
        f"flatten(transform(b, e -> IF({_is_open('e')}, "
        f"transform(map_entries(e.members), m -> {member}), array(e))))"
    )
    some = f"exists({{0}}, e -> {_is_open('e')})"
    rounds = f"sequence(2, greatest(2, {_levels(bag)}))"
    deeper = f"aggregate({rounds}, {entries}, (b, r) -> IF({some.format('b')}, {one_level}, b))"
    return f"IF({some.format(entries)}, {deeper}, {entries})"


def _pairs(e: str) -> str:
    """(key, text) pairs of one finished entry: one, or those of a measure."""

    def pair(key: str, value: str) -> str:
        return f"named_struct('key', {key}, 'value', {_text(value)})"

    parts = [pair(f"{e}.key", f"{e}.members['value']")]
    for name in ("unit", "attribute"):
        made = pair(f"concat({e}.key, '.{name}')", f"{e}.members['{name}']")
        parts.append(f"IF(map_contains_key({e}.members, '{name}'), {made}, NULL)")
    measure = f"array_compact(array({', '.join(parts)}))"
    single = f"array({pair(f'{e}.key', f'{e}.value')})"
    return f"IF({e}.members IS NOT NULL AND NOT {_is_open(e)}, {measure}, {single})"


def flatten_bag_sql(bag: str, prefix: str = "") -> str:
    head = f"{prefix}." if prefix else ""
    top = f"map_entries(try_variant_get({bag}, '$', 'map<string,variant>'))"
    entry = _entry(f"concat('{head}', t.key)", "t.value")
    entries = f"transform({top}, t -> {entry})"
    opened = _bound(entries, "x", _opened("x", bag))
    pairs = f"flatten(transform({opened}, d -> {_pairs('d')}))"
    keys = "transform(p, k -> k.key)"
    first = f"filter(p, (q, i) -> array_position(ks, q.key) = i + 1)"
    unique = f"IF(size(array_distinct(ks)) = size(ks), p, {first})"
    return _bound(pairs, "p", f"map_from_entries({_bound(keys, 'ks', unique)})")


def flatten_bag(bag: str, prefix: str = "") -> Column:
    """VARIANT attribute bag (SQL text of it) -> ``map<string,string>`` with dotted keys.

    A member ``{value, unit, attribute}`` gives ``key``, ``key.unit``, ``key.attribute``
    (those present); another map is opened, however deep it lies; anything else is a value. Two members that
    come to the same dotted key: the first in key order is kept.
    """
    return F.expr(flatten_bag_sql(bag, prefix))


def attribute_rows(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """One row per attribute (attribute, value) in place of the map.

    The explode is of an expression: of a plain column Spark would infer a filter on its size,
    which moves down to the scan and flattens every bag twice more, in the scan's few tasks.
    """
    pair = F.explode(F.map_entries(attrs)).alias("_pair")
    rows = df.select(*[c for c in df.columns if c != attrs], pair)
    return rows.select("*", F.col("_pair.key").alias("attribute"), F.col("_pair.value").alias("value")).drop("_pair")


def _merged(attrs: str, bag: str, prefix: str) -> Column:
    """``attrs`` with the flattened bag added (an absent bag adds nothing)."""
    added = f"map_concat({attrs}, coalesce({flatten_bag_sql(bag, prefix)}, {NO_ATTRS}))"
    return F.expr(f"IF({bag} IS NULL, {attrs}, {added})")


def attribute_keys(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """The keys that occur, one row each (partial aggregation before the shuffle)."""
    return df.select(F.explode(F.map_keys(attrs)).alias("attribute")).distinct()


def attributes_wide(df: DataFrame, attrs: str = "attrs", keys: list[str] | None = None) -> DataFrame:
    """Attribute map -> one column per key.

    Without ``keys`` they are found by one job first; only the key names reach the driver.
    Beyond MAX_WIDE_KEYS the most frequent keys become columns, and the map column stays
    with all other keys.
    """
    rest = []
    if keys is None:
        counts = df.select(F.explode(F.map_keys(attrs)).alias("key")).groupBy("key").count()
        found = counts.orderBy(F.desc("count"), "key").limit(MAX_WIDE_KEYS + 1).collect()
        keys = sorted(r["key"] for r in found[:MAX_WIDE_KEYS])
        if len(found) > MAX_WIDE_KEYS:
            wide = F.array(*map(F.lit, keys))
            rest = [F.map_filter(attrs, lambda k, _: ~F.array_contains(wide, k)).alias(attrs)]
    return df.select(
        *[c for c in df.columns if c != attrs], *[F.col(attrs)[k].alias(k) for k in keys], *rest
    )
