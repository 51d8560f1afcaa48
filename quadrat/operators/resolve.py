"""From what a user wrote to the canonical vocabulary entry.

Exact identifier, then exact label, then the best similar label. Only the *distinct*
values that no equi-join settled are compared, and with few labels:

* a text is the set of its characters, numbered where they repeat, rarest first. Two texts
  of lengths la and lb with ``ratio >= t`` share at least ``o = t * (la + lb) / 200`` of
  them, so the ``la - o + k`` rarest of one and the ``lb - o + k`` rarest of the other have
  at least k in common. Each k of these, with both lengths and the facet, are a join key;
  lengths that cannot reach the threshold make no key at all;
* the pairs that meet are made distinct, the exact number of shared characters is tested,
  and only then the score is computed;
* the thresholds fall round by round. What a round settles is final, because any better
  label would have been found in the same round; near-perfect matches cost few keys, and
  only what is left pays for the wide rounds.

All steps are exact: no pair that reaches the threshold is lost.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity
from ..functions.text import region_type_key, strip
from ..model import REGION_TYPES
from ..session import cut_lineage
from .lookup import broadcast_if_small, is_small

# fixed values: thresholds
FACET_NAME_THRESHOLD = 70
VALUE_THRESHOLD = 75
SINGLE_VALUE_THRESHOLD = 80
SPECIES_THRESHOLD = 80
REGION_TYPE_THRESHOLD = 90
REGION_TYPE_L_THRESHOLD = 20

# Thresholds of the rounds before the last one, and the characters of a join key.
ROUNDS = (92.0, 84.0)
KEY_ITEMS = 4
# Guards the bounds against rounding.
EPS = 1e-9


# --- similarity join --------------------------------------------------------------


def _characters(text: str) -> str:
    """Characters numbered by repeat, so that shared repeats can be counted as a set."""

    def of(chars: str) -> str:
        return (
            f"transform({chars}, (c, i) -> concat(c, CAST(size(filter(slice({chars}, 1, i + 1), "
            f"x -> x = c)) AS STRING)))"
        )

    return similarity.let(similarity.characters(text), of)


def ranked_texts(texts: DataFrame, rarity: DataFrame) -> DataFrame:
    """(facet, text, n, items): the numbered characters of each text, rarest first.

    Groups are the characters of one text, so they are as small as a label.
    """
    return (
        texts.withColumn("char", F.explode(F.expr(_characters("text"))))
        .join(broadcast_if_small(rarity), ["facet", "char"], "left")
        .groupBy("facet", "text")
        .agg(
            F.array_sort(
                F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "char"))
            ).alias("ranked")
        )
        .select(
            "facet",
            "text",
            F.length("text").alias("n"),
            F.transform("ranked", lambda r: F.xxhash64(r["char"])).alias("items"),
        )
    )


def _key_sets(items: str, seed: str, count: str) -> Column:
    """Hashes of the seed and each ``count`` (1 to KEY_ITEMS) of the items, in their order."""

    def chosen(more: int, start: str, before: str) -> str:
        rest = f"slice({items}, {start}, size({items}))"
        x, i = f"x{more}", f"i{more}"
        if more == 1:
            return f"transform({rest}, {x} -> xxhash64({seed}{before}, {x}))"
        inner = chosen(more - 1, f"{start} + {i} + 1", f"{before}, {x}")
        return f"flatten(transform({rest}, ({x}, {i}) -> {inner}))"

    cases = " ".join(f"WHEN {count} = {k} THEN {chosen(k, '1', '')}" for k in range(1, KEY_ITEMS))
    return F.expr(f"CASE {cases} ELSE {chosen(KEY_ITEMS, '1', '')} END")


def _keyed(texts: DataFrame, lengths: DataFrame, own: str, name: str) -> DataFrame:
    """(key, facet, name): the join keys of each text for each length it may meet."""
    count = F.least(F.lit(KEY_ITEMS), F.col("shared"))
    met = texts.join(
        F.broadcast(lengths.withColumnRenamed("facet", "_facet")),
        (F.col("facet") == F.col("_facet")) & (F.col("n") == F.col(own)),
    )
    rarest = F.slice("items", F.lit(1), F.col("n") - F.col("shared") + count)
    rows = met.select(
        "facet", F.col("text").alias(name), "la", "lb", rarest.alias("items"), count.alias("count")
    )
    return rows.select(F.explode(_key_sets("items", "facet, la, lb", "count")).alias("key"), "facet", name)


@dataclass
class Sides:
    """Both ranked sides, whether each is small, and the lengths of the texts per facet."""

    left: DataFrame
    right: DataFrame
    few: tuple[bool, bool]
    lengths: list[tuple[str, int, int]]

    def reachable(self, threshold: float) -> DataFrame:
        """(facet, la, lb, shared): the lengths that can reach the threshold, a row per pair."""
        rows = [
            (f, a, b, max(1, math.ceil(threshold * (a + b) / 200.0 - EPS)))
            for f, a, b in self.lengths
            if 200.0 * min(a, b) >= (threshold - EPS) * (a + b)
        ]
        return self.left.sparkSession.createDataFrame(rows, "facet string, la int, lb int, shared int")

    def without(self, done: DataFrame) -> "Sides":
        rest = self.left.join(done, ["facet", "text"], "left_anti")
        return replace(self, left=cut_lineage(rest))


def sides_of(values: DataFrame, labels: DataFrame) -> Sides:
    right = labels.select("facet", F.col("label").alias("text")).where(F.length("text") > 0)
    left = values.select("facet", F.col("value").alias("text")).where(F.length("text") > 0)
    rarity = (
        right.select("facet", F.explode(F.expr(_characters("text"))).alias("char"))
        .groupBy("facet", "char")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    rarity = cut_lineage(rarity)
    left, right = (cut_lineage(ranked_texts(side, rarity)) for side in (left, right))
    # as many rows as a facet has different lengths of text
    la, lb = (side.select("facet", "n").distinct().collect() for side in (left, right))
    lengths = [(a["facet"], a["n"], b["n"]) for a in la for b in lb if a["facet"] == b["facet"]]
    return Sides(left, right, (is_small(left), is_small(right)), lengths)


def key_pairs(sides: Sides, threshold: float) -> DataFrame:
    """(facet, value, label) that share a key, once per key."""
    lengths = sides.reachable(threshold)
    a = _keyed(sides.left, lengths, "la", "value")
    b = _keyed(sides.right, lengths, "lb", "label").withColumnRenamed("facet", "_facet")
    return a.join(b, "key").where(F.col("facet") == F.col("_facet")).select("facet", "value", "label")


def _scored(sides: Sides, threshold: float) -> DataFrame:
    pairs = key_pairs(sides, threshold).distinct()
    a = sides.left.select("facet", F.col("text").alias("value"), F.col("items").alias("items_a"))
    b = sides.right.select("facet", F.col("text").alias("label"), F.col("items").alias("items_b"))
    a, b = (F.broadcast(side) if few else side.hint("merge") for side, few in zip((a, b), sides.few))
    both = pairs.join(a, ["facet", "value"]).join(b, ["facet", "label"])
    common = F.size(F.array_intersect("items_a", "items_b"))
    total = F.size("items_a") + F.size("items_b")
    score = similarity.ratio_column("value", "label")
    likely = both.where(common >= threshold * total / 200.0 - EPS)
    return likely.select("facet", "value", "label", score.alias("score")).where(F.col("score") >= threshold)


def similar_pairs(values: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(facet, value, label, score) of all pairs with ``ratio >= threshold``.

    ``values`` is (facet, value), ``labels`` is (facet, label); both distinct.
    """
    return _scored(sides_of(values, labels), threshold)


def best_per_value(pairs: DataFrame) -> DataFrame:
    """Highest score per value, the smallest label on a tie (partial aggregation)."""
    return (
        pairs.groupBy("facet", "value")
        .agg(F.min(F.struct(-F.col("score"), F.col("label"))).alias("b"))
        .select(
            "facet", "value", F.col("b.label").alias("label"), (-F.col("b.col1")).alias("score")
        )
    )


def best_matches(
    values: DataFrame, labels: DataFrame, threshold: float, rounds: tuple[float, ...] = ROUNDS
) -> DataFrame:
    """Best label of each value that has one at or above the threshold."""
    sides = sides_of(values, labels.distinct())
    found = None
    for bound in [r for r in rounds if r > threshold] + [threshold]:
        best = cut_lineage(best_per_value(_scored(sides, bound)))
        found = best if found is None else found.union(best)
        if bound > threshold:
            sides = sides.without(best.select("facet", F.col("value").alias("text")))
            if sides.left.isEmpty():
                break
    return found


# --- resolver ---------------------------------------------------------------------


def _exact(wanted: DataFrame, vocab: DataFrame) -> DataFrame:
    """(facet, value, l1, u2): label of the value as identifier, identifier of it as label.

    The vocabulary is read once and meets the values before it is grouped, so a large
    vocabulary is not shuffled for a few values.
    """
    both = F.array(
        *[
            F.struct(F.lit(how).alias("how"), F.col(key).alias("value"), F.col(other).alias("other"))
            for how, key, other in (("uri", "uri", "label"), ("label", "label", "uri"))
        ]
    )
    keyed = vocab.select("facet", F.explode(both).alias("k")).select("facet", "k.*")
    found = (
        keyed.join(broadcast_if_small(wanted), ["facet", "value"])
        .groupBy("facet", "value")
        .agg(
            F.min(F.when(F.col("how") == "uri", F.col("other"))).alias("l1"),
            F.min(F.when(F.col("how") == "label", F.col("other"))).alias("u2"),
        )
    )
    return wanted.join(found, ["facet", "value"], "left")


def _near(misses: DataFrame, targets: DataFrame, threshold: float, **how) -> DataFrame:
    """The best target of each miss, or NULL: (facet, value, uri, label, score)."""
    best = cut_lineage(best_matches(misses, targets.select("facet", "label"), threshold, **how))
    named = (
        targets.join(broadcast_if_small(best), ["facet", "label"])
        .groupBy("facet", "value")
        .agg(F.min(F.struct("uri", "shown")).alias("t"), F.first("score").alias("score"))
        .select("facet", "value", "t.uri", F.col("t.shown").alias("label"), "score")
    )
    return misses.join(named, ["facet", "value"], "left")


def resolve(
    candidates: DataFrame,
    vocab: DataFrame,
    threshold: float = VALUE_THRESHOLD,
    correct_uris: bool = False,
    **how,
) -> DataFrame:
    """Resolve all (facet, value) rows of all facets in one job.

    -> (facet, value, uri, label, score, outcome), one row per distinct value;
    outcome is ``uri``, ``label``, ``fuzzy`` or ``unmatched``. With ``correct_uris`` a
    value that looks like a web address is compared with the identifiers instead of
    the labels. ``how`` goes to ``best_matches``.
    """
    wanted = cut_lineage(
        candidates.select("facet", strip(F.col("value")).alias("value")).distinct()
    )
    exact = cut_lineage(_exact(wanted, vocab))
    is_uri, is_label = F.col("l1").isNotNull(), F.col("u2").isNotNull()
    settled = exact.where(is_uri | is_label).select(
        "facet",
        "value",
        F.when(is_uri, F.col("value")).otherwise(F.col("u2")).alias("uri"),
        F.when(is_uri, F.col("l1")).otherwise(F.col("value")).alias("label"),
        F.lit(100.0).alias("score"),
        F.when(is_uri, "uri").otherwise("label").alias("outcome"),
    )
    misses = exact.where(~is_uri & ~is_label).select("facet", "value")
    # the few facet names that still have misses
    facets = [r["facet"] for r in misses.select("facet").distinct().collect()]
    if not facets:
        return settled
    known = vocab.where(F.col("facet").isin(facets))
    names = known.select("facet", "label", "uri", F.col("label").alias("shown"))
    if correct_uris:
        is_address = F.col("value").rlike("^https?://")
        addresses = known.select("facet", F.col("uri").alias("label"), "uri", F.col("label").alias("shown"))
        fuzzy = _near(misses.where(is_address), addresses, threshold, **how).union(
            _near(misses.where(~is_address), names, threshold, **how)
        )
    else:
        fuzzy = _near(misses, names, threshold, **how)
    outcome = F.when(F.col("uri").isNotNull(), "fuzzy").otherwise("unmatched")
    return settled.union(fuzzy.select("*", outcome.alias("outcome")))


def resolve_single(candidates: DataFrame, vocab: DataFrame) -> DataFrame:
    """The stricter form for single values: names and addresses, each at 80 or above."""
    return resolve(candidates, vocab, SINGLE_VALUE_THRESHOLD, correct_uris=True)


def resolve_region_types(texts: DataFrame, column: str) -> DataFrame:
    """(column, region_type, score) of each distinct text; NULL type when none fits.

    A URL is compared with the known URLs, anything else with the known names.
    """
    names, urls = list(REGION_TYPES), list(REGION_TYPES.values())
    raw = F.col(column)
    is_url = raw.startswith("http://") | raw.startswith("https://")
    clean = region_type_key(raw)
    name_of = F.create_map(*[F.lit(x) for url in urls for x in (url, names[urls.index(url)])])
    scored = (
        texts.select(column)
        .distinct()
        .withColumn("clean", clean)
        .withColumn("by_url", similarity.best_choice_column(f"`{column}`", urls))
        .withColumn("by_name", similarity.best_choice_column("clean", names))
    )
    pick = F.when(is_url, name_of[F.col("by_url.choice")]).otherwise(F.col("by_name.choice"))
    score = F.when(is_url, F.col("by_url.score")).otherwise(F.col("by_name.score"))
    bound = F.when(~is_url & clean.startswith("l"), REGION_TYPE_L_THRESHOLD).otherwise(
        REGION_TYPE_THRESHOLD
    )
    return scored.select(
        column, F.when(score >= bound, pick).alias("region_type"), score.alias("score")
    )


def resolve_name(text: str, allowed, threshold: float = FACET_NAME_THRESHOLD) -> str | None:
    """Closest of a few fixed names (driver side), or None."""
    key = "_".join(re.findall("[a-z0-9]+", text.lower()))
    scored = [(similarity.ratio(key, name), name) for name in sorted(allowed, reverse=True)]
    score, top = max(scored)
    return top if score >= threshold else None


def _traits(text: str) -> Column:
    """What bounds a weighted ratio: characters with blanks alike, words, length of the words."""
    plain = f"regexp_replace({text}, r'{similarity.BLANKS}', ' ')"
    words = similarity.let(
        f"array_distinct({similarity.words(text)})",
        lambda w: f"named_struct('chars', {_characters(plain)}, 'words', {w}, 'n', length(array_join({w}, ' ')))",
    )
    return F.expr(words)


def species_candidates(names: DataFrame, typed: DataFrame, threshold: float) -> DataFrame:
    """(position, value, speciesname, same) of the names that may reach the threshold.

    ``names`` is (speciesname), ``typed`` (position, value), what a user typed. A name that
    shares a word with the value may. Any other needs enough common characters: of c common
    ones a ratio is at most 200 c / (length of both), and for texts of very different length
    that of a window at most 200 c / (length of the shorter + c). The distinct words are the
    shortest form that is compared.
    """
    asked = typed.select("position", "value", _traits("value").alias("t")).collect()
    words = lambda some: F.lit(list(some)).cast("array<string>")
    listed = [
        F.struct(
            F.lit(r["position"]).alias("position"),
            F.lit(r["value"]).alias("value"),
            words(r["t"]["chars"]).alias("chars"),
            words(r["t"]["words"]).alias("words"),
            F.lit(r["t"]["n"]).alias("n"),
        )
        for r in asked
    ]
    mine = F.col("t")
    # what a user typed travels with the tasks: no name is moved
    pairs = (
        names.select("speciesname", _traits("speciesname").alias("s"))
        .select("*", F.explode(F.array(*listed)).alias("t"))
        .select("*", "t.position", "t.value", F.size(F.array_intersect("t.chars", "s.chars")).alias("common"))
    )
    la, lb = F.length("value"), F.length("speciesname")
    short, long = F.least(la, lb), F.greatest(la, lb)
    weight = F.when(long <= similarity.LONG_WINDOW_FROM * short, similarity.WINDOW_WEIGHT).otherwise(
        similarity.LONG_WINDOW_WEIGHT
    )
    c, n = F.col("common"), F.least(mine["n"], F.col("s.n"))
    whole = 200.0 * c >= threshold * (mine["n"] + F.col("s.n")) - EPS
    window = (long >= similarity.WINDOW_FROM * short - EPS) & (weight * 200.0 * c >= threshold * (n + c) - EPS)
    same = F.lower("value") == F.lower("speciesname")
    likely = same | F.arrays_overlap("t.words", "s.words") | whole | window
    return pairs.where((la > 0) & likely).select("position", "value", "speciesname", same.alias("same"))


def match_species(
    species: DataFrame, column: str, wanted: list[str], threshold: float = SPECIES_THRESHOLD
) -> DataFrame:
    """Match the species names a user typed against all names of a table.

    -> (position, value, speciesname, score); NULL name when nothing is close enough.
    The typed list travels with the tasks, names are scored where they lie, and only those
    that share a word or enough characters. An exact match that only differs in case beats
    any similarity.
    """
    spark = species.sparkSession
    typed = spark.createDataFrame(
        [(i, v.strip()) for i, v in enumerate(wanted)], "position int, value string"
    )
    if not wanted:
        return typed.select("position", "value", F.lit("").alias("speciesname"), F.lit(0.0).alias("score"))
    names = (
        species.select(F.trim(column).alias("speciesname"))
        .where(F.length("speciesname") > 0)
        .distinct()
    )
    likely = species_candidates(names, typed, threshold)
    weighted = similarity.weighted_ratio_column("value", "speciesname")
    score = F.when(F.col("same"), F.lit(101.0)).otherwise(weighted)
    best = (
        likely.select("position", "speciesname", score.alias("score"))
        .groupBy("position")
        .agg(F.min(F.struct(-F.col("score"), F.col("speciesname"))).alias("b"))
        .select("position", F.col("b.speciesname").alias("speciesname"), (-F.col("b.col1")).alias("s"))
        .where(F.col("s") >= threshold)
    )
    return typed.join(best, "position", "left").select(
        "position", "value", "speciesname", F.least("s", F.lit(100.0)).alias("score")
    )
