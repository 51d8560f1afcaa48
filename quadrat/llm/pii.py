"""Personal data: base patterns, and bootstrapped contextual extraction.

Base matches of four kinds are found by pattern, with their places. They are the seeds: the
words of the text to their left and right, one or two, make lexical patterns. Patterns are
then matched with everything in the corpus that looks like an identifier, also with blanks,
brackets and dashes in it, or with its signs spelt out; the shape is only part of the score. On the graph of patterns and
instances, a pattern's confidence in a kind is the share of its instances' confidence among
all it extracts, and an instance's confidence is that at least one of its patterns is right;
the two are computed in turn. Patterns that end up sure enough, and that enough different
seeds support, add spans for identifiers that no base pattern knows.

Positions come from cutting the text at the matches: a match starts where the texts between
matches and the matches before it end. Running sums over a document's own cuts give them in
one pass.

Defined cases: null and empty texts have no spans; equal rows have equal spans; equal texts
under two ids are two documents; a null id is an id; without seeds there are no patterns;
other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# The base patterns. Possessive repeats and the looks behind only keep a failed start from
# being tried again further on in the same run; what matches is the same.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What may be an identifier: a run of identifier characters with a digit or @ in it; groups of
# digits with blanks, brackets and dashes between; an address whose signs are written as words
# or in brackets, or with blanks around.
_NAME = "[A-Za-z0-9-]++"
_AT = r"(?:\s*+[\[({<]\s*+(?:at|@)\s*+[\])}>]\s*+)"
_DOT = r"(?:\s*+[\[({<]\s*+(?:dot|\.)\s*+[\])}>]\s*+|\s++dot\s++)"
CANDIDATES = {
    "candidate": r"(?<![A-Za-z0-9@._%+-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9@._%+-]*+",
    "groups": r"(?<![A-Za-z0-9@._%+-])[+(\[]*+[0-9]++(?:[\s()\[\]./‐-―-]{1,3}+[0-9]++)++(?![._%+-]?[A-Za-z@])",
    "spoken": rf"(?i)(?<![A-Za-z0-9@._%+-])[A-Za-z0-9._%+-]++(?:(?:{_AT}|\s++(?:at|@)\s++){_NAME}(?:\.{_NAME})*+"
    rf"(?:{_DOT}{_NAME}(?:\.{_NAME})*+)++|(?:{_AT}|\s*+@\s*+){_NAME}(?:\.{_NAME})++)",
}
# A word of the context, and how far it is looked for. Half as many matches reach over it.
WORD = r"[\p{L}\p{M}\p{N}]+"
SEEN, REACH = 64, 32
LEAST_CHARS = 4
ROUNDS, LEAST_SEEDS, SURE, SMOOTHING = 3, 3, 0.8, 1.0
# One word on each side says less than two in a row: so many times the seeds are asked for.
SHORT, SHORT_SEEDS = "left, right", 10
# How much of a span's score the likeness of its shape can take away.
SHAPE_WEIGHT = 0.15


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the last digit checks the others: every second one, from the right, doubled."""
    at = F.sequence(F.lit(1), F.length(digits))
    values = F.transform(at, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    size = F.length(_digits(hit))
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(size.between(16, 19), _luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return size.between(8, 15)
    return F.lit(True)


def _contexts(units: Column, step: int) -> Column:
    """The words of the text that goes on from a match, the nearest two, digits as 9; the
    start of the text is the word ^.

    ``units`` are the stretches between matches that reach over SEEN characters together.
    """
    side = F.array_join(units, "")
    near = F.right(side, F.lit(SEEN)) if step < 0 else F.left(side, F.lit(SEEN))
    words = F.regexp_extract_all(near, F.lit(WORD), F.lit(0))
    # a word that the bound cuts is not known
    whole = F.when(F.length(near) < SEEN, words).otherwise(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        if step < 0
        else F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    )
    if step < 0:
        start = F.when(F.length(near) < SEEN, F.array(F.lit("^"))).otherwise(F.array())
        whole = F.reverse(F.concat(start, whole))
    return F.transform(
        F.slice(whole, 1, 2), lambda w: F.lower(F.regexp_replace(w, "[0-9]+", "9"))
    )


def _cuts(docs: DataFrame, kind: str, pattern: str) -> DataFrame:
    """(id, row, kind, hit, start, end, left, right): the matches of one pattern.

    ``left`` and ``right`` are the nearest words, at most two, of the text on each side. A
    match and the gap at its side are two characters at least, so REACH of them hold all of
    SEEN characters, and the work grows with the number of matches.
    """
    text = F.col("text")
    parts = docs.where(text.rlike("[0-9@]|(?i:at|dot)") & text.rlike(pattern)).select(
        "id",
        "row",
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    seen = F.lit(SEEN)
    ends = lambda g, i: F.right(F.concat(F.when(i > 0, F.get("hits", i - 1)).otherwise(F.lit("")), g), seen)
    begins = lambda g, i: F.left(F.concat(g, F.coalesce(F.get("hits", i), F.lit(""))), seen)
    parts = parts.withColumns(
        {"ahead": F.transform("gaps", ends), "behind": F.transform("gaps", begins)}
    )
    found = parts.select(
        "id",
        "row",
        F.posexplode(
            F.transform(
                "hits",
                lambda h, i: F.struct(
                    h.alias("hit"),
                    F.length(F.get("gaps", i)).alias("gap"),
                    _contexts(F.slice("ahead", F.greatest(i + 2 - REACH, F.lit(1)), F.least(i + 1, F.lit(REACH))), -1).alias("left"),
                    _contexts(F.slice("behind", i + 2, REACH), 1).alias("right"),
                ),
            )
        ).alias("k", "cut"),
    )
    return found.select("id", "row", F.lit(kind).alias("kind"), "k", "cut.*").withColumn(
        "size", F.length("hit")
    )


def find_matches(docs: DataFrame) -> DataFrame:
    """(id, row, kind, start, end, hit, left, right) of all base matches and candidates."""
    keyed = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("row"), F.col("text")
    )
    patterns = {**KINDS, **CANDIDATES}
    cuts = reduce(DataFrame.unionAll, [_cuts(keyed, *p) for p in patterns.items()])
    # rows that repeat give the same cuts: one of each is enough
    cuts = cuts.dropDuplicates(["id", "row", "kind", "k"])
    order = Window.partitionBy("id", "row", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    placed = cuts.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.withColumn(
        "kind", F.when(F.col("kind").isin(*CANDIDATES), "candidate").otherwise(F.col("kind"))
    )
    # a candidate does not end in a sign
    trimmed = F.when(
        F.col("kind") == "candidate", F.regexp_replace("hit", "[._%+-]+$", "")
    ).otherwise(F.col("hit"))
    placed = placed.withColumn("hit", trimmed).withColumn("end", F.col("start") + F.length("hit"))
    valid = reduce(
        lambda out, kind: F.when(F.col("kind") == kind, _valid(kind, F.col("hit"))).otherwise(out),
        KINDS,
        F.length("hit") >= LEAST_CHARS,
    )
    return placed.where(valid).select("id", "row", "kind", "start", "end", "hit", "left", "right")


def _free(matches: DataFrame) -> DataFrame:
    """Candidates that no base match of their document overlaps, the widest at each place."""
    ahead = Window.partitionBy("id", "row").orderBy("start", F.col("kind") == "candidate")
    behind = Window.partitionBy("id", "row").orderBy(F.col("start").desc(), F.col("kind") == "candidate")
    past = ahead.rowsBetween(Window.unboundedPreceding, -1)
    base_end = F.when(F.col("kind") != "candidate", F.col("end"))
    base_start = F.when(F.col("kind") != "candidate", F.col("start"))
    swept = matches.withColumns(
        {
            "reached": F.max(base_end).over(past),
            "next": F.min(base_start).over(behind.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    clear = (F.coalesce("reached", F.lit(0)) <= F.col("start")) & (
        F.col("next").isNull() | (F.col("next") >= F.col("end"))
    )
    free = swept.where((F.col("kind") == "candidate") & clear).drop("next")
    wide_first = Window.partitionBy("id", "row").orderBy("start", F.col("end").desc())
    wider = F.max("end").over(wide_first.rowsBetween(Window.unboundedPreceding, -1))
    free = free.withColumn("reached", wider)
    return free.where(F.coalesce("reached", F.lit(0)) < F.col("end")).drop("reached")


def _patterns(left: Column, right: Column) -> Column:
    """The contexts of a match: two words on one side, alone or with one of the other, and
    one word on each side."""

    def known(name: str, parts: list[Column]) -> Column:
        whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
        return F.when(whole, F.concat_ws("\t", F.lit(name), *parts))

    l1, r1, r2 = F.get(left, F.lit(0)), F.get(right, F.lit(0)), F.get(right, F.lit(1))
    l2 = F.get(left, F.lit(1))
    return F.array_compact(
        F.array(
            known("two left", [l2, l1]),
            known("two left, right", [l2, l1, r1]),
            known("two right", [r1, r2]),
            known("left, two right", [l1, r1, r2]),
            known(SHORT, [l1, r1]),
        )
    )


def _shape(hit: Column) -> Column:
    """A match with its digits as 9 and its letters as a, runs as one."""
    letters = F.regexp_replace(hit, "[A-Za-z]+", "a")
    return F.regexp_replace(letters, "[0-9]+", "9")


def sure_patterns(
    graph: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, sure: float = SURE
) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that may extract.

    ``graph`` holds distinct (pattern, instance, seed): ``seed`` is the kind of a base
    match, null for a candidate. A pattern with very many instances is summed map-side.
    """
    graph = cut_lineage(graph.where(F.col("pattern").isNotNull()).distinct())
    seeds = graph.where(F.col("seed").isNotNull())
    supported = seeds.groupBy("pattern", F.col("seed").alias("kind")).agg(
        F.count_distinct("instance").alias("seeds")
    )
    short = F.col("pattern").startswith(SHORT + "\t")
    least = F.when(short, F.lit(least_seeds * SHORT_SEEDS)).otherwise(F.lit(least_seeds))
    supported = supported.where(F.col("seeds") >= least)
    totals = graph.groupBy("pattern").agg(F.count_distinct("instance").alias("n"))
    known = cut_lineage(supported.join(totals, "pattern"))
    # only edges of patterns that seeds support carry confidence
    edges = cut_lineage(
        graph.join(known.select("pattern", "kind"), "pattern").where(
            F.col("seed").isNull() | (F.col("seed") == F.col("kind"))
        )
    )
    fixed = edges.where(F.col("seed").isNotNull()).select("instance", "kind").distinct()
    belief = fixed.withColumn("belief", F.lit(1.0))
    trust = None
    for _ in range(rounds):
        gained = edges.join(belief, ["instance", "kind"]).groupBy("pattern", "kind").agg(
            F.sum("belief").alias("mass")
        )
        trust = cut_lineage(
            known.join(gained, ["pattern", "kind"]).select(
                "pattern", "kind", (F.col("mass") / (F.col("n") + SMOOTHING)).alias("confidence")
            )
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        heard = edges.where(F.col("seed").isNull()).join(trust, ["pattern", "kind"])
        heard = heard.groupBy("instance", "kind").agg((1 - doubt).alias("belief"))
        belief = cut_lineage(
            fixed.withColumn("belief", F.lit(1.0)).unionByName(
                heard.join(fixed, ["instance", "kind"], "left_anti")
            )
        )
    return trust.where(F.col("confidence") >= sure)


def find_spans(docs: DataFrame, **settings) -> DataFrame:
    """(id, row, kind, start, end, hit, added): base matches and what the method adds.

    ``row`` is a hash of id and text. Places are code points, the end exclusive.
    """
    matches = cut_lineage(find_matches(docs))
    sure = settings.get("sure", SURE)
    base = matches.where(F.col("kind") != "candidate")
    free = cut_lineage(_free(matches))
    pattern = F.explode(_patterns(F.col("left"), F.col("right"))).alias("pattern")
    graph = base.select(pattern, F.col("hit").alias("instance"), F.col("kind").alias("seed")).unionAll(
        free.select(pattern, F.col("hit").alias("instance"), F.lit(None).cast("string"))
    )
    trust = sure_patterns(graph, **settings)
    shapes = base.select("kind", _shape(F.col("hit")).alias("shape"), F.lit(True).alias("seen")).distinct()
    span = ["id", "row", "start", "end", "hit"]
    heard = free.drop("kind").select(*span, pattern).join(trust, "pattern")
    heard = heard.groupBy(*span, "kind").agg(F.max("confidence").alias("confidence"))
    heard = heard.withColumn("shape", _shape(F.col("hit"))).join(shapes, ["kind", "shape"], "left")
    # the shape of a seed counts whole, one with letters where seeds of the kind have them half
    lettered = F.col("hit").rlike("[A-Za-z]") == (F.col("kind") == "email")
    likeness = F.when(F.col("seen"), 1.0).when(lettered, 0.5).otherwise(0.0)
    score = F.col("confidence") * (1 - SHAPE_WEIGHT * (1 - likeness))
    # a span sure of two kinds goes with the surer one
    added = heard.where(score >= sure).groupBy(*span).agg(F.max_by("kind", F.struct(score, "kind")).alias("kind"))
    columns = ["id", "row", "kind", "start", "end", "hit"]
    return base.select(*columns, F.lit(False).alias("added")).unionByName(
        added.select(*columns, F.lit(True).alias("added"))
    )


def report(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, base counts by kind, base_spans and spans as text.

    Spans are written ``kind:start:end``, by kind, then start, joined by commas.
    """
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(
        order.alias("order"),
        "start",
        "end",
        F.concat_ws(":", "kind", "start", "end").alias("text"),
    )
    own = F.when(~F.col("added"), span)
    counts = [
        F.count_if((F.col("kind") == k) & ~F.col("added")).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    found = find_spans(docs, **settings).groupBy("id", "row").agg(
        *counts,
        F.array_join(F.array_sort(F.collect_list(own))["text"], ",").alias("base_spans"),
        F.array_join(F.array_sort(F.collect_list(span))["text"], ",").alias("spans"),
    )
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"))
    on = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("row"))
    return rows.join(found, on, "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")],
    )
