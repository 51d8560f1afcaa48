"""Quality rules: text statistics, a fixed base rule and a learned decision list.

Sequential covering writes the list: a rule grows by the threshold that gains most
information about the documents not yet covered, loses its last conditions again where a
part of the rows kept aside says so, and is accepted while it is right more often than
wrong there. Every step is one Spark aggregate over the labelled statistics, cut into bins
at quantiles; the driver sees counts per statistic and bin only. The result is an ordered
Spark conditional.

Defined cases: a null text has no words, and so fails the base rule; null labels leave
their document out, repeated labels count as the best one; equal rows are judged alike;
without labels of both kinds the list is empty and keeps all that the base rule keeps;
other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import PLAIN_WORD, SPACE

WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
BINS, CONDITIONS, RULES, LEAST_COVERED = 32, 4, 12, 8
# What the rules may test: shares that a reader of the text can check.
MEASURES = {
    "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "mean_word": "word_chars / n_words",
    "distinct_share": "n_distinct / n_words",
    "capital_share": "n_capitals / word_chars",
    "digit_share": "n_digits / word_chars",
    "cry_share": "n_cries / n_words",
    "stop_share": "n_stops / n_words",
    "line_words": "n_words / n_lines",
}


def _kept(text: Column, chars: str) -> Column:
    """How many characters of a class the text has."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and those behind MEASURES, a row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = docs.select(
        "doc_id",
        text.alias("text"),
        F.transform(F.regexp_extract_all(text, F.lit(PLAIN_WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("h"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(PLAIN_WORD)).alias("lines"),
    )
    counted = worded.select(
        "doc_id",
        F.size("h").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        _kept(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("h")).alias("n_distinct"),
        _kept(F.col("text"), r"\p{Lu}").alias("n_capitals"),
        _kept(F.col("text"), "0-9").alias("n_digits"),
        _kept(F.col("text"), "!?").alias("n_cries"),
        _kept(F.col("text"), ".").alias("n_stops"),
        F.when(
            F.size("h") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("h") - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(WINDOW)]),
            ),
        ).alias("windows"),
    )
    # places are sorted by window only in the texts that repeat one
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.zip_with(
        "windows",
        F.sequence(F.lit(0), F.size("windows") - 1),
        lambda w, i: F.struct(w.alias("w"), i.alias("i")),
    )
    paired = counted.withColumn("placed", F.when(repeats, F.array_sort(placed))).drop("windows")
    same = _neighbours(
        "placed", lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array())
    )
    starts = F.array_sort(F.array_distinct(F.flatten(same)))
    covered = paired.withColumn("starts", starts).drop("placed")
    steps = _neighbours("starts", lambda a, b: F.least(F.lit(WINDOW), b - a))
    total = F.aggregate(steps, F.lit(WINDOW), lambda n, x: n + x).cast("long")
    return covered.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("starts")


def _neighbours(name: str, pair) -> Column:
    """``pair(a, b)`` of every two neighbours of an array; null for null."""
    n = F.size(name) - 1
    return F.when(
        F.col(name).isNotNull(), F.zip_with(F.slice(name, F.lit(1), n), F.slice(name, F.lit(2), n), pair)
    )


def base_failed() -> Column:
    """The base rule over ``statistics``."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def measures() -> list[Column]:
    return [
        F.coalesce(F.expr(f"try_divide({' , '.join(e.split(' / '))})"), F.lit(0.0)).alias(name)
        for name, e in MEASURES.items()
    ]


@dataclass(frozen=True)
class Condition:
    """``measure >= cut`` or, where ``below``, ``measure < cut``; ``bin`` is the cut's number."""

    measure: str
    bin: int
    below: bool
    cut: float

    def binned(self) -> Column:
        at = F.col(self.measure) >= self.bin
        return ~at if self.below else at

    def plain(self) -> Column:
        at = F.col(self.measure) >= F.lit(self.cut)
        return ~at if self.below else at

    def __str__(self) -> str:
        return f"{self.measure} {'<' if self.below else '>='} {self.cut:g}"


Rule = tuple[Condition, ...]


def _all(conditions, how) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & how(c)
    return out


def _bins(table: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Measures replaced by the number of cuts they reach; the cuts, from quantiles."""
    at = [k / BINS for k in range(1, BINS)]
    found = table.agg(*[F.percentile_approx(m, at, 10_000).alias(m) for m in MEASURES]).first()
    cuts = {m: sorted(set(found[m] or [])) for m in MEASURES}
    # a quantile of 0 is a usual value: what lies above it is the finding
    for m, values in cuts.items():
        least = table.where(F.col(m) > (values[-1] if values else 0)).agg(F.min(m)).first()[0]
        if least is not None:
            values.append(least)
    columns = [_reached(m, cuts[m]).alias(m) for m in MEASURES]
    return table.select("bad", "aside", *columns), cuts


def _reached(measure: str, cuts: list[float]) -> Column:
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(measure)))


def _information(bad: float, good: float) -> float:
    return math.log2(bad / (bad + good)) if bad else -math.inf


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, int, int] | None:
    """The condition with the highest gain, and the bad and good rows that it leaves."""
    each = F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("b")) for m in MEASURES])
    counts = (
        rows.select("bad", F.explode(each).alias("x"))
        .groupBy("x.m", "x.b")
        .agg(F.sum(F.col("bad").cast("int")).alias("bad"), F.count("*").alias("n"))
        .collect()
    )
    table = {(r.m, r.b): (r.bad, r.n - r.bad) for r in counts}
    best, most = None, 0.0
    for m, values in cuts.items():
        bins = [table.get((m, b), (0, 0)) for b in range(len(values) + 1)]
        bad, good = sum(b for b, _ in bins), sum(g for _, g in bins)
        low = [0, 0]
        for b, cut in enumerate(values, 1):
            low = [low[0] + bins[b - 1][0], low[1] + bins[b - 1][1]]
            for below, (p, n) in ((True, low), (False, (bad - low[0], good - low[1]))):
                if p and p + n < bad + good:
                    gain = p * (_information(p, n) - _information(bad, good))
                    if gain > most + 1e-9:
                        best, most = (Condition(m, b, below, cut), p, n), gain
    return best


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < CONDITIONS:
        found = _best(rows.where(_all(rule, Condition.binned)), cuts)
        if found is None:
            break
        rule += (found[0],)
        if found[2] == 0:
            break
    return rule


def _prune(rule: Rule, rows: DataFrame) -> tuple[Rule, int, int]:
    """The beginning of the rule with the best (bad - good) / (bad + good) on rows kept aside."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k], Condition.binned)
        sums += [F.count_if(hit & F.col("bad")).alias(f"p{k}"), F.count_if(hit & ~F.col("bad")).alias(f"n{k}")]
    got = rows.agg(*sums).first()
    tried = [(got[f"p{k}"], got[f"n{k}"], k) for k in range(1, len(rule) + 1)]
    p, n, k = max(tried, key=lambda t: ((t[0] - t[1]) / (t[0] + t[1]) if t[0] + t[1] else -1, -t[2]))
    return rule[:k], p, n


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """The ordered rules for bad documents, from all labelled ones that pass the base rule.

    ``labels`` holds (doc_id, quality): 1 is good. Two thirds grow rules, a third prunes.
    """
    marked = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.max("quality") == 0).alias("bad")
    )
    table = cut_lineage(
        stats.where(~base_failed())
        .select("doc_id", *measures())
        .join(marked, "doc_id")
        .select("bad", (F.pmod(F.hash("doc_id"), F.lit(3)) == 0).alias("aside"), *MEASURES)
    )
    binned, cuts = _bins(table)
    binned = cut_lineage(binned)
    rules: list[Rule] = []
    left = binned
    while len(rules) < RULES:
        rule = _grow(left.where(~F.col("aside")), cuts)
        if not rule:
            break
        rule, p, n = _prune(rule, left.where("aside"))
        if p < LEAST_COVERED or p <= n:
            break
        rules.append(rule)
        left = left.where(~_all(rule, Condition.binned))
    return rules


def fired(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all(rule, Condition.plain), k).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, base statistics, base_failed, rule, kept."""
    stats = cut_lineage(statistics(docs))
    rules = learn(stats, labels)
    judged = stats.select("*", *measures()).withColumn("rule", fired(rules))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        "rule",
        (~base_failed() & F.col("rule").isNull()).alias("kept"),
    )
