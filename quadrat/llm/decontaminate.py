"""Benchmark decontamination: find, report and remove passages of test items.

Every window of ``n`` consecutive item words (an item with fewer words is one window)
goes into a hash set that is broadcast. The training texts' windows of the same lengths
are looked up in it while they are scanned, so training rows are never shuffled; each hit
is confirmed on the words themselves. A set larger than ``SET_BYTES`` is cut into blocks
by hash, and each block is broadcast in a scan of its own.

Defined cases: a null or word-free text has no words and no hits; a null item text has no
windows; a null item id counts as the id ``null``; repeated items and repeated windows
count once; rows that repeat are each reported; tables without rows give no hits; other
columns of either table, whatever their names, are not looked at and stay in place.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..session import cut_lineage
from .common import MATCH_WORD, ascii_lower

WINDOW = 10
# Most bytes of window texts and item ids in one broadcast.
SET_BYTES = 24 << 20
# As MATCH_WORD, for texts whose capitals still stand; and what stands between such words.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(MATCH_WORD), F.lit(0)), F.array())


def benchmark_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(key, span, passage, items): the distinct windows of all items.

    ``key`` is the window's hash, ``span`` its number of words, ``passage`` its words
    joined by blanks and ``items`` the sorted ids of the items that hold it.
    """
    worded = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        _words(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    placed = worded.select(
        "item",
        "words",
        F.least(F.size("words"), F.lit(n)).alias("span"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))).alias("at"),
    )
    windows = placed.select("item", "span", F.slice("words", F.col("at"), F.col("span")).alias("w"))
    return (
        windows.select("item", "span", F.array_join("w", " ").alias("passage"))
        .groupBy("span", "passage")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("key", F.xxhash64(F.transform(F.split("passage", " "), lambda w: F.xxhash64(w))))
    )


def _row_key() -> list[Column]:
    """Rows are told apart by id and text: equal rows have equal hits."""
    return [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text")]


def find_hits(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """(_id, _text, at, span, items): where a window of an item stands in a document.

    ``at`` is the position of its first word, from 0; ``_id`` and ``_text`` are the
    document's id and text hash.
    """
    windows = cut_lineage(benchmark_windows(items, n))
    spans, size = windows.agg(
        F.collect_set("span"),
        F.sum(F.length("passage") + F.length(F.array_join("items", ",")) + 48),
    ).first()
    blocks = max(1, math.ceil((size or 0) / SET_BYTES))
    least = min(spans, default=n)
    hashed = docs.select(*_row_key(), _words(F.col("text")).alias("words")).select(
        "*", F.transform("words", lambda w: F.xxhash64(w)).alias("h")
    )
    starts = F.when(F.size("h") >= least, F.sequence(F.lit(0), F.size("h") - least))
    placed = hashed.select("*", F.explode(starts).alias("at"))
    if len(spans) > 1:
        placed = placed.select("*", F.explode(F.array(*map(F.lit, sorted(spans)))).alias("span"))
    else:
        placed = placed.withColumn("span", F.lit(least))
    # the hash of an array is that of its elements in turn, so this equals the item's key
    fits = F.col("at") + F.col("span") <= F.size("h")
    key = F.lit(None).cast("long")
    for span in sorted(spans):
        parts = [F.get(F.col("h"), F.col("at") + k) for k in range(span)]
        key = F.when((F.col("span") == span) & fits, F.xxhash64(*parts)).otherwise(key)
    placed = placed.withColumn("key", key)

    def block(b: int) -> DataFrame:
        part = windows.where(F.pmod("key", F.lit(blocks)) == b)
        found = placed.join(F.broadcast(part), ["key", "span"])
        same = F.array_join(F.slice("words", F.col("at") + 1, F.col("span")), " ") == F.col("passage")
        return found.where(same).select("_id", "_text", "at", "span", "items")

    return reduce(DataFrame.unionAll, map(block, range(blocks)))


def _by_document(hits: DataFrame) -> DataFrame:
    """Per document: hit stretches (sorted, possibly overlapping), items."""
    stretch = F.struct(F.col("at").alias("s"), (F.col("at") + F.col("span")).alias("e"))
    return hits.groupBy("_id", "_text").agg(
        F.array_sort(F.collect_set(stretch)).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` as ``_doc``, joined with the few documents in which something was found.

    What was found is written first; measured small it is broadcast, and the texts stay
    where they are.
    """
    left = docs.select(F.struct("*").alias("_doc"), *_row_key())
    right = cut_lineage(found.withColumnsRenamed({"_id": "_rid", "_text": "_rtext"}))
    on = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_text") == F.col("_rtext"))
    return left.join(broadcast_if_small(right), on, how).drop("_rid", "_rtext", "_id", "_text")


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids (sorted array), contaminated.

    ``n_hit`` counts the words that stand inside any window of any item.
    """
    narrow = docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("_text"),
        F.coalesce(F.regexp_count("text", F.lit(_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"),
    )
    found = _by_document(find_hits(docs, items, n))
    covered = F.aggregate(
        "hit",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"),
            F.greatest(a["end"], x["e"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )
    counted = found.select(
        F.col("_id"), F.col("_text").alias("_rtext"), covered.alias("n_hit"), "item_ids"
    )
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_rtext"))
    return narrow.join(counted, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; all columns stay."""
    found = find_hits(docs, items, n).select("_id", "_text").distinct()
    return _joined(docs, found, "left_anti").select("_doc.*")


def remove_spans(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` with hit words, and what stands before each, cut out of the text."""
    pieces = F.regexp_extract_all(F.col("_doc.text"), F.lit(f"{_SEPARATOR}*{_ANY_CASE}"), F.lit(0))
    joined = _joined(docs, _by_document(find_hits(docs, items, n)).drop("item_ids"), "left")
    cut = joined.withColumn("_pieces", F.when(F.col("hit").isNotNull(), pieces))
    kept = F.filter(
        "_pieces",
        lambda p, i: ~F.exists("hit", lambda x: (x["s"] <= i) & (i < x["e"])),
    )
    rest = F.substring(F.col("_doc.text"), F.length(F.array_join("_pieces", "")) + 1, F.lit(1 << 30))
    text = F.when(F.col("hit").isNull(), F.col("_doc.text")).otherwise(
        F.concat(F.array_join(kept, ""), rest)
    )
    return cut.withColumn("_new", text).select(
        *[(F.col("_new") if c == "text" else F.col("_doc")[c]).alias(c) for c in docs.columns]
    )
