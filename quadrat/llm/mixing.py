"""Mixing sources to target weights.

Each document gets a hash-random key. Within its source the documents are sorted by it -
key ranges first, then rows within a range - and distributed prefix sums of the sizes say
how many words come before each document. A source whose budget is below its size is cut
where the prefix sum reaches the budget; one whose budget is above is repeated for whole
epochs, and the cut is made in the last one. The document on the cut gives only the words
that are still missing, so each budget is met exactly.

Defined cases: a null text has size 0 and gives nothing; a null source is a source of its
own, last in order; null ids share one key; rows that repeat are separate documents next to
each other in the order; a table without words has targets of 0; other columns are not
looked at by ``plan`` and stay in place in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..session import cut_lineage
from .common import PLAIN_WORD, SPACE, hash_bits, running_sums, slice_bits, word_count

WEIGHTS = (1, 2, 3)  # given to the sources in turn
EPOCHS = 3  # how often a document may be taken
SEED = "mix"
KEY_BITS = 60


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target): each source's share of the words of all sources.

    ``sizes`` holds (source, source_size). A target is the source's weight times one common
    level, or ``epochs`` times its size where that is less. Sorted by how soon they reach
    that limit, the sources below the level are a prefix; the level is what the rest of the
    words gives each unit of the rest of the weight. One row per source is ordered here.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"),
    )
    limit = (F.col("source_size") * epochs).alias("limit")
    table = sizes.select("source", "source_size", weight.alias("weight"), limit)
    full_at = F.col("limit") / F.col("weight")
    by_limit = Window.orderBy(full_at, F.col("source").asc_nulls_last())
    ahead = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    words = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(ahead), F.lit(0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    table = table.withColumn("level", words / heavy)
    open_level = F.when(F.col("level") <= full_at, F.col("level"))
    # behind the first open source the level only falls, so the first is the largest
    table = table.withColumn("common", F.max(open_level).over(every))
    target = F.when(open_level.isNotNull(), F.col("common") * F.col("weight"))
    target = F.least(F.coalesce(target, F.col("limit").cast("double")), F.col("limit").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, row, size, source_size, target, taken.

    ``taken`` counts the document's words in the mix, repeats included; ``row`` is a hash
    of id, source and text. Equal inputs give equal plans.
    """
    sized = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64("doc_id", "source", "text").alias("row"),
            word_count(F.col("text")).alias("size"),
            hash_bits(seed, F.col("doc_id"), KEY_BITS).alias("key"),
        )
    )
    bits = slice_bits(sized.count())
    sized = sized.withColumn("part", F.shiftright("key", KEY_BITS - bits) if bits else F.lit(0))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(
        source_targets(sizes, weights, epochs).withColumnRenamed("source", "of")
    )
    summed = running_sums(sized, ["source"], "part", ["key", "doc_id", "size", "row"], "size", "before")
    joined = summed.join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("of")))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("whole") * F.col("source_size") - F.col("before")
    taken = F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return joined.withColumn("whole", whole.cast("long")).select(
        "doc_id", "row", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed documents: a row per copy, all columns as they are.

    The one document per source on which the cut falls ends, in its last copy, after the
    words that its budget still had room for.
    """
    steps = cut_lineage(plan(docs, weights, epochs, seed))
    wanted = steps.where(F.col("taken") > 0).select(F.col("row").alias("_row"), "size", "taken")
    keyed = docs.select(F.struct("*").alias("_doc"), F.xxhash64("doc_id", "source", "text").alias("_row"))
    once = wanted.groupBy("_row").agg(
        F.max("size").alias("size"), F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n")
    )
    found = keyed.join(broadcast_if_small(once), "_row")
    # of rows that are equal, one carries what they give together
    rows = found.where(F.col("n") == 1).unionByName(
        found.where(F.col("n") > 1).dropDuplicates(["_row"])
    )
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = rows.select("_doc", "size", "taken", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.regexp_extract_all("_doc.text", F.lit(rf"[{SPACE}]*{PLAIN_WORD}"), F.lit(0))
    text = F.when(left >= F.col("size"), F.col("_doc.text")).otherwise(
        F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")
    )
    return rows.withColumn("_text", text).select(
        *[(F.col("_text") if c == "text" else F.col("_doc")[c]).alias(c) for c in docs.columns]
    )
