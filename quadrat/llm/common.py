"""Words, ordered running sums and table reading shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words of running text: what stands between ASCII white space.
SPACE = r"\x20\x09-\x0D"
PLAIN_WORD = rf"[^{SPACE}]+"
# Words for benchmark matching: ASCII digits and letters, and all that is not ASCII.
MATCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows of one slice of an ordered running sum, about.
SLICE_ROWS = 50_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    ``lower`` does the same wherever no other character has a lower case of its own, and
    is much faster than ``translate``.
    """
    other = r"[\P{ASCII}&&[^\p{Ll}\p{Lo}]]"
    return F.when(text.rlike(other), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def word_count(text: Column) -> Column:
    """Number of plain words; 0 for null."""
    marks = F.regexp_replace(F.regexp_replace(text, PLAIN_WORD, "x"), f"[{SPACE}]+", "")
    return F.coalesce(F.length(marks).cast("long"), F.lit(0).cast("long"))


def hash_bits(seed: str | Column, key: Column, bits: int = 60) -> Column:
    """``bits`` (a multiple of 4, up to 60) of the MD5 of ``seed:key``; null counts as a key."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    text = F.concat(seed, F.lit(":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, bits // 4), 16, 10).cast("long")


def slice_bits(rows: int) -> int:
    """How many leading hash bits cut ``rows`` into slices of about SLICE_ROWS."""
    return max(0, math.ceil(math.log2(max(1, rows) / SLICE_ROWS)))


def running_sums(
    df: DataFrame, groups: list[str], part: str, order: list[str], value: str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the same group.

    Rows of a group are ordered by ``part``, then by ``order``. Only the sums per (group,
    part) are ordered as a whole; rows are ordered within their part, so no task holds a
    whole group. ``df`` is read twice: write it first if it is costly.
    """
    keys = [*groups, part]
    ahead = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.sum(value).alias("_sum"))
        .select(
            *[F.col(k).alias(f"_{k}") for k in keys],
            F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"),
        )
    )
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(value).over(inner), F.lit(0))
    return df.join(starts, same).withColumn(out, F.col("_start") + within).drop(
        "_start", *[f"_{k}" for k in keys]
    )
