"""URL filters: site rules, and a Bloom filter cascade for a list of keys.

The universe of keys is known: it is what the corpus holds. Level 0 of the cascade is a
Bloom filter of the listed keys, level 1 one of the unlisted keys that level 0 lets
through, level 2 one of the listed keys that level 1 lets through, and so on until no key
is left. A key's class follows from the first level that rejects it, and is exact for
every key of the universe, so rows are judged as they are scanned, without a join.

Keys are dealt by hash to as many cascades as keep each group of them below FILTER_BYTES;
a group is sent to the tasks at once, and the rows pass the groups one after the other.

Defined cases: a null url, and one without ``://``, has an empty host and path; such keys
belong to the universe like others; a list without keys blocks nothing; repeated keys count
once; listed keys that no row has are left out; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_with_tasks
from .common import LOWER, UPPER

ship_with_tasks(__name__)

HASHES, BITS_A_KEY = 4, 8
FILTER_BYTES = 16 << 20
LEVELS = 64
# (verdict, host, path), fixed values
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and where ``://`` is missing."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = [F.coalesce(F.regexp_extract(url, parts, k), F.lit("")) for k in (1, 2)]
    return F.translate(found[0], UPPER, LOWER), found[1]


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        name = F.when(fits, site + start).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


@dataclass
class Level:
    """One Bloom filter."""

    bits: np.ndarray
    size: int


def _positions(a: np.ndarray, b: np.ndarray, level: int, size: int) -> Iterator[np.ndarray]:
    """The bits of keys with hashes ``a`` and ``b``; each level has its own."""
    step = b | np.uint64(1)
    x = a ^ np.uint64((level * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    for _ in range(HASHES):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) + step
        yield (x >> np.uint64(20)) % np.uint64(size)


def _passes(levels: list[Level], start: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of levels from ``start`` on that let each key through one after the other."""
    passed, alive = np.zeros(len(a), np.int64), np.arange(len(a))
    for k, level in enumerate(levels, start):
        inside = np.ones(len(alive), bool)
        for at in _positions(a[alive], b[alive], k, level.size):
            inside &= (level.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        alive = alive[inside]
        passed[alive] += 1
    return passed


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("a", "b"))


def _bits_of(level: int, size: int):
    """Task function: (place, bits), 64-bit words of one level's filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(list(_positions(*_hashes(batch), level, size)))
            bit = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            place = (at >> np.uint64(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(bit)], names=["place", "bits"])

    return run


def _through(number: int, level: Level):
    """Task function: the keys that a level lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_passes([level], number, *_hashes(batch)) > 0))

    return run


def build(keys: DataFrame) -> list[Level]:
    """The cascade of distinct keys (a, b, listed).

    Each level is one Spark job per side: bits are set in the tasks, merged by ``bit_or``
    before and after the shuffle, and come to the driver as 64-bit words.
    """
    into, other = (keys.where(F.col("listed") == side).select("a", "b") for side in (True, False))
    levels: list[Level] = []
    while n := into.count():
        if len(levels) == LEVELS:
            raise ValueError("two keys share both hashes")
        size = math.ceil(n * BITS_A_KEY / 64) * 64
        words = (
            into.mapInArrow(_bits_of(len(levels), size), "place long, bits long")
            .groupBy("place")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()
        )
        table = np.zeros(size // 64, np.int64)
        table[words.column("place").to_numpy()] = words.column("bits").to_numpy()
        level = Level(table.view(np.uint8), size)
        through = other.mapInArrow(_through(len(levels), level), "a long, b long")
        levels.append(level)
        into, other = cut_lineage(through), into
    return levels


def _member(levels: list[Level]):
    """Exact for keys of the universe: listed ones pass an odd number of levels."""

    def member(a: pd.Series, b: pd.Series) -> pd.Series:
        keys = (x.to_numpy(np.int64).view(np.uint64) for x in (a, b))
        return pd.Series(_passes(levels, 0, *keys) % 2 == 1)

    return F.pandas_udf(member, "boolean")


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("b"), key).alias("b")]


def mark_listed(rows: DataFrame, key: str, names: DataFrame, out: str = "listed") -> DataFrame:
    """``rows`` with ``out``: whether the row's ``key`` is among ``names`` (a column ``key``).

    The keys of ``rows`` are the universe. Only distinct key hashes are shuffled.
    """
    universe = rows.select(*_hashed(F.col(key))).distinct()
    wanted = names.where(F.col("key").isNotNull()).select(*_hashed(F.col("key")))
    marked = (
        universe.select("a", "b", F.lit(1).alias("here"), F.lit(0).alias("named"))
        .unionAll(wanted.select("a", "b", F.lit(0), F.lit(1)))
        .groupBy("a", "b")
        .agg(F.max("here").alias("here"), F.max("named").alias("named"))
        .where(F.col("here") == 1)
    )
    marked = cut_lineage(marked.select("a", "b", (F.col("named") == 1).alias("listed")))
    # each side's levels shrink so fast that all take less than twice the keys' bits
    groups = max(1, math.ceil(2 * marked.count() * BITS_A_KEY / 8 / FILTER_BYTES))
    group = F.pmod(F.xxhash64("b", "a"), F.lit(groups))
    judged = rows.select(F.struct("*").alias("row"), *_hashed(F.col(key)), F.lit(False).alias("listed"))
    for g in range(groups):
        member = _member(build(marked.where(group == g)))
        now = F.when(group == g, member("a", "b")).otherwise(F.col("listed"))
        judged = judged.withColumn("listed", now)
        if groups > 1:
            judged = cut_lineage(judged)
    return judged.select("row.*", F.col("listed").alias(out))


def judge(pages: DataFrame, names: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The longest fitting rule decides; without one, a page whose host and path, joined, are
    listed is blocked and any other allowed.
    """
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    keyed = split.select("*", F.concat("host", "path").alias("key"), rule.alias("rule"), verdict.alias("ruled"))
    judged = mark_listed(keyed, "key", names)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"))


def tracked_keys(pages: DataFrame) -> DataFrame:
    """A block list from the corpus: keys that some url requests with a tracking parameter."""
    host, path = url_parts(F.col("url"))
    tracked = F.col("url").rlike(r"[?&]utm_[a-z]+=")
    return pages.where(tracked).select(F.concat(host, path).alias("key")).distinct()
