"""Merkle dataset manifest by lag and lead windows.

Every row of a table is a leaf: the hash of its fields, each with its length. The leaves of a
source, in the order of their ids, are the lowest level of its tree; every 16 neighbours of a
level hash to a node of the next until one is left, the source's subroot. The subroots, in
the order of the sources, make the top tree in the same way.

Per level, 15 lag and 15 lead columns of fixed offsets over the numbered nodes, masked by a
node's slot in its run and by the run's length, give the siblings to its left and right; the
first child of a run hashes the parent from itself and its leads. Runs are 16 nodes, so no
window holds more, however large a source is. Positions are prefix sums over slices of a
range partitioning. Proofs come down again from the roots: a node's path is its siblings
followed by its parent's path, joined on the run by which the siblings are dealt already.

Defined cases: a null field is ``-``; null ids come before all others, a null source before
all sources; rows with equal ids are ordered by their leaf, and equal rows are leaves of
their own, interchangeable; a null id or text is not tampered with; one source makes its
subroot the root; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..session import cut_lineage
from .common import SLICE_ROWS, ascii_lower, running_sums

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
PATH = "array<struct<l:string,r:string>>"


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(fields: list[Column]) -> Column:
    """The hash of a row: each field with its length in bytes, ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    marked = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return hashed(*[F.coalesce(m, F.lit("-")) for m in marked])


def numbered(df: DataFrame, groups: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: the rows of each group numbered from 0 in the given order.

    Nulls come first. Rows are dealt to slices by range; a slice is numbered within a task,
    and only the slices' row counts are summed up over a whole group.
    """
    slices = max(1, math.ceil(df.count() / SLICE_ROWS))
    ranged = df.repartitionByRange(slices, *groups, *order)
    ranged = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()).withColumn("_one", F.lit(1)))
    return running_sums(ranged, groups, "_slice", order, "_one", out).drop("_slice", "_one")


def siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, idx, digest, width) that have a run: with run, slot and siblings l, r."""
    nodes = nodes.where(F.col("width") > 1).withColumns(
        {"run": F.floor(F.col("idx") / FAN), "slot": F.col("idx") % FAN}
    )
    inner = Window.partitionBy("tree", "run").orderBy("idx")
    length = F.least(F.lit(FAN), F.col("width") - F.col("run") * FAN)
    none = F.lit("")
    before = [
        F.when(F.col("slot") >= k, F.lag("digest", k).over(inner)).otherwise(none)
        for k in range(FAN - 1, 0, -1)
    ]
    after = [
        F.when(F.col("slot") + k < length, F.lead("digest", k).over(inner)).otherwise(none)
        for k in range(1, FAN)
    ]
    return nodes.withColumns({"l": F.concat(*before), "r": F.concat(*after)})


def levels_of(leaves: DataFrame) -> list[DataFrame]:
    """The levels (tree, idx, digest, width) from the leaves up to where all trees are done."""
    levels = [leaves]
    widest = leaves.agg(F.max("width")).first()[0] or 0
    while widest > 1:
        firsts = siblings(levels[-1]).where(F.col("slot") == 0)
        parents = firsts.select(
            "tree",
            F.col("run").alias("idx"),
            hashed(F.col("digest"), F.col("r")).alias("digest"),
            F.ceil(F.col("width") / FAN).alias("width"),
        )
        levels.append(cut_lineage(parents))
        widest = -(-widest // FAN)
    return levels


def roots_of(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the single node in which each tree ends."""
    ends = [level.where(F.col("width") == 1).select("tree", "digest") for level in levels]
    return reduce(DataFrame.union, ends)


def paths_down(levels: list[DataFrame], seeds: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(tree, idx, path, subroot) and the columns ``carry`` of the lowest level.

    ``path`` holds the siblings (l, r) of the node, of its parent and so on; at the root of a
    tree it goes on with the path of ``seeds`` (tree, path, subroot).
    """
    above = None
    for k, level in reversed(list(enumerate(levels))):
        names = ["tree", "idx", "path", "subroot", *(() if k else carry)]
        found = level.where(F.col("width") == 1).join(broadcast_if_small(seeds), "tree").select(names)
        if above is not None:
            over = above.select("tree", F.col("idx").alias("run"), F.col("path").alias("_path"), "subroot")
            path = F.concat(F.array(F.struct("l", "r")), "_path")
            # dealt by (tree, run) already, the siblings stay where they are
            here = siblings(level).join(over, ["tree", "run"]).withColumn("path", path)
            found = found.union(here.select(names))
        above = cut_lineage(found) if k else found
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: its leaf, subroot, root, proof and the check of a changed copy.

    Rows for which ``tampered`` holds are checked with A-Z of their text lower-cased (those
    whose id's CRC-32 5 divides, if not given). -> doc_id, source, leaf, subroot, root, path,
    proof_sha256, folded_root, verified; ``path`` lists the siblings left and right, level
    by level.
    """
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = [F.col(f) for f in FIELDS]
    changed = [*fields[:-1], ascii_lower(F.col("text"))]
    rows = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            leaf_of(fields).alias("leaf"),
            F.when(tampered, leaf_of(changed)).alias("other"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("width"))
    sources = cut_lineage(numbered(cut_lineage(sources), [], ["source"], "tree"))
    known = sources.select(F.col("source").alias("_source"), "tree", "width")
    placed = rows.join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("_source")))
    leaves = cut_lineage(
        numbered(placed.drop("_source"), ["tree"], ["doc_id", "leaf", "tie"], "idx").withColumn(
            "digest", F.col("leaf")
        )
    )
    levels = levels_of(leaves)
    subroots = cut_lineage(roots_of(levels))
    count = F.lit(sources.count()).cast("long")
    one_tree = F.lit(0).cast("long")
    top = levels_of(
        subroots.select(one_tree.alias("tree"), F.col("tree").alias("idx"), "digest", count.alias("width"))
    )
    ends = roots_of(top).select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot"))
    whole = paths_down(top, cut_lineage(ends)).withColumnRenamed("subroot", "root")
    seeds = subroots.withColumnRenamed("digest", "subroot").join(
        whole.select(F.col("idx").alias("tree"), "path", "root"), "tree"
    )
    root = seeds.select("root").first()
    root = F.lit(root[0] if root else None).cast("string")
    carried = ("doc_id", "source", "leaf", "other")
    out = paths_down(levels, cut_lineage(seeds.select("tree", "path", "subroot")), carried)
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["l"], p["r"])), "")
    folded = F.aggregate(
        "path", F.coalesce("other", "leaf"), lambda node, p: hashed(p["l"], node, p["r"])
    )
    return out.select(
        "doc_id",
        "source",
        "leaf",
        "subroot",
        root.alias("root"),
        "path",
        hashed(proof).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
