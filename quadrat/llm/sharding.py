"""Sharding by a hierarchical weighted hash tree.

A document descends from the root to a region, a rack and a shard. At each level every
child draws an exponential variate, its rate the child's weight, from the hash of the
child's name and the document's id; the smallest draw wins, so children win in proportion
to their weights. A child's draw does not depend on its siblings: where a weight changes
or a child is added, only documents that the changed subtree wins or loses move, and below
an unchanged subtree nothing moves.

Defined cases: a null text has no bytes; documents with a null id share one shard, since
the id decides; equal rows get different slots; other columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import hash_bits, running_sums, slice_bits

SHARDS = 24
REGIONS, RACKS = 2, 3  # the first SHARDS shards: 2 regions of 3 racks of 4 shards
DRAW_BITS = 52
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(count: int, base: int = SHARDS, weights: dict[int, float] | None = None) -> Tree:
    """The tree of ``count`` shards: region -> rack -> shard -> weight (1 if not given).

    The first ``base`` shards are dealt evenly over REGIONS x RACKS. Each further shard opens
    a region of its own: no weight above an old shard changes, so rows move to the new shard
    alone.
    """
    per_rack = -(-base // (REGIONS * RACKS))
    tree: Tree = {}
    for shard in range(count):
        if shard < base:
            rack = shard // per_rack
            at = f"g{rack // RACKS}", f"r{rack}"
        else:
            at = f"g{REGIONS + shard - base}", f"r{REGIONS * RACKS + shard - base}"
        tree.setdefault(at[0], {}).setdefault(at[1], {})[shard] = (weights or {}).get(shard, 1.0)
    return tree


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _levels(tree: Tree) -> list[dict[str, list[tuple[str, float]]]]:
    """For each level: path of a node -> its children's names and weights above 0."""
    levels, nodes = [], {"": tree}
    while any(isinstance(node, dict) for node in nodes.values()):
        level, below = {}, {}
        for path, node in nodes.items():
            level[path] = [(str(n), _weight(c)) for n, c in node.items() if _weight(c) > 0]
            below |= {f"{path}/{n}": c for n, c in node.items()}
        levels.append(level)
        nodes = below
    return levels


def _drawer(path: Column, key: Column):
    """child -> (draw, name): exponential with the child's weight as its rate."""

    def draw(child: Column) -> Column:
        bits = hash_bits(F.concat(path, F.lit("/"), child["name"]), key, DRAW_BITS)
        uniform = (bits + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["name"].alias("name"))

    return draw


def shard_of(tree: Tree, key: Column) -> Column:
    """The shard (int) of a key: at each level the child with the smallest draw."""
    path = F.lit("")
    for level in _levels(tree):
        pairs = []
        for node, children in level.items():
            named = [F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in children]
            pairs += [F.lit(node), F.array(*named)]

        won = F.array_min(F.transform(F.create_map(*pairs)[path], _drawer(path, key)))
        path = F.concat(path, F.lit("/"), won["name"])
    return F.element_at(F.split(path, "/"), -1).cast("int")


def place(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``slot`` numbers a shard's documents from 0 without gaps, in the order of a hash;
    ``grown_shard`` is the shard once one more has been added.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = cut_lineage(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text).alias("text_crc32"),
            shard_of(tree_of(count), F.col("doc_id")).alias("shard"),
            shard_of(tree_of(count + 1), F.col("doc_id")).alias("grown_shard"),
        ).select(
            "*",
            hash_bits("slot", F.concat_ws(":", "doc_id", "text_crc32")).alias("key"),
            F.lit(1).alias("one"),
        )
    )
    bits = slice_bits(placed.count() // max(1, count))
    placed = placed.withColumn("part", F.shiftright("key", 60 - bits) if bits else F.lit(0))
    order = ["key", "doc_id", "size", "text_crc32"]
    return running_sums(placed, ["shard"], "part", order, "one", "slot").select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
