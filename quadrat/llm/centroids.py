"""Centroid clustering of integer vectors by scalar lookup tables.

Components become integers (the floor of ``scale`` times the value), so every distance,
sum and centroid is exact and reruns agree bit by bit. Vectors lie in blocks; a block keeps,
for each dimension, the integer values that occur in it and, per vector, the place of its
value. In each round a task tabulates for every (dimension, occurring value, centroid) the
squared difference once; the distance of a vector is then a sum of gathered table rows, and
no vector is subtracted from a centroid. Only sums per (cluster, dimension) leave the tasks.

Defined cases: a vector is kept if it has exactly ``dimensions`` components and none of them
is null or not finite; ids may be null (they hash as the text ``null``) or repeat (equal ids
start in the order of their components); fewer vectors than clusters give one cluster each;
an empty centroid stays where it was; no kept vector, no rows; other columns are not looked
at. Integers beyond 2^27 are computed with Python's unbounded ones, and a distance or an
inertia beyond a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_with_tasks

ship_with_tasks(__name__)

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
BLOCK = 4096  # vectors of a block: bounds the tables and the gathered rows of a task
PLAIN = 1 << 27  # squared differences below this sum up within a long
LONG = (1 << 63) - 1
LIMB = 40  # sums leave a task in parts of so many bits, which Spark adds exactly


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    """Exact floors of ``scale * value``: longs, or Python integers where one is large."""
    wide = np.abs(values) >= PLAIN // scale
    if not wide.any():
        return np.floor(values * scale).astype(np.int64)
    # a double this large is whole, and scaling it could overflow
    exact = [int(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale) for v in values.flat]
    return np.array(exact, dtype=object).reshape(values.shape)


def distances(values: np.ndarray, dims: np.ndarray, codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, vectors x centroids.

    ``values`` are the occurring values of all dimensions in a row, ``dims`` the dimension of
    each, ``codes`` (dimensions x vectors) the places of the vectors' values among them.
    """
    table = (values[:, None] - centroids.T[dims]) ** 2
    total = table[codes[0]]
    for places in codes[1:]:
        total = total + table[places]
    return total


def limbs(number: int) -> list[int]:
    """The number cut into signed parts of LIMB bits, lowest first."""
    sign, rest, out = (-1 if number < 0 else 1), abs(number), []
    while rest:
        rest, low = rest >> LIMB, rest & ((1 << LIMB) - 1)
        out.append(sign * low)
    return out


def _blocks(scale: int, size: int):
    """Rows (vec_id, embedding) -> blocks (ids, values, dims, codes)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
                whole = quantised(flat.astype(np.float64).reshape(part.num_rows, -1), scale)
                values, dims, codes, start = [], [], [], 0
                for d in range(whole.shape[1]):
                    occurring, places = np.unique(whole[:, d], return_inverse=True)
                    values += occurring.tolist()
                    dims.append(np.full(len(occurring), d, np.int32))
                    codes.append((places + start).astype(np.int32))
                    start += len(occurring)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([list(map(str, values))], pa.list_(pa.string())),
                        pa.array([np.concatenate(dims).tobytes()], pa.binary()),
                        pa.array([np.concatenate(codes).tobytes()], pa.binary()),
                    ],
                    names=["ids", "values", "dims", "codes"],
                )

    return pack


BLOCK_SCHEMA = "ids array<long>, values array<string>, dims binary, codes binary"


def _opened(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]):
    """(ids, values, codes, cluster of each vector, its squared distance) of each block."""
    most = max(abs(x) for c in centroids for x in c)
    for batch in batches:
        for ids, texts, dims, codes in zip(*(batch.column(c) for c in ("ids", "values", "dims", "codes"))):
            numbers = list(map(int, texts.as_py()))
            plain = max(most, *map(abs, numbers)) <= PLAIN
            kind = np.int64 if plain else object
            values = np.array(numbers, dtype=kind)
            places = np.frombuffer(codes.as_py(), np.int32).reshape(len(centroids[0]), -1)
            total = distances(
                values, np.frombuffer(dims.as_py(), np.int32), places, np.array(centroids, dtype=kind)
            )
            # the first of equal distances is the smaller number
            cluster = total.argmin(axis=1).astype(np.int32)
            yield ids.as_py(), values, places, cluster, total[np.arange(len(cluster)), cluster]


def _sums(centroids: list[list[int]]):
    """Blocks -> (cluster, dim, limb, part): one set of sums per task; dim -1 counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * len(centroids[0]) for _ in centroids]
        counts = [0] * len(centroids)
        for _, values, places, cluster, _ in _opened(batches, centroids):
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                counts[c] += int(mine.sum())
                added = values[places[:, mine]].sum(axis=1).tolist()
                sums[c] = [a + b for a, b in zip(sums[c], added)]
        rows = [
            (c, d, k, part)
            for c, n in enumerate(counts)
            if n
            for d, number in [(-1, n), *enumerate(sums[c])]
            for k, part in enumerate(limbs(number))
        ]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "dim", "limb", "part"])

    return add


def _assigned(centroids: list[list[int]]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, cluster, distance in _opened(batches, centroids):
            longs = [min(d, LONG) for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(cluster), pa.array(longs, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return assign


def kept(vectors: DataFrame, dimensions: int) -> DataFrame:
    """(vec_id, embedding) of the vectors with all components there and finite."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    ok = (F.size("embedding") == dimensions) & finite
    return vectors.select("vec_id", F.col("embedding").cast("array<double>")).where(ok)


def first_centroids(vectors: DataFrame, clusters: int, scale: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest hashes of ``seed:vec_id``, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    digest = F.sha2(name.cast("binary"), 256)
    rows = vectors.select("embedding", digest.alias("digest")).orderBy("digest", "embedding").limit(clusters)
    return [quantised(np.array(r["embedding"]), scale).tolist() for r in rows.collect()]


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the floored means of the vectors nearest to each centroid."""
    parts = blocks.mapInArrow(_sums(centroids), "cluster int, dim int, limb int, part long")
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("part")
    sums: dict[tuple[int, int], int] = {}
    # bounded by clusters x dimensions x the few limbs of a sum
    for r in parts.groupBy("cluster", "dim", "limb").agg(total).collect():
        at = r["cluster"], r["dim"]
        sums[at] = sums.get(at, 0) + (int(r["part"]) << (LIMB * r["limb"]))
    return [
        [sums.get((c, d), 0) // sums[c, -1] for d in range(len(old))] if (c, -1) in sums else old
        for c, old in enumerate(centroids)
    ]


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of each kept vector, the final centroids)."""
    spark = vectors.sparkSession
    chosen = kept(vectors, dimensions)
    centroids = first_centroids(chosen, clusters, scale, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    blocks = cut_lineage(chosen.mapInArrow(_blocks(scale, BLOCK), BLOCK_SCHEMA))
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    assigned = blocks.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long")
    return cut_lineage(assigned), centroids


def report(vectors: DataFrame, **parameters: int) -> DataFrame:
    """One row per kept vector with its cluster's and the whole clustering's inertia."""
    assigned, centroids = cluster(vectors, **parameters)
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r["cluster"]: min(int(r["total"]), LONG) for r in assigned.groupBy("cluster").agg(total).collect()}
    everything = min(sum(sums.values()), LONG)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = [
        F.struct(F.lit(sums.get(c, 0)).cast("long").alias("sum"), F.lit(digest).alias("digest"))
        for c, digest in enumerate(digests)
    ] or [F.struct(F.lit(0).cast("long").alias("sum"), F.lit("").alias("digest"))]
    own = F.array(*known)[F.col("cluster")]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        own["sum"].alias("cluster_inertia"),
        F.lit(everything).cast("long").alias("inertia"),
        own["digest"].alias("centroid_sha256"),
    )
