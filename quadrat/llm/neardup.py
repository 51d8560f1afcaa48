"""Near-duplicate documents by SetSketch registers.

A text's set is that of its five-word shingles. Register i holds the integer logarithm,
to a base just above 1, of the smallest exponential variate that any shingle draws from
hash function i: registers of a union are maxima, so sketches merge, and two registers
agree about as often as the sets do. Four neighbouring registers are a band; texts that
agree on a band are candidates.

1. Texts with equal words are one class from the start.
2. In each group of classes that share a band, one hash-chosen hub is compared with each
   member: as many pairs as members. The hubs of the first band meet every member, those of
   the others, a few bands at a time, the members that are not yet in the hub's component.
3. What is still apart in a group is compared across its components, the group cut into
   blocks and sketch against sketch within a task: no pair of band mates from two components
   is left out, and none from one component needs a test. Likely pairs stay together by the
   two blocks they lie in, and so do the full sets they are tested on: what is moved grows
   with the members of the blocks and not with the pairs.
4. A pair is likely unless the estimate from its joint register counts (who is larger, how
   often) is four deviations short. Likely pairs are tested on the full shingle sets.

Defined cases: a null, empty or blank text has an empty set and is linked with nothing;
fewer than five words are one shingle; equal rows are copies; documents whose id is null
take part, give way to any document with an id, and are kept where there is none; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..session import cut_lineage, ship_with_tasks
from .components import components

ship_with_tasks(__name__)

SHINGLE = 5
SHARE = 75  # per cent of the union that two linked sets share at least
REGISTERS, BANDS, BAND = 512, 32, 4  # the first BANDS x BAND registers make the bands
BASE, RATE, TOP = 1.1, 20.0, 254  # a register is one byte
# members of a block, and shingles of all its members, about
BLOCK_NODES, BLOCK_HASHES, PAIRS_AT_ONCE = 256, 1 << 18, 8192
# bands whose hubs meet their members in one round, from the first band on
HUB_ROUNDS = ((0, 1), (1, 4), (4, BANDS))
# a pair at the bound is passed on with a probability of 0.99997
DEVIATIONS = 4.0

_MIX = np.random.default_rng(20210127)
_FACTORS = _MIX.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _MIX.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_PLACES = _MIX.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words; ``bytes`` methods know ASCII letters and white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    n = len(words)
    if n < SHINGLE:
        whole = [xxhash.xxh3_64_intdigest(b" ".join(words), n)] if n else []
        return np.array(whole, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    x = h[: n - SHINGLE + 1] * _PLACES[0]
    for j in range(1, SHINGLE):
        x += h[j : n - SHINGLE + 1 + j] * _PLACES[j]
    return np.unique(_mixed(x))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set.

    The smallest exponential variate comes from the smallest hash, so the logarithm is
    taken once per register and not once per shingle.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    room = np.empty((_BLOCK, REGISTERS), np.uint32)
    # 32 bits are far finer than a register's steps, and twice as fast
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for s in range(0, len(short), _BLOCK):
        part = short[s : s + _BLOCK, None]
        out = room[: len(part)]
        np.multiply(part, _FACTORS, out=out)
        out += _SHIFTS
        np.minimum(least, out.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    variate = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, TOP + 1).astype(np.uint8)


def jaccard_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from their registers and set sizes.

    Of two sketches, ``a`` is larger at a register with probability p(u - v J) and smaller
    with p(v - u J), where u, v are the sizes' shares and p(x) = -log_b(1 - x (b-1)/b).
    The likelihood is concave in J; its maximum is narrowed down for all pairs at once.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - more - less
    u = na / (na + nb)
    v = 1 - u

    def likelihood(j: np.ndarray) -> np.ndarray:
        def p(x: np.ndarray) -> np.ndarray:
            return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

        up, down = p(u - v * j), p(v - u * j)
        logs = [np.log(np.maximum(x, 1e-12)) for x in (up, down, 1 - up - down)]
        return more * logs[0] + less * logs[1] + equal * logs[2]

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(25):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low = np.where(left, low + third, low)
        high = np.where(left, high, high - third)
    return (low + high) / 2


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in batch.column("text"):
            words = words_of(text.as_py())
            hashes = shingle_set(words)
            sizes.append(len(hashes))
            digests.append(hashlib.md5(b" ".join(words)).digest())
            sketches.append(registers(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(sketches, pa.binary()),
            ],
            names=["doc_id", "row", "n_shingles", "node", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, sets = [], []
        for text in batch.column("text"):
            words = words_of(text.as_py())
            digests.append(hashlib.md5(b" ".join(words)).digest())
            sets.append(shingle_set(words).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], names=["node", "hashes"]
        )


def _likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Which pairs of sketches may belong to linked sets."""
    share = SHARE / 100
    least = share - DEVIATIONS * np.sqrt(share * (1 - share) / REGISTERS)
    fits = 100 * np.minimum(na, nb) >= SHARE * np.maximum(na, nb)
    fits[fits] = jaccard_estimate(a[fits], b[fits], na[fits], nb[fits]) >= least
    return fits


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, REGISTERS)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (_sketches(batch.column(c).to_pylist()) for c in ("sketch_a", "sketch_b"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            yield batch.select(["a", "b"]).filter(pa.array(_likely(a, b, na, nb)))


MET = (
    "key long, band int, first long, block long, "
    "sides array<struct<side:int,no:int,label:int,node:binary>>, pairs binary"
)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likely pairs between two blocks of a group, each at the first band it shares.

    A row per two blocks: who takes part on either side, and the pairs of their numbers.
    """
    for batch in batches:
        rows: list[dict] = []
        for row in batch.to_pylist():
            band, x, y = row["band"], row.pop("x"), row.pop("y")
            sx, sy = (_sketches(m["sketch"] for m in z) for z in (x, y))
            nx, ny = (np.array([m["n_shingles"] for m in z], float) for z in (x, y))
            labels = {v: k for k, v in enumerate({m["label"] for m in x} | {m["label"] for m in y})}
            lx, ly = (np.array([labels[m["label"]] for m in z]) for z in (x, y))
            mx, my = (np.array([m["minor"] for m in z]) for z in (x, y))
            bx, by = (z[:, : BANDS * BAND].copy().view("<u4") for z in (sx, sy))
            first, second = [], []
            for i in range(len(x)):
                ok = (ly != lx[i]) & (my | mx[i])
                if row["first"] == row["block"]:
                    ok[: i + 1] = False
                k = np.flatnonzero(ok & (by[:, band] == bx[i, band]))
                k = k[(by[k, :band] != bx[i, :band]).all(axis=1)]
                first.append(np.full(len(k), i))
                second.append(k)
            first, second = np.concatenate(first), np.concatenate(second)
            fits = [np.empty(0, bool)]
            for at in range(0, len(first), PAIRS_AT_ONCE):
                i, k = first[at : at + PAIRS_AT_ONCE], second[at : at + PAIRS_AT_ONCE]
                fits.append(_likely(sx[i], sy[k], nx[i], ny[k]))
            fits = np.concatenate(fits)
            if fits.any():
                row["sides"], numbers = [], []
                for side, members, known, at in ((0, x, lx, first[fits]), (1, y, ly, second[fits])):
                    who, number = np.unique(at, return_inverse=True)
                    numbers.append(number)
                    row["sides"] += [
                        {"side": side, "no": no, "label": int(known[i]), "node": members[i]["node"]}
                        for no, i in enumerate(who.tolist())
                    ]
                rows.append(row | {"pairs": np.stack(numbers).astype("<u4").tobytes()})
        side = pa.struct([("side", pa.int32()), ("no", pa.int32()), ("label", pa.int32()), ("node", pa.binary())])
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(side), pa.binary())
        names = ["key", "band", "first", "block", "sides", "pairs"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in zip(names, kinds)], names=names
        )


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets are linked."""
    common = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * common >= SHARE * (len(x) + len(y) - common)


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed links between two blocks, those that join what is apart until then."""
    for batch in batches:
        found: list[tuple[bytes, bytes]] = []
        for members, pairs in zip(batch.column("members"), batch.column("pairs")):
            sides: tuple[dict, dict] = ({}, {})
            for m in members.as_py():
                sides[m["side"]][m["no"]] = m["label"], m["node"], np.frombuffer(m["hashes"], np.uint64)
            above: dict[int, int] = {}

            def top(label: int) -> int:
                while label in above:
                    label = above[label]
                return label

            for i, k in np.frombuffer(pairs.as_py(), "<u4").reshape(2, -1).T.tolist():
                (la, a, x), (lb, b, y) = sides[0][i], sides[1][k]
                la, lb = top(la), top(lb)
                if la != lb and _similar(x, y):
                    above[lb] = la
                    found.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in found], pa.binary()) for j in (0, 1)], names=["a", "b"]
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sure = []
        for x, y in zip(batch.column("hashes_a"), batch.column("hashes_b")):
            sure.append(_similar(*(np.frombuffer(z.as_py(), np.uint64) for z in (x, y))))
        yield batch.select(["a", "b"]).filter(pa.array(sure, pa.bool_()))


def _with(pairs: DataFrame, side: str, nodes: DataFrame, **columns: str) -> DataFrame:
    """``pairs`` with columns of the node on one side."""
    named = nodes.select(
        F.col("node").alias(side), *[F.col(old).alias(new) for new, old in columns.items()]
    )
    return pairs.join(named, side)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the registers do not rule out."""
    pairs = _with(pairs, "a", classes, n_a="n_shingles", sketch_a="sketch")
    pairs = _with(pairs, "b", classes, n_b="n_shingles", sketch_b="sketch")
    return cut_lineage(pairs.mapInArrow(_plausible, "a binary, b binary"))


def _full_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, hashes) of the wanted nodes, each named once."""
    rows = cut_lineage(wanted.join(classes, "node").select("row").distinct())
    texts = docs.select("row", "text").join(broadcast_if_small(rows), "row", "left_semi")
    # a row hash may stand for another text as well: the digest decides
    sets = texts.select("text").mapInArrow(_sets, "node binary, hashes binary")
    return cut_lineage(sets.groupBy("node").agg(F.first("hashes").alias("hashes")))


def _confirmed(likely: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ends = likely.select(F.col("a").alias("node")).distinct()
    wanted = ends.union(likely.select(F.col("b").alias("node")).distinct()).distinct()
    sets = _full_sets(wanted, classes, docs)
    full = _with(_with(likely, "a", sets, hashes_a="hashes"), "b", sets, hashes_b="hashes")
    return cut_lineage(full.mapInArrow(_linked, "a binary, b binary"))


def _banded(classes: DataFrame) -> DataFrame:
    """(node, n_shingles, band, key): a row per class and band."""
    keys = [F.xxhash64(F.lit(k), F.substring("sketch", 1 + k * BAND, BAND)) for k in range(BANDS)]
    return classes.select("node", "n_shingles", F.posexplode(F.array(*keys)).alias("band", "key"))


def _rank(doc_id: str, row: str) -> Column:
    """Which document of a group goes first: the smallest id; null ids last, then by hash."""
    return F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(row))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links reach, the document's own included.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return _grouped(docs).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, row, n_shingles, component_id, first: ``first`` is the group's row to keep."""
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    signed = cut_lineage(
        docs.mapInArrow(
            _signatures, "doc_id long, row long, n_shingles long, node binary, sketch binary"
        )
    )
    classes = cut_lineage(
        signed.where(F.col("n_shingles") > 0)
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min_by("row", _rank("doc_id", "row")).alias("row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
    )
    banded = _banded(classes)
    # one order of the nodes for all keys: groups that share members then share their hub
    hub = F.min_by("node", F.xxhash64("node")).alias("hub")
    hubs = banded.groupBy("key").agg(hub, F.count(F.lit(1)).alias("members"))
    mates = cut_lineage(
        banded.join(hubs.where(F.col("members") > 1), "key").select("key", "band", "node", "n_shingles", "hub")
    )
    # a round's hubs settle most members; those of the next one are for the rest
    tested = links = labels = None
    for first, end in HUB_ROUNDS:
        some = mates.where((F.col("band") >= first) & (F.col("band") < end))
        pairs = _hub_pairs(some if labels is None else _unsettled(some, labels))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        found = _confirmed(_estimated(pairs, classes), classes, docs)
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        labels = components(links)
    more = _apart(mates, labels, classes, docs)
    if not more.isEmpty():
        labels = components(links.union(more))
    placed = classes.select("node", "first_id", "row").join(labels, "node", "left")
    placed = cut_lineage(placed.withColumn("label", F.coalesce("label", "node")))
    least = placed.groupBy("label").agg(
        F.min("first_id").alias("component_id"),
        F.min_by("row", _rank("first_id", "row")).alias("first"),
    )
    found = cut_lineage(placed.join(least, "label").select("node", "component_id", "first"))
    out = signed.drop("sketch").join(found, "node", "left").drop("node")
    alone = F.col("n_shingles") == 0
    return out.withColumns(
        {
            "component_id": F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")),
            "first": F.when(alone, F.col("row")).otherwise(F.col("first")),
        }
    )


def _hub_pairs(mates: DataFrame) -> DataFrame:
    """Each member with its group's hub, as distinct pairs (a, b)."""
    pairs = mates.where(F.col("node") != F.col("hub"))
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _unsettled(mates: DataFrame, labels: DataFrame) -> DataFrame:
    """Members that are not yet in the component of their group's hub."""
    own = labels.select("node", F.col("label").alias("own"))
    hubs = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    named = mates.join(own, "node", "left").join(hubs, "hub", "left")
    apart = F.coalesce("own", "node") != F.coalesce("hub_label", "hub")
    return named.where(apart).select("node", "hub")


def _apart(mates: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of band mates that lie in two components: enough of them to join these."""
    named = mates.join(labels, "node", "left").select(
        "key", "band", "node", "n_shingles", F.coalesce("label", "node").alias("label")
    )
    counted = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    split = counted.groupBy("key").agg(
        F.max_by("label", F.struct("n", "label")).alias("major"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("n").alias("members"),
        F.sum("size").alias("size"),
    )
    count = F.ceil(F.greatest(F.col("members") / BLOCK_NODES, F.col("size") / BLOCK_HASHES))
    # of two members one is the hub, and the pair is tested
    split = split.where((F.col("parts") > 1) & (F.col("members") > 2)).drop("parts")
    member = F.struct("node", "label", (F.col("label") != F.col("major")).alias("minor"), "n_shingles", "sketch")
    blocks = (
        named.join(split, "key")
        .join(classes.select("node", "sketch"), "node")
        .select(
            "key",
            "band",
            F.pmod(F.xxhash64("node"), count).alias("block"),
            member.alias("member"),
        )
        .groupBy("key", "band", "block")
        .agg(F.collect_list("member").alias("members"))
    )
    blocks = cut_lineage(blocks.withColumn("open", F.exists("members", lambda m: m["minor"])))
    left = blocks.select("key", "band", F.col("block").alias("first"), F.col("members").alias("x"), F.col("open").alias("x_open"))
    pairs = left.join(blocks, ["key", "band"]).where(
        (F.col("first") <= F.col("block")) & (F.col("x_open") | F.col("open"))
    )
    blocked = pairs.select("key", "band", "first", "block", "x", F.col("members").alias("y"))
    met = cut_lineage(blocked.mapInArrow(_across, MET))
    at = ["key", "band", "first", "block"]
    asked = met.select(*at, F.explode("sides").alias("s")).select(*at, "s.*")
    sets = _full_sets(asked.select("node").distinct(), classes, docs)
    member = F.struct("side", "no", "label", "node", "hashes")
    held = asked.join(sets, "node").groupBy(*at).agg(F.collect_list(member).alias("members"))
    full = held.join(met.select(*at, "pairs"), at).select("members", "pairs")
    return cut_lineage(full.mapInArrow(_joining, "a binary, b binary"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group; all columns stay.

    Documents with empty sets are in no group, and all stay.
    """
    rows = cut_lineage(
        _grouped(docs)
        .groupBy("row")
        .agg(
            F.first(F.col("row") == F.col("first")).alias("stays"),
            (F.max("n_shingles") > 0).alias("grouped"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    drop = rows.where(~F.col("stays")).select(F.col("row").alias("_row"))
    again = rows.where(F.col("stays") & F.col("grouped") & (F.col("n") > 1))
    again = broadcast_if_small(again.select(F.col("row").alias("_row")))
    whole = docs.select(F.struct("*").alias("_doc"), F.xxhash64("doc_id", "text").alias("_row"))
    left = whole.join(broadcast_if_small(drop), "_row", "left_anti")
    # equal rows of one id: one of them
    once = left.join(again, "_row", "left_semi").dropDuplicates(["_row"])
    return left.join(again, "_row", "left_anti").unionByName(once).select("_doc.*")
