import zlib
from collections import Counter

from pyspark.sql import functions as F

from quadrat.llm import sharding


def test_places(make):
    rows = [(k, "x" * (k % 50) + "é") for k in range(600)] + [(None, None), (None, "a"), (7, "é"), (7, "é"), (8, "")]
    got = sharding.place(make(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert set(shards) <= set(range(24)) and len(shards) == 24
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    for key in (7, None):
        assert len({r.shard for r in got if r.doc_id == key}) == 1
    assert sharding.place(make([])).count() == 0


def shards(spark, tree, n=20_000):
    df = spark.range(n).select("id", sharding.shard_of(tree, F.col("id")).alias("s"))
    return {r.id: r.s for r in df.collect()}


def test_weights_and_movement(spark):
    plain = shards(spark, sharding.tree_of(24))
    counts = Counter(plain.values())
    assert all(abs(c - 20_000 / 24) < 6 * (20_000 / 24) ** 0.5 for c in counts.values())
    heavy = shards(spark, sharding.tree_of(24, weights={5: 3.0}))
    assert 2.6 < Counter(heavy.values())[5] / counts[5] < 3.4
    # shard 5 is in the first region: nothing moves within the second, or into its shards
    for k, s in plain.items():
        assert heavy[k] == s or heavy[k] < 12
    grown = shards(spark, sharding.tree_of(26))
    before = shards(spark, sharding.tree_of(25))
    assert all(grown[k] in (s, 25) for k, s in before.items())
    gone = shards(spark, sharding.tree_of(24, weights={5: 0.0}))
    assert 5 not in gone.values()
