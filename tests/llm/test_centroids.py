import hashlib
import math
import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from quadrat.llm import centroids as ct

KINDS = "vec_id long, embedding array<double>"


def brute(rows, clusters=8, rounds=10, width=64):
    whole = lambda x: x is not None and math.isfinite(x)
    kept = [(i, v) for i, v in rows if v is not None and len(v) == width and all(map(whole, v))]
    q = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(q, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, z)), c) for c, z in enumerate(middle))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in q]
        for c in set(at):
            mine = [v for (_, v), k in zip(q, at) if k == c]
            middle[c] = [sum(x) // len(mine) for x in zip(*mine)]
    far = [(i, *near(v)) for i, v in q]
    cap = (1 << 63) - 1
    total = {c: sum(d for _, d, k in far if k == c) for c in range(len(middle))}
    sha = [hashlib.sha256(",".join(map(str, z)).encode()).hexdigest() for z in middle]
    every = min(sum(total.values()), cap)
    out = [(i, c, min(d, cap), min(total[c], cap), every, sha[c]) for i, d, c in far]
    return sorted(out, key=repr)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, KINDS)
    for name in ("ids", "cluster", "distance", "codes", "digest"):
        df = df.withColumn(name, F.lit("x"))
    return sorted((tuple(r) for r in ct.report(df.repartition(3), **how).collect()), key=repr)


def vectors(n, spread=1.0, width=64):
    draw = random.Random(4)
    heads = [[draw.gauss(0, spread) for _ in range(width)] for _ in range(6)]
    return [(k, [x + draw.gauss(0, spread / 4) for x in heads[k % 6]]) for k in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", 37)
    rows = vectors(300)
    rows += [(900, None), (901, []), (902, [0.0] * 63), (903, [0.0] * 65), (904, [None] + [0.0] * 63)]
    rows += [(905, [float("nan")] + [0.0] * 63), (906, [float("inf")] + [1.0] * 63)]
    rows += [(None, [0.25] * 64), (None, [0.5] * 64), (3, rows[3][1]), (3, rows[4][1]), (907, [-0.0001] * 64)]
    assert found(spark, rows) == brute(rows)


def test_a_common_vector_and_ties(spark):
    rows = [(k, [0.5] * 64) for k in range(200)] + [(500 + k, [float(k % 2)] * 64) for k in range(10)]
    assert found(spark, rows) == brute(rows)


def test_large_numbers_stay_exact(spark):
    rows = vectors(40) + [(100 + k, [1e6 * k] + [1e-3] * 63) for k in range(20)]
    rows += [(200, [1.7e308] * 64), (201, [-1.7e308] * 64), (202, [3e15 + 0.5] * 64), (203, [1e300] * 64)]
    assert found(spark, rows) == brute(rows)


def test_few_and_none(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == []
    assert found(spark, vectors(3)) == brute(vectors(3))


def test_other_parameters(spark):
    rows = vectors(60, width=5)
    got = found(spark, rows, clusters=3, rounds=2, dimensions=5)
    assert got == brute(rows, 3, 2, 5)


def test_tables_give_the_plain_distances():
    draw = np.random.default_rng(1)
    whole, middle = draw.integers(-50, 50, (30, 4)), draw.integers(-50, 50, (3, 4))
    values, dims, codes = [], [], []
    for d in range(4):
        occurring, places = np.unique(whole[:, d], return_inverse=True)
        codes.append(places + sum(map(len, values)))
        values.append(occurring)
        dims.append(np.full(len(occurring), d))
    got = ct.distances(np.concatenate(values), np.concatenate(dims), np.array(codes), middle)
    assert (got == ((whole[:, None] - middle[None]) ** 2).sum(axis=2)).all()


def test_limbs():
    for number in (0, 5, -5, 1 << 40, -(1 << 100) - 17):
        assert sum(part << (ct.LIMB * k) for k, part in enumerate(ct.limbs(number))) == number
