import hashlib
import zlib

from pyspark.sql import functions as F

from quadrat.llm import manifest as mf


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    fields = list(row)
    if lower and fields[4] is not None:
        fields[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in fields[4])
    marks = ["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields]
    return h("".join(marks))


def climb(nodes):
    """Root of a list of digests, and each one's path of (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // 16 * 16
            paths[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + 16])))
        at = [k // 16 for k in at]
        nodes = [h("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        mine = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = mine, *climb([leaf(r) for r in mine])
    root, tops = climb([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        mine, sub, paths = trees[s]
        for r, path in zip(mine, paths):
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for left, right in path + top:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in path + top))
            out.append((r[0], s, leaf(r), sub, root, proof, node, node == root))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name in ("tree", "idx", "digest", "width", "run", "slot", "l", "r", "path", "_one"):
        df = df.withColumn(name, F.lit("x"))
    got = mf.manifest(df).drop("path")
    return got, sorted((tuple(r) for r in got.collect()), key=repr)


def corpus():
    rows = [(k, f"s{k % 3}", "en", k, f"Text {k} É") for k in range(300, 0, -1)]
    rows += [(1000 + k, "big", None, None, "A" * (k % 5)) for k in range(273)]
    rows += [(2000 + k, f"one {k}", "en", 1, "B") for k in range(20)]
    rows += [(None, "s1", None, None, None), (None, None, None, None, "Null"), (7, "s1", "en", 7, "again"), (7, "s1", "en", 7, "again")]
    return rows + [(3000, "", "en", 0, ""), (3001, "Ω", "en", 9, "word " * 40_000), (3002, "￮", None, 1, "A"), (3003, "\U0001f600", None, 1, "Z")]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mf, "SLICE_ROWS", 60)
    rows = corpus()
    got, out = found(spark, rows)
    assert out == brute(rows)
    assert {r[0] for r in out if not r[-1]} <= {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert any(not r[-1] for r in out)


def test_full_runs_and_single_nodes(spark):
    for n in (1, 17, 256):
        rows = [(k, "s", "en", k, f"T{k}") for k in range(n)]
        assert found(spark, rows)[1] == brute(rows)


def test_empty(spark):
    got, out = found(spark, [])
    assert out == [] and "proof_sha256" in got.columns


def test_any_change_is_seen(spark):
    rows = [(k, "s", "en", k, f"low {k}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    # nothing to lower-case: the changed copy is the row itself
    assert all(r.verified for r in mf.manifest(df, F.lit(True)).collect())


def test_windows_hold_one_run(spark):
    rows = [(k, "s", "en", k, "t") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    plan = mf.manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert "Window [lag" in plan and ", [tree" in plan
