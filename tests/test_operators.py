import json
import random

import pytest
from pyspark.sql import functions as F

from quadrat.errors import PlotDataError
from quadrat.model import SurveyTables
from quadrat.operators import align, discovery, images, lookup, paging, samples, saved, selection, spatial
from quadrat.operators.selection import Selection
from quadrat.sources import readers

# --- hot keys ---------------------------------------------------------------------


def test_hot_code_is_split(spark, monkeypatch, tmp_path):
    """Beyond the broadcast bound, a code that most rows share is split over tasks."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 10 < 8, F.lit("u0")).otherwise(F.concat(F.lit("u"), F.col("id") % 50))
        facts = spark.range(0, 60000, 1, 8).select("id", hot.alias("code"))
        vocab = spark.range(50).select(
            F.lit("f").alias("facet"),
            F.concat(F.lit("u"), F.col("id")).alias("uri"),
            F.concat(F.lit("l"), F.col("id")).alias("label"),
        )
        named = lookup.add_label(facts, vocab, "f", "code", "label")
        assert named.where(F.substring("label", 2, 9) == F.substring("code", 2, 9)).count() == 60000
        named.collect()
        assert "skew=true" in named._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- selections -------------------------------------------------------------------


def test_selection_edits(spark):
    empty = Selection("observations")
    one = empty.add(spark, {"site_id": "A"}).add(spark, {"site_id": ["B", "A"], "feature_type": "soil"})
    assert one.values == {"site_id": ("A", "B"), "feature_type": ("soil",)} and empty.values == {}
    assert one.drop({"site_id": "A"}).values["site_id"] == ("B",)
    assert "site_id" not in one.drop({"site_id": None}).values
    assert "site_id" not in one.drop({"site_id": ["A", "B"]}).values
    for bad in ({"nope": 1}, {"region": "Q"}, {"has_image": True}, {"date_from": "x"}):
        with pytest.raises(PlotDataError):
            empty.add(spark, bad)
    with pytest.raises(KeyError):
        one.drop({"dataset": None})
    with pytest.raises(PlotDataError):
        one.drop({"site_id": "Z"})
    region = empty.add(spark, {"region_type": "t", "region": "r"})
    assert region.drop({"region_type": None}).values == {}


def test_sample_literals(spark):
    s = Selection("samples").add(
        spark,
        {
            "has_image": [True],
            "soil_subsite": ["1", 2, 1],
            "soil_subsite_id": 3,
            "soil_depth_range": {"min": 0, "max": "0.3"},
            "date_to": "21st May 2020",
        },
    )
    assert s.values == {
        "has_image": True,
        "soil_subsite_id": (1, 2, 3),
        "soil_depth_range": (0.0, 0.3),
        "date_to": "2020-05-21",
    }
    for bad in (
        {"has_image": "yes"},
        {"has_image": [True, False]},
        {"soil_subsite_id": "x"},
        {"soil_depth_range": [1]},
        {"soil_depth_range": [0.3, 0.1]},
        {"soil_depth_range": ["a", 1]},
        {"spatial": "POLYGON((0 0"},
    ):
        with pytest.raises(PlotDataError):
            s.add(spark, bad)
    with pytest.raises(PlotDataError, match="required dataset"):
        s.drop({"dataset": None})
    saved = [r[1:] for r in s.rows("k")]
    assert Selection.from_rows("samples", saved) == s


def test_long_value_list_becomes_a_semi_join(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("site_id"))
    wanted = [str(i) for i in range(0, 3000, 2)]
    chosen = Selection("observations").add(spark, {"site_id": wanted})
    assert chosen.apply(df, SurveyTables()).count() == 1500


def test_has_image(spark):
    cells = {
        None: False,
        "[]": False,
        '["  "]': False,
        '["x"]': True,
        '[{"a":" "},{"b":"u"}]': True,
        '[{"a":1,"b":null}]': False,
        '[{"a":{"b":"deep"}}]': False,
        '[[ "x" ]]': False,
        '{"original":"u"}': False,
        '"text"': False,
        "[1, true]": False,
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r["c"]: r["ok"] for r in df.select("c", selection.has_image(F.col("c")).alias("ok")).collect()}
    assert got == cells


def test_count_selections_against_each_selection(spark):
    rnd = random.Random(5)
    days = [None] + [f"2020-01-{d:02d}" for d in range(1, 29)]
    rows = [
        (rnd.choice(["a", "b", "c", None]), rnd.choice(["x", "y"]), rnd.choice(days))
        for _ in range(600)
    ]
    facts = spark.createDataFrame(rows, "dataset string, feature_type string, d string").select(
        "dataset", "feature_type", F.col("d").cast("date").alias("visit_date")
    )
    asked = {}
    for i in range(40):
        edits = {}
        if rnd.random() < 0.6:
            edits["dataset"] = rnd.sample(["a", "b", "c", "zz"], rnd.randint(1, 3))
        if rnd.random() < 0.6:
            edits["feature_type"] = rnd.sample(["x", "y"], rnd.randint(1, 2))
        if rnd.random() < 0.6:
            edits["date_from"] = f"2020-01-{rnd.randint(1, 28):02d}"
        if rnd.random() < 0.6:
            edits["date_to"] = f"2020-01-{rnd.randint(1, 28):02d}"
        if edits:
            asked[f"s{i}"] = Selection("observations").add(spark, edits)
    spec = spark.createDataFrame(
        [r for k, s in asked.items() for r in s.rows(k)],
        "spec_id string, facet string, op string, value string",
    )
    got = {
        r["spec_id"]: r["rows"]
        for r in saved.count_selections(facts, spec, ["dataset", "feature_type"]).collect()
    }

    def matches(s, row):
        dataset, kind, day = row
        v = s.values
        return (
            ("dataset" not in v or dataset in v["dataset"])
            and ("feature_type" not in v or kind in v["feature_type"])
            and ("date_from" not in v or (day is not None and day >= v["date_from"]))
            and ("date_to" not in v or (day is not None and day <= v["date_to"]))
        )

    assert got == {k: sum(matches(s, r) for r in rows) for k, s in asked.items()}
    other = spark.createDataFrame([("s", "region_type", "in", "states")], spec.schema)
    with pytest.raises(PlotDataError):
        saved.count_selections(facts, other, ["dataset"])
    assert saved.count_selections(facts, spec.limit(0), ["dataset"]).collect() == []


@pytest.mark.parametrize("mode", ["overlap", "within"])
def test_count_selections_of_all_kinds(spark, mode, monkeypatch):
    """Depths, images, regions, shapes and species, each selection also counted on its own."""
    monkeypatch.setattr(saved, "BLOCK", 17)
    rnd = random.Random(6)
    image = ["[]", None, '["http://i"]', '[{"a": " "}]', '[{"a": "x"}]']
    rows = []
    for k in range(400):
        top = rnd.choice([None, rnd.randint(0, 9) / 10])
        rows.append(
            (k, str(rnd.randint(0, 20)), rnd.randint(1, 5), rnd.choice(["A b", "C d", None]), top,
             None if top is None else top + rnd.randint(0, 4) / 10, rnd.choice(image),
             rnd.choice([None, rnd.uniform(0, 10), 5.0]), rnd.choice([rnd.uniform(0, 10), 2.0]), "2020-01-01")
        )
    facts = spark.createDataFrame(
        rows,
        "sample_id long, site_id string, soil_subsite_id long, scientific_name string, soil_depth_min double, "
        "soil_depth_max double, sample_images string, lon double, lat double, d string",
    ).withColumn("visit_date", F.col("d").cast("date"))
    regions = [(str(s), t, f"{t}{s % n}") for s in range(0, 18) for t, n in (("x", 3), ("y", 5))]
    tables = SurveyTables(site_region=spark.createDataFrame(regions, "site_id string, region_type string, region string"))
    shapes = [
        [2, 2, 5, 8],
        "POLYGON((1 1, 9 1, 9 9, 1 9, 1 1),(3 3, 6 3, 6 6, 3 6, 3 3))",
        {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4]]], [[[3, 0], [9, 0], [9, 5]]]]},
        "GEOMETRYCOLLECTION(POINT(5 2), LINESTRING(5 0, 5 9), POLYGON((0 0, 1 0, 1 1, 0 0)))",
    ]
    asked = {}
    for i in range(40):
        edits = {
            "soil_depth_range": [rnd.randint(0, 5) / 10, rnd.randint(6, 12) / 10],
            "has_image": rnd.choice([True, False]),
            "spatial": shapes[i % 4],
            "speciesname": rnd.sample(["A b", "C d", "E f"], rnd.randint(1, 2)),
            "soil_subsite_id": rnd.sample(range(1, 7), rnd.randint(1, 4)),
            "site_id": [str(v) for v in rnd.sample(range(25), 15)],
        }
        kept = {k: v for k, v in edits.items() if rnd.random() < 0.4}
        if rnd.random() < 0.5:
            kept |= {"region_type": rnd.sample(["x", "y"], rnd.randint(1, 2))}
            if rnd.random() < 0.6:
                kept["region"] = [f"x{rnd.randint(0, 2)}", f"y{rnd.randint(0, 4)}"]
        if kept:
            asked[f"s{i}"] = Selection("samples").add(spark, kept)
    spec = spark.createDataFrame(
        [r for k, s in asked.items() for r in s.rows(k)], "spec_id string, facet string, op string, value string"
    )
    counts = saved.count_selections(
        facts, spec, ["speciesname", "soil_subsite_id", "site_id"], site_region=tables.site_region, depth_mode=mode
    )
    got = {r["spec_id"]: r["rows"] for r in counts.collect()}
    assert got == {k: s.apply(facts, tables, mode).count() for k, s in asked.items()}
    assert len({v for v in got.values()}) > 5


def test_an_index_row_per_value(spark, monkeypatch):
    """Long lists on several facets are never multiplied with each other."""
    written = []
    real = saved.cut_lineage
    monkeypatch.setattr(saved, "cut_lineage", lambda df: written.append(real(df)) or written[-1])
    sites, kinds, props = range(300), range(10), range(50)
    spec = [(f"s{i}", f, "in", str(v)) for i in range(30) for f, vs in (("site_id", sites), ("feature_type", kinds), ("observed_property", props)) for v in vs if v != i]
    rows = [(s % 300, s % 10, s % 50) for s in range(3000)]
    facts = spark.createDataFrame(rows, "site_id long, feature_type long, observed_property long")
    spec = spark.createDataFrame(spec, "spec_id string, facet string, op string, value string")
    got = {r["spec_id"]: r["rows"] for r in saved.count_selections(facts, spec, ["site_id", "feature_type", "observed_property"]).collect()}
    assert got == {f"s{i}": sum(i not in r for r in rows) for i in range(30)}
    assert max(df.count() for df in written) <= spec.count()


def test_indexes_do_not_grow_with_sites_points_and_days(spark, monkeypatch):
    """Sites in the same regions, points in the same shapes: one combination."""
    written = []
    real = saved.cut_lineage
    monkeypatch.setattr(saved, "cut_lineage", lambda df: written.append(real(df)) or written[-1])
    rows = [(str(k), float(k % 100), 1.0, f"2020-01-{k % 28 + 1:02d}") for k in range(300)] + [(None, None, None, None)]
    facts = spark.createDataFrame(rows, "site_id string, lon double, lat double, d string")
    facts = facts.withColumn("visit_date", F.col("d").cast("date"))
    regions = [(str(k), "x", f"x{k % 60}") for k in range(300)]
    regions = spark.createDataFrame(regions, "site_id string, region_type string, region string")
    asked = [
        ("a", "region_type", "in", "x"), ("a", "region", "in", "x1"), ("a", "date_from", "date_from", "2020-01-20"),
        ("b", "spatial", "spatial", "[0.0, 0.0, 49.0, 2.0]"), ("b", "date_to", "date_to", "2020-01-07"),
        ("c", "region_type", "in", "x"), ("c", "date_from", "date_from", "2020-01-09"), ("c", "date_to", "date_to", "2020-01-03"),
        ("d", "region_type", "in", "zz"), ("e", "region_type", "in", "x"),
    ]
    spec = spark.createDataFrame(asked, "spec_id string, facet string, op string, value string")
    got = {r["spec_id"]: r["rows"] for r in saved.count_selections(facts, spec, [], site_region=regions).collect()}
    one = sum(k % 60 == 1 and k % 28 >= 19 for k in range(300))
    two = sum(k % 100 <= 49 and k % 28 <= 6 for k in range(300))
    assert got == {"a": one, "b": two, "c": 0, "d": 0, "e": 300}
    assert max(df.count() for df in written if "words" in df.columns or "days" in df.columns) <= 6


# --- spatial ----------------------------------------------------------------------


@pytest.mark.parametrize("limit", [200_000, 0])
def test_points_in_polygons_of_all_sizes(spark, limit, monkeypatch):
    """The same pairs with a broadcast and with a salted merge join."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    rnd = random.Random(11)
    points = [(i, rnd.uniform(-179, 179), rnd.uniform(-89, 89)) for i in range(300)]
    points += [(1000 + i, 10.0, 10.0) for i in range(200)]  # one hot place
    shapes = []
    for k in range(40):
        r = 10 ** rnd.uniform(-4, 2.2)
        if k % 4 == 0:
            cx, cy = points[k][1:]
        elif k % 4 == 1:
            cx, cy = 10.0, 10.0
        else:
            cx, cy = rnd.uniform(-100, 100), rnd.uniform(-50, 50)
        shapes.append((k, [(cx - r, cy - r / 3), (cx + r, cy - r / 2), (cx + r / 3, cy + r)]))
    got = spatial.points_in_polygons(
        spark.createDataFrame(points, "id int, lon double, lat double"),
        spark.createDataFrame(shapes, "shape_id int, ring array<struct<x:double,y:double>>"),
    )
    from test_functions import inside

    want = {
        (i, k) for i, x, y in points for k, ring in shapes if inside(x, y, [[*ring, ring[0]]])
    }
    rows = [(r["id"], r["shape_id"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 300


@pytest.mark.parametrize("limit", [200_000, 0])
def test_totals_in_polygons(spark, limit, monkeypatch):
    """The sums over all pairs, of few places and many, whatever the ring is like."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(spatial, "LEAF_PLACES", 3)
    rnd = random.Random(12)
    nan, inf = float("nan"), float("inf")
    points = [(i, rnd.uniform(-20, 20), rnd.uniform(-20, 20)) for i in range(600)]
    points += [(1000 + i, 10.0, 10.0) for i in range(50)]  # one place
    points += [(2000 + i, 10 + rnd.uniform(0, 1e-4), 10 + rnd.uniform(0, 1e-4)) for i in range(60)]
    points += [(3000 + 9 * i + j, i / 2, j / 2) for i in range(9) for j in range(9)]  # on sides and corners
    points += [(None, 1.0, 1.0), (1, None, 1.0), (2, 1.0, None), (3, nan, 1.0), (4, 1.0, inf), (None, -15.5, -15.5)]
    shapes = []
    for k in range(60):
        r, (cx, cy) = 10 ** rnd.uniform(-4, 1.5), points[rnd.randrange(700)][1:]
        corners = rnd.randrange(3, 8)
        free = [(cx + rnd.uniform(-r, r), cy + rnd.uniform(-r, r)) for _ in range(corners)]  # crosses itself
        shapes.append((k, free, False))
    box = [(0.0, 0.0), (3.0, 0.0), (3.0, 2.5), (0.0, 2.5)]
    shapes += [(100, box, False), (101, box, True), (102, [*box, box[0]], False), (100, box, False), (None, box, False)]
    shapes += [(103, [(-9.0, -9.0), (9.0, -9.0), (9.0, None), (0.0, 9.0)], False), (104, [(0.0, 0.0)], False)]
    shapes += [(105, [(0.0, 0.0), None, (9.0, 9.0), (0.0, 9.0)], False), (106, [], False), (107, None, False)]
    shapes += [(108, [(2.0, 2.0), (2.0, 2.0)], True), (109, [(-15.6, -15.6), (-15.4, -15.6), (-15.5, -15.4)], False)]
    where = spark.createDataFrame(points, "id int, lon double, lat double")
    what = spark.createDataFrame(shapes, "shape_id int, ring array<struct<x:double,y:double>>, closed boolean")
    pairs = spatial.points_in_polygons(where, what).groupBy("shape_id").agg(F.count(F.lit(1)), F.sum("id"))
    got = spatial.points_in_polygons(where, what, count="n", sums={"s": "id"})
    assert got.columns == ["shape_id", "n", "s"]
    want = {tuple(r) for r in pairs.collect()}
    assert {tuple(r) for r in got.collect()} == want and len(want) > 30


def test_totals_do_not_make_the_pairs(spark, monkeypatch):
    """A shape meets what lies along its sides: pairs grow fourfold, rows tested do not."""
    tested, exact = [], spatial._holds
    total = spark.sparkContext.accumulator(0)

    def counted():
        test = exact()
        mark = F.udf(lambda: total.add(1) or True, "boolean").asNondeterministic()
        tested.append(1)
        return mark() & test

    monkeypatch.setattr(spatial, "_holds", counted)
    rows = {}
    for n in (40, 80):
        total.value = 0
        points = [(i * n + j, i * 8.0 / n, j * 8.0 / n) for i in range(n) for j in range(n)]
        shapes = [(k, [(-1.0 - k / 99, 4.0), (4.0, -1.0), (9.0, 4.0), (4.0, 9.0)]) for k in range(10)]
        got = spatial.points_in_polygons(
            spark.createDataFrame(points, "id int, lon double, lat double"),
            spark.createDataFrame(shapes, "shape_id int, ring array<struct<x:double,y:double>>"),
            count="n",
        ).collect()
        pairs = sum(r["n"] for r in got)
        rows[n] = total.value
        assert tested and 0 < rows[n] < pairs / 3
    assert rows[80] < 3 * rows[40]


def test_no_polygons(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    none = spark.createDataFrame([], "shape_id int, ring array<struct<x:double,y:double>>")
    assert spatial.points_in_polygons(points, none).collect() == []
    assert spatial.points_in_polygons(points, none, count="n").collect() == []


def test_clusters_and_layer(spark):
    rows = [(i, 130.0 + 0.001 * (i % 3), -25.0) for i in range(5)] + [(9, 150.0, -30.0)] * 2
    df = spark.createDataFrame(rows, "site_id long, lon double, lat double")
    cells = sorted(r["num_sites"] for r in spatial.clusters(df).collect())
    assert cells == [1, 5]
    weights = sorted(r["weight"] for r in spatial.cluster_weights(spatial.clusters(df)).collect())
    assert weights == [0.2, 1.0]
    few = spatial.map_layer(df).collect()
    assert len(few) == 6 and {r["kind"] for r in few} == {"site"}
    assert {r["kind"] for r in spatial.map_layer(df, limit=6).collect()} == {"cluster"}
    assert spatial.map_layer(df.limit(0)).collect() == []
    assert spatial.cluster_weights(spatial.clusters(df.limit(0))).collect() == []


# --- pages ------------------------------------------------------------------------


def test_pages_shallow_and_deep_agree(spark):
    rnd = random.Random(1)
    keys = [(None if k < 40 else 7 if k < 500 else k // 3, f"t{k:04d}", k) for k in range(997)]
    want = sorted(keys, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rnd.shuffle(keys)
    df = spark.createDataFrame(keys, "a int, t string, b int").repartition(5)
    for order in (["a", "b"], ["a", "t"], ["b"]):
        expect = [r[2] for r in want] if order != ["b"] else list(range(997))
        for number, size, top_k in ((4, 100, 10_000), (1, 100, 50), (6, 90, 50), (2, 450, 200), (11, 100, 50)):
            page = expect[(number - 1) * size : number * size]
            got = paging.page(df, order, number, size, top_k_rows=top_k)
            assert [r["b"] for r in got.collect()] == page, (order, number, size, top_k)
    with pytest.raises(PlotDataError):
        paging.page(df, ["a"], 0, 10)


def test_preview_by_type(spark):
    df = spark.createDataFrame([(t, i) for t in ("b", "a", "c", None) for i in range(8)], "t string, i int")
    got = [(r["t"], r["i"]) for r in paging.preview_by_type(df, "t", ["i"]).collect()]
    assert got == [("a", i) for i in range(5)] + [("b", i) for i in range(5)]


# --- union, labels, samples, images -----------------------------------------------


def test_stack_tables(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "b int, c int")
    plain = align.stack_tables([a, b])
    assert plain.columns == ["a", "b", "c"] and dict(plain.dtypes)["a"] == "int"
    filled = [r.asDict() for r in align.stack_tables([a, b], fill=True).orderBy("b").collect()]
    assert filled == [{"a": "1", "b": "2", "c": "N/A"}, {"a": "N/A", "b": "3", "c": "4"}]


def test_add_point(spark):
    df = spark.createDataFrame(
        [("153.0", "-27.0"), ("east", "1"), (None, "2")], "longitude_Degree string, latitude_Degree string"
    )
    assert [r["geometry"] for r in align.add_point(df).collect()] == ["POINT (153.0 -27.0)", None, None]
    assert align.add_point(spark.range(1)).first()["geometry"] is None


def test_labels(spark):
    vocab = spark.createDataFrame(
        [("f", "u1", "one"), ("f", "u2", "two"), ("g", "u3", "no")], "facet string, uri string, label string"
    )
    df = spark.createDataFrame(
        [(1, "u1", ["u1"]), (2, "u3", ["u2", None, "u9"]), (3, None, []), (4, "u2", None), (5, "u1", [None])],
        "id int, code string, codes array<string>",
    )
    for missing, want in (
        ("na", ["one", "N/A", "N/A", "two", "one"]),
        ("keep", ["one", "u3", None, "two", "one"]),
        ("null", ["one", None, None, "two", "one"]),
    ):
        got = lookup.add_label(df, vocab, "f", "code", "l", missing).orderBy("id").collect()
        assert [r["l"] for r in got] == want
    listed = lookup.add_label_list(df, vocab, "f", "codes", "names").orderBy("id")
    got = [r[0] for r in listed.select(lookup.unwrap(F.col("names"))).collect()]
    assert got == ["one", '["two","u9"]', None, None, None]


def test_broadcast_only_when_small(spark, monkeypatch):
    df = spark.range(10).select(F.col("id").cast("string").alias("s"))

    def strategy():
        joined = spark.range(3).join(lookup.broadcast_if_small(df), F.col("s") == F.lit("1"))
        return joined._jdf.queryExecution().analyzed().toString().split("strategy=")[1].split(")")[0]

    assert strategy() == "broadcast"
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 5)
    assert strategy() == "merge"
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 50)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 5)
    assert strategy() == "merge"


def test_regions(spark):
    long = spark.createDataFrame(
        [(1, "t", "a"), (1, "u", "b"), (2, "t", "c")], "site_id int, region_type string, region string"
    )
    wide = lookup.regions_wide(long, ["t", "u"]).orderBy("site_id").collect()
    assert [tuple(r) for r in wide] == [(1, "a", "b"), (2, "c", None)]
    mapped = spark.createDataFrame([(1, {"t": "a"}), (2, None)], "id int, regions map<string,string>")
    flat = lookup.regions_from_map(mapped, "regions", ["t", "u"])
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [(1, "a", None), (2, None, None)]


def test_sample_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", "r", "t", None, "[]")],
        "sample_id int, sample_name string, region_x string, tags string, gone string, sample_images string",
    )
    kept = samples.drop_internal(df)
    assert kept.columns == ["sample_id", "sample_name", "gone", "sample_images"]
    assert samples.drop_empty_columns(kept).columns == ["sample_id", "sample_name"]
    assert samples.drop_empty_columns(kept.limit(0)).columns == kept.columns


def test_hits(spark, tmp_path):
    answers = [
        {"hits": {"hits": [{"_source": {"sample_id": 1, "n": "a"}}, {"_source": "odd"}, {}]}},
        {"hits": {"hits": []}},
        {"hits": {}},
        {"hits": {"hits": [{"_source": {"sample_id": 2}}]}},
    ]
    (tmp_path / "hits.json").write_text("\n".join(json.dumps(a) for a in answers))
    hits = readers.read_hits(spark, str(tmp_path / "hits.json"))
    rows = hits.select(*readers.source_columns(F.col("source"), {"sample_id": "int", "n": "string"}))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "a"), (2, None)]


def test_image_options(spark):
    deep = {"a": {"b": [{"src": "s"}, ["t", {"original": "o"}]]}, "url": "u"}
    cells = [
        ("plain text", [("image", "plain text")]),
        (json.dumps("x"), [("image", "x")]),
        (json.dumps(deep), [("original", "o"), ("image", "t"), ("src", "s"), ("url", "u")]),
        (json.dumps([{"thumbnail_320": "1"}, {"original": "2"}, {"zzz": "3"}, {"url": "1"}]),
         [("original", "2"), ("thumbnail_320", "1")]),
        (json.dumps(5), []),
        (None, []),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cells)], "i int, c string")
    got = df.select("i", images.image_options(F.col("c")).alias("o")).orderBy("i").collect()
    assert [[tuple(x) for x in r["o"]] for r in got] == [w for _, w in cells]
    options = spark.createDataFrame(
        [([("thumbnail_320", "a"), ("thumbnail_1280", "b")],), ([("url", "c")],), ([],)],
        images.OPTIONS_TYPE.replace("array", "o array", 1),
    )
    assert [r[0] for r in options.select(images.default_image(F.col("o"))).collect()] == ["b", "c", None]


def test_summary_without_multiplied_facts(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS a", "IF(id % 3 = 0, NULL, id % 11) AS b", "CAST(id % 900 AS STRING) AS c")
    unique = {"as": "a", "bs": "b", "cs": "c", "again": "a"}
    got = {r["metric"]: r["count"] for r in discovery.summary(rows, unique, "all").collect()}
    assert got == {"all": 5000, "as": 7, "bs": 11, "cs": 900, "again": 7}
    assert {r["count"] for r in discovery.summary(rows.limit(0), unique, "all").collect()} == {0}
    sketches = discovery.summary_sketches(rows, "a", {"bs": "b", "cs": "c"})
    for values in (None, [1, 2], [99]):
        kept = rows if values is None else rows.where(F.col("a").isin(values))
        exact = {r["metric"]: r["count"] for r in discovery.summary(kept, {"bs": "b", "cs": "c"}, "all").collect()}
        near = {r["metric"]: r["count"] for r in discovery.summary_of_sketches(sketches, values, "all").collect()}
        assert near == pytest.approx(exact, rel=0.02)


def test_summary_counts_distinct_values_of_written_combinations(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (1, "a")], "site int, kind string")
    found = discovery.summary(rows, {"sites": "site", "kinds": "kind"}, "rows")
    assert {r["metric"]: r["count"] for r in found.collect()} == {"rows": 5, "sites": 2, "kinds": 2}
    # the facts are aggregated in a job of their own: they are not below the distinct counts
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan.lower() and "LogicalRDD" not in plan and "LocalRelation" not in plan
