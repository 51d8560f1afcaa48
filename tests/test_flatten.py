import datetime
import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quadrat.operators import flatten
from quadrat.sources import readers


def obs(name, **more):
    return {"observableProperty": name, "value": 1.5, "unit": "m", **more}


def feature(visits, geometry=None, **attrs):
    return {
        "type": "Feature",
        "geometry": geometry,
        "properties": {
            "dataset": {"dataset.title": "D", "dataset.link": "d", "dataset.attributes": attrs},
            "site": {"site.name": "S", "site.link": "s"},
            "siteVisit": visits,
        },
    }


def visit(*fois):
    return {"siteVisit.id": "v", "siteVisit.name": "V", "featureOfInterest": list(fois)}


def foi(groups, name="f"):
    return {"foi.id": name, "foi.type": "t", "foi.observations": groups}


CASES = [
    ("no visits", None, 1),
    ("empty visits", [], 1),
    ("visit without features of interest", [visit()], 1),
    ("empty map gives a context row", [visit(foi({}))], 1),
    ("missing map gives a context row", [visit({"foi.id": "f"})], 1),
    ("group with an empty list gives none", [visit(foi({"g": []}))], 0),
    ("two groups of two", [visit(foi({"g": [obs("a"), obs("b")], "h": [obs("c"), obs("d")]}))], 4),
    ("one of two groups empty", [visit(foi({"g": [], "h": [obs("c")]}))], 1),
    ("two visits, three features", [visit(foi({}), foi({"g": [obs("a")]})), visit(foi({}))], 3),
]


@pytest.mark.parametrize(("name", "visits", "count"), CASES, ids=[c[0] for c in CASES])
def test_row_counts(spark, name, visits, count):
    lines = spark.createDataFrame([(json.dumps(feature(visits)),)], "value string")
    assert flatten.flatten_features(readers.parse_features(lines, "value")).count() == count


def test_values_and_attributes(spark, tmp_path):
    bag = {
        "plain": "x",
        "number": 3,
        "only": {"value": 1},
        "size": {"value": 2.5, "unit": "ha"},
        "full": {"value": "v", "unit": "u", "attribute": "a"},
        "nest": {"one": {"two": {"value": 7, "unit": "k"}}, "list": [1, "b"]},
        "none": None,
    }
    doc = feature(
        [visit(foi({"g": [obs("a", system={"probe": {"value": 9}})]}))],
        {"type": "Point", "coordinates": [153.0, -27.0]},
        **bag,
    )
    collection = {"type": "FeatureCollection", "features": [doc, feature([])]}
    (tmp_path / "doc.json").write_text(json.dumps(collection, indent=1))
    rows = flatten.flatten_features(readers.read_feature_collections(spark, str(tmp_path / "doc.json")))
    rows = sorted(rows.collect(), key=lambda r: r["obs_group"] or "")
    assert [r["obs_group"] for r in rows] == [None, "g"]
    row = rows[1]
    assert (row["lon"], row["lat"], rows[0]["lon"]) == (153.0, -27.0, None)
    assert (row["obs_property"], row["obs_value"], row["obs_unit"]) == ("a", "1.5", "m")
    p = "dataset.attributes."
    assert row["attrs"] == {
        p + "plain": "x",
        p + "number": "3",
        p + "only": "1",
        p + "size": "2.5",
        p + "size.unit": "ha",
        p + "full": "v",
        p + "full.unit": "u",
        p + "full.attribute": "a",
        p + "nest.one.two": "7",
        p + "nest.one.two.unit": "k",
        p + "nest.list": '[1,"b"]',
        p + "none": None,
        "obs.system.probe": "9",
    }


def test_equal_dotted_keys(spark):
    deep = {"a": {"b": {"c": {"d": 1}}}, "a.b": 5, "a.b.c.d": 7}
    df = spark.createDataFrame([(json.dumps(deep),)], "j string").select(F.parse_json("j").alias("bag"))
    got = df.select(flatten.flatten_bag("bag").alias("m")).first()["m"]
    assert got == {"a.b.c.d": "1", "a.b": "5"}


def test_lines_files_and_collections_agree(spark, tmp_path):
    docs = [feature([visit(foi({"g": [obs("a")]}))]), feature([])]
    (tmp_path / "l.geojson").write_text("\n".join(json.dumps(d) for d in docs) + "\n  \n")
    by_line = readers.read_feature_lines(spark, str(tmp_path / "l.geojson"))
    text = spark.createDataFrame(
        [(json.dumps({"type": "FeatureCollection", "features": docs}),)], "value string"
    )
    by_doc = readers.parse_collections(text, "value")
    names = ["site_name", "visit_id", "obs_group", "obs_property"]
    a, b = (sorted(flatten.flatten_features(x).select(*names).collect(), key=str) for x in (by_line, by_doc))
    assert a == b and len(a) == 2


def test_empty_collection(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"type": "FeatureCollection", "features": []}')
    rows = flatten.flatten_features(readers.read_feature_collections(spark, str(tmp_path / "e.json")))
    assert rows.count() == 0 and "attrs" in rows.columns


def test_no_shuffle_in_the_flatten(spark):
    lines = spark.createDataFrame([(json.dumps(feature([])),)], "value string")
    rows = flatten.flatten_features(readers.parse_features(lines, "value"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_attributes_wide(spark):
    df = spark.createDataFrame([(1, {"b": "x"}), (2, {"a": "y"})], "id int, attrs map<string,string>")
    wide = flatten.attributes_wide(df).orderBy("id").collect()
    assert [r.asDict() for r in wide] == [
        {"id": 1, "a": None, "b": "x"},
        {"id": 2, "a": "y", "b": None},
    ]


def test_bags_of_any_depth(spark):
    deep = json.dumps({"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": {"value": 1, "unit": "m"}}, "x": 2}}}}}}})
    df = spark.createDataFrame([(deep,), ('{"z": 1}',), (None,)], "t string").selectExpr("parse_json(t) AS bag")
    got = [r.m for r in df.select(flatten.flatten_bag("bag").alias("m")).collect()]
    assert {"a.b.c.d.e.f.g.h": "1", "a.b.c.d.e.f.g.h.unit": "m", "a.b.c.d.e.f.x": "2"} in got
    tricky = {"k": '{{\\\\"{', "w}": {"x\\": {"y": {"{": ["}", {"in": {"a": "list"}}]}}}}
    for n in (1, 2, 30, 60):
        bag = {"end": n}
        for _ in range(n):
            bag = {"d": bag}
        df = spark.createDataFrame([(json.dumps(bag | tricky),)], "t string").selectExpr("parse_json(t) AS bag")
        want = {".".join(["d"] * n + ["end"]): str(n), "k": '{{\\\\"{', "w}.x\\.y.{": '["}",{"in":{"a":"list"}}]'}
        assert df.select(flatten.flatten_bag("bag").alias("m")).first()["m"] == want


def test_deep_bags_on_a_stream(spark, tmp_path):
    from quadrat.streaming import jobs

    bag = {"value": 1}
    for _ in range(12):
        bag = {"d": bag}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.geojson").write_text(json.dumps(feature([], **bag)))
    lines = readers.clean_lines(spark.readStream.text(str(tmp_path / "in")))
    rows = jobs.run_to_table(flatten.flatten_features(readers.parse_features(lines, "line")), "deep").collect()
    assert [r["attrs"] for r in rows] == [{"dataset.attributes" + ".d" * 12: "1"}]


def test_geometries_of_every_type(spark):
    shapes = [
        ({"type": "Point", "coordinates": [1, 2.5, 9]}, "POINT (1.0 2.5)", (1.0, 2.5, 1.0, 2.5)),
        ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 0]]}, "MULTIPOINT (1.0 2.0, 3.0 0.0)", (1.0, 0.0, 3.0, 2.0)),
        ({"type": "LineString", "coordinates": [[1, 2], [3, 0]]}, "LINESTRING (1.0 2.0, 3.0 0.0)", (1.0, 0.0, 3.0, 2.0)),
        ({"type": "MultiLineString", "coordinates": [[[1, 2], [3, 0]], [[9, 9], [8, 8]]]},
         "MULTILINESTRING ((1.0 2.0, 3.0 0.0), (9.0 9.0, 8.0 8.0))", (1.0, 0.0, 9.0, 9.0)),
        ({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]},
         "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0), (1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 1.0))", (0.0, 0.0, 4.0, 4.0)),
        ({"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 0]]], [[[7, 7], [8, 7], [8, 8], [7, 7]]]]},
         "MULTIPOLYGON (((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0)), ((7.0 7.0, 8.0 7.0, 8.0 8.0, 7.0 7.0)))", (0.0, 0.0, 8.0, 8.0)),
        ({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "LineString", "coordinates": [[3, 4], [5, 6]]}]},
         "GEOMETRYCOLLECTION (POINT (1.0 2.0), LINESTRING (3.0 4.0, 5.0 6.0))", (1.0, 2.0, 5.0, 6.0)),
        ({"type": "Point", "coordinates": []}, None, (None,) * 4),
        ({"type": "LineString", "coordinates": "none"}, None, (None,) * 4),
        ({"type": "Circle", "coordinates": [1, 2]}, None, (None,) * 4),
        (None, None, (None,) * 4),
    ]
    lines = spark.createDataFrame([(json.dumps(feature([], g)),) for g, _, _ in shapes], "value string").coalesce(1)
    rows = flatten.base_context(readers.parse_features(lines, "value")).collect()
    for row, (shape, wkt, bounds) in zip(rows, shapes):
        assert (row["geometry_wkt"], tuple(row[c] for c in ("minx", "miny", "maxx", "maxy"))) == (wkt, bounds), shape
        middle = None if bounds[0] is None else ((bounds[0] + bounds[2]) / 2, (bounds[1] + bounds[3]) / 2)
        assert (None if row["lon"] is None else (row["lon"], row["lat"])) == middle


def test_rare_attributes_stay_in_the_map(spark, monkeypatch):
    monkeypatch.setattr(flatten, "MAX_WIDE_KEYS", 2)
    rows = [(1, {"a": "1", "b": "2", "c": "3"}), (2, {"a": "4", "b": "5"}), (3, None)]
    df = flatten.attributes_wide(spark.createDataFrame(rows, "id int, attrs map<string,string>"))
    got = {r.id: (r.a, r.b, r.attrs) for r in df.collect()}
    assert got == {1: ("1", "2", {"c": "3"}), 2: ("4", "5", {}), 3: (None, None, None)}


def test_deep_bags_of_every_level_are_opened(spark, tmp_path):
    def deep(name):
        bag = {"value": name, "unit": "m"}
        for k in range(7, -1, -1):
            bag = {f"k{k}": bag}
        return bag

    one = foi({"g": [obs("a", system=deep("o"))], "none": None}) | {"foi.attributes": deep("f")}
    doc = feature([visit(one) | {"siteVisit.attributes": deep("v")}], **deep("d"))
    doc["properties"]["site"]["site.attributes"] = deep("s")
    (tmp_path / "deep.json").write_text(json.dumps({"type": "FeatureCollection", "features": [doc, feature(None)]}))
    df = readers.read_feature_collections(spark, str(tmp_path / "deep.json"))
    path = ".".join(f"k{k}" for k in range(8))
    names = {"dataset.attributes": "d", "site.attributes": "s", "siteVisit.attributes": "v", "foi.attributes": "f", "obs.system": "o"}
    want = {f"{n}.{path}{end}": v for n, x in names.items() for end, v in (("", x), (".unit", "m"))}
    got = [r["attrs"] for r in flatten.flatten_features(df).collect() if r["obs_group"] == "g"]
    assert got == [want]


@pytest.mark.parametrize("indent", [None, 1])
def test_a_large_document_is_read_in_splits(spark, tmp_path, indent):
    """The rows of one document do not depend on where its file is split."""
    docs = []
    for k in range(60):
        doc = feature([visit(foi({"g": [obs("a", note='}{ "{[ \\\\ \\" {')]}))], **{"k{": f'}}{{"{k}', "e": "\\\\"})
        doc["properties"]["site"]["site.name"] = f'S{k} {{ " \\ }}'
        docs.append(doc)
    collection = {"type": "FeatureCollection", "crs": {"a": {"b": "{"}}, "features": docs, "more": {"type": "Other"}}
    for n in range(2):
        (tmp_path / f"{n}.json").write_text(json.dumps(collection, indent=indent))
    want = sorted([d["properties"]["site"]["site.name"] for d in docs] * 2)
    name = F.col("feature.properties.site").getField("site.name")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "777", "4096"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.read_feature_collections(spark, str(tmp_path))
            assert sorted(r[0] for r in rows.select(name).collect()) == want
            bags = rows.select(flatten.flatten_bag("feature.properties.dataset.`dataset.attributes`").alias("m")).collect()
            assert {r["m"]["k{"] for r in bags} == {f'}}{{"{k}' for k in range(60)} and {r["m"]["e"] for r in bags} == {"\\\\"}
            assert size == old or spark.read.option("lineSep", "{").text(str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bad_features_are_set_aside(spark, tmp_path):
    good = json.dumps(feature([]))
    (tmp_path / "a.json").write_text(f'{{"type": "FeatureCollection", "features": [{good}, {{"type": nonsense}}, {good}]}}')
    (tmp_path / "b.json").write_text("")
    rows = readers.collection_rows(spark, str(tmp_path)).collect()
    assert sorted(r["bad"] is None for r in rows) == [False, True, True]
    assert readers.read_feature_collections(spark, str(tmp_path)).count() == 2


def test_collection_reader_keeps_no_row_per_brace(spark, tmp_path, monkeypatch):
    kept = []
    real = readers.cut_lineage

    def counting(df, *args, **how):
        out = real(df, *args, **how)
        kept.append(out.count())
        return out

    monkeypatch.setattr(readers, "cut_lineage", counting)
    docs = [json.dumps({"type": "Other", "n": n, "a": {"b": [{"c": '}"{'}] * 20}}) for n in range(300)]
    (tmp_path / "one.json").write_text('{"type":"FeatureCollection","features":[' + ",".join(docs) + "]}")
    rows = readers.collection_texts(spark, str(tmp_path)).collect()
    assert [r["number"] for r in sorted(rows, key=lambda r: r["number"])] == list(range(1, 301))
    decoder = json.JSONDecoder()
    assert {decoder.raw_decode(r["text"])[0]["n"] for r in rows} == set(range(300))
    assert sum(kept) < 3 * len(docs)


def test_collections_are_written_round_by_round(spark, tmp_path, monkeypatch):
    """The files on disk at a time hold a round's features, and all features are counted."""
    from quadrat.plans import documents

    row = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp"
    day = datetime.datetime(1999, 1, 2)
    rows = [(k, k % 50, k % 7, k % 4, 1.5 * k, "AR"[k % 2], day) for k in range(700)]
    rows += [(1, 2, 3, 4, 5.0, "A", day)] * 300 + [(None, None, None, None, None, None, None)] * 20
    spark.createDataFrame(rows, row).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    held = []
    real = readers.read_feature_collections

    def counting(session, path, *scratch):
        docs = [json.loads(r.value) for r in session.read.text(path).collect()]
        held.append([len(d["features"]) for d in docs])
        return real(session, path, *scratch)

    monkeypatch.setattr(readers, "read_feature_collections", counting)
    monkeypatch.setattr(documents, "ROUND_FEATURES", 250, raising=False)
    got = {tuple(r)[:3]: r["n"] for r in documents.scan_collection_files(spark, str(tmp_path)).collect()}
    assert got == Counter((None, None, None) if r[2] is None else (r[5], f"S{r[2]}", r[3] % 3) for r in rows)
    assert sum(map(sum, held)) == len(rows)
    # equal rows are spread over the rounds as well
    assert len(held) == 5 and max(map(sum, held)) < 300


def test_documents_of_a_collection_are_not_shuffled(spark):
    from quadrat.sinks import writers

    lines = spark.range(0, 2345, 1, 2).selectExpr("""concat('{"n":', id, '}') AS value""")
    docs = writers.collection_documents(lines, '{"features":[', 500)
    features = [json.loads(r.value)["features"] for r in docs.collect()]
    assert sorted(f["n"] for fs in features for f in fs) == list(range(2345))
    assert all(0 < len(fs) <= 500 for fs in features)
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()


def test_texts_of_a_collection_go_where_they_are_told(spark, tmp_path):
    scratch = str(tmp_path / "texts")
    for k in (1, 2):
        (tmp_path / f"{k}.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature([])] * k}))
        assert readers.read_feature_collections(spark, str(tmp_path / f"{k}.json"), scratch).count() == k
    # the head of the second document and its two features; nothing of the first
    assert spark.read.parquet(scratch).count() == 3


def test_features_of_collections_are_parsed_once(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature([])]}))
    rows = readers.read_feature_collections(spark, str(tmp_path / "one.json"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_marks_of_texts_leave_out_what_is_escaped():
    rng = random.Random(3)
    texts = ["{" + "".join(rng.choice('{}""\\\\a\né') for _ in range(rng.randrange(9))) for _ in range(300)]
    data, begin, quotes, closings = readers._marks(pa.array(["x", *texts, "}"]).slice(1, len(texts)))
    want = {'"': [], "}": []}
    at = 0
    for text in texts:
        escaped = False
        for byte in text.encode():
            if not escaped and chr(byte) in want:
                want[chr(byte)].append(at)
            escaped = not escaped and byte == ord("\\")
            at += 1
    assert data == "".join(texts).encode() and begin[-1] == at
    assert [data[a:b].decode() for a, b in zip(begin, begin[1:])] == texts
    assert quotes.tolist() == want['"'] and closings.tolist() == want["}"]


def test_attribute_rows_open_each_bag_once(spark):
    bags = spark.createDataFrame([(1, '{"a":{"b":1},"c":"x"}'), (2, "{}"), (3, None)], "id int, text string")
    attrs = bags.select("id", flatten.flatten_bag("parse_json(text)").alias("attrs"))
    rows = flatten.attribute_rows(attrs)
    assert sorted(map(tuple, rows.collect())) == [(1, "a.b", "1"), (1, "c", "x")]
    # no filter that flattens the bags once more below
    assert "Filter" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_feature_texts_are_json_without_structs_per_row(spark):
    from quadrat.plans.documents import FEATURE_SQL

    row = "1L l_orderkey, 2L l_partkey, {} l_suppkey, {} l_linenumber, 2.5D l_quantity, {} l_returnflag, DATE'1999-01-02' l_shipdate"
    made = lambda *v: spark.sql(f"SELECT {FEATURE_SQL} AS t FROM (SELECT {row.format(*v)})")
    got = json.loads(made("3L", "1", r"'a\"b]\\'").first()["t"])
    assert got["properties"]["dataset"]["dataset.title"] == 'a"b]\\'
    (visit,) = got["properties"]["siteVisit"]
    assert visit["siteVisit.id"] == "1-1-2-3-1" and visit["featureOfInterest"] == []
    assert got["geometry"]["type"] == "GeometryCollection"
    bare = json.loads(made("CAST(NULL AS BIGINT)", "CAST(NULL AS INT)", "CAST(NULL AS STRING)").first()["t"])
    assert "siteVisit" not in bare["properties"] and "dataset.title" not in bare["properties"]["dataset"]
    assert bare["geometry"]["coordinates"] == [None, None]
    # neither variants nor lambdas are built for the text
    plan = spark.range(1).selectExpr(
        "id l_orderkey", "id l_partkey", "id l_suppkey", "CAST(id AS INT) l_linenumber", "1D l_quantity",
        "CAST(id AS STRING) l_returnflag", "DATE'1999-01-02' l_shipdate",
    )
    text = plan.selectExpr(f"{FEATURE_SQL} AS t")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in text and "variant" not in text.lower()
