import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from quadrat.errors import PlotDataError
import scorers
from quadrat.functions import geometry, similarity, text
from quadrat.functions.dates import parse_date


def one(spark, value, make):
    return spark.range(1).select(make(F.lit(value)).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "day"),
    [
        ("2020-05-21", "2020-05-21"),
        ("2020-05-06", "2020-05-06"),
        ("21/05/2020", "2020-05-21"),
        ("21-05-2020", "2020-05-21"),
        ("21st May 2020", "2020-05-21"),
        ("May 20 2020", "2020-05-20"),
        ("may 20th, 2020", "2020-05-20"),
        ("1 SEPTEMBER 1999", "1999-09-01"),
        ("3-mar-2001", "2001-03-03"),
        ("2020-05-21 10:30:00", "2020-05-21"),
        ("21/5/20", "2020-05-21"),
        ("21.05.99", "1999-05-21"),
        ("21 Sept 2020", "2020-09-21"),
        ("Thu 21 May 2020", "2020-05-21"),
        ("Thursday, 21st of May 2020", "2020-05-21"),
        ("21/May/2020", "2020-05-21"),
        ("2020.05.21", "2020-05-21"),
        ("20200521", "2020-05-21"),
        ("21May2020", "2020-05-21"),
        ("May 21st, 20", "2020-05-21"),
        ("2020-05-21T10:30:00Z", "2020-05-21"),
        ("21 Foo 2020", None),
        ("21 ma 2020", None),
        ("1 2 3 4", None),
        ("", None),
        (None, None),
        ("05/21/2020", None),
        ("31/02/2020", None),
        ("not a date", None),
        ("", None),
    ],
)
def test_parse_date(spark, raw, day):
    assert one(spark, raw, parse_date) == (dt.date.fromisoformat(day) if day else None)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_ratio_against_the_classic_table():
    rnd = random.Random(7)
    for _ in range(500):
        a = "".join(rnd.choice("abcde é") for _ in range(rnd.randint(0, 90)))
        b = "".join(rnd.choice("abcdf é") for _ in range(rnd.randint(0, 90)))
        want = 200 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0
        assert scorers.ratio(a, b) == pytest.approx(want)


def test_known_scores():
    assert scorers.ratio("region_type", "region") == pytest.approx(70.588, abs=1e-3)
    assert scorers.ratio("North coasy", "North Coast") == pytest.approx(81.818, abs=1e-3)
    assert scorers.weighted_ratio("this is a test", "this is a new test!!!") == pytest.approx(85.5)
    assert scorers.token_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert scorers.token_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert scorers.window_ratio("this is a test", "this is a test!") == 100
    assert scorers.weighted_ratio("", "x") == 0


def test_text(spark):
    assert one(spark, "  Feature Type ", text.facet_key) == "feature_type"
    assert one(spark, "IBRA7_ Sub Regions", text.region_type_key) == "sub-regions"
    assert one(spark, "http://a.test/b/c//", text.uri_tail) == "c"
    for raw, want in (
        ("10.60792/abc", "10.60792/abc"),
        ("https://doi.org/10.60792/abc", "10.60792/abc"),
        ("DOI.org/10.60792/abc", "10.60792/abc"),
        ("https://doi.org.evil.test/10.60792/abc", None),
        ("10.60792/a b", None),
        ("11.60792/abc", None),
        (" ", None),
    ):
        assert one(spark, raw, text.igsn) == want


def test_literal_kinds():
    assert geometry.literal_kind("POLYGON((0 0, 1 0, 1 1, 0 0))") == "wkt"
    assert geometry.literal_kind({"type": "Point", "coordinates": [153.0, -27.0]}) == "geojson"
    assert geometry.literal_kind([152.0, "-28.0", 153.0, -27.0]) == "bbox"
    for bad in ("POLYGON((0 0, 1 1)", {"type": "Point"}, [1, 2, 3], [1, 2, 3, "x"], None):
        with pytest.raises(PlotDataError, match="spatial filter"):
            geometry.literal_kind(bad)


def test_kinds_of_text_agree_with_literals(spark):
    for value in ("POINT(1 2)", "POINT(1 2", {"type": "Feature"}, {"type": "X"}, [1, 2, 3, 4], [1]):
        raw = value if isinstance(value, str) else json.dumps(value)
        try:
            want = geometry.literal_kind(value)
        except PlotDataError:
            want = "error"
        assert one(spark, raw, geometry.geometry_kind) == want


WKTS = {
    "POINT (1 2)": {"type": "Point", "coordinates": [1, 2]},
    "SRID=4326;POINT(1 2)": {"type": "Point", "coordinates": [1, 2]},
    "MULTIPOINT ((1 2), (3 4))": {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
    "MULTIPOINT (1 2, 3 4)": {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]},
    "LINESTRING (0 0, 2 2)": {"type": "LineString", "coordinates": [[0, 0], [2, 2]]},
    "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((9 9, 8 9, 8 8, 9 9)))": {
        "type": "MultiPolygon",
        "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 0]]], [[[9, 9], [8, 9], [8, 8], [9, 9]]]],
    },
    "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1))": {
        "type": "GeometryCollection",
        "geometries": [
            {"type": "Point", "coordinates": [1, 2]},
            {"type": "LineString", "coordinates": [[0, 0], [1, 1]]},
        ],
    },
}


@pytest.mark.parametrize("wkt", WKTS)
def test_wkt_reads_as_geojson(wkt):
    assert geometry.read_literal(wkt) == geometry.read_literal(WKTS[wkt])


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_polygons_small_and_large(spark):
    """Unrolled and array forms of the ray cast, with a hole, against a plain loop."""
    import math

    rnd = random.Random(3)
    points = [(rnd.uniform(-12, 12), rnd.uniform(-12, 12)) for _ in range(400)]
    df = spark.createDataFrame(points, "lon double, lat double")
    for n in (5, 500):
        ring = [
            ((8 + 3 * math.sin(5 * t)) * math.cos(t), (8 + 3 * math.sin(5 * t)) * math.sin(t))
            for t in (2 * math.pi * i / n for i in range(n))
        ]
        rings = [tuple(ring + ring[:1]), ((-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0), (-2.0, -2.0))]
        shape = {"type": "Polygon", "coordinates": [[list(v) for v in r] for r in rings]}
        got = df.where(geometry.in_bbox_or_shape(F.col("lon"), F.col("lat"), shape)).collect()
        want = {p for p in points if inside(*p, rings)}
        assert {tuple(r) for r in got} == want and want


def test_points_and_lines(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (3.0, 3.0)], "lon double, lat double")
    hit = lambda s: sorted(
        tuple(r) for r in df.where(geometry.in_bbox_or_shape(F.col("lon"), F.col("lat"), s)).collect()
    )
    assert hit("POINT(1 2)") == [(1.0, 2.0)]
    assert hit("LINESTRING(0 0, 3 3)") == [(1.0, 1.0), (3.0, 3.0)]
    assert hit([1, 1, 1, 2]) == [(1.0, 1.0), (1.0, 2.0)]
    assert hit({"type": "FeatureCollection", "features": []}) == []
