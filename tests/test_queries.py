"""Every named query against its SQL twin, and the shape of a few plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quadrat.plans.catalogue import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
ORACLE = {name: entry.oracle_sql()[name] for name in REGISTRY if name in entry.oracle_sql()}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*(table.column(n).to_pylist() for n in names)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, db, name):
    ours = entry.queries()[name](spark, FOLDER).toArrow()
    assert rows(ours) == rows(db.sql(ORACLE[name]).to_arrow_table())


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 7


def plan(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    dates = plan(spark, "date_range")
    assert "GreaterThanOrEqual(o_orderdate" in dates and "p_partkey" not in dates
    assert "c_mktsegment" not in dates
    for name in ("spatial_polygon", "depth_overlap", "has_image", "flatten_full"):
        assert "CartesianProduct" not in plan(spark, name)
    for name in ("spatial_bbox", "depth_overlap", "has_image", "wkt_valid", "igsn_normalise", "points"):
        assert "Exchange" not in plan(spark, name)
    for name in ("polygon_join", "resolve_fuzzy", "multi_spec_counts"):
        assert "NestedLoop" not in plan(spark, name) and "Cartesian" not in plan(spark, name)


def test_map_layer_shows_sites_everywhere(spark, monkeypatch):
    from quadrat.plans import views

    far = spark.createDataFrame([(1, 0.0, 50.0), (2, 130.0, -25.0)], "site_id long, lon double, lat double")
    monkeypatch.setattr(views, "site_points", lambda spark, folder: far)
    shown = lambda name: {r.site_id for r in entry.queries()[name](spark, FOLDER).collect()}
    assert shown("map_layer") == {1, 2} and shown("map_layer_window") == {2}
