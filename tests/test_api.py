import warnings

import pytest
from pyspark.sql import functions as F

from quadrat import PlotData, PlotDataError, SurveyTables, UnfilteredReadError
from quadrat.api import ANSWERS
from quadrat.model import MATERIAL_SAMPLE_TYPES, PLANT_VOUCHER, SOIL_PIT, SOIL_SUBSITE

U = "http://v.test/"


@pytest.fixture(scope="module")
def tables(spark):
    observation = spark.createDataFrame(
        [
            ("v1", "s1", "North Survey", "soil profile", "ph", "probe", "2020-01-01", 5.0, 130.0, -25.0),
            ("v1", "s1", "North Survey", "plant", "height", "tape", "2020-01-01", 1.5, 130.0, -25.0),
            ("v2", "s2", "North Survey", "plant", "height", "tape", "2021-06-30", 2.5, 140.0, -30.0),
            ("v3", "s3", "South Survey", "plant", "cover", "eye", "2022-02-02", 30.0, 145.0, -35.0),
        ],
        "visit_id string, site_id string, dataset string, feature_type string, observed_property string, "
        "used_procedure string, visit_date string, obs_value double, lon double, lat double",
    ).withColumn("visit_date", F.col("visit_date").cast("date"))
    attrs = F.create_map(F.lit(U + "attributes/area"), F.lit("1"))
    sample = spark.createDataFrame(
        [
            ("p1", "name1", "s1", PLANT_VOUCHER, "Acacia aneura", None, None, None, '[{"original":"u1"}]'),
            ("p2", "name2", "s1", PLANT_VOUCHER, "Acacia dealbata", None, None, None, "[]"),
            ("p3", "name3", "s2", SOIL_PIT, None, 3, 0.0, 0.1, None),
            ("p4", "name4", "s2", SOIL_SUBSITE, None, 3, 0.1, 0.5, None),
        ],
        "sample_id string, sample_name string, site_id string, material_sample_type string, "
        "scientific_name string, soil_subsite_id long, soil_depth_min double, soil_depth_max double, "
        "sample_images string",
    ).withColumn("dataset", F.lit("North Survey")).withColumn("visit_date", F.lit("2020-01-01").cast("date"))
    labels = {
        "dataset": ["North Survey", "South Survey"],
        "site_id": ["s1", "s2", "s3"],
        "feature_type": ["soil profile", "plant"],
        "observed_property": ["ph", "height", "cover"],
        "used_procedure": ["probe", "tape", "eye"],
        "region_type": ["bioregions", "states"],
        "region": ["Mulga", "Queensland", "Victoria"],
        "material_sample_type": list(MATERIAL_SAMPLE_TYPES),
    }
    vocab = [(f, f"{U}{f}/{v}", v) for f, vs in labels.items() for v in vs]
    vocab.append(("attributes", U + "attributes/area", "Area"))
    regions = [("s1", "bioregions", "Mulga"), ("s1", "states", "Queensland"), ("s3", "states", "Victoria")]
    return SurveyTables(
        observation=observation.withColumn("attrs", attrs),
        sample=sample,
        site_region=spark.createDataFrame(regions, "site_id string, region_type string, region string"),
        vocab=spark.createDataFrame(vocab, "facet string, uri string, label string"),
        site_attributes=spark.createDataFrame([("s1", 10000.0), ("s3", 5.0)], "site_id string, plotArea double"),
        site_visit_attributes=spark.createDataFrame([("v1", "x"), ("v3", "y")], "visit_id string, note string"),
        required_sample_dataset="North Survey",
    )


@pytest.fixture
def obs(tables):
    return PlotData(tables, order=["visit_id", "feature_type"])


def test_required_dataset_needs_its_column(tables):
    from dataclasses import replace

    bare = replace(tables, sample=tables.sample.drop("dataset"))
    with pytest.raises(PlotDataError, match="dataset column"):
        PlotData(bare, "samples")


def test_map_layer_of_a_shape(obs):
    assert obs.map_layer(window=(139.0, 0.0, 146.0, -60.0)).count() < obs.map_layer().count()
    assert {r.kind for r in obs.map_layer(limit=2).collect()} == {"cluster"}
    assert obs.map_layer(shape=[144.0, -36.0, 146.0, -34.0]).count() == 1


def test_long_lists_keep_the_same_rows(smp):
    import quadrat.operators.selection as selection

    few = sorted(r.sample_id for r in smp.select(soil_subsite_id=[3]).selected().collect())
    many = [3, *range(10_000, 10_000 + selection.IN_LIST_LIMIT + 1)]
    assert few == sorted(r.sample_id for r in smp.clear().select(soil_subsite_id=many).selected().collect()) == ["p3", "p4"]


def test_preview_of_samples_is_clean(smp):
    with pytest.raises(PlotDataError, match="one material_sample_type"):
        smp.preview()
    assert smp.select(material_sample_type=SOIL_PIT).preview().count() == 1


@pytest.fixture
def smp(tables):
    return PlotData(tables, "sample")


def keys(df, column="key"):
    return sorted(r[column] for r in df.collect())


def test_select_resolves_labels_and_codes(obs):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert obs.select(dataset="North Survy").select(site_id=U + "site_id/s1") is obs
    assert any("Took dataset" in str(w.message) for w in seen)
    assert obs.get_filter() == {"dataset": ["North Survey"], "site_id": ["s1"]}
    assert obs.get_api_query_filters("dataset") == [U + "dataset/North Survey"]
    assert obs.selected().count() == 2
    obs.remove(site_id="s1")
    assert obs.get_filter("site_id") is None and obs.selected().count() == 3
    assert obs.clear().get_filter() == {}


def test_failed_select_changes_nothing(obs):
    obs.select(feature_type="plant")
    for bad in ({"dataset": "zzzz"}, {"nope": 1}, {"region": "Mulga"}):
        with pytest.raises(PlotDataError):
            obs.select(bad)
    with pytest.warns(UserWarning, match="Nothing matches"):
        obs.select(date_from="2030-01-01")
    assert obs.get_filter() == {"feature_type": ["plant"]}


def test_project_dates_spatial_region(obs):
    assert obs.select(project="South Survey").selected().count() == 1
    obs.clear().from_date("30/06/2021").to_date("2nd February 2022")
    assert keys(obs.selected(), "visit_id") == ["v2", "v3"]
    assert keys(obs.clear().select(spatial=[139, -36, 146, -29]).selected(), "visit_id") == ["v2", "v3"]
    wkt = "POLYGON((129 -26, 131 -26, 131 -24, 129 -24, 129 -26))"
    assert keys(obs.clear().select(spatial=wkt).selected(), "visit_id") == ["v1", "v1"]
    obs.clear().select(region_type="states", region=["Queensland", "Victoria"])
    assert keys(obs.selected(), "visit_id") == ["v1", "v1", "v3"]
    assert obs.remove(region_type=None).get_filter() == {}


def test_summary_and_discovery(obs):
    obs.select(feature_type="plant")
    got = {r["metric"]: r["count"] for r in obs.summary().collect()}
    assert got == {
        "observations": 3,
        "dataset": 2,
        "site_id": 3,
        "site_visit_id": 3,
        "feature_type": 1,
        "observed_property": 2,
        "used_procedure": 2,
    }
    near = {r["metric"]: r["count"] for r in obs.summary(approximate=True).collect()}
    assert near == got
    assert keys(obs.discover("Observed Properties")) == ["cover", "height"]
    assert keys(obs.discover("sites")) == ["s1", "s2", "s3"]
    assert keys(obs.discover("region", region_type="states")) == ["Queensland", "Victoria"]
    assert keys(obs.discover("region_type")) == ["bioregions", "states"]
    assert [tuple(r) for r in obs.discover("observation attributes").collect()] == [
        ("Area", U + "attributes/area")
    ]
    wide = {r["key"]: (r["bioregions"], r["states"]) for r in obs.get_sites(include_region=True).collect()}
    assert wide == {"s1": ("Mulga", "Queensland"), "s2": (None, None), "s3": (None, "Victoria")}
    assert keys(obs.select(site_id="s1").discover("site_attributes_data"), "plotArea") == [10000.0]
    assert keys(obs.get_site_visit_attributes_data(), "visit_id") == ["v1"]
    with pytest.raises(PlotDataError):
        obs.discover("region")
    with pytest.raises(PlotDataError):
        obs.discover("colour")
    with pytest.raises(PlotDataError):
        obs.get_regions("zzzzz")


def test_every_alias_leads_somewhere(obs, smp):
    for name in ANSWERS:
        what = name.removesuffix("s") if name.startswith("material") else name
        plots = smp if what in ("material_sample_type", "sample_igsn") else obs
        if what in ("soil_depth_range", "soilpit", "speciesname"):
            with pytest.raises(PlotDataError):  # needs a sample type
                smp.discover(name)
            continue
        assert plots.discover(name, region_type="states").columns


def test_samples_mode(smp):
    assert smp.get_filter() == {"dataset": ["North Survey"]}
    assert keys(smp.get_datasources()) == ["North Survey"]
    with pytest.raises(PlotDataError):
        smp.remove(dataset=None)
    with pytest.raises(PlotDataError):
        smp.get_data()
    smp.select(material_sample_type=PLANT_VOUCHER, speciesname=["acacia ANEURA"])
    assert smp.get_filter("speciesname") == ["Acacia aneura"]
    assert keys(smp.selected(), "sample_id") == ["p1"]
    smp.select(has_image=True)
    row = smp.get_sample_images().first()
    assert (row["name"], row["default"]) == ("name1", "u1")
    data = smp.get_data()
    assert "soil_depth_min" not in data.columns and data.count() == 1
    assert smp.clear().get_filter() == {"dataset": ["North Survey"]}
    with pytest.raises(PlotDataError):
        smp.get_sample_images()
    assert keys(smp.discover("sample_igsn"), "sample_name") == ["NAME1", "NAME2", "NAME3", "NAME4"]


def test_sample_aggregates_and_guards(smp):
    for ask in (smp.get_soilpit, smp.get_speciesname, smp.get_soil_depth_range):
        with pytest.raises(PlotDataError, match="material_sample_type"):
            ask()
    smp.select(material_sample_type=[SOIL_SUBSITE, SOIL_PIT])
    assert smp.get_soil_depth_range().first().asDict() == {
        "overall_depth_min_meter": 0.0,
        "overall_depth_max_meter": 0.5,
        "min_depth_range": "0.0-0.1 m",
        "max_depth_range": "0.1-0.5 m",
    }
    assert [tuple(r) for r in smp.get_soilpit().collect()] == [(3, 2)]
    with pytest.raises(PlotDataError):
        smp.get_speciesname()
    smp.clear().select(material_sample_type=PLANT_VOUCHER)
    assert sorted(tuple(r) for r in smp.get_speciesname().collect()) == [
        ("Acacia aneura", 1),
        ("Acacia dealbata", 1),
    ]
    assert keys(smp.clear().select(soil_depth_range=[0.0, 0.05], soil_subsite="3").selected(), "sample_id") == ["p3"]
    got = {r["metric"]: r["count"] for r in smp.clear().summary().collect()}
    assert got == {"site_id": 2, "material_sample_type": 3, "speciesname": 2, "sample_name": 4}


def test_retrieval_and_export(obs, spark, tmp_path):
    with pytest.raises(UnfilteredReadError):
        obs.get_data()
    assert obs.get_data(allow_full_download=True).count() == 4
    obs.select(dataset="North Survey")
    assert [r["geometry"] for r in obs.get_data(dformat="gpd").where("visit_id = 'v2'").collect()] == [
        "POINT (140.0 -30.0)"
    ]
    assert obs.get_data(dformat="geojson").columns == ["value"] and obs.preview("json").count() == 3
    with pytest.raises(PlotDataError):
        obs.get_data(dformat="what")
    assert obs.get_data(fill=True).where("dataset = 'N/A'").count() == 0
    assert [r["visit_id"] for r in obs.preview().collect()] == ["v1", "v2", "v1"]
    assert [r["visit_id"] for r in obs.page(2, 2).collect()] == ["v2"]
    out = obs.export_data(str(tmp_path / "deep" / "a.parquet"), partition_by="feature_type")
    assert spark.read.parquet(out).count() == 3
    lines = spark.read.text(obs.export_data(str(tmp_path / "a.geojson"))).select(
        F.get_json_object("value", "$.geometry.coordinates[0]").alias("x")
    )
    assert sorted(r["x"] for r in lines.collect()) == ["130.0", "130.0", "140.0"]
    for path, kind in (("a.csv", "pq"), ("a.gpkg", None), ("a", None), ("a.csv", "what")):
        with pytest.raises(PlotDataError):
            obs.export_data(str(tmp_path / path), kind)


def test_default_order(tables):
    plots = PlotData(tables)
    assert [r["visit_id"] for r in plots.page(1, 3).collect()] == ["v1", "v1", "v2"]


def test_map(obs):
    assert obs.clusters().agg(F.sum("num_sites")).first()[0] == 3
    assert obs.sites_in([139, -36, 146, -29]).first()["num_sites"] == 2
    assert obs.map_layer().count() == 3


def test_saved_selections(obs, tables, tmp_path):
    path = str(tmp_path / "saved")
    obs.select(dataset="North Survey", date_from="2020-06-01", spatial=[100, -40, 150, -10])
    obs.save_selection(path, "mine")
    other = PlotData(tables).load_selection(path, "mine")
    assert other.get_filter() == obs.get_filter()
    assert other.get_api_query_filters() == obs.get_api_query_filters()
    with pytest.raises(PlotDataError):
        other.load_selection(path, "yours")


def test_codes_in_the_fact_table(tables, spark):
    """Fact tables may hold identifiers instead of labels."""
    rows = tables.observation
    for facet in ("dataset", "feature_type", "site_id"):
        rows = rows.withColumn(facet, F.concat(F.lit(f"{U}{facet}/"), facet))
    plots = PlotData(SurveyTables(observation=rows, vocab=tables.vocab, codes="uri"))
    plots.select(dataset="North Survey")
    assert plots.selected().count() == 3
    assert [tuple(r) for r in plots.get_datasources().collect()] == [
        ("North Survey", U + "dataset/North Survey")
    ]
