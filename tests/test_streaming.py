import json

import pytest
from pyspark.sql import functions as F

from quadrat import PlotData, PlotDataError, SurveyTables
from quadrat.operators import flatten
from quadrat.sinks import writers
from quadrat.sources import readers
from quadrat.streaming import jobs

SCHEMA = "id long, ts timestamp, feature_type string, value double"


@pytest.fixture
def folder(spark, tmp_path):
    """Three files that arrive one after the other; id 1 is delivered twice."""
    rows = [
        [(1, "2024-01-01 00:00:00", "soil", 1.0), (2, "2024-01-01 00:01:00", "plant", 2.0)],
        [(1, "2024-01-01 00:02:00", "soil", 1.0), (3, "2024-01-01 00:03:00", None, 3.0)],
        [(4, "2024-01-01 00:04:00", "plant", 4.0)],
    ]
    for part in rows:
        df = spark.createDataFrame(part, "id long, ts string, feature_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in")
        )
    return str(tmp_path / "in")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_counts_equal_batch(spark, folder):
    got = {r["feature_type"]: r["count"] for r in jobs.facet_counts(stream(spark, folder), "feature_type").collect()}
    batch = spark.read.parquet(folder).groupBy("feature_type").count().collect()
    assert got == {r["feature_type"]: r["count"] for r in batch} == {"soil": 2, "plant": 2, None: 1}


def test_counts_without_repeats(spark, folder):
    how = {"key": ["id"], "time": "ts", "delay": "1 hour"}
    rows = jobs.facet_counts(stream(spark, folder), "feature_type", **how).collect()
    assert {r["feature_type"]: r["count"] for r in rows} == {"soil": 1, "plant": 2, None: 1}


def test_counts_go_on_after_a_restart(spark, folder, tmp_path):
    """Repeats of rows counted before the restart stay repeats; earlier files are not read again."""
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "cp")}
    how = {"key": ["id"], "time": "ts", "delay": "1 hour"}

    def counted():
        rows = jobs.facet_counts(stream(spark, folder), "feature_type", **how, **where).collect()
        return {r["feature_type"]: r["count"] for r in rows}

    assert counted() == {"soil": 1, "plant": 2, None: 1}
    more = [(4, "2024-01-01 00:05:00", "plant", 4.0), (5, "2024-01-01 00:05:30", "plant", 5.0)]
    df = spark.createDataFrame(more, "id long, ts string, feature_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
    assert counted() == {"soil": 1, "plant": 3, None: 1}
    assert counted() == {"soil": 1, "plant": 3, None: 1}
    changed = spark.read.parquet(where["out"]).where("batch_id >= 0").collect()
    # one row per batch and changed value: nothing was counted from the start again
    last = max(r["batch_id"] for r in changed)
    assert [(r["feature_type"], r["count"]) for r in changed if r["batch_id"] == last and r["count"] == 3] in ([], [("plant", 3)])
    assert sum(r["feature_type"] == "soil" for r in changed) == 1


def test_continues_after_a_stop(spark, folder, tmp_path):
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "cp")}
    first = jobs.chunks_by_type(stream(spark, folder), "feature_type", **where)
    assert first.count() == 5
    more = spark.createDataFrame([(9, "soil", 9.0)], "id long, feature_type string, value double")
    more.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(folder)
    again = jobs.chunks_by_type(stream(spark, folder), "feature_type", **where)
    assert sorted(r["id"] for r in again.collect()) == [1, 1, 2, 3, 4, 9]
    assert {r["feature_type"] for r in again.collect()} == {"soil", "plant", None}


def test_empty_input(spark, tmp_path):
    (tmp_path / "none").mkdir()
    lines = readers.clean_lines(spark.readStream.text(str(tmp_path / "none")))
    assert jobs.run_to_table(lines, "none").collect() == []


def test_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('\n {"a": 1} \n\t\n{"b": 2}\n')
    lines = readers.clean_lines(spark.readStream.text(str(tmp_path / "in")))
    assert sorted(r["line"] for r in jobs.run_to_table(lines, "lines").collect()) == ['{"a": 1}', '{"b": 2}']


def test_flatten_is_the_same_on_a_stream(spark, tmp_path):
    docs = [
        {"type": "Feature", "properties": {"site": {"site.name": f"S{i}"}, "siteVisit": [
            {"siteVisit.id": str(v), "featureOfInterest": []} for v in range(i)]}}
        for i in range(4)
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.geojson").write_text("\n".join(json.dumps(d) for d in docs))
    plan = lambda lines: flatten.flatten_features(
        readers.parse_features(readers.clean_lines(lines), "line")
    ).select("site_name", "visit_id")
    streamed = jobs.run_to_table(plan(spark.readStream.text(str(tmp_path / "in"))), "flat")
    batch = plan(spark.read.text(str(tmp_path / "in")))
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str)
    assert batch.count() == 1 + 1 + 2 + 3


def test_selection_on_a_stream(spark, folder):
    facts = spark.read.parquet(folder)
    plots = PlotData(SurveyTables(observation=facts), order=["id"]).select(feature_type="plant")
    got = plots.get_data_stream(stream(spark, folder))
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in plots.get_data().collect()) == [2, 4]


def test_file_round_trips(spark, folder, tmp_path):
    rows = spark.read.parquet(folder).withColumn("lon", F.col("value")).withColumn("lat", F.lit(None).cast("double"))
    want = sorted(tuple(r) for r in rows.select("id", "value").collect())
    for name in ("a.parquet", "b.csv"):
        path = writers.write_table(rows, str(tmp_path / name))
        back = spark.read.parquet(path) if name.endswith("parquet") else readers.read_csv(spark, path)
        assert sorted(tuple(r) for r in back.select("id", "value").collect()) == want
    path = writers.write_table(rows, str(tmp_path / "c.json"))
    docs = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert {d["type"] for d in docs} == {"Feature"} and all(d["geometry"] is None for d in docs)
    assert sorted((d["properties"]["id"], d["properties"]["value"]) for d in docs) == want


def test_csv_tables_of_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("site_id,longitude_Degree,latitude_Degree,a\nA,153.0,-27.0,one\n")
    (tmp_path / "b.csv").write_text("site_id,longitude_Degree,latitude_Degree,b\nB,154.0,-28.0,two\n")
    (tmp_path / "empty").mkdir()
    base = "site_id string, longitude_Degree double, latitude_Degree double"
    got = readers.read_csv_by_type(
        spark,
        {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv"), "none": str(tmp_path / "empty")},
        {"a": base + ", a string", "b": base + ", b string", "none": base},
        fill=True,
    )
    rows = [r.asDict() for r in got.orderBy("site_id").collect()]
    assert [(r["site_id"], r["a"], r["b"], r["feature_type"]) for r in rows] == [
        ("A", "one", "N/A", "a"),
        ("B", "N/A", "two", "b"),
    ]


def test_samples_stream_lands_as_one_table(spark, tmp_path):
    facts = spark.createDataFrame(
        [("p1", "Soil Pit Sample", 3), ("p2", "Soil Pit Sample", 4), ("p3", "Plant Tissue Sample", 3)],
        "sample_id string, material_sample_type string, soil_subsite_id long",
    )
    facts.write.parquet(str(tmp_path / "in"))
    plots = PlotData(SurveyTables(sample=facts), "samples").select(soil_subsite_id=3)
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(PlotDataError, match="one material_sample_type"):
        plots.get_data_stream(stream)
    plots.select(material_sample_type="Soil Pit Sample")
    rows = plots.get_data_stream(stream)
    batch = plots.get_data()
    assert rows.columns == batch.columns
    assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in batch.collect()] == [("p1", "Soil Pit Sample", 3)]


def test_output_without_its_checkpoint_is_refused(spark, folder, tmp_path):
    with pytest.raises(PlotDataError, match="both folders"):
        jobs.run_to_table(stream(spark, folder), "x", out=str(tmp_path / "out"))


def test_geojson_lines_stream(spark, folder):
    plots = PlotData(SurveyTables(observation=spark.read.parquet(folder)), order=["id"])
    plots.select(feature_type="soil")
    lines = plots.get_data_stream(stream(spark, folder), dformat="geojson").collect()
    docs = [json.loads(r["value"]) for r in lines]
    assert [d["properties"]["id"] for d in docs] == [1, 1] and docs[0]["geometry"] is None


def test_chunks_have_their_own_columns(spark, tmp_path):
    rows = [("1", "soil", 1.0, None, None), ("2", "plant", None, "x", None), ("3", "soil", 2.0, None, None), ("4", None, None, None, "w")]
    schema = "id string, feature_type string, depth double, species string, `a b` string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "cp")}
    facts = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    plots = PlotData(SurveyTables(observation=facts), order=["id"])
    with pytest.raises(PlotDataError):
        plots.get_chunk_stream(stream)
    chunks = plots.get_chunk_stream(stream, allow_full_download=True, **where)
    assert chunks.of("soil").columns == ["id", "feature_type", "depth"]
    assert chunks.of("plant").columns == ["id", "feature_type", "species"]
    assert chunks.of(None).columns == ["id", "a b"]
    assert chunks.of("none").collect() == []
    assert {(r["feature_type"], r["rows"]) for r in chunks.manifest().collect()} == {("soil", 2), ("plant", 1), (None, 1)}
    # a later batch brings a further column to a type
    more = [("5", "soil", None, "y", None)]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    chunks = plots.get_chunk_stream(stream, allow_full_download=True, **where)
    got = sorted(tuple(r) for r in chunks.of("soil").collect())
    assert got == [("1", "soil", 1.0, None), ("3", "soil", 2.0, None), ("5", "soil", None, "y")]
    assert chunks.together().columns == ["id", "feature_type", "depth", "species", "a b"]
    assert chunks.together().count() == 5


def test_a_repeated_batch_replaces_itself(spark, tmp_path, monkeypatch):
    """A batch that dies before its manifest shows nothing; run again it shows its rows once."""
    schema = "id long, feature_type string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    where = {"out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "cp")}
    real, calls = jobs.cut_lineage, []

    def dies_once(df):
        calls.append(1)
        if len(calls) == 1:
            real(df).write.mode("overwrite").parquet(f"{where['out']}/batch_id=0/chunk=0")
            raise RuntimeError("lost")
        return real(df)

    monkeypatch.setattr(jobs, "cut_lineage", dies_once)
    with pytest.raises(Exception):
        jobs.land_chunks(stream, "feature_type", **where)
    assert jobs.Chunks(spark, where["out"], stream.schema).together().collect() == []
    chunks = jobs.land_chunks(stream, "feature_type", **where)
    assert sorted(tuple(r) for r in chunks.together().collect()) == [(1, "a"), (2, "b")]
