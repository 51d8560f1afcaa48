"""Queries over nested documents, attribute bags, sample documents and image cells.

The documents are built row by row from the tables (no grouping), so there is one
document per line item or part and none grows with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import flatten, images, samples
from ..sinks import writers
from ..sources import readers
from ..session import cut_lineage, shared_dir, spread
from . import views
from .registry import query

# --- survey documents -------------------------------------------------------------

# The texts are put together by concat_ws, which leaves out NULL members as to_json does: in
# generated code, without building structs, variants and lambdas for every row first.


def _object(**members: str) -> str:
    """JSON text of an object from SQL of its members' texts; ``_`` in a name is a dot."""
    parts = ", ".join(f"""concat('"{name.replace("_", ".")}":', {value})""" for name, value in members.items())
    return f"concat('{{', concat_ws(',', {parts}), '}}')"


def _list(items: list[str], count: str) -> str:
    """JSON text of the first ``count`` items."""
    return f"concat('[', array_join(slice(array({', '.join(items)}), 1, {count}), ','), ']')"


X, Y = "100 + l_suppkey % 40", "-40 + l_linenumber"
_NUMBER = "coalesce(CAST({} AS STRING), 'null')"
# A line, a polygon with a hole, a collection with a corner at (X, Y), or a point.
GEOMETRY_SQL = f"""CASE l_suppkey % 10 WHEN 0 THEN NULL
  WHEN 1 THEN concat('{{"coordinates":[[', {X}, ',', {Y}, '],[', {X}, '.5,-3]],"type":"LineString"}}')
  WHEN 2 THEN concat('{{"coordinates":[[[', {X}, ',', {Y}, '],[170,', {Y}, '],[170,-1],[', {X}, ',', {Y},
    ']],[[150,-10],[151,-10],[151,-9],[150,-10]]],"type":"Polygon"}}')
  WHEN 3 THEN concat('{{"geometries":[{{"coordinates":[', {X}, ',', {Y}, '],"type":"Point"}},',
    '{{"coordinates":[[160,-2],[161,-5]],"type":"MultiPoint"}}],"type":"GeometryCollection"}}')
  ELSE concat('{{"coordinates":[', {_NUMBER.format("100 + l_suppkey / 8D")}, ',',
    {_NUMBER.format("-40 + l_linenumber / 4D")}, '],"type":"Point"}}') END"""


def _obs_sql(i: int) -> str:
    unit = """'"m"'""" if i % 2 else "CAST(NULL AS STRING)"
    return _object(
        observableProperty=f"""'"prop{i}"'""",
        value=f"CAST(l_quantity AS INT) + {i}",
        unit=unit,
        usedProcedure=f"""'"proc{i}"'""",
        system=f"""'{{"sensor":{{"value":{i},"unit":"mm"}}}}'""",
    )


def _foi_sql(f: int) -> str:
    """With no group, an empty group, one observation, or three in two groups."""
    o = [_obs_sql(i) for i in (1, 2, 3)]
    return _object(
        foi_id=f"""'"f{f}"'""",
        foi_type="""'"plot"'""" if f == 1 else """'"plant"'""",
        foi_scientificName="""'"Acacia"'""" if f == 2 else "CAST(NULL AS STRING)",
        foi_observations=f"""CASE CAST((l_suppkey + {f}) % 4 AS INT) WHEN 0 THEN '{{}}' WHEN 1 THEN '{{"g1":[]}}'
          WHEN 2 THEN concat('{{"g1":[', {o[0]}, ']}}')
          ELSE concat('{{"g1":[', {o[0]}, ',', {o[1]}, '],"g2":[', {o[2]}, ']}}') END""",
    )


def _visit_sql(v: int) -> str:
    return _object(
        siteVisit_id=f"""concat('"', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {v}), '"')""",
        siteVisit_date="""concat('"', date_format(l_shipdate, 'yyyy-MM-dd'), '"')""",
        featureOfInterest=_list([_foi_sql(1), _foi_sql(2)], f"CAST((l_partkey + {v}) % 3 AS INT)"),
    )


# One feature per line item with 0-2 visits, each with 0-2 features of interest.
FEATURE_SQL = _object(
    type="""'"Feature"'""",
    geometry=GEOMETRY_SQL,
    properties=_object(
        dataset=_object(
            # the escapes of a JSON string are Spark's own
            dataset_title="IF(l_returnflag IS NULL, NULL, trim(BOTH '[]' FROM to_json(array(l_returnflag))))",
            dataset_link="""'"http://d.test"'""",
            dataset_attributes=_object(area=_object(value="l_partkey", unit="""'"ha"'""")),
        ),
        site=_object(
            site_name="""concat('"S', l_suppkey, '"')""",
            site_link="""'"http://s.test"'""",
            site_attributes="""IF(l_suppkey % 7 = 0, concat(repeat('{"k":', 8), l_linenumber, repeat('}', 8)), NULL)""",
        ),
        siteVisit=_list([_visit_sql(1), _visit_sql(2)], "l_linenumber % 3"),
    ),
)


def feature_lines(spark, folder, part=0, parts=1):
    """One GeoJSON feature text per line item, of all or of one of several parts of the table.

    A row's place in its file tells its part, so parts are even however often a row repeats,
    and do not depend on how the files are split.
    """
    lines = views.table(spark, folder, "lineitem")
    if parts > 1:
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        lines = lines.where(F.pmod(place, F.lit(parts)) == part)
    lines = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    return spread(lines).select(
        F.expr(FEATURE_SQL).alias("value")
    )


def features(spark, folder):
    return readers.parse_features(feature_lines(spark, folder), "value")


DOC_SQL = """doc AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, *,
    l_returnflag AS dataset_title, concat('S', l_suppkey) AS site_name,
    l_suppkey % 10 AS shape, CAST(100 + l_suppkey % 40 AS DOUBLE) AS x, CAST(-40 + l_linenumber AS DOUBLE) AS y,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN x WHEN 2 THEN x WHEN 3 THEN x ELSE 100 + l_suppkey / CAST(8 AS DOUBLE) END AS minx,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN x + 0.5 WHEN 2 THEN 170 WHEN 3 THEN 161
      ELSE 100 + l_suppkey / CAST(8 AS DOUBLE) END AS maxx,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN y WHEN 2 THEN y WHEN 3 THEN y ELSE -40 + l_linenumber / CAST(4 AS DOUBLE) END AS miny,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN -3 WHEN 2 THEN -1 WHEN 3 THEN -2
      ELSE -40 + l_linenumber / CAST(4 AS DOUBLE) END AS maxy,
    (minx + maxx) / 2 AS lon, (miny + maxy) / 2 AS lat,
    CASE shape WHEN 0 THEN NULL WHEN 1 THEN concat('LINESTRING (', x, ' ', y, ', ', x + 0.5, ' -3.0)')
      WHEN 2 THEN concat('POLYGON ((', x, ' ', y, ', 170.0 ', y, ', 170.0 -1.0, ', x, ' ', y,
        '), (150.0 -10.0, 151.0 -10.0, 151.0 -9.0, 150.0 -10.0))')
      WHEN 3 THEN concat('GEOMETRYCOLLECTION (POINT (', x, ' ', y, '), MULTIPOINT (160.0 -2.0, 161.0 -5.0))')
      ELSE concat('POINT (', lon, ' ', lat, ')') END AS geometry_wkt
  FROM lineitem),
two AS (SELECT unnest([1, 2]) AS i),
visits AS (SELECT doc.*, v.i AS v, id || '-' || v.i AS visit_id
  FROM doc LEFT JOIN two v ON v.i <= l_linenumber % 3),
fois AS (SELECT visits.*, f.i AS f, CASE WHEN f.i IS NOT NULL THEN concat('f', f.i) END AS foi_id,
    CASE f.i WHEN 1 THEN 'plot' WHEN 2 THEN 'plant' END AS foi_type,
    CASE f.i WHEN 2 THEN 'Acacia' END AS scientific_name
  FROM visits LEFT JOIN two f ON v IS NOT NULL AND f.i <= (l_partkey + v) % 3),
item AS (SELECT * FROM (VALUES (2, 'g1', 1), (3, 'g1', 1), (3, 'g1', 2), (3, 'g2', 3)) t(kind, grp, n)),
obs AS (SELECT fois.*, grp AS obs_group, n,
    CASE WHEN n IS NOT NULL THEN concat('prop', n) END AS obs_property,
    CASE WHEN n IS NOT NULL THEN CAST(CAST(l_quantity AS INTEGER) + n AS VARCHAR) END AS obs_value,
    CASE WHEN n % 2 = 1 THEN 'm' END AS obs_unit
  FROM fois LEFT JOIN item ON f IS NOT NULL AND kind = (l_suppkey + f) % 4
  WHERE f IS NULL OR (l_suppkey + f) % 4 <> 1)"""


@query(
    "scan_geojson_features",
    f"WITH {DOC_SQL} SELECT dataset_title, site_name, l_linenumber % 3 AS visits, count(*) AS n FROM doc GROUP BY ALL",
)
def scan_geojson_features(spark, folder):
    return _scanned(features(spark, folder))


def _scanned(rows):
    props = F.col("feature.properties")
    rows = rows.select(
        props["dataset"].getField("dataset.title").alias("dataset_title"),
        props["site"].getField("site.name").alias("site_name"),
        F.size(props["siteVisit"]).alias("visits"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


# Features written at once: some 4 GB of text.
ROUND_FEATURES = 6_000_000
COLLECTION_HEAD = '{"type":"FeatureCollection","crs":{"name":"x{"},"features":['


@query(
    "scan_collection_files",
    f"WITH {DOC_SQL} SELECT dataset_title, site_name, l_linenumber % 3 AS visits, count(*) AS n FROM doc GROUP BY ALL",
)
def scan_collection_files(spark, folder):
    """Collections of about a thousand features, written to files and read in splits.

    The texts are many times as large as the table. They are written round by round into the
    same folder, and only the counts of a round are kept, so the disk holds one round's files.
    """
    parts = views.table(spark, folder, "lineitem").count() // ROUND_FEATURES + 1
    out = shared_dir(spark, "collections")
    counts = []
    for part in range(parts):
        docs = writers.collection_documents(feature_lines(spark, folder, part, parts), COLLECTION_HEAD)
        docs.write.mode("overwrite").text(f"{out}/files")
        rows = readers.read_feature_collections(spark, f"{out}/files", f"{out}/texts")
        counts.append(cut_lineage(_scanned(rows)))
    rows = reduce(DataFrame.union, counts)
    return rows.groupBy("dataset_title", "site_name", "visits").agg(F.sum("n").alias("n"))


PLACED = ["lon", "lat", "geometry_wkt", "minx", "miny", "maxx", "maxy"]


@query("flatten_base", f"WITH {DOC_SQL} SELECT dataset_title, site_name, {', '.join(PLACED)} FROM doc")
def flatten_base(spark, folder):
    rows = flatten.base_context(features(spark, folder))
    return rows.select("dataset_title", "site_name", *PLACED)


@query("flatten_visits", f"WITH {DOC_SQL} SELECT site_name, visit_id FROM visits")
def flatten_visits(spark, folder):
    rows = flatten.explode_visits(flatten.base_context(features(spark, folder)))
    return rows.select("site_name", "visit_id")


@query(
    "flatten_foi",
    f"WITH {DOC_SQL} SELECT visit_id, foi_id, foi_type, scientific_name FROM fois",
)
def flatten_foi(spark, folder):
    base = flatten.base_context(features(spark, folder))
    rows = flatten.explode_fois(flatten.explode_visits(base))
    return rows.select("visit_id", "foi_id", "foi_type", "scientific_name")


@query(
    "flatten_observations",
    f"""WITH {DOC_SQL}
    SELECT visit_id, foi_id, obs_group, obs_property, obs_value, obs_unit FROM obs""",
)
def flatten_observations(spark, folder):
    base = flatten.base_context(features(spark, folder))
    rows = flatten.explode_observations(flatten.explode_fois(flatten.explode_visits(base)))
    return rows.select("visit_id", "foi_id", "obs_group", "obs_property", "obs_value", "obs_unit")


@query(
    "flatten_full",
    f"""WITH {DOC_SQL} SELECT dataset_title, obs_group, count(*) AS n,
      CAST(sum(CAST(obs_value AS BIGINT)) AS BIGINT) AS value_sum, count(lon) AS with_point,
      CAST(sum(l_partkey) AS BIGINT) AS area_sum, CAST(sum(n) AS BIGINT) AS sensor_sum,
      CAST(sum(CASE WHEN l_suppkey % 7 = 0 THEN l_linenumber END) AS BIGINT) AS deep_sum,
      count(DISTINCT geometry_wkt) AS shapes
    FROM obs GROUP BY ALL""",
)
def flatten_full(spark, folder):
    rows = flatten.flatten_features(features(spark, folder))
    attr = lambda k: F.col("attrs")[k].cast("long")
    return rows.groupBy("dataset_title", "obs_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("obs_value").cast("long")).alias("value_sum"),
        F.count("lon").alias("with_point"),
        F.sum(attr("dataset.attributes.area")).alias("area_sum"),
        F.sum(attr("obs.system.sensor")).alias("sensor_sum"),
        F.sum(attr("site.attributes" + ".k" * 8)).alias("deep_sum"),
        F.count_distinct("geometry_wkt").alias("shapes"),
    )


@query(
    "export_geojson_rows",
    """SELECT observed_property, dataset, count(*) AS features, count(*) AS points
    FROM observation GROUP BY ALL""",
    "observation",
)
def export_geojson_rows(spark, folder):
    """Observations as GeoJSON lines; what is counted is read back from the text."""
    rows = views.observation(
        spark, folder, ["visit_id", "dataset", "observed_property", "obs_value", "lon", "lat"]
    )
    line = lambda path: F.get_json_object("value", path)
    return (
        writers.geojson_lines(rows)
        .groupBy(
            line("$.properties.observed_property").alias("observed_property"),
            line("$.properties.dataset").alias("dataset"),
        )
        .agg(
            F.count(F.when(line("$.type") == "Feature", 1)).alias("features"),
            F.count(line("$.geometry.coordinates[1]")).alias("points"),
        )
    )


# --- attribute bags ---------------------------------------------------------------


@query(
    "attrs_flatten",
    """SELECT p_partkey AS sample_id, unnest(['size', 'size.unit', 'brand', 'price', 'price.unit',
        'price.attribute', 'nested.deep.er', 'nested.two', 'gone',
        concat('deep', repeat('.d', CASE WHEN p_partkey % 2 = 0 THEN 8 ELSE 30 END))]) AS attribute,
      unnest([CAST(p_size AS VARCHAR), 'cm', p_brand, CAST(p_partkey * 3 AS VARCHAR), 'AUD',
        'http://a.test', p_type, '[1,"x"]', NULL, CAST(p_partkey AS VARCHAR)]) AS value
    FROM part""",
)
def attrs_flatten(spark, folder):
    bag = F.expr(
        """to_json(named_struct('size', named_struct('value', p_size, 'unit', 'cm'), 'brand', p_brand,
        'price', named_struct('value', p_partkey * 3, 'unit', 'AUD', 'attribute', 'http://a.test'),
        'nested', named_struct('deep', named_struct('er', p_type), 'two', parse_json('[1,"x"]')),
        'gone', named_struct('value', CAST(NULL AS STRING)),
        'deep', parse_json(concat(repeat('{"d":', IF(p_partkey % 2 = 0, 8, 30)), p_partkey,
          repeat('}', IF(p_partkey % 2 = 0, 8, 30))))), map('ignoreNullFields', 'false'))"""
    )
    part = views.table(spark, folder, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    bags = spread(part).select(F.col("p_partkey").alias("sample_id"), F.parse_json(bag).alias("bag"))
    rows = bags.select("sample_id", flatten.flatten_bag("bag").alias("attrs"))
    return flatten.attribute_rows(rows)


@query(
    "attrs_wide",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS kind FROM events""",
)
def attrs_wide(spark, folder):
    bag = F.map_concat(
        flatten.flatten_bag("parse_json(props)"),
        F.create_map(F.lit("kind"), F.col("event_type")),
    )
    rows = views.table(spark, folder, "events").select("event_id", bag.alias("attrs"))
    return flatten.attributes_wide(rows)


# --- sample documents -------------------------------------------------------------

HIT_SQL = """to_json(named_struct('hits', named_struct('hits',
  IF(p_partkey % 5 = 0, slice(array(named_struct('_source', named_struct('sample_id', p_partkey,
      'sample_name', p_name, 'soil_depth_min', p_size / 8D))), 1, 0),
    array(named_struct('_source', named_struct('sample_id', p_partkey, 'sample_name', p_name,
      'soil_depth_min', p_size / 8D)))))))"""


@query(
    "scan_hits",
    """SELECT p_partkey AS sample_id, p_name AS sample_name,
      p_size / CAST(8 AS DOUBLE) AS soil_depth_min FROM part WHERE p_partkey % 5 <> 0""",
)
def scan_hits(spark, folder):
    answers = views.table(spark, folder, "part").select(F.expr(HIT_SQL).alias("value"))
    fields = {"sample_id": "bigint", "sample_name": "string", "soil_depth_min": "double"}
    hits = readers.parse_hits(answers, "value")
    return hits.select(*readers.source_columns(F.col("source"), fields))


@query(
    "scan_csv_by_type",
    """SELECT p_partkey AS sample_id, p_type AS feature_type, p_name AS scientific_name,
      CASE WHEN p_type = 'ECONOMY' THEN p_size END AS size_economy,
      CASE WHEN p_type = 'LARGE' THEN p_size END AS size_large,
      CASE WHEN p_type = 'MEDIUM' THEN p_size END AS size_medium,
      CASE WHEN p_type = 'PROMO' THEN p_size END AS size_promo,
      CASE WHEN p_type = 'SMALL' THEN p_size END AS size_small,
      CASE WHEN p_type = 'STANDARD' THEN p_size END AS size_standard
    FROM part""",
)
def scan_csv_by_type(spark, folder):
    """Parts written as one CSV table per type, then read back, each with its own columns."""
    rows = views.sample(spark, folder).select(
        "sample_id", "scientific_name", "soil_subsite_id", "material_sample_type"
    )
    out = shared_dir(spark, "by-type") + ".csv"
    writers.write_table(rows, out, partition_by="material_sample_type")
    types = rows.select("material_sample_type").distinct().collect()  # one row per type
    names = sorted(r["material_sample_type"] for r in types)
    return readers.read_csv_by_type(
        spark,
        {n: f"{out}/material_sample_type={n}" for n in names},
        {n: f"sample_id long, scientific_name string, size_{n.lower()} int" for n in names},
    )


# Sample documents as they come: codes, counters, nested identifiers.
def raw_samples(spark, folder):
    from .discovery import _procedure_code

    rows = views.sample(spark, folder)
    k = F.col("sample_id")
    code = lambda facet, c: F.concat(F.lit(f"{views.VOCAB_BASE}{facet}/"), c)
    first = _procedure_code((k % 6 + 1).cast("int"))
    return rows.select(
        "sample_id",
        "sample_name",
        code("material_sample_type", F.col("material_sample_type")).alias("material_sample_type"),
        F.when(k % 4 == 0, F.array(first))
        .when(k % 4 == 1, F.array(first, F.lit(None)))
        .when(k % 4 == 2, F.array().cast("array<string>"))
        .alias("used_procedure"),
        F.lit("x").alias("geopoint"),
        F.lit("y").alias("tags"),
        F.lit("z").alias("region_ibra"),
        F.lit(3).alias("sample_attr_count"),
        F.lit(None).cast("string").alias("never_filled"),
        "sample_images",
        F.parse_json(
            F.when(
                k % 3 != 0,
                F.concat(F.lit('[{"value":{"label":"10.60792/aus'), k.cast("string"), F.lit('"}}]')),
            ).otherwise("[]")
        ).alias("igsn_information"),
        F.parse_json(
            F.when(k % 2 == 0, '{"value":"2020-01-02"}').otherwise('[{"value":"2021-03-04"}]')
        ).alias("visit_start_date"),
    )


@query(
    "sample_clean",
    """SELECT sample_id, sample_name, material_sample_type,
      CASE WHEN sample_id % 4 < 2 THEN CASE sample_id % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH'
        WHEN 2 THEN '3-MEDIUM' WHEN 3 THEN '4-NOT SPECIFIED' WHEN 4 THEN '5-LOW'
        ELSE 'http://v.test/used_procedure/none' END END AS used_procedure,
      sample_images,
      CASE WHEN sample_id % 3 <> 0 THEN concat('10.60792/aus', sample_id) END AS igsn,
      CASE WHEN sample_id % 2 = 0 THEN '2020-01-02' ELSE '2021-03-04' END AS visit_date
    FROM sample""",
    "sample",
)
def sample_clean(spark, folder):
    rows = samples.clean_samples(
        raw_samples(spark, folder),
        views.vocab(spark, folder, "material_sample_type", "used_procedure"),
    )
    return samples.drop_empty_columns(rows)


@query(
    "drop_all_null",
    """SELECT sample_id, CASE WHEN sample_id % 2 = 0 THEN scientific_name END AS half FROM sample""",
    "sample",
)
def drop_all_null(spark, folder):
    """One column is NULL throughout, and no image cell that is left holds a filled list."""
    k = F.col("sample_id")
    rows = views.sample(spark, folder).select(
        "sample_id",
        F.when(k % 2 == 0, F.col("scientific_name")).alias("half"),
        F.lit(None).cast("double").alias("none_at_all"),
        F.when(k % 4 == 1, F.col("sample_images")).alias("sample_images"),
    )
    return samples.drop_empty_columns(rows)


@query(
    "lift_nested",
    """SELECT p_partkey AS sample_id,
      CASE WHEN p_partkey % 3 <> 0 THEN concat('10.60792/aus', p_partkey) END AS igsn,
      CASE WHEN p_partkey % 2 = 0 THEN '2020-01-02' ELSE '2021-03-04' END AS visit_date
    FROM part""",
)
def lift_nested(spark, folder):
    rows = raw_samples(spark, folder).select("sample_id", "igsn_information", "visit_start_date")
    return samples.lift(rows)


LABEL_CELLS = (
    '{"label":"L#"}',
    '[{"label":"L#"},{"label":"no"}]',
    '{"value":[{"label":"","value":"V#"}],"current":{"label":"no"}}',
    '{"value":{"value":"V#"}}',
    '{"current":[{"label":"C#"}]}',
    '"plain #"',
    '{"value":"scalar","current":{"value":"C#"}}',
    "[]",
    '{"label":null,"value":{"label":"no"}}',
)


@query(
    "label_coalesce",
    """SELECT event_id, CASE event_id % 9 WHEN 0 THEN concat('L', event_id) WHEN 1 THEN concat('L', event_id)
      WHEN 2 THEN concat('V', event_id) WHEN 3 THEN concat('V', event_id)
      WHEN 4 THEN concat('C', event_id) WHEN 6 THEN concat('C', event_id) END AS label
    FROM events""",
)
def label_coalesce(spark, folder):
    k = F.col("event_id")
    cells = F.array(*[F.lit(c) for c in LABEL_CELLS])
    cell = F.replace(F.get(cells, (k % 9).cast("int")), F.lit("#"), k.cast("string"))
    rows = views.table(spark, folder, "events")
    return rows.select("event_id", samples.pick_label(F.parse_json(cell)).alias("label"))


# --- image cells ------------------------------------------------------------------

IMAGE_CELLS = (
    None,
    '"http://i.test/#"',
    '["http://i.test/b#","http://i.test/a#","http://i.test/b#"]',
    '[{"thumbnail_640":"http://i.test/s#","original":"http://i.test/o#"},{"thumbnail_1280":"http://i.test/m#"}]',
    '{"thumbnail_320":"http://i.test/t#","junk":"http://i.test/j#","original":"http://i.test/o#"}',
    '{"photos":[{"url":"http://i.test/u#"},{"original":"http://i.test/o#","src":"http://i.test/u#"}]}',
    '["  ",{"href":" "},7]',
)


def image_cells(spark, folder):
    k = F.col("p_partkey")
    cells = F.array(*[F.lit(c) for c in IMAGE_CELLS])
    cell = F.replace(F.get(cells, (k % 7).cast("int")), F.lit("#"), k.cast("string"))
    return views.table(spark, folder, "part").select(
        k.alias("sample_id"),
        images.row_label(F.when(k % 2 == 0, F.col("p_name")), F.when(k % 3 == 0, k), k).alias("name"),
        images.image_options(cell).alias("options"),
    )


@query(
    "image_options",
    """WITH item AS (SELECT * FROM (VALUES (1, 0, 'image', ''), (2, 0, 'image', 'b'), (2, 1, 'image', 'a'),
        (3, 0, 'original', 'o'), (3, 1, 'thumbnail_1280', 'm'), (3, 2, 'thumbnail_640', 's'),
        (4, 0, 'thumbnail_320', 't'), (4, 1, 'original', 'o'),
        (5, 0, 'original', 'o'), (5, 1, 'url', 'u')) t(kind, position, label, tag))
    SELECT p_partkey AS sample_id, position, item.label,
      concat('http://i.test/', tag, p_partkey) AS url,
      CASE WHEN p_partkey % 2 = 0 THEN p_name WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR)
        ELSE concat('Sample ', p_partkey) END AS name
    FROM part JOIN item ON kind = p_partkey % 7""",
)
def image_options(spark, folder):
    rows = image_cells(spark, folder)
    return rows.select("sample_id", "name", F.posexplode("options").alias("position", "o")).select(
        "sample_id", "name", "position", "o.label", "o.url"
    )


@query(
    "image_default",
    """SELECT p_partkey AS sample_id, concat('http://i.test/', CASE p_partkey % 7 WHEN 1 THEN ''
        WHEN 2 THEN 'b' WHEN 3 THEN 'm' WHEN 4 THEN 't' ELSE 'o' END, p_partkey) AS url
    FROM part WHERE p_partkey % 7 BETWEEN 1 AND 5""",
)
def image_default(spark, folder):
    rows = image_cells(spark, folder)
    return rows.select("sample_id", images.default_image(F.col("options")).alias("url")).where(
        F.col("url").isNotNull()
    )


# --- identifiers ------------------------------------------------------------------

IGSN_FORMS = (
    "10.60792/a#",
    "https://doi.org/10.60792/a#",
    "http://DOI.org/10.60792/a#?x=1",
    "doi.org/10.60792/a#",
    "https://other.org/10.60792/a#",
    "  ",
    "10.60792/a #",
    "10.6/a#",
    " \t10.60792/a#\n",
)


@query(
    "igsn_normalise",
    """SELECT p_partkey AS sample_id, CASE WHEN p_partkey % 9 IN (0, 1, 2, 3, 8)
      THEN concat('10.60792/a', p_partkey) END AS igsn FROM part""",
)
def igsn_normalise(spark, folder):
    k = F.col("p_partkey")
    forms = F.array(*[F.lit(f) for f in IGSN_FORMS])
    raw = F.replace(F.get(forms, (k % 9).cast("int")), F.lit("#"), k.cast("string"))
    return views.table(spark, folder, "part").select(k.alias("sample_id"), text.igsn(raw).alias("igsn"))
