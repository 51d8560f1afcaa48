"""The survey model over the star-schema tables, in Spark and as SQL text.

Every dimension is unique on its key, so an observation row is kept by left joins and
only the dimensions that a query asks columns of are joined at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import SurveyTables
from ..session import configure

VOCAB_BASE = "http://v.test/"

ORDER = ["visit_id", "line_no", "part_id", "supplier_id"]
FROM_ORDERS = {"site_id", "used_procedure", "visit_date", "visit_time", "lon", "lat"}
FROM_PART = {"feature_type"}
FROM_CUSTOMER = {"dataset"}


_schemas: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder; its schema is read from the files once per process."""
    path, reader = f"{folder}/{name}.parquet", configure(spark).read
    if (folder, name) not in _schemas:
        _schemas[folder, name] = reader.parquet(path).schema
    return reader.schema(_schemas[folder, name]).parquet(path)


LON_SQL = "CAST(112.9 AS DOUBLE) + CAST(({key} * 37) % 4070 AS DOUBLE) / 100"
LAT_SQL = "CAST(-43.8 AS DOUBLE) + CAST(({key} * 53) % 3320 AS DOUBLE) / 100"


def _position(key: str):
    return (
        F.expr(LON_SQL.format(key=key)).alias("lon"),
        F.expr(LAT_SQL.format(key=key)).alias("lat"),
    )


def site(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    joined = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.col("c_custkey").alias("site_id"),
        F.col("c_name").alias("label"),
        F.col("c_mktsegment").alias("dataset"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        *_position("c_custkey"),
    )


def site_points(spark: SparkSession, folder: str) -> DataFrame:
    """(site_id, lon, lat) straight from the customers: no dimension is needed."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("site_id"), *_position("c_custkey")
    )


def site_region(spark: SparkSession, folder: str) -> DataFrame:
    both = F.array(
        F.struct(F.lit("nations").alias("region_type"), F.col("nation").alias("region")),
        F.struct(F.lit("regions").alias("region_type"), F.col("region").alias("region")),
    )
    rows = site(spark, folder).select("site_id", F.explode(both).alias("m"))
    return rows.select("site_id", "m.region_type", "m.region")


def visit(spark: SparkSession, folder: str) -> DataFrame:
    late = F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00"))
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderdate") >= late)
        .select(
            F.col("o_orderkey").alias("visit_id"),
            F.col("o_custkey").alias("site_id"),
            F.col("o_orderdate").cast("date").alias("visit_date"),
            F.col("o_orderpriority").alias("used_procedure"),
        )
    )


def observation(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """Flat observations; with ``columns`` only those, and only the joins they need."""
    every = {
        "visit_id": "l_orderkey",
        "line_no": "l_linenumber",
        "part_id": "l_partkey",
        "supplier_id": "l_suppkey",
        "site_id": "o_custkey",
        "dataset": "c_mktsegment",
        "feature_type": "p_type",
        "observed_property": "concat(l_returnflag, l_linestatus)",
        "used_procedure": "o_orderpriority",
        "visit_date": "CAST(o_orderdate AS DATE)",
        # the raw column, for date filters that reach the scan
        "visit_time": "o_orderdate",
        "obs_value": "l_quantity",
        "obs_result_time": "l_shipdate",
        "lon": LON_SQL.format(key="o_custkey"),
        "lat": LAT_SQL.format(key="o_custkey"),
    }
    wanted = columns or list(every)
    need = set(wanted)
    rows = table(spark, folder, "lineitem")
    if need & (FROM_ORDERS | FROM_CUSTOMER):
        orders = table(spark, folder, "orders")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if need & FROM_PART:
        part = table(spark, folder, "part").select("p_partkey", "p_type")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "dataset" in need:
        customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.selectExpr(*[f"{every[c]} AS {c}" for c in wanted])


def sample(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    url = F.concat(
        F.lit('[{"original":"http://img.test/'), key.cast("string"), F.lit('"}]')
    )
    images = (
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "[]").when(key % 4 == 2, '["  "]')
    ).otherwise(url)
    return table(spark, folder, "part").select(
        key.alias("sample_id"),
        F.concat(F.lit("aus"), key.cast("string")).alias("sample_name"),
        F.col("p_name").alias("scientific_name"),
        F.col("p_type").alias("material_sample_type"),
        F.col("p_size").alias("soil_subsite_id"),
        (F.col("p_size").cast("double") / 100).alias("soil_depth_min"),
        ((F.col("p_size") + key % 7 + 1).cast("double") / 100).alias("soil_depth_max"),
        images.alias("sample_images"),
        ((key * 7) % 100).alias("site_id"),
    )


# Facet -> the (table, label expression) pairs its labels come from.
VOCAB_SOURCES = {
    "dataset": [("customer", "c_mktsegment")],
    "site_id": [("customer", "c_custkey")],
    "feature_type": [("part", "p_type")],
    "material_sample_type": [("part", "p_type")],
    "speciesname": [("part", "p_name")],
    "used_procedure": [("orders", "o_orderpriority")],
    "region": [("nation", "n_name"), ("region", "r_name")],
    "region_type": [("nation", "'nations'"), ("region", "'regions'")],
    "observed_property": [("lineitem", "concat(l_returnflag, l_linestatus)")],
}


def vocab(spark: SparkSession, folder: str, *facets: str) -> DataFrame:
    """(facet, uri, label) of the named facets (of all without names)."""
    parts = [
        table(spark, folder, name).selectExpr(
            f"'{facet}' AS facet", f"CAST({label} AS STRING) AS label"
        )
        for facet in facets or VOCAB_SOURCES
        for name, label in VOCAB_SOURCES[facet]
    ]
    uri = F.expr(f"concat('{VOCAB_BASE}', facet, '/', label)")
    rows = reduce(DataFrame.union, parts).distinct()
    return rows.select("facet", uri.alias("uri"), "label")


def survey(spark: SparkSession, folder: str) -> SurveyTables:
    points = site(spark, folder)
    return SurveyTables(
        observation=observation(spark, folder),
        sample=sample(spark, folder),
        site=points,
        site_region=site_region(spark, folder),
        vocab=vocab(spark, folder),
        site_attributes=points.select(
            "site_id", "label", F.col("nation").alias("locationName"), F.col("region").alias("bioregion")
        ),
        site_visit_attributes=visit(spark, folder).select("visit_id", "site_id", "visit_date"),
    )


# --- the same views as SQL --------------------------------------------------------

VIEW_SQL = {
    "site": """
SELECT c_custkey AS site_id, c_name AS label, c_mktsegment AS dataset, n_name AS nation,
       r_name AS region,
       CAST(112.9 AS DOUBLE) + CAST((c_custkey * 37) % 4070 AS DOUBLE) / 100 AS lon,
       CAST(-43.8 AS DOUBLE) + CAST((c_custkey * 53) % 3320 AS DOUBLE) / 100 AS lat
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "site_region": """
SELECT site_id, 'nations' AS region_type, nation AS region FROM site
UNION ALL SELECT site_id, 'regions', region FROM site""",
    "visit": """
SELECT o_orderkey AS visit_id, o_custkey AS site_id, CAST(o_orderdate AS DATE) AS visit_date,
       o_orderpriority AS used_procedure
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'""",
    "observation": """
SELECT l_orderkey AS visit_id, l_linenumber AS line_no, l_partkey AS part_id,
       l_suppkey AS supplier_id, o_custkey AS site_id, c_mktsegment AS dataset,
       p_type AS feature_type, concat(l_returnflag, l_linestatus) AS observed_property,
       o_orderpriority AS used_procedure, CAST(o_orderdate AS DATE) AS visit_date,
       l_quantity AS obs_value, l_shipdate AS obs_result_time,
       CAST(112.9 AS DOUBLE) + CAST((o_custkey * 37) % 4070 AS DOUBLE) / 100 AS lon,
       CAST(-43.8 AS DOUBLE) + CAST((o_custkey * 53) % 3320 AS DOUBLE) / 100 AS lat
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
     LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "sample": """
SELECT p_partkey AS sample_id, concat('aus', CAST(p_partkey AS VARCHAR)) AS sample_name,
       p_name AS scientific_name, p_type AS material_sample_type, p_size AS soil_subsite_id,
       CAST(p_size AS DOUBLE) / 100 AS soil_depth_min,
       CAST(p_size + p_partkey % 7 + 1 AS DOUBLE) / 100 AS soil_depth_max,
       CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '["  "]'
            ELSE concat('[{"original":"http://img.test/', CAST(p_partkey AS VARCHAR), '"}]')
       END AS sample_images,
       (p_partkey * 7) % 100 AS site_id
FROM part""",
    "vocab": """
SELECT facet, concat('http://v.test/', facet, '/', label) AS uri, label FROM (
  SELECT 'dataset' AS facet, c_mktsegment AS label FROM customer
  UNION SELECT 'site_id', CAST(c_custkey AS VARCHAR) FROM customer
  UNION SELECT 'feature_type', p_type FROM part
  UNION SELECT 'material_sample_type', p_type FROM part
  UNION SELECT 'speciesname', p_name FROM part
  UNION SELECT 'used_procedure', o_orderpriority FROM orders
  UNION SELECT 'region', n_name FROM nation
  UNION SELECT 'region', r_name FROM region
  UNION SELECT 'region_type', 'nations' FROM nation
  UNION SELECT 'region_type', 'regions' FROM region
  UNION SELECT 'observed_property', concat(l_returnflag, l_linestatus) FROM lineitem)""",
}


def with_views(body: str, *names: str) -> str:
    """``body`` preceded by the definitions of the views it uses."""
    wanted = [n for n in VIEW_SQL if n in names or (n == "site" and "site_region" in names)]
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in wanted)
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):]}"
    return f"WITH {ctes}\n{body}"
