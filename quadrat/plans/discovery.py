"""Discovery, aggregate, lookup, preview and union queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import OBSERVATIONS
from ..operators import align, discovery, lookup, paging, spatial
from ..operators.selection import Selection, date_test
from ..sources import readers
from ..session import cut_lineage
from . import views
from .registry import query

SINCE = "2000-01-01"


def _recent(spark, folder, *columns):
    rows = views.observation(spark, folder, [*columns, "visit_time"])
    return rows.where(date_test(F.col("visit_time"), SINCE, None))


def _facet_sql(facet: str, column: str, source: str, where: str = "") -> str:
    return f"""SELECT f.code AS key, v.uri FROM
      (SELECT DISTINCT CAST({column} AS VARCHAR) AS code FROM {source} {where}) f
      LEFT JOIN (SELECT label, min(uri) AS uri FROM vocab WHERE facet = '{facet}' GROUP BY label) v
      ON f.code = v.label"""


RECENT_SQL = f"WHERE visit_date >= DATE '{SINCE}'"

for _facet, _column in (
    ("dataset", "dataset"),
    ("site_id", "site_id"),
    ("feature_type", "feature_type"),
    ("observed_property", "observed_property"),
    ("used_procedure", "used_procedure"),
):

    @query(
        "discover_site" if _facet == "site_id" else f"discover_{_facet}",
        _facet_sql(_facet, _column, "observation", RECENT_SQL),
        "observation vocab",
    )
    def _discover(spark, folder, facet=_facet, column=_column):
        rows = _recent(spark, folder, column)
        return discovery.discover_values(
            rows, column, views.vocab(spark, folder, facet), facet
        )


def _region_rows(spark, folder):
    sites = _recent(spark, folder, "site_id")
    return lookup.sites_of_samples(views.site_region(spark, folder), sites)


@query(
    "discover_region_type",
    _facet_sql(
        "region_type",
        "region_type",
        "site_region",
        f"WHERE site_id IN (SELECT site_id FROM observation {RECENT_SQL})",
    ),
    "observation site_region vocab",
)
def discover_region_type(spark, folder):
    vocab = views.vocab(spark, folder, "region_type")
    return discovery.discover_values(_region_rows(spark, folder), "region_type", vocab, "region_type")


@query(
    "discover_region",
    _facet_sql(
        "region",
        "region",
        "site_region",
        f"""WHERE region_type = 'nations'
        AND site_id IN (SELECT site_id FROM observation {RECENT_SQL})""",
    ),
    "observation site_region vocab",
)
def discover_region(spark, folder):
    rows = _region_rows(spark, folder).where(F.col("region_type") == "nations")
    vocab = views.vocab(spark, folder, "region")
    return discovery.discover_values(rows, "region", vocab, "region")


@query(
    "discover_material_sample_type",
    _facet_sql("material_sample_type", "material_sample_type", "sample", "WHERE soil_subsite_id > 25"),
    "sample vocab",
)
def discover_material_sample_type(spark, folder):
    rows = views.sample(spark, folder).where(F.col("soil_subsite_id") > 25)
    vocab = views.vocab(spark, folder, "material_sample_type")
    return discovery.discover_values(rows, "material_sample_type", vocab, "material_sample_type")


@query(
    "vocab_build",
    """SELECT facet, concat('http://v.test/', facet, '/', label) AS uri, label FROM (
      SELECT 'speciesname' AS facet, p_name AS label FROM part
      UNION SELECT 'feature_type', p_type FROM part
      UNION SELECT 'soil_subsite_id', CAST(p_size AS VARCHAR) FROM part)""",
)
def vocab_build(spark, folder):
    part = views.table(spark, folder, "part")
    return readers.build_vocab(
        part,
        {
            "speciesname": F.col("p_name"),
            "feature_type": F.col("p_type"),
            "soil_subsite_id": F.col("p_size"),
        },
        views.VOCAB_BASE,
    )


# --- attribute tables and keys ----------------------------------------------------


@query(
    "site_attributes",
    """SELECT site_id, label, nation AS "locationName", region AS bioregion FROM site
    WHERE site_id IN (SELECT site_id FROM observation WHERE dataset = 'FURNITURE')""",
    "site observation",
)
def site_attributes(spark, folder):
    rows = views.observation(spark, folder, ["site_id", "dataset"])
    chosen = Selection(OBSERVATIONS).add(spark, {"dataset": "FURNITURE"})
    tables = views.survey(spark, folder)
    return readers.attribute_table(tables, "site", chosen.apply(rows, tables))


@query(
    "visit_attributes",
    """SELECT visit_id, site_id, visit_date FROM visit
    WHERE visit_id IN (SELECT visit_id FROM observation WHERE observed_property = 'RF')""",
    "visit observation",
)
def visit_attributes(spark, folder):
    rows = views.observation(spark, folder, ["visit_id", "observed_property"])
    chosen = Selection(OBSERVATIONS).add(spark, {"observed_property": "RF"})
    tables = views.survey(spark, folder)
    return readers.attribute_table(tables, "site-visit", chosen.apply(rows, tables))


ATTRIBUTE_BASE = "http://v.test/attributes/"


def attribute_maps(spark, folder):
    """Attribute maps of parts; which keys a part has depends on its columns."""
    found = {
        "brand": F.col("p_brand"),
        "size": F.when(F.col("p_size") > 10, F.col("p_size").cast("string")),
        "price": F.when(F.col("p_type") == "PROMO", F.col("p_retailprice").cast("string")),
        "unknown": F.when(F.col("p_partkey") % 9 == 0, F.col("p_name")),
    }
    pairs = F.array(
        *[
            F.struct(F.lit(ATTRIBUTE_BASE + name).alias("key"), value.alias("value"))
            for name, value in found.items()
        ]
    )
    attrs = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return views.table(spark, folder, "part").select(F.col("p_partkey").alias("sample_id"), attrs.alias("attrs"))


@query(
    "attribute_discovery",
    """SELECT key, uri FROM (
      SELECT 'Brand' AS key, 'http://v.test/attributes/brand' AS uri, count(*) AS n FROM part
      UNION ALL SELECT 'Size', 'http://v.test/attributes/size', count(*) FROM part WHERE p_size > 10
      UNION ALL SELECT 'Price', 'http://v.test/attributes/price', count(*) FROM part WHERE p_type = 'PROMO'
      UNION ALL SELECT NULL, 'http://v.test/attributes/unknown', count(*) FROM part WHERE p_partkey % 9 = 0)
    WHERE n > 0""",
)
def attribute_discovery(spark, folder):
    # the vocabulary knows three of the four keys
    rows = ", ".join(f"('{ATTRIBUTE_BASE}{n.lower()}', '{n}')" for n in ("Brand", "Size", "Price"))
    names = spark.sql(f"SELECT 'attributes' AS facet, * FROM VALUES {rows} AS t(uri, label)")
    return discovery.discover_attributes(attribute_maps(spark, folder), names)


# --- aggregates -------------------------------------------------------------------

SUMMARY_FACETS = {
    "dataset": "dataset",
    "site_id": "site_id",
    "site_visit_id": "visit_id",
    "feature_type": "feature_type",
    "observed_property": "observed_property",
    "used_procedure": "used_procedure",
}


def _summary_sql(facets: dict[str, str], source: str, total: str | None) -> str:
    parts = [f"SELECT '{m}' AS metric, count(DISTINCT {c}) AS count FROM {source}" for m, c in facets.items()]
    if total:
        parts.insert(0, f"SELECT '{total}' AS metric, count(*) AS count FROM {source}")
    return " UNION ALL ".join(parts)


@query(
    "summary_observations",
    _summary_sql(SUMMARY_FACETS, "observation", "observations"),
    "observation",
)
def summary_observations(spark, folder):
    rows = views.observation(spark, folder, list(SUMMARY_FACETS.values()))
    return discovery.summary(rows, SUMMARY_FACETS, "observations")


@query(
    "summary_sketched",
    f"""SELECT metric, count > 0 AS found, TRUE AS close FROM ({_summary_sql(
        SUMMARY_FACETS, "(SELECT * FROM observation WHERE dataset IN ('BUILDING', 'MACHINERY'))", "observations")})""",
    "observation",
)
def summary_sketched(spark, folder):
    """The summary under a filter by merging sketches, against the exact one: within 2 %."""
    rows = views.observation(spark, folder, list(dict.fromkeys([*SUMMARY_FACETS.values(), "dataset"])))
    sketches = cut_lineage(discovery.summary_sketches(rows, "dataset", SUMMARY_FACETS))
    kept = ["BUILDING", "MACHINERY"]
    exact = discovery.summary(rows.where(F.col("dataset").isin(kept)), SUMMARY_FACETS, "observations")
    merged = discovery.summary_of_sketches(sketches, kept, "observations")
    both = exact.join(merged.withColumnRenamed("count", "estimate"), "metric")
    close = F.abs(F.col("estimate") - F.col("count")) <= 0.02 * F.col("count")
    return both.select("metric", (F.col("estimate") > 0).alias("found"), close.alias("close"))


SAMPLE_FACETS = {
    "site_id": "site_id",
    "material_sample_type": "material_sample_type",
    "speciesname": "scientific_name",
    "sample_name": "sample_name",
}


@query("summary_samples", _summary_sql(SAMPLE_FACETS, "sample", None), "sample")
def summary_samples(spark, folder):
    return discovery.summary(views.sample(spark, folder), SAMPLE_FACETS)


@query(
    "soilpit_counts",
    "SELECT soil_subsite_id AS soilpit, count(*) AS counts FROM sample GROUP BY 1",
    "sample",
)
def soilpit_counts(spark, folder):
    return discovery.soilpit_counts(views.sample(spark, folder))


@query(
    "species_counts",
    "SELECT scientific_name AS speciesname, count(*) AS count FROM sample GROUP BY 1",
    "sample",
)
def species_counts(spark, folder):
    return discovery.species_counts(views.sample(spark, folder))


@query(
    "soil_depth_range",
    """SELECT min(soil_depth_min) AS overall_depth_min_meter,
      max(soil_depth_max) AS overall_depth_max_meter,
      concat(min(soil_depth_min), '-', min(soil_depth_max), ' m') AS min_depth_range,
      concat(max(soil_depth_min), '-', max(soil_depth_max), ' m') AS max_depth_range
    FROM sample WHERE material_sample_type = 'PROMO'""",
    "sample",
)
def soil_depth_range(spark, folder):
    rows = views.sample(spark, folder).where(F.col("material_sample_type") == "PROMO")
    return discovery.soil_depth_range(rows)


@query(
    "sample_igsn",
    "SELECT upper(sample_name) AS sample_name, concat('10.60792/', sample_name) AS igsn FROM sample",
    "sample",
)
def sample_igsn(spark, folder):
    return discovery.sample_igsn(views.sample(spark, folder))


# --- map --------------------------------------------------------------------------

CELLS_SQL = """cells AS (
  SELECT CAST(floor((lon + 180) / 360 * 256) AS BIGINT) AS cell_x,
         CAST(floor((lat + 90) / 180 * 128) AS BIGINT) AS cell_y, count(*) AS num_sites,
         CAST(sum(CAST(lon AS DECIMAL(18,8))) AS DOUBLE) / count(*) AS lon,
         CAST(sum(CAST(lat AS DECIMAL(18,8))) AS DOUBLE) / count(*) AS lat
  FROM site GROUP BY 1, 2)"""


@query("map_clusters", f"WITH {CELLS_SQL} SELECT * FROM cells", "site")
def map_clusters(spark, folder):
    return spatial.clusters(views.site_points(spark, folder))


@query(
    "cluster_weights",
    f"""WITH {CELLS_SQL}
    SELECT *, CAST(num_sites AS DOUBLE) / max(num_sites) OVER () AS weight FROM cells""",
    "site",
)
def cluster_weights(spark, folder):
    return spatial.cluster_weights(spatial.clusters(views.site_points(spark, folder)))


@query(
    "map_layer",
    f"""WITH {CELLS_SQL}, few AS (SELECT count(DISTINCT site_id) BETWEEN 1 AND 249 AS yes FROM site)
    SELECT 'cluster' AS kind, CAST(NULL AS BIGINT) AS site_id, cell_x, cell_y, num_sites, lon, lat
    FROM cells, few WHERE NOT yes
    UNION ALL
    SELECT 'site', site_id, NULL, NULL, 1, lon, lat FROM site, few WHERE yes""",
    "site",
)
def map_layer(spark, folder):
    return spatial.map_layer(views.site_points(spark, folder))


WEST, NORTH, EAST, SOUTH = LAYER_WINDOW = (120.0, -15.0, 145.0, -35.0)


@query(
    "map_layer_window",
    f"""WITH shown AS (SELECT * FROM site
      WHERE lon BETWEEN {WEST} AND {EAST} AND lat BETWEEN {SOUTH} AND {NORTH}),
    {CELLS_SQL.replace("FROM site", "FROM shown")},
    few AS (SELECT count(DISTINCT site_id) BETWEEN 1 AND 249 AS yes FROM shown)
    SELECT 'cluster' AS kind, CAST(NULL AS BIGINT) AS site_id, cell_x, cell_y, num_sites, lon, lat
    FROM cells, few WHERE NOT yes
    UNION ALL
    SELECT 'site', site_id, NULL, NULL, 1, lon, lat FROM shown, few WHERE yes""",
    "site",
)
def map_layer_window(spark, folder):
    return spatial.map_layer(views.site_points(spark, folder), window=LAYER_WINDOW)


# --- regions and labels -----------------------------------------------------------


@query(
    "sites_with_regions",
    "SELECT site_id, nation AS nations, region AS regions FROM site",
    "site",
)
def sites_with_regions(spark, folder):
    return lookup.regions_wide(views.site_region(spark, folder), ["nations", "regions"])


@query(
    "sample_sites_regions",
    """SELECT site_id, region_type, region FROM site_region
    WHERE site_id IN (SELECT site_id FROM sample WHERE material_sample_type = 'SMALL')""",
    "site_region sample",
)
def sample_sites_regions(spark, folder):
    samples = views.sample(spark, folder).where(F.col("material_sample_type") == "SMALL")
    return lookup.sites_of_samples(views.site_region(spark, folder), samples)


# Codes of line items: the procedure code of its line number; 6 and 7 are not in the
# vocabulary.
CODE_SQL = """coded AS (
  SELECT l_orderkey AS visit_id, l_linenumber AS line_no, l_partkey AS part_id,
    concat('http://v.test/used_procedure/', CASE l_linenumber WHEN 1 THEN '1-URGENT'
      WHEN 2 THEN '2-HIGH' WHEN 3 THEN '3-MEDIUM' WHEN 4 THEN '4-NOT SPECIFIED'
      WHEN 5 THEN '5-LOW' ELSE 'none' END) AS code FROM lineitem),
  names AS (SELECT uri, min(label) AS label FROM vocab WHERE facet = 'used_procedure' GROUP BY uri)"""


def _procedure_code(number):
    from .filters import PRIORITIES

    names = F.array(*[F.lit(p) for p in PRIORITIES])
    label = F.when(number <= 5, F.get(names, number - 1)).otherwise("none")
    return F.concat(F.lit(views.VOCAB_BASE + "used_procedure/"), label)


def _coded_lines(spark, folder):
    return views.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("visit_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
        _procedure_code(F.col("l_linenumber")).alias("code"),
    )


@query(
    "label_lookup_na",
    f"""WITH {CODE_SQL} SELECT visit_id, line_no, part_id, coalesce(label, 'N/A') AS label
    FROM coded LEFT JOIN names ON code = uri""",
    "vocab",
)
def label_lookup_na(spark, folder):
    vocab = views.vocab(spark, folder, "used_procedure")
    rows = lookup.add_label(_coded_lines(spark, folder), vocab, "used_procedure", "code", "label", "na")
    return rows.select("visit_id", "line_no", "part_id", "label")


@query(
    "label_lookup_keep",
    f"""WITH {CODE_SQL}, items AS (
      SELECT visit_id, line_no, part_id, coalesce(a.label, code) AS first,
        CASE WHEN line_no % 3 = 0 THEN NULL ELSE coalesce(b.label, 'http://v.test/x') END AS second
      FROM coded LEFT JOIN names a ON code = a.uri
      LEFT JOIN names b ON b.uri = CASE WHEN line_no % 2 = 0 THEN 'http://v.test/used_procedure/5-LOW'
        ELSE 'http://v.test/x' END)
    SELECT visit_id, line_no, part_id, CASE WHEN line_no = 7 THEN NULL
      WHEN second IS NULL THEN first ELSE concat('["', first, '","', second, '"]') END AS labels
    FROM items""",
    "vocab",
)
def label_lookup_keep(spark, folder):
    """Lists of one or two codes, with unknown and NULL items; line 7 has an empty list."""
    n = F.col("line_no")
    second = F.when(n % 3 == 0, F.lit(None)).when(
        n % 2 == 0, F.lit(views.VOCAB_BASE + "used_procedure/5-LOW")
    ).otherwise(views.VOCAB_BASE + "x")
    codes = F.when(n == 7, F.array().cast("array<string>")).otherwise(F.array("code", second))
    rows = _coded_lines(spark, folder).withColumn("codes", codes)
    vocab = views.vocab(spark, folder, "used_procedure")
    named = lookup.add_label_list(rows, vocab, "used_procedure", "codes", "names")
    return named.select("visit_id", "line_no", "part_id", lookup.unwrap(F.col("names")).alias("labels"))


# --- previews, pages, order -------------------------------------------------------


@query(
    "preview_by_type",
    """WITH ranked AS (SELECT feature_type, visit_id, line_no, part_id, supplier_id, obs_value,
        row_number() OVER (PARTITION BY feature_type
          ORDER BY visit_id, line_no, part_id, supplier_id) AS n
      FROM observation WHERE feature_type IN (
        SELECT DISTINCT feature_type FROM observation ORDER BY 1 LIMIT 2))
    SELECT * EXCLUDE (n) FROM ranked WHERE n <= 5""",
    "observation",
)
def preview_by_type(spark, folder):
    rows = views.observation(spark, folder, ["feature_type", *views.ORDER, "obs_value"])
    return paging.preview_by_type(rows, "feature_type", views.ORDER)


@query(
    "preview_samples",
    "SELECT sample_id, sample_name, scientific_name FROM sample ORDER BY sample_id LIMIT 10",
    "sample",
)
def preview_samples(spark, folder):
    rows = views.sample(spark, folder).select("sample_id", "sample_name", "scientific_name")
    return paging.preview(rows, ["sample_id"])


@query(
    "page_n",
    """SELECT visit_id, line_no, part_id, supplier_id, obs_value FROM observation
    ORDER BY visit_id, line_no, part_id, supplier_id LIMIT 50 OFFSET 100""",
    "observation",
)
def page_n(spark, folder):
    rows = views.observation(spark, folder, [*views.ORDER, "obs_value"])
    return paging.page(rows, views.ORDER, 3, 50)


@query(
    "ordered_dedupe",
    "SELECT p_name AS scientific_name, min(p_partkey) AS first_position FROM part GROUP BY p_name",
)
def ordered_dedupe(spark, folder):
    rows = views.sample(spark, folder)
    return paging.first_occurrence(rows, ["scientific_name"], F.col("sample_id"))


# --- union ------------------------------------------------------------------------


TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def _type_tables(spark, folder):
    """A table per sample type, in two shapes by turns."""
    rows = views.sample(spark, folder)
    tables = []
    for k, name in enumerate(TYPES):
        own = rows.where(F.col("material_sample_type") == name)
        if k % 2 == 0:
            tables.append(own.select("sample_id", "site_id", F.col("soil_subsite_id").alias("subsite")))
        else:
            tables.append(own.select("sample_id", F.col("scientific_name").alias("species"), "site_id"))
    return tables


TYPE_TABLES_SQL = " UNION ALL BY NAME ".join(
    "SELECT sample_id, "
    + ("site_id, soil_subsite_id AS subsite" if k % 2 == 0 else "scientific_name AS species, site_id")
    + f" FROM sample WHERE material_sample_type = '{name}'"
    for k, name in enumerate(TYPES)
)


@query("align_concat", TYPE_TABLES_SQL, "sample")
def align_concat(spark, folder):
    return align.stack_tables(_type_tables(spark, folder))


@query(
    "align_concat_na",
    f"""SELECT CAST(sample_id AS VARCHAR) AS sample_id, CAST(site_id AS VARCHAR) AS site_id,
      coalesce(CAST(subsite AS VARCHAR), 'N/A') AS subsite, coalesce(species, 'N/A') AS species
    FROM ({TYPE_TABLES_SQL})""",
    "sample",
)
def align_concat_na(spark, folder):
    return align.stack_tables(_type_tables(spark, folder), fill=True)


@query(
    "points",
    """WITH raw AS (
      SELECT site_id, CASE WHEN site_id % 5 = 0 THEN 'east' ELSE CAST(lon AS VARCHAR) END AS x,
        CASE WHEN site_id % 7 = 0 THEN NULL ELSE CAST(lat AS VARCHAR) END AS y FROM site)
    SELECT site_id, CASE WHEN TRY_CAST(x AS DOUBLE) IS NOT NULL AND TRY_CAST(y AS DOUBLE) IS NOT NULL
      THEN concat('POINT (', x, ' ', y, ')') END AS geometry FROM raw""",
    "site",
)
def points(spark, folder):
    """Coordinates as text; some are words, some are missing."""
    k = F.col("site_id")
    rows = views.site_points(spark, folder).select(
        "site_id",
        F.when(k % 5 == 0, "east").otherwise(F.col("lon").cast("string")).alias(align.LON),
        F.when(k % 7 != 0, F.col("lat").cast("string")).alias(align.LAT),
    )
    return align.add_point(rows).select("site_id", "geometry")
