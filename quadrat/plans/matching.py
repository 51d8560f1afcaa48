"""Queries that resolve, normalise, parse and classify text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, geometry, similarity, text
from ..model import REGION_TYPES
from ..operators import resolve
from ..session import spread
from . import views
from .registry import query

# --- similarity in SQL ------------------------------------------------------------


def ratio_sql(a: str, b: str) -> str:
    """200 * LCS / (len a + len b) for texts of up to 60 characters, bit by bit."""
    mask = (
        f"list_transform(range(1, length({b}) + 1), lambda j: CAST(coalesce(list_sum(list_transform("
        f"range(0, length({a})), lambda i: CASE WHEN {a}[i + 1] = {b}[j] THEN CAST(1 AS BIGINT) << i "
        f"ELSE CAST(0 AS BIGINT) END)), 0) AS BIGINT))"
    )
    full = f"((CAST(1 AS BIGINT) << length({a})) - 1)"
    row = (
        f"list_reduce(list_prepend({full}, {mask}), lambda s, m: "
        f"((s + (s & m)) | (s - (s & m))) & {full})"
    )
    lcs = f"(length({a}) - bit_count({row}))"
    return f"(200.0::DOUBLE * {lcs} / (length({a}) + length({b})))"


@query(
    "fuzzy_ratio",
    f"""WITH pairs AS (SELECT DISTINCT p_name AS a,
        concat(split_part(p_name, ' ', 2), ' ', lower(p_type)) AS b FROM part)
    SELECT a, b, round({ratio_sql("a", "b")}, 6) AS score FROM pairs""",
)
def fuzzy_ratio(spark, folder):
    name = F.col("p_name")
    other = F.concat(F.split(name, " ")[1], F.lit(" "), F.lower("p_type"))
    pairs = views.table(spark, folder, "part").select(name.alias("a"), other.alias("b")).distinct()
    return pairs.withColumn("score", F.round(similarity.ratio_column("a", "b"), 6))


def weighted_ratio_ctes(pairs: str) -> str:
    """CTEs from distinct non-empty ``pairs`` (a, b) to ``weighted`` (a, b, score)."""
    words = "list_sort(list_filter(string_split({0}, ' '), lambda w: w <> ''))"
    only = "array_to_string(list_sort(list_distinct(list_filter({0}, lambda w: {1} list_contains({2}, w)))), ' ')"
    return f"""pairs AS ({pairs}),
    split AS (SELECT a, b, {words.format("a")} AS wa, {words.format("b")} AS wb FROM pairs),
    parts AS (SELECT a, b, array_to_string(wa, ' ') AS all_a, array_to_string(wb, ' ') AS all_b,
      {only.format("wa", "", "wb")} AS shared, {only.format("wa", "NOT", "wb")} AS only_a,
      {only.format("wb", "NOT", "wa")} AS only_b FROM split),
    texts AS (SELECT a AS x, b AS y FROM parts UNION SELECT all_a, all_b FROM parts
      UNION SELECT only_a, only_b FROM parts WHERE only_a <> '' AND only_b <> ''),
    plain AS (SELECT x, y, {ratio_sql("x", "y")} AS r FROM texts),
    sides AS (SELECT x, y, x AS part, y AS whole FROM texts WHERE length(x) <= length(y)
      UNION ALL SELECT x, y, y, x FROM texts WHERE length(y) <= length(x)),
    windows AS (SELECT x, y, part, whole[greatest(0, e - length(part)) + 1:e] AS w
      FROM (SELECT *, unnest(range(1, length(whole) + length(part))) AS e FROM sides)),
    cut AS (SELECT DISTINCT part, w FROM windows),
    fit AS (SELECT part, w, {ratio_sql("part", "w")} AS r FROM cut),
    best AS (SELECT x, y, max(r) AS r FROM windows JOIN fit USING (part, w) GROUP BY x, y),
    joined AS (SELECT p.*, greatest(length(a), length(b)) / least(length(a), length(b)) AS stretch,
        r1.r AS r, r2.r AS r_all, coalesce(r3.r, 0.0) AS r_only, w1.r AS w, w2.r AS w_all,
        coalesce(w3.r, 0.0) AS w_only, length(shared) AS head, length(shared) + 1 + length(only_a) AS la,
        length(shared) + 1 + length(only_b) AS lb
      FROM parts p JOIN plain r1 ON a = r1.x AND b = r1.y JOIN plain r2 ON all_a = r2.x AND all_b = r2.y
      LEFT JOIN plain r3 ON only_a = r3.x AND only_b = r3.y
      JOIN best w1 ON a = w1.x AND b = w1.y JOIN best w2 ON all_a = w2.x AND all_b = w2.y
      LEFT JOIN best w3 ON only_a = w3.x AND only_b = w3.y),
    token AS (SELECT *, CASE
        WHEN shared <> '' AND (only_a = '' OR only_b = '') THEN 100.0
        WHEN shared = '' THEN greatest(r_all, r_only)
        ELSE greatest(r_all, 200.0 * (head + 1 + round(r_only * (length(only_a) + length(only_b)) / 200)) / (la + lb),
          200.0 * head / (head + la), 200.0 * head / (head + lb)) END AS by_token,
      CASE WHEN shared <> '' THEN 100.0 ELSE greatest(w_all, w_only) END AS w_token,
      CASE WHEN stretch <= 8.0 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS weight FROM joined),
    weighted AS (SELECT a, b, CASE WHEN stretch < 1.5 THEN greatest(r, 0.95::DOUBLE * by_token)
      ELSE greatest(r, weight * w, weight * 0.95::DOUBLE * w_token) END AS score FROM token)"""


@query(
    "fuzzy_wratio",
    f"""WITH {weighted_ratio_ctes("""SELECT DISTINCT p_name AS a,
        concat(split_part(p_name, ' ', 2), ' ', lower(p_type)) AS b FROM part""")}
    SELECT a, b, round(score, 6) AS score FROM weighted""",
)
def fuzzy_wratio(spark, folder):
    name = F.col("p_name")
    other = F.concat(F.split(name, " ")[1], F.lit(" "), F.lower("p_type"))
    pairs = views.table(spark, folder, "part").select(name.alias("a"), other.alias("b")).distinct()
    score = similarity.weighted_ratio_column("a", "b")
    return pairs.withColumn("score", F.round(score, 6))


# --- resolver ---------------------------------------------------------------------


def _candidates(spark, folder, change):
    """(facet, value) of three facets, each value passed through ``change(value, key)``."""
    part = views.table(spark, folder, "part")
    nation = views.table(spark, folder, "nation")
    rows = [
        part.select(F.lit("speciesname").alias("facet"), F.col("p_name").alias("v"), F.col("p_partkey").alias("k")),
        part.select(F.lit("feature_type"), F.col("p_type"), F.col("p_partkey")),
        nation.select(F.lit("region"), F.col("n_name"), F.col("n_nationkey").cast("long")),
    ]
    stacked = rows[0].union(rows[1]).union(rows[2])
    return stacked.select("facet", change(F.col("facet"), F.col("v"), F.col("k")).alias("value"))


RAW_SQL = """raw AS (
  SELECT 'speciesname' AS facet, p_name AS v, p_partkey AS k FROM part
  UNION ALL SELECT 'feature_type', p_type, p_partkey FROM part
  UNION ALL SELECT 'region', n_name, n_nationkey FROM nation)"""


@query(
    "resolve_exact",
    f"""WITH {RAW_SQL}, asked AS (SELECT DISTINCT facet, v,
        CASE WHEN k % 2 = 0 THEN concat('http://v.test/', facet, '/', v) ELSE v END AS value FROM raw)
    SELECT facet, value, concat('http://v.test/', facet, '/', v) AS uri, v AS label,
      CASE WHEN value = v THEN 'label' ELSE 'uri' END AS outcome FROM asked""",
)
def resolve_exact(spark, folder):
    """Odd rows give a padded label, even rows an identifier: all are settled exactly."""

    def change(facet, v, k):
        uri = F.concat(F.lit(views.VOCAB_BASE), facet, F.lit("/"), v)
        return F.when(k % 2 == 0, uri).otherwise(F.concat(F.lit("  "), v, F.lit(" ")))

    found = resolve.resolve(
        _candidates(spark, folder, change),
        views.vocab(spark, folder, "speciesname", "feature_type", "region"),
    )
    return found.select("facet", "value", "uri", "label", "outcome")


@query(
    "resolve_fuzzy",
    f"""WITH {RAW_SQL}, asked AS (SELECT DISTINCT facet,
        concat(v[1], substr(v, 3)) AS value FROM raw),
    labels AS (SELECT facet, label, min(uri) AS uri FROM vocab GROUP BY facet, label),
    scored AS (SELECT a.facet, a.value, l.label, l.uri, {ratio_sql("a.value", "l.label")} AS score
      FROM asked a JOIN labels l ON a.facet = l.facet),
    best AS (SELECT *, row_number() OVER (PARTITION BY facet, value ORDER BY score DESC, label) AS n
      FROM scored WHERE score >= 75)
    SELECT a.facet, a.value, b.uri, b.label, round(b.score, 6) AS score,
      CASE WHEN b.uri IS NULL THEN 'unmatched' ELSE 'fuzzy' END AS outcome
    FROM asked a LEFT JOIN best b ON a.facet = b.facet AND a.value = b.value AND b.n = 1""",
    "vocab",
)
def resolve_fuzzy(spark, folder):
    """Every label with its second character missing, all facets in one job."""

    def change(facet, v, k):
        return F.concat(F.substring(v, 1, 1), F.substr(v, F.lit(3)))

    found = resolve.resolve(
        _candidates(spark, folder, change),
        views.vocab(spark, folder, "speciesname", "feature_type", "region"),
    )
    return found.withColumn("score", F.round("score", 6))


@query(
    "resolve_single",
    f"""WITH {RAW_SQL}, asked AS (SELECT DISTINCT facet, CASE WHEN k % 2 = 0
        THEN concat('http://v.tst/', facet, '/', v) ELSE concat(v[1], substr(v, 3)) END AS value FROM raw),
    targets AS (SELECT facet, label AS t, label, min(uri) AS uri, FALSE AS address FROM vocab GROUP BY ALL
      UNION ALL SELECT facet, uri, label, uri, TRUE FROM vocab),
    scored AS (SELECT a.facet, a.value, t.t, t.label, t.uri, {ratio_sql("a.value", "t.t")} AS score
      FROM asked a JOIN targets t ON a.facet = t.facet AND t.address = starts_with(a.value, 'http')),
    best AS (SELECT *, row_number() OVER (PARTITION BY facet, value ORDER BY score DESC, t) AS n
      FROM scored WHERE score >= 80)
    SELECT a.facet, a.value, b.uri, b.label, round(b.score, 6) AS score,
      CASE WHEN b.uri IS NULL THEN 'unmatched' ELSE 'fuzzy' END AS outcome
    FROM asked a LEFT JOIN best b ON a.facet = b.facet AND a.value = b.value AND b.n = 1""",
    "vocab",
)
def resolve_single(spark, folder):
    """Even rows give an address with a letter missing, odd rows a name with one missing."""

    def change(facet, v, k):
        address = F.concat(F.lit("http://v.tst/"), facet, F.lit("/"), v)
        name = F.concat(F.substring(v, 1, 1), F.substr(v, F.lit(3)))
        return F.when(k % 2 == 0, address).otherwise(name)

    found = resolve.resolve_single(
        _candidates(spark, folder, change),
        views.vocab(spark, folder, "speciesname", "feature_type", "region"),
    )
    return found.withColumn("score", F.round("score", 6))


REGION_TEXTS = (
    "Bioregions",
    "IBRA7 bioregions",
    "ibra7_subregions",
    "NRM regions",
    "local government",
    "states and teritories",
    "https://linked.data.gov.au/dataset/ibra7",
    "https://linked.data.gov.au/dataset/wwf201",
    "http://elsewhere.test/",
    "nonsense",
)


def _region_texts_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(REGION_TEXTS))
    return f"CASE event_id % {len(REGION_TEXTS)} {cases} END"


@query(
    "resolve_region_type",
    f"""WITH asked AS (SELECT DISTINCT concat({_region_texts_sql()},
        CASE WHEN event_type = 'click' THEN ' ' ELSE '' END) AS raw FROM events),
    known AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{n}', '{u}')" for i, (n, u) in enumerate(REGION_TYPES.items()))}) t(pos, name, url)),
    side AS (SELECT raw, raw LIKE 'http%://%' AS is_url,
        lower(replace(trim(regexp_replace(raw, '\\bibra7[-_ ]*', '', 'gi')), ' ', '-')) AS clean FROM asked),
    pair AS (SELECT raw, name, pos, is_url, clean, CASE WHEN is_url THEN raw ELSE clean END AS a,
        CASE WHEN is_url THEN url ELSE name END AS b FROM side, known),
    scored AS (SELECT *, {ratio_sql("a", "b")} AS s FROM pair),
    best AS (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY s DESC, pos) AS n FROM scored)
    SELECT raw, CASE WHEN s >= CASE WHEN NOT is_url AND clean LIKE 'l%' THEN 20 ELSE 90 END
        THEN name END AS region_type, round(s, 6) AS score FROM best WHERE n = 1""",
)
def resolve_region_type(spark, folder):
    texts = F.array(*[F.lit(t) for t in REGION_TEXTS])
    raw = F.concat(
        F.get(texts, (F.col("event_id") % len(REGION_TEXTS)).cast("int")),
        F.when(F.col("event_type") == "click", " ").otherwise(""),
    )
    rows = views.table(spark, folder, "events").select(raw.alias("raw"))
    return resolve.resolve_region_types(rows, "raw").withColumn("score", F.round("score", 6))


# --- scalars ----------------------------------------------------------------------


@query(
    "parse_dates",
    """WITH made AS (SELECT o_orderkey AS visit_id, o_orderdate AS d, o_orderkey % 10 AS form,
      CASE WHEN day(o_orderdate) % 10 = 1 AND day(o_orderdate) <> 11 THEN 'st'
        WHEN day(o_orderdate) % 10 = 2 AND day(o_orderdate) <> 12 THEN 'nd'
        WHEN day(o_orderdate) % 10 = 3 AND day(o_orderdate) <> 13 THEN 'rd' ELSE 'th' END AS suffix
      FROM orders)
    SELECT visit_id, CASE form WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y')
      WHEN 2 THEN strftime(d, '%d-%m-%Y') WHEN 3 THEN concat(day(d), suffix, ' ', strftime(d, '%B %Y'))
      WHEN 4 THEN strftime(d, '%b %-d %Y') WHEN 5 THEN strftime(d, '%-d %b %Y')
      WHEN 6 THEN strftime(d, '%Y-%m-%dT10:30:00') WHEN 7 THEN strftime(d, '%-d.%-m.%Y')
      WHEN 8 THEN concat('13/', strftime(d, '%d/%Y')) ELSE 'not a date' END AS raw,
      CASE WHEN form < 8 THEN CAST(d AS DATE)
        WHEN form = 8 AND day(d) <= 12 THEN make_date(year(d), day(d), 13) END AS day
    FROM made""",
)
def parse_dates(spark, folder):
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    day = F.dayofmonth(d)
    suffix = (
        F.when((day % 10 == 1) & (day != 11), "st")
        .when((day % 10 == 2) & (day != 12), "nd")
        .when((day % 10 == 3) & (day != 13), "rd")
        .otherwise("th")
    )
    show = lambda layout: F.date_format(d.cast("timestamp"), layout)
    forms = [
        show("yyyy-MM-dd"),
        show("dd/MM/yyyy"),
        show("dd-MM-yyyy"),
        F.concat(day.cast("string"), suffix, F.lit(" "), show("MMMM yyyy")),
        show("MMM d yyyy"),
        show("d MMM yyyy"),
        F.concat(show("yyyy-MM-dd"), F.lit("T10:30:00")),
        show("d.M.yyyy"),
        F.concat(F.lit("13/"), show("dd/yyyy")),
        F.lit("not a date"),
    ]
    raw = F.get(F.array(*forms), (key % 10).cast("int"))
    orders = spread(views.table(spark, folder, "orders").select("o_orderkey", "o_orderdate"))
    rows = orders.select(key.alias("visit_id"), raw.alias("raw"))
    return rows.withColumn("day", dates.parse_date(F.col("raw")))


@query(
    "normalise_labels",
    """SELECT p_partkey AS sample_id, replace(lower(p_name), ' ', '_') AS facet_key,
      replace(lower(p_name), ' ', '-') AS region_key FROM part""",
)
def normalise_labels(spark, folder):
    name = F.initcap("p_name")
    prefix = F.when(F.col("p_partkey") % 2 == 0, "IBRA7 ").otherwise("ibra7-_")
    return views.table(spark, folder, "part").select(
        F.col("p_partkey").alias("sample_id"),
        text.facet_key(F.concat(F.lit(" "), name, F.lit("\t"))).alias("facet_key"),
        text.region_type_key(F.concat(prefix, name)).alias("region_key"),
    )


@query(
    "uri_tail",
    """SELECT page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') AS tail,
      concat('site', page_id) AS site_label FROM pages""",
)
def uri_tail(spark, folder):
    site = F.concat(F.lit("http://s.test/site"), F.col("page_id").cast("string"), F.lit("//"))
    return views.table(spark, folder, "pages").select(
        "page_id", text.uri_tail(F.col("url")).alias("tail"), text.uri_tail(site).alias("site_label")
    )


# Texts of all kinds, with the customer's key in the place of '#'; each with its kind.
SHAPE_TEXTS = (
    ("POLYGON((0 0, # 0, # 1, 0 0))", "wkt"),
    ("  srid=4326; point (# 2) ", "wkt"),
    ("POLYGON((0 0, # 1)", "error"),
    ("CIRCLE(# 1)", "error"),
    ('{"type":"Point","coordinates":[#,2]}', "geojson"),
    ('{"type":"Point","coordinate":[#,2]}', "error"),
    ('{"type":"GeometryCollection","geometries":[],"n":#}', "geojson"),
    ('{"type":"Feature","geometry":null,"id":#}', "geojson"),
    ('{"type":"Feature","geometry":"none","id":#}', "error"),
    ('{"type":"FeatureCollection","features":[],"id":#}', "geojson"),
    ('{"type":"FeatureCollection","features":{},"id":#}', "error"),
    ("[#, -28.0, 153.0, -27.0]", "bbox"),
    ('["#", 1, 2, "3"]', "bbox"),
    ("[#, 1, 2]", "error"),
    ('[#, 1, 2, "x"]', "error"),
    ("#", "error"),
)


def _shape_rows(spark, folder):
    k = F.col("c_custkey")
    forms = F.array(*[F.lit(t) for t, _ in SHAPE_TEXTS])
    raw = F.replace(
        F.get(forms, (k % len(SHAPE_TEXTS)).cast("int")), F.lit("#"), k.cast("string")
    )
    return views.table(spark, folder, "customer").select(k.alias("site_id"), raw.alias("raw"))


def _shape_sql(result) -> str:
    cases = " ".join(f"WHEN {i} THEN {result(kind)}" for i, (_, kind) in enumerate(SHAPE_TEXTS))
    return f"CASE c_custkey % {len(SHAPE_TEXTS)} {cases} END"


@query(
    "wkt_valid",
    f"SELECT c_custkey AS site_id, {_shape_sql(lambda k: str(k == 'wkt'))} AS valid FROM customer",
)
def wkt_valid(spark, folder):
    return _shape_rows(spark, folder).select("site_id", geometry.is_wkt(F.col("raw")).alias("valid"))


@query(
    "geojson_valid",
    f"SELECT c_custkey AS site_id, {_shape_sql(lambda k: str(k == 'geojson'))} AS valid FROM customer",
)
def geojson_valid(spark, folder):
    return _shape_rows(spark, folder).select(
        "site_id", geometry.is_geojson(F.col("raw")).alias("valid")
    )


@query(
    "geom_kind",
    f"SELECT c_custkey AS site_id, {_shape_sql(lambda k: repr(k))} AS kind FROM customer",
)
def geom_kind(spark, folder):
    return _shape_rows(spark, folder).select(
        "site_id", geometry.geometry_kind(F.col("raw")).alias("kind")
    )
