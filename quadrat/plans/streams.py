"""Streaming queries; each runs to the end of its input and returns what it wrote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flatten, lookup
from ..session import cut_lineage, shared_dir
from ..sinks import writers
from ..sources import readers
from ..streaming import jobs
from . import views
from .registry import query


def stream_table(spark, folder, name):
    """A table as a stream. The glob form takes one file as well as a folder of files."""
    schema = views.table(spark, folder, name).schema
    path = f"{folder}/{name}.parque[t]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path)


@query("stream_lines", "SELECT site_id, lon, lat FROM site", "site")
def stream_lines(spark, folder):
    """Sites exported as GeoJSON lines, streamed back as lines, and parsed."""
    out = shared_dir(spark, "lines") + ".geojson"
    writers.write_table(views.site_points(spark, folder), out)
    lines = readers.clean_lines(spark.readStream.text(out))
    landed = jobs.run_to_table(lines, "stream-lines")
    parsed = F.parse_json("line")
    pick = lambda path, kind: F.variant_get(parsed, path, kind)
    return landed.select(
        pick("$.properties.site_id", "bigint").alias("site_id"),
        pick("$.geometry.coordinates[0]", "double").alias("lon"),
        pick("$.geometry.coordinates[1]", "double").alias("lat"),
    )


@query(
    "stream_chunks",
    """SELECT feature_type,
      concat('feature_type,obs_value,', CASE WHEN feature_type IN ('ECONOMY', 'LARGE') THEN 'ship_mode'
        WHEN feature_type = 'PROMO' THEN 'tax,line_no' ELSE 'tax' END) AS columns,
      count(*) AS n, sum(obs_value) AS value_sum,
      CASE WHEN feature_type = 'PROMO' THEN CAST(sum(line_no) AS BIGINT) END AS line_sum
    FROM observation GROUP BY feature_type""",
    "observation",
)
def stream_chunks(spark, folder):
    """Chunks of six types, in three shapes; each is read back with its own columns."""
    lines = stream_table(spark, folder, "lineitem")
    part = views.table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("feature_type")
    )
    kind = F.col("feature_type")
    shaped = kind.isin("ECONOMY", "LARGE")
    stream = lines.join(part, "l_partkey", "left").select(
        "feature_type",
        F.col("l_quantity").alias("obs_value"),
        F.when(shaped, "AIR").alias("ship_mode"),
        F.when(~shaped, F.col("l_tax")).alias("tax"),
        F.when(kind == "PROMO", F.col("l_linenumber")).alias("line_no"),
    )
    chunks = jobs.land_chunks(stream, "feature_type")
    # the feature types, a row each
    types = [r["feature_type"] for r in chunks.manifest().select("feature_type").distinct().collect()]
    parts = []
    for name in types:
        rows = chunks.of(name)
        line_sum = F.sum("line_no") if "line_no" in rows.columns else F.lit(None)
        parts.append(
            rows.groupBy("feature_type").agg(
                F.lit(",".join(rows.columns)).alias("columns"),
                F.count(F.lit(1)).alias("n"),
                F.sum("obs_value").alias("value_sum"),
                line_sum.cast("long").alias("line_sum"),
            )
        )
    return reduce(DataFrame.union, parts)


@query(
    "stream_resolve",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'N/A' ELSE upper(event_type) END AS label,
      json_extract_string(props, '$.k') AS k
    FROM events WHERE value > 10""",
)
def stream_resolve(spark, folder):
    """Filter, flatten and label on a stream, with the batch operators unchanged."""
    kinds = views.table(spark, folder, "events").select("event_type").distinct()
    uri = F.concat(F.lit(views.VOCAB_BASE), F.col("event_type"))
    vocab = kinds.where(F.col("event_type") != "error").select(
        F.lit("observed_property").alias("facet"),
        uri.alias("uri"),
        F.upper("event_type").alias("label"),
    )
    # written once, or every micro-batch would read the whole table again
    vocab = cut_lineage(vocab)
    stream = stream_table(spark, folder, "events").where(F.col("value") > 10)
    bagged = stream.select(
        "event_id", uri.alias("code"), flatten.flatten_bag("parse_json(props)").alias("attrs")
    )
    named = lookup.add_label(bagged, vocab, "observed_property", "code", "label", "na")
    return jobs.run_to_table(
        named.select("event_id", "label", F.col("attrs")["k"].alias("k")), "stream-resolve"
    )


@query(
    "stream_counts",
    """SELECT event_type, count(*) AS count
    FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY event_type""",
)
def stream_counts(spark, folder):
    """Every event is delivered twice, and the job is stopped and started again."""
    events = stream_table(spark, folder, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    base = shared_dir(spark, "stream-counts")
    where = {"out": f"{base}/data", "checkpoint": f"{base}/checkpoint"}
    how = {"key": ["event_id"], "time": "ts", "delay": "400 days"}
    jobs.facet_counts(events.union(events), "event_type", **how, **where)
    return jobs.facet_counts(events.union(events), "event_type", **how, **where)
