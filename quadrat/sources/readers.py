"""Readers: feature collections, CSV per feature type, sample hits, vocabularies, lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlotDataError
from ..functions.text import strip
from ..model import FEATURE, FEATURE_COLLECTION, SPEC_SCHEMA, VOCAB_SCHEMA
from ..operators.align import stack_tables
from ..operators.lookup import broadcast_if_small
from ..session import cut_lineage, ship_with_tasks

ship_with_tasks(__name__)

HITS = "struct<hits: struct<hits: array<struct<_source: variant>>>>"
ATTRIBUTE_KINDS = {"site": "site", "site_visit": "site_visit", "site-visit": "site_visit"}


SUMS = "file string, split long, turn long, s0 long, s1 long"
TEXTS = "file string, split long, n long, seq long, whole boolean, text string"


def _marks(values: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, where each begins, and where quotes and closing braces lie.

    What a backslash escapes is no quote or brace. The last of an even run of backslashes
    escapes nothing, and no run goes over a text's end, as each text begins with a brace.
    """
    values = values.cast(pa.large_binary())
    _, bounds, buffer = values.buffers()
    bounds = np.frombuffer(bounds, np.int64)[values.offset : values.offset + len(values) + 1]
    data = buffer.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).to_pybytes()
    signs = np.frombuffer(data, np.uint8)
    quotes, closings = np.flatnonzero(signs == ord('"')), np.flatnonzero(signs == ord("}"))
    slashes = np.flatnonzero(signs == ord("\\"))
    if slashes.size:
        last = np.append(np.diff(slashes) != 1, True)
        length = np.diff(np.flatnonzero(last), prepend=-1)
        escaped = slashes[last][length % 2 == 1] + 1
        quotes, closings = np.setdiff1d(quotes, escaped, True), np.setdiff1d(closings, escaped, True)
    return data, bounds - bounds[0], quotes, closings


def _stretches(batches: Iterator[pa.RecordBatch], carried: int) -> Iterator[tuple]:
    """Each batch's stretches of one split: (batch, file, split, seq, head, carry).

    ``seq`` counts the stretches of a split, ``head`` tells the row before a file's first
    brace, ``carry`` holds ``carried`` running numbers of the split, from 0.
    """
    at, seq, carry = None, 0, [0] * carried
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode()
        splits = batch.column("split").to_numpy()
        change = (np.diff(files.indices.to_numpy()) != 0) | (np.diff(splits) != 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for first, end in zip(edges, edges[1:]):
            here = files[first].as_py(), int(splits[first])
            seq = seq + 1 if here == at else 0
            if here != at:
                at, carry = here, [0] * carried
            part = batch.slice(first, end - first)
            head = np.zeros(part.num_rows, bool)
            head[0] = seq == 0 and here[1] == 0
            yield part, *here, seq, head, carry


def _split_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a stretch of a split adds to quotes and depth, for either case."""
    for part, file, split, _, head, carry in _stretches(batches, 1):
        _, begin, quotes, closings = _marks(part.column("value"))
        outside = (carry[0] + np.searchsorted(quotes, begin[:-1])) % 2 == 0
        closed = int(((carry[0] + np.searchsorted(quotes, closings)) % 2 == 0).sum())
        carry[0] += len(quotes)
        sums = [len(quotes), int((outside & ~head).sum()) - closed, int((~outside & ~head).sum()) - len(closings) + closed]
        yield pa.RecordBatch.from_arrays(
            [pa.array([file]), pa.array([split], pa.int64()), *(pa.array([x], pa.int64()) for x in sums)],
            names=["file", "split", "turn", "s0", "s1"],
        )


def _split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a stretch, numbered within the split; ``whole`` where all of it lies in."""
    for part, file, split, seq, head, carry in _stretches(batches, 3):
        quoted, depth = part.column("quoted")[0].as_py() + carry[0], part.column("depth")[0].as_py() + carry[1]
        data, begin, quotes, closings = _marks(part.column("value"))
        opens = ((quoted + np.searchsorted(quotes, begin[:-1])) % 2 == 0) & ~head
        closings = closings[(quoted + np.searchsorted(quotes, closings)) % 2 == 0]
        before = depth + np.cumsum(opens) - opens - np.searchsorted(closings, begin[:-1])
        begins = np.flatnonzero(opens & (before == 1)).tolist()
        edges = [0, *begins, part.num_rows]
        rows = [
            (carry[2] + k, 0 < k < len(begins), data[begin[a] : begin[b]])
            for k, (a, b) in enumerate(zip(edges, edges[1:]))
            if a < b
        ]
        for k, more in enumerate((len(quotes), int(opens.sum()) - len(closings), len(begins))):
            carry[k] += more
        n = len(rows)
        columns = [[file] * n, [split] * n, [r[0] for r in rows], [seq] * n, [r[1] for r in rows]]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        texts = pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds)), texts],
            names=["file", "split", "n", "seq", "whole", "text"],
        )


def collection_texts(spark: SparkSession, path: str, scratch: str | None = None) -> DataFrame:
    """(file, number, text): the objects that lie directly in a collection's document.

    Files are read in splits, cut at opening braces, however large a document is. A cut's
    quotes and closing braces are counted for either case, that it starts inside a string or
    outside; the counts add up within a split, then over the splits of a file, and so tell
    each cut its depth. A cut that opens an object at depth one begins a text.

    Splits are read twice, from start to end and without a shuffle: for their sums, and for
    the texts. Only texts that do not lie within one batch of a split are put together
    afterwards. The texts are written once more, compressed, into ``scratch`` or a folder of
    their own; a later call with the same ``scratch`` replaces them.
    """
    cuts = spark.read.option("lineSep", "{").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.concat(F.lit("{"), F.col("value")).alias("value"),
    )
    zero = F.lit(0)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # a row per split
    splits = cuts.mapInArrow(_split_sums, SUMS).groupBy("file", "split").agg(
        (F.sum("turn") % 2).alias("turn"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1")
    )
    splits = splits.withColumn("quoted", F.coalesce(F.sum("turn").over(earlier), zero) % 2)
    change = F.when(F.col("quoted") == 0, F.col("s0")).otherwise(F.col("s1"))
    splits = splits.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(earlier), zero))
    starts = cut_lineage(splits.select("file", "split", "quoted", "depth"))
    # a broadcast join leaves the rows of a split in order
    placed = cuts.join(F.broadcast(starts), ["file", "split"], "left")
    missing = F.raise_error(F.lit("The files changed while they were read."))
    placed = placed.withColumn("quoted", F.coalesce("quoted", missing.cast("long")))
    texts = cut_lineage(placed.mapInArrow(_split_texts, TEXTS), "zstd", scratch)
    totals = texts.groupBy("file", "split").agg(F.max("n").alias("n"))
    totals = cut_lineage(totals.select("file", "split", F.coalesce(F.sum("n").over(earlier), zero).alias("ahead")))
    number = (F.col("ahead") + F.col("n")).alias("number")
    numbered = texts.join(broadcast_if_small(totals), ["file", "split"])
    numbered = numbered.select("file", number, "split", "seq", "whole", "text").where("number > 0")
    pieces = F.array_sort(F.collect_list(F.struct("split", "seq", "text")))
    rest = numbered.where(~F.col("whole")).groupBy("file", "number").agg(pieces.alias("pieces"))
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    return numbered.where("whole").select("file", "number", "text").union(
        rest.select("file", "number", joined.alias("text"))
    )


def collection_rows(spark: SparkSession, path: str, scratch: str | None = None) -> DataFrame:
    """(file, number, feature, bad): features, and the text of those that cannot be read."""
    kind = T.StructType([*FEATURE.fields, T.StructField("_bad", T.StringType())])
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    # out of an array, so that no filter on the features is put below, where it would parse them again
    parsed = F.explode(F.array(F.from_json("text", kind, how))).alias("f")
    read = collection_texts(spark, path, scratch).select("file", "number", parsed)
    fields = [F.col("f").getField(f.name).alias(f.name) for f in FEATURE.fields]
    rows = read.select("file", "number", F.struct(*fields).alias("feature"), F.col("f._bad").alias("bad"))
    # other objects of a document, such as its reference system, are no features
    return rows.where((F.col("feature.type") == "Feature") | F.col("bad").isNotNull())


def read_feature_collections(spark: SparkSession, path: str, scratch: str | None = None) -> DataFrame:
    """``feature`` rows of GeoJSON FeatureCollection files of any size.

    A document is read by as many tasks as its file has splits. Features that cannot be
    read are left out; ``collection_rows`` gives them as well. ``scratch``: see
    ``collection_texts``.
    """
    rows = collection_rows(spark, path, scratch)
    return rows.where(F.col("bad").isNull()).select("feature")


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """``feature`` rows of files with one GeoJSON feature per line (splittable)."""
    return parse_features(clean_lines(spark.read.text(path)), "line")


def parse_features(df: DataFrame, column: str) -> DataFrame:
    """Parse a text column of GeoJSON features; works on a stream as well.

    Text that is not JSON is an error. Blank lines must be gone before (``clean_lines``):
    a filter here would be evaluated below the parser together with whatever the text is
    made from.
    """
    return df.select(F.from_json(column, FEATURE, {"mode": "FAILFAST"}).alias("feature"))


def parse_collections(df: DataFrame, column: str) -> DataFrame:
    """Parse a text column of whole FeatureCollections into ``feature`` rows."""
    docs = df.select(F.from_json(column, FEATURE_COLLECTION, {"mode": "FAILFAST"}).alias("doc"))
    return docs.select(F.explode("doc.features").alias("feature"))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One CSV table with a header. Without a schema the types are inferred (two passes)."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_csv_by_type(
    spark: SparkSession, paths: dict[str, str], schemas: dict[str, str], fill: bool = False
) -> DataFrame:
    """CSV tables of several feature types, each with its own columns, as one table."""
    frames = [
        read_csv(spark, path, schemas[name]).withColumn("feature_type", F.lit(name))
        for name, path in paths.items()
    ]
    return stack_tables(frames, fill)


def parse_hits(df: DataFrame, column: str) -> DataFrame:
    """Text column of search answers -> one VARIANT ``source`` per sample document."""
    docs = df.select(F.from_json(column, HITS).alias("doc"))
    hits = docs.select(F.explode("doc.hits.hits").alias("hit"))
    source = F.col("hit._source")
    # anything but an object is passed over
    return hits.select(source.alias("source")).where(
        F.coalesce(F.schema_of_variant("source"), F.lit("VOID")).startswith("OBJECT")
    )


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Sample documents of JSON files, one search answer per line."""
    return parse_hits(spark.read.text(path), "value")


def source_columns(source: Column, fields: dict[str, str]) -> list[Column]:
    """Named fields of a sample document with their types."""
    return [F.try_variant_get(source, f"$.{n}", t).alias(n) for n, t in fields.items()]


def attribute_table(tables, kind: str, selected: DataFrame) -> DataFrame:
    """Site or site-visit attributes of the rows in ``selected``.

    A semi-join with the distinct keys: a hot site or visit is one row in it.
    """
    if kind not in ATTRIBUTE_KINDS:
        raise PlotDataError("Attribute tables exist for: site, site_visit.")
    table, key = {
        "site": (tables.site_attributes, "site_id"),
        "site_visit": (tables.site_visit_attributes, "visit_id"),
    }[ATTRIBUTE_KINDS[kind]]
    return table.join(selected.select(key).distinct(), key, "left_semi")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCAB_SCHEMA).parquet(path)


def build_vocab(rows: DataFrame, facets: dict[str, Column], uri_base: str) -> DataFrame:
    """Vocabulary (facet, uri, label) of the distinct values of several columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("facet"), c.cast("string").alias("label"))
            for f, c in facets.items()
        ]
    )
    return (
        rows.select(F.explode(pairs).alias("p"))
        .select("p.facet", "p.label")
        .where(F.col("label").isNotNull())
        .distinct()
        .select(
            "facet",
            F.concat(F.lit(uri_base), F.col("facet"), F.lit("/"), F.col("label")).alias("uri"),
            "label",
        )
    )


def read_selections(spark: SparkSession, path: str) -> DataFrame:
    """Saved selections: (spec_id, facet, op, value)."""
    return spark.read.schema(SPEC_SCHEMA).parquet(path)


def clean_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Stripped, non-empty lines of a text table or stream."""
    return df.select(strip(F.col(column)).alias("line")).where(F.length("line") > 0)
