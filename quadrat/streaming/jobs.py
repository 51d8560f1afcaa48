"""Structured Streaming forms of the batch operators.

All selection, flatten and lookup steps are stateless and run on a stream as they are.
Each micro-batch is written to its own ``batch_id=`` folder with overwrite, so a batch
that is repeated after a failure replaces itself: the results are exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlotDataError
from ..session import cut_lineage, shared_dir


def _folders(spark, purpose: str, out: str | None, checkpoint: str | None) -> tuple[str, str]:
    if (out is None) != (checkpoint is None):
        raise PlotDataError("Give both folders, out and checkpoint, or neither.")
    base = shared_dir(spark, purpose)
    return out or f"{base}/data", checkpoint or f"{base}/checkpoint"


def _drain(stream: DataFrame, write, checkpoint: str, mode: str = "append") -> None:
    """Pass all that is available to ``write(batch, batch_id)``."""
    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_table(
    stream: DataFrame,
    purpose: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    schema: str | T.StructType | None = None,
    partition_by: list[str] | None = None,
    out: str | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    number: str | None = None,
) -> DataFrame:
    """Process all that is available and return what was written.

    With ``mode`` "update" a batch holds the results that changed in it; ``number`` names a
    column for the batch that wrote a row.

    ``transform`` is applied per micro-batch, which allows batch-only steps in it;
    ``schema`` is that of its result. Give ``out`` and ``checkpoint`` to go on from an
    earlier run; one without the other would number its batches from 0 again, and replace
    what is there.
    """
    spark = stream.sparkSession
    out, checkpoint = _folders(spark, purpose, out, checkpoint)
    schema = schema or stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        save(transform(batch) if transform else batch, batch_id)

    def save(rows: DataFrame, batch_id: int) -> None:
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{out}/batch_id={batch_id}")

    # the folder exists even when nothing arrives
    save(spark.createDataFrame([], schema), -1)
    _drain(stream, write, checkpoint, mode)
    written = spark.read.schema(schema).parquet(out)
    if number:
        written = written.withColumn(number, F.col("batch_id").cast("long"))
    return written.drop("batch_id") if number != "batch_id" else written


def deduplicated(stream: DataFrame, key: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay`` of each other (bounded state)."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def facet_counts(
    stream: DataFrame,
    facet: str,
    purpose: str = "facet-counts",
    key: list[str] | None = None,
    time: str | None = None,
    delay: str = "1 hour",
    **where,
) -> DataFrame:
    """Running count per facet value, held in streaming state.

    A batch adds its rows to the counts of the state and writes the counts that changed;
    no earlier input or output is read for it, and a restart goes on from the state. Rows
    with the same ``key`` that arrive within ``delay`` of the event ``time`` count once. The
    result is the last count written of each value.
    """
    if key:
        stream = deduplicated(stream, key, time, delay)
    changes = run_to_table(
        stream.groupBy(facet).agg(F.count(F.lit(1)).alias("count")),
        purpose,
        mode="update",
        number="_batch",
        **where,
    )
    return changes.groupBy(facet).agg(F.max_by("count", "_batch").alias("count"))


MANIFEST = "feature_type string, columns array<string>, rows long, path string"


@dataclass(frozen=True)
class Chunks:
    """Chunks of a stream: per batch and feature type a table with that type's own columns.

    The manifest lists what a finished batch wrote; it is written last, so a batch that died
    halfway shows nothing, and one that is repeated replaces itself.
    """

    spark: SparkSession
    out: str
    schema: T.StructType

    def manifest(self) -> DataFrame:
        """(feature_type, columns, rows, path, batch_id), a row per chunk."""
        listed = self.spark.read.schema(MANIFEST).json(f"{self.out}/manifest")
        return listed.where(F.col("path").isNotNull())

    def of(self, feature_type: str | None) -> DataFrame:
        """All rows of one type, with the columns that its chunks have."""
        mine = F.col("feature_type").eqNullSafe(F.lit(feature_type))
        return self._read(self.manifest().where(mine).collect())

    def together(self) -> DataFrame:
        """The rows of all types with all columns."""
        return self._read(self.manifest().collect(), self.schema.names)

    def _read(self, chunks: list, names: list[str] | None = None) -> DataFrame:
        have = {c for chunk in chunks for c in chunk["columns"]}
        kept = T.StructType([f for f in self.schema if f.name in (names or have)])
        if not chunks:
            return self.spark.createDataFrame([], kept)
        return self.spark.read.schema(kept).parquet(*[chunk["path"] for chunk in chunks])


def land_chunks(
    stream: DataFrame,
    feature_type: str,
    purpose: str = "chunks",
    out: str | None = None,
    checkpoint: str | None = None,
) -> Chunks:
    """Write one chunk per batch and feature type; a chunk has no column without a value."""
    spark = stream.sparkSession
    out, checkpoint = _folders(spark, purpose, out, checkpoint)
    names = stream.schema.names

    def save(rows: list[tuple], batch_id: int) -> None:
        table = spark.createDataFrame(rows, MANIFEST).coalesce(1)
        table.write.mode("overwrite").json(f"{out}/manifest/batch_id={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = cut_lineage(batch)
        # a row per feature type: which columns have a value
        filled = kept.groupBy(F.col(feature_type).alias("_type")).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names)]
        )
        rows = []
        for k, found in enumerate(sorted(filled.collect(), key=lambda r: (r["_type"] is not None, r["_type"] or ""))):
            own = [c for i, c in enumerate(names) if found[f"_{i}"]]
            path = f"{out}/batch_id={batch_id}/chunk={k}"
            mine = kept.where(F.col(feature_type).eqNullSafe(F.lit(found["_type"])))
            mine.select(*[f"`{c}`" for c in own]).write.mode("overwrite").parquet(path)
            rows.append((found["_type"], own, found["_rows"], path))
        save(rows, batch_id)

    save([], -1)
    _drain(stream, write, checkpoint)
    return Chunks(spark, out, stream.schema)


def chunks_by_type(stream: DataFrame, feature_type: str, purpose: str = "chunks", **where) -> DataFrame:
    """The chunks of all feature types, as one table."""
    return land_chunks(stream, feature_type, purpose, **where).together()
