"""Incremental ingest: new files are merged into a table, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewatch.operators.records import upsert
from tidewatch.sources.io import drop_tables


def newest_by_key(rows: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """One row of each key: the one of greatest ``newest`` (null is least), then the greatest as JSON, whatever their order.

    Rows with a null key match nothing, and all stay.
    """
    text = F.to_json(F.struct("*"))
    order = F.struct(newest, text) if newest else text
    named = reduce(and_, [F.col(k).isNotNull() for k in keys])
    chosen = rows.where(named).groupBy(*keys).agg(F.max_by(F.struct("*"), order).alias("_row")).select("_row.*")
    return chosen.unionByName(rows.where(~named))


def merge_new_files(
    spark: SparkSession, source: str, schema: StructType, target: str, keys: Sequence[str], checkpoint: str, newest: str | None = None
) -> StreamingQuery:
    """Read what is new below ``source`` and upsert it; each batch writes a version beside the last.

    Of rows that share their keys in a batch one stays (:func:`newest_by_key`).
    The version before the last is kept, as a batch may be run again; older ones go.
    """

    def merge(batch: DataFrame, number: int) -> None:
        rows = newest_by_key(batch, keys, newest)
        if number:
            rows = upsert(spark.read.parquet(f"{target}/version={number - 1}"), rows, keys)
        rows.write.mode("overwrite").parquet(f"{target}/version={number}")
        if number > 1:
            drop_tables(spark, [f"{target}/version={number - 2}"])

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Counts by event type and window, closed once the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
