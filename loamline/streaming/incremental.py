"""New rows of a growing folder, counted by season as they come.

The batch operators know no streams; these two functions let their inputs grow: a stream of scene rows is folded into counts by season with a watermark,
and any batch stage can be run on each batch of new rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import season_of


def arriving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def season_counts(stream: DataFrame, at: str = "ts", late: str = "1 day") -> DataFrame:
    """Rows by area, season and day of the stream; rows later than `late` are left out."""
    held = stream.withWatermark(at, late).withColumn("season", F.coalesce(season_of(F.col(at)), F.lit("none")))
    return held.groupBy(F.window(at, "1 day"), "area", "season").agg(F.count("*").alias("n"))


def on_each_batch(stream: DataFrame, stage: Callable[[DataFrame], None], checkpoint: str):
    """Starts a query that runs a batch stage on each batch of new rows, once for all that is there."""
    return stream.writeStream.foreachBatch(lambda df, _: stage(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
