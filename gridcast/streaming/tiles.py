"""The current tile of every site as a stateful streaming aggregate.

The last-arriving fresh message of each site is kept in the state store, one
row per site, by Spark's own streaming aggregation in update mode: a
micro-batch's messages are reduced before the shuffle, and only sites that the
batch changed leave it. Those go to a folder named by the batch, so a replay
rewrites its own; the table is the newest row per site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators import views
from gridcast.operators.selection import FRESH, Time
from gridcast.streaming.state import newest_run, run_dir

TILE = ["Time", "price_rf", "wind_speed", "temperature"]


def site_tiles(pred: DataFrame, as_of: Time, site_col: str = "site", arrival_col: str = "arrival", delay: str = "2 hours") -> DataFrame:
    """The last-arriving fresh message per site: ``site, Time, price_rf, wind_speed,
    temperature, arrival``, for a table or a stream. On a stream, messages older
    than the watermark (``delay`` behind the newest time seen) are not waited for."""
    rows = views.message_rows(pred.withColumn("_who", F.struct(site_col, arrival_col)), "_who", as_of, FRESH)
    rows = rows.select(F.col("_arrival")[site_col].alias("site"), *TILE, F.col("_arrival")[arrival_col].alias("arrival"))
    if rows.isStreaming:
        rows = rows.withWatermark("Time", delay)
    return rows.groupBy("site").agg(F.max_by(F.struct(*TILE, "arrival"), "arrival").alias("m")).select("site", "m.*")


def keep_tiles(path: str):
    """A ``foreachBatch`` function for ``site_tiles``: the sites that a batch changed, by batch."""

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{run_dir(changed.sparkSession, path)}/batch_id={batch_id}")

    return write


def run_tiles(tiles: DataFrame, path: str, checkpoint: str) -> None:
    """Run over what is available; with the same checkpoint it goes on where it stopped."""
    writer = tiles.writeStream.outputMode("update").foreachBatch(keep_tiles(path)).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """The newest tile of every site."""
    rows = spark.read.parquet(newest_run(spark, path))
    return rows.groupBy("site").agg(F.max_by(F.struct(*TILE, "arrival"), "batch_id").alias("m")).select("site", "m.*")
