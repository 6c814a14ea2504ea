"""Bounded serving state kept across micro-batches with ``foreachBatch``.

Each micro-batch merges its rows into the previous state and writes the new
state under its own batch id, so a replayed batch rewrites the same folder
(idempotent) and a restart picks up the last committed state. The state is
bounded (at most ``cap`` rows), whatever the stream's volume.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.operators import views
from gridcast.operators.selection import Time
from gridcast.operators.views import forecast_buffer_rows


def run_dir(spark: SparkSession, state_dir: str) -> str:
    """The state folder of the running streaming query: ``state_dir/run=<query id>``.
    The id lives in the query's checkpoint, so a restart goes on with its own
    state, and a query with a new checkpoint, whose batch ids start at 0 again,
    starts its own beside it. Outside a query it is ``state_dir`` itself."""
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{state_dir}/run={run}" if run else state_dir


def newest_run(spark: SparkSession, state_dir: str) -> str:
    """The run folder last written to, or ``state_dir`` when there are none."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    runs = [s for s in fs.listStatus(root) if s.getPath().getName().startswith("run=")] if fs.exists(root) else []
    if not runs:
        return state_dir
    return max(runs, key=lambda s: (s.getModificationTime(), s.getPath().getName())).getPath().toString()


def state_path(state_dir: str, batch_id: int) -> str:
    return f"{state_dir}/batch_id={batch_id}"


def committed_batches(spark: SparkSession, state_dir: str) -> list[int]:
    """Batch ids whose state write finished (``_SUCCESS`` present), one listing."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    ids = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)


def latest_state(spark: SparkSession, state_dir: str, batch_id: int, schema=None) -> DataFrame | None:
    """The newest committed state before ``batch_id``.

    A replayed batch ignores its own earlier write and anything after it, so
    it merges into exactly the state it saw the first time. With ``schema``
    the read skips schema discovery.
    """
    before = [b for b in committed_batches(spark, state_dir) if b < batch_id]
    if not before:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(state_path(state_dir, before[-1]))


def prune_states(spark: SparkSession, state_dir: str, batch_id: int) -> None:
    """Drop states no replay can need: those older than the newest one before
    ``batch_id`` (a replay of ``batch_id`` merges into that one). Keeps the
    state folder at two or three entries however long the stream runs."""
    before = [b for b in committed_batches(spark, state_dir) if b < batch_id]
    jvm = spark.sparkContext._jvm
    for b in before[:-1]:
        p = jvm.org.apache.hadoop.fs.Path(state_path(state_dir, b))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def final_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The state written by the newest committed micro-batch of the newest run."""
    state_dir = newest_run(spark, state_dir)
    ids = committed_batches(spark, state_dir)
    if not ids:
        raise ValueError(f"no committed state under {state_dir}")
    return spark.read.parquet(state_path(state_dir, ids[-1]))


def keep_last(state_dir: str, cap: int, arrival_col: str) -> Callable[[DataFrame, int], None]:
    """W1 as stream state: the last ``cap`` rows by arrival."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = run_dir(spark, state_dir)
        prev = latest_state(spark, own, batch_id, batch.schema)
        rows = batch if prev is None else prev.unionByName(batch)
        rows.orderBy(F.col(arrival_col).desc()).limit(cap).write.mode("overwrite").parquet(state_path(own, batch_id))
        prune_states(spark, own, batch_id)

    return merge


def keep_forecast_buffer(state_dir: str, arrival_col: str = "_arrival", slot_col: str = "_slot") -> Callable[[DataFrame, int], None]:
    """W2 as stream state: the forecast buffer and the running count of rows
    ever appended (the buffer length depends on it).

    The new buffer is the last k(n') rows of (old buffer + batch rows); it
    never needs older rows because k grows by at most the rows appended.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = run_dir(spark, state_dir)
        schema = T.StructType([*batch.schema.fields, T.StructField("_appended", T.LongType())])
        prev = latest_state(spark, own, batch_id, schema)
        # Two actions read the batch (its size, then its newest rows): keep it
        # so the source is read once per micro-batch.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            added = batch.count()
            seen = 0 if prev is None else prev.select(F.max("_appended")).first()[0] or 0
            total = seen + added
            rows = batch if prev is None else prev.drop("_appended").unionByName(batch)
            k = forecast_buffer_rows(total)
            out = rows.orderBy(F.col(arrival_col).desc(), F.col(slot_col).desc()).limit(k)
            out.withColumn("_appended", F.lit(total)).write.mode("overwrite").parquet(state_path(own, batch_id))
            prune_states(spark, own, batch_id)
        finally:
            batch.unpersist()

    return merge


def keep_views(state_dir: str, as_of: Time, arrival_col: str) -> Callable[[DataFrame, int], None]:
    """The consumer's three views over prediction messages as one state (C7, C8, C9):
    the last fresh message, the live buffer and the forecast buffer, each in its
    folder, from one decoded micro-batch. ``as_of`` is a time or an ingest stamp
    column of the messages. A manifest that names the batch's three folders is
    written last: readers follow it, so they never see views of two batches."""
    tiles = keep_last(f"{state_dir}/tiles", 1, "_arrival")
    live = keep_last(f"{state_dir}/live", views.LIVE_CAP, "_arrival")
    forecast = keep_forecast_buffer(f"{state_dir}/forecast")

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tiles(views.fresh_rows(batch, as_of, arrival_col), batch_id)
            live(views.today_rows(batch, as_of, arrival_col), batch_id)
            forecast(views.model_long(views.future_rows(batch, as_of, arrival_col)), batch_id)
            commit_views(batch.sparkSession, state_dir, batch_id)
        finally:
            batch.unpersist()

    return merge


VIEWS = ("tiles", "live", "forecast")


def commit_views(spark: SparkSession, state_dir: str, batch_id: int) -> None:
    """Write the manifest of a batch: the folders of its three states."""
    folders = [(name, state_path(run_dir(spark, f"{state_dir}/{name}"), batch_id)) for name in VIEWS]
    own = run_dir(spark, f"{state_dir}/commits")
    spark.createDataFrame(folders, "view string, folder string").coalesce(1).write.mode("overwrite").parquet(state_path(own, batch_id))
    prune_states(spark, own, batch_id)


def read_views(spark: SparkSession, state_dir: str) -> dict[str, DataFrame]:
    """The three views of the newest batch whose manifest is complete.

    The states a manifest names stay until two later batches are written, so a
    reader that began before a batch can end during it."""
    folders = {r.view: r.folder for r in final_state(spark, f"{state_dir}/commits").collect()}  # three rows
    state = {name: spark.read.parquet(folders[name]) for name in VIEWS}
    return {
        "current_conditions": views.conditions_tile(state["tiles"]),
        "live_series": views.live_view(state["live"]),
        "model_comparison": views.model_pivot(state["forecast"]),
    }


def run_stateful(stream: DataFrame, spark: SparkSession, state_dir: str, checkpoint: str, merge: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
