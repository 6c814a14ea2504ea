"""Registered queries that fit models or run streams (rows-only checks for
model outputs; stream results are compared with the batch oracle)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.messages import decode
from gridcast.jobs import score_job, serve_job
from gridcast.models.scoring import load_model, reading_features, scorable, score, score_dual
from gridcast.models.training import fit_both, fit_ready, save_model, training_set
from gridcast.operators import views
from gridcast.plans import standins as S
from gridcast.plans.catalog import AS_OF, _events, prices_hourly, weather_15min
from gridcast.schemas import READING
from gridcast.session import fresh_dir, run_concurrently
from gridcast.sources.messages import publish
from gridcast.streaming import state
from gridcast.streaming.progress import read_progress
from gridcast.streaming.runner import run_available, stage_files, stream_to_table
from gridcast.streaming.tiles import TILE, read_tiles, run_tiles, site_tiles

STAGED_FILES = 5  # micro-batches the staged streams replay in
DISTINCT_DELAY = "60 days"  # repeats of a pair within this time are one

_MODEL_DIRS: dict[tuple[str, str], str] = {}
_MODELS: dict[tuple[str, str], tuple[PipelineModel, PipelineModel]] = {}


def fitted_models(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, PipelineModel]:
    """Fit both learners once per session and data set, and save them.

    The batch model queries score with the fitted models in memory; the
    scoring stream (``stream_score``, through ``jobs.score_job``) loads them
    back from the saved folder (S7), as a separate scoring job would.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        rf, gbt = fit_both(training_set(weather_15min(spark, sf_dir), prices_hourly(spark, sf_dir)))
        base = fresh_dir(spark, "models")
        run_concurrently(lambda: save_model(rf, f"{base}/rf"), lambda: save_model(gbt, f"{base}/gbt"))
        _MODEL_DIRS[key] = base
        _MODELS[key] = (rf, gbt)
    return _MODELS[key]


def q_fit_models(spark, sf_dir):
    """Both fits and saves (the scoring queries after it find them done)."""
    rf, gbt = fitted_models(spark, sf_dir)
    rows = fit_ready(training_set(weather_15min(spark, sf_dir), prices_hourly(spark, sf_dir))).count()
    sizes = [(name, model.stages[-1].getNumTrees, rows) for name, model in (("rf", rf), ("gbt", gbt))]
    return spark.createDataFrame(sizes, "model string, trees long, train_rows long")


def q_dual_score_checks(spark, sf_dir):
    """Every reading with what must hold of its two prices: the forest's
    lies between the smallest and largest label, and the saved models, loaded
    again, give the same."""
    rf, gbt = fitted_models(spark, sf_dir)
    base = _MODEL_DIRS[(spark.sparkContext.applicationId, sf_dir)]
    again = [load_model(f"{base}/{kind}") for kind in ("rf", "gbt")]
    labels = prices_hourly(spark, sf_dir).agg(F.min("label"), F.max("label")).first()
    out = score_dual(_scorable_readings(spark, sf_dir), rf, gbt)
    out = score(again[1], score(again[0], out, "rf_again"), "gbt_again")
    return out.select(
        "arrival", "time", "temperature", "wind_speed",
        F.col("price_rf").between(labels[0] - 1e-9, labels[1] + 1e-9).alias("rf_in_range"),
        (F.col("price_rf") == F.col("rf_again")).alias("rf_reloads"),
        (F.col("price_gbt") == F.col("gbt_again")).alias("gbt_reloads"),
    )


def _scorable_readings(spark, sf_dir) -> DataFrame:
    good, _quarantine = scorable(S.readings(_events(spark, sf_dir)))
    return good


def q_rf_predict(spark, sf_dir):
    rf, _ = fitted_models(spark, sf_dir)
    out = score(rf, _scorable_readings(spark, sf_dir), "price_rf")
    return out.select("arrival", "time", "temperature", "wind_speed", "price_rf")


def q_gbt_predict(spark, sf_dir):
    _, gbt = fitted_models(spark, sf_dir)
    out = score(gbt, _scorable_readings(spark, sf_dir), "price_gbt")
    return out.select("arrival", "time", "temperature", "wind_speed", "price_gbt")


def q_dual_score(spark, sf_dir):
    rf, gbt = fitted_models(spark, sf_dir)
    out = score_dual(_scorable_readings(spark, sf_dir), rf, gbt)
    return out.select("arrival", "time", "temperature", "wind_speed", "price_rf", "price_gbt")


# --- streams -----------------------------------------------------------------

def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream (one file: one micro-batch)."""
    schema = _events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


_STAGED: dict[tuple[str, str], str] = {}
_INBOX: dict[tuple[str, str], str] = {}


def staged_events_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The events table replayed in ``STAGED_FILES`` micro-batches, in arrival order.

    The staged copy is an immutable input, written once per session and data
    set and shared by every replayed stream (each has its own checkpoint).
    """
    ev = _events(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        _STAGED[key] = stage_files(ev, spark, "events", STAGED_FILES, "event_id")
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(_STAGED[key])


def q_stream_features(spark, sf_dir):
    feats = reading_features(S.readings(events_stream(spark, sf_dir)))
    return stream_to_table(feats.select("arrival", "time", "ts", "hour_of_day", "day_of_week"), spark, "features")


def q_stream_distinct(spark, sf_dir):
    """A pair is kept as state for as long as the watermark allows, not for ever."""
    pairs = events_stream(spark, sf_dir).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    once = pairs.withWatermark("ts", DISTINCT_DELAY).dropDuplicatesWithinWatermark(["user_id", "event_type"])
    return stream_to_table(once.select("user_id", "event_type"), spark, "distinct")


def q_stream_union(spark, sf_dir):
    """Forecast and live readings share one stream, tagged by origin."""
    ev = events_stream(spark, sf_dir)
    forecast = S.readings(ev.where(F.col("event_type") == S.FORECAST_EVENT)).withColumn("source", F.lit(S.FORECAST_SOURCE))
    live = S.readings(ev.where(F.col("event_type") != S.FORECAST_EVENT)).withColumn("source", F.lit(S.LIVE_SOURCE))
    return stream_to_table(forecast.unionByName(live), spark, "union")


def _run_state(spark, stream, merge_factory, name) -> DataFrame:
    base = fresh_dir(spark, f"state-{name}")
    state_dir = f"{base}/state"
    merge = merge_factory(state_dir)
    state.run_stateful(stream, spark, state_dir, f"{base}/checkpoint", merge)
    return state.final_state(spark, state_dir)


def q_stream_last_100(spark, sf_dir):
    """The live buffer kept across micro-batches."""
    pred = S.predictions(staged_events_stream(spark, sf_dir, "last100")).drop("event_ts")
    return _run_state(spark, pred, lambda d: state.keep_last(d, views.LIVE_CAP, "arrival"), "last100")


def q_stream_forecast_buffer(spark, sf_dir):
    """The forecast buffer and its running count across micro-batches."""
    long = views.model_long(views.future_rows(S.predictions(staged_events_stream(spark, sf_dir, "forecast")), AS_OF))
    buf = _run_state(spark, long, lambda d: state.keep_forecast_buffer(d), "forecast")
    return buf.select("Time", "Model", "Price", F.col("_arrival").alias("arrival"))


def q_stream_current_conditions(spark, sf_dir):
    """The tiles kept across micro-batches (the last fresh message, one row of state)."""
    rows = views.fresh_rows(S.predictions(staged_events_stream(spark, sf_dir, "tiles")), AS_OF)
    last = _run_state(spark, rows, lambda d: state.keep_last(d, 1, "_arrival"), "tiles")
    return views.conditions_tile(last)


def q_stream_live_series(spark, sf_dir):
    """The live buffer (last 100 in-window rows) kept across micro-batches, then the chart rows."""
    rows = views.today_rows(S.predictions(staged_events_stream(spark, sf_dir, "live")), AS_OF)
    last = _run_state(spark, rows, lambda d: state.keep_last(d, views.LIVE_CAP, "_arrival"), "live")
    return views.live_view(last)


def q_stream_model_comparison(spark, sf_dir):
    """The forecast buffer kept across micro-batches, then the pivoted table."""
    long = views.model_long(views.future_rows(S.predictions(staged_events_stream(spark, sf_dir, "comparison")), AS_OF))
    buf = _run_state(spark, long, lambda d: state.keep_forecast_buffer(d), "comparison")
    return views.model_pivot(buf)


def q_stream_score(spark, sf_dir):
    """JSON messages in files -> dual score -> JSON messages out,
    malformed ones to a quarantine, one read of the source per micro-batch."""
    fitted_models(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INBOX:
        msgs = S.readings(_events(spark, sf_dir)).select(F.to_json(F.struct("time", "temperature", "wind_speed", "source")).alias("value"), "arrival")
        _INBOX[key] = stage_files(msgs, spark, "inbox", STAGED_FILES, "arrival", fmt="text")
    inbox = _INBOX[key]
    base = fresh_dir(spark, "scored")
    models = _MODEL_DIRS[key]
    score_job(
        spark, models, f"{base}/checkpoint", source="files", sink="files", inbox=inbox,
        outbox=f"{base}/out", quarantine=f"{base}/quarantine", available_now=True, max_per_trigger=1,
    )
    return spark.read.text(f"{base}/out").select("value")


def q_published_messages(spark, sf_dir):
    """S12/A4 then S13 in batch: publish readings as JSON messages, read them back."""
    path = fresh_dir(spark, "published")
    readings = S.readings(_events(spark, sf_dir)).select("arrival", "time", "temperature", "wind_speed", "source")
    publish(readings, "files", path=path)
    schema = T.StructType([*READING.fields, T.StructField("arrival", T.LongType())])
    back = spark.read.text(path).select(decode("value", schema).alias("m"))
    return back.select("m.arrival", "m.time", "m.temperature", "m.wind_speed", "m.source")


def q_serving_views(spark, sf_dir):
    """The serving job over JSON prediction messages in several micro-batches:
    its three views in one table."""
    base = fresh_dir(spark, "serving")
    pred = S.predictions(_events(spark, sf_dir)).drop("event_ts")
    inbox = stage_files(pred.select(F.to_json(F.struct(*pred.columns)).alias("value"), "arrival"), spark, "predictions", STAGED_FILES, "arrival", fmt="text")
    serve_job(
        spark, f"{base}/state", f"{base}/checkpoint", "files", inbox=inbox, max_per_trigger=1,
        sequence=T.StructField("arrival", T.LongType()), as_of=AS_OF, available_now=True,
    )
    shown = state.read_views(spark, f"{base}/state")
    tile = shown["current_conditions"].select(F.lit("now").alias("view"), "Time", F.col("price").alias("Price"))
    live = shown["live_series"].select(F.lit("live").alias("view"), "Time", "Price")
    models = [shown["model_comparison"].select(F.lit(m).alias("view"), "Time", F.col(f"`{m}`").alias("Price")) for m in (views.RF_LABEL, views.GBT_LABEL)]
    return tile.unionByName(live).unionByName(models[0]).unionByName(models[1])


def q_served_quarantine(spark, sf_dir):
    """F8 on S13: prediction messages the serving job cannot use, as they came."""
    base = fresh_dir(spark, "serving-bad")
    pred = S.poisoned_predictions(_events(spark, sf_dir))
    inbox = stage_files(pred, spark, "bad-predictions", STAGED_FILES, "arrival", fmt="text")
    serve_job(
        spark, f"{base}/state", f"{base}/checkpoint", "files", inbox=inbox, max_per_trigger=1,
        sequence=T.StructField("arrival", T.LongType()), as_of=AS_OF, quarantine=f"{base}/bad", available_now=True,
    )
    return spark.read.text(f"{base}/bad").select("value")


def _in_two_parts(spark: SparkSession, df: DataFrame, order: str, name: str, run) -> None:
    """Replay ``df`` in five files: two, a stop, three more. ``run(inbox)`` runs what is there."""
    staged = stage_files(df, spark, name, STAGED_FILES, order)
    inbox = fresh_dir(spark, f"{name}-inbox")
    rows = spark.read.schema(df.schema).parquet(staged)
    cut = rows.agg(F.expr(f"percentile_approx({order}, 0.4)")).first()[0]
    for files, part in ((2, rows.where(F.col(order) <= cut)), (STAGED_FILES - 2, rows.where(F.col(order) > cut))):
        part.repartitionByRange(files, order).sortWithinPartitions(order).write.mode("append").parquet(inbox)
        run(inbox)


def q_stream_site_tiles(spark, sf_dir):
    """The tile of every site in the state store, over five micro-batches and a restart."""
    base = fresh_dir(spark, "site-tiles")
    pred = S.predictions(_events(spark, sf_dir)).drop("event_ts").withColumn("site", S.site_name("arrival"))

    def run(inbox: str) -> None:
        stream = spark.readStream.schema(pred.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        run_tiles(site_tiles(stream, AS_OF, delay="60 days"), f"{base}/tiles", f"{base}/checkpoint")

    _in_two_parts(spark, pred, "arrival", "tiles-messages", run)
    tiles = read_tiles(spark, f"{base}/tiles")
    shown = views.conditions_tile(tiles.select(*TILE, "site"), keep=["site"])
    return shown.select("site", "Time", "price", "wind_speed", "temperature", "signal")


def q_stream_restarted(spark, sf_dir):
    """A stream stopped after two of five batches and resumed on its checkpoint;
    a last run that finds nothing new adds nothing."""
    base = fresh_dir(spark, "restarted")
    readings = S.readings(_events(spark, sf_dir))

    def run(inbox: str) -> None:
        for _ in range(2):
            stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
            run_available(reading_features(stream), spark, "restarted", base=base)

    _in_two_parts(spark, readings, "arrival", "restarted", run)
    return spark.read.parquet(f"{base}/out").select("arrival", "time", "ts", "hour_of_day", "day_of_week")


def q_stream_message_counts(spark, sf_dir):
    """The scoring job's counts of five micro-batches, summed, and the rows of its outputs."""
    fitted_models(spark, sf_dir)
    base = fresh_dir(spark, "counted")
    inbox = stage_files(S.poisoned_messages(_events(spark, sf_dir)), spark, "counted", STAGED_FILES, "arrival", fmt="text")
    score_job(
        spark, _MODEL_DIRS[(spark.sparkContext.applicationId, sf_dir)], f"{base}/checkpoint", source="files", sink="files", inbox=inbox,
        outbox=f"{base}/out", quarantine=f"{base}/bad", available_now=True, max_per_trigger=1, progress=f"{base}/progress",
    )
    counts = read_progress(spark, f"{base}/progress")
    sums = counts.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in ("received", "scored", "quarantined")])
    sent = spark.read.text(f"{base}/out").agg(F.count(F.lit(1)).alias("sent"))
    kept = spark.read.text(f"{base}/bad").agg(F.count(F.lit(1)).alias("kept"))
    return sums.crossJoin(sent).crossJoin(kept)  # one row each


STREAM_QUERIES = {
    "served_quarantine": q_served_quarantine,
    "stream_site_tiles": q_stream_site_tiles,
    "stream_restarted": q_stream_restarted,
    "stream_message_counts": q_stream_message_counts,
    "serving_views": q_serving_views,
    "fit_models": q_fit_models,
    "dual_score_checks": q_dual_score_checks,
    "rf_predict": q_rf_predict,
    "gbt_predict": q_gbt_predict,
    "dual_score": q_dual_score,
    "stream_features": q_stream_features,
    "stream_distinct": q_stream_distinct,
    "stream_union": q_stream_union,
    "stream_last_100": q_stream_last_100,
    "stream_forecast_buffer": q_stream_forecast_buffer,
    "stream_current_conditions": q_stream_current_conditions,
    "stream_live_series": q_stream_live_series,
    "stream_model_comparison": q_stream_model_comparison,
    "stream_score": q_stream_score,
    "published_messages": q_published_messages,
}
