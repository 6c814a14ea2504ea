"""The driver's tables seen as the weather/price data sets.

``events`` stands in for every energy data set (the real ones are not in the
test data):

* ``event_type = 'purchase'`` rows are price records: the hour of ``ts`` is
  the price time, ``value`` the price, ``event_id`` the arrival order; one in
  50 keeps its off-hour time, one in 41 has no price;
* all other rows are weather readings: ``ts`` is the time, ``value`` the
  temperature, and ``k`` of the ``props`` JSON the wind speed;
* every row is also a live/forecast message and - with ``price_rf = value``
  and ``price_gbt = 1.5 * value`` - a scored prediction message, arriving in
  ``event_id`` order;
* ``user_id`` stands in for a location or price area.

Nothing here samples or caps rows: each frame covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.timefmt import HOURLY_FORMAT, PRICE_FORMAT, iso_text
from gridcast.operators.readings import FORECAST_SOURCE, LIVE_SOURCE

# Fixed values of the stand-in mapping.
PRICE_EVENT = "purchase"
FORECAST_EVENT = "view"
LIVE_EVENT = "click"
GBT_FACTOR = 1.5
DOC_READINGS = 24  # readings per bronze weather document
SITES = ("55.0,12.5", "56.0,9.5")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def wind_of(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("double")


def weather_events(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") != PRICE_EVENT)


def site_of(col: str = "event_id"):
    """Two sites, as the text of their coordinates."""
    return F.element_at(F.array(*[F.lit(s) for s in SITES]), (F.col(col) % 2 + 1).cast("int"))


def weather_docs_text(ev: DataFrame, readings_per_doc: int = DOC_READINGS, part=None) -> DataFrame:
    """Weather readings packed as bronze JSON documents (D1): ``chunk, value``, one
    document per ``part`` (a site, a day) at least.

    Consecutive arrivals form a document of at most ``readings_per_doc``
    readings, so no document grows with the data. Even documents carry the
    wind under the month job's name, odd ones under the year job's name, as
    a mixed bronze folder does.
    """
    rows = weather_events(ev).select(
        F.floor(F.col("event_id") / readings_per_doc).alias("chunk"),
        site_of().alias("site"),
        (F.lit("") if part is None else part).alias("part"),
        F.struct(
            F.col("event_id"),
            iso_text("ts", HOURLY_FORMAT).alias("time"),
            F.col("value").alias("temperature"),
            wind_of().alias("wind"),
        ).alias("r"),
    )
    docs = rows.groupBy("chunk", "site", "part").agg(F.array_sort(F.collect_list("r")).alias("r"))
    old_name = F.col("chunk") % 2 == 0
    hourly = F.struct(
        F.col("r.time").alias("time"),
        F.col("r.temperature").alias("temperature_2m"),
        F.when(old_name, F.col("r.wind")).alias("windspeed_10m"),
        F.when(~old_name, F.col("r.wind")).alias("wind_speed_10m"),
    )
    place = F.split("site", ",")
    where = [place[0].cast("double").alias("latitude"), place[1].cast("double").alias("longitude")]
    return docs.select("chunk", "site", "part", F.to_json(F.struct(*where, hourly.alias("hourly"))).alias("value"))


def broken_docs(ev: DataFrame) -> DataFrame:
    """Lines that no bronze reader can use, among the events: text that is cut off
    and, for every other one, the answer of a failed call."""
    i = F.col("event_id")
    cut = F.concat(F.lit('[{"HourUTC": "2024-01-0'), i.cast("string"))
    failed = F.concat(F.lit('{"error": true, "id": '), i.cast("string"), F.lit(', "hourly": '))
    return ev.where(i % 97 == 0).select(F.when(i % 2 == 0, cut).otherwise(failed).alias("value"))


def broken_times(ev: DataFrame) -> DataFrame:
    """Weather documents of one reading; the time of every 13th does not parse."""
    rows = weather_events(ev)
    time = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("day "), F.col("event_id").cast("string"))).otherwise(iso_text("ts", HOURLY_FORMAT))
    hourly = F.struct(F.array(time).alias("time"), F.array("value").alias("temperature_2m"), F.array(wind_of()).alias("windspeed_10m"))
    return rows.select(F.to_json(F.struct(F.lit(55.0).alias("latitude"), F.lit(12.5).alias("longitude"), hourly.alias("hourly"))).alias("value"))


def live_docs_text(ev: DataFrame) -> DataFrame:
    """Every event as a live weather document (a ``current`` struct), with the
    time it was fetched (``ts``) and its arrival: ``arrival, fetched, value``."""
    current = F.struct(
        iso_text("ts", HOURLY_FORMAT).alias("time"),
        F.col("value").alias("temperature_2m"),
        wind_of().alias("wind_speed_10m"),
    )
    return ev.select(
        F.col("event_id").alias("arrival"),
        F.col("ts").alias("fetched"),
        F.to_json(F.struct(current.alias("current"))).alias("value"),
    )


def price_records(ev: DataFrame) -> DataFrame:
    """Price records (D2) with their arrival: ``HourUTC, SpotPriceEUR, arrival``."""
    at = F.when(F.col("event_id") % 50 == 0, F.col("ts")).otherwise(F.date_trunc("hour", "ts"))
    return ev.where(F.col("event_type") == PRICE_EVENT).select(
        iso_text(at, PRICE_FORMAT).alias("HourUTC"),
        F.when(F.col("event_id") % 41 != 0, F.col("value")).alias("SpotPriceEUR"),
        F.col("event_id").alias("arrival"),
    )


def readings(ev: DataFrame) -> DataFrame:
    """Live/forecast messages (D8) with their arrival."""
    source = F.when(F.col("event_type") == FORECAST_EVENT, F.lit(FORECAST_SOURCE)).otherwise(F.lit(LIVE_SOURCE))
    return ev.select(
        iso_text("ts", PRICE_FORMAT).alias("time"),
        F.col("value").alias("temperature"),
        wind_of().alias("wind_speed"),
        source.alias("source"),
        F.col("event_id").alias("arrival"),
    )


def poisoned_messages(ev: DataFrame) -> DataFrame:
    """Reading messages of which some are no use: not JSON, NaN, NULL, a bad time, a missing key."""
    i = F.col("arrival")
    r = readings(ev).withColumn("time", F.when(i % 17 == 0, F.lit("yesterday")).otherwise(F.col("time")))
    whole = F.to_json(F.struct("time", "temperature", "wind_speed", "source"))
    nan = F.concat(F.lit('{"temperature": NaN, "wind_speed": 1.0, "time": "'), F.col("time"), F.lit('"}'))
    null = F.concat(F.lit('{"temperature": null, "wind_speed": 1.0, "time": "'), F.col("time"), F.lit('"}'))
    value = F.when(i % 7 == 0, nan).when(i % 19 == 0, null).when(i % 11 == 0, F.lit("not json")).when(i % 13 == 0, F.to_json(F.struct("time", "temperature"))).otherwise(whole)
    return r.select(value.alias("value"), "arrival")


def predictions(ev: DataFrame) -> DataFrame:
    """Scored messages (D10) with their arrival and the stored time theirs is cut from."""
    return ev.select(
        iso_text("ts", PRICE_FORMAT).alias("time"),
        F.col("value").alias("temperature"),
        wind_of().alias("wind_speed"),
        F.col("value").alias("price_rf"),
        (F.col("value") * F.lit(GBT_FACTOR)).alias("price_gbt"),
        F.col("event_id").alias("arrival"),
        F.col("ts").alias("event_ts"),
    )


def poisoned_predictions(ev: DataFrame) -> DataFrame:
    """Prediction messages as text; some are not JSON, some have no usable time."""
    i = F.col("arrival")
    p = predictions(ev).drop("event_ts").withColumn("time", F.when(i % 17 == 0, F.lit("yesterday")).when(i % 23 != 0, F.col("time")))
    whole = F.to_json(F.struct("time", "price_rf", "arrival"))
    return p.select(F.when(i % 11 == 0, F.concat(F.lit("not json "), i.cast("string"))).otherwise(whole).alias("value"), "arrival")


def site_name(col: str = "event_id"):
    """One of 40 sites."""
    return F.concat(F.lit("site"), (F.col(col) % 40).cast("string"))


def market_records(ev: DataFrame) -> DataFrame:
    """Market price records (D9): ``TimeUTC, PriceArea, ImbalancePriceEUR, arrival``.

    The upstream price is often missing: here it is set only from 60 up, so
    about a third of the newest records carry no price.
    """
    price = F.when(F.col("value") >= 60, F.col("value"))
    return ev.select(
        iso_text("ts", PRICE_FORMAT).alias("TimeUTC"),
        F.col("user_id").cast("string").alias("PriceArea"),
        price.alias("ImbalancePriceEUR"),
        F.col("event_id").alias("arrival"),
    )


def market_records_text(ev: DataFrame) -> DataFrame:
    """Market price records as JSON text with a field the operators do not know: ``value, arrival``."""
    records = market_records(ev).withColumn("note", F.concat(F.lit("n"), F.col("arrival").cast("string")))
    return records.select(F.to_json(F.struct("TimeUTC", "PriceArea", "ImbalancePriceEUR", "note")).alias("value"), "arrival")
