"""Bronze (raw landed documents): scans with fixed schemas, and landing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.sizing import bounded_broadcast
from gridcast.schemas import CURRENT_DOC, PRICE_RECORD, WEATHER_DOC


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_weather_docs(spark: SparkSession, paths: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """Weather documents from a glob or list of paths, one row per document.

    The schema is fixed (no inference job, only the needed arrays are read)
    and declares both wind names. Use ``multiline`` for pretty-printed files.
    """
    return spark.read.schema(WEATHER_DOC).option("multiLine", multiline).json(_paths(paths))


def read_price_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Price files holding one JSON array each; one row per record."""
    return spark.read.schema(PRICE_RECORD).json(_paths(paths))


def parse_weather_docs(text: DataFrame, col: str = "value") -> DataFrame:
    """Weather documents held as JSON text (a message value, a text file line)."""
    return text.select(F.from_json(F.col(col), WEATHER_DOC).alias("_doc")).select("_doc.*")


def parse_live_docs(text: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Live weather documents (a ``current`` struct) held as JSON text."""
    return text.select(*keep, F.from_json(F.col(col), CURRENT_DOC).alias("_doc")).select(*keep, "_doc.*")


def document_tags(kind: str, col: str = "value") -> tuple[Column, Column]:
    """(site, range) of a raw document, read from the document itself.

    The site is ``latitude,longitude`` of a weather document and the price areas
    of a price document (``all`` when it names none). The range is the first
    and last day the document holds, ``yyyy-MM-dd_yyyy-MM-dd``: the name under
    which a request's answer is kept, so a document over two months is one
    range. A document without times (a failed call kept as it came) has the
    range ``none-`` and its own digest, and replaces no other.
    """
    value = F.col(col)
    if kind == "weather":
        doc = F.from_json(value, "latitude string, longitude string, hourly struct<time:array<string>>")
        times = doc["hourly"]["time"]
        site = F.concat_ws(",", doc["latitude"], doc["longitude"])
    elif kind == "prices":
        records = F.from_json(value, "array<struct<HourUTC:string,PriceArea:string>>")
        times = records["HourUTC"]
        site = F.concat_ws("+", F.array_sort(F.array_distinct(records["PriceArea"])))
    else:
        raise ValueError(f"unknown document kind {kind!r}")
    first, last = F.substring(F.array_min(times), 1, 10), F.substring(F.array_max(times), 1, 10)
    span = F.coalesce(F.concat(first, F.lit("_"), last), F.concat(F.lit("none-"), F.sha2(value, 256)))
    return F.when(F.coalesce(site, F.lit("")) == "", F.lit("all")).otherwise(site), span


LANDING_KEYS = ("kind", "site", "chunk")
LANDED = "value string, kind string, site string, chunk string"


def land_raw(docs: DataFrame, base: str, text_col: str = "value") -> None:
    """Write raw JSON text under ``kind=.../site=.../chunk=...``.

    Dynamic partition overwrite replaces only the (kind, site, chunk) that
    ``docs`` holds: landing a request's range again replaces its last answer,
    and another range, month or site stays as it is.
    """
    (
        docs.select(text_col, *LANDING_KEYS)
        .hint("rebalance", *LANDING_KEYS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LANDING_KEYS)
        .text(base)
    )


def land_version(docs: DataFrame, base: str, text_col: str = "value") -> str:
    """S11 that shows all at once: the documents go to a folder of their own,
    ``base/data/landing=<id>``, and the ranges they replace to a manifest,
    written last. Readers follow complete manifests only (``read_versions``), so
    a landing that stops half-way, or is still running, changes no answer.
    Ids sort by the time they were given. Returns the landing's id."""
    spark = docs.sparkSession
    landing = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    data = f"{base}/data/landing={landing}"
    docs.select(text_col, *LANDING_KEYS).hint("rebalance", *LANDING_KEYS).write.partitionBy(*LANDING_KEYS).text(data)
    commit_version(spark, base, landing)
    return landing


def commit_version(spark: SparkSession, base: str, landing: str) -> None:
    """Write the manifest of a landing: the ranges that its folder holds."""
    path = f"{base}/data/landing={landing}"
    ranges = spark.read.schema(LANDED).option("basePath", path).text(path).select(*LANDING_KEYS).distinct()
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifests/landing={landing}")


def read_versions(spark: SparkSession, base: str) -> DataFrame:
    """Text of each range's newest complete landing, with its range columns.

    Manifests hold a row per range and landing, not per document; they are
    reduced to the newest landing of each range, and a checked broadcast of that
    prunes the folders of older landings before they are listed for reading."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{base}/manifests")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [s.getPath() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))] if fs.exists(root) else []
    kinds = ", ".join(f"{k} string" for k in LANDING_KEYS)
    if not done:
        return spark.createDataFrame([], f"value string, {kinds}")
    manifests = spark.read.schema(f"{kinds}, landing string").option("basePath", f"{base}/manifests").parquet(*[p.toString() for p in done])
    newest, _ = bounded_broadcast(manifests.groupBy(*LANDING_KEYS).agg(F.max("landing").alias("landing")))
    folders = [f"{base}/data/{p.getName()}" for p in done]
    data = spark.read.schema(f"value string, landing string, {kinds}").option("basePath", f"{base}/data").text(folders)
    return data.join(newest, ["landing", *LANDING_KEYS], "left_semi").select("value", *LANDING_KEYS)


def read_landed(spark: SparkSession, base: str) -> DataFrame:
    """Landed text back with its ``kind``, ``site`` and ``chunk`` partition columns."""
    return spark.read.option("basePath", base).text(base)
