"""Bronze text parsed once, what cannot be used kept as it came.

Bronze is read as text and parsed beside it, so a rejected line still has its
raw text, its file and its place there. One pass tags every row (``good``,
``reading`` / ``record``, ``document``) and writes it once, by tag, to the
shared folder; every later step reads its own part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.timefmt import HOURLY_FORMAT, PRICE_FORMAT, parse_time
from gridcast.operators.quality import usable
from gridcast.operators.series import hourly_arrays
from gridcast.schemas import PRICE_RECORD, WEATHER_DOC
from gridcast.session import fresh_dir

# Where a row of text came from: file, start of the block of the file that its
# task read, and its row number in that task.
ORIGIN = ["source_file", "block_start", "task_row"]
CORRUPT = "_corrupt"


def run_name(*inputs: str | Sequence[str]) -> str:
    """A name for a run by what it reads and writes: the same job run again has the same name."""
    return hashlib.sha256(repr([[i] if isinstance(i, str) else list(i) for i in inputs]).encode()).hexdigest()[:16]


def read_bronze_text(spark: SparkSession, paths: str | Sequence[str], whole_files: bool = False) -> DataFrame:
    """``value`` (a line, or a file with ``whole_files``), its origin and ``landed``,
    the file's modification time; blank lines are no documents."""
    text = spark.read.option("wholetext", whole_files).text([paths] if isinstance(paths, str) else list(paths))
    rows = text.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("landed"),
    )
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("task_row", place).where(F.trim("value") != "")


def _by_tag(tagged: DataFrame, kind: str) -> dict[str, DataFrame]:
    spark = tagged.sparkSession
    path = fresh_dir(spark, kind)
    tagged.write.partitionBy("tag").parquet(path)
    back = spark.read.schema(tagged.schema).option("basePath", path).parquet(path)
    return {tag: back.where(F.col("tag") == tag).drop("tag") for tag in ("good", "record", "document")}


def _reject(fields: Sequence[tuple[str, str]]) -> Column:
    return F.array(F.struct(F.lit("document").alias("tag"), *[F.lit(None).cast(k).alias(n) for n, k in fields]))


def weather_parts(text: DataFrame) -> dict[str, DataFrame]:
    """C1 and F8 in one pass over bronze weather text (``read_bronze_text``).

    ``good``: readings with ``site``, ``time``, ``landed``; ``record``: readings
    whose time does not parse, with their origin; ``document``: raw text and
    origin of a line that is not JSON, has no ``hourly`` section, or could be
    read only in part (the readings that it has are kept as well).
    """
    schema = T.StructType([*WEATHER_DOC.fields, T.StructField(CORRUPT, T.StringType())])
    docs = text.withColumn("d", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    docs = docs.select(*ORIGIN, "landed", "value", "d.*")
    fields = [("time_str", "string"), ("temperature", "double"), ("wind_speed", "double")]
    readings = F.transform(hourly_arrays(), lambda r: F.struct(F.lit("reading").alias("tag"), *[r[n].alias(n) for n, _ in fields]))
    whole = F.col("hourly").isNotNull() & F.col(CORRUPT).isNull()
    entries = F.when(whole, readings).when(F.col("hourly").isNotNull(), F.concat(_reject(fields), readings)).otherwise(_reject(fields))
    site = F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    rows = docs.select(*ORIGIN, "landed", "value", site.alias("site"), F.explode(entries).alias("r")).select(*ORIGIN, "landed", "site", "value", "r.*")
    time = parse_time("time_str", HOURLY_FORMAT)
    tag = F.when(F.col("tag") == "document", F.col("tag")).when(time.isNull(), F.lit("record")).otherwise(F.lit("good"))
    value = F.when(F.col("tag") == "document", F.col("value"))
    parts = _by_tag(rows.select(*ORIGIN, "landed", "site", value.alias("value"), "time_str", time.alias("time"), "temperature", "wind_speed", tag.alias("tag")), "weather-parts")
    return {
        "good": parts["good"].drop("value", "time_str", *ORIGIN),
        "record": parts["record"].drop("value", "time", "landed"),
        "document": parts["document"].select("value", *ORIGIN),
    }


def price_parts(text: DataFrame) -> dict[str, DataFrame]:
    """S2 and F8 in one pass over bronze price text: a line is a JSON array of records or one record.

    ``good``: ``price_time``, ``label``, ``PriceArea``, ``landed`` and the
    record's place; ``record``: records without a time or a finite price;
    ``document``: raw text and origin of lines that are no JSON.
    """
    fields = [(f.name, f.dataType.simpleString()) for f in PRICE_RECORD]
    parsed = F.from_json("value", T.ArrayType(PRICE_RECORD))
    records = F.transform("records", lambda r: F.struct(F.lit("record").alias("tag"), *[r[n].alias(n) for n, _ in fields]))
    rows = text.withColumn("records", parsed)
    rows = rows.select(*ORIGIN, "landed", "value", F.posexplode(F.when(F.col("records").isNull(), _reject(fields)).otherwise(records)).alias("item", "r"))
    rows = rows.select(*ORIGIN, "landed", "value", "item", "r.*").withColumn("price_time", parse_time("HourUTC", PRICE_FORMAT)).withColumnRenamed("SpotPriceEUR", "label")
    fine = usable(rows, ["price_time", "label"])
    tag = F.when(F.col("tag") == "document", F.col("tag")).when(fine, F.lit("good")).otherwise(F.lit("record"))
    rows = rows.withColumn("value", F.when(F.col("tag") == "document", F.col("value"))).withColumn("tag", tag)
    parts = _by_tag(rows, "price-parts")
    return {
        "good": parts["good"].drop("value", "HourUTC"),
        "record": parts["record"].drop("value", "landed", "price_time"),
        "document": parts["document"].select("value", *ORIGIN),
    }


def write_quarantine(df: DataFrame, base: str, run: str) -> None:
    """Keep ``df`` under ``base/run=<run>``: the same run again replaces what it had rejected."""
    df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/run={run}")
