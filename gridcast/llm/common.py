"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.session import fresh_dir

# The word pattern of the contracts: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


# Bytes of one Arrow batch sent to a Python worker: long texts are sent in more batches.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, kind: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: cuts
    the lineage, so later passes neither recompute it nor depend on one executor."""
    bound_batches(df.sparkSession)
    path = fresh_dir(df.sparkSession, kind)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that gives its memory back when its partition ends.

    Spark keeps Python workers for later tasks of other operators; what a task
    has freed stays with the allocators of an idle worker otherwise, and counts
    against its executor.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return tidied


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless_rank(df: DataFrame, keys: list[str], name: str, cells: int, spread: Column, order: list[Column]) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within ``keys``, with no task per key.

    Each key's rows are dealt to ``cells`` cells by the hash of ``spread``;
    a cell is numbered by itself and starts where the cells before it end, so
    a key holding a third of all rows is numbered by many tasks. The offsets
    are one row per (key, cell). ``df`` must be stored (it is read twice) and
    ``keys`` not null.
    """
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(spread), F.lit(cells)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*keys, "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = dealt.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*order)))
    # At most (number of keys) x cells rows: both are parameters of the caller.
    return (
        numbered.join(F.broadcast(offsets), [*keys, "_cell"])
        .withColumn(name, (F.col("_offset") + F.col("_rn") - 1).cast("long"))
        .drop("_cell", "_offset", "_rn")
    )


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each slice holds about ``max_bytes`` of text
    (one longer text is a slice of its own), which bounds a task's memory."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // max_bytes
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of each text at ASCII white space: (all words, offsets per text)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    keep = pc.greater(pc.binary_length(words), 0)
    counted = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy()
    return words.filter(keep), counted[offsets - offsets[0]]


def hash_strings(values: pa.Array, key: str = "0123456789abcdef") -> np.ndarray:
    """64-bit keyed hash of each value; each distinct value is hashed once."""
    if len(values) == 0:
        return np.empty(0, np.uint64)
    coded = values.dictionary_encode()
    hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), hash_key=key, categorize=False)
    return hashes[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

