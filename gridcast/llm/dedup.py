"""Exact de-duplication by content sort.

Rows are range-partitioned at sampled splitters over (text prefix, digest, id),
each partition is sorted externally by Spark, and neighbours are compared in
full. The id is part of the splitters, so a text shared by a third of all rows
is spread over many partitions; a run of equal texts that touches a partition's
edge is stitched to its neighbours by comparing the edge texts, two per
partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import shuffle_width, staged, tidy

# Characters of the text in the range key. The digest that follows splits
# texts with a longer common beginning, and keeps the sampled splitters small
# (they pass through the driver) whatever the length of the texts.
PREFIX = 48


def _runs(smallest: bool, carried: list[str], schema: pa.Schema):
    """Arrow function over one sorted partition: a row per input row with its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # the open run without its text
        held_text, best, n_run = None, None, 0

        def close(last: bool) -> pa.RecordBatch:
            nonlocal held, n_run
            rows = pa.Table.from_batches(held).combine_chunks()
            n, ids = rows.num_rows, rows.column("id")
            at = 0 if smallest else n - 1
            edge = last or n_run == 0
            here = np.arange(n) == at
            text = pa.array([None] * n, pa.string()) if not edge else pa.array([held_text.as_py() if h else None for h in here], pa.string())
            cols = [ids, rows.column("sha"), pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, n_run, np.int64)), pa.array(np.full(n, n, np.int64)), pa.array([ids[at].as_py()] * n, ids.type), pa.array(here), text]
            for c in carried:
                cols.append(pa.concat_arrays([pa.nulls(at, best[c].type), pa.array([best[c].as_py()], best[c].type), pa.nulls(n - 1 - at, best[c].type)]))
            n_run, held = n_run + 1, []
            cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

        def many(batch: pa.RecordBatch, starts: np.ndarray, stop: int) -> pa.RecordBatch:
            """Runs that begin and end inside one batch, none at an edge."""
            nonlocal n_run
            a, n = int(starts[0]), stop - int(starts[0])
            sizes = np.diff(np.append(starts, stop))
            which = np.repeat(np.arange(len(starts)), sizes)
            pick = (starts if smallest else starts + sizes - 1) - a
            part = batch.slice(a, n)
            here = np.zeros(n, bool)
            here[pick] = True
            mask = pa.array(here)
            cols = [part.column("id"), part.column("sha"), pa.array(np.full(n, pid, np.int32)), pa.array(n_run + which), pa.array(sizes[which]), part.column("id").take(pa.array(pick[which])), mask, pa.nulls(n, pa.string())]
            cols += [pc.if_else(mask, part.column(c), pa.nulls(n, part.column(c).type)) for c in carried]
            n_run += len(starts)
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column("content")
            same = np.empty(batch.num_rows, bool)
            same[0] = held_text is not None and held_text.as_py() == text[0].as_py()
            if batch.num_rows > 1:
                same[1:] = pc.equal(text.slice(1), text.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~same)
            light = batch.select(["id", "sha"])

            def hold(a: int, b: int) -> None:
                nonlocal best
                held.append(light.slice(a, b - a))
                at = a if smallest else b - 1
                if best is None or not smallest:
                    best = {c: batch.column(c)[at] for c in carried}

            if not len(starts):
                hold(0, batch.num_rows)
                continue
            if held_text is not None:
                if starts[0]:
                    hold(0, int(starts[0]))
                yield close(last=False)
            first = 0
            if n_run == 0 and len(starts) > 1:  # the partition's first run stands at its edge
                best, held_text = None, text[0]
                hold(0, int(starts[1]))
                yield close(last=False)
                first = 1
            if len(starts) - first > 1:
                yield many(batch, starts[first:-1], int(starts[-1]))
            best, held_text = None, text[int(starts[-1])]
            hold(int(starts[-1]), batch.num_rows)
        if held:
            yield close(last=True)

    return run


def content_sort(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", carry: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256`` and, on kept rows only, the ``carry`` columns.

    Texts are equal when identical after null becomes empty. Of equal texts
    the row with the largest (or smallest) id stays; a null id counts as the
    smallest. Rows repeated with one id are copies: one of them stays. Other
    columns, whatever their names, are not looked at. An empty table gives no
    rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    carry = carry or []
    spark = df.sparkSession
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = df.select(
        F.col(id_col).alias("id"), content.alias("content"), F.sha2(content.cast("binary"), 256).alias("sha"), *[F.col(c).alias(f"c{i}_") for i, c in enumerate(carry)]
    )
    order = [F.substring("content", 1, PREFIX), F.col("sha"), F.col("id")]
    ranged = keyed.repartitionByRange(partitions or shuffle_width(spark), *order).sortWithinPartitions(order[0], "sha", "content", "id")
    names = [f"c{i}_" for i in range(len(carry))]
    kinds = dict(zip(keyed.columns, keyed.schema))
    out = T.StructType(
        [
            T.StructField("id", kinds["id"].dataType),
            T.StructField("sha", T.StringType()),
            T.StructField("pid", T.IntegerType()),
            T.StructField("run", T.LongType()),
            T.StructField("run_size", T.LongType()),
            T.StructField("run_id", kinds["id"].dataType),
            T.StructField("best", T.BooleanType()),
            T.StructField("edge_text", T.StringType()),
            *[T.StructField(c, kinds[c].dataType) for c in names],
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = staged(ranged.mapInArrow(tidy(_runs(keep == "smallest", names, to_arrow_schema(out))), out), "content-runs")
    same = Window.partitionBy("edge_text")
    pick = F.min if keep == "smallest" else F.max
    # Two rows per partition at most: a bound that does not follow the rows.
    stitched = rows.where("edge_text IS NOT NULL").select(
        "pid", "run", F.sum("run_size").over(same).alias("all_size"), pick(F.struct("pid", "run_id")).over(same).alias("top")
    )
    joined = rows.join(F.broadcast(stitched), ["pid", "run"], "left")
    kept = F.col("best") & (F.col("top").isNull() | (F.col("pid") == F.col("top.pid")))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("top").isNull(), F.col("run_id")).otherwise(F.col("top.run_id")).alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"),
        kept.alias("kept"),
        F.col("sha").alias("text_sha256"),
        *[F.when(kept, F.col(n)).alias(c) for n, c in zip(names, carry)],
    )
