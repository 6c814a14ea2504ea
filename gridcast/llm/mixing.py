"""Mixing sources to target weights by hash thresholds.

Tokens are summed by source and hash bucket; the boundary bucket in which a
source's budget runs out is the only one refined, level by level, until it
holds one hash. A row is taken once more when its hash lies below its
source's threshold: a plain filter, no sort of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.llm.common import WORD, staged

# Bits of the row hash, and bits told apart per level of the histogram.
HASH_BITS, LEVEL_BITS = 60, 12
WEIGHTS = (5, 2, 1)


def water_fill(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> dict[str | None, float]:
    """Targets by source: ``share`` of all sizes by repeating ``weights`` over the
    sources in code-point order (null last), none above ``most`` times its
    source's size; what the cap cuts is shared again by weight."""
    ordered = sorted((s for s in sizes if s[0] is not None), key=lambda s: s[0]) + [s for s in sizes if s[0] is None]
    ranked = sorted(((most * n / w, i, s, n, w) for i, (s, n) in enumerate(ordered) for w in [weights[i % len(weights)]]), key=lambda x: x[:2])
    left, heavy = share * sum(n for _, n in sizes), sum(x[4] for x in ranked)
    targets: dict[str | None, float] = {}
    for _, _, source, n, w in ranked:
        level = left / heavy
        if level * w > most * n:
            targets[source] = float(most * n)
            left -= most * n
            heavy -= w
        else:  # the fill level holds for all that are left
            targets.update({s: level * v for _, _, s, _, v in ranked if s not in targets})
            break
    return targets


def _thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the first hash that is not taken; ``rows``: source_key, size, hash."""
    state = plan.select("source_key", "budget", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("acc"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("tie"), F.lit(False).alias("all"))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        # One row per source: bounded by the sources, not by the rows.
        inside = rows.join(F.broadcast(state.where("NOT done")), "source_key").where(F.shiftright("hash", shift + LEVEL_BITS) == F.col("lo"))
        hist = inside.groupBy("source_key", "budget", "acc", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("tokens"), F.min("hash").alias("first"), F.max("hash").alias("last")
        )
        order = Window.partitionBy("source_key").orderBy("bucket")
        cut = (
            hist.withColumn("upto", F.col("acc") + F.sum("tokens").over(order))
            .where(F.col("upto") > F.col("budget"))
            .groupBy("source_key")
            .agg(F.min(F.struct("bucket", "upto", "tokens", "first", "last")).alias("b"))
        )
        one = F.col("b.first") == F.col("b.last")
        past = F.col("done") | F.col("b").isNull()
        state = staged(
            state.join(F.broadcast(cut), "source_key", "left").select(
                "source_key",
                "budget",
                F.when(past, F.col("lo")).otherwise(F.when(one, F.col("b.first")).otherwise(F.col("b.bucket"))).alias("lo"),
                F.when(past, F.col("acc")).otherwise(F.col("b.upto") - F.col("b.tokens")).alias("acc"),
                (past | one).alias("done"),
                F.when(past, F.col("tie")).otherwise(F.col("b.tokens")).alias("tie"),
                F.when(F.col("done"), F.col("all")).otherwise(F.col("b").isNull()).alias("all"),
            ),
            "mix-thresholds",
        )
        if state.where("NOT done").isEmpty():
            break
    # The hash at the border joins when that brings the sum nearer the budget.
    nearer = F.abs(F.col("acc") + F.col("tie") - F.col("budget")) < F.abs(F.col("acc") - F.col("budget"))
    return state.select("source_key", F.when(F.col("all"), F.lit(1 << HASH_BITS)).otherwise(F.col("lo") + nearer.cast("long")).alias("stop"))


def source_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source: source_key, source_size, target, base (copies every row gets) and
    stop (hashes below it get one more). ``rows`` as ``sized_rows`` makes them, stored."""
    found = rows.groupBy("source_key", "source").agg(F.sum("size").alias("size")).collect()  # a row per source
    targets = water_fill([(r["source"], r["size"]) for r in found], weights, share, most) if found else {}
    lines = [(r["source_key"], r["size"], targets[r["source"]]) for r in found]
    schema = T.StructType([T.StructField("source_key", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = rows.sparkSession.createDataFrame(lines, schema).withColumn("base", base).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    return plan.join(F.broadcast(_thresholds(rows, plan)), "source_key").drop("budget")


def sized_rows(df: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, hash and source_key of every row, and the ``carry`` columns as c0_, c1_, ..."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        row_hash(F.col(id_col), text).alias("hash"),
        _key(F.col(source_col).cast("string")).alias("source_key"),
        *[F.col(c).alias(f"c{i}_") for i, c in enumerate(carry or [])],
    )


def with_copies(rows: DataFrame, plan: DataFrame, most: int = 2) -> DataFrame:
    """``rows`` with the plan of their source (a row per source, broadcast) and ``copies``."""
    copies = F.least(F.lit(most).cast("long"), F.col("base") + (F.col("hash") < F.col("stop")).cast("long"))
    return rows.join(F.broadcast(plan), "source_key").withColumn("copies", copies)


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """Every row with the number of ``copies`` the mix takes: doc_id, hash, size,
    source_size, target, copies, taken.

    Size: words of the text (null: 0). Each row is taken ``floor(target /
    source size)`` times, and once more below its source's hash threshold;
    never more than ``most`` times. A source without words is kept once. The
    hash is of id and text, so reruns agree and equal rows go together. Null
    sources are one source, the last. Null ids are rows like others. Other
    columns are not looked at; an empty table gives no rows.
    """
    rows = staged(sized_rows(df, id_col, text_col, source_col), "mix-rows")
    chosen = with_copies(rows, source_plan(rows, weights, share, most), most)
    return chosen.select("doc_id", "hash", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as ``mix_sources`` takes it.
    The texts are filtered and repeated where they are read, not shuffled."""
    plan = source_plan(staged(sized_rows(df, id_col, text_col, source_col), "mix-rows"), weights, share, most)
    chosen = with_copies(sized_rows(df, id_col, text_col, source_col, df.columns), plan, most).where("copies > 0")
    repeated = chosen.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*[F.col(f"c{i}_").alias(c) for i, c in enumerate(df.columns)])


def row_hash(row_id, text):
    """60 bits of MD5 over id and text, as a long: the same in any SQL engine."""
    named = F.concat(F.coalesce(row_id.cast("string"), F.lit("null")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _key(source):
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))
