"""Contiguous shards of atomic groups with the smallest possible largest shard.

Groups of equal texts are ordered by digest. The smallest capacity with which
a greedy pass needs no more than the given number of shards is found by binary
search. Greedy cuts would leave the last shards small, so within that capacity
two more binary searches make the smallest shard as large as the blocks allow,
then the largest one (but for single blocks above it) as small. The driver
never holds a row per group: it searches over blocks of digests (one Spark
aggregate), and only blocks in which a greedy border can still lie are split
further, level by level, until they are single groups; so are blocks that are
coarse beside a shard.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import gapless_rank, staged

# Hex digits of the digest per level: 16 ** FIRST blocks at first; a block is
# then split 16 ** STEP ways.
FIRST, STEP, DIGITS = 4, 2, 64
CELLS = 64
# A block of several groups larger than a mean shard's part of this is split.
PARTS = 64


def _chain(ends: list[int], capacity: int, shards: int, slack: bool) -> list[int]:
    """Greedy cuts over cumulative block ends. Without ``slack`` a cut is at a
    block's end (what is certainly reachable); with it, anywhere (what is at
    most reachable)."""
    cuts, at = [], 0
    for _ in range(shards):
        reach = at + capacity
        if slack:
            at = min(reach, ends[-1])
        else:
            i = bisect_right(ends, reach)
            at = ends[i - 1] if i and ends[i - 1] > at else at
        cuts.append(at)
    return cuts


def _smallest(ends: list[int], low: int, high: int, shards: int, slack: bool) -> int:
    while low < high:
        mid = (low + high) // 2
        if _chain(ends, mid, shards, slack)[-1] >= ends[-1]:
            high = mid
        else:
            low = mid + 1
    return low


def minimax_cuts(groups: DataFrame, shards: int) -> list[str]:
    """Digests at which shards 1, 2, ... begin; ``groups``: digest, bytes (stored).

    The capacity is exact: every block in which any greedy border can fall for
    any capacity still possible is split down to single groups before the last
    search. The cuts within it are the evenest ones at borders of blocks.
    """
    width = FIRST
    block = F.substring("digest", 1, width)
    found = groups.groupBy(block.alias("block")).agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"), F.count(F.lit(1)).alias("n")).collect()
    blocks = sorted((r["block"], r["bytes"], r["most"], r["n"]) for r in found)
    if not blocks:
        return []
    total, most = sum(b[1] for b in blocks), max(b[2] for b in blocks)
    floor = max(most, -(-total // shards))
    while True:
        ends = list(accumulate(b[1] for b in blocks))
        high = _smallest(ends, floor, total, shards, slack=False)
        low = _smallest(ends, floor, high, shards, slack=True)
        # A border j lies between the lowest greedy cut at the least capacity
        # and the furthest at the largest one.
        spans = list(zip(_chain_low(ends, low, shards), _chain(ends, high, shards, slack=True)))
        open_blocks = [
            b for b, end in zip(blocks, ends) if b[3] > 1 and (b[1] * shards * PARTS > total or any(end > a and end - b[1] < z for a, z in spans))
        ]
        if not open_blocks or width >= DIGITS:
            break
        width = min(DIGITS, width + STEP)
        wanted = groups.sparkSession.createDataFrame([(b[0],) for b in open_blocks], "block string")
        # One row per block that is still open: at most the number of blocks.
        finer = (
            groups.withColumn("block", F.substring("digest", 1, len(open_blocks[0][0])))
            .join(F.broadcast(wanted), "block")
            .groupBy(F.substring("digest", 1, width).alias("block"))
            .agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        split = {b[0] for b in open_blocks}
        blocks = sorted([b for b in blocks if b[0] not in split] + [(r["block"], r["bytes"], r["most"], r["n"]) for r in finer])
    ends = list(accumulate(b[1] for b in blocks))
    best = _smallest(ends, floor, total, shards, slack=False)
    return [blocks[i][0] for i in _even(ends, best, shards)]


def _reach(at: np.ndarray, shards: int, low: int, high: int, most: int) -> list[np.ndarray]:
    """Per number of shards, the borders at which so many can end: each holds
    ``low`` to ``high`` bytes, or is one block of ``low`` to ``most``."""
    first, last = np.searchsorted(at, at - high, "left"), np.searchsorted(at, at - low, "right")
    single = np.diff(at)
    alone = (single >= low) & (single <= most)
    found = [np.arange(len(at)) == 0]
    for _ in range(shards):
        before = np.concatenate([[0], np.cumsum(found[-1])])
        here = before[np.maximum(first, last)] > before[first]
        here[1:] |= alone & found[-1][:-1]
        found.append(here)
    return found


def _even(ends: list[int], capacity: int, shards: int) -> list[int]:
    """First blocks of shards 1, 2, ...: none is empty (with fewer blocks than
    shards, the last shards are left out)."""
    at, shards = np.array([0, *ends], np.int64), min(shards, len(ends))
    low, high = 1, ends[-1] // shards
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if _reach(at, shards, mid, capacity, capacity)[-1][-1] else (low, mid - 1)
    least, most = low, capacity
    while least < most:
        mid = (least + most) // 2
        least, most = (least, mid) if _reach(at, shards, low, mid, capacity)[-1][-1] else (mid + 1, most)
    found, cuts, i = _reach(at, shards, low, most, capacity), [], len(ends)
    for j in range(shards - 1, 0, -1):
        size = at[i] - at[:i]
        able = np.flatnonzero(found[j][:i] & (((size >= low) & (size <= most)) | ((np.arange(i) == i - 1) & (size >= low) & (size <= capacity))))
        i = int(able[np.argmin(np.abs(at[able] * (j + 1) - at[i] * j))])
        cuts.append(i)
    return cuts[::-1]


def _chain_low(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Lower bounds of the greedy cuts: each is at least the end of the last
    block that fits whole after the bound before it."""
    return _chain(ends, capacity, shards, slack=False)


def shard_of(digest: Column, cuts: list[str]) -> Column:
    """Shard of a digest: the number of borders at or before it."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: digest >= c)) if cuts else F.lit(0)


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40) -> DataFrame:
    """Every row with its shard and its slot in it (gapless from 0).

    Size: UTF-8 bytes of the text plus 16; a null text has none and counts as
    the empty text. Equal texts are one atomic group and share a shard; slots
    follow no order. Null ids are rows like others; repeated rows get slots of
    their own; other columns are not looked at; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = staged(
        df.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest")),
        "shard-rows",
    )
    groups = staged(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = rows.withColumn("shard", shard_of(F.col("digest"), minimax_cuts(groups, shards)).cast("int"))
    spread = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("digest"))
    return gapless_rank(placed, ["shard"], "slot", CELLS, spread, [F.col("doc_id"), F.col("digest")])
