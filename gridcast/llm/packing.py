"""Packing by cutting-stock column generation.

Texts are tokenised and cut at multiples of the sequence length; whole cuts
are sequences of their own. What is left of each text is packed: a linear
program over patterns (how many pieces of each length class fill one sequence)
is solved on the length histogram by column generation, with a knapsack
dynamic program pricing the columns. Rounded patterns are then handed out: the
piece of rank r in its class takes the r-th slot that the patterns have for
that class. The driver sees the histogram and the patterns only.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import gapless_rank, staged, text_slices, tidy

# Lengths are rounded up to a multiple of this in the program (not in the data).
UNIT = 8
END_ID = 0
# Stop pricing when the program is this near its bound, or after so many columns.
GAP, COLUMNS = 1e-3, 6000
CELLS = 256


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Byte-level BPE of a ``tokenizers`` file as text -> ids, as that library gives
    them. tiktoken runs the file's own vocabulary, several times faster; a text
    that holds a special string, or that tiktoken refuses, goes to ``tokenizers``
    itself."""
    import tiktoken

    # The byte alphabet of byte-level BPE: printable bytes stand for themselves,
    # the others for the code points from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = sorted({t["content"] for t in spec.get("added_tokens", [])})
    ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    del spec, ranks

    @functools.cache
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except BaseException as e:  # noqa: BLE001 - the Rust side panics with its own class
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _pieces(path: str, size: int, with_ids: bool):
    def run(batches):
        encode = encoder(path)
        for whole in batches:
            for batch in text_slices(whole, "text", max_bytes=1 << 20):
                rows = []
                for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                    ids = np.append(encode(text or ""), END_ID).astype("<u4")
                    for a in range(0, len(ids), size):
                        piece = ids[a : a + size].tobytes()
                        rows.append((i, a, len(piece) // 4, zlib.crc32(piece), len(ids), piece if with_ids else None))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def _knapsack(value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best pattern: value[c] per piece of class c + 1, any number of each."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        top = min(w, len(value))
        gains = best[w - 1 :: -1][:top] + value[:top]  # best[w - c] + value of class c
        c = int(np.argmax(gains))
        if gains[c] > best[w]:
            best[w], pick[w] = gains[c], c
    pattern, w = np.zeros(len(value), np.int64), room
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            pattern[pick[w]] += 1
            w -= pick[w] + 1
    return float(best[room]), pattern


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination. A linear algebra library's own threads can hang in
    a driver that has forked; the matrices here have a row per length class."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        best = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, best]] = both[[best, i]]
        both[i] /= both[i, i]
        factors = both[:, i].copy()
        factors[i] = 0
        both -= factors[:, None] * both[i]
    return both[:, n:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(1)


def cutting_stock(demand: np.ndarray, room: int) -> list[tuple[int, np.ndarray]]:
    """(times, pattern) that hold exactly ``demand[c]`` pieces of class c + 1,
    whose width is c + 1, in few sequences of width ``room``."""
    classes = np.flatnonzero(demand)
    if not len(classes):
        return []
    m, need = len(classes), demand[classes].astype(float)
    basis = np.diag(np.array([room // (c + 1) for c in classes], float))
    inverse = _inverse(basis)
    for step in range(COLUMNS):
        amount = _times(inverse, need)
        price = inverse.sum(0)
        value = np.full(len(demand), -1.0)
        value[classes] = price
        best, column = _knapsack(np.maximum(value, 0), room)
        column = np.where(value > 0, column, 0)[classes].astype(float)
        if best <= 1 + 1e-9 or amount.sum() - (price * need).sum() / max(best, 1) <= max(0.5, GAP * amount.sum()):
            break
        move = _times(inverse, column)
        up = move > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = np.maximum(amount[up], 0) / move[up]
        out = int(np.argmin(ratio))
        basis[:, out] = column
        if step % 64 == 63:
            inverse = _inverse(basis)
        else:
            pivot = inverse[out] / move[out]
            inverse = inverse - np.outer(move, pivot)
            inverse[out] = pivot
    amount = _times(_inverse(basis), need)
    left, made = demand.copy(), []

    def use(times: int, pattern: np.ndarray) -> None:
        nonlocal left
        used = pattern > 0
        times = min(times, int((left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            made.append((times, pattern))
            left = left - times * pattern

    for j in np.argsort(-amount, kind="stable"):
        pattern = np.zeros(len(demand), np.int64)
        pattern[classes] = basis[:, j].round().astype(np.int64)
        use(int(amount[j] + 1e-7), pattern)
    while left.any():  # what rounding left over: the largest that fits, again and again
        pattern, space = np.zeros(len(demand), np.int64), room
        for c in np.flatnonzero(left)[::-1]:
            pattern[c] = min(left[c], space // (c + 1))
            space -= pattern[c] * (c + 1)
        use(int(left.sum()), pattern)
    return made


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and its ids (little-endian 32 bit) if asked for.

    A text is its ids and a closing id 0; null and empty texts are that id
    alone. Every id lies in one piece, every piece in one sequence of at most
    ``size`` ids, without gaps from offset 0. Repeated rows and null ids are
    packed like others; other columns are not looked at; an empty table gives
    no rows. ``tokenizer`` is a path that every executor can open.
    """
    spark = df.sparkSession
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = source.mapInArrow(tidy(_pieces(tokenizer, size, with_ids)), PIECES)
    whole = F.col("length") == size
    pieces = staged(pieces.withColumn("class", F.when(whole, 0).otherwise(F.ceil(F.col("length") / UNIT)).cast("int")), "pack-pieces", "zstd")

    demand = np.zeros(size // UNIT, np.int64)
    for row in pieces.where("class > 0").groupBy("class").count().collect():  # a row per class
        demand[row["class"] - 1] = row["count"]
    lines, base, ranks = [], 0, np.zeros(len(demand), np.int64)
    for times, pattern in cutting_stock(demand, size // UNIT):
        for c in np.flatnonzero(pattern):
            slots = int(times * pattern[c])
            lines.append((int(c) + 1, int(ranks[c]), int(ranks[c]) + slots, int(pattern[c]), base))
            ranks[c] += slots
        base += times
    slots = spark.createDataFrame(lines, "class int, first long, stop long, each long, base long")

    spread = F.concat_ws(":", F.col("id").cast("string"), F.col("start").cast("string"), F.col("ids_crc32").cast("string"))
    ranked = gapless_rank(pieces, ["class"], "rank", CELLS, spread, [F.col("id"), F.col("start"), F.col("ids_crc32")])
    done = ranked.where("class = 0").withColumn("sequence_id", F.col("rank") + base).withColumn("offset", F.lit(0).cast("long"))
    # A line per class and pattern: bounded by the classes, not by the rows.
    fit = ranked.where("class > 0").join(F.broadcast(slots), "class").where("rank >= first AND rank < stop")
    turn = F.col("rank") - F.col("first")
    fit = fit.withColumn("sequence_id", F.col("base") + F.floor(turn / F.col("each"))).withColumn("_turn", turn % F.col("each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "_turn").rowsBetween(Window.unboundedPreceding, -1)
    fit = fit.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    columns = [F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return done.select(*columns).unionByName(fit.select(*columns))
