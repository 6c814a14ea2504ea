"""Exact top-k inner products with one KD-tree per shard.

Shards are regions of space: median splits of a bounded sample give cells, and
a cell of more rows than a shard holds is dealt to shards by a hash. Each
shard's tree is built once (median splits of the widest component, tight boxes)
and stored. A query first searches its own shard, best box first. Its k-th
score and the other shards' root boxes then tell which shards can hold better
rows; only those pairs of query and shard are sent on, in two waves: the few
shards of the best bounds, and, with the k-th score these gave, what is left.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import shuffle_width, staged, tidy

# Rows per shard and per leaf, and queries that share one copy of a tree: what one
# task holds is a shard and a group, whose products are made SEARCHED queries at a time.
SHARD_ROWS, LEAF_ROWS, GROUP_QUERIES, SEARCHED = 8192, 256, 4096, 1024
# Hits that wait for a merge with the best rows so far, at most by one leaf more.
WAITING = 65536
# Rows the cells are drawn from and cells at most (the driver holds these), root
# boxes in one block, and shards a query visits in the first wave.
SAMPLE_ROWS, CELLS, BOX_BLOCK, FIRST_WAVE = 16384, 1024, 1024, 4
BATCH_ROWS = 8192


def box_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product that each query can have inside each box."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def product_kind(q: np.ndarray, largest: float) -> type:
    """float32 products are exact below 2**24, float64 below 2**53; larger values stay integers."""
    most = largest * max(abs(float(q.max(initial=0))), abs(float(q.min(initial=0)))) * q.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def narrow(values: np.ndarray) -> np.ndarray:
    """``values`` in the smallest integer type that holds them all."""
    low, high = values.min(initial=0), values.max(initial=0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return values.astype(kind)


def unpacked(data: list[bytes], dim: int) -> np.ndarray:
    """Vectors of ``dim`` components from the bytes of ``narrow`` ones, each of its own width."""
    out = np.empty((len(data), dim), np.int64)
    widths = np.array([len(d) for d in data]) // dim
    for width in np.unique(widths):
        mine = np.flatnonzero(widths == width)
        out[mine] = np.frombuffer(b"".join(data[i] for i in mine), f"i{width}").reshape(len(mine), dim)
    return out


class Cells:
    """Up to ``cells`` regions of space by median splits of a sample, each along the
    widest component. Nodes are (axis, threshold, below, above); a cell has axis
    -1 and its number in place of ``below``."""

    def __init__(self, sample: np.ndarray, cells: int):
        nodes, self.count = [], 0
        wait = [(sample, cells, -1, 0)]
        while wait:
            here, most, parent, side = wait.pop()
            if parent >= 0:
                nodes[parent][2 + side] = len(nodes)
            if most < 2 or len(here) < 2 or (here == here[0]).all():
                nodes.append([-1, 0, self.count, -1])
                self.count += 1
                continue
            axis = int(np.argmax(here.max(0) - here.min(0)))
            values = np.sort(here[:, axis])
            middle = values[len(values) // 2]
            cut = middle if middle > values[0] else values[values > values[0]][0]
            above = here[:, axis] >= cut
            me = len(nodes)
            nodes.append([axis, int(cut), -1, -1])
            wait += [(here[above], most // 2, me, 1), (here[~above], most - most // 2, me, 0)]
        self.nodes = np.array(nodes, np.int64)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64)
        while len(go := np.flatnonzero(self.nodes[at, 0] >= 0)):
            node = self.nodes[at[go]]
            at[go] = np.where(vectors[go, node[:, 0]] >= node[:, 1], node[:, 3], node[:, 2])
        return self.nodes[at, 2]


class Tree:
    """KD-tree over integer vectors. ``rows`` are reordered so that each node is a
    slice; nodes are (start, stop, left child, right child), -1 without children."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.nodes, low, high = [], [], []
        wait = [(0, len(order), -1, 0)]
        while wait:
            a, z, parent, side = wait.pop()
            here = vectors[order[a:z]]
            lo, hi = here.min(0), here.max(0)
            if parent >= 0:
                self.nodes[parent][2 + side] = len(self.nodes)
            self.nodes.append([a, z, -1, -1])
            low.append(lo)
            high.append(hi)
            if z - a > LEAF_ROWS:
                axis = int(np.argmax(hi - lo))
                mid = (a + z) // 2
                if hi[axis] > lo[axis]:  # equal vectors stay in id order
                    order[a:z] = order[a:z][np.argsort(here[:, axis], kind="stable")]
                wait += [(mid, z, len(self.nodes) - 1, 1), (a, mid, len(self.nodes) - 1, 0)]
        self.low, self.high = narrow(np.array(low)), narrow(np.array(high))
        self.ids, self.uids, self.vectors = ids[order], uids[order], narrow(vectors[order])
        self.first_id = np.array([self.ids[a:z].min() for a, z, _, _ in self.nodes])
        # As Python numbers: the least integer of a type has no positive one.
        self.largest = max(abs(float(self.low.min(initial=0))), abs(float(self.high.max(initial=0))))

    def search(self, queries: np.ndarray, own: np.ndarray, floor: list[tuple[int, int] | None], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query (scores, ids) of its k best rows here that are not worse
        than ``floor``, a (score, id) already reached k times elsewhere. Ties go
        to the smaller id; the row whose uid is ``own`` is left out.

        Queries go down the tree together, the box of the best bound first; a box
        is entered by those that may still find a row in it, in one product.
        """
        kind = product_kind(queries, self.largest)
        rows, low, high = (x.astype(kind) for x in (self.vectors, self.low, self.high))
        for a in range(0, len(queries), SEARCHED):
            part = slice(a, a + SEARCHED)
            best = self._search(rows, low, high, queries[part].astype(kind), own[part], floor[part], k)
            yield from ((a + i, scores, ids) for i, scores, ids in best)

    def _search(self, rows, low, high, q, own, floor, k) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        bounds = box_bounds(q, low, high)
        unset = np.array([f is None for f in floor])
        worst = np.array([0 if f is None else f[0] for f in floor], np.int64)  # the k-th (score, id) so far
        last = np.array([0 if f is None else f[1] for f in floor], np.int64)
        at, scores, ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        wait, waiting = [], 0

        def merge() -> None:
            nonlocal at, scores, ids, wait, waiting
            at, scores, ids = (np.concatenate(x) for x in zip((at, scores, ids), *wait))
            wait, waiting = [], 0
            order = np.lexsort((ids, -scores, at))
            at, scores, ids = at[order], scores[order], ids[order]
            starts = np.searchsorted(at, np.arange(len(q)))
            keep = np.arange(len(at)) - starts[at] < k
            full = np.flatnonzero(np.diff(np.append(starts, len(at))) >= k)
            kth = starts[full] + k - 1
            # Rows found are not worse than the floor, so their k-th is not either.
            worst[full], last[full], unset[full] = scores[kth], ids[kth], False
            at, scores, ids = at[keep], scores[keep], ids[keep]

        def open_for(node: int, asked: np.ndarray) -> np.ndarray:
            bound, least = bounds[asked, node].astype(np.int64), self.first_id[node]
            return asked[unset[asked] | (bound > worst[asked]) | ((bound == worst[asked]) & (least <= last[asked]))]

        def entry(node: int, asked: np.ndarray) -> tuple:
            return -int(bounds[asked, node].max()), int(self.first_id[node]), node, asked

        heap = [entry(0, np.arange(len(q)))] if len(q) else []
        while heap:
            _, _, node, asked = heapq.heappop(heap)
            if not len(asked := open_for(node, asked)):
                continue
            a, z, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, entry(child, asked))
                continue
            got = q[asked] @ rows[a:z].T
            # In the products' own kind the floor is exact too: it is one of them, or their bound.
            i, j = np.nonzero((got >= worst[asked].astype(got.dtype)[:, None]) | unset[asked][:, None])
            found, query, row = got[i, j].astype(np.int64), asked[i], j + a
            new = self.ids[row]
            able = (self.uids[row] != own[query]) & (unset[query] | (found > worst[query]) | (new <= last[query]))
            wait.append((query[able], found[able], new[able]))
            waiting += len(wait[-1][0])
            if waiting >= WAITING or unset[asked].any():
                merge()
        if wait:
            merge()
        starts = np.searchsorted(at, np.arange(len(q) + 1))
        for i in range(len(q)):
            yield i, scores[starts[i] : starts[i + 1]], ids[starts[i] : starts[i + 1]]


ROW = "kind int, shard int, dim int, uid long, query_id long, vec_id long, score long, bound long, data binary"
KINDS = {"tree": 0, "query": 1, "hit": 2, "box": -1}


def _rows(kind: str, n: int, **given) -> pa.RecordBatch:
    names = {"shard": pa.int32(), "dim": pa.int32(), "uid": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "bound": pa.int64(), "data": pa.binary()}
    cols = [pa.array([KINDS[kind]] * n, pa.int32())]
    cols += [pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in names.items()]
    return pa.RecordBatch.from_arrays(cols, ["kind", *names])


def _hits(found, uids, query_ids) -> Iterator[pa.RecordBatch]:
    """Found rows of many queries in batches of about BATCH_ROWS."""
    wait, rows = [], 0
    for i, scores, ids in found:
        if len(scores):
            wait.append((i, scores, ids))
            rows += len(scores)
        if rows >= BATCH_ROWS:
            yield _hit_rows(wait, uids, query_ids)
            wait, rows = [], 0
    if wait:
        yield _hit_rows(wait, uids, query_ids)


def _hit_rows(wait, uids, query_ids) -> pa.RecordBatch:
    at = np.repeat([i for i, _, _ in wait], [len(s) for _, s, _ in wait])
    scores, ids = (np.concatenate(x) for x in list(zip(*wait))[1:])
    return _rows("hit", len(at), uid=np.asarray(uids, np.int64)[at], query_id=np.asarray(query_ids, np.int64)[at], vec_id=ids, score=scores)


def _build(k: int, every: int):
    """Rows sorted by (dim, shard): the tree and root box of each shard, its own queries' best
    rows in it, and those queries with their k-th (score, id) so far."""

    def shard_rows(key, parts) -> Iterator[pa.RecordBatch]:
        dim, shard = key
        ids, uids, vectors = (np.concatenate(x) for x in zip(*parts))
        tree = Tree(ids, uids, vectors)
        yield _rows("tree", 1, shard=[shard], dim=[dim], data=[pickle.dumps(tree)])
        yield _rows("box", 1, shard=[shard], dim=[dim], data=[np.concatenate([tree.low[0], tree.high[0]]).astype(np.int64).tobytes()])
        asked = np.flatnonzero(ids % every == 0)
        if not len(asked):
            return
        found = list(tree.search(vectors[asked], uids[asked], [None] * len(asked), k))
        yield from _hits(found, uids[asked], ids[asked])
        reached = {i: (s[-1], n[-1]) for i, s, n in found if len(s) == k}
        for i, row in enumerate(asked):
            score, last = reached.get(i, (None, None))
            yield _rows("query", 1, shard=[shard], dim=[dim], uid=[int(uids[row])], query_id=[int(ids[row])], vec_id=[None if last is None else int(last)], score=[None if score is None else int(score)], data=[narrow(vectors[row]).tobytes()])

    def run(batches):
        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            dims, shards = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            flat = batch.column("v").flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(dims, dtype=np.int64)])
            cuts = np.flatnonzero((np.diff(dims, prepend=dims[0] - 1) != 0) | (np.diff(shards, prepend=shards[0] - 1) != 0))
            for a, z in zip(cuts, [*cuts[1:], batch.num_rows]):
                now = (int(dims[a]), int(shards[a]))
                if now != key and parts:
                    yield from shard_rows(key, parts)
                    parts = []
                key = now
                vectors = flat[ends[a] : ends[z]].reshape(z - a, now[0])
                parts.append((batch.column("vec_id").to_numpy()[a:z], batch.column("uid").to_numpy()[a:z], vectors))
        if parts:
            yield from shard_rows(key, parts)

    return run


def _visit(k: int):
    """Rows sorted by (dim, shard, group) with the tree first in each group."""

    def answer(tree, asked) -> Iterator[pa.RecordBatch]:
        if tree is None or not asked:
            return
        uids, query_ids, floors, data = zip(*asked)
        queries = unpacked(data, tree.vectors.shape[1])
        yield from _hits(tree.search(queries, np.full(len(uids), -1), list(floors), k), uids, query_ids)

    def run(batches):
        tree, asked = None, []
        for batch in batches:
            for kind, uid, query_id, vec_id, score, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "uid", "query_id", "vec_id", "score", "data"))):
                if kind == KINDS["tree"]:
                    yield from answer(tree, asked)
                    tree, asked = pickle.loads(data), []
                else:
                    asked.append((uid, query_id, None if score is None else (score, vec_id), data))
        yield from answer(tree, asked)

    return run


def _prune():
    """Rows sorted by (dim, block, group) with the root boxes first in each group:
    each query once per shard whose box may hold a row that is not worse than its
    k-th so far, with that bound; its own shard is left out."""

    def pairs(shards, boxes, asked) -> Iterator[pa.RecordBatch]:
        low, high = np.split(np.array(boxes), 2, axis=1)
        largest = max(abs(float(low.min())), abs(float(high.max())))
        shards = np.array(shards)
        for start in range(0, len(asked), SEARCHED):
            homes, uids, query_ids, last, scores, dims, data = zip(*asked[start : start + SEARCHED])
            q = unpacked(data, low.shape[1])
            kind = product_kind(q, largest)
            bounds = box_bounds(q.astype(kind), low.astype(kind), high.astype(kind)).astype(np.int64)
            least = np.array([np.iinfo(np.int64).min if x is None else x for x in scores])
            query, box = np.nonzero((shards != np.array(homes)[:, None]) & (bounds >= least[:, None]))
            for a in range(0, len(query), BATCH_ROWS):
                i, j = query[a : a + BATCH_ROWS], box[a : a + BATCH_ROWS]
                take = lambda values: [values[n] for n in i]
                yield _rows("query", len(i), shard=shards[j], dim=take(dims), uid=take(uids), query_id=take(query_ids), vec_id=take(last), score=take(scores), bound=bounds[i, j], data=take(data))

    def run(batches):
        key, shards, boxes, asked = None, [], [], []
        names = ("kind", "dim", "block", "group", "shard", "uid", "query_id", "vec_id", "score", "data")
        for batch in batches:
            for kind, dim, block, group, shard, uid, query_id, vec_id, score, data in zip(*(batch.column(c).to_pylist() for c in names)):
                if (dim, block, group) != key:
                    if asked:
                        yield from pairs(shards, boxes, asked)
                    key, shards, boxes, asked = (dim, block, group), [], [], []
                if kind == KINDS["box"]:
                    shards.append(shard)
                    boxes.append(np.frombuffer(data, np.int64))
                else:
                    asked.append((shard, uid, query_id, vec_id, score, dim, data))
        if asked:
            yield from pairs(shards, boxes, asked)

    return run


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v: floor(scale * component); rows with a null id, vector or
    component, or a component that is not finite, are left out."""
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled: Column = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & whole).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def space_cells(vectors: DataFrame) -> dict[int, Cells]:
    """Per vector length with more rows than a shard, cells from a sample of about
    SAMPLE_ROWS of all rows."""
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    large = {dim: n for dim, n in sizes.items() if n > SHARD_ROWS}
    if not large:
        return {}
    share = min(1.0, SAMPLE_ROWS / sum(large.values()))
    drawn = F.pmod(F.xxhash64("uid", F.lit("cells")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = vectors.where(F.col("dim").isin(*large) & drawn).select("dim", "v").collect()
    rows = {dim: np.array([r["v"] for r in sample if r["dim"] == dim], np.int64) for dim in large}
    return {dim: Cells(rows[dim], min(CELLS, -(-n // SHARD_ROWS))) for dim, n in large.items() if len(rows[dim])}


def place_in_cells(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``vectors`` with the number of their cell (0 where a length has one cell)."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            starts = batch.column("v").offsets.to_numpy()[:-1]
            values = batch.column("v").values.to_numpy()
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                if int(dim) in cells:
                    mine = np.flatnonzero(dims == dim)
                    cell[mine] = cells[int(dim)].of(values[starts[mine][:, None] + np.arange(dim)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("uid", "vec_id", "dim", "v")), pa.array(cell)], ["uid", "vec_id", "dim", "v", "cell"])

    return vectors.select("uid", "vec_id", "dim", "v").mapInArrow(tidy(run), "uid long, vec_id long, dim int, v array<long>, cell int")


def in_shards(vectors: DataFrame) -> DataFrame:
    """``vectors`` with their shard: cells in turn, a cell above SHARD_ROWS rows (equal
    vectors, or more cells than CELLS needed) in as many shards as it fills."""
    placed = place_in_cells(vectors, space_cells(vectors))
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("parts"))
    cells = cells.withColumn("from", F.coalesce(F.sum("parts").over(before), F.lit(0)))
    # A row per length and cell: at most CELLS for each length.
    return placed.join(F.broadcast(cells), ["dim", "cell"]).withColumn("shard", (F.col("from") + F.pmod(F.xxhash64("uid"), F.col("parts"))).cast("int"))


def grouped_queries(queries: DataFrame, *keys: str) -> DataFrame:
    """``queries`` in groups of about GROUP_QUERIES per vector length (and ``keys``)."""
    groups = queries.groupBy("dim", *keys).agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("groups"))
    # A row per length, or length and shard.
    return queries.join(F.broadcast(groups), ["dim", *keys]).withColumn("group", F.pmod(F.xxhash64("uid"), F.col("groups")).cast("int")).drop("groups")


def open_pairs(built: DataFrame) -> DataFrame:
    """Pairs of query and shard (not its own) that the root boxes leave open."""
    width = shuffle_width(built.sparkSession)
    boxes, queries = (built.where(F.col("kind") == KINDS[kind]) for kind in ("box", "query"))
    boxes = boxes.withColumn("block", F.floor(F.col("shard") / BOX_BLOCK).cast("int"))
    queries = grouped_queries(queries)
    # A block of boxes meets a group of queries: block and group numbers travel, not pairs of rows.
    asked = queries.join(boxes.select("dim", "block").distinct(), "dim")
    hosts = boxes.join(queries.select("dim", "group").distinct(), "dim")
    met = asked.unionByName(hosts).repartition(width, "dim", "block", "group").sortWithinPartitions("dim", "block", "group", "kind")
    return met.mapInArrow(tidy(_prune()), ROW)


def visit(built: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Best rows of the pairs' shards that are not worse than the queries' floors. A
    tree is sent once for each group of its own queries, not of all pairs."""
    width = shuffle_width(built.sparkSession)
    pairs = grouped_queries(pairs, "shard")
    hosts = built.where(F.col("kind") == KINDS["tree"]).join(pairs.select("dim", "shard", "group").distinct(), ["dim", "shard"])
    visits = pairs.unionByName(hosts).repartition(width, "dim", "shard", "group").sortWithinPartitions("dim", "shard", "group", "kind")
    return visits.mapInArrow(tidy(_visit(k)), ROW)


def top_inner_products(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible
    by ``every``, its k largest integer inner products with all other rows.

    Vectors are compared with those of the same length only. Equal scores are
    ranked by the smaller id; fewer than k other rows give fewer. Rows repeated
    with one id are rows of their own, both as queries and as candidates.
    Vectors without components, null or not finite take no part; an empty
    table gives no rows; other columns are not looked at. Scores and box bounds
    are 64-bit: components whose products exceed that are not supported.
    """
    vectors = integer_vectors(df, id_col, vector_col, scale).where(F.size("v") > 0)
    vectors = staged(vectors.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("v").alias("dim"), "v"), "knn-vectors")
    built = in_shards(vectors).select("dim", "shard", "uid", "vec_id", "v").repartition(shuffle_width(df.sparkSession), "dim", "shard").sortWithinPartitions("dim", "shard")
    built = staged(built.mapInArrow(tidy(_build(k, every)), ROW), "knn-trees")

    best_bound = Window.partitionBy("uid").orderBy(F.desc("bound"), "shard")
    pairs = staged(open_pairs(built).withColumn("turn", F.row_number().over(best_bound)), "knn-pairs")
    ranked = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    first = visit(built, pairs.where(F.col("turn") <= FIRST_WAVE).drop("turn"), k)
    best = built.where(F.col("kind") == KINDS["hit"]).unionByName(first).select("uid", "query_id", "vec_id", "score")
    best = staged(best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "knn-first")

    kth = best.where(F.col("rank") == k).select("uid", F.col("score").alias("least"), F.col("vec_id").alias("last"))
    left = pairs.where(F.col("turn") > FIRST_WAVE).drop("turn").join(kth, "uid", "left").where("least IS NULL OR bound >= least")
    left = left.withColumn("score", F.coalesce("least", "score")).withColumn("vec_id", F.coalesce("last", "vec_id")).drop("least", "last")
    found = best.drop("rank").unionByName(visit(built, left, k).select("uid", "query_id", "vec_id", "score"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
