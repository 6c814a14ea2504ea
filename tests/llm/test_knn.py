import math
from collections import defaultdict

import numpy as np

from gridcast.llm import knn
from gridcast.llm.knn import top_inner_products


def brute(given, k, every):
    able = [(i, tuple(math.floor(64 * float(np.float32(x))) for x in v)) for i, v in given if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(able):
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(able) if m != n and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def frame(spark, given):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in given], "vec_id long, embedding array<float>, uid string, dim int, shard int").repartition(3)


def test_matches_brute_force_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(knn, "SHARD_ROWS", 60)
    monkeypatch.setattr(knn, "GROUP_QUERIES", 5)
    rng = np.random.default_rng(0)
    given = [(i, rng.normal(0, 0.4, 8).tolist()) for i in range(400)]
    given += [(400 + i, [0.5] * 8) for i in range(200)]  # ties
    given += [(1000, None), (1020, [0.1, None]), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (None, [0.1] * 8), (1080, []), (1100, [0.25, 0.5]), (1101, [1.0, 1.0]), (40, [0.5] * 8)]
    got = top_inner_products(frame(spark, given), k=7, every=20).collect()
    assert sorted(tuple(r) for r in got) == brute(given, 7, 20)


def test_few_pairs_of_query_and_shard_stay_open_on_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(knn, "SHARD_ROWS", 50)
    monkeypatch.setattr(knn, "FIRST_WAVE", 1)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 2, (16, 6))
    given = [(i, (centres[i % 16] + rng.normal(0, 0.05, 6)).tolist()) for i in range(1600)]
    given += [(2000 + i, centres[3].tolist()) for i in range(300)]  # one cell fills several shards
    sent = []
    visit = knn.visit
    monkeypatch.setattr(knn, "visit", lambda built, pairs, k: (sent.append((pairs.count(), built.where("kind = 0").count(), built.where("kind = 1").count())), visit(built, pairs, k))[1])
    got = top_inner_products(frame(spark, given), k=5, every=20).collect()
    assert sorted(tuple(r) for r in got) == brute(given, 5, 20)
    (first, shards, queries), (second, _, _) = sent
    assert shards >= 32 and first <= queries and first + second < queries * (shards - 1) / 3


def test_cells_take_every_vector():
    rng = np.random.default_rng(2)
    cells = knn.Cells(rng.integers(-9, 9, (500, 4)), 16)
    at = cells.of(rng.integers(-90, 90, (5000, 4)))
    assert cells.count == 16 and set(at) == set(range(16))
    same = knn.Cells(np.ones((10, 3), np.int64), 8)
    assert same.count == 1 and same.of(np.zeros((2, 3), np.int64)).tolist() == [0, 0]


def test_boxes_prune_without_losing_the_best(spark):
    rng = np.random.default_rng(1)
    ids = np.arange(3000)
    vectors = rng.integers(-64, 64, (3000, 3))
    tree = knn.Tree(ids, ids, vectors)
    query = np.array([[64, 1, -3]])
    (_, scores, found), = tree.search(query, np.array([-1]), [None], 20)
    want = np.lexsort((ids, -(vectors @ query[0])))[:20]
    assert found.tolist() == want.tolist() and scores.tolist() == (vectors @ query[0])[want].tolist()


def test_large_components_stay_exact(spark):
    given = [(0, [2.0e15, 1.0]), (1, [2.0e15, 3.0]), (2, [1.0, 1.0])]
    got = defaultdict(list)
    for r in top_inner_products(frame(spark, given[2:] + [(20, [3.0e5, 7.0]), (21, [3.0e5, -5.0])]), k=5).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    big = math.floor(64 * float(np.float32(3.0e5)))
    assert sorted(got[20])[0] == (1, 21, big * big - 64 * 7 * 64 * 5)


def test_empty_table(spark):
    assert top_inner_products(frame(spark, [])).count() == 0


def test_a_tree_is_sent_once_for_a_group_of_its_queries_in_narrow_integers(spark, monkeypatch):
    monkeypatch.setattr(knn, "SHARD_ROWS", 100)
    monkeypatch.setattr(knn, "GROUP_QUERIES", 50)
    rng = np.random.default_rng(7)
    given = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(1000)]
    sent, built = [], []
    visit, prune = knn.visit, knn.open_pairs
    monkeypatch.setattr(knn, "open_pairs", lambda b: (built.append(b), prune(b))[1])

    def visited(b, pairs, k):
        out = visit(b, pairs, k)
        trees = b.where("kind = 0").select("dim", "shard").join(knn.grouped_queries(pairs, "shard").select("dim", "shard", "group").distinct(), ["dim", "shard"])
        sent.append((pairs.count(), trees.count()))
        return out

    monkeypatch.setattr(knn, "visit", visited)
    got = top_inner_products(frame(spark, given), k=5, every=10).collect()
    assert sorted(tuple(r) for r in got) == brute(given, 5, 10)
    shards = built[0].where("kind = 0").count()
    assert sum(n for n, _ in sent) > 10 * 50 and all(trees <= 2 * shards for _, trees in sent)
    tree = built[0].where("kind = 0").selectExpr("max(length(data))").first()[0]
    assert tree < 100 * 16 * 8 and built[0].where("kind = 1").selectExpr("max(length(data))").first()[0] == 16


def test_queries_of_a_group_search_together_as_each_alone():
    rng = np.random.default_rng(3)
    ids = rng.permutation(2000) // 2  # every id twice
    vectors = rng.integers(-2, 3, (2000, 3))  # many ties
    tree = knn.Tree(ids, np.arange(2000), vectors)
    queries = rng.integers(-130, 130, (1500, 3))
    own = rng.integers(-1, 2000, 1500)
    floor = [None if i % 3 == 0 else (int((vectors @ q).max()) - i % 9, int(i)) for i, q in enumerate(queries)]
    for i, scores, found in tree.search(queries, own, floor, 7):
        all_scores = vectors @ queries[i]
        able = [(-s, j) for n, (s, j) in enumerate(zip(all_scores.tolist(), ids.tolist())) if n != own[i]]
        want = sorted(x for x in able if floor[i] is None or x <= (-floor[i][0], floor[i][1]))[:7]
        assert [(-s, j) for s, j in zip(scores.tolist(), found.tolist())] == want


def test_products_and_bytes_take_the_extremes_of_their_types():
    low = np.array([[-128, 127], [0, 1]])
    assert knn.narrow(low).dtype == np.int8 and knn.narrow(low * 2).dtype == np.int16 and knn.narrow(low << 40).dtype == np.int64
    assert knn.unpacked([knn.narrow(v).tobytes() for v in (low[0], low[1] * 300, low[0] << 40)], 2).tolist() == [[-128, 127], [0, 300], [-128 << 40, 127 << 40]]
    assert knn.product_kind(np.array([[-128, 0]]), 128.0) is np.float32 and knn.product_kind(low << 10, 2.0**20) is np.float64
    assert knn.product_kind(low << 30, 2.0**30) is np.int64
