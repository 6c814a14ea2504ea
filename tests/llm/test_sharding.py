import hashlib
import random
import zlib
from collections import defaultdict
from itertools import accumulate, combinations

from gridcast.llm import sharding
from gridcast.llm.sharding import _even, minimax_cuts, shard_rows
from tests.llm.data import documents, rows, words


def greedy(sizes, capacity):
    shards, room = 1, capacity
    for s in sizes:
        if s > capacity:
            return 10**9
        if s > room:
            shards, room = shards + 1, capacity
        room -= s
    return shards


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(sizes, mid) <= shards else (mid + 1, high)
    return low


def test_largest_shard_is_the_smallest_possible(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST", 1)  # few blocks: several levels must be refined
    monkeypatch.setattr(sharding, "STEP", 1)
    got = shard_rows(documents(spark), shards=6).collect()
    groups = defaultdict(int)
    for _, t in rows():
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 16
    sums, of = defaultdict(int), {}
    for r in got:
        sums[r.shard] += r["size"]
        assert of.setdefault(r.digest, r.shard) == r.shard  # equal texts share a shard
    assert max(sums.values()) == smallest([groups[d] for d in sorted(groups)], 6)
    order = [of[d] for d in sorted(groups)]
    assert order == sorted(order)  # contiguous in digest order


def test_slots_sizes_and_checksums(spark):
    got = shard_rows(documents(spark), shards=4).collect()
    texts = {hashlib.sha256((t or "").encode()).hexdigest(): (t or "").encode() for _, t in rows()}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r["size"] == len(texts[r.digest]) + 16 and r.text_crc32 == zlib.crc32(texts[r.digest])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == len(rows())


def test_one_hot_group_and_empty_table(spark):
    got = shard_rows(documents(spark, [(i, "same") for i in range(300)]), shards=5).collect()
    assert {r.shard for r in got} == {0} and sorted(r.slot for r in got) == list(range(300))
    assert shard_rows(documents(spark, [])).count() == 0


def most_even(sizes, shards, capacity):
    """Largest smallest shard, and with it the smallest largest one beside single groups, over all partitions within the capacity."""
    found = []
    for cuts in combinations(range(1, len(sizes)), shards - 1):
        parts = [sizes[a:z] for a, z in zip((0, *cuts), (*cuts, len(sizes)))]
        if max(map(sum, parts)) <= capacity:
            found.append((min(map(sum, parts)), [sum(p) for p in parts if len(p) > 1], parts))
    low = max(f[0] for f in found)
    return low, min(max([low, *f[1]]) for f in found if f[0] == low)


def test_cuts_are_the_evenest_within_the_capacity():
    rng = random.Random(4)
    for _ in range(60):
        sizes = [rng.choice([rng.randrange(1, 9), rng.randrange(1, 60)]) for _ in range(rng.randrange(3, 11))]
        shards = rng.randrange(1, len(sizes) + 1)
        capacity = smallest(sizes, shards)
        cuts = _even(list(accumulate(sizes)), capacity, shards)
        parts = [sizes[a:z] for a, z in zip((0, *cuts), (*cuts, len(sizes)))]
        low, most = most_even(sizes, shards, capacity)
        assert len(parts) == shards and max(map(sum, parts)) == capacity
        assert min(map(sum, parts)) == low and max([low, *(sum(p) for p in parts if len(p) > 1)]) <= max(low, most)
    assert _even([5, 9], 5, 6) == [1]


def test_a_hot_text_leaves_no_shard_empty(spark):
    given = [(i, "same" * 9) for i in range(400)] + [(1000 + i, " ".join(words(6, i))) for i in range(800)]
    got = shard_rows(documents(spark, given), shards=40).collect()
    sums = defaultdict(int)
    for r in got:
        sums[r.shard] += r["size"]
    rest = sorted(sums.values())[:-1]
    assert sorted(sums) == list(range(40)) and max(sums.values()) == 400 * 52
    assert rest[-1] < 1.25 * rest[0]


def test_cuts_of_known_sizes(spark):
    groups = spark.createDataFrame([(f"{i:064x}", s) for i, s in enumerate([7, 2, 5, 10, 8])], "digest string, bytes long")
    assert [int(c, 16) for c in minimax_cuts(groups, 2)] == [3]
