import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from gridcast.llm import partenum
from gridcast.llm.partenum import Bands, jaccard_join, one_per_component
from tests.llm.data import documents, rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(given):
    sets = [(i, shingles(t)) for i, t in given]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def test_matches_brute_force(spark):
    got = jaccard_join(documents(spark)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows())


def test_random_edits_match_brute_force(spark):
    rng = random.Random(3)
    given = []
    for g in range(25):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 140))]
        for k in range(6):
            near = list(base)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(near))
                near[at : at + 1] = rng.choice([[], [f"e{rng.randrange(9)}"], [near[at], "plus"]])
            given.append((g * 10 + k, " ".join(near)))
    got = jaccard_join(documents(spark, given)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(given)


@pytest.mark.parametrize("at_once", [4 << 20, 300])
def test_members_that_only_meet_beside_their_centre_are_linked(spark, monkeypatch, at_once):
    """Signature holders whose smallest id is similar to none of them; with few
    elements per task, the elements are joined by Spark."""
    monkeypatch.setattr(partenum, "COMPARED", at_once)
    rng = random.Random(9)
    base = [f"p{i}" for i in range(100)]
    centre = base[:78] + [f"c{i}" for i in range(22)]
    other = base[:78] + [f"o{i}" for i in range(22)]
    given = [(1, " ".join(centre))]
    for i in range(2, 12):
        near = list(other)
        near[rng.randrange(78, 100)] = f"z{i}"
        given.append((i, " ".join(near)))
    got = jaccard_join(documents(spark, given)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(given)


def near_copies_that_cover(centre, x, y):
    """The centre with, each time, the content that x and y have in one partition."""
    bands, out = Bands(80, 100), []
    coded = {w: next(partenum.shingle_sets(pa.array([w]), 1))[0] for w in {*centre, *x, *y}}
    band = len(y).bit_length() - 1
    seed = partenum.mix(np.array([band + 1], np.uint64) * partenum._SECOND)
    part = {w: int((partenum.mix(np.array([h]) ^ seed) % np.uint64(bands.parts(band)))[0]) for w, h in coded.items()}
    inside = lambda words, n: {w for w in words if part[w] == n}
    for n in sorted(set(part.values())):
        if inside(x, n) and inside(x, n) == inside(y, n) != inside(centre, n):
            out.append((len(out), [w for w in centre if part[w] != n] + sorted(inside(x, n))))
    return out


@pytest.mark.parametrize("at_once", [4 << 20, 16_000])
def test_a_longer_linked_member_is_compared_with_a_shorter_one(spark, monkeypatch, at_once):
    """x is near y only, y also near the centre and further from it in elements;
    near copies with smaller ids hold every signature that x and y share."""
    monkeypatch.setattr(partenum, "COMPARED", at_once)
    centre = [f"p{i}" for i in range(1000)]
    x = centre[165:] + [f"e{i}" for i in range(65)]
    y = centre[66:] + [f"e{i}" for i in range(166)]
    given = near_copies_that_cover(centre, x, y) + [(5000, centre), (6000, x), (6001, y)]
    sets = {i: set(s) for i, s in given}
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert similar(sets[6000], sets[6001]) and not any(similar(sets[6000], s) for i, s in sets.items() if i < 6000)
    assert len(given) > 60 and all(similar(sets[0], s) for i, s in sets.items() if i != 6000)
    got = jaccard_join(documents(spark, [(i, " ".join(s)) for i, s in given]), words=1).collect()
    assert {r.component_id for r in got} == {0}


def test_similar_sets_share_as_many_signatures_as_promised():
    bands, rng = Bands(80, 100), np.random.default_rng(0)
    for _ in range(300):
        size = int(rng.integers(4, 400))
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        gone = int(rng.integers(0, size // 5 + 1))
        fresh = int(rng.integers(0, size // 5 + 1))
        b = np.concatenate([a[gone:], rng.integers(0, 2**63, fresh, dtype=np.uint64)])
        both, union = size - gone, size + fresh
        if 100 * both < 80 * union:
            continue
        left, right = ({(band, int(s)): need for band, need, sigs in bands.signatures(np.unique(x)) for s in sigs} for x in (a, b))
        shared = left.keys() & right.keys()
        if size == both == union:
            continue
        assert any(sum(band == s[0] for s in shared) >= need for (band, _), need in left.items() if band < 64)


def test_one_row_per_component_stays(spark):
    docs = documents(spark)
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    want = sorted(str(i) for i, _, c in brute(rows()) if i is None or i == c)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(spark):
    assert jaccard_join(documents(spark, [])).count() == 0


def test_group_of_near_copies_in_many_parts_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(partenum, "COMPARED", 400)
    rng = random.Random(5)
    base = [f"p{i}" for i in range(90)]
    given = []
    for i in range(60):
        near = list(base)
        for _ in range(rng.randrange(0, 7)):
            near[rng.randrange(90)] = f"e{rng.randrange(40)}"
        given.append((i, " ".join(near)))
    got = jaccard_join(documents(spark, given)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(given)


def test_links_inside_a_group_equal_all_pairs():
    rng = np.random.default_rng(4)
    for seed in range(30):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(20, 200)), dtype=np.uint64))
        pool = rng.integers(0, 2**63, 30, dtype=np.uint64)
        sets = []
        for _ in range(25):
            keep = base[rng.random(len(base)) > rng.random() * 0.3]
            sets.append(np.unique(np.concatenate([keep, rng.choice(pool, int(rng.integers(0, 12)))])))
        sets = [s for s in sets if len(s)]
        centre = sets[0]
        members = [partenum._Apart(i, i, s, centre, 80, 100) for i, s in enumerate(sets) if i]
        found = {tuple(sorted(l)) for l in partenum._links_inside(members, 80, 100)}
        similar = lambda i, j: partenum._similar(sets[i], sets[j], 80, 100)
        near = {i for i in range(1, len(sets)) if similar(0, i)}
        want = {(i, j) for i, j in combinations(range(1, len(sets)), 2) if similar(i, j)}
        # Pairs that are both linked with the centre are connected already.
        assert {l for l in want if not set(l) <= near} <= found <= want


def far_from_their_centre(members):
    """A centre similar to none, and sets that are all similar to one another."""
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**62, 120, dtype=np.uint64))
    centre = np.unique(np.concatenate([base[:60], rng.integers(2**62, 2**63, 60, dtype=np.uint64)]))
    return centre, [np.unique(np.append(base, np.uint64(2**63 + i))) for i in range(members)]


def joined_by(pairs, nodes):
    joined = partenum._Joined()
    for a, b in pairs:
        if joined.root(a) != joined.root(b):
            joined.join(a, b)
    return len({joined.root(n) for n in nodes})


def group_rows(centre, sets, labels):
    def column(own, *others):
        return pa.array([own, *others])

    n = len(sets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([0] * (n + 1)),
            pa.array([0] * (n + 1)),
            pa.array([1] * (n + 1)),
            column(True, *[False] * n),
            column(0, *range(1, n + 1)),
            column(None, *labels),
            column(centre.tobytes(), *[s.tobytes() for s in sets]),
        ],
        ["centre", "salt", "salts", "own", "rep", "label", "elements"],
    )


@pytest.mark.parametrize("members", [20, 80])
def test_a_group_gives_fewer_links_than_members(members):
    centre, sets = far_from_their_centre(members)
    (made,) = partenum._apart_rows(80, 100)([group_rows(centre, sets, range(1, members + 1))])
    links = list(zip(made.column("a").to_pylist(), made.column("b").to_pylist()))
    assert len(links) == members - 1
    assert joined_by(links, range(1, members + 1)) == 1


def test_spanning_links_join_what_all_links_join():
    rng = np.random.default_rng(6)
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(20, 200)), dtype=np.uint64))
        pool = rng.integers(0, 2**63, 30, dtype=np.uint64)
        sets = []
        for _ in range(25):
            keep = base[rng.random(len(base)) > rng.random() * 0.3]
            sets.append(np.unique(np.concatenate([keep, rng.choice(pool, int(rng.integers(0, 12)))])))
        sets = [s for s in sets if len(s)]
        labels = rng.integers(0, 12, len(sets)).tolist()  # some lie in one component already
        members = [partenum._Apart(i, labels[i], s, sets[0], 80, 100) for i, s in enumerate(sets) if i]
        every, spanning = partenum._links_inside(members, 80, 100), partenum._links_inside(members, 80, 100, spanning=True)
        of_labels = lambda links: [(labels[a], labels[b]) for a, b in links]  # noqa: E731, B023
        assert {tuple(sorted(l)) for l in spanning} <= {tuple(sorted(l)) for l in every}
        assert len(spanning) < len({m.label for m in members})
        assert joined_by(of_labels(every), labels) == joined_by(of_labels(spanning), labels)


def test_a_group_of_many_parts_is_joined_without_all_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(partenum, "COMPARED", 500)
    members = 60
    centre, sets = far_from_their_centre(members)
    compared, verify = [], partenum._verify

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(partenum, "_verify", counted)
    elements = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate([centre, *sets])], "rep long, elements binary")
    groups = spark.createDataFrame([(0, i, i) for i in range(1, members + 1)], "a long, b long, label long")
    links = [tuple(r) for r in partenum._links_beside_centres(groups, elements, 80, 100).collect()]
    assert joined_by(links, range(1, members + 1)) == 1
    assert len(links) < 2 * members and sum(compared) < 2 * members
