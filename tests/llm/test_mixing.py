import hashlib
import re
from collections import Counter, defaultdict

import pytest

from gridcast.llm.mixing import mix_sources, mixed_rows, water_fill
from tests.llm.data import documents, rows


def test_targets_share_what_the_cap_cuts():
    targets = water_fill([("a", 100), ("b", 1000), (None, 10)])
    assert targets["a"] == 200 and targets[None] == 20
    assert sum(targets.values()) == pytest.approx(1.5 * 1110)
    assert water_fill([("a", 0)]) == {"a": 0.0}


def brute(docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    key = lambda r: int(hashlib.md5(f"{'null' if r.doc_id is None else r.doc_id}:{r.text or ''}".encode()).hexdigest()[:15], 16)
    sums = Counter()
    for r in docs:
        sums[r.source] += size(r.text)
    targets = water_fill(list(sums.items()))
    out = []
    for source, n in sums.items():
        base = int(targets[source] // n) if n else 0
        left, ties = targets[source] - base * n, defaultdict(list)
        for r in docs:
            if r.source == source:
                ties[key(r)].append(r)
        done, open_ = 0, True
        for h in sorted(ties):
            more = sum(size(r.text) for r in ties[h])
            take = open_ and (done + more <= left or abs(done + more - left) < abs(done - left))
            if done + more > left:
                open_ = False
            done += more
            out += [(r.doc_id, size(r.text), n, size(r.text) * min(2, base + take), min(2, base + take)) for r in ties[h]]
    return Counter(out), targets


def test_matches_brute_force(spark):
    docs = documents(spark).cache()
    want, targets = brute(docs.collect())
    got = mix_sources(docs).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, r.taken, r.copies) for r in got) == want
    taken = Counter()
    for r in got:
        assert r.taken <= 2 * r["size"]
        taken[r.target] += r.taken
    repeated = Counter((r.doc_id, r.text) for r in mixed_rows(docs).collect())
    copies = Counter()
    for r in got:
        copies[r.doc_id] += r.copies
    found = Counter()
    for (i, _), n in repeated.items():
        found[i] += n
    assert +copies == +found


def test_empty_table(spark):
    assert mix_sources(documents(spark, [])).count() == 0 and mixed_rows(documents(spark, [])).count() == 0
