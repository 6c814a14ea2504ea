import hashlib
from collections import defaultdict

import pytest

from gridcast.llm.dedup import content_sort
from tests.llm.data import documents, rows


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_matches_brute_force_with_runs_over_many_partitions(spark, keep):
    given = rows()
    got = content_sort(documents(spark), keep=keep, carry=["text", "source"], partitions=7).collect()
    groups = defaultdict(list)
    for i, t in given:
        groups[t or ""].append(i)
    low = lambda i: (i is not None, i or 0)
    assert len(got) == len(given)
    kept = defaultdict(int)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        text = by_sha[r.text_sha256]
        want = (max if keep == "largest" else min)(groups[text], key=low)
        assert (r.keep_id, r.group_size) == (want, len(groups[text]))
        if r.kept:
            kept[text] += 1
            assert r.doc_id == want and (r.text or "") == text
        else:
            assert r.text is None
    assert kept == {t: 1 for t in groups}


def test_one_text_in_all_rows_is_spread_and_stitched(spark):
    got = content_sort(documents(spark, [(i, "same") for i in range(500)]), partitions=8).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(499, 500)}
    assert [r.doc_id for r in got if r.kept] == [499]


def test_empty_table(spark):
    assert content_sort(documents(spark, [])).count() == 0
