"""Conversation repair against plain strings, exhaustive search and given cases."""

import hashlib
import itertools
import random

from gridcast.llm.conversations import EditLists, audit_conversations, cheapest_edits, damaged, repair_report, repaired_rows

SCHEMA = "conv_id long, turn long, role string, text string, conv string, audit string"
LEGAL = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]


def ways(rows):
    """Every edit of ``rows`` with at most three inserts in a row, as (cost, letters)."""

    def go(i, state, run):
        if i == len(rows) and state in (0, 3):
            yield 0, ""
        if run < 3:
            for initial in "ua":
                if initial in LEGAL[state]:
                    for c, a in go(i, LEGAL[state][initial], run + 1):
                        yield c + 2, "I" + a
        if i < len(rows):
            initial, gone, cut = rows[i]
            for c, a in go(i + 1, state, 0):
                yield c + 3, "D" + a
            if not gone:
                if initial in LEGAL[state]:
                    for c, a in go(i + 1, LEGAL[state][initial], 0):
                        yield c + cut, "K" + a
                for new in "ua":
                    if new in LEGAL[state]:
                        for c, a in go(i + 1, LEGAL[state][new], 0):
                            yield c + 2 + cut, "R" + a

    return go(0, 0, 0)


def test_every_short_conversation_against_all_edits():
    for n in range(4):
        for initials in itertools.product(["s", "u", "a", "x"], repeat=n):
            for gone in range(2**n):
                rows = [(c, bool(gone >> i & 1), (i + gone) % 3 == 0 and not gone >> i & 1) for i, c in enumerate(initials)]
                assert cheapest_edits(rows) == min(ways(rows))


def test_long_conversations_against_plain_strings():
    rng = random.Random(3)
    for n in (40, 200):
        rows = [(rng.choice("suax"), rng.random() < 0.2, False) for _ in range(n)]
        best = {0: (0, ""), 3: (0, ""), 2: (2, "I"), 1: (4, "II")}
        for initial, gone, cut in reversed(rows):
            now = {}
            for q in range(4):
                now[q] = [(best[q][0] + 3, "D" + best[q][1])]
                if not gone:
                    now[q] += [(best[to][0], "K" + best[to][1]) for c, to in LEGAL[q].items() if c == initial]
                    now[q] += [(best[to][0] + 2, "R" + best[to][1]) for c, to in LEGAL[q].items() if c != "s"]
            for _ in range(3):
                for q in range(4):
                    now[q] += [(c + 2, "I" + a) for x, to in LEGAL[q].items() if x != "s" for c, a in now[to][:1]]
                    now[q] = [min(now[q])]
            best = {q: v[0] for q, v in now.items()}
        assert cheapest_edits(rows) == best[0]


def test_lists_compare_as_strings_even_when_all_hashes_collide():
    for collide in (False, True):
        lists, rng, made = EditLists(), random.Random(5), {}
        for _ in range(300):
            text, node = "", 0
            for c in (rng.choice("DK") for _ in range(rng.randint(0, 9))):
                text, node = c + text, lists.put(c, node)
            made[text] = node
        if collide:
            lists.hash = [[*h[:1], *[0] * (len(h) - 1)] for h in lists.hash]
        for a, b in itertools.product(list(made)[:80], repeat=2):
            assert lists.less(made[a], made[b]) == (a < b)
            assert lists.text(made[a]) == a


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [
        (1, None, "user", "Hi.", "x", "y"),
        (1, 0, "assistant", "Yes", None, None),
        (1, 0, "assistant", "Yes", None, None),
        (1, 5, None, None, None, None),
        (None, None, None, None, None, None),
        (2, 1, "", "Odd.", None, None),
        (3, 1, "user", "x" * 100_000 + ".", None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.conv: r for r in audit_conversations(df).collect()}
    assert (found[1].gaps, found[1].blank, found[1].duplicate, found[1].truncated) == (4, 1, 1, 1)
    assert found[1].audit == "KKDD" and found[1].cost == 7
    assert found[None].blank == 1 and found[None].audit == "D"
    assert found[2].audit == "D" and found[2].cost == 3
    assert found[3].audit == "KI" and found[3].cost == 2
    fixed = repaired_rows(df, audit_conversations(df)).orderBy("conv", "position").collect()
    assert [(r.conv, r.role, len(r.text)) for r in fixed] == [(1, "user", 3), (1, "assistant", 3), (3, "user", 100_001), (3, "assistant", 0)]
    assert audit_conversations(df.limit(0)).count() == 0 and repair_report(df.limit(0)).count() == 0


def test_conversation_without_rows_after_the_damage(spark):
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.", None, None)], SCHEMA)
    assert damaged(df).count() == 0
    row = repair_report(df).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
