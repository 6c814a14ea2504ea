"""Decontamination against plain word lists."""

import hashlib
import random
import re

from gridcast.llm import decontamination
from gridcast.llm.decontamination import contamination, contamination_report, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string, hash string, w string", "item_id long, text string, n string"


def words(s):
    return WORD.findall((s or "").translate(LOW))


def expected(docs, items):
    windows = {}
    for item, text, _ in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    ids |= {str(x) for x in windows[tuple(w[i : i + n])] if x is not None}
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["alpha", "Beta", "ÄRA", "d4", "e"]) for _ in range(n))
    items = [(i, text(14), None) for i in range(9)] + [(10, "Only, three words", None), (11, "one", None), (2, text(12), None), (None, text(11), None), (12, "", None), (13, None, None), (14, " -- ", None)]
    docs = [(i, text(30) + ". " + items[i % 9][1].upper() + "! " + text(5), "x", "y") for i in range(12)]
    docs += [(20, None, "", ""), (21, "", "", ""), (22, "?!", "", ""), (None, "so ONE only three-words", "", ""), (3, "one", "", ""), (3, "one", "", "")]
    docs += [(30, text(9000) + " " + items[4][1], "", ""), (31, items[0][1], "", "")] + [(40 + i, docs[1][1], "", "") for i in range(40)]
    return docs, items, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)


def test_report_equals_plain_word_lists(spark):
    docs, items, df, bench = tables(spark)
    got = sorted([tuple(r) for r in contamination_report(df, bench).collect()], key=str)
    assert got == expected(docs, items)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    docs, items, df, bench = tables(spark)
    monkeypatch.setattr(decontamination, "BLOCK", 7)
    got = sorted([tuple(r) for r in contamination_report(df, bench).collect()], key=str)
    assert got == expected(docs, items)


def test_equal_hashes_are_told_apart_by_their_words(spark, monkeypatch):
    docs, items, df, bench = tables(spark)
    real = decontamination.F.xxhash64
    monkeypatch.setattr(decontamination.F, "xxhash64", lambda *c: decontamination.F.pmod(real(*c), decontamination.F.lit(50)) if len(c) > 2 else real(*c))
    got = sorted([tuple(r) for r in contamination_report(df, bench).collect()], key=str)
    assert got == expected(docs, items)


def test_removal_of_documents_and_spans(spark):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"
    docs = [(1, f"Before it: {item.upper()}, after."), (2, "clean text"), (3, item), (4, None), (5, f"{item} x {item}")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate(df, bench).collect()) == [2, 4]
    cut = {r.doc_id: r.text for r in decontaminate(df, bench, remove="spans").collect()}
    assert cut == {1: "Before it: , after.", 2: "clean text", 3: "", 4: None, 5: " x "}
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in contamination(df, bench).collect()}
    assert spans[5] == [(0, 10), (11, 21)] and spans[2] == []


def test_empty_tables(spark):
    _, _, df, bench = tables(spark)
    assert contamination_report(df.limit(0), bench).count() == 0
    assert contamination_report(df, bench.limit(0)).where("contaminated OR n_items > 0").count() == 0
