"""Merkle manifest against a plain recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gridcast.llm.manifest import fold, manifest_report, merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, tree string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(last node, siblings left and right of every leaf, level by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            a = at[i] // 8 * 8
            run = nodes[a : a + 8]
            p.append(("".join(run[: at[i] - a]), "".join(run[at[i] - a + 1 :])))
            at[i] //= 8
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def expected(rows):
    leaf = {r: sha("".join(map(field, r[:5]))) for r in rows}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    subs, paths, order = [], {}, {}
    for g in langs:
        order[g] = sorted([r for r in rows if r[2] == g], key=lambda r: (r[0] is not None, r[0] or 0, leaf[r]))
        top, p = climb([leaf[r] for r in order[g]])
        subs.append(top)
        paths[g] = p
    root, upper = climb(subs)
    out = []
    for k, g in enumerate(langs):
        for r, p in zip(order[g], paths[g]):
            steps = p + upper[k]
            struck = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            now = sha("".join(map(field, (*r[:4], r[4].translate(low) if struck else r[4]))))
            for a, b in steps:
                now = sha(a + now + b)
            out.append((r[0], leaf[r], subs[k], root, sha("".join(a + b for a, b in steps)), now, now == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,groups", [(1, 1), (9, 1), (700, 1), (300, 20), (40, 40)])
def test_report_equals_the_recursion(spark, n, groups):
    rows = [(i, f"s{i}" if i % 7 else None, None if i % groups == 0 else f"l{i % groups}é", i, None if i % 11 == 0 else f"Text Ä {i}", "x", "y") for i in range(n)]
    got = sorted([tuple(r) for r in manifest_report(spark.createDataFrame(rows, SCHEMA)).collect()], key=str)
    assert got == expected(rows)


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(None, None, None, None, None, None, None), (5, "", "", 0, "", None, None), (5, "", "", 0, "", None, None), (5, "", "", 1, "Z" * 200_000, None, None)] + [(3, "a", "en", 1, "Same", None, None)] * 30
    got = sorted([tuple(r) for r in manifest_report(spark.createDataFrame(rows, SCHEMA)).collect()], key=str)
    assert [g[1] for g in got] == [e[1] for e in expected_many(rows)]
    assert got == expected_many(rows)


def expected_many(rows):
    """``expected`` tells rows apart by their values; equal rows get marks that do not reach the digests."""
    marked = [(*r[:5], i) for i, r in enumerate(rows)]
    return expected(marked)


def test_paths_fold_to_the_root_and_empty_table(spark):
    df = spark.createDataFrame([(i, "s", f"l{i % 3}", i, f"T{i}", "", "") for i in range(100)], SCHEMA)
    rows = merkle_manifest(df, ["doc_id", "text"], fanout=4).withColumn("again", fold(F.col("leaf"), F.col("path")))
    assert rows.where("again <> root").count() == 0 and rows.select("root").distinct().count() == 1
    assert manifest_report(df.limit(0)).count() == 0
