import random
import re

import duckdb
import pytest

from gridcast.llm.license_texts import NAMES, TEXTS, cc_names, templates
from gridcast.llm.licenses import oracle_sql, scan_licenses
from tests.llm.data import documents, words


def bare(text):
    return re.sub(r"[{}]", "", text)


def by_sql(given):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", given)
    cur = con.execute(oracle_sql())
    names = [c[0] for c in cur.description]
    return sorted(tuple(dict(zip(names, r))[c] for c in ("doc_id", "license", "start", "stop", "template", "found", "shingles", "containment")) for r in cur.fetchall())


def scanned(spark, given):
    return sorted(tuple(r) for r in scan_licenses(documents(spark, given)).select("doc_id", "license", "start", "stop", "template", "found", "shingles", "containment").collect())


def planted():
    given, want = [], set()
    for n, (name, text) in enumerate(templates()):
        for pad in range(4):
            i = 10 * n + pad
            given.append((i, " ".join(words(pad + 7, i)) + f" ** {bare(text).upper()}!! " + " ".join(words(9, i + 1000))))
            want.add((i, name))
    return given, want


def test_every_template_is_found_at_every_offset_and_no_relative_is(spark):
    given, want = planted()
    got = scanned(spark, given)
    assert want <= {r[:2] for r in got}
    # A text that holds another license's whole text names both; versions and clauses never mix.
    extra = {(dict((i, n) for i, n in want)[i], name) for i, name in {r[:2] for r in got} - want}
    assert all({a.split("-")[0], b.split("-")[0]} == {"ISC", "0BSD"} or a.split("-")[0] != b.split("-")[0] for a, b in extra), extra
    assert all(r[7] >= 0.8 and r[3] > r[2] for r in got)


def test_same_as_all_shingles_by_sql(spark):
    rng = random.Random(3)
    given, _ = planted()
    for n, (_, text) in enumerate(TEXTS + NAMES + cc_names()):
        for k in range(4):  # edited, cut and repeated passages
            w = (bare(text) + " ").split(" ")
            for _ in range(k * max(1, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(["", "edit", "the of"])
            given.append((100_000 + 10 * n + k, " ".join(words(k, n)) + " ".join(w[: len(w) - k]) + " " + " ".join(words(3, n)) + " ".join(w) * (k % 2)))
    given += [(200_000, None), (200_001, ""), (200_002, " ".join(words(30_000, 5)) + " Released under the MIT License. " + " ".join(words(30_000, 6)))]
    got = scanned(spark, given)
    assert len(got) > 1000 and got == by_sql(given)


def test_versions_clauses_and_rephrased_notices(spark):
    given = {
        1: ("This work is licensed under the GNU General Public License, version 2", {"GPL-2.0"}),
        2: ("This work is licensed under the GNU General Public License, version 3", {"GPL-3.0"}),
        3: ("The tool is Licensed under the MIT License.", {"MIT"}),
        4: ("All pictures: Licensed under CC BY 4.0", {"CC-BY-4.0"}),
        5: ("All pictures: Licensed under CC BY-NC 4.0", {"CC-BY-NC-4.0"}),
        6: ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
        7: ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", {"ISC"}),
        8: (bare(TEXTS[5][1]), {"BSD-2-Clause"}),
        9: (bare(TEXTS[6][1]) + " THIS SOFTWARE IS PROVIDED BY", {"BSD-3-Clause"}),
        10: ("It is under the GNU Lesser General Public License, version 3", {"LGPL-3.0"}),
        11: ("MIT License", set()),
        12: ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 4 of the License, or (at your option) any later version.", set()),
    }
    got = scan_licenses(documents(spark, [(i, t) for i, (t, _) in given.items()])).collect()
    assert {i: {r.license for r in got if r.doc_id == i} for i in given} == {i: want for i, (_, want) in given.items()}


def test_containment_threshold_repeats_and_empty(spark):
    grant = bare(TEXTS[0][1]).split()
    cut = lambda n: " ".join(grant[:n])
    given = [(1, cut(len(grant) - 8)), (2, cut(len(grant) // 2)), (3, "Released under the MIT License. " * 4), (4, None), (5, ""), (None, "Released under the MIT License."), (3, "Released under the MIT License.")]
    got = scan_licenses(documents(spark, given)).collect()
    assert sorted(((r.doc_id, r.license) for r in got), key=str) == sorted([(1, "MIT")] + [(3, "MIT")] * 5 + [(None, "MIT")], key=str)
    assert scan_licenses(documents(spark, [])).count() == 0


def test_templates_of_the_caller(spark):
    own = [("House", "you may read this page {but not} print it"), ("House", "reading is free for all of you")]
    given = [(1, "You may read this page, but not print it!"), (2, "you may read this page and print it"), (3, "now reading is free for all of you")]
    got = scan_licenses(documents(spark, given), templates=own).collect()
    assert sorted((r.doc_id, r.license, r.template) for r in got) == [(1, "House", 0), (3, "House", 1)]
    with pytest.raises(ValueError):
        scan_licenses(documents(spark, given), templates=[("x", "too short")])
