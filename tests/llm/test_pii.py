import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridcast.llm import pii
from gridcast.llm.pii import find_personal_data
from tests.llm.data import documents, rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def check(spark, given):
    got = {r.doc_id: r for r in find_personal_data(documents(spark, given)).collect()}
    for i, text in given:
        found = base(text or "")
        listed = ",".join(f"{k}:{a}:{z}" for k, a, z in found)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(f[0] == k for f in found) for k in PATTERNS), text
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))
    return got


def test_base_spans_equal_the_plain_patterns(spark):
    check(spark, [(10, None), (11, "")] + list(enumerate([
        "a@b.c_d@e.f x@y..z@w.v .@a.b a@b a@b. q%w+e-r@s-t.uv.",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1.2..3.4.5.6 1.2.3.",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 4 1 1 1  1 1 1 12-",
        "+1 (234) 555-1234 +12 345 +49.(0)30-1234567- ++1 2 3 4 5 6 7 8 9+",
        "é😀 a@b.co 😀 10.0.0.1 é +44 20 7946 0958",
        "1" * 30_000 + " " + "a" * 30_000 + " " + "1 " * 20_000 + "a@" * 5_000 + "x.y",
    ])))


def test_proposals_like_base_spans_are_added(spark):
    """Spaced dots in otherwise ordinary addresses: format and context are those of base spans."""
    given = [(i, f"the server at 10.{i % 250}.7.{i % 99} went down") for i in range(400)]
    given += [(1000 + i, f"version {i}.400.{i}.999 of it") for i in range(150)]
    given += [(2000 + i, f"the server at 10. {i}.7.9 went down") for i in range(5)]
    got = check(spark, given)
    assert sum(got[2000 + i].spans != "" for i in range(5)) >= 4
    assert all(got[1000 + i].spans == "" for i in range(150))


def test_a_rare_kind_has_its_threshold_from_all_proposals(spark, monkeypatch):
    """Card-like digit groups outnumber addresses by far more than the sample holds."""
    monkeypatch.setattr(pii, "SAMPLE_ROWS", 600)
    bad = [str(n) for n in range(7 * 10**15, 7 * 10**15 + 6000) if not luhn(str(n))][:5000]
    given = [(i, " x ".join(bad[20 * i : 20 * i + 20])) for i in range(250)]
    given += [(1000 + i, f"the server at 10.{i % 250}.7.{i % 99} went down") for i in range(300)]
    given += [(2000 + i, f"the server at 10. {i}.7.9 went down") for i in range(2)]
    got = check(spark, given)
    assert all(got[2000 + i].spans.startswith("ip:") for i in range(2))
    assert not any(got[i].spans for i in range(250))


def card(n):
    head = f"4{n:014d}"
    return head + next(str(c) for c in range(10) if luhn(head + str(c)))


@pytest.mark.parametrize("planted", [60, 3000])
def test_planted_spans_are_added_however_many_and_look_alikes_left(spark, planted):
    plain = ["write to u{0}@host{1}.example.com today", "the server at 10.{1}.7.{1} went down", "my card {2} was lost", "call +49 30 {3} now"]
    wider = ["write to u{0} [at] host{1} dot example dot com today", "the server at 10[.]{1}[.]8[.]{1} went down", "my card {4} was lost", "call 49 30 {3} now"]
    clean = ["version {0} . 400 . 7 . 999 of it", "order {5} is late", "it looks at nothing in {1} of {0} parts", "built 2024-01-{1}"]
    bad = lambda n: card(n)[:-1] + str((int(card(n)[-1]) + 1) % 10)
    fill = lambda t, n: t.format(n, n % 90 + 10, card(7919 * n), 5550000 + n, "/".join(card(104729 * n)[k : k + 4] for k in range(0, 16, 4)), "/".join(bad(n)[k : k + 4] for k in range(0, 16, 4)))
    given = [(n, fill(plain[n % 4], n)) for n in range(1200)]
    given += [(10_000 + n, fill(wider[n % 4], n)) for n in range(planted)]
    given += [(20_000 + n, fill(clean[n % 4], n)) for n in range(800)]
    got = check(spark, given)
    for k, kind in enumerate(pii.KINDS):
        found = [kind in got[10_000 + n].spans for n in range(planted) if n % 4 == k]
        assert sum(found) >= 0.9 * len(found), kind
    assert sum(got[20_000 + n].spans != "" for n in range(800)) <= 8
    if planted == 60:
        again = find_personal_data(documents(spark, given[::-1], partitions=7)).collect()
        assert {r.doc_id: r.spans for r in again} == {i: r.spans for i, r in got.items()}


def test_the_cheap_test_drops_no_match(spark, monkeypatch):
    given = ["write to jane at example.com", "jane at example[dot]com", "jane AT example dot com", "jane [at] example.com", "jane(at)example(dot)com", "jane@example dot com", "a@b.c"]
    given += ["8[.]8[.]8[.]8", "1 . 1 . 1 . 1", "1. 2. 3. 4", "1 .2 .3 .4", "1.2.3.4", "1[.]1.1 .1", "+1 (234) 555-1234", "4111/1111 - 1111.1111", "at a. b", ""]
    docs = spark.createDataFrame([(t,) for t in given], "text string")
    of = lambda: [r.found for r in docs.select(pii.found_spans(docs.text).alias("found")).collect()]
    with_tests = of()
    monkeypatch.setattr(pii, "NEEDS", {kind: lambda t, broad: F.lit(True) for kind in pii.KINDS})
    assert with_tests == of()
    assert all(any(not f.base for f in found) for found in with_tests[:-2])


def test_awkward_rows(spark):
    got = find_personal_data(documents(spark)).collect()
    assert len(got) == len(rows()) and {r.base_sha256 for r in got if r.doc_id in (1, 2)} == {hashlib.sha256(b"").hexdigest()}
    assert find_personal_data(documents(spark, [])).count() == 0
