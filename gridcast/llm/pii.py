"""Personal data by candidate gradient boosting, on DataFrame functions only.

Base spans are exact format matches (e-mail, IP, card with a valid check sum,
phone). Broader generators propose further spans: spelled-out or bracketed
e-mail and IP separators, digit groups without a plus or a valid check sum.
Boosted trees on format and context features score the proposals. They learn
what a base span would look like in the wider formats: each base span is
rewritten into one of them, in its own context, with label 1; a base match whose
check fails is rewritten likewise, with label 0, and so counts a proposal that
meets one, or a base span of another kind. Proposals that meet no base match are
unlabelled: they count as 0, with at most a tenth of the weight of the positives
of their kind together, however many they are. Equal ones in equal context count once, so
copies change nothing. A threshold per kind, at least even odds, is the lowest score from which
the labelled rows that the trees were not fitted on reach the wanted precision;
unlabelled proposals above it are added. A kind without base spans adds none.
Base spans always stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import staged

KINDS = ("email", "ip", "card", "phone")

# Fixed formats of the base spans. They match what the plain patterns match;
# starting a run only at its beginning or where the last match ended, and not
# giving characters back, keeps the scan linear on very long runs.
_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
_DIGITS = r"(?:\G|(?<![0-9]))[0-9]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _DIGITS + r"\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider formats of the proposals.
_DOT = r"(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
_AT = r"(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)"
_POINT = r"(?:\x20?\.\x20?|\[\.\])"
BROAD = {
    "email": "(?i)" + _LOCAL + r"(?:@|" + _AT + r")[A-Za-z0-9-]++(?:" + _DOT + r"[A-Za-z0-9-]++)++",
    "ip": _DIGITS + r"(?:" + _POINT + r"[0-9]++){3}+",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20./-]{0,2}+[0-9]){12,18}+(?![0-9])",
    "phone": r"[+(]?(?:\G|(?<![0-9]))[0-9](?:[\x20().-]{0,3}+[0-9]){6,14}+(?![0-9])",
}
# A text without this cannot match the pattern: a cheap test first.
NEEDS = {
    "email": lambda t, broad: t.contains("@") | (t.rlike("(?i)" + _AT + "[A-Za-z0-9-]++" + _DOT) if broad else F.lit(False)),
    "ip": lambda t, broad: t.rlike("[0-9]" + _POINT + "[0-9]"),
    "card": lambda t, broad: t.rlike("[0-9][^0-9]?[^0-9]?[0-9]"),
    "phone": lambda t, broad: t.rlike("[0-9][^0-9]{0,3}[0-9]") if broad else t.contains("+"),
}
BEFORE, AFTER = 24, 16

# Rows the trees are fitted on, at most (about), as many of each kind and class;
# and the size of the trees.
SAMPLE_ROWS, TREES, DEPTH, LEAF = 20_000, 12, 4, 5
# Weight of a kind's unlabelled proposals together, at most, in proportion where they
# are fewer than its positives; positives, and negatives, have 1.
UNLABELLED = 0.1
# One row in so many is never fitted on, nor is what the sample leaves out: these
# set the thresholds. The precision asked of an added span there.
CALIBRATE, PRECISION, BINS = 4, 0.98, 1000
POSITIVE, NEGATIVE, OPEN = 1, 0, 2
# How base spans are rewritten: what stands for the at sign and the dots of an
# address, between the parts of an IP, the groups of a card, those of a phone number.
REWRITE = {
    "at": (" at ", " [at] ", "[at]", "(at)", " (at) ", "@"),
    "dot": (" dot ", " [dot] ", "[dot]", "(dot)", " (dot) ", "."),
    "point": ("[.]", " . ", ". ", " ."),
    "group": (".", "/", " - ", "  ", "-", " "),
    "space": ("", ".", " ", "-"),
}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _matches(text: Column, pattern: str, kind: int, base: bool) -> Column:
    """All matches in order, each with the length of the text since the last one
    and its surroundings: what lies between matches is what split leaves."""

    def spans(x: Column) -> Column:
        n = F.size(x["found"])
        one = lambda i: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(base).alias("base"),
            F.length(F.get(x["between"], i)).alias("gap"),
            F.get(x["found"], i).alias("match"),
            F.right(F.get(x["between"], i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(x["between"], i + 1), F.lit(AFTER)).alias("after"),
        )
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast(SPANS))

    return _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")), spans)


SPANS = "array<struct<kind:int,base:boolean,gap:int,match:string,before:string,after:string>>"


def found_spans(text: Column) -> Column:
    """Base and broad matches of every kind in one array."""
    none = F.array().cast(SPANS)
    parts = [
        F.when(NEEDS[kind](text, not base), _matches(text, patterns[kind], i, base).cast(SPANS)).otherwise(none)
        for base, patterns in ((True, BASE), (False, BROAD))
        for i, kind in enumerate(KINDS)
    ]
    return F.concat(*parts)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """The checks a base match must pass."""
    digits = _digits(match)
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return (
        F.when(kind == 0, True)
        .when(kind == 1, match.rlike(rf"\A{part}(?:\.{part}){{3}}\z"))
        .when(kind == 2, F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(F.length(digits).between(9, 15))
    )


def rewritten(kind: Column, match: Column) -> Column:
    """A base match in a wider format, picked by its own hash."""
    pick = lambda name, salt: F.get(F.array(*[F.lit(w) for w in REWRITE[name]]), F.pmod(F.xxhash64(match, F.lit(salt)), F.lit(len(REWRITE[name]))).cast("int"))
    local, host = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    bare = F.ltrim(F.regexp_replace(match, r"\+", ""))
    between = pick("space", 1)
    return (
        F.when(kind == 0, F.concat(local, pick("at", 1), F.replace(host, F.lit("."), pick("dot", 2))))
        .when(kind == 1, F.replace(match, F.lit("."), pick("point", 1)))
        .when(kind == 2, F.regexp_replace(_digits(match), F.lit("([0-9]{4})(?=[0-9])"), F.concat(F.lit("$1"), pick("group", 1))))
        .otherwise(F.when(between == "", bare).otherwise(F.regexp_replace(bare, F.lit("[^0-9]+"), between)))
    )


def proposed(kind: Column, match: Column) -> Column:
    """Whether all of ``match`` is in its kind's wider format."""
    return reduce(lambda other, i: F.when(kind == i, match.rlike(r"\A(?:" + BROAD[KINDS[i]] + r")\z")).otherwise(other), range(len(KINDS)), F.lit(False))


CONTEXT = {
    "says_phone": r"(?i)phone|tel|call|mobile|fax",
    "says_card": r"(?i)card|visa|credit|account|iban",
    "says_mail": r"(?i)mail|contact|write",
    "says_ip": r"(?i)\bip\b|host|server|addr",
    "says_other": r"(?i)token|version|order|\bref|\bno\b|id\W*$",
}


def features() -> dict[str, Column]:
    """Format and context of a proposal, and whether its digits make sense as its
    kind. What stands between the parts is not told: a corpus has ways to write
    it that no rewriting thinks of."""
    m, before, after = F.col("match"), F.col("before"), F.col("after")
    address = F.regexp_replace(F.regexp_replace(m, "(?i)" + _AT, "@"), "(?i)" + _DOT, ".")
    plain = F.when(F.col("kind") == 0, address).when(F.col("kind") == 1, F.regexp_replace(m, "[^0-9]+", ".")).otherwise(m)
    count = lambda pattern: F.regexp_count(plain, F.lit(pattern))
    edge = lambda c: F.when(F.length(c) == 0, 0).when(c.rlike(r"\A\s\z"), 1).when(c.rlike(r"\A\p{L}\z"), 2).when(c.rlike(r"\A[0-9]\z"), 3).otherwise(4)
    given = {
        "kind": F.col("kind"),
        "sense": valid(F.col("kind"), plain),
        "digits": count("[0-9]"),
        "letters": count("[A-Za-z]"),
        "groups": count("[A-Za-z0-9]+"),
        # Issuers and countries have their first digits; in an address they say nothing.
        "first_digit": F.when(F.col("kind") >= 2, F.regexp_extract(plain, "[0-9]", 0).try_cast("int")).otherwise(-1),
        "first_group": F.length(F.regexp_extract(plain, "[A-Za-z0-9]+", 0)),
        "last_group": F.length(F.regexp_extract(plain, r"[A-Za-z0-9]+\z", 0)),
        "left": edge(F.right(before, F.lit(1))),
        "right": edge(F.left(after, F.lit(1))),
        **{name: before.rlike(pattern) for name, pattern in CONTEXT.items()},
    }
    return {name: c.cast("double").alias(name) for name, c in given.items()}


def _thresholds(scored: DataFrame) -> dict[int, float]:
    """Per kind the lowest score bin, from even odds on, above which its labelled rows keep PRECISION."""
    bins = scored.where(F.col("class") != OPEN).groupBy("kind", "class", F.floor(F.col("p") * BINS).alias("bin")).count().collect()  # at most a row per kind, class and bin
    chosen: dict[int, float] = {}
    for kind in range(len(KINDS)):
        own = [r for r in bins if r["kind"] == kind]
        of = {c: sum(r["count"] for r in own if r["class"] == c) for c in (POSITIVE, NEGATIVE)}
        right = wrong = 0.0
        least = BINS // 2
        for row in sorted((r for r in own if 2 * r["bin"] >= BINS), key=lambda r: (-r["bin"], -r["class"])):
            if row["class"] == POSITIVE:
                right += row["count"] / of[POSITIVE]
            else:
                wrong += row["count"] / of[NEGATIVE]
                if right < PRECISION * (right + wrong):  # from here down it is not precise enough
                    least = row["bin"] + 1
                    break
        chosen[kind] = least / BINS
    return chosen


def added_spans(rows: DataFrame) -> DataFrame:
    """Open proposals the calibrated trees accept; ``rows``: proposals and rewritten
    base matches with their features and class."""
    names = list(features())
    kinds = rows.where(F.col("class") == POSITIVE).select("kind_id").distinct().collect()  # a row per kind
    none = rows.limit(0).select("uid", "kind_id", "start", "stop")
    if not kinds:
        return none
    able = rows.where(F.col("kind_id").isin([r["kind_id"] for r in kinds]))
    different = staged(able.groupBy("class", F.col("key").alias("draw"), *names).agg(F.count(F.lit(1)).alias("copies")), "pii-different")
    sizes = {(r["kind"], r["class"]): r["count"] for r in different.groupBy("kind", "class").count().collect()}  # a row per kind and class
    share = lambda n: min(1.0, SAMPLE_ROWS / len(sizes) / n)
    of = lambda value: reduce(lambda other, k: F.when((F.col("kind") == k[0]) & (F.col("class") == k[1]), value(k)).otherwise(other), sizes, F.lit(0.0))
    drawn = F.pmod(F.col("draw"), F.lit(1 << 20)) < of(lambda k: F.lit(share(sizes[k]) * (1 << 20)))
    fitted = drawn & (F.pmod(F.shiftrightunsigned("draw", 20), F.lit(CALIBRATE)) > 0)
    beside = lambda k: UNLABELLED * min(1.0, sizes[k] / sizes.get((k[0], POSITIVE), sizes[k])) if k[1] == OPEN else 1.0
    total = lambda k: beside(k) * SAMPLE_ROWS / len(sizes)
    weight = of(lambda k: F.lit(total(k) / (sizes[k] * share(sizes[k]))))
    row = VectorAssembler(inputCols=names, outputCol="x")
    # The sample is bounded: a few partitions keep the tree jobs short. Its order, and so the trees, come from the rows.
    sample = row.transform(different.where(fitted)).select("draw", (F.col("class") == POSITIVE).cast("int").alias("label"), weight.alias("weight"), "x")
    sample = staged(sample.repartition(2, "draw").sortWithinPartitions("draw").drop("draw"), "pii-sample")
    classes = sample.agg(F.min("label"), F.max("label")).first()
    if classes[0] is None or classes[0] == classes[1]:
        return none
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF, stepSize=0.3, seed=0).fit(sample)

    score = lambda df: model.transform(row.transform(df)).withColumn("p", vector_to_array("probability")[1])
    limits = _thresholds(score(different.where(~fitted)))
    if not limits:
        return none
    accepted = reduce(lambda a, b: a | b, [(F.col("kind_id") == kind) & (F.floor(F.col("p") * BINS) / BINS >= least) for kind, least in limits.items()])
    return score(able.where(F.col("class") == OPEN)).where(accepted).select("uid", "kind_id", "start", "stop")


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and
    spans (base and added, kind:start:end by kind, then start; code points, end
    exclusive).

    Null texts count as empty and have no spans. Null ids and repeated rows
    give a row each. Other columns are not looked at; an empty table gives no
    rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    docs = staged(docs.select("uid", "doc_id", found_spans(F.col("text")).alias("found")), "pii-found")

    in_turn = Window.partitionBy("uid", "kind_id", "base").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = docs.where(F.size("found") > 0).select("uid", F.posexplode("found").alias("pos", "f"))
    rows = rows.select("uid", "pos", F.col("f.kind").alias("kind_id"), "f.base", "f.gap", "f.match", "f.before", "f.after")
    rows = rows.withColumn("stop", F.sum((F.col("gap") + F.length("match")).cast("long")).over(in_turn)).withColumn("start", F.col("stop") - F.length("match"))
    rows = rows.withColumn("good", F.col("base") & valid(F.col("kind_id"), F.col("match")))

    def meets(those: Column, keys: list[str]) -> Column:
        """One of ``those`` that starts before this row's end ends after its start."""
        by_start = Window.partitionBy(*keys).orderBy("start", "stop")
        upto = F.max(F.when(those, F.col("stop"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        onward = F.min(F.when(those, F.col("start"))).over(by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        return F.coalesce(upto > F.col("start"), F.lit(False)) | F.coalesce(onward < F.col("stop"), F.lit(False))

    good = F.col("good")
    # Any two digits match the card's base pattern: what has fewer than a card's says nothing.
    failed = F.col("base") & ~good & ((F.col("kind_id") != 2) | (F.length(_digits(F.col("match"))) >= 13))
    rows = rows.withColumn("hit", meets(good, ["uid", "kind_id"])).withColumn("miss", meets(failed, ["uid", "kind_id"])).withColumn("any", meets(good, ["uid"]))
    rows = staged(rows.where(F.col("good") | failed | ~F.col("base")), "pii-matches")
    kind, own = F.col("kind_id").alias("kind"), ["uid", "kind_id", "start", "stop"]
    learned = rows.where("base").select(*own, kind, rewritten(F.col("kind_id"), F.col("match")).alias("match"), "before", "after", F.when(good, POSITIVE).otherwise(NEGATIVE).alias("class"))
    learned = learned.where(proposed(F.col("kind"), F.col("match")))
    real = rows.where("NOT base AND NOT hit").select(*own, kind, "match", "before", "after", F.when(F.col("miss") | F.col("any"), NEGATIVE).otherwise(OPEN).alias("class"))
    key = F.xxhash64("class", "kind", "match", "before", "after").alias("key")
    proposals = staged(learned.unionByName(real).select(*own, "class", key, *features().values()), "pii-spans")

    base = rows.where("good").select(*own, F.lit(True).alias("base"))
    added = added_spans(proposals).withColumn("base", F.lit(False))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind_id"]), s["start"], s["stop"])), ",")
    per_doc = base.unionByName(added).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("kind_id", "start", "stop", "base"))).alias("all"))
    per_doc = per_doc.withColumn("kept", F.filter("all", lambda s: s["base"]))
    of_kind = lambda i: F.size(F.filter("kept", lambda s: s["kind_id"] == i)).cast("long")
    counts = [of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    per_doc = per_doc.select("uid", *counts, listed(F.col("kept")).alias("base"), listed(F.col("all")).alias("spans"))
    out = docs.select("uid", "doc_id").join(per_doc, "uid", "left")
    none = F.lit("")
    return out.select(
        F.col("doc_id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", none).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
    )
