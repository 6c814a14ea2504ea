"""Merkle manifest of a table, with nested-interval labels.

Every group's rows are leaves in order of their id; runs of ``fanout`` nodes
become one until a group's subroot is left, and the subroots, in order of their
group, likewise become the root. A node carries the half-open interval of leaf
ranks that it covers. Rows are range-partitioned by (group, id), so a group
holding a third of all rows is ranked by many tasks. Going up, a level's nodes
are bucketed by the rank at which their parent begins; going down, each level
is joined with the level above by that bucket and by containment of intervals,
and a node's siblings are what its parent's interval holds besides its own.
Above the leaves a level has an eighth of the nodes of the one below; the
siblings on the way to the root travel with nodes, not with rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import shuffle_width, staged
from gridcast.operators.sizing import bounded_broadcast

PATH = "array<struct<left:binary,right:binary>>"


def field_digest(values: list[Column]) -> Column:
    """SHA-256, lowercase hex, of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def _hex(b: Column) -> Column:
    return F.lower(F.hex(b))


def _ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``lo`` (rank within ``tree``, from 0) and ``leaves`` (rows of the tree) for every row."""
    spark = leaves.sparkSession
    # The id of a stored row breaks ties of equal rows, so that they can be split too.
    keyed = leaves.withColumn("_uid", F.monotonically_increasing_id())
    keys = ["tree", *order, "_uid"]
    dealt = keyed.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    placed = staged(dealt.drop("_uid").withColumn("_at", F.monotonically_increasing_id()), "manifest-ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "tree", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("tree")).alias("leaves")
    )
    side, _ = bounded_broadcast(offsets)
    return placed.join(side, ["tree", "_part"]).withColumn("lo", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def _levels(leaves: DataFrame, fanout: int, tallest: int) -> list[DataFrame]:
    """Nodes of each level as (tree, leaves, lo, hi, digest), with their ``children`` above level 0."""
    levels = [leaves.select("tree", "leaves", "lo", (F.col("lo") + 1).alias("hi"), F.unhex("digest").alias("digest"))]
    span = 1
    while span < tallest:
        many = levels[-1].where(F.col("leaves") > span)  # a tree of one node is done
        span *= fanout
        runs = many.groupBy("tree", "leaves", F.floor(F.col("lo") / span).alias("_bucket")).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        whole = F.unhex(F.sha2(_hex(F.aggregate("children.digest", F.lit(b""), lambda a, d: F.concat(a, d))), 256))
        up = runs.select("tree", "leaves", F.col("children.lo")[0].alias("lo"), F.array_max("children.hi").alias("hi"), whole.alias("digest"), "children")
        levels.append(staged(up, "manifest-level"))
    return levels


def _tops(levels: list[DataFrame], fanout: int) -> DataFrame:
    """Each tree's last node: (tree, leaves, digest)."""
    out = None
    for i, level in enumerate(levels):
        own = level.where(F.col("leaves") <= fanout**i)
        if i:
            own = own.where(F.col("leaves") > fanout ** (i - 1))
        own = own.select("tree", "leaves", "digest")
        out = own if out is None else out.unionByName(own)
    return out


def _paths(levels: list[DataFrame], tops: DataFrame, fanout: int, carried: list[str], last: int) -> DataFrame:
    """Level ``last`` with ``path``: the siblings of each node's way up, from itself.

    ``tops`` has ``path`` and ``carried`` per tree; they are handed down.
    """
    above, side = None, None
    for i in range(len(levels) - 1, last - 1, -1):
        level = levels[i]
        ends = level.where((F.col("leaves") <= fanout**i) & (F.col("leaves") > (fanout ** (i - 1) if i else 0)))
        own = ends.join(tops.drop("leaves", "digest"), "tree")
        if above is not None:
            side = above.select("tree", F.floor(F.col("lo") / fanout ** (i + 1)).alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("children").alias("_run"), F.col("path").alias("_path"), *carried)
            rest = level.where(F.col("leaves") > fanout**i).withColumn("_bucket", F.floor(F.col("lo") / fanout ** (i + 1)))
            held = rest.join(side, ["tree", "_bucket"]).where("lo >= _lo AND hi <= _hi")
            part = lambda keep: F.aggregate(F.filter("_run", keep), F.lit(b""), lambda a, c: F.concat(a, c["digest"]))
            step = F.struct(part(lambda c: c["hi"] <= F.col("lo")).alias("left"), part(lambda c: c["lo"] >= F.col("hi")).alias("right"))
            held = held.withColumn("path", F.concat(F.array(step), F.col("_path")).cast(PATH)).select(*level.columns, "path", *carried)
            own = own.select(*level.columns, "path", *carried).unionByName(held)
        above = staged(own, "manifest-paths") if i > last else own
    return above


def merkle_manifest(
    df: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", fanout: int = 8, changed: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row: id, ``leaf``, ``subroot``, ``root``, ``path`` (siblings as
    (left, right) digests from the leaf to the root) and ``now``, the digest of
    the row with ``changed`` columns (the leaf itself without).

    Null values have a mark of their own, so null and empty differ; a null group
    comes first, a null id before the others. Rows with one id are ordered by
    their digest; equal rows have equal digests, in any order. A lone leaf is
    its subroot, a lone subroot the root. Other columns are not looked at. An
    empty table gives no rows.
    """
    # A null group sorts before the empty one.
    tree = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    now = field_digest([(changed or {}).get(c, F.col(c)) for c in fields])
    digests = df.select(F.col(id_col).alias("id"), tree.alias("tree"), field_digest([F.col(c) for c in fields]).alias("digest"), now.alias("now"))
    leaves = _ranked(staged(digests, "manifest-leaves"), ["id", "digest"])
    tallest = leaves.agg(F.max("leaves")).first()[0] or 0
    levels = _levels(leaves, fanout, tallest)
    tops = staged(_tops(levels, fanout), "manifest-subroots")

    upper = _ranked(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), _hex(F.col("digest")).alias("digest")), ["name"])
    upper = staged(upper, "manifest-groups")
    groups = upper.agg(F.max("leaves")).first()[0] or 0
    above = _levels(upper, fanout, groups)
    start = F.array().cast(PATH)
    root = staged(_tops(above, fanout).withColumn("root", _hex(F.col("digest"))).withColumn("path", start), "manifest-root")
    led = _paths(above, root, fanout, ["root"], 0).select("lo", "path", "root")
    named = upper.select("lo", F.col("name").alias("tree"), F.col("digest").alias("subroot")).join(led, "lo").drop("lo")
    tops = staged(tops.join(named, "tree"), "manifest-tops")

    # Rows meet the nodes above them by the bucket of their rank; what a node has
    # gathered on its way is stored once for its ``fanout`` leaves.
    carried = ["subroot", "root"]
    rows = [leaves.select("tree", "leaves", "lo", (F.col("lo") + 1).alias("hi"), F.unhex("digest").alias("digest"), "id", "now"), *levels[1:]]
    out = _paths(rows, tops, fanout, carried, 0)
    return out.select(F.col("id").alias(id_col), _hex(F.col("digest")).alias("leaf"), "subroot", "root", "path", "now")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(_hex(s["left"]), d, _hex(s["right"])), 256))


def manifest_report(docs: DataFrame) -> DataFrame:
    """The contract's digest columns: rows whose id's CRC-32 divides by 3 are tampered with."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(struck, F.translate(F.col("text").cast("string"), upper, lower)).otherwise(F.col("text"))
    rows = merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": text})
    proof = F.aggregate("path", F.lit(b""), lambda a, s: F.concat(a, s["left"], s["right"]))
    rows = rows.withColumn("proof_sha256", F.sha2(_hex(proof), 256)).withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
