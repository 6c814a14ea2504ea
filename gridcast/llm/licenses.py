"""License scans: MinHash bands over text windows, then shingle containment.

Texts are read as words (lower-cased runs of letters and digits) in windows of
WINDOW words, that is STEP 5-word shingles. Windows overlap: each starts at the
first shingle that the last did not hold. A window's band value is the least
hash of its shingles under the band's hash function (one row per band, as a
notice may be a single shingle). Templates give the band values of all runs of
1 to STEP shingles, so a window that holds c template shingles in a row has
Jaccard similarity c / STEP with one of them, and meets it in some band with
probability 1 - (1 - c / STEP) ** BANDS: over 0.9999 for c = 1. The join on
the band values is what retrieves a window; nothing is left out before it.

Each retrieved window is read with its neighbours, and their shingles are
matched exactly: a match is a run of shingles in template order that holds
``percent`` of those that stand in the template once, and every phrase the template marks as telling
(its version, or what sets it apart from a relative). Matches of one license
that overlap are one row, with the template that is held best. DataFrame
functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.llm.license_texts import templates as known_templates
from gridcast.operators.sizing import bounded_broadcast

WORDS, STEP = 5, 4
WINDOW = WORDS + STEP - 1
BANDS = 32
NOT_WORD = r"[^\p{L}\p{N}]+"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), NOT_WORD, " "), " "), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """Hashes of all 5-word shingles, in order; empty with fewer words."""

    def shingles(h: Column) -> Column:
        n = F.size(h) - WORDS + 1
        at = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WORDS)])
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def windows(hashes: Column) -> Column:
    """Windows of STEP shingles: their hashes, and the shingles ``around`` (the
    windows before and after included) with the place of the first of those."""

    def cut(h: Column) -> Column:
        n = F.size(h)

        def one(i: Column) -> Column:
            first = F.greatest(F.lit(0), i - STEP)
            return F.struct(first.alias("first"), F.slice(h, first + 1, 3 * STEP).alias("around"), *[F.get(h, i + j).alias(f"h{j}") for j in range(STEP)])

        kind = "array<struct<first:int,around:array<bigint>," + ",".join(f"h{j}:bigint" for j in range(STEP)) + ">>"
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(STEP)), one)).otherwise(F.array().cast(kind))

    return _let(hashes, cut)


def band_values(df: DataFrame, hashes: list[Column]) -> DataFrame:
    """``df`` once per band, with ``value``: the least hash of its shingles under the
    band's hash function, which the band's number seeds. The first shingle is
    never null; a null one counts as the first again."""
    per_band = df.withColumn("band", F.explode(F.array(*[F.lit(b) for b in range(BANDS)])))
    return per_band.withColumn("value", F.least(*[F.xxhash64(F.coalesce(h, hashes[0]), F.col("band")) for h in hashes])).drop("band")


def _plain(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_rows(templates: list[tuple[str, str]]) -> list[tuple[int, str, str, list[tuple[int, str]]]]:
    """template number, license, text and telling phrases, each with its bit."""
    out = []
    for n, (name, marked) in enumerate(templates):
        phrases = [" ".join(_plain(p)) for p in re.findall(r"\{([^}]*)\}", marked)]
        text = re.sub(r"[{}]", "", marked)
        if len(_plain(text)) < WORDS or any(not 0 < len(p.split()) <= WORDS for p in phrases):
            raise ValueError(f"a template of {name} has fewer than {WORDS} words or a phrase of more: {marked}")
        out.append((n, name, text, [(1 << bit, p) for bit, p in enumerate(phrases)]))
    return out


def template_shingles(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """Per template and shingle that stands in it once: place, hash, the number of such
    shingles, ``keys`` (bits of the phrases the shingle holds) and ``all_keys``."""
    rows = spark.createDataFrame(template_rows(templates), "template int, license string, text string, phrases array<struct<bit:int,words:string>>")
    rows = rows.withColumn("words", word_list(F.col("text"))).withColumn("h", shingle_hashes(F.col("words")))
    either = lambda given: F.aggregate(given, F.lit(0), lambda a, b: a.bitwiseOR(b))
    places = rows.select("template", "license", "words", "phrases", F.posexplode("h").alias("place", "hash"))
    shingle = F.concat(F.lit(" "), F.array_join(F.slice("words", F.col("place") + 1, WORDS), " "), F.lit(" "))
    held = F.transform("phrases", lambda p: F.when(F.contains(F.col("shingle"), F.concat(F.lit(" "), p["words"], F.lit(" "))), p["bit"]).otherwise(0))
    places = places.withColumn("shingle", shingle).withColumn("keys", either(held)).withColumn("all_keys", either(F.transform("phrases", lambda p: p["bit"])))
    # A shingle that a template repeats has no one place in its order.
    once = places.groupBy("template", "license", "all_keys", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"), F.first("keys").alias("keys")).where("n = 1")
    return once.drop("n").withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("template")).cast("int"))


def template_bands(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """The distinct band values of all runs of 1 to STEP shingles of the templates."""
    rows = spark.createDataFrame(template_rows(templates), "template int, license string, text string, phrases array<struct<bit:int,words:string>>")
    runs = rows.select(shingle_hashes(word_list(F.col("text"))).alias("h"), F.explode(F.sequence(F.lit(1), F.lit(STEP))).alias("n"))
    runs = runs.select("h", "n", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    return band_values(runs, [F.when(F.col("n") > j, F.get("h", F.col("at") + j)) for j in range(STEP)]).select("value").distinct()


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, percent: int = 80) -> DataFrame:
    """A row per match: id, license, start and stop (word places, end exclusive), and of
    the template held best its number, shingles found, shingles and containment.

    ``templates`` are pairs of license and text, telling phrases in braces; a
    license may have many. Null, empty and short texts match nothing; very long
    ones are read whole. A passage repeated in a text matches each time. Null ids
    and repeated rows are scanned like others; other columns are not looked at;
    an empty table gives no rows. Of templates held equally well, the one with
    more shingles is named, then the smaller number.
    """
    spark = df.sparkSession
    given = templates or known_templates()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), windows(shingle_hashes(word_list(text))).alias("cut"))
    rows = rows.select("uid", "doc_id", F.explode("cut").alias("w")).select("uid", "doc_id", "w.*")
    bands, _ = bounded_broadcast(template_bands(spark, given))
    retrieved = band_values(rows, [F.col(f"h{j}") for j in range(STEP)]).join(bands, "value", "left_semi")

    # A window meets its template in many bands, and is its neighbours' neighbour.
    around = retrieved.select("uid", "doc_id", "first", F.posexplode("around").alias("j", "hash"))
    shingles = around.select("uid", "doc_id", (F.col("first") + F.col("j")).alias("pos"), "hash").distinct()
    known, _ = bounded_broadcast(template_shingles(spark, given))
    met = shingles.join(known, "hash")
    order = Window.partitionBy("uid", "template").orderBy("pos")
    new = F.coalesce((F.col("place") <= F.lag("place").over(order)) | (F.col("pos") - F.lag("pos").over(order) > F.col("of")), F.lit(True))
    runs = met.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    held = runs.groupBy("uid", "doc_id", "template", "license", "of", "all_keys", "run").agg(
        F.count(F.lit(1)).alias("found"), F.bit_or("keys").alias("keys"), F.min("pos").alias("start"), (F.max("pos") + WORDS).alias("stop")
    )
    held = held.where((F.col("found") * 100 >= F.col("of") * percent) & (F.col("keys") == F.col("all_keys")))

    by_place = Window.partitionBy("uid", "license").orderBy("start", "stop", "template")
    before = F.max("stop").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = held.withColumn("fresh", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")).withColumn("span", F.sum("fresh").over(by_place))
    best = F.max(F.struct((F.col("found") / F.col("of")).alias("containment"), "of", (-F.col("template")).alias("t"), "found"))
    merged = spans.groupBy("uid", "doc_id", "license", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), best.alias("b"))
    return merged.select(
        F.col("doc_id").alias(id_col), "license", "start", "stop", (-F.col("b.t")).alias("template"), F.col("b.found").alias("found"), F.col("b.of").alias("shingles"), F.col("b.containment").alias("containment")
    )


def oracle_sql(templates: list[tuple[str, str]] | None = None, percent: int = 80) -> str:
    """The same matches in DuckDB SQL, from all shingles of all texts."""
    given = template_rows(templates or known_templates())
    text_rows = ", ".join("({}, '{}', '{}', {})".format(n, name, text.replace("'", "''"), sum(bit for bit, _ in phrases)) for n, name, text, phrases in given)
    phrase_rows = ", ".join(f"({n}, {bit}, '{p}')" for n, _, _, phrases in given for bit, p in phrases)
    words = "list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    cut = f"unnest(range(1, len(w) - {WORDS - 2})) AS i"
    shingle = f"array_to_string(w[i:i + {WORDS - 1}], ' ')"
    return f"""
WITH t0(template, license, text, all_keys) AS (VALUES {text_rows}),
p(template, bit, words) AS (VALUES {phrase_rows}),
t1 AS (SELECT template, license, all_keys, w, {cut} FROM (SELECT template, license, all_keys, {words} AS w FROM t0)),
t2 AS (SELECT template, license, all_keys, {shingle} AS s, i FROM t1),
t3 AS (SELECT *, count(*) OVER (PARTITION BY template) AS n FROM (SELECT template, license, all_keys, s, min(i) - 1 AS place FROM t2 GROUP BY template, license, all_keys, s HAVING count(*) = 1)),
t AS (SELECT t3.*, coalesce((SELECT CAST(sum(bit) AS INTEGER) FROM p WHERE p.template = t3.template AND contains(' ' || t3.s || ' ', ' ' || p.words || ' ')), 0) AS keys FROM t3),
d1 AS (SELECT doc_id, w, {cut} FROM (SELECT doc_id, {words} AS w FROM documents)),
d AS (SELECT doc_id, {shingle} AS s, i - 1 AS pos FROM d1),
m AS (SELECT doc_id, template, license, all_keys, keys, n, place, pos FROM d JOIN t USING (s)),
r AS (SELECT *, CASE WHEN place <= lag(place) OVER o OR pos - lag(pos) OVER o > n THEN 1 ELSE 0 END AS fresh FROM m WINDOW o AS (PARTITION BY doc_id, template ORDER BY pos)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY pos) AS run FROM r),
h AS (SELECT doc_id, template, license, n, count(*) AS found, min(pos) AS start, max(pos) + {WORDS} AS stop FROM g
      GROUP BY doc_id, template, license, n, all_keys, run HAVING count(*) * 100 >= n * {percent} AND bit_or(keys) = all_keys),
b AS (SELECT *, max(stop) OVER (PARTITION BY doc_id, license ORDER BY start, stop, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h),
s AS (SELECT *, sum(CASE WHEN start < before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, license ORDER BY start, stop, template) AS span FROM b),
f AS (SELECT doc_id, license, span, min(start) AS start, max(stop) AS stop, first(template ORDER BY found / n DESC, n DESC, template) AS template,
             first(found ORDER BY found / n DESC, n DESC, template) AS found, first(n ORDER BY found / n DESC, n DESC, template) AS n FROM s GROUP BY doc_id, license, span)
SELECT doc_id, license, CAST(start AS INTEGER) AS start, CAST(stop AS INTEGER) AS stop, CAST(template AS INTEGER) AS template, found, CAST(n AS INTEGER) AS shingles, found / n AS containment
FROM f
"""
