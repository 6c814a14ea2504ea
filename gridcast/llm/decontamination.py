"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows.

A window is ``words`` consecutive words of a benchmark item; an item of fewer
words is one window. The distinct windows' 64-bit hashes are written, counted
and broadcast under a size bound (beyond it the join shuffles on the hash).
Each document's words are cut into blocks, each block into windows, and the
windows whose hash is in the set leave that stage, with one row per document.
The few texts with such windows are then read again, by the digest of their
content, and each window is compared word by word. All of it is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import staged
from gridcast.operators.sizing import bounded_broadcast

# The letters that are lower-cased, what stands between words (in
# lower-cased text and in text as it is), and a word or what is between words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|" + GAP_CASED
# Words of a block: bounds what one row of a very long text takes in memory.
BLOCK = 2048
KEY = "content"  # sets the second half of a digest apart from the first


def _lower(text: Column) -> Column:
    """A-Z only; Spark's ``lower`` changes other letters, so it serves ASCII texts alone."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normalised_words(text_col: str) -> Column:
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.array_remove(F.split(_lower(whole), GAP), "")


def _content(text_col: str) -> list[Column]:
    """A text's 128-bit digest, as two numbers that are cheap to carry along."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(KEY), text).alias("_k2")]


def _picked(words: Column, at: Column, n: int) -> list[Column]:
    # One by one: ``slice`` copies the whole array at every call.
    return [F.get(words, at + i) for i in range(n)]


def _starts(last: Column) -> Column:
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, words: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``n`` (words), ``gram`` and ``hash``: each item's distinct windows."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), normalised_words(text_col).alias("w")).where(F.size("w") > 0)

    def windows(n: int) -> DataFrame:
        of = items.where(F.size("w") == n) if n < words else items.where(F.size("w") >= n)

        def one(i: Column) -> Column:
            picked = _picked(F.col("w"), i, n)
            return F.struct(F.array_join(F.array(*picked), " ").alias("gram"), F.xxhash64(F.lit(n), *[F.xxhash64(w) for w in picked]).alias("hash"))

        return of.select("item", F.lit(n).alias("n"), F.explode(F.transform(_starts(F.size("w") - n), one)).alias("x"))

    out = windows(words)
    for n in range(1, words):
        out = out.unionByName(windows(n))
    return out.select("item", "n", "x.gram", "x.hash").distinct()


def _suspects(docs: DataFrame, grams: DataFrame, lengths: list[int], words: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document (``pos`` null) and one per window whose hash is in ``grams``."""
    # From here on a word is its hash: eight bytes, whatever its length.
    hashed = F.transform(normalised_words(text_col), lambda w: F.xxhash64(w))
    rows = docs.select(F.col(id_col).alias("id"), *_content(text_col), hashed.alias("w"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size("w"), F.lit(1)) - 1) / BLOCK).cast("int")),
        lambda b: F.struct((b * BLOCK).alias("base"), F.slice(F.col("w"), b * BLOCK + 1, BLOCK + words - 1).alias("w")),
    )
    rows = rows.select("id", "_k1", "_k2", F.size("w").cast("long").alias("n_words"), F.explode(blocks).alias("b"))
    rows = rows.select("id", "_k1", "_k2", "n_words", "b.base", "b.w").withColumn("m", F.size("w"))

    def windows(n: int) -> Column:
        last = F.least(F.col("m") - n, F.lit(BLOCK - 1))
        return F.transform(_starts(last), lambda i: F.xxhash64(F.lit(n), *_picked(F.col("w"), i, n)))

    # Number 0 is null and stands for the document itself.
    found = F.concat(F.array(F.lit(None).cast("long")), *[windows(n) for n in lengths])
    seen = rows.select("id", "_k1", "_k2", "n_words", "base", "m", F.posexplode(found).alias("at", "hash"))
    hits = seen.join(grams, "hash", "left").where("same IS NOT NULL OR (at = 0 AND base = 0)")
    # A window's number less those of the shorter windows before it.
    hits, before, pos = hits.select("*", F.explode_outer("same").alias("s")), F.lit(1), F.lit(None).cast("int")
    for n in lengths:
        pos = F.when(F.col("s.n") == n, F.col("at") - before).otherwise(pos)
        before = before + F.greatest(F.least(F.col("m") - n + 1, F.lit(BLOCK)), F.lit(0))
    return hits.select("id", "_k1", "_k2", "n_words", (F.col("base") + pos).alias("pos"), "s.n", "s.gram", "s.gram_id")


def _merged(exact: str) -> Column:
    """Windows in order of their position, merged to spans."""
    none = F.lit(-1).cast("long")

    def state(done: Column, start: Column, end: Column) -> Column:
        return F.struct(done.alias("done"), start.alias("start"), end.alias("end"))

    def closed(acc: Column) -> Column:
        last = F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))
        return F.when(acc["end"] < 0, acc["done"]).otherwise(F.concat(acc["done"], last))

    def step(acc: Column, x: Column) -> Column:
        end = (x["pos"] + x["n"]).cast("long")
        longer = state(acc["done"], acc["start"], F.greatest(acc["end"], end))
        return F.when(x["pos"] <= acc["end"], longer).otherwise(state(closed(acc), x["pos"].cast("long"), end))

    return F.aggregate(exact, state(F.array().cast("array<struct<start:bigint,end:bigint>>"), none, none), step, closed)


def _verified(docs: DataFrame, hits: DataFrame, lengths: list[int], text_col: str) -> DataFrame:
    """Per text with exact windows: its digest, ``spans`` and ``gram_ids``."""
    found = hits.select("_k1", "_k2", "pos", "n", "gram", "gram_id").distinct()
    side, _ = bounded_broadcast(found.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("pos", "n", "gram", "gram_id")).alias("found")))
    texts = docs.select(*_content(text_col), F.col(text_col).alias("text")).join(side, ["_k1", "_k2"])
    texts = texts.select("_k1", "_k2", "found", normalised_words("text").alias("w"))

    def read(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for n in lengths:
            out = F.when(x["n"] == n, F.array_join(F.array(*_picked(F.col("w"), x["pos"], n)), " ")).otherwise(out)
        return F.struct(x["pos"].alias("pos"), x["n"].alias("n"), x["gram_id"].alias("gram_id"), (out == x["gram"]).alias("equal"))

    # Exploded before anything is filtered: a filter pushed below would split the text again for every word.
    exact = texts.select("_k1", "_k2", F.explode(F.transform("found", read)).alias("x")).select("_k1", "_k2", "x.*")
    exact = exact.where("equal").drop("equal").distinct()
    windows = F.sort_array(F.collect_list(F.struct("pos", "n")))
    out = exact.groupBy("_k1", "_k2").agg(windows.alias("windows"), F.collect_set("gram_id").alias("gram_ids"))
    return out.select("_k1", "_k2", _merged("windows").alias("spans"), "gram_ids")


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, words: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(id, digest and ``n_words`` of every document; digest, ``spans`` and ``items`` of every contaminated text)."""
    pairs = staged(benchmark_windows(benchmark, words, item_col, item_text), "benchmark-windows")
    grams = staged(pairs.select("gram", "n", "hash").distinct().withColumn("gram_id", F.monotonically_increasing_id()), "benchmark-grams")
    lengths = sorted(r[0] for r in grams.select("n").distinct().collect())  # at most ``words`` numbers
    # Windows with one hash stand in one row, so that a match never repeats a document.
    by_hash, _ = bounded_broadcast(grams.groupBy("hash").agg(F.collect_list(F.struct("n", "gram", "gram_id")).alias("same")))
    listed, _ = bounded_broadcast(pairs.where("item IS NOT NULL").join(grams.select("gram", "gram_id"), "gram").select("gram_id", "item"))
    seen = staged(_suspects(docs, by_hash, lengths, words, id_col, text_col), "benchmark-matches")
    texts = staged(_verified(docs, seen.where("pos IS NOT NULL"), lengths, text_col), "benchmark-texts")
    items = texts.select("_k1", "_k2", F.explode("gram_ids").alias("gram_id")).join(listed, "gram_id").select("_k1", "_k2", "item").distinct()
    items = items.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return seen.where("pos IS NULL").select("id", "_k1", "_k2", "n_words"), texts.select("_k1", "_k2", "spans").join(items, ["_k1", "_k2"], "left")


def contamination(
    docs: DataFrame, benchmark: DataFrame, words: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit`` (words inside a benchmark
    window), ``items`` (sorted texts of the ids of the items whose windows occur)
    and ``spans`` (merged half-open word ranges that are hit).

    A null text or one without words gives zeros and empty lists. Repeated rows
    and null ids are rows of their own. An item without words matches nothing;
    rows with one item id are one item; a null item id marks words and is not
    listed. Very long texts are cut into overlapping blocks. Other columns are
    not looked at. An empty ``docs`` gives no rows, an empty benchmark no hits.
    """
    own, texts = contaminated_texts(docs, benchmark, words, id_col, text_col, item_col, item_text)
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return own.join(texts, ["_k1", "_k2"], "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        spans.alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without what the benchmark holds, its columns as they were.

    ``remove="documents"`` drops every document with a hit word;
    ``remove="spans"`` cuts the hit words, and what stands between the words of
    a span, out of the text. Texts are found by the digest of their content, so
    equal texts fare alike; a null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    _, texts = contaminated_texts(docs, benchmark, words, id_col, text_col)
    marked, _ = bounded_broadcast(texts.select("_k1", "_k2", F.col("spans").alias("_spans")))
    keyed = docs.select("*", *_content(text_col))
    if remove == "documents":
        return keyed.join(marked, ["_k1", "_k2"], "left_anti").select(*docs.columns)
    # Pieces are words and what stands between them, by turns; a piece between
    # words goes when the words on both its sides do.
    pieces = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(PIECE), F.lit(0))
    found = keyed.join(marked, ["_k1", "_k2"], "left").withColumn("_pieces", F.when(F.col("_spans").isNotNull(), pieces))
    found = found.withColumn("_first", F.when(F.get("_pieces", F.lit(0)).rlike("^" + GAP_CASED), F.lit(1)).otherwise(F.lit(0)))

    def cut(i: Column) -> Column:
        word = F.floor((i - F.col("_first")) / 2)
        after = word + F.when((i - F.col("_first")) % 2 == 0, F.lit(0)).otherwise(F.lit(1))
        return F.exists("_spans", lambda s: (word >= s["start"]) & (after < s["end"]))

    left = F.array_join(F.filter("_pieces", lambda p, i: ~cut(i)), "")
    return found.withColumn(text_col, F.when(F.col("_spans").isNull(), F.col(text_col)).otherwise(left)).select(*docs.columns)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest columns of ``contamination``."""
    rows = contamination(docs, benchmark)
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
