"""Small documents with the awkward cases every operator must take."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, kind string, rank int, hash string, base boolean, shard string"


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(["red", "blue", "green", "stone", "river", "cloud"]) + str(rng.randrange(900)) for _ in range(n)]


def rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty, blank, very long, repeated rows, copies, near copies, short texts."""
    out: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (None, "a text without an id"), (None, None)]
    out += [(6, " ".join(words(9000, 6))), (7, "x" * 60_000)]
    base = words(120, 1)
    out += [(100 + i, " ".join(base)) for i in range(30)]
    for i in range(40):
        near = list(base)
        for k in range(i % 6):
            near[(17 * i + 29 * k) % 120] = f"edit{i}_{k}"
        out.append((200 + i, " ".join(near)))
    out += [(300 + i, " ".join(words(6 + i, i + 50))) for i in range(60)]
    return out + [(300, " ".join(words(6, 50))), (100, " ".join(base))]


def documents(spark: SparkSession, given=None, partitions: int = 3) -> DataFrame:
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, "en", ["a", "b", None, "ü"][n % 4], len(t or ""), "x", "k", 7, "h", True, "s") for n, (i, t) in enumerate(given if given is not None else rows())]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)
