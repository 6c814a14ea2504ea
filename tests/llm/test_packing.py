import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridcast.llm.packing import cutting_stock, encoder, pack
from gridcast.llm.queries import byte_bpe_path
from tests.llm.data import documents, rows


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe_path())


@pytest.mark.parametrize("text", ["", " ", "Hello  world\n\n it's 1234 déjà-vu", "　日本語 <|endoftext|> \t\t x", "a" * 3000, " " * 500 + "x", "!!!???'s 're"])
def test_ids_equal_the_tokenizers_library(text):
    assert encoder(byte_bpe_path())(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids


def test_round_trip(spark):
    pieces = pack(documents(spark), byte_bpe_path(), size=256, with_ids=True).collect()
    tk = tokenizer()
    want = Counter((i, tuple(tk.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in rows())
    sequences = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    # Repeated rows give equal pieces: each occurs as often as its document does.
    seen = Counter((p.doc_id, p.start, bytes(p.ids), p.doc_tokens) for p in pieces)
    expected = Counter()
    for (i, ids), n in want.items():
        data = np.array(ids, "<u4")
        for a in range(0, len(ids), 256):
            expected[(i, a, data[a : a + 256].tobytes(), len(ids))] += n
    assert seen == expected


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_patterns_hold_every_piece_and_waste_little(n):
    demand = np.bincount(np.random.default_rng(n).integers(0, 32, n), minlength=32)
    made = cutting_stock(demand, 32)
    assert (sum((t * p for t, p in made), np.zeros(32, np.int64)) == demand).all()
    assert all((p * np.arange(1, 33)).sum() <= 32 for _, p in made)
    least = int(-(-(demand * np.arange(1, 33)).sum() // 32))
    assert sum(t for t, _ in made) <= 1.02 * least + 32


def test_empty_table(spark):
    assert pack(documents(spark, []), byte_bpe_path()).count() == 0


def test_stored_token_ids_take_less_than_half_their_size(spark):
    import glob
    import os
    import random

    from gridcast.llm.queries import byte_bpe_path
    from gridcast.session import shared_dir

    rng = random.Random(4)
    words = [l for l in "the of and a to in is you that it he was for on are as with his they at be this have from or one had by word but not what all were we when your can said there".split()]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=1500))) for i in range(40)], "doc_id long, text string")
    root = shared_dir(spark, "pack-pieces").removeprefix("file:")
    before = set(glob.glob(f"{root}/*"))
    tokens = pack(docs, byte_bpe_path(), with_ids=True).agg({"length": "sum"}).first()[0]
    (made,) = set(glob.glob(f"{root}/*")) - before
    assert sum(os.path.getsize(f) for f in glob.glob(f"{made}/*.parquet")) < 2 * tokens
