import zlib
from collections import Counter

import numpy as np

from tests.llm.data import documents, rows
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_packing import tokenizer
from tests.llm.test_partenum import brute as brute_join


def test_stages_against_brute_force(spark, tmp_dir):
    """Each stage on what its predecessor kept, nulls and extra columns included."""
    import corpus_pipeline as cp

    given = rows() + [(5000 + i, f"you are vile {i} friend of mine today") for i in range(40)]
    spark.createDataFrame([(5000 + i, 1) for i in range(40)] + [(300 + i, 0) for i in range(60)] + [(100 + i, 0) for i in range(30)], "doc_id long, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = documents(spark, given)
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns
        before, docs = docs, spark.createDataFrame(out.collect(), out.schema)
        kept[name] = (before.collect(), docs.collect())

    before, after = kept["toxicity"]
    assert not [r for r in after if r.doc_id and r.doc_id >= 5000] and len(after) == len(rows())
    before, after = kept["exact_dedup"]
    best = {}
    for r in before:
        key = r.text or ""
        best[key] = max(best.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in after) == Counter((i, t) for t, i in best.items())
    before, after = kept["jaccard_join"]
    stay = sorted(str(i) for i, _, c in brute_join([(r.doc_id, r.text) for r in before]) if i is None or i == c)
    assert sorted(str(r.doc_id) for r in after) == stay
    before, after = kept["mixing"]
    want = Counter()
    for (i, _, _, _, copies), n in brute_mix(before)[0].items():
        want[i] += copies * n
    assert Counter(r.doc_id for r in after) == +want
    pieces = cp.STAGES[-1][1](spark, docs, tmp_dir).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r.doc_id for r in docs.collect())
    # Every token id lies in one piece, every piece in a sequence without gaps.
    encoded = tokenizer()
    tokens = Counter()
    for r in docs.collect():
        ids = encoded.encode(r.text or "", add_special_tokens=False).ids + [0]
        tokens.update((r.doc_id, a, len(ids), tuple(ids[a : a + 1024])) for a in range(0, len(ids), 1024))
    assert Counter((p.doc_id, p.start, p.doc_tokens, tuple(np.frombuffer(p.ids, "<u4").tolist())) for p in pieces) == tokens
    assert all(p.ids_crc32 == zlib.crc32(p.ids) and p.length * 4 == len(p.ids) for p in pieces)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    # No worse than filling one sequence after another, first fit, longest first.
    room = []
    for p in sorted(pieces, key=lambda p: -p.length):
        k = next((k for k, left in enumerate(room) if left >= p.length), None)
        if k is None:
            room.append(1024 - p.length)
        else:
            room[k] -= p.length
    assert len(sequences) <= 1.1 * len(room) + 1


def test_run_and_registration(spark):
    import __spark_entry__ as entry
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    names = set(entry.queries())
    assert {"pipeline"} | {n.split("_")[0] for n in names if n.startswith("op")} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    out = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"] and out.count() > 0
