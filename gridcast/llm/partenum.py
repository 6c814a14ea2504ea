"""Jaccard join of word-shingle sets by PartEnum signatures.

A document is the set of hashes of its distinct shingles. Sets are banded by
size (powers of two). For each band the hash domain is partitioned, and a set
emits signatures: the hash of its elements in a subset of partitions. Two sets
of Jaccard similarity g or more differ in at most ``k = s (1 - g) / g``
elements, s the size of either; each differing element spoils one partition,
so of the N partitions in which a set has elements, at least N - k hold the
same elements in both. Small bands enumerate all pairs of partitions (a pair
is more selective than a part), large bands single partitions:

* similar sets share at least ``need = N - k`` (or ``C(N - k, 2)``) signatures;
  a set with fewer signatures that anyone shares has no partner;
* a set with too few filled partitions for that promise also emits every
  partition, the empty ones included, of which one must be unspoilt; only such
  sets (rare by the choice of the number of partitions) meet there.

A set similar to another of the next band also emits that band's signatures.
Sharing a signature only makes a candidate: intersection and union are then
counted on the sets. Links are needed up to connectivity, so each signature's
holders are compared with the smallest of them (its centre) only. Holders that
stay in different components are compared by what sets them apart from their
centre c: for D(x) = x XOR c, the sets x and y differ in |D(x) XOR D(y)|
elements, so similar ones share at least t = (|D(x)| + |D(y)| - d) / 2
elements of D, where d = (|x| + |y|) (1 - g) / (1 + g). Were t not positive,
both would be linked with the centre already. A prefix filter on the small sets
D, rarest elements of the group first, names the pairs that are left to compare:
no link between components is lost, and a group of near copies is not compared
pair by pair. A centre's members are filtered in one task up to ``COMPARED`` elements of
them, and a link is looked for only between members that no link found there
joins yet: a group gives fewer links than it has members. For more elements, they
are counted, ranked and joined by Spark, the holders of each beside one of them
first, so that there too only what stays apart is joined pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import hash_strings, mix, shuffle_width, split_words, staged, text_slices, tidy
from gridcast.llm.components import components
from gridcast.operators.sizing import bounded_broadcast

# Bands below this one (sets of fewer than 16 shingles) enumerate pairs of
# partitions over a wide domain; the others single partitions.
PAIR_BANDS, PAIR_PARTS = 4, 1024
# Signature rows are packed by bucket; more buckets than tasks evens them out.
BUCKETS_PER_TASK = 4
# Elements of the members of one centre that one task takes at once (32 MB).
COMPARED = 4 << 20
# Rounds in which a set is compared with one centre only, or with one holder of an element.
ROUNDS = 2

_FOLD = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A-Z is lower-cased; a text of
    fewer words than ``words`` has its whole sequence as one shingle; null,
    empty and blank texts have none."""
    tokens, offsets = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashes = hash_strings(tokens)
    full = max(0, len(hashes) - words + 1)
    rolled = hashes[:full].copy()
    for j in range(1, words):
        rolled = mix(rolled * _FOLD + hashes[j : j + full])
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = mix(whole * _FOLD + h)
            yield whole
        else:
            yield hashes[:0]


def set_key(elements: np.ndarray) -> bytes:
    """128-bit identity of a set."""
    n = np.uint64(len(elements))
    return b"".join(mix(np.array([mix(elements ^ c).sum(dtype=np.uint64) ^ n])).tobytes() for c in (_FOLD, _SECOND))


class Bands:
    """Partition counts and signatures by size band for a threshold p / q."""

    def __init__(self, p: int, q: int):
        if not 0.6 <= p / q <= 1:
            raise ValueError("the similarity threshold must lie between 0.6 and 1")
        self.p, self.q = p, q
        spoilt, self.load = 1.15 * (q - p) / p, 0.05
        while self.load * (1 - math.exp(-1 / self.load)) < spoilt:  # parts per element that leave enough filled
            self.load += 0.005

    def differing(self, size: int) -> int:
        return size * (self.q - self.p) // self.p

    def bands(self, size: int) -> list[int]:
        """A set's own band, and the next where a similar set can lie in it."""
        own = size.bit_length() - 1
        return [own, own + 1] if size * self.q // self.p >= 2 << own else [own]

    def parts(self, band: int) -> int:
        top = (2 << band) - 1
        return PAIR_PARTS if band < PAIR_BANDS else math.ceil(self.load * top + 2 * math.sqrt(top))

    def signatures(self, elements: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(band, need, signatures) of a set; sets that admit no difference emit none."""
        size = len(elements)
        k = self.differing(size)
        if not k:
            return
        for band in self.bands(size):
            n = self.parts(band)
            seed = mix(np.array([band + 1], np.uint64) * _SECOND)
            part = mix(elements ^ seed) % np.uint64(n)
            order = np.argsort(part, kind="stable")
            sorted_part = part[order]
            starts = np.flatnonzero(np.diff(sorted_part, prepend=sorted_part[:1] + np.uint64(1)))
            filled = sorted_part[starts]
            content = np.add.reduceat(mix(elements ^ _SECOND)[order], starts)
            single = mix(content ^ mix(seed + filled))
            pairs = band < PAIR_BANDS
            spare = len(filled) - k
            if pairs:
                i, j = np.triu_indices(len(single), 1)
                yield band, max(1, math.comb(max(spare, 0), 2)), mix(single[i] * _FOLD + single[j])
            else:
                yield band, max(1, spare), single
            if spare < 1 + pairs:
                every = mix(np.arange(n, dtype=np.uint64) + (seed ^ _FOLD))
                every[filled.astype(np.int64)] = mix(single ^ _FOLD)
                yield band + 64, 1, every


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _planes(values: np.ndarray) -> bytes:
    """Bytes by significance: high bytes repeat, and compress away in the shuffle."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _describe(words: int):
    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = list(shingle_sets(batch.column("text"), words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), _binary([set_key(s) for s in sets])], ["id", "n", "node"]
                )

    return run


def _signature_rows(words: int, bands: Bands, buckets: int):
    """Signatures packed by bucket: one row per slice of texts and bucket. Within
    a task only the first of equal sets emits."""

    def run(batches):
        seen: set[bytes] = set()
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sigs, ids, need, band = [], [], [], []
                for i, elements in zip(batch.column("id").to_pylist(), shingle_sets(batch.column("text"), words)):
                    if i is None or not len(elements) or (key := set_key(elements)) in seen:
                        continue
                    seen.add(key)
                    for b, wanted, made in bands.signatures(elements):
                        sigs.append(made)
                        ids.append(np.full(len(made), i, np.int64))
                        need.append(np.full(len(made), min(wanted, 65535), np.uint16))
                        band.append(np.full(len(made), b, np.uint8))
                if not sigs:
                    continue
                sigs, ids, need, band = map(np.concatenate, (sigs, ids, need, band))
                bucket = (sigs % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                cols = [np.split(x[order], cuts[1:]) for x in (sigs, ids, need, band)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[order][cuts], pa.int32()), *[_binary([_planes(x) for x in c]) for c in cols]], ["bucket", "sigs", "ids", "need", "band"]
                )

    return run


STAR = "kind int, sig long, band int, a long, b long, n long, need int"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures held by several documents, bucket by bucket (rows come sorted by
    bucket). Kind 0: centre a, holder b, number of signatures n, the holder's
    need. Kind 1: holder b of a signature of three or more holders; signatures
    with the same holders have one key, so they fall together."""

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sigs, ids, need, band = (np.concatenate([_unplanes(r[i], t) for r in rows]) for i, t in enumerate((np.uint64, np.int64, np.uint16, np.uint8)))
        order = np.lexsort((ids, sigs))
        sigs, ids, need, band = sigs[order], ids[order], need[order], band[order]
        fresh = np.concatenate([[True], (sigs[1:] != sigs[:-1]) | (ids[1:] != ids[:-1])])
        sigs, ids, need, band = sigs[fresh], ids[fresh], need[fresh], band[fresh]
        starts = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
        sizes = np.diff(np.append(starts, len(sigs)))
        keep = np.repeat(sizes > 1, sizes)
        if not keep.any():
            return
        run_size = np.repeat(sizes, sizes)[keep]
        run = np.repeat(np.cumsum(sizes > 1) - 1, sizes)[keep]
        sigs, ids, need, band = sigs[keep], ids[keep], need[keep], band[keep]
        first = np.concatenate([[True], run[1:] != run[:-1]])
        centre = ids[np.flatnonzero(first)][run]
        key = np.rec.fromarrays([band, centre, ids], names="band,a,b")
        order = np.lexsort((ids, centre, band))
        change = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        count = np.diff(np.append(change, len(order)))
        pick = order[change]
        # Runs with the same holders say the same: one of them is enough.
        holders = np.add.reduceat(mix(ids.view(np.uint64) ^ _FOLD), np.flatnonzero(first))
        one = np.zeros(len(holders), bool)
        one[np.unique(holders, return_index=True)[1]] = True
        more = one[run] & (run_size > 2)

        def batch(kind, s, bnd, a, b, n, nd):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b), kind, np.int32)), pa.array(s.view(np.int64)), pa.array(bnd.astype(np.int32)), pa.array(a), pa.array(b), pa.array(n.astype(np.int64)), pa.array(nd.astype(np.int32))],
                ["kind", "sig", "band", "a", "b", "n", "need"],
            )

        yield batch(0, np.zeros(len(pick), np.uint64), band[pick], centre[pick], ids[pick], count, need[pick])
        if more.any():
            yield batch(1, holders[run][more], band[more], centre[more], ids[more], run_size[more], need[more])

    open_bucket, held = None, []
    for b in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in b.columns)):
            if bucket != open_bucket and held:
                yield from emit(held)
                held = []
            open_bucket = bucket
            held.append(tuple(row))
    if held:
        yield from emit(held)


def _set_rows(words: int):
    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = list(shingle_sets(batch.column("text"), words))
                yield pa.RecordBatch.from_arrays([batch.column("id"), _binary([s.tobytes() for s in sets])], ["rep", "elements"])

    return run


def _by_centre(batches) -> Iterator[tuple[int, int, np.ndarray, list[tuple[int, int, np.ndarray]]]]:
    """(centre, number of groups, its set, [(member, label, its set)]) for each group of
    about ``COMPARED`` elements; rows come sorted by (centre, salt), the
    centre's own set first in each group."""
    group, centre, members = None, None, []
    for batch in batches:
        for c, salt, salts, own, node, label, data in zip(*(col.to_pylist() for col in batch.columns)):
            elements = np.frombuffer(data, np.uint64)
            if own:
                if members:
                    yield group[0], group[2], centre, members
                group, centre, members = (c, salt, salts), elements, []
            elif group != (c, salt, salts):
                raise ValueError("a group without its centre")
            else:
                members.append((node, label, elements))
    if members:
        yield group[0], group[2], centre, members


def _members_in(centre: np.ndarray, elements: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(centre, elements), len(centre) - 1)
    return centre[at] == elements


def _similar(x: np.ndarray, y: np.ndarray, p: int, q: int) -> bool:
    both = int(_members_in(x, y).sum())
    return q * both >= p * (len(x) + len(y) - both)


def _compare(p: int, q: int):
    def run(batches):
        for centre, _, own, members in _by_centre(batches):
            linked = [node for node, _, elements in members if _similar(own, elements, p, q)]
            yield pa.RecordBatch.from_arrays([pa.array([centre] * len(linked), pa.int64()), pa.array(linked, pa.int64())], ["a", "b"])

    return run


class _Apart:
    """A member by what sets it apart from the centre: D, and how many of D's
    elements in a common order must be looked at when it is the one with the
    smaller D, or the larger. Of two members in different components one at
    most is linked with the centre, but that may be either of them."""

    def __init__(self, node: int, label: int, elements: np.ndarray, centre: np.ndarray, p: int, q: int):
        self.node, self.label, self.elements, self.size = node, label, elements, len(elements)
        extra, missing = elements[~_members_in(centre, elements)], centre[~_members_in(elements, centre)]
        self.d = np.concatenate([mix(extra), mix(missing)])
        both = self.size - len(extra)
        most = self.size * (q - p) // p  # elements in which it can differ from a similar set
        # A similar set that is not linked is at least this far from the centre. If
        # the larger one is linked, this one is not, and no nearer than that itself.
        least = (p * self.size + q * len(centre)) * (q - p) // (q * (q + p)) + 1
        share = max(1, -(-(len(self.d) + max(len(self.d), least) - most) // 2))
        self.small = max(0, len(self.d) - share + 1)
        linked = q * both >= p * (len(centre) + len(extra))
        # A linked one is the larger only beside one that is not linked.
        self.large = 0 if linked and len(self.d) < least else min(len(self.d), most + 1)


class _Joined:
    """Labels joined by links so far; every label is its own at first."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, label: int) -> int:
        while (above := self.up.get(label, label)) != label:
            self.up[label] = label = self.up.get(above, above)
        return label

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)

    def gather(self, holders: dict[int, list[tuple[int, int]]]) -> None:
        """Put lists of joined labels together, the shorter behind the longer."""
        for label in [x for x in holders if x in self.up]:
            root, moved = self.root(label), holders.pop(label)
            kept = holders.get(root, [])
            if len(kept) < len(moved):
                kept, moved = moved, kept
            kept.extend(moved)
            holders[root] = kept


def _links_inside(members: list[_Apart], p: int, q: int, spanning: bool = False) -> list[tuple[int, int]]:
    """Links between members of one group that have different labels: all of them, or
    (``spanning``) as many as join the same labels, fewer than there are labels."""
    every, place, count = np.unique(np.concatenate([m.d for m in members]), return_inverse=True, return_counts=True)
    order = np.argsort(count, kind="stable")
    rank = np.empty(len(every), np.int64)
    rank[order] = np.arange(len(every))
    sorted_ranks, shared = [], count[order] > 1
    for part in np.split(place, np.cumsum([len(m.d) for m in members])[:-1]):
        sorted_ranks.append(np.sort(rank[part]))
    # Holders of an element by their label, or by what it is joined with.
    index: dict[int, dict[int, list[tuple[int, int]]]] = {}
    for y, (m, ranks) in enumerate(zip(members, sorted_ranks)):
        for pos, element in enumerate(ranks[: m.small].tolist()):
            if shared[element]:
                index.setdefault(element, {}).setdefault(m.label, []).append((y, pos))
    links, joined = [], _Joined()
    for x, (m, ranks) in enumerate(zip(members, sorted_ranks)):
        seen: set[int] = set()
        for pos, element in enumerate(ranks[: m.large].tolist()):
            holders = index.get(element, {})
            joined.gather(holders)
            for label, listed in holders.items():
                if joined.root(label) == joined.root(m.label):
                    continue
                for y, at in listed:
                    other = members[y]
                    if y in seen or len(other.d) > len(m.d):
                        continue
                    # Elements still to come bound what the two can share.
                    ahead = min(len(m.d) - pos, len(other.d) - at)
                    if 2 * ahead >= len(m.d) + len(other.d) - (m.size + other.size) * (q - p) // (q + p):
                        seen.add(y)
                        if _similar(m.elements, other.elements, p, q):
                            links.append((m.node, other.node))
                            if spanning:
                                joined.join(m.label, label)
                                break
    return links


APART = "kind int, a long, b long, label long, element long, apart int, size int, small int, large int"


def _apart_rows(p: int, q: int):
    """Kind 0: a link (a, b) found inside a whole group, fewer of them than it has
    members. Kind 1: an element of D(b) for a member b of a centre a with more
    members than one task takes."""

    def run(batches):
        for c, groups, centre, raw in _by_centre(batches):
            members = [_Apart(node, label, elements, centre, p, q) for node, label, elements in raw]
            if groups == 1:
                links = _links_inside(members, p, q, spanning=True)
                n = len(links)
                a, b = zip(*links) if links else ((), ())
                cols = [[0] * n, a, b, *[[None] * n] * 6]
            else:
                sizes = [len(m.d) for m in members]
                spread = lambda values: np.repeat(np.array(values, np.int64), sizes)  # noqa: E731, B023
                d = np.concatenate([m.d for m in members]).view(np.int64)
                cols = [np.ones(len(d), np.int64), np.full(len(d), c), spread([m.node for m in members]), spread([m.label for m in members]), d]
                cols += [spread(v) for v in (sizes, [m.size for m in members], [m.small for m in members], [m.large for m in members])]
            kinds = [pa.int32()] + [pa.int64()] * 4 + [pa.int32()] * 4
            names = ["kind", "a", "b", "label", "element", "apart", "size", "small", "large"]
            yield pa.RecordBatch.from_arrays([pa.array(v).cast(t) if isinstance(v, np.ndarray) else pa.array(v, t) for v, t in zip(cols, kinds)], names)

    return run


def _with_centres(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets of the members (b, with a label) of every centre (a), dealt by centre. A
    centre's set is sent once per ``COMPARED`` elements of its members, so a centre
    of very many or very large members is many groups, and a task holds no more."""
    sizes = sets.select(F.col("rep").alias("b"), (F.length("elements") / 8).cast("long").alias("size"))
    groups = pairs.join(sizes, "b").groupBy("a").agg(F.ceil(F.sum("size") / COMPARED).alias("salts"))
    members = pairs.join(groups, "a").select(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), "salts", F.lit(False).alias("own"), F.col("b").alias("rep"), "label")
    owns = groups.select(F.col("a").alias("centre"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "salts", F.lit(True).alias("own"), F.col("a").alias("rep"), F.lit(None).cast("long").alias("label"))
    rows = members.unionByName(owns).join(sets, "rep").select("centre", "salt", "salts", "own", "rep", "label", "elements")
    return rows.repartition(shuffle_width(pairs.sparkSession), "centre", "salt").sortWithinPartitions("centre", "salt", F.desc("own"))


def _verify(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    rows = _with_centres(pairs.withColumn("label", F.lit(None).cast("long")), sets)
    return staged(rows.mapInArrow(tidy(_compare(p, q)), "a long, b long"), "jaccard-links")


def _enough(p: int, q: int) -> Column:
    """Whether x and y, which share their i-th and j-th element, can be similar."""
    ahead = F.least(F.col("dx") - F.col("i"), F.col("dy") - F.col("j"))
    return 2 * ahead >= F.col("dx") + F.col("dy") - F.floor((F.col("sx") + F.col("sy")) * F.lit(q - p) / F.lit(q + p))


def _links_beside_centres(groups: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Links that join the members of one centre in different components; ``groups``:
    centre a, member b, the member's component label."""
    rows = staged(_with_centres(groups, sets).mapInArrow(tidy(_apart_rows(p, q)), APART), "jaccard-apart")
    links = rows.where("kind = 0").select("a", "b")
    big = rows.where("kind = 1")
    if big.isEmpty():
        return links
    # Elements that no other member has match nothing and come first.
    counts = big.groupBy("a", "element").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_member = Window.partitionBy("a", "b")
    place = F.col("apart") - F.count(F.lit(1)).over(of_member) + F.row_number().over(of_member.orderBy("n", "element")) - 1
    ranked = staged(big.join(counts, ["a", "element"]).withColumn("pos", place).where("pos < greatest(small, large)"), "jaccard-ranked")
    # The holders of an element beside one of them, another in each round: a group of
    # near copies is joined by as many pairs as its elements have holders, not their square.
    members = groups.select(F.col("b").alias("a"), F.col("label").alias("b"))
    for turn in range(ROUNDS):
        one = F.min_by(F.struct(F.col("b").alias("x"), F.col("pos").alias("i"), F.col("apart").alias("dx"), F.col("size").alias("sx"), F.col("label").alias("lx")), F.xxhash64("b", F.lit(turn)))
        ones = ranked.groupBy("a", "element").agg(one.alias("one")).select("a", "element", "one.*")
        beside = ranked.withColumnsRenamed({"b": "y", "pos": "j", "apart": "dy", "size": "sy", "label": "ly"}).join(ones, ["a", "element"])
        beside = staged(beside.where("lx <> ly").where(_enough(p, q)).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "jaccard-beside")
        links = links.unionByName(_verify(beside, sets, p, q))
        now = components(members.unionByName(links)).select(F.col("node").alias("b"), "component")
        ranked = ranked.join(now, "b", "left").withColumn("label", F.coalesce("component", "label")).drop("component")
        mixed = ranked.groupBy("a", "element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("a", "element")
        ranked = staged(ranked.join(mixed, ["a", "element"]), "jaccard-ranked")
        if ranked.isEmpty():
            return links
    x = ranked.where("pos < large").select("a", "element", F.col("b").alias("x"), F.col("pos").alias("i"), F.col("apart").alias("dx"), F.col("size").alias("sx"), F.col("label").alias("lx"))
    y = ranked.where("pos < small").select("a", "element", F.col("b").alias("y"), F.col("pos").alias("j"), F.col("apart").alias("dy"), F.col("size").alias("sy"), F.col("label").alias("ly"))
    met = x.join(y, ["a", "element"]).where("x <> y AND lx <> ly AND dy <= dx").where(_enough(p, q))
    rest = staged(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "jaccard-rest")
    return links.unionByName(_verify(rest, sets, p, q))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable by
    links of Jaccard similarity p / q or more).

    Null, empty and blank texts have empty sets and are linked with nothing.
    Rows of equal sets are one class. A row without an id takes no part in
    links and has no component. Repeated rows give a row each. Other columns
    are not looked at; an empty table gives no rows.
    """
    spark = df.sparkSession
    bands = Bands(p, q)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = staged(source.mapInArrow(tidy(_describe(words)), "id long, n long, node binary"), "jaccard-sets")
    classes = sets.where("n > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes, "jaccard-classes")
    rep_of = sets.where("n > 0").join(classes.select("node", "rep"), "node").select("id", "rep", "n")

    width = shuffle_width(spark)
    packed = source.mapInArrow(tidy(_signature_rows(words, bands, width * BUCKETS_PER_TASK)), "bucket int, sigs binary, ids binary, need binary, band binary")
    shared = staged(packed.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_shared), STAR), "jaccard-shared")
    stars = shared.where("kind = 0").select("band", "a", "b", "n", "need")
    # A document that shares fewer signatures than a partner would share has none.
    live = stars.groupBy("band", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need")).where("n >= need").select("band", F.col("b").alias("id"))
    live = staged(live.join(rep_of, "id").select("band", "id", "rep", F.col("n").alias("size")), "jaccard-live")

    # Holders of a signature that three or more share, and their smallest live one.
    holders = shared.where("kind = 1").select("sig", "band", F.col("b").alias("id")).distinct().join(live, ["band", "id"]).select("sig", "rep", "size")
    centres = holders.groupBy("sig").agg(F.min(F.struct("rep", "size")).alias("c"), F.max("rep").alias("last")).where("c.rep < last")
    centres = centres.select("sig", F.col("c.rep").alias("a"), F.col("c.size").alias("sa"))
    holders = staged(holders.join(centres, "sig").where("rep <> a").select("sig", "a", "sa", F.col("rep").alias("b"), F.col("size").alias("sb")), "jaccard-holders")

    a_end = live.select("band", F.col("id").alias("a"), F.col("rep").alias("ra"), F.col("size").alias("sa"))
    b_end = live.select("band", F.col("id").alias("b"), F.col("rep").alias("rb"), F.col("size").alias("sb"))
    # A pair meets in many buckets: once is enough.
    met = stars.where("a <> b").select("band", "a", "b").distinct()
    direct = met.join(a_end, ["band", "a"]).join(b_end, ["band", "b"]).where("ra <> rb")
    direct = direct.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), "sa", "sb")
    sized = (F.col("sa") * q >= F.col("sb") * p) & (F.col("sb") * q >= F.col("sa") * p)
    pairs = staged(direct.unionByName(holders.select("a", "b", "sa", "sb")).where(sized).select("a", "b").distinct(), "jaccard-pairs")

    # The sets of live documents; the list of them is broadcast only if it is small.
    wanted, _ = bounded_broadcast(live.select(F.col("rep").alias("id")).distinct())
    elements = staged(source.join(wanted, "id").mapInArrow(tidy(_set_rows(words)), "rep long, elements binary").dropDuplicates(["rep"]), "jaccard-elements")

    # First each set beside one centre, the smallest it has met, then beside the
    # smallest of another component; only what then still lies in two components
    # is compared pair by pair. Pairs within a component add nothing to it.
    links, first, rest = None, None, pairs
    for turn in range(ROUNDS + 1):
        if first is not None:
            label = first.select(F.col("node").alias("a"), F.col("component").alias("la"))
            rest = rest.join(tried, ["a", "b"], "left_anti").join(label, "a", "left").withColumn("la", F.coalesce("la", "a"))
            rest = rest.join(label.toDF("b", "lb"), "b", "left").where("la <> coalesce(lb, b)").select("a", "b")
            rest = staged(rest, "jaccard-rest")
        tried = rest if turn == ROUNDS else rest.groupBy("b").agg(F.min("a").alias("a"))
        found = _verify(tried, elements, p, q)
        links = found if links is None else links.unionByName(found)
        first = staged(components(links), "jaccard-components")

    # Signatures whose holders lie in different components, by centre.
    side = first.select(F.col("node").alias("b"), F.col("component").alias("label"))
    labelled = holders.select("sig", "a", "b").join(side, "b", "left").withColumn("label", F.coalesce("label", "b"))
    open_sigs = labelled.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("sig")
    groups = staged(labelled.join(open_sigs, "sig").select("a", "b", "label").distinct(), "jaccard-groups")
    if not groups.isEmpty():
        more = _links_beside_centres(groups, elements, p, q)
        first = staged(components(links.unionByName(more)), "jaccard-components")

    by_class = classes.join(first, classes.rep == first.node, "left").select(classes.node, F.coalesce("component", "rep").alias("component_id"))
    joined = sets.join(by_class, "node", "left")
    alone = F.when(F.col("id").isNull(), F.lit(None).cast("long")).when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """The rows of ``df`` without those that are not their component's smallest id.
    Rows without an id stay. The list of ids that go is broadcast only if it is small."""
    members = jaccard_join(df, id_col, text_col, words, p, q)
    gone, _ = bounded_broadcast(members.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone_")).distinct())
    return df.join(gone, F.col(id_col).cast("long") == F.col("gone_"), "left_anti")
