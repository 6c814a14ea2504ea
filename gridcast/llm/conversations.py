"""Repair of conversation structure: a persistent audit dynamic program.

Rows of a conversation are kept, re-roled, deleted or joined by inserted rows
at fixed costs, until the initials of the roles read ``(s?(ua)+)?``. The
program runs from the last row to the first: for each place and each state of
that pattern it holds the cost and the edit letters of the cheapest way to the
end. A list of letters is a node, its first letter linked with the node of the
rest, so lists share what they have in common; nodes hold binary-lifting links
and rolling hashes of their first 1, 2, 4, ... letters. Of equally cheap lists
the ASCII-least wins: the longest common prefix is found by descending powers
of two, and blocks with equal hashes are compared by their halves (verified
pairs are remembered). Going backwards makes the choice sound: lists that
follow the same place are compared whole.

Rows travel twice. The program sees digests and flags, no texts; the texts are
then read in order beside the letters, row by row. So a task holds a few
numbers per row of the conversation it is at, and one batch of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import bound_batches, shuffle_width, staged, tidy

# Costs and names of the edits, roles by initial, ASCII white space.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"
# The pattern's states: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
FORCED = ["u", "u", "a", "u"]  # the only role an inserted or re-roled row can have
ENDS = (0, 3)
PRIME, BASE = (1 << 61) - 1, 911382323


class EditLists:
    """Lists of letters that share their tails. Node 0 is the empty list."""

    def __init__(self) -> None:
        self.letter, self.size, self.next, self.hash = [""], [0], [[]], [[]]
        self.nodes: dict[tuple[str, int], int] = {}
        self.equal: set[tuple[int, int, int]] = set()
        self.power = [BASE]

    def put(self, letter: str, rest: int) -> int:
        node = self.nodes.get((letter, rest))
        if node is not None:
            return node
        node = self.nodes[letter, rest] = len(self.letter)
        size = self.size[rest] + 1
        links, hashes = [rest], [ord(letter)]
        k = 1
        while 1 << k <= size:
            if k > len(self.power) - 1:
                self.power.append(self.power[-1] * self.power[-1] % PRIME)
            half = links[k - 1]
            hashes.append((hashes[k - 1] * self.power[k - 1] + self.hash[half][k - 1]) % PRIME)
            links.append(self.next[half][k - 1])
            k += 1
        self.letter.append(letter)
        self.size.append(size)
        self.next.append(links)
        self.hash.append(hashes)
        return node

    def same_block(self, k: int, x: int, y: int) -> bool:
        """Whether the first 2^k letters agree: hashes first, then the halves they stand for."""
        if x == y:
            return True
        if self.hash[x][k] != self.hash[y][k]:
            return False
        if k == 0 or (k, x, y) in self.equal:
            return True
        todo, seen = [(k, x, y)], []
        while todo:
            j, a, b = todo.pop()
            if a == b or (j, a, b) in self.equal:
                continue
            if self.hash[a][j] != self.hash[b][j]:
                return False  # a collision further up
            if j:
                seen.append((j, a, b))
                todo += [(j - 1, a, b), (j - 1, self.next[a][j - 1], self.next[b][j - 1])]
        self.equal.update(seen)
        return True

    def less(self, x: int, y: int) -> bool:
        if x == y:
            return False
        for k in range(max(len(self.next[x]), len(self.next[y])) - 1, -1, -1):
            while x != y and k < len(self.next[x]) and k < len(self.next[y]) and self.same_block(k, x, y):
                x, y = self.next[x][k], self.next[y][k]
        return x != y and (x == 0 or (y != 0 and self.letter[x] < self.letter[y]))

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.next[node][0]
        return "".join(out)


def cheapest_edits(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, letters) for rows of (role's initial, must go, is truncated)."""
    lists = EditLists()

    def better(a: tuple[int, int] | None, b: tuple[int, int]) -> tuple[int, int]:
        if a is None or b[0] < a[0] or (b[0] == a[0] and lists.less(b[1], a[1])):
            return b
        return a

    def with_inserts(best: list[tuple[int, int] | None]) -> list[tuple[int, int]]:
        for _ in STEP:  # no cheapest way inserts more rows than there are states
            for q, forced in enumerate(FORCED):
                then = best[STEP[q][forced]]
                if then is not None and (best[q] is None or then[0] + INSERT <= best[q][0]):
                    best[q] = better(best[q], (then[0] + INSERT, lists.put("I", then[1])))
        return best

    best = with_inserts([(0, 0) if q in ENDS else None for q in range(len(STEP))])
    for initial, must_go, truncated in reversed(rows):
        now: list[tuple[int, int] | None] = []
        for q, step in enumerate(STEP):
            cost, node = best[q]
            own = (cost + DELETE, lists.put("D", node))
            if not must_go:
                if initial in step:
                    cost, node = best[step[initial]]
                    if cost + KEEP + truncated * TRUNCATED <= own[0]:
                        own = better(own, (cost + KEEP + truncated * TRUNCATED, lists.put("K", node)))
                cost, node = best[step[FORCED[q]]]
                if cost + REROLE + truncated * TRUNCATED <= own[0]:
                    own = better(own, (cost + REROLE + truncated * TRUNCATED, lists.put("R", node)))
            now.append(own)
        best = with_inserts(now)
    return best[0][0], lists.text(best[0][1])


class Replay:
    """Letters applied to rows as they come; yields (role, text) of what stays."""

    def __init__(self, letters: str) -> None:
        self.letters, self.at, self.state = letters, 0, 0

    def _go(self, initial: str) -> None:
        self.state = STEP[self.state][initial]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            initial = FORCED[self.state]
            self._go(initial)
            yield ROLES[initial], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self._go(role[:1])
            yield role, text
        elif letter == "R":
            initial = FORCED[self.state]
            self._go(initial)
            yield ROLES[initial], text


AUDIT = "conv long, some long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and order to one row per conversation."""
    names = [f.strip().split()[0] for f in AUDIT.split(",")]
    conv, rows, out = None, [], []
    first = last = before = None
    distinct = 0
    seen: set[tuple[str, bytes]] = set()
    tally = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal

    def close() -> None:
        cost, audit = cheapest_edits(rows)
        gaps = 0 if first is None else last - first + 1 - distinct
        out.append((conv[0], len(rows), gaps, *tally, cost, audit))

    def flush() -> pa.RecordBatch:
        cols = [pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, zip(*out) if out else [[]] * len(names))]
        out.clear()
        return pa.RecordBatch.from_arrays(cols, names)

    for batch in batches:
        for c, turn, role, digest, blank, ended in zip(*[batch.column(n).to_pylist() for n in ("conv", "turn", "role", "digest", "blank", "ended")]):
            if conv is None or conv[0] != c:
                if conv is not None:
                    close()
                conv, rows, first, last, before, distinct = (c,), [], None, None, None, 0
                seen, tally = set(), [0, 0, 0, 0]
            if turn is not None:
                first = turn if first is None else first
                distinct += turn != last
                last = turn
            copy = (role, digest) in seen
            seen.add((role, digest))
            initial = role[:1]
            cut = not blank and not copy and not ended
            tally[0] += blank
            tally[1] += copy and not blank
            tally[2] += cut
            tally[3] += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            rows.append((initial, blank or copy, cut))
        if len(out) > 1000:
            yield flush()
    if conv is not None:
        close()
    yield flush()


def _apply(as_rows: bool):
    """Arrow function: a conversation's letters, then its rows in order, to its repaired rows or their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, replay, summary, sha, n = None, Replay(""), None, None, 0
        out: list[tuple] = []

        def take(pieces: Iterator[tuple[str, str]]) -> None:
            nonlocal n
            for role, text in pieces:
                if as_rows:
                    out.append((conv[0], n, role, text))
                else:
                    sha.update((("\n" if n else "") + role + ":" + text).encode())
                n += 1

        def close() -> None:
            take(replay.inserted())
            if not as_rows:
                out.append((conv[0], sha.hexdigest()))

        def flush() -> pa.RecordBatch:
            if as_rows:
                kinds = {"conv": pa.int64(), "position": pa.int64(), "role": pa.string(), "text": pa.string()}
            else:
                kinds = {"conv": pa.int64(), "repaired_sha256": pa.string()}
            cols = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds.values())]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, list(kinds))

        for batch in batches:
            for c, kind, audit, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv", "kind", "audit", "role", "text")]):
                if kind == 0:
                    if conv is not None:
                        close()
                    conv, replay, sha, n = (c,), Replay(audit), hashlib.sha256(), 0
                else:
                    take(replay.row(role, text))
            yield flush()
        if conv is not None:
            close()
        yield flush()

    return run


def _ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of a conversation in one partition, in order. (A join would let
    adaptive execution split a large conversation over tasks.)"""
    return df.repartition(shuffle_width(df.sparkSession), "conv").sortWithinPartitions("conv", *keys)


def _clean(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
    )


def audit_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``some`` (its rows), ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``.

    Rows are taken by turn, null turns first; rows of one turn by role, then by
    the digest of their text. A null role or text is one space. A row whose
    role is empty fits nowhere and is re-roled or deleted. A null conversation
    id is a conversation. Repeated rows are duplicates. An empty table gives no
    rows.
    """
    bound_batches(rows.sparkSession)
    clean = _clean(rows, conv_col, turn_col, role_col, text_col)
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    light = clean.select("conv", "turn", "role", F.unhex("digest").alias("digest"), (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"))
    return _ordered(light, ["turn", "role", "digest"]).mapInArrow(tidy(_audits), AUDIT)


def _beside(rows: DataFrame, audits: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    clean = _clean(rows, conv_col, turn_col, role_col, text_col).select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv", F.lit(0).alias("kind"), *[F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))], "audit")
    return _ordered(clean.unionByName(heads), ["kind", "turn", "role", "digest"])


def repaired_rows(rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``position``, ``role``, ``text`` of the repaired conversations."""
    return _beside(rows, audits, conv_col, turn_col, role_col, text_col).mapInArrow(tidy(_apply(True)), "conv long, position long, role string, text string")


def repaired_digests(rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``repaired_sha256``: SHA-256 of the ``role:text`` lines, joined by newlines."""
    return _beside(rows, audits, conv_col, turn_col, role_col, text_col).mapInArrow(tidy(_apply(False)), "conv long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by the CRC-32 of ``conv_id:turn`` (a null is one space)."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("_harm"))
    rows = rows.where("_harm <> 0").withColumns(
        {
            "text": F.when(F.col("_harm") == 1, F.lit("")).when(F.col("_harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(F.col("_harm") == 4, F.lit("user")).otherwise(F.col("role")),
        }
    )
    copies = F.when(F.col("_harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies)).drop("col")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every original conversation."""
    rows = damaged(conversations)
    audits = staged(audit_conversations(rows), "conversation-audits")
    fixed = repaired_digests(rows, audits)
    found = audits.withColumn("_here", F.lit(1)).drop("some").alias("a").join(fixed.alias("f"), F.col("a.conv").eqNullSafe(F.col("f.conv"))).select("a.*", "repaired_sha256")
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = all_ids.join(found, all_ids["conv_id"].eqNullSafe(found["conv"]), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return joined.select(
        "conv_id",
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
