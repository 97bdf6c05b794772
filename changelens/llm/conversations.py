"""Conversation structure repair: the cheapest edits that give a well-formed order of roles, found by Dijkstra's
algorithm from both ends of the edit lattice."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Rows that are searched at once; longer conversations are searched in blocks, whose results are joined.
BLOCK = 256
#: Edited rows that leave a task in one row.
CHUNK = 4096
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: States of `(s?(ua)+)?`: nothing yet; after s; after u; after a. What may follow, and where the pattern may end.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
NEVER = 1 << 60

SPACE = " \t\n\v\f\r"


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (null roles and texts are one space), damaged by crc32 of `conv_id:turn` (a null is one space there) modulo 20:
    0 drops the row, 1 empties the text, 2 removes its `.!?`, 3 repeats the row, 4 makes the role user. A conversation that has lost
    all rows has one with gone true, so that it is not forgotten; other rows have gone false. Other columns are not read."""
    space = lambda c: F.coalesce(df[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = df.select(df["conv_id"].cast("long").alias("conv_id"), df["turn"].cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    kept = rows.where("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    lost = rows.groupBy("conv_id").agg(F.max("kind").alias("most")).where("most = 0")
    return kept.select("conv_id", "turn", "role", "text", F.lit(False).alias("gone")).unionByName(lost.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(True).alias("gone")))


def _steps(rows: list[tuple[str, bool, bool]], i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """Edits at a node (rows before i are done): next i, next state, cost, initial. A row: its role's initial, whether it must go, whether it is cut off."""
    follows = FOLLOWS[state]
    if i < len(rows):
        initial, must_go, cut = rows[i]
        yield i + 1, state, DELETE, "D"
        if not must_go:
            if initial in follows:
                yield i + 1, follows[initial], KEEP + CUT * cut, "K"
            for role in "ua":
                if role in follows and role != initial:
                    yield i + 1, follows[role], REROLE + CUT * cut, "R"
    for role in "ua":
        if role in follows:
            yield i, follows[role], INSERT, "I"


def _back_steps(rows: list[tuple[str, bool, bool]], i: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """The same edges against their direction: nodes from which one edit leads here."""
    for before in range(len(FOLLOWS)):
        for j in (i - 1, i):
            if j >= 0:
                for a, s, cost, initial in _steps(rows, j, before):
                    if (a, s) == (i, state):
                        yield j, before, cost, initial


def cheapest(rows: list[tuple[str, bool, bool]], entry: int, ends: tuple[int, ...]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits from the state entry to one of ends over all rows, of equal cost the one whose
    initials are least; (NEVER, "") where there is none.

    One search runs forward, one back, each with a heap of its own in order of (cost, rows done), so that a node's label is final when it is taken: all nodes that lead
    to it at the same cost have done fewer rows. The cheaper search goes on; an edge from a node that is settled forward to one that is settled backward is
    a crossing. The searches end when the least costs in both heaps sum to more than the best crossing: by then every path of the
    best cost has an edge that was met. To one node, no audit of the least cost is the beginning of another (the rest would be inserts, which cost),
    so the least beginning and the least rest make the least audit across that edge."""
    n, best = len(rows), (NEVER, "")
    ahead, back = {(0, entry): (0, "")}, {(n, s): (0, "") for s in ends}
    heaps, labels, settled = ([(0, 0, entry)], [(0, 0, s) for s in sorted(ends)]), (ahead, back), ({}, {})
    if n == 0 and entry in ends:
        best = (0, "")
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else NEVER for h in heaps]
        if tops[0] + tops[1] > best[0]:
            break
        side = 0 if heaps[0] and (tops[0] <= tops[1] or not heaps[1]) else 1
        cost, done, state = heappop(heaps[side])
        node = (n - done if side else done, state)
        if node in settled[side]:
            continue
        _, audit = settled[side][node] = labels[side][node]
        for i, s, more, initial in (_back_steps if side else _steps)(rows, *node):
            to, whole = (i, s), initial + audit if side else audit + initial
            if to in settled[1 - side]:
                other_cost, other = settled[1 - side][to]
                best = min(best, (cost + more + other_cost, whole + other if not side else other + whole))
            if to not in settled[side] and ((cost + more, whole) < labels[side].get(to, (NEVER, ""))):
                labels[side][to] = (cost + more, whole)
                heappush(heaps[side], (cost + more, n - i if side else i, s))
    return best


ROW = ["conv_id", "has_turn", "at", "role", "tie", "uid", "turn", "initial", "blank", "duplicate", "truncated"]
ORDER = ROW[:6]
SUMMARY = "conv_id long, has_turn int, at long, role string, tie long, uid long, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, initials string, uids array<bigint>, costs array<bigint>, audits array<string>"
JOINED = "conv_id long, chunk long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, uids array<bigint>, roles array<string>"
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[kind]) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _summary(rows: list[tuple], starts: bool, ends: bool) -> tuple:
    """A block of a conversation's rows as one row: its first row's place in order, counts, the cheapest edits from each state to each (from 0,
    and to the pattern's ends, alone where the conversation starts or ends here)."""
    turns = [r[6] for r in rows if r[6] is not None]
    lattice = [(r[7], r[8] or r[9], r[10]) for r in rows]
    costs, audits = [NEVER] * 16, [""] * 16
    for entry in (0,) if starts else range(4):
        for end in ENDS if ends else range(4):
            costs[4 * entry + end], audits[4 * entry + end] = cheapest(lattice, entry, (end,))
    counts = (sum(r[k] for r in rows) for k in (8, 9, 10))
    return (*rows[0][:6], turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), *counts, "".join(r[7] for r in rows), [r[5] for r in rows], costs, audits)


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Summaries of the blocks of the conversations that rows in order hold. The task's first and last conversation may have rows elsewhere."""
    held, starts, out = [], False, []  # starts: whether the conversation's first row is the first of those held
    for row in _rows(batches):
        if held and row[0] != held[0][0]:
            out.append(_summary(held, starts, True))
            held, starts = [], True
        elif len(held) == block:
            out.append(_summary(held, starts, False))
            held, starts = [], False
        held.append(row)
        if len(out) >= 512:
            yield _batch(out, SUMMARY)
            out = []
    if held:
        out.append(_summary(held, starts, False))
    if out:
        yield _batch(out, SUMMARY)


def _edits(audit: str, initials: str, uids: list[int]) -> Iterator[tuple[int | None, str | None]]:
    """(uid, role) of the repaired rows: no uid for a row put in, no role for one that keeps its own."""
    state, at = 0, 0
    for edit in audit:
        role = "a" if state == 2 else "u"
        if edit == "K":
            role = initials[at]
        if edit != "D":
            state = FOLLOWS[state][role]
            yield (None if edit == "I" else uids[at]), (None if edit == "K" else {"u": "user", "a": "assistant"}[role])
        at += edit != "I"


def _conversation(blocks: list[tuple]) -> Iterator[tuple]:
    """The cheapest edits of a whole conversation: from block to block, each state's least cost and audit. What all states' audits begin with is put aside."""
    done, labels, counts = [], {0: (0, "")}, [0, 0, 0]
    first = last = None
    distinct = 0
    for b in blocks:
        costs, audits = b[14], b[15]
        new: dict[int, tuple[int, str]] = {}
        for entry, (cost, audit) in labels.items():
            for end in range(4):
                if costs[4 * entry + end] < NEVER:
                    new[end] = min(new.get(end, (NEVER, "")), (cost + costs[4 * entry + end], audit + audits[4 * entry + end]))
        shared = len(os.path.commonprefix([audit for _, audit in new.values()]))
        done.append(next(iter(new.values()))[1][:shared])
        labels = {state: (cost, audit[shared:]) for state, (cost, audit) in new.items()}
        counts = [n + m for n, m in zip(counts, b[9:12], strict=True)]
        distinct += b[8] - (b[6] is not None and b[6] == last)
        first, last = b[6] if first is None else first, last if b[7] is None else b[7]
    cost, rest = min(labels[s] for s in ENDS if s in labels)
    audit, initials = "".join(done) + rest, "".join(b[12] for b in blocks)
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
    gaps = last - first + 1 - distinct if distinct else 0
    chunk, uids, roles = 0, [], []
    stats = (gaps, *counts, illegal, cost, audit)
    for uid, role in _edits(audit, initials, [u for b in blocks for u in b[13]]):
        uids.append(uid)
        roles.append(role)
        if len(uids) == CHUNK:
            yield (blocks[0][0], chunk, *stats, uids, roles)
            chunk, uids, roles, stats = chunk + 1, [], [], (None,) * 7
    if uids or not chunk:
        yield (blocks[0][0], chunk, *stats, uids, roles)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    out: list[tuple] = []
    for row in _rows(batches):
        if held and row[0] != held[0][0]:
            out += _conversation(held)
            held = []
            if len(out) >= 512:
                yield _batch(out, JOINED)
                out = []
        held.append(row)
    if held:
        out += _conversation(held)
    if out:
        yield _batch(out, JOINED)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's lines, joined by line feeds, as they pass."""
    now, sha, begun = None, None, False
    for batch in batches:
        ids, shas = [], []
        for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if not begun or conv != now:
                if begun:
                    ids.append(now)
                    shas.append(sha.hexdigest())
                now, sha, begun = conv, hashlib.sha256(line), True
            else:
                sha.update(b"\n")
                sha.update(line)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string())], ["id", "sha"])
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([sha.hexdigest()])], ["id", "sha"])


def _solved(df: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their numbers, and for each conversation its counts, cost and audit (in chunk 0) and edits (JOINED)."""
    space = lambda c: F.coalesce(df[c].cast("string"), F.lit(" "))
    rows = df.select(F.monotonically_increasing_id().alias("uid"), df["conv_id"].cast("long").alias("conv_id"), df["turn"].cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    if "gone" in df.columns:
        rows = df.where(~df["gone"]).select(*(c for c in ("conv_id", "turn")), space("role").alias("role"), space("text").alias("text")).withColumn("uid", F.monotonically_increasing_id())
    rows = written(rows.select("uid", "conv_id", "turn", "role", "text"), "conversation-rows")
    bare = F.rtrim("text", F.lit(SPACE))
    thin = rows.select("uid", "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("same"), F.xxhash64("text").alias("tie"), (bare == "").alias("empty"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    thin = thin.withColumn("has_turn", F.col("turn").isNotNull().cast("int")).withColumn("at", F.coalesce("turn", F.lit(0).cast("long")))
    # of equal rows of a conversation the first is no duplicate; one number for each, so that the join has no hot key
    firsts = thin.groupBy("conv_id", "role", "same").agg(F.min_by("uid", F.struct("has_turn", "at", "uid")).alias("uid")).select("uid", F.lit(True).alias("is_first"))
    marked = thin.join(firsts, "uid", "left").withColumn("duplicate", ~F.col("empty") & F.col("is_first").isNull())
    marked = marked.select(*ORDER, "turn", F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1)).alias("initial"), F.col("empty").alias("blank"), "duplicate", (F.col("cut") & ~F.col("empty") & ~F.col("duplicate")).alias("truncated"))
    sorted_rows = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    blocks = written(sorted_rows.select(*ROW).mapInArrow(lambda it: _blocks(it, block), SUMMARY), "conversation-blocks")
    return rows, written(blocks.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(_joined, JOINED), "conversation-edits")


def _repaired_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    edits = solved.select("conv_id", "chunk", F.posexplode(F.arrays_zip("uids", "roles")).alias("pos", "edit")).select("conv_id", (F.col("chunk") * CHUNK + F.col("pos")).alias("place"), F.col("edit.uids").alias("uid"), F.col("edit.roles").alias("new"))
    own = edits.where("uid IS NOT NULL").join(rows.select("uid", "role", "text"), "uid").select("conv_id", "place", F.coalesce("new", "role").alias("role"), "text")
    return own.unionByName(edits.where("uid IS NULL").select("conv_id", "place", F.col("new").alias("role"), F.lit("").alias("text")))


def repair(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text. See repaired()."""
    return _repaired_rows(*_solved(df, block))


def repaired(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows stand by turn, nulls first, rows of one turn by role and the hash of their text. The first fault of a row counts: blank (nothing but ASCII white space), duplicate (role
    and text as in an earlier row of the conversation), truncated (the last other character is none of `.!?`). Edits: Keep 0, Rerole to user or
    assistant 1, Delete 2 (blank and duplicate rows must go), Insert an empty row of user or assistant 5; a truncated row that stays costs 5 more. They are the cheapest that give the roles' initials
    the form `(s?(ua)+)?`, and of those the ones with the least audit (the edits' initials). repaired_sha256 is of the lines `role:text`.

    Rows are sorted in ranges, so a long conversation is cut into blocks of rows in many tasks, each searched from each state to each. A task joins a conversation's blocks,
    about 40 bytes a row, for the audit is one string. Its lines pass through one task for the hash, which has to see them in order, but are not held.

    A null role or text is one space; an empty role fits nowhere; a null conv_id is a conversation. gaps: last turn - first turn + 1 - different turns, of turns that are not null.
    Conversations of which df has but a row marked gone have zeros, an empty audit and the hash of nothing. An empty table gives an empty one; other columns are not read."""
    rows, solved = _solved(df, block)
    lines = _repaired_rows(rows, solved).select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    hashes = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "line").mapInArrow(_hashes, "id long, sha string")
    stats = solved.where("chunk = 0").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    if "gone" in df.columns:
        zero = F.lit(0).cast("long")
        stats = stats.unionByName(df.where("gone").select("conv_id", *(zero.alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.lit("").alias("audit")))
    return stats.join(hashes, stats["conv_id"].eqNullSafe(hashes["id"]), "left").select(*stats.columns, F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
