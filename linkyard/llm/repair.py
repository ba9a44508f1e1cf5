"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A conversation is well formed if its role initials match ``(s?(ua)+)?``.  Edits of a row: keep (K, cost 0), give it
the role user or assistant (R, 1), delete (D, 2; required for blank and duplicate rows); an empty user or assistant row
may be inserted (I, 5) anywhere; a truncated row that stays adds 5.  Of all cheapest edits the ones whose initials
are least in ASCII order are taken; these initials are the audit.

Nodes are (rows done, state), states: start, after system, after user, after assistant.  Arcs are edits.

* Cost DP: cheapest cost from every node to the end, backwards, for all conversations of a batch at once.
* Prefix-doubling ranking: the arcs on cheapest paths are ranked by the least audit of length 1, 2, 4, 8, ...
  that begins with them: the rank by 2L comes from the pair (rank by L, rank by L of the arc L edits further on).
  With it the pointers double.  The arc with the least rank leaves the first node, and the audit is read through the doubled pointers,
  all its places at once.

Edits with one initial that leave a node end in one node (a row can only get the role that may come next), so
a prefix has one successor.

Long conversations: rows are range-sorted by (conversation, turn), so a conversation is cut into blocks of at most
``BLOCK_ROWS`` rows, a byte a row.  A block is a 4x4 matrix of costs; only those of a conversation are combined in one
place, to find the cost from each block's end; blocks are then solved apart for every state
they can be entered in, and the states chained.  The digest of a repaired conversation is one SHA-256, hence one
task's stream in constant memory beside the audit.

Order and equality: rows of a conversation go by turn (null first), then role, then MD5 of the text; equal texts
have equal MD5.  Equal rows are grouped with a count before they meet.

Defined results: a null text or role is one space; a null ``conv_id`` is one conversation, returned as null; role
initials are first characters, and a role without one can't be kept; an empty table has no row; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ship import partitions_for, ship, stored
from .sqltext import CRC_TABLE, crc32_of

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK_ROWS = 4096
ROW_BYTES, RANGE_BYTES = 80, 16e6
SOLVE_ROWS = 50_000   # rows solved at once in a worker
FAR = 1 << 40
SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept row, by its initial (s, u, a, other); -1 where it may not stand.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: State after the row that may come next, given or inserted.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Cost from each state to the end, by insertions alone.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
GIVEN = {USER: "user", ASSISTANT: "assistant"}
CODES = b"$DIKR"      # labels in ASCII order; $ ends an audit
MUST_GO, IS_TRUNCATED = 8, 4


# --- one batch of blocks, numpy only -----------------------------------------------------------

class Blocks:
    """Some blocks of row codes laid end to end, each with one more place for its end."""

    def __init__(self, codes: list[np.ndarray], ends: np.ndarray, last: np.ndarray):
        self.n = np.array([len(c) for c in codes], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n + 1)[:-1])).astype(np.int64)
        self.end = self.first + self.n
        self.size = int((self.n + 1).sum())
        self.code = np.zeros(self.size, np.uint8)
        rows = np.ones(self.size, bool)
        rows[self.end] = False
        self.code[rows] = np.concatenate(codes) if codes else []
        self.rows, self.last = np.flatnonzero(rows), last
        self.cost = np.full((self.size, 4), FAR, np.int64)
        self.cost[self.end] = ends
        self._costs()

    def _steps(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of keep, rerole and delete from places ``at``, by state, given the costs behind the row."""
        code = self.code[at]
        stays = np.where(code & IS_TRUNCATED, TRUNCATED, 0)[:, None]
        gone = (code & MUST_GO > 0)[:, None]
        to = KEPT[:, code & 3].T
        keep = np.where((to < 0) | gone, FAR, KEEP + stays + np.take_along_axis(after, np.maximum(to, 0), 1))
        given = np.where(gone, FAR, REROLE + stays + after[:, NEXT])
        return np.minimum(keep, FAR), np.minimum(given, FAR), np.minimum(DELETE + after, FAR)

    def _costs(self) -> None:
        order = np.argsort(-self.n, kind="stable")
        end, n = self.end[order], self.n[order]
        for t in range(int(n[0]) if len(n) else 0):
            at = end[: np.searchsorted(-n, -t, "left")] - 1 - t
            best = np.minimum.reduce(self._steps(at, self.cost[at + 1]))
            for _ in range(2):  # at most a user and an assistant are put in
                best = np.minimum(best, INSERT + best[:, NEXT])
            self.cost[at] = best

    def arcs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of cheapest paths, by tail and label: tail, label, head; an end node has a ``$`` arc to itself."""
        tails, labels, heads = [], [], []
        state = np.arange(4)

        def add(label, at, on, heads_of):
            i, s = np.nonzero(on)
            tails.append(at[i] * 4 + s)
            labels.append(np.full(len(i), label))
            heads.append(heads_of(i, s))
        at = self.rows
        here, after = self.cost[at], self.cost[at + 1]
        keep, given, gone = self._steps(at, after)
        add(1, at, gone == here, lambda i, s: (at[i] + 1) * 4 + s)
        add(3, at, keep == here, lambda i, s: (at[i] + 1) * 4 + KEPT[s, self.code[at[i]] & 3])
        add(4, at, given == here, lambda i, s: (at[i] + 1) * 4 + NEXT[s])
        add(2, at, INSERT + here[:, NEXT] == here, lambda i, s: at[i] * 4 + NEXT[s])
        tail_ends, block_ends = self.end[self.last], self.end[~self.last]
        add(2, tail_ends, np.broadcast_to(END > 0, (len(tail_ends), 4)), lambda i, s: tail_ends[i] * 4 + NEXT[s])
        add(0, tail_ends, np.broadcast_to(END == 0, (len(tail_ends), 4)), lambda i, s: tail_ends[i] * 4 + s)
        add(0, block_ends, np.ones((len(block_ends), 4), bool), lambda i, s: block_ends[i] * 4 + state[s])
        tail, label, head = (np.concatenate(x).astype(np.int64) for x in (tails, labels, heads))
        order = np.lexsort((label, tail))
        return tail[order], label[order], head[order]

    def audits(self, enter: list[list[int]]) -> list[list[tuple[int, str, int]]]:
        """For each block and each state it is entered in: state at its end, audit, cost to the end of all."""
        tail, label, head = self.arcs()
        out_of = np.searchsorted(tail, np.arange(self.size * 4 + 1))
        rank, jump = label, out_of[head]  # labels leaving a node differ, and arcs are sorted: the first is the least
        jumps = [jump]
        while label[jump].any():
            # Audits twice as long: their first half, then their second half.
            rank = np.unique(rank * len(rank) + rank[jump], return_inverse=True)[1]
            jump = jump[jump]
            jumps.append(jump)
        node = np.array([self.first[b] * 4 + s for b, states in enumerate(enter) for s in states], np.int64)
        start = np.array([a + int(np.argmin(rank[a:b])) for a, b in zip(out_of[node], out_of[node + 1])], np.int64)
        length, at = np.zeros(len(start), np.int64), start.copy()
        for k in range(len(jumps) - 1, -1, -1):  # the longest jumps that do not reach the end
            on = label[jumps[k][at]] != 0
            length[on] += 1 << k
            at[on] = jumps[k][at[on]]
        length += label[start] != 0
        final = np.where(label[at] != 0, jumps[0][at], at)
        path = np.repeat(start, length)
        place = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
        for k, jump in enumerate(jumps):
            on = place >> k & 1 == 1
            path[on] = jump[path[on]]
        text = np.frombuffer(CODES, np.uint8)[label[path]].tobytes().decode()
        cut, rows, i = np.concatenate(([0], np.cumsum(length))), [], 0
        for b, states in enumerate(enter):
            rows.append([(int(tail[final[i + j]] % 4), text[cut[i + j]: cut[i + j + 1]], int(self.cost[self.first[b], s]))
                         for j, s in enumerate(states)])
            i += len(states)
        return rows


def cost_matrix(codes: np.ndarray) -> np.ndarray:
    """Cheapest cost from each state before a block to each state behind it."""
    ends = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(ends, 0)
    blocks = Blocks([codes] * 4, ends, np.zeros(4, bool))
    return np.minimum(blocks.cost[blocks.first].T, FAR)


def in_parts(sizes: list[int], limit: int = SOLVE_ROWS):
    """Ranges of items of about ``limit`` together, one item at least."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


# --- tasks ------------------------------------------------------------------------------------

BLOCK = T.StructType([
    T.StructField("has_conv", T.BooleanType()), T.StructField("conv", T.LongType()), T.StructField("rng", T.IntegerType()),
    T.StructField("seq", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("blank", T.LongType()),
    T.StructField("duplicate", T.LongType()), T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("head", T.IntegerType()), T.StructField("tail", T.IntegerType()),
])
_KINDS = {T.BooleanType(): pa.bool_(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[f.dataType]) for c, f in zip(zip(*rows), schema.fields)], names=schema.names)


def _legal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether initials (0 s, 1 u, 2 a, 3 other) may follow one another: su, ua, au."""
    return (a == 0) & (b == 1) | (a == 1) & (b == 2) | (a == 2) & (b == 1)


def _pack(block_rows: int):
    """Sorted slim rows to blocks of one conversation, at most ``block_rows`` rows each."""
    def cut(rng, seq, rows):
        has_conv, conv, has_turn, turn, initial, blank, truncated, first, n = rows
        # A group of n equal rows: n blank rows, or a first one and its duplicates.
        at = np.repeat(np.arange(len(n)), n)
        lead = np.zeros(len(at), bool)
        lead[np.cumsum(n) - n] = True
        is_blank = blank[at]
        double = ~is_blank & ~(first[at] & lead)
        cut_off = ~is_blank & ~double & truncated[at]
        codes = (np.where(is_blank | double, MUST_GO, 0) + np.where(cut_off, IS_TRUNCATED, 0) + initial[at]).astype(np.uint8)
        out = []
        for lo in range(0, len(at), block_rows):
            hi = min(lo + block_rows, len(at))
            i = initial[at[lo:hi]]
            turns = turn[at[lo:hi]][has_turn[at[lo:hi]]]
            out.append((bool(has_conv[0]), int(conv[0]), rng, seq + len(out), codes[lo:hi].tobytes(),
                        int(turns[0]) if len(turns) else None, int(turns[-1]) if len(turns) else None,
                        int((np.diff(turns) != 0).sum() + 1) if len(turns) else 0, int(is_blank[lo:hi].sum()), int(double[lo:hi].sum()),
                        int(cut_off[lo:hi].sum()), int((~_legal(i[:-1], i[1:])).sum()), int(i[0]), int(i[-1])))
        return out

    def run(batches):
        kept, rng, seq = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rng = batch.column(0)[0].as_py()
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            if kept is not None:
                rows, kept = [np.concatenate(x) for x in zip(kept, rows)], None
            edge = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
            out = []
            for a, b in zip([0, *edge], [*edge, len(rows[0])]):
                if b == len(rows[0]) and rows[8][a:b].sum() < block_rows:
                    kept = [x[a:b] for x in rows]  # may go on in the next batch
                else:
                    out += cut(rng, seq + len(out), [x[a:b] for x in rows])
            if out:
                seq += len(out)
                yield _batch(out, BLOCK)
        if kept is not None:
            yield _batch(cut(rng, seq, kept), BLOCK)
    return run


_NAME = ["has_conv", "conv"]
_PLACE = [*_NAME, "rng", "seq"]


def _matrices(batches):
    for batch in batches:
        cells = [cost_matrix(np.frombuffer(c, np.uint8)).reshape(-1).tolist() for c in batch.column("codes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in _PLACE] + [pa.array(cells, pa.list_(pa.int64()))], names=[*_PLACE, "matrix"])


def _cost_ends(group: pd.DataFrame) -> pd.DataFrame:
    """The matrices of a conversation's blocks to the cost from each block's end, by state."""
    group = group.sort_values(["rng", "seq"])
    ends, cost = [], END
    for m in reversed(group["matrix"].tolist()):
        ends.append(cost.tolist())
        cost = np.minimum((np.asarray(m).reshape(4, 4) + cost[None, :]).min(1), FAR)
    group["ends"] = ends[::-1]
    group["nth"] = np.arange(len(group), dtype=np.int64)
    group["n_blocks"] = np.int64(len(group))
    return group[[*_PLACE, "ends", "nth", "n_blocks"]]


def _chain(group: pd.DataFrame) -> pd.DataFrame:
    """The state each block of a conversation is entered in."""
    group = group.sort_values("nth")
    states, s = [], START
    for exits in group["exits"]:
        states.append(s)
        s = int(exits[s])
    group["state"] = np.array(states, np.int32)
    return group[[*_PLACE, "state"]]


def _solve(batches):
    """Blocks with the costs behind them to audits: of a first block for the start, of others for every state."""
    for batch in batches:
        codes = [np.frombuffer(c, np.uint8) for c in batch.column("codes").to_pylist()]
        ends, nth, n = (batch.column(c).to_pylist() for c in ("ends", "nth", "n_blocks"))
        solved = []
        for lo, hi in in_parts([len(c) for c in codes]):
            blocks = Blocks(codes[lo:hi], np.array(ends[lo:hi], np.int64), np.array([nth[i] == n[i] - 1 for i in range(lo, hi)]))
            solved += blocks.audits([[START] if nth[i] == 0 else [0, 1, 2, 3] for i in range(lo, hi)])
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in [*_PLACE, "nth", "n_blocks"]] + [
            pa.array([[x[0] for x in s] for s in solved], pa.list_(pa.int32())), pa.array([[x[1] for x in s] for s in solved], pa.list_(pa.string())),
            pa.array([s[0][2] for s in solved], pa.int64())], names=[*_PLACE, "nth", "n_blocks", "exits", "audits", "cost"])


REPAIRED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("gaps", T.LongType()), T.StructField("blank", T.LongType()),
    T.StructField("duplicate", T.LongType()), T.StructField("truncated", T.LongType()), T.StructField("illegal", T.LongType()),
    T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    T.StructField("n_repaired", T.LongType()),
])
INITIALS = {"s": 0, "u": 1, "a": 2}


def replay(audit: str, rows):
    """The repaired rows: ``(role, text)`` by running the edits of ``audit`` over ``(role, text, n)``."""
    state, i = START, 0
    for role, text, n in rows:
        for _ in range(n):
            while audit[i] == "I":
                state = int(NEXT[state])
                yield GIVEN[state], ""
                i += 1
            if audit[i] == "K":
                state = int(KEPT[state, INITIALS.get(role[:1], 3)])
                yield role, text
            elif audit[i] == "R":
                state = int(NEXT[state])
                yield GIVEN[state], text
            i += 1
    for _ in audit[i:]:
        state = int(NEXT[state])
        yield GIVEN[state], ""


def _digests(batches):
    """Rows sorted by conversation, a head row with its audit first; one text at a time is held."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in (
                "is_row", "has_conv", "conv", "role", "text", "n", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")))

    stream, out = rows(), []
    row = next(stream, None)
    while row is not None:
        head, sha, made = row, hashlib.sha256(), 0
        row = next(stream, None)

        def own():
            nonlocal row
            while row is not None and row[0]:
                yield row[3], row[4], row[5]
                row = next(stream, None)
        for role, text in replay(head[12], own()):
            sha.update(f"{chr(10) if made else ''}{role}:{text}".encode())
            made += 1
        out.append((head[2] if head[1] else None, *head[6:12], head[12], sha.hexdigest(), made))
        if len(out) == 1000:
            yield _batch(out, REPAIRED)
            out = []
    if out:
        yield _batch(out, REPAIRED)


# --- the job ----------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 makes it a user's.  A null is one space."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy")).drop("copy")


def _grouped(rows: DataFrame) -> DataFrame:
    """Equal rows with their number; no null in a key."""
    return rows.select(
        F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).groupBy("has_conv", "conv", "has_turn", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "text_id", F.md5(F.col("text").cast("binary")))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).cast("long")


def blocks_of(turns: DataFrame, block_rows: int = BLOCK_ROWS, range_bytes: float = RANGE_BYTES) -> DataFrame:
    """Conversations as blocks of row codes, by range of (conversation, turn, role, text id)."""
    key, order = ["has_conv", "conv", "role", "text_id"], ["has_conv", "conv", "has_turn", "turn", "role", "text_id"]
    kept = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = turns.select(*order, "n", (kept == "").alias("blank"), (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("truncated"))
    # The first row of each role and text; null turns come first.
    seen = slim.groupBy(*key).agg(F.min(F.struct("has_turn", "turn")).alias("at")).select(
        *key, F.col("at.has_turn").alias("has_turn"), F.col("at.turn").alias("turn"), F.lit(True).alias("first"))
    slim = stored(slim.join(seen, order, "left").withColumn("first", F.coalesce("first", F.lit(False))), "repair-slim")
    ranges = partitions_for(slim.count() * ROW_BYTES, range_bytes)
    return stored(slim.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("rng"), "has_conv", "conv", "has_turn", "turn", _initial(F.col("role")).alias("initial"), "blank", "truncated",
        "first", "n").mapInArrow(_pack(block_rows), BLOCK), "repair-blocks")


def repair(rows: DataFrame, conv_ids: DataFrame | None = None, block_rows: int = BLOCK_ROWS, range_bytes: float = RANGE_BYTES) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and the SHA-256 of what it becomes.

    ``rows``: conv_id, turn, role, text.  ``conv_ids``: conversations to return (``rows`` may have lost some); those
    without a row have zeros, an empty audit and the digest of nothing.  Also returned: n_repaired, the rows it ends with.
    """
    spark = rows.sparkSession
    ship(spark)
    turns = stored(_grouped(rows), "repair-turns")
    blocks = blocks_of(turns, block_rows, range_bytes)
    several = blocks.groupBy(*_NAME).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    # Cost behind each block: known for a lone block, by matrices for the others.
    long_ones = blocks.join(several, _NAME, "left_semi").select(*_PLACE, "codes").mapInArrow(
        _matrices, "has_conv boolean, conv long, rng int, seq long, matrix array<long>")
    place = "has_conv boolean, conv long, rng int, seq long, "
    ends = long_ones.groupBy(*_NAME).applyInPandas(_cost_ends, place + "ends array<long>, nth long, n_blocks long")
    ended = blocks.join(ends, _PLACE, "left").select(
        *_PLACE, "codes", F.coalesce("ends", F.array(*[F.lit(int(x)).cast("long") for x in END])).alias("ends"),
        F.coalesce("nth", F.lit(0).cast("long")).alias("nth"), F.coalesce("n_blocks", F.lit(1).cast("long")).alias("n_blocks"))
    solved = stored(ended.mapInArrow(_solve, place + "nth long, n_blocks long, exits array<int>, audits array<string>, cost long"), "repair-solved")
    states = solved.filter("n_blocks > 1").select(*_PLACE, "nth", "exits").groupBy(*_NAME).applyInPandas(_chain, place + "state int")
    lone = solved.filter("n_blocks = 1").select(*_NAME, F.col("audits")[0].alias("audit"), "cost")
    parts = solved.filter("n_blocks > 1").join(states, _PLACE).groupBy(*_NAME).agg(
        F.sort_array(F.collect_list(F.struct("nth", F.get("audits", F.col("state")).alias("audit")))).alias("parts"),
        F.sum(F.when(F.col("nth") == 0, F.col("cost"))).alias("cost"))
    audits = lone.unionByName(parts.select(*_NAME, F.array_join(F.col("parts.audit"), "").alias("audit"), "cost"))
    # Faults, with what lies between neighbouring blocks.
    near = Window.partitionBy(*_NAME).orderBy("rng", "seq")
    joint = F.lag("tail").over(near), F.col("head")
    legal = (joint[0] == 0) & (joint[1] == 1) | (joint[0] == 1) & (joint[1] == 2) | (joint[0] == 2) & (joint[1] == 1)
    faults = blocks.select(*_NAME, "blank", "duplicate", "truncated", "low", "high", (F.col("illegal") + F.when(
        joint[0].isNotNull() & ~legal, F.lit(1)).otherwise(F.lit(0))).alias("illegal"), (F.col("n_turns") - F.when(
            F.lag("high").over(near) == F.col("low"), F.lit(1)).otherwise(F.lit(0))).alias("n_turns")).groupBy(*_NAME).agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("n_turns"), F.lit(0).cast("long")).alias("gaps"))
    heads = faults.join(audits, _NAME)
    if conv_ids is not None:
        asked = conv_ids.select(F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv")).distinct()
        heads = asked.join(heads, _NAME, "full").fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna("", ["audit"])
    rows = heads.withColumn("is_row", F.lit(False)).unionByName(turns.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    return rows.repartition(*_NAME).sortWithinPartitions(*_NAME, "is_row", "has_turn", "turn", "role", "text_id").select(
        "is_row", *_NAME, "role", "text", "n", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").mapInArrow(_digests, REPAIRED)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations`` and repair them; every conversation is returned."""
    return repair(damaged(conversations), conversations.select("conv_id"))


#: The same in DuckDB: costs and least audits forward, row by row; then the edits run over the rows.
REPAIR_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_of("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept, left(role, 1) AS initial FROM damaged
), classed AS (
  SELECT *, kept = '' AS blank, kept <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS joint FROM numbered
), rows_ AS (
  SELECT *, NOT blank AND NOT duplicate AND right(kept, 1) NOT IN ('.', '!', '?') AS truncated FROM classed
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (joint IS NOT NULL AND joint NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows_ GROUP BY conv_id
), plans AS (
  SELECT conv_id, n, 0 AS i, {{'c': 0, 'a': ''}} AS st, {{'c': 1000000000, 'a': ''}} AS sy, {{'c': 5, 'a': 'I'}} AS us, {{'c': 10, 'a': 'II'}} AS asst FROM faults
  UNION ALL
  SELECT conv_id, n, i, st, sy, list_min([us, {{'c': st.c + 5, 'a': st.a || 'I'}}, {{'c': sy.c + 5, 'a': sy.a || 'I'}}, {{'c': asst.c + 5, 'a': asst.a || 'I'}}]),
    list_min([asst, {{'c': us.c + 5, 'a': us.a || 'I'}}, {{'c': st.c + 10, 'a': st.a || 'II'}}, {{'c': sy.c + 10, 'a': sy.a || 'II'}}])
  FROM (
    SELECT p.conv_id, p.n, r.i, {{'c': st.c + 2, 'a': st.a || 'D'}} AS st,
      list_min([{{'c': sy.c + 2, 'a': sy.a || 'D'}}, CASE WHEN stays AND initial = 's' THEN {{'c': st.c + late, 'a': st.a || 'K'}} END]) AS sy,
      list_min([{{'c': us.c + 2, 'a': us.a || 'D'}},
        CASE WHEN stays AND initial = 'u' THEN list_min([{{'c': st.c + late, 'a': st.a || 'K'}}, {{'c': sy.c + late, 'a': sy.a || 'K'}}, {{'c': asst.c + late, 'a': asst.a || 'K'}}]) END,
        CASE WHEN stays THEN list_min([{{'c': st.c + late + 1, 'a': st.a || 'R'}}, {{'c': sy.c + late + 1, 'a': sy.a || 'R'}}, {{'c': asst.c + late + 1, 'a': asst.a || 'R'}}]) END]) AS us,
      list_min([{{'c': asst.c + 2, 'a': asst.a || 'D'}}, CASE WHEN stays AND initial = 'a' THEN {{'c': us.c + late, 'a': us.a || 'K'}} END,
        CASE WHEN stays THEN {{'c': us.c + late + 1, 'a': us.a || 'R'}} END]) AS asst
    FROM plans p JOIN (SELECT conv_id, i, initial, NOT blank AND NOT duplicate AS stays, CASE WHEN truncated THEN 5 ELSE 0 END AS late FROM rows_) r
      ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1)
), audits AS (
  SELECT conv_id, list_min([st, asst]) AS best FROM plans WHERE i = n
), edits AS (
  SELECT conv_id, best.a AS audit, 0 AS done, 0 AS i, '' AS came, CAST([] AS VARCHAR[]) AS made FROM audits
  UNION ALL
  SELECT e.conv_id, e.audit, e.done + 1, CASE WHEN op = 'I' THEN e.i ELSE e.i + 1 END,
    CASE WHEN op = 'D' THEN e.came WHEN op = 'K' THEN r.initial WHEN e.came = 'u' THEN 'a' ELSE 'u' END,
    CASE WHEN op = 'D' THEN e.made ELSE list_append(e.made, CASE WHEN op = 'K' THEN r.role WHEN e.came = 'u' THEN 'assistant' ELSE 'user' END || ':'
      || CASE WHEN op = 'I' THEN '' ELSE r.text END) END
  FROM (SELECT *, substr(audit, done + 1, 1) AS op FROM edits WHERE done < length(audit)) e
  LEFT JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i + 1
)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
  coalesce(f.illegal, 0) AS illegal, CAST(coalesce(a.best.c, 0) AS BIGINT) AS cost, coalesce(a.best.a, '') AS audit,
  sha256(coalesce(array_to_string(e.made, chr(10)), '')) AS repaired_sha256, CAST(coalesce(len(e.made), 0) AS BIGINT) AS n_repaired
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN edits e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.done = length(e.audit)
"""
