"""Chat windows under a token budget.

Prefix sums of the turns' tokens cut a conversation into turn-aligned spans; each span becomes a
window with the conversation's system turn, up to ``history`` tokens of turns repeated from the
window before, and its own turns.  Only the window's own assistant texts are under the loss
mask, so every assistant text is a target once.  The room of a window is what the budget
leaves after system turn and history; spans begin on a grid of half that room, so a window
keeps its budget unless one turn alone is over half the room (a turn is never cut).

Turn format: ``<turn ROLE>TEXT</turn>`` and a line feed; ``\\``, ``<`` and ``>`` of roles and texts are
escaped with ``\\``, so no text can look like a mark and every text can be read back.

Defined results: null text or role is empty; a null ``conv_id`` is one conversation of its own;
turns of equal number are ordered by role and text, repeated rows stay; null turn numbers
come first; an empty table gives no window; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .mixing import word_count
from .ship import ship, stored

SLICE_TURNS = 256
MARK_TOKENS = 2

_ESCAPE = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


WINDOWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("window", T.LongType()), T.StructField("n_repeated", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("loss_from", T.ArrayType(T.IntegerType())), T.StructField("loss_to", T.ArrayType(T.IntegerType())),
])


def _assemble(batches):
    """Rows sorted by conversation, window and place to one row per window."""
    key, parts = None, []

    def row():
        text, size, tokens, repeated, spans = [], 0, 0, 0, []
        for again, role, body, n in parts:
            head, inner = f"<turn {escape(role)}>", escape(body)
            if again:
                repeated += 1
            elif role == "assistant":
                spans.append((size + len(head), size + len(head) + len(inner)))
            text.append(f"{head}{inner}</turn>\n")
            size += len(text[-1])
            tokens += n
        return (key[0], key[1], repeated, tokens, "".join(text), [a for a, _ in spans], [b for _, b in spans])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
            names=WINDOWS.names)

    for batch in batches:
        rows = []
        for conv, window, again, role, body, n in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, window) != key:
                if parts:
                    rows.append(row())
                key, parts = (conv, window), []
            parts.append((again, role, body, n))
        if rows:
            yield out(rows)
    if parts:
        yield out([row()])


def chat_windows(conversations: DataFrame, budget: int = 1024, history: int = 128) -> DataFrame:
    """One row per window: its text, the number of leading repeated turns, and the loss spans in code points."""
    ship(conversations.sparkSession)
    turns = stored(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tokens", word_count("text") + MARK_TOKENS)
        .withColumn("slice", F.coalesce(F.floor(F.col("turn") / SLICE_TURNS), F.lit(-(2**62)))), "chat-turns")
    order = ["turn", "role", "text"]
    # Prefix sums by slices of each conversation: number of turns and of tokens before each turn.
    sums = turns.groupBy("conv_id", "slice").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"),
                       F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    within = Window.partitionBy("conv_id", "slice").orderBy(*order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = (turns.withColumn("place", F.row_number().over(within) - 1)
              .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
              .join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")))
              .select("conv_id", "role", "text", "tokens", (F.col("place") + F.col("n0")).alias("place"),
                      (F.col("start") + F.col("t0")).alias("start")))
    placed = stored(placed, "chat-placed")
    system = placed.filter((F.col("place") == 0) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("sys_conv"), F.col("text").alias("sys_text"), F.col("tokens").alias("sys_tokens"))
    rows = placed.join(system.select("sys_conv", "sys_tokens"), F.col("conv_id").eqNullSafe(F.col("sys_conv")), "left").drop("sys_conv")
    room = F.greatest(F.lit(budget - history) - F.coalesce("sys_tokens", F.lit(0)), F.lit(max(8, budget // 4)))
    rows = rows.withColumn("window", F.floor(F.greatest(F.col("start") - F.coalesce("sys_tokens", F.lit(0)), F.lit(0))
                                             / F.ceil(room / 2)).cast("long"))
    # Windows in order, with the start of the next one, to which the last turns are repeated.
    heads = rows.groupBy("conv_id", "window").agg(F.min("start").alias("first"))
    later = Window.partitionBy("conv_id").orderBy("window")
    heads = heads.select(F.col("conv_id").alias("h_conv"), F.col("window").alias("h_window"),
                         F.lead("window").over(later).alias("next_window"), F.lead("first").over(later).alias("next_first"))
    rows = rows.join(heads, F.col("conv_id").eqNullSafe(F.col("h_conv")) & (F.col("window") == F.col("h_window")))
    own = rows.select("conv_id", "window", F.lit(False).alias("again"), "place", "role", "text", "tokens")
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    again = rows.filter(F.col("next_first").isNotNull() & (F.col("start") >= F.col("next_first") - history) & ~is_system).select(
        "conv_id", F.col("next_window").alias("window"), F.lit(True).alias("again"), "place", "role", "text", "tokens")
    # The system turn again, before everything else, in every window but its own.
    retained = heads.filter(F.col("h_window") > 0).join(system, F.col("h_conv").eqNullSafe(F.col("sys_conv"))).select(
        F.col("h_conv").alias("conv_id"), F.col("h_window").alias("window"), F.lit(True).alias("again"), F.lit(-1).cast("long").alias("place"),
        F.lit("system").alias("role"), F.col("sys_text").alias("text"), F.col("sys_tokens").alias("tokens"))
    parts = own.unionByName(again).unionByName(retained)
    return (parts.repartition("conv_id", "window").sortWithinPartitions("conv_id", "window", "place")
            .select("conv_id", "window", "again", "role", "text", "tokens").mapInArrow(_assemble, WINDOWS))


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType()), T.StructField("n_windows", T.LongType()),
])


def _digest(batches):
    """Windows sorted by conversation to one digest per conversation, a window at a time."""
    key, state = None, None

    def result():
        return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=DIGEST.names)

    for batch in batches:
        rows = []
        for conv, repeated, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or conv != key:
                if state is not None:
                    rows.append(result())
                key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for n, m in enumerate(_TURN.finditer(text)):
                if n >= repeated:
                    state[0] += 1
                    state[1].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
            for a, b in zip(starts, ends):
                target = unescape(text[a:b])
                state[2] += len(target)
                state[3].update(target.encode())
            state[4] += len(text)
            state[5] += 1
        if rows:
            yield out(rows)
    if state is not None:
        yield out([result()])


def window_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per conversation, read back from written windows: turns and loss text, hashed in order.

    A SHA-256 is sequential, so one task reads the windows of a conversation, in
    order and one at a time.
    """
    ship(spark)
    return (spark.read.parquet(path).repartition("conv_id").sortWithinPartitions("conv_id", "window")
            .select("conv_id", "n_repeated", "text", "loss_from", "loss_to").mapInArrow(_digest, DIGEST))


def format_and_read(conversations: DataFrame, budget: int = 1024, history: int = 128) -> DataFrame:
    """Write the windows in the shared folder; return the digests of what was written."""
    spark = conversations.sparkSession
    path = scratch_path(spark, "chat-windows")
    chat_windows(conversations, budget, history).write.option("compression", "zstd").parquet(path)
    return window_digests(spark, path)


#: A conversation whose texts look like marks of templates.
HARD_TEXT = "\\### Assistant: </turn> ok"


def with_hard_conversation(conversations: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -7, whose two texts are ``HARD_TEXT``."""
    spark = conversations.sparkSession
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)],
                                 "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(hard)
