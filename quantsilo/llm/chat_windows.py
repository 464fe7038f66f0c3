"""Chat formatting in budgeted windows.

Prefix sums of turn tokens give every turn its place in the conversation.  The places are cut into
cells of what the budget leaves beside the conversation's system turn and ``history``: the turns that
lie inside a cell form one window, a turn that runs over the cell's end forms one of its own.  So
windows are made of whole turns and are known without reading a conversation in one task.  Each window
repeats the system turn and as much of up to ``history`` tokens of turns before it as the budget then
leaves, so it stays within the budget unless the system turn and one single turn exceed it together.
The loss mask covers assistant texts of new turns only, so each is a target exactly once.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm import bpe
from quantsilo.llm.common import reliable, shuffle_partitions, small_batches

BUDGET = 512
HISTORY = 128
#: Tokens that the template adds to a turn, about.
TURN_TOKENS = 8

#: The template: <s>[INST] role [/INST]text</s>
OPEN, MID, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
_CONTROL = re.compile(r"\\|<s>|</s>|\[INST\]|\[/INST\]")
_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(MID) + "(.*?)" + re.escape(CLOSE), re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """``text`` without control strings: a backslash goes after their first character, and is doubled itself."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    head = OPEN + escape(role) + MID
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _places(conv: pa.DataType):
    """Token counts and running sums of a sorted partition; conversations may go on in the next one."""
    schema = pa.schema([("conv", conv), ("part", pa.int32()), ("role", pa.string()), ("text", pa.string()),
                        ("tokens", pa.int64()), ("before", pa.int64()), ("turns_before", pa.int64()),
                        ("system", pa.int64()), ("summary", pa.bool_())])

    def run(batches):
        part = TaskContext.get().partitionId()
        enc = bpe.encoding()
        current, started, segment, tokens, turns, system = None, False, 0, 0, 0, 0

        def total():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], conv), pa.array([part], pa.int32()), pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.string()), pa.array([tokens], pa.int64()), pa.array([0], pa.int64()),
                 pa.array([turns], pa.int64()), pa.array([system], pa.int64()), pa.array([True])], schema=schema)

        for b in batches:
            n_tokens, before, at, systems = [], [], [], []
            for c, role, text in zip(b.column("conv").to_pylist(), b.column("role").to_pylist(),
                                     b.column("text").to_pylist()):
                if started and c != current:
                    if segment == 0:
                        yield total()
                    segment, tokens, turns = segment + 1, 0, 0
                started, current = True, c
                n = TURN_TOKENS + len(bpe.encode(enc, text))
                if not turns:       # the first of its conversation, unless that began in an earlier partition
                    system = n if role == "system" else 0
                systems.append(system)
                n_tokens.append(n)
                before.append(tokens)
                at.append(turns)
                tokens, turns = tokens + n, turns + 1
            k = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), pa.array([part] * k, pa.int32()), b.column("role"), b.column("text"),
                 pa.array(n_tokens, pa.int64()), pa.array(before, pa.int64()), pa.array(at, pa.int64()),
                 pa.array(systems, pa.int64()), pa.array([False] * k)], schema=schema)
        if started:
            yield total()

    return run


def _format(conv_type: pa.DataType):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(zip(t["pos"].to_pylist(), t["repeated"].to_pylist(), t["role"].to_pylist(), t["text"].to_pylist()))
        out, spans, at = [], [], 0
        for _, repeated, role, text in rows:
            turn, a, b = render(role, text)
            if role == "assistant" and not repeated:
                spans.append({"start": at + a, "end": at + b})
            out.append(turn)
            at += len(turn)
        return pa.table({"conv": t["conv"][:1].cast(conv_type), "cell": t["cell"][:1], "sub": t["sub"][:1],
                         "text": pa.array(["".join(out)], pa.string()), "loss": pa.array([spans], span),
                         "n_repeated": pa.array([sum(r[1] for r in rows)], pa.int64()),
                         "n_turns": pa.array([len(rows)], pa.int64())})

    return run


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id",
                   turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Windows of all conversations: ``conv_col``, cell, sub (their order), text, loss, n_repeated, n_turns.

    loss: (start, end) code points in the window's text that are targets; n_repeated: leading turns
    that stand in an earlier window (system turn and history).  Turns go by ``turn_col`` (null
    first), ties by role and text; repeated rows are turns of their own.  Null role or text counts
    as empty (an empty assistant text is an empty span), a null conversation id as a conversation.
    The system turn is the first one, if its role is ``system``.  An empty table gives no windows.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be less than the budget")
    spark = turns.sparkSession
    small_batches(spark)
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = turns.schema[conv_col].dataType
    conv_ddl, conv_arrow = conv_type.simpleString(), to_arrow_type(conv_type)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tie = F.xxhash64("role", "text")     # splitters must not hold whole texts
    placed = reliable(
        rows.repartitionByRange(shuffle_partitions(spark), "conv", "turn", "role", tie)
        .sortWithinPartitions("conv", "turn", "role", tie, "text").select("conv", "role", "text")
        .mapInArrow(_places(conv_arrow), f"conv {conv_ddl}, part int, role string, text string, tokens long, "
                                               "before long, turns_before long, system long, summary boolean"))
    # at most two rows for each partition: what a conversation has had in the partitions before
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = placed.where("summary").select(
        F.col("conv").alias("c"), F.col("part").alias("p"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("carry"),
        F.coalesce(F.sum("turns_before").over(earlier), F.lit(0)).alias("carry_turns"),
        F.first("system").over(earlier).alias("carry_system"))
    start = F.col("before") + F.coalesce("carry", F.lit(0))
    located = (placed.where("NOT summary")
               .join(F.broadcast(carry), F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
               .select("conv", "role", "text", start.alias("s"), (start + F.col("tokens")).alias("e"),
                       (F.col("turns_before") + F.coalesce("carry_turns", F.lit(0))).alias("pos"),
                       F.when(F.col("carry_turns") > 0, F.col("carry_system")).otherwise(F.col("system")).alias("system")))
    located = located.withColumn("width", F.greatest(F.lit(budget - history) - F.col("system"), F.lit(1)))
    located = located.withColumn("cell", F.floor(F.col("s") / F.col("width"))).withColumn(
        "sub", (F.col("e") > (F.col("cell") + 1) * F.col("width")).cast("int"))
    new = located.select("conv", "cell", "sub", "pos", F.lit(0).alias("repeated"), "role", "text")
    windows = located.groupBy("conv", "cell", "sub").agg(
        F.min("s").alias("ws"), F.min("pos").alias("wp"), F.sum(F.col("e") - F.col("s")).alias("new"), F.max("system").alias("ws_system"))
    # history that fits beside the new turns and, where it is repeated, the system turn
    left = F.lit(budget) - F.col("new") - F.when(F.col("wp") > 0, F.col("ws_system")).otherwise(F.lit(0))
    windows = windows.withColumn("reach", F.greatest(F.least(left, F.lit(history)), F.lit(0))).drop("new", "ws_system")
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    seen = (located.where((F.col("e") <= F.col("s") + history) & ~is_system)
            .select(F.col("conv").alias("c"), "s", "e", "pos", "role", "text",
                    F.explode(F.sequence(F.floor(F.col("e") / F.col("width")),
                                         F.floor((F.col("s") + history) / F.col("width")))).alias("k")))
    past = (seen.join(windows, seen.c.eqNullSafe(windows.conv) & (seen.k == windows.cell)
                      & (windows.ws >= seen.e) & (windows.ws <= seen.s + windows.reach))
            .select("conv", "cell", "sub", "pos", F.lit(1).alias("repeated"), "role", "text"))
    system = located.where(is_system).select(F.col("conv").alias("c"), "role", "text")
    kept = (windows.where("wp > 0").join(system, F.col("conv").eqNullSafe(F.col("c")))
            .select("conv", "cell", "sub", F.lit(0).cast("long").alias("pos"), F.lit(1).alias("repeated"), "role", "text"))
    return (new.unionByName(past).unionByName(kept).groupBy("conv", "cell", "sub")
            .applyInArrow(_format(conv_arrow), f"conv {conv_ddl}, cell long, sub int, text string, "
                          "loss array<struct<start long, end long>>, n_repeated long, n_turns long")
            .withColumnRenamed("conv", conv_col))


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of the conversations that formatted windows hold, read from their texts and masks.

    Returns ``conv_col``, n_turns, turns_sha256 (role, newline, text, newline of each turn),
    loss_chars, loss_sha256 (text under the mask), formatted_chars, n_windows.  A digest needs its
    conversation in order, so windows are sorted by conversation and streamed: a task holds one
    window at a time, however long the conversation.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = windows.schema[conv_col].dataType
    conv_arrow = to_arrow_type(conv_type)
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    kinds = [conv_arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        current, open_ = None, None      # open_: [turns, digest, loss chars, digest, chars, windows]
        done = []

        def close():
            done.append((current, open_[0], open_[1].hexdigest(), open_[2], open_[3].hexdigest(), *open_[4:]))

        for b in batches:
            for conv, text, loss, skip in zip(*(b.column(i).to_pylist() for i in range(4))):
                if open_ is None or conv != current:
                    if open_:
                        close()
                    current, open_ = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in parse(text)[skip:]:
                    open_[0] += 1
                    open_[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    target = unescape(text[span["start"]:span["end"]])
                    open_[2] += len(target)
                    open_[3].update(target.encode())
                open_[4] += len(text)
                open_[5] += 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)
                done = []
        if open_:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)

    return (windows.select(F.col(conv_col).alias("conv"), "text", "loss", "n_repeated", "cell", "sub")
            .repartition("conv").sortWithinPartitions("conv", "cell", "sub")
            .select("conv", "text", "loss", "n_repeated")
            .mapInArrow(run, f"conv {conv_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long, n_windows long")
            .withColumnRenamed("conv", conv_col))
