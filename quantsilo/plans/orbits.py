"""Orbits of successor pointers: which rows an automaton over a key's history starts afresh at.

Many counters with expiry forget everything at certain rows; from such a row the next one is a function
of the rows alone (``successor``), so the rows where the counter starts afresh are the orbit of the
key's first row.  ``next_at`` finds successors by time, ``mark`` the orbits:

* inside a block of ``ordered.arrange`` pointers are followed by doubling, on arrays;
* pointers that leave their block are composed until they leave it (the block's exits), and a row that
  is entered from an earlier block is found by doubling over the exits, once for each power of two of
  blocks that a chain can span.  A history without end is thus split like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.plans import ordered


def next_at(rows: DataFrame, time: str, target: str, inclusive: bool) -> DataFrame:
    """(_g, successor): for rows of ``ordered.arrange`` with a ``target`` time the key's first row after it.

    ``inclusive``: a row at the very target counts.  No row after it: null.  Probes at the targets are
    sorted in among the rows, and each takes the next row's ordinal.
    """
    size, _ = ordered.plan_of(rows)
    probe = 0 if inclusive else 1
    key = rows.select(F.col("_key").alias("key"), F.col(time).alias("t"), F.lit(1 - probe).alias("rank"), F.col("_g").alias("g"),
                      F.col("_g").alias("successor"))
    ask = rows.filter(F.col(target).isNotNull()).select(
        F.col("_key").alias("key"), F.col(target).alias("t"), F.lit(probe).alias("rank"), F.col("_g").alias("g"),
        F.lit(None).cast("long").alias("successor"))
    both = ordered.fill_backward(ordered.arrange(key.unionByName(ask), ["key"], ["t", "rank", "g"], size), ["successor"])
    return both.filter(F.col("rank") == probe).select(F.col("g").alias("_g"), "successor")


def _exits(first: int, succ: np.ndarray) -> np.ndarray:
    """Where the pointers of a block (rows first, first + 1, ...; -1: none) lead outside it."""
    n = len(succ)
    out = succ.copy()
    while True:
        inside = (out >= first) & (out < first + n)
        if not inside.any():
            return out
        out[inside] = out[out[inside] - first]


def _paths(first: int, succ: np.ndarray, on: np.ndarray) -> np.ndarray:
    """All rows of a block on the paths from the rows ``on``."""
    n = len(succ)
    to = np.where((succ >= first) & (succ < first + n), succ - first, -1)
    on = on.copy()
    while (to >= 0).any():
        go = on & (to >= 0)
        on[to[go]] = True
        to = np.where(to >= 0, to[np.maximum(to, 0)], -1)
    return on


def _by_block(fn, fields: str):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_g", kind="stable")
        g = group["_g"].to_numpy()
        succ = group["successor"].fillna(-1).to_numpy().astype(np.int64)
        on = group["on"].to_numpy(bool)
        return fn(g, succ, on)

    return lambda df: df.groupBy("_key", "_blk").applyInPandas(run, fields)


def mark(rows: DataFrame, start: str, successor: str, longest: int) -> DataFrame:
    """(_g): the rows on the orbits that begin at rows where ``start`` is true.

    ``rows`` are of ``ordered.arrange``, successors stay within the key and point forward.  ``longest`` is
    the most rows that a chain from one start can span, so that it crosses that many blocks at most.
    """
    size, total = ordered.plan_of(rows)
    slim = rows.select("_key", "_blk", "_g", F.col(successor).alias("successor"), F.col(start).alias("on"))
    # a chain crosses no border of blocks when there is one block
    rounds = math.ceil(math.log2(1 + longest / size)) + 1 if total > size and longest > 1 else 0
    starts = slim.filter("on").select("_g")
    entered = starts
    if rounds:
        def exits(g, succ, on):
            out = _exits(int(g[0]), succ)
            left = out >= 0
            return pd.DataFrame({"_g": g[left], "to": out[left]})

        # rows whose path leaves the block; starts among them enter later blocks
        ptr = ordered.stored(_by_block(exits, "_g long, to long")(slim))
        for _ in range(rounds):
            if ptr.isEmpty():
                break
            entered = ordered.stored(entered.unionByName(entered.join(ptr, "_g").select(F.col("to").alias("_g"))).distinct())
            two = ptr.select(F.col("_g").alias("to"), F.col("to").alias("_then"))
            ptr = ordered.stored(ptr.join(two, "to").select("_g", F.col("_then").alias("to")))

    def paths(g, succ, on):
        return pd.DataFrame({"_g": g[_paths(int(g[0]), succ, on)]})

    known = slim
    if rounds:
        inside = entered.select("_g", F.lit(True).alias("_in"))
        known = slim.join(inside, "_g", "left").withColumn("on", F.coalesce("_in", "on")).drop("_in")
    return _by_block(paths, "_g long")(known)
