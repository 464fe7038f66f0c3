"""Skew-safe ordered computations per key.

Market data has few keys (symbols) and one may hold a third of all rows, all of them on one day, so a
window ``partitionBy(symbol)`` or ``partitionBy(symbol, day)`` would put that third in one task.  The
helpers here know no key and no calendar when they cut the rows:

* ``arrange`` evaluates its input once: rows are range-partitioned by (keys, order) with splitters that
  Spark samples, sorted, and written to the shared folder of ``spark.checkpoint.dir``.  A row's place in
  its file plus the rows of the files before give its global ordinal ``_g``, and ``_g`` divided by
  ``block_rows`` its block ``_blk``: all blocks have the same number of rows, whatever the keys.
* ``rolling`` evaluates bounded frames (lags, leads, moving averages, z-scores).  The last ``lookback``
  rows before a block and the first ``lookahead`` after it are copied into it, which ``_g`` alone
  decides; one shuffle by (key, block) then serves any number of windows.  A frame may reach over
  several blocks.
* ``fill_forward`` / ``fill_backward`` (last / next non-null value) and ``running`` (max, min, sum) have
  unbounded frames: windows inside (key, block), and what enters a block from the key's earlier blocks
  from a summary with one row for each key and block, joined on the windows' own partitioning.
* ``scan`` composes maps over a key's blocks by doubling, for recursions (see ``plans.recursion``).

Keys may be null.  ``order`` must be a total order within a key; on true ties any order may come out,
but one only, since the rows are written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.session import scratch_path

DEFAULT_BLOCK_ROWS = 131072

#: Columns that ``arrange`` adds: the key as one value that is never null, the global ordinal, the block.
HELPERS = ["_key", "_g", "_blk"]

_U = Window.unboundedPreceding
_LOCAL = 33     # bits of a row's place in its partition, as in monotonically_increasing_id


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _key(keys: Sequence[str]) -> Column:
    """The key columns as one struct: never null itself, and equal where the same columns are null."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


def arrange(df: DataFrame, keys: Sequence[str], order: Sequence, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``df`` sorted by (keys, order) with the columns ``_key``, ``_g`` (from 0 over all rows) and ``_blk``.

    The input is evaluated once, here.  The driver gets one count for each partition.
    """
    spark = df.sparkSession
    keys, order = list(keys), _cols(order)
    path = scratch_path(spark, "arranged")
    by = [*_cols(keys), *order]
    # without a number, adaptive execution may merge small neighbouring ranges
    rows = (df.drop(*HELPERS).repartitionByRange(*by).sortWithinPartitions(*by)
            .withColumn("_at", F.monotonically_increasing_id()))
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    part = F.shiftright("_at", _LOCAL).cast("int")
    counts = sorted(stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, size in counts:
        starts.append((p, total))
        total += size
    first = spark.createDataFrame(starts or [(0, 0)], "_p int, _first long")   # one row a partition
    g = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    return (stored.join(F.broadcast(first), part == F.col("_p"))
            .withColumn("_g", g)
            .select(*df.drop(*HELPERS).columns, _key(keys).alias("_key"), "_g",
                    F.floor(F.col("_g") / block_rows).cast("long").alias("_blk"))
            .withMetadata("_blk", {"block_rows": block_rows, "rows": total}))


def plan_of(df: DataFrame) -> tuple[int, int]:
    """(rows of a block, rows in all) as ``arrange`` measured them."""
    meta = df.schema["_blk"].metadata
    if "block_rows" not in meta:
        raise ValueError("rows need the columns of ordered.arrange")
    return meta["block_rows"], meta["rows"]


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def block_window(*more: str) -> Window:
    """Rows of a (key, block) in order."""
    return Window.partitionBy("_key", "_blk", *more).orderBy("_g")


def rolling(df: DataFrame, build: Callable[[Window], list[Column]] | Sequence[Callable[[Window], list[Column]]],
            lookback: int = 0, lookahead: int = 0) -> DataFrame:
    """Evaluate bounded-frame window columns per key over rows of ``arrange``.

    ``build(w)`` receives the window of a (key, block) in order and returns the columns to add; frames may
    reach ``lookback`` rows back and ``lookahead`` rows ahead.  ``build`` may be a list of stages, each
    seeing the columns of those before (same partitioning, no extra shuffle); ``lookback`` must then cover
    the summed reach.  Unbounded frames are not exact here; use ``running`` / ``fill_*``.
    """
    size, _ = plan_of(df)
    meta = df.schema["_blk"].metadata
    rows = df
    if lookback or lookahead:
        # a row serves every block from that of the row ``lookahead`` before it to that ``lookback`` after it
        to = F.sequence(F.greatest(F.floor((F.col("_g") - lookahead) / size), F.lit(0)).cast("long"),
                        F.floor((F.col("_g") + lookback) / size).cast("long"))
        rows = (df.withColumn("_home", F.col("_blk")).withColumn("_to", F.explode(to))
                .withColumn("_blk", F.col("_to")).drop("_to"))
    w = block_window()
    for stage in (build if isinstance(build, (list, tuple)) else [build]):
        rows = rows.select("*", *stage(w))
    if lookback or lookahead:
        rows = rows.filter(F.col("_home") == F.col("_blk")).drop("_home").withMetadata("_blk", meta)
    return rows


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder: for rows that several later steps read."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carry(df: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows with what enters their block; a row of the summary for each (key, block)."""
    right = summary.withColumnsRenamed({"_key": "_ckey", "_blk": "_cblk"})
    return df.join(right, (df["_key"] == right["_ckey"]) & (df["_blk"] == right["_cblk"]), "left").drop("_ckey", "_cblk")


def fill_forward(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Last non-null value of each column at or before the row (as-of backward)."""
    return fill(df, forward=cols, suffix=suffix)


def fill_backward(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Next non-null value of each column at or after the row (as-of forward)."""
    return fill(df, backward=cols, suffix=suffix)


def fill(df: DataFrame, forward: Sequence[str] = (), backward: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """``fill_forward`` and ``fill_backward`` of different columns, with one summary and one join."""
    # backward is forward in descending order: a frame that grows, never one that shrinks (quadratic)
    ways = [(list(forward), F.max_by, "asc"), (list(backward), F.min_by, "desc")]
    inside, before, summed, value = [], [], [], {}
    for cols, take, turn in ways:
        rows = Window.partitionBy("_key", "_blk").orderBy(getattr(F, turn)("_g")).rowsBetween(_U, 0)
        blocks = Window.partitionBy("_key").orderBy(getattr(F, turn)("_blk")).rowsBetween(_U, -1)
        for c in cols:
            summed.append(take(F.col(c), F.when(F.col(c).isNotNull(), F.col("_g"))).alias(f"_s_{c}"))
            before.append(F.last(f"_s_{c}", ignorenulls=True).over(blocks).alias(f"_c_{c}"))
            inside.append(F.last(c, ignorenulls=True).over(rows).alias(f"_in_{c}"))
            value[c] = F.coalesce(F.col(f"_in_{c}"), F.col(f"_c_{c}"))
    summary = df.groupBy("_key", "_blk").agg(*summed).select("_key", "_blk", *before)
    out = carry(df.select("*", *inside), summary)
    if suffix:
        return out.select(*df.columns, *[v.alias(f"{c}{suffix}") for c, v in value.items()])
    return out.select(*[value[c].alias(c) if c in value else F.col(c) for c in df.columns])


_RUN = {
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
}


def running(df: DataFrame, col: str | Column, how: str, out: str) -> DataFrame:
    """Running max / min / sum of ``col`` per key in order (inclusive); nulls are passed over."""
    fold, combine = _RUN[how]
    value = F.col(col) if isinstance(col, str) else col
    before = Window.partitionBy("_key").orderBy("_blk").rowsBetween(_U, -1)
    summary = (df.groupBy("_key", "_blk").agg(fold(value).alias("_tot"))
               .select("_key", "_blk", fold("_tot").over(before).alias("_c")))
    part = df.withColumn("_in", fold(value).over(block_window().rowsBetween(_U, 0)))
    base = [c for c in df.columns if c != out]
    return carry(part, summary).select(*base, combine(F.col("_c"), F.col("_in")).alias(out))


def sequence(df: DataFrame, out: str = "seq") -> DataFrame:
    """The exact 0-based ordinal of every row within its key."""
    return running(df, F.lit(1).cast("long"), "sum", out).withColumn(out, F.col(out) - 1)


def scan(maps: DataFrame, state: Sequence[str], compose: Callable[[dict, dict], dict], blocks: int) -> DataFrame:
    """Inclusive composition of maps over each key's blocks, in the order of ``_blk``.

    ``maps`` has one row for each (key, block) and the columns ``state``; ``compose(first, second)`` gives
    their composition as SQL expressions.  Each of the log2(blocks) rounds doubles the reach; all share
    one partitioning of the maps, a small table.
    """
    w = "OVER (PARTITION BY _key ORDER BY _blk)"
    for r in range(math.ceil(math.log2(blocks)) if blocks > 1 else 0):
        cols = maps.columns
        maps = maps.selectExpr("*", f"lag(true, {1 << r}) {w} AS _has", *[f"lag({c}, {1 << r}) {w} AS _l_{c}" for c in state])
        both = compose({c: f"_l_{c}" for c in state}, {c: c for c in state})
        maps = maps.selectExpr(*[f"CASE WHEN _has THEN {both[c]} ELSE {c} END AS {c}" if c in state else c for c in cols])
    return maps
