"""History-page analytics: seasonality pivot and return correlation.

Correlation never emits symbol pairs per timestamp: returns are pivoted to
one row per timestamp (a shuffle on timestamp, few columns), and every pair
correlation is an aggregate expression over those columns - one pass with
partial aggregation.  Symbols are processed in column blocks so the number
of aggregate expressions per job stays bounded for any symbol count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.functions.scalar import month_name, weekday_name
from quantsilo.plans import ordered
from quantsilo.plans.joins import with_stats
from quantsilo.session import ensure_checkpoint_dir

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]


def seasonality(returns: DataFrame, key: str = "symbol", ts: str = "timestamp",
                value: str = "returns") -> DataFrame:
    """Mean return x 100 by month (rows) and weekday (fixed column order).

    Every key has all twelve months, numbered from 1 in ``month_no``; those without returns hold nulls.
    """
    found = (returns.withColumn("month", month_name(ts)).withColumn("_wd", weekday_name(ts))
             .groupBy(key, "month").pivot("_wd", WEEKDAYS).agg(F.avg(F.col(value) * 100.0)))
    row = F.struct(*[F.col(d) for d in WEEKDAYS])
    table = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("month", row))).alias("_by"))   # 12 at most
    months = F.array(*map(F.lit, MONTHS))
    return (table.select(key, "_by", F.posexplode(months).alias("_at", "month"))
            .select(key, "month", (F.col("_at") + 1).alias("month_no"), *[F.col("_by")[F.col("month")][d].alias(d) for d in WEEKDAYS]))


def close_returns(bars: DataFrame, key: str = "symbol", ts: str = "timestamp", price: str = "close",
                  block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Change of each bar's raw close against the series' bar before (null for the first)."""
    b = ordered.arrange(bars.select(key, ts, price), [key], [ts], block_rows)
    b = ordered.rolling(b, lambda w: [F.lag(price, 1).over(w).alias("_before")], lookback=1)
    return b.select(key, ts, (F.try_divide(F.col(price), F.col("_before")) - 1).alias("returns"))


def correlation_matrix(bars: DataFrame, symbols: list[str], key: str = "symbol",
                       ts: str = "timestamp", price: str = "close", block: int = 32) -> DataFrame:
    """Pearson correlation of the returns of raw closes over all timestamps, pairs a <= b.

    A series without a bar at a timestamp keeps its last close there, so its return is 0 from its
    first bar on and missing before.  ``symbols`` is the (small) list of series to correlate.
    """
    wide = close_returns(bars, key, ts, price).groupBy(ts).pivot(key, symbols).agg(F.max("returns"))
    began = bars.agg(*[F.min(F.when(F.col(key) == s, F.col(ts))).alias(f"_t{i}") for i, s in enumerate(symbols)])
    wide = with_stats(wide, began)
    wide = wide.select(*[F.when(F.col(f"`{s}`").isNull() & (F.col(ts) > F.col(f"_t{i}")), 0.0)
                         .otherwise(F.col(f"`{s}`")).alias(s) for i, s in enumerate(symbols)])
    groups = [symbols[i:i + block] for i in range(0, len(symbols), block)]
    if len(groups) > 1:
        ensure_checkpoint_dir(bars.sparkSession)
        wide = wide.checkpoint()        # read once for each pair of blocks
    parts = []
    for gi, ga in enumerate(groups):
        for gb in groups[gi:]:
            pairs = [(a, b) for a in ga for b in gb if a <= b]
            agg = wide.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"c{i}")
                             for i, (a, b) in enumerate(pairs)])
            rows = F.inline(F.array(*[F.struct(F.lit(a).alias("symbol_a"), F.lit(b).alias("symbol_b"),
                                               F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]))
            parts.append(agg.select(rows))
    return reduce(DataFrame.unionByName, parts)
