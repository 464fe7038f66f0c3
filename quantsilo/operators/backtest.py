"""Backtests over 5-minute buckets.

The reference nests ``lead`` inside ``SUM`` (rejected by most engines); here
the lead is a window over the signal buckets alone (literal meaning: six
signal buckets ahead) or, with ``calendar=True``, six calendar buckets.  The
lead is a bounded frame, evaluated through ``plans.ordered.rolling`` so a hot
symbol is split in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.plans import ordered
from quantsilo.plans.joins import with_stats

STRATEGIES = ("cvd_bullish", "vpin_toxic")


def recent(rows: DataFrame, days: int = C.BACKTEST_DAYS, symbol: str | None = None, key: str = "symbol",
           time_col: str = "processed_time") -> DataFrame:
    """Rows of ``symbol`` (None: of all) that are less than ``days`` older than the table's newest row.

    Both are filters ahead of the buckets, so they reach the scan; 'now' is a scalar subquery.
    """
    now = rows.agg(F.max(time_col).alias("_now"))
    found = rows if symbol is None else rows.filter(F.col(key) == symbol)
    return (with_stats(found, now).filter(F.col(time_col) > F.col("_now") - F.expr(f"INTERVAL {int(days)} DAYS"))
            .drop("_now"))


def signal(strategy: str) -> Column:
    """Whether a bucket is a signal of the strategy; never null."""
    if strategy == "cvd_bullish":           # A11
        hit = (F.col("total_cvd") > C.CVD_BULLISH_MIN) & (F.col("avg_buy_wall") > F.col("avg_sell_wall"))
    elif strategy == "vpin_toxic":          # A12
        hit = F.col("peak_vpin") > C.VPIN_TOXIC_MIN
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return F.coalesce(hit, F.lit(False))


def _win(strategy: str, now, later):
    return (now < later) if strategy == "cvd_bullish" else (now > later)


def backtest(buckets: DataFrame, strategy: str, key: str = "symbol", lead: int = C.BACKTEST_LEAD,
             calendar: bool = False, block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per symbol: total signals, winning trades, win rate (A13: rounded to 2, 0 without signals).

    Signal buckets are a series of their own next to the others of the symbol, so one arrangement gives
    the lead over signals and every symbol reports, with zero counts where it has no signal.
    """
    rows = buckets.select(key, "bucket", "close_price", signal(strategy).alias("_signal"))
    series = [key] if calendar else [key, "_signal"]
    s = ordered.arrange(rows, series, ["bucket"], block_rows)
    r = ordered.rolling(s, lambda w: [F.lead("close_price", lead).over(w).alias("_later")], lookahead=lead)  # W3
    won = F.col("_signal") & F.coalesce(_win(strategy, F.col("close_price"), F.col("_later")), F.lit(False))
    out = r.groupBy(key).agg(F.sum(F.col("_signal").cast("long")).alias("total_signals"),
                             F.sum(won.cast("long")).alias("winning_trades"))
    return win_rate(out)


def win_rate(agg: DataFrame) -> DataFrame:
    """Win rate in percent, rounded to 2; 0 when there is no signal."""
    return agg.withColumn("win_rate", F.when(F.col("total_signals") > 0, F.round(
        F.col("winning_trades") / F.col("total_signals") * 100.0, 2)).otherwise(F.lit(0.0)))
