"""Technical indicators and model features as window functions.

All per-symbol series are evaluated through ``plans.ordered``: rows are
arranged once, then bounded row frames run over blocks of equal size, so no
task ever holds a whole symbol.  pandas semantics are kept where the
reference used pandas: ``rolling(n)`` is NULL until n rows exist,
``std`` is the sample deviation, ``ewm(adjust=False)`` seeds with the
first value and ``cummax`` is a running maximum.  Averages by recursion
(EMA, MACD) are a scan over blocks, ``plans.recursion``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.plans import ordered, recursion

EMA_SPANS = (C.EMA_FAST, C.EMA_SLOW, C.EMA_SIGNAL)


def rolling_mean(col: str, n: int, w) -> Column:
    f = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.col(col)).over(f) == n, F.avg(col).over(f))


def rolling_std(col: str, n: int, w) -> Column:
    f = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.col(col)).over(f) == n, F.stddev_samp(col).over(f))


def rsi_from_means(gain: Column, loss: Column) -> Column:
    """100 - 100/(1+gain/loss); loss 0 gives 100, 0/0 gives NULL."""
    return (F.when(gain.isNull() | loss.isNull(), F.lit(None))
            .when(loss == 0, F.when(gain > 0, F.lit(100.0)))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + gain / loss)))


def history_indicators(bars: DataFrame, key: str = "symbol", order: str = "timestamp",
                       price: str = "close", block_rows: int = ordered.DEFAULT_BLOCK_ROWS,
                       dropna: bool = True) -> DataFrame:
    """History page: returns, MA7/25/99, RSI14, Bollinger 20/2, MACD 12/26/9, drawdown."""
    df = ordered.arrange(bars, [key], [order], block_rows)

    def stage1(w):
        prev = F.lag(price, 1).over(w)
        delta = F.col(price) - prev
        return [
            F.try_divide(F.col(price) - prev, prev).alias("returns"),                     # W9
            *[rolling_mean(price, n, w).alias(f"MA{n}") for n in C.MA_PERIODS],           # W5
            F.when(delta > 0, delta).otherwise(F.lit(0.0)).alias("_gain"),
            F.when(delta < 0, -delta).otherwise(F.lit(0.0)).alias("_loss"),
            rolling_mean(price, C.BOLLINGER_PERIOD, w).alias("BB_mid"),                    # W6
            rolling_std(price, C.BOLLINGER_PERIOD, w).alias("BB_std"),
        ]

    def stage2(w):
        return [rsi_from_means(rolling_mean("_gain", C.RSI_PERIOD, w),
                               rolling_mean("_loss", C.RSI_PERIOD, w)).alias("RSI")]       # W7

    r = ordered.rolling(df, [stage1, stage2], lookback=max(C.MA_PERIODS) + C.RSI_PERIOD)
    r = recursion.ema_columns(r, price, EMA_SPANS, names=("_e12", "_e26", "MACD", "Signal"), source=df).drop("_e12", "_e26")  # W8
    r = (r.withColumn("BB_upper", F.col("BB_mid") + F.col("BB_std") * C.BOLLINGER_K)
          .withColumn("BB_lower", F.col("BB_mid") - F.col("BB_std") * C.BOLLINGER_K)
          .withColumn("MACD_Hist", F.col("MACD") - F.col("Signal")))
    if dropna:      # the running maximum starts with the first complete row
        r = r.dropna(subset=[c for c in r.columns if not c.startswith("_")])
    r = ordered.running(r, price, "max", "rolling_max")                                   # W11
    r = r.withColumn("drawdown", F.try_divide(F.col(price) - F.col("rolling_max"), F.col("rolling_max")))
    r = ordered.drop_helpers(r.drop("_gain", "_loss"))
    return r.dropna() if dropna else r


def live_indicators(rows: DataFrame, key: str = "symbol", order: tuple = ("processed_time", "event_id"),
                    price: str = "average_price", block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Live page: SMA20, sample std, Bollinger bands, RSI14, EMA12/26, MACD, signal; NULL -> 0 (P5)."""
    df = ordered.arrange(rows, [key], list(order), block_rows)

    def stage1(w):
        delta = F.col(price) - F.lag(price, 1).over(w)
        return [
            rolling_mean(price, C.BOLLINGER_PERIOD, w).alias("SMA_20"),
            rolling_std(price, C.BOLLINGER_PERIOD, w).alias("Std_Dev"),
            F.when(delta > 0, delta).otherwise(F.lit(0.0)).alias("_gain"),
            F.when(delta < 0, -delta).otherwise(F.lit(0.0)).alias("_loss"),
        ]

    def stage2(w):
        return [rsi_from_means(rolling_mean("_gain", C.RSI_PERIOD, w),
                               rolling_mean("_loss", C.RSI_PERIOD, w)).alias("RSI")]

    r = ordered.rolling(df, [stage1, stage2], lookback=C.BOLLINGER_PERIOD + C.RSI_PERIOD)
    r = recursion.ema_columns(r, price, EMA_SPANS, names=("EMA12", "EMA26", "MACD", "Signal_Line"), source=df)
    r = (r.withColumn("Bollinger_Upper", F.col("SMA_20") + F.col("Std_Dev") * C.BOLLINGER_K)
          .withColumn("Bollinger_Lower", F.col("SMA_20") - F.col("Std_Dev") * C.BOLLINGER_K)
          .drop("_gain", "_loss", *ordered.HELPERS))
    return r.na.fill(0)


def training_features(rows: DataFrame, key: str = "symbol", order: str = "processed_time",
                      price: str = "average_price", vol: str = "volatility",
                      block_rows: int = ordered.DEFAULT_BLOCK_ROWS, keep: bool = False,
                      complete: bool = True) -> DataFrame:
    """M3: lags 1/3 (W1), means 5/10 (W4), momentum and volatility change (W10),
    next price as target (W2); rows with any NULL dropped (P6) if ``complete``.

    With ``keep`` the columns of ``ordered.arrange`` stay, for ``chronological_split``.
    """
    df = ordered.arrange(rows, [key], [order], block_rows)

    def build(w):
        lag3 = F.lag(price, 3).over(w)
        return [
            F.lag(price, 1).over(w).alias("lag_1"),
            lag3.alias("lag_3"),
            *[rolling_mean(price, n, w).alias(f"ma_{n}") for n in C.FEATURE_MA_PERIODS],
            (F.col(price) - lag3).alias("momentum"),
            (F.col(vol) - F.lag(vol, 1).over(w)).alias("volatility_change"),
            F.lead(price, 1).over(w).alias("target_price"),
        ]

    r = ordered.rolling(df, build, lookback=max(C.FEATURE_MA_PERIODS), lookahead=1)
    r = r.dropna() if complete else r
    return r if keep else ordered.drop_helpers(r)


def chronological_split(features: DataFrame, fraction: float = C.TRAIN_FRACTION) -> DataFrame:
    """First floor(n * fraction) rows of each symbol are training rows.

    ``features`` are rows of ``training_features(..., keep=True)``; their order and partitioning serve
    here as well.  What enters a block, and the rows of a symbol, come from one summary by block.
    """
    by = Window.partitionBy("_key").orderBy("_blk")
    counts = features.groupBy("_key", "_blk").agg(F.count(F.lit(1)).alias("_in")).select(
        "_key", "_blk", F.coalesce(F.sum("_in").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_in").over(Window.partitionBy("_key")).alias("_n"))
    placed = ordered.carry(features.withColumn("_place", F.row_number().over(ordered.block_window())), counts)
    train = F.col("_before") + F.col("_place") <= F.floor(F.col("_n") * fraction)
    return ordered.drop_helpers(placed.withColumn("is_train", train).drop("_place", "_before", "_n"))


def change_points(df: DataFrame, key: str, order: list, payload: str,
                  block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Keep rows whose payload hash differs from the previous row of the same key."""
    s = ordered.arrange(df.withColumn("payload_hash", F.md5(F.col(payload))), [key], order, block_rows)
    r = ordered.rolling(s, lambda w: [F.lag("payload_hash", 1).over(w).alias("_prev")], lookback=1)
    return ordered.drop_helpers(r.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("payload_hash"))).drop("_prev"))
