"""Bars: OHLC resampling, last-value resampling, 5-minute buckets, bar unions.

Resampling is a hash aggregate on (symbol, time bucket): partial aggregation
on the map side, one small row per bucket after the shuffle.  Open/close and
"last" values use ``min_by``/``max_by`` over the total order (time, id).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import usd_to_usdt, utc_year

# A8 intervals offered by the live page
RESAMPLE_INTERVALS = {"1s": "1 second", "5s": "5 seconds", "15s": "15 seconds",
                      "30s": "30 seconds", "1m": "1 minute"}


def ohlc(df: DataFrame, interval: str = "5s", key: str = "symbol", price: str = "average_price",
         time_col: str = "processed_time", tie: str = "event_id",
         last_cols=(), sum_cols=("volume_usd",)) -> DataFrame:
    """A8 + A9: OHLC of ``price`` per bucket, last non-null of ``last_cols``, sums;
    empty buckets never appear and buckets with a NULL result are dropped."""
    width = RESAMPLE_INTERVALS.get(interval, interval)
    order = F.struct(F.col(time_col), F.col(tie))
    aggs = [F.min_by(price, order).alias("open"), F.max(price).alias("high"),
            F.min(price).alias("low"), F.max_by(price, order).alias("close")]
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in last_cols]
    aggs += [F.sum(c).alias(f"{c}_sum") for c in sum_cols]
    out = (df.groupBy(key, F.window(time_col, width).alias("_w")).agg(*aggs)
           .withColumn(time_col, F.col("_w.start")).drop("_w"))
    return out.dropna()


def five_minute_buckets(rows: DataFrame, key: str = "symbol", time_col: str = "processed_time",
                        tie: str = "event_id", width: str = C.BACKTEST_BUCKET) -> DataFrame:
    """A10: per (symbol, bucket): last price, summed CVD, mean walls, peak VPIN."""
    order = F.struct(F.col(time_col), F.col(tie))
    return (rows.groupBy(key, F.window(time_col, width).alias("_w"))
            .agg(F.max_by("average_price", order).alias("close_price"),
                 F.sum("cvd").alias("total_cvd"),
                 F.avg("buy_wall_usd").alias("avg_buy_wall"),
                 F.avg("sell_wall_usd").alias("avg_sell_wall"),
                 F.max("vpin_score").alias("peak_vpin"))
            .withColumn("bucket", F.col("_w.start")).drop("_w"))


def normalize_bars(raw: DataFrame, ticker: str = "ticker", ts: str = "Date") -> DataFrame:
    """vendor bar rows -> (timestamp UTC, symbol '-USD'->'USDT', OHLCV, year)."""
    t = F.to_utc_timestamp(F.col(ts).cast("timestamp"), "UTC")
    return raw.select(t.alias("timestamp"), usd_to_usdt(ticker).alias("symbol"),
                      *[F.col(c).cast("double").alias(c.lower()) for c in ("Open", "High", "Low", "Close", "Volume")],
                      utc_year(t).alias("year"))


def union_bars(frames: list[DataFrame]) -> DataFrame:
    """Union of per-symbol frames by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
