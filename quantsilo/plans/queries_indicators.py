"""Registered queries: indicators, bars, backtests, seasonality, correlation (W*, A8-A13, A22, A23, J8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.operators import analysis, backtest, bars, indicators, silver
from quantsilo.plans.catalog import register, spark_round_sql
from quantsilo.plans.queries_market import SQL_WINDOWS
from quantsilo.sources import fixtures as fx
from quantsilo.sources.fixtures import with_ctes


def _a(span: int) -> tuple[str, str]:
    a = 2.0 / (span + 1)
    return repr(1 - a), repr(a)


_K12, _A12 = _a(C.EMA_FAST)
_K26, _A26 = _a(C.EMA_SLOW)
_K9, _A9 = _a(C.EMA_SIGNAL)


def _ma(col, n, w="w"):
    return (f'CASE WHEN count({col}) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING '
            f'AND CURRENT ROW) = {n} THEN avg({col}) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN '
            f'{n - 1} PRECEDING AND CURRENT ROW) END')


def _sd(col, n):
    return (f'CASE WHEN count({col}) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING '
            f'AND CURRENT ROW) = {n} THEN stddev_samp({col}) OVER (PARTITION BY symbol ORDER BY seq ROWS '
            f'BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END')


_RSI = ("CASE WHEN g IS NULL OR l IS NULL THEN NULL WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 END "
        "ELSE 100.0 - 100.0 / (1.0 + g / l) END")


def _ema_sql(src: str, price: str) -> str:
    """EMA 12/26 by recursion over seq (full history), MACD, then the signal EMA 9."""
    return f"""e AS (
  SELECT symbol, seq, {price} AS e12, {price} AS e26 FROM {src} WHERE seq = 0
  UNION ALL
  SELECT b.symbol, b.seq, e.e12 * {_K12} + b.{price} * {_A12}, e.e26 * {_K26} + b.{price} * {_A26}
  FROM e JOIN {src} b ON b.symbol = e.symbol AND b.seq = e.seq + 1),
m AS (SELECT b.*, e.e12 AS "EMA12", e.e26 AS "EMA26", e.e12 - e.e26 AS "MACD"
      FROM {src} b JOIN e USING (symbol, seq)),
s AS (
  SELECT symbol, seq, "MACD" AS sig FROM m WHERE seq = 0
  UNION ALL
  SELECT m.symbol, m.seq, s.sig * {_K9} + m."MACD" * {_A9} FROM s JOIN m ON m.symbol = s.symbol AND m.seq = s.seq + 1),
ms AS (SELECT m.*, s.sig AS sig FROM m JOIN s USING (symbol, seq))"""


# ------------------------------------------------------- history page -------
SQL_HISTORY = "WITH RECURSIVE " + fx.SQL_BARS + """,
b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") - 1 AS seq FROM bars),
""" + _ema_sql("b", "close") + f""",
f AS (
  SELECT *,
    CASE WHEN lag(close) OVER w = 0 THEN NULL ELSE (close - lag(close) OVER w) / lag(close) OVER w END AS "returns",
    {_ma('close', 7)} AS "MA7", {_ma('close', 25)} AS "MA25", {_ma('close', 99)} AS "MA99",
    CASE WHEN close - lag(close) OVER w > 0 THEN close - lag(close) OVER w ELSE 0.0 END AS gain,
    CASE WHEN close - lag(close) OVER w < 0 THEN -(close - lag(close) OVER w) ELSE 0.0 END AS loss,
    {_ma('close', 20)} AS "BB_mid", {_sd('close', 20)} AS "BB_std"
  FROM ms WINDOW w AS (PARTITION BY symbol ORDER BY seq)),
r AS (SELECT *, {_ma('gain', 14)} AS g, {_ma('loss', 14)} AS l FROM f),
hist AS (
  SELECT symbol, "timestamp", open, high, low, close, volume, "returns", "MA7", "MA25", "MA99",
         "BB_mid", "BB_std", "MACD", {_RSI} AS "RSI", sig AS "Signal",
         "BB_mid" + "BB_std" * 2.0 AS "BB_upper", "BB_mid" - "BB_std" * 2.0 AS "BB_lower",
         "MACD" - sig AS "MACD_Hist"
  FROM r),
hist_full AS (
  SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY "timestamp"
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rolling_max
  FROM hist WHERE "returns" IS NOT NULL AND "MA7" IS NOT NULL AND "MA25" IS NOT NULL
    AND "MA99" IS NOT NULL AND "BB_mid" IS NOT NULL AND "BB_std" IS NOT NULL AND "RSI" IS NOT NULL),
hist_clean AS (
  SELECT *, (close - rolling_max) / rolling_max AS drawdown FROM hist_full WHERE rolling_max <> 0)
"""

_HIST_DOUBLES = ("open high low close volume returns MA7 MA25 MA99 BB_mid BB_std MACD RSI Signal "
                 "BB_upper BB_lower MACD_Hist rolling_max drawdown")


@register("history_indicators", "W5 W6 W7 W8 W9 W11 T5 P6 P26",
          sql=SQL_HISTORY + "SELECT * FROM hist_clean", doubles=_HIST_DOUBLES, digits=4)
def q_history_indicators(spark, sf):
    return indicators.history_indicators(fx.daily_bars(spark, sf))


@register("seasonality_pivot", "A22 F5",
          sql=SQL_HISTORY + """
SELECT s.symbol, m.month, m.month_no, "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"
FROM (SELECT DISTINCT symbol FROM hist_clean) s
CROSS JOIN (SELECT CAST(k AS INTEGER) AS month_no, monthname(make_date(2000, k, 1)) AS month FROM range(1, 13) AS r(k)) m
LEFT JOIN (SELECT * FROM (
  PIVOT (SELECT symbol, monthname("timestamp") AS month, dayname("timestamp") AS wd, "returns" * 100.0 AS rx
         FROM hist_clean)
  ON wd IN ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday')
  USING avg(rx) GROUP BY symbol, month)) p ON p.symbol = s.symbol AND p.month = m.month""",
          doubles="Monday Tuesday Wednesday Thursday Friday Saturday Sunday", digits=4)
def q_seasonality(spark, sf):
    return analysis.seasonality(indicators.history_indicators(fx.daily_bars(spark, sf)))


@register("return_correlation", "A23 J8 W9",
          sql=with_ctes(fx.SQL_BARS) + """,
began AS (SELECT symbol, min("timestamp") AS t0 FROM bars GROUP BY symbol),
times AS (SELECT DISTINCT "timestamp" FROM bars),
held AS (
  SELECT s.symbol, t."timestamp", last_value(b.close IGNORE NULLS) OVER (
           PARTITION BY s.symbol ORDER BY t."timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
  FROM began s CROSS JOIN times t LEFT JOIN bars b ON b.symbol = s.symbol AND b."timestamp" = t."timestamp"),
changes AS (
  SELECT symbol, "timestamp", c / nullif(lag(c) OVER (PARTITION BY symbol ORDER BY "timestamp"), 0) - 1 AS r FROM held)
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, corr(a.r, b.r) AS corr
FROM changes a JOIN changes b ON a."timestamp" = b."timestamp" AND a.symbol <= b.symbol
GROUP BY 1, 2""", doubles="corr", digits=4)
def q_return_correlation(spark, sf):
    bars = fx.daily_bars(spark, sf)
    # the series to correlate: the distinct symbols (a small list, like a pivot's values)
    symbols = sorted(r.symbol for r in bars.select("symbol").distinct().collect())
    return analysis.correlation_matrix(bars, symbols)


# ------------------------------------------------------- live candles -------
SQL_LIVE = "WITH RECURSIVE " + fx.SQL_TICKS + """,
b AS (SELECT symbol, price AS average_price, mark_price AS predicted_price, ts AS processed_time,
             volume_usd, trade_side, event_id,
             row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1 AS seq FROM ticks),
""" + _ema_sql("b", "average_price") + f""",
f AS (
  SELECT *, {_ma('average_price', 20)} AS "SMA_20", {_sd('average_price', 20)} AS "Std_Dev",
    CASE WHEN average_price - lag(average_price) OVER w > 0 THEN average_price - lag(average_price) OVER w ELSE 0.0 END AS gain,
    CASE WHEN average_price - lag(average_price) OVER w < 0 THEN -(average_price - lag(average_price) OVER w) ELSE 0.0 END AS loss
  FROM ms WINDOW w AS (PARTITION BY symbol ORDER BY seq)),
r AS (SELECT *, {_ma('gain', 14)} AS g, {_ma('loss', 14)} AS l FROM f),
live AS (
  SELECT symbol, average_price, predicted_price, processed_time, volume_usd, trade_side, event_id,
         coalesce("SMA_20", 0) AS "SMA_20", coalesce("Std_Dev", 0) AS "Std_Dev",
         "EMA12", "EMA26", coalesce({_RSI}, 0) AS "RSI", "MACD", sig AS "Signal_Line",
         coalesce("SMA_20" + "Std_Dev" * 2.0, 0) AS "Bollinger_Upper",
         coalesce("SMA_20" - "Std_Dev" * 2.0, 0) AS "Bollinger_Lower"
  FROM r)
"""

_LAST = ["predicted_price", "Bollinger_Upper", "Bollinger_Lower", "MACD", "Signal_Line", "RSI", "volatility", "SMA_20",
         "trade_side", "is_buyer_maker", "cvd"]

# the page's rows are the silver windows; ties of the last tick's time go by the window's start
SQL_LIVE_WINDOWS = "WITH RECURSIVE " + fx.SQL_TICKS + ",\n" + SQL_WINDOWS + """,
b AS (SELECT symbol, average_price, mark_price AS predicted_price, processed_time, volume_usd, trade_side, is_buyer_maker,
             volatility, cvd, vpin_score, window_start,
             row_number() OVER (PARTITION BY symbol ORDER BY processed_time, window_start) - 1 AS seq FROM win),
""" + _ema_sql("b", "average_price") + f""",
f AS (
  SELECT *, {_ma('average_price', 20)} AS "SMA_20", {_sd('average_price', 20)} AS "Std_Dev",
    CASE WHEN average_price - lag(average_price) OVER w > 0 THEN average_price - lag(average_price) OVER w ELSE 0.0 END AS gain,
    CASE WHEN average_price - lag(average_price) OVER w < 0 THEN -(average_price - lag(average_price) OVER w) ELSE 0.0 END AS loss
  FROM ms WINDOW w AS (PARTITION BY symbol ORDER BY seq)),
r AS (SELECT *, {_ma('gain', 14)} AS g, {_ma('loss', 14)} AS l FROM f),
live AS (
  SELECT symbol, average_price, predicted_price, processed_time, volume_usd, trade_side, is_buyer_maker, volatility, cvd,
         vpin_score, window_start, coalesce("SMA_20", 0) AS "SMA_20", coalesce("Std_Dev", 0) AS "Std_Dev",
         "EMA12", "EMA26", coalesce({_RSI}, 0) AS "RSI", "MACD", sig AS "Signal_Line",
         coalesce("SMA_20" + "Std_Dev" * 2.0, 0) AS "Bollinger_Upper",
         coalesce("SMA_20" - "Std_Dev" * 2.0, 0) AS "Bollinger_Lower"
  FROM r)
"""


def live_windows(spark, sf):
    """Silver windows with the live page's indicators."""
    w = silver.window_metrics(fx.ticks(spark, sf)).select(
        "symbol", "average_price", F.col("mark_price").alias("predicted_price"), "processed_time", "volume_usd",
        "trade_side", "is_buyer_maker", "volatility", "cvd", "vpin_score", "window_start")
    return indicators.live_indicators(w, order=("processed_time", "window_start"))


def _live_rows(spark, sf):
    t = fx.ticks(spark, sf)
    return t.select("symbol", F.col("price").alias("average_price"), F.col("mark_price").alias("predicted_price"),
                    F.col("ts").alias("processed_time"), "volume_usd", "trade_side", "event_id")


@register("live_indicators", "W6 W7 W8 P5 M2",
          sql=SQL_LIVE + "SELECT * FROM live",
          doubles="average_price predicted_price volume_usd SMA_20 Std_Dev EMA12 EMA26 RSI MACD Signal_Line "
                  "Bollinger_Upper Bollinger_Lower")
def q_live_indicators(spark, sf):
    return indicators.live_indicators(_live_rows(spark, sf))


_LAST_SQL = ", ".join(f'arg_max("{c}", (processed_time, window_start)) AS "{c}"' for c in _LAST)


@register("live_candles_1m", "A8 A9 P5 J7",
          sql=SQL_LIVE_WINDOWS + f"""
SELECT symbol, time_bucket(INTERVAL '1 minute', processed_time) AS processed_time,
       arg_min(average_price, (processed_time, window_start)) AS open, max(average_price) AS high,
       min(average_price) AS low, arg_max(average_price, (processed_time, window_start)) AS close,
       {_LAST_SQL}, sum(volume_usd) AS volume_usd_sum
FROM live GROUP BY symbol, time_bucket(INTERVAL '1 minute', processed_time)""",
          doubles="open high low close predicted_price Bollinger_Upper Bollinger_Lower MACD Signal_Line RSI "
                  "volatility SMA_20 cvd volume_usd_sum")
def q_live_candles(spark, sf):
    return bars.ohlc(live_windows(spark, sf), "1m", tie="window_start", last_cols=_LAST)


@register("ohlc_5s", "A8",
          sql="WITH " + fx.SQL_TICKS + """
SELECT symbol, time_bucket(INTERVAL '5 seconds', ts) AS processed_time,
       arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close, sum(volume_usd) AS volume_usd_sum
FROM ticks GROUP BY 1, 2""", doubles="open high low close volume_usd_sum")
def q_ohlc_5s(spark, sf):
    t = _live_rows(spark, sf)
    return bars.ohlc(t, "5s")


# --------------------------------------------------- buckets / backtests ----
SQL_BUCKETS = SQL_WINDOWS + """,
buckets AS (
  SELECT symbol, time_bucket(INTERVAL '5 minutes', processed_time) AS bucket,
         arg_max(average_price, (processed_time, window_start)) AS close_price,
         sum(cvd) AS total_cvd, avg(buy_wall_usd) AS avg_buy_wall, avg(sell_wall_usd) AS avg_sell_wall,
         max(vpin_score) AS peak_vpin
  FROM win GROUP BY 1, 2)"""


def _buckets(spark, sf):
    return bars.five_minute_buckets(silver.window_metrics(fx.ticks(spark, sf)), tie="window_start")


@register("five_minute_buckets", "A10",
          sql="WITH " + fx.SQL_TICKS + ",\n" + SQL_BUCKETS + "\nSELECT * FROM buckets",
          doubles="close_price total_cvd avg_buy_wall avg_sell_wall peak_vpin")
def q_buckets(spark, sf):
    return _buckets(spark, sf)


def _bt_sql(cond: str, cmp: str, buckets: str = SQL_BUCKETS) -> str:
    return "WITH " + fx.SQL_TICKS + ",\n" + buckets + f""",
sig AS (SELECT *, lead(close_price, {C.BACKTEST_LEAD}) OVER (PARTITION BY symbol ORDER BY bucket) AS later
        FROM buckets WHERE {cond}),
agg AS (SELECT symbol, count(*) AS total_signals,
       CAST(sum(CASE WHEN close_price {cmp} later THEN 1 ELSE 0 END) AS BIGINT) AS winning_trades
       FROM sig GROUP BY symbol)
SELECT k.symbol, coalesce(total_signals, 0) AS total_signals, coalesce(winning_trades, 0) AS winning_trades,
       CASE WHEN coalesce(total_signals, 0) > 0 THEN {spark_round_sql("winning_trades / total_signals * 100.0", 2)}
            ELSE 0.0 END AS win_rate
FROM (SELECT DISTINCT symbol FROM buckets) k LEFT JOIN agg USING (symbol)"""


@register("backtest_cvd_bullish", "A11 A13 W3",
          sql=_bt_sql(f"total_cvd > {C.CVD_BULLISH_MIN} AND avg_buy_wall > avg_sell_wall", "<"))
def q_bt_cvd(spark, sf):
    return backtest.backtest(_buckets(spark, sf), "cvd_bullish")


@register("backtest_vpin_toxic", "A12 A13 W3",
          sql=_bt_sql(f"peak_vpin > {C.VPIN_TOXIC_MIN}", ">"))
def q_bt_vpin(spark, sf):
    return backtest.backtest(_buckets(spark, sf), "vpin_toxic")


@register("backtest_recent_symbol", "A11 A13 W3",
          sql=_bt_sql(f"total_cvd > {C.CVD_BULLISH_MIN} AND avg_buy_wall > avg_sell_wall", "<", SQL_BUCKETS.replace(
              "FROM win GROUP BY", f"""FROM win WHERE symbol = 'purchase' AND processed_time >
    (SELECT max(processed_time) FROM win) - INTERVAL '{C.BACKTEST_DAYS} days' GROUP BY""")))
def q_bt_recent(spark, sf):
    rows = backtest.recent(silver.window_metrics(fx.ticks(spark, sf)), symbol="purchase")
    return backtest.backtest(bars.five_minute_buckets(rows, tie="window_start"), "cvd_bullish")


@register("backtest_vpin_recent_symbol", "A12 A13 W3",
          sql=_bt_sql(f"peak_vpin > {C.VPIN_TOXIC_MIN}", ">", SQL_BUCKETS.replace(
              "FROM win GROUP BY", f"""FROM win WHERE symbol = 'click' AND processed_time >
    (SELECT max(processed_time) FROM win) - INTERVAL '{C.BACKTEST_DAYS} days' GROUP BY""")))
def q_bt_vpin_recent(spark, sf):
    rows = backtest.recent(silver.window_metrics(fx.ticks(spark, sf)), symbol="click")
    return backtest.backtest(bars.five_minute_buckets(rows, tie="window_start"), "vpin_toxic")


# ------------------------------------------------ features / split ----------
SQL_FEATURES = SQL_WINDOWS + """,
feat AS (
  SELECT *, lag(average_price, 1) OVER w AS lag_1, lag(average_price, 3) OVER w AS lag_3,
    CASE WHEN count(average_price) OVER w5 = 5 THEN avg(average_price) OVER w5 END AS ma_5,
    CASE WHEN count(average_price) OVER w10 = 10 THEN avg(average_price) OVER w10 END AS ma_10,
    average_price - lag(average_price, 3) OVER w AS momentum,
    volatility - lag(volatility, 1) OVER w AS volatility_change,
    lead(average_price, 1) OVER w AS target_price
  FROM win
  WINDOW w AS (PARTITION BY symbol ORDER BY window_start),
         w5 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         w10 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
features AS (SELECT * FROM feat WHERE lag_1 IS NOT NULL AND lag_3 IS NOT NULL AND ma_5 IS NOT NULL
             AND ma_10 IS NOT NULL AND momentum IS NOT NULL AND volatility_change IS NOT NULL
             AND target_price IS NOT NULL)"""

_FEAT_DOUBLES = _WIN = ("average_price volatility volume_usd cvd vpin_score wall_imbalance buy_wall_usd "
                        "sell_wall_usd imbalance_ratio mark_price funding_rate liq_buy_usd liq_sell_usd "
                        "lag_1 lag_3 ma_5 ma_10 momentum volatility_change target_price")


def _features(spark, sf, keep=False):
    w = silver.window_metrics(fx.ticks(spark, sf))
    return indicators.training_features(w, order="window_start", keep=keep)


@register("training_features", "M3 W1 W2 W4 W10 P6",
          sql="WITH " + fx.SQL_TICKS + ",\n" + SQL_FEATURES + "\nSELECT * FROM features",
          doubles=_FEAT_DOUBLES)
def q_features(spark, sf):
    return _features(spark, sf)


@register("chronological_split", "W18",
          sql="WITH " + fx.SQL_TICKS + ",\n" + SQL_FEATURES + """
SELECT * EXCLUDE (rn, n), rn < floor(n * 0.8) AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) - 1 AS rn,
         count(*) OVER (PARTITION BY symbol) AS n FROM features)""",
          doubles=_FEAT_DOUBLES)
def q_split(spark, sf):
    return indicators.chronological_split(_features(spark, sf, keep=True))


@register("change_points", "W17",
          sql="WITH " + fx.SQL_TICKS + """
SELECT * EXCLUDE (prev) FROM (
  SELECT symbol, ts, event_id, payload, md5(payload) AS payload_hash,
         lag(md5(payload)) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev
  FROM (SELECT symbol, ts, event_id, trade_side || ':' || CAST(CAST(quantity AS BIGINT) % 4 AS VARCHAR) AS payload
        FROM ticks))
WHERE prev IS NULL OR prev <> payload_hash""")
def q_change_points(spark, sf):
    t = fx.ticks(spark, sf)
    p = t.select("symbol", "ts", "event_id",
                 F.concat(F.col("trade_side"), F.lit(":"),
                          (F.col("quantity").cast("long") % 4).cast("string")).alias("payload"))
    return indicators.change_points(p, "symbol", ["ts", "event_id"], "payload")
