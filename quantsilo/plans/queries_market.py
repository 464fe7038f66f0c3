"""Registered queries: silver windows, anomalies, gold summaries, quality (A1-A7, A20, A21, P*, W12, W13, M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.operators import gold, ops, silver
from quantsilo.plans.catalog import register
from quantsilo.sources import fixtures as fx
from quantsilo.sources.fixtures import with_ctes


def market_rows(spark, sf):
    """Ticks as serving-table rows: price -> average_price, time -> processed_time.

    The exchange mark price plays the model prediction (fixture mapping).
    """
    t = fx.ticks(spark, sf)
    return t.select("symbol", F.col("price").alias("average_price"),
                    F.col("mark_price").alias("predicted_price"),
                    F.col("ts").alias("processed_time"), "volume_usd", "event_id")


SQL_MARKET = """market AS (
  SELECT symbol, price AS average_price, mark_price AS predicted_price, ts AS processed_time,
         volume_usd, event_id FROM ticks)"""


# ---------------------------------------------------------------- A6 -------
@register("minute_summary", "A6 F2",
          sql=with_ctes(fx.SQL_TICKS, SQL_MARKET) + """
SELECT symbol, date_trunc('minute', processed_time) AS minute,
       avg(average_price) AS avg_price, max(average_price) AS max_price,
       min(average_price) AS min_price, count(*) AS trade_count
FROM market GROUP BY 1, 2""",
          doubles="avg_price max_price min_price")
def q_minute_summary(spark, sf):
    return gold.minute_summary(market_rows(spark, sf))


# ---------------------------------------------------------- A1-A5 ----------
SQL_WINDOWS = """d AS (
  SELECT *, CASE WHEN trade_side = 'BUY' THEN volume_usd ELSE -volume_usd END AS volume_delta FROM ticks),
x AS (
  SELECT d.*, time_bucket(INTERVAL '5 seconds', ts) - k * INTERVAL '5 seconds' AS window_start
  FROM d, (VALUES (0), (1)) AS v(k)),
win AS (
  SELECT window_start, window_start + INTERVAL '10 seconds' AS window_end, symbol,
         avg(price) AS average_price, stddev_pop(price) AS volatility,
         sum(volume_usd) AS volume_usd, sum(volume_delta) AS cvd,
         abs(sum(volume_delta)) / (sum(volume_usd) + 1) AS vpin_score,
         arg_max(buy_wall_usd, (ts, event_id)) / (arg_max(sell_wall_usd, (ts, event_id)) + 1) AS wall_imbalance,
         arg_max(is_buyer_maker, (ts, event_id)) AS is_buyer_maker,
         arg_max(trade_side, (ts, event_id)) AS trade_side,
         arg_max(buy_wall_usd, (ts, event_id)) AS buy_wall_usd,
         arg_max(sell_wall_usd, (ts, event_id)) AS sell_wall_usd,
         arg_max(imbalance_ratio, (ts, event_id)) AS imbalance_ratio,
         arg_max(mark_price, (ts, event_id)) AS mark_price,
         arg_max(funding_rate, (ts, event_id)) AS funding_rate,
         sum(liq_buy_usd) AS liq_buy_usd, sum(liq_sell_usd) AS liq_sell_usd,
         max(ts) AS processed_time
  FROM x GROUP BY window_start, symbol)"""

_WIN_DOUBLES = ("average_price volatility volume_usd cvd vpin_score wall_imbalance buy_wall_usd "
                "sell_wall_usd imbalance_ratio mark_price funding_rate liq_buy_usd liq_sell_usd")


@register("silver_windows", "A1 A2 A3 A4 A5 P3 P4 R2",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + "SELECT * FROM win",
          doubles=_WIN_DOUBLES)
def q_silver_windows(spark, sf):
    return silver.window_metrics(fx.ticks(spark, sf))


@register("silver_from_records", "P1 P2 A1 A5 F13 R2",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + "SELECT * FROM win",
          doubles=_WIN_DOUBLES)
def q_silver_from_records(spark, sf):
    """Raw broker records to silver windows: the batch form of the streaming chain."""
    return silver.window_metrics(silver.parse_ticks(ops.to_kafka_records(fx.ticks(spark, sf))))


_BANDS_SQL = ", ".join(
    f"average_price * {1 + f!r} AS liq_up_{lev}x, average_price * {1 - f!r} AS liq_dn_{lev}x"
    for lev, f in C.LIQ_BANDS)

SQL_SILVER = SQL_WINDOWS + f""",
h AS (
  SELECT *, average_price AS predicted_price, {_BANDS_SQL},
         count(*) OVER w AS n, avg(volume_usd) OVER w AS vm, stddev_pop(volume_usd) OVER w AS vs,
         avg(wall_imbalance) OVER w AS im, stddev_pop(wall_imbalance) OVER w AS isd
  FROM win
  WINDOW w AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN {C.ANOMALY_HISTORY - 1} PRECEDING AND CURRENT ROW)),
z AS (
  SELECT *, (volume_usd - vm) / (vs + {C.ANOMALY_EPS!r}) AS vz, (wall_imbalance - im) / (isd + {C.ANOMALY_EPS!r}) AS iz FROM h),
silver AS (
  SELECT window_start, window_end, symbol, average_price, volume_usd, is_buyer_maker, trade_side,
         processed_time, volatility, predicted_price, cvd, buy_wall_usd, sell_wall_usd, imbalance_ratio,
         mark_price, funding_rate, liq_buy_usd, liq_sell_usd, vpin_score, wall_imbalance,
         liq_up_10x, liq_dn_10x, liq_up_25x, liq_dn_25x, liq_up_50x, liq_dn_50x, liq_up_100x, liq_dn_100x,
         CASE WHEN n >= {C.ANOMALY_MIN_ROWS} THEN vz > {C.ANOMALY_Z} ELSE false END AS anomaly_wash_trading,
         CASE WHEN n >= {C.ANOMALY_MIN_ROWS} THEN abs(iz) > {C.ANOMALY_Z} AND volume_usd < vm * {C.SPOOF_VOLUME_FRACTION}
              ELSE false END AS anomaly_spoofing,
         CASE WHEN n >= {C.ANOMALY_MIN_ROWS} THEN greatest(abs(vz), abs(iz)) ELSE 0.0 END AS anomaly_score
  FROM z)"""

_SILVER_DOUBLES = (_WIN_DOUBLES + " predicted_price liq_up_10x liq_dn_10x liq_up_25x liq_dn_25x "
                   "liq_up_50x liq_dn_50x liq_up_100x liq_dn_100x anomaly_score")


@register("silver_enriched", "M1 M2 P9 W12 W13 F10",
          sql=with_ctes(fx.SQL_TICKS, SQL_SILVER) + "SELECT * FROM silver",
          doubles=_SILVER_DOUBLES)
def q_silver_enriched(spark, sf):
    return silver.silver(fx.ticks(spark, sf))


@register("serving_rows", "S13",
          sql=with_ctes(fx.SQL_TICKS, SQL_SILVER) + """
SELECT symbol, average_price, volume_usd, is_buyer_maker, trade_side, processed_time, volatility,
       predicted_price, cvd, buy_wall_usd, sell_wall_usd, imbalance_ratio, mark_price, funding_rate,
       liq_buy_usd, liq_sell_usd, vpin_score, wall_imbalance, window_start, window_end FROM silver""",
          doubles=_WIN_DOUBLES + " predicted_price")
def q_serving_rows(spark, sf):
    return silver.serving_projection(silver.silver(fx.ticks(spark, sf)))


# ---------------------------------------------------------- P8 / A7 --------
@register("hourly_model_performance", "A7 P8 F2",
          sql=with_ctes(fx.SQL_TICKS, SQL_MARKET) + """,
stg AS (SELECT symbol, average_price AS current_price, predicted_price AS ai_prediction,
               abs(average_price - predicted_price) AS prediction_error, processed_time AS event_timestamp
        FROM market)
SELECT symbol, date_trunc('hour', event_timestamp) AS observation_hour,
       avg(current_price) AS avg_actual_price, avg(ai_prediction) AS avg_predicted_price,
       avg(prediction_error) AS mean_absolute_error, count(*) AS tick_count
FROM stg GROUP BY 1, 2""",
          doubles="avg_actual_price avg_predicted_price mean_absolute_error")
def q_hourly_model_performance(spark, sf):
    return gold.hourly_model_performance(gold.staging(market_rows(spark, sf)))


# ------------------------------------------------------- A20 / A21 ---------
@register("quality_gate", "A20 P14",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE average_price <= 0) AS bad_prices,
       count(*) FILTER (WHERE volatility IS NULL) AS null_volatility,
       count(*) FILTER (WHERE processed_time IS NULL) AS null_time,
       CASE WHEN count(*) FILTER (WHERE average_price <= 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS price_check,
       CASE WHEN count(*) FILTER (WHERE volatility IS NULL) > 0 THEN 'WARN' ELSE 'PASS' END AS volatility_check,
       CASE WHEN count(*) FILTER (WHERE processed_time IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS time_check,
       CASE WHEN count(*) = 0 THEN 'EMPTY'
            WHEN count(*) FILTER (WHERE average_price <= 0) > 0
              OR count(*) FILTER (WHERE processed_time IS NULL) > 0 THEN 'FAILED'
            ELSE 'PASSED' END AS result
FROM win""")
def q_quality_gate(spark, sf):
    return gold.quality_report(silver.window_metrics(fx.ticks(spark, sf)))


@register("not_null_tests", "A21",
          sql=with_ctes(fx.SQL_TICKS, SQL_MARKET) + """
SELECT 'not_null_symbol' AS test_name, count(*) FILTER (WHERE symbol IS NULL) AS failures,
       CASE WHEN count(*) FILTER (WHERE symbol IS NULL) = 0 THEN 'pass' ELSE 'fail' END AS status FROM market
UNION ALL
SELECT 'not_null_processed_time', count(*) FILTER (WHERE processed_time IS NULL),
       CASE WHEN count(*) FILTER (WHERE processed_time IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM market""")
def q_not_null_tests(spark, sf):
    return gold.not_null_tests(market_rows(spark, sf))
