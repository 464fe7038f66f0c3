"""Registered queries: alarms, model runs, quotas, digests, tags, membership, bronze (A16-A28, J4, J6, J10, J11, P*, R*, W14-W16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.operators import alerts, derivatives, gold, indicators, ops, quotas, runs, silver
from quantsilo.plans.catalog import register, spark_round_sql
from quantsilo.plans.queries_indicators import SQL_FEATURES, SQL_HISTORY, SQL_LIVE_WINDOWS, live_windows
from quantsilo.plans.queries_market import SQL_SILVER, SQL_WINDOWS, market_rows
from quantsilo.sources import fixtures as fx
from quantsilo.sources.fixtures import with_ctes
from quantsilo.sources.tables import table

# ---------------------------------------------------------------- alarms ----
SQL_ALARM_BASE = with_ctes(fx.SQL_TICKS, fx.SQL_ALARMS) + f""",
capped AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at, alarm_id) AS rn FROM alarms)
  WHERE rn <= {C.MAX_ALARMS_PER_USER}),
now_t AS (SELECT max(ts) AS as_of FROM ticks),
live AS (SELECT capped.*, as_of FROM capped, now_t
         WHERE created_at <= as_of AND as_of < created_at + INTERVAL {C.ALARM_TTL_DAYS} DAY),
prices AS (SELECT symbol, arg_max(price, (ts, event_id)) AS current_price FROM ticks GROUP BY symbol),
fired AS (SELECT live.*, current_price FROM live JOIN prices USING (symbol)
          WHERE (direction = 'up' AND current_price >= target) OR (direction = 'down' AND current_price <= target))"""


def _live_alarms(spark, sf):
    t = fx.ticks(spark, sf)
    a = alerts.cap_per_user(fx.alarms(spark, sf))
    as_of = t.agg(F.max("ts").alias("as_of"))
    return t, alerts.live_alarms(a, as_of)


@register("alarm_triggers", "J4 A28 R7 F11",
          sql=SQL_ALARM_BASE + """
SELECT alarm_id, user_id, symbol, target, direction, created_at, as_of, current_price,
       'alarm:' || CAST(user_id AS VARCHAR) || ':' || symbol || ':' || CAST(target AS VARCHAR) || ':' || direction
         AS alarm_key
FROM fired""", doubles="target current_price")
def q_alarm_triggers(spark, sf):
    t, live = _live_alarms(spark, sf)
    fired = alerts.triggered(live, alerts.current_prices(t))
    keyed = alerts.with_keys(fired)
    # F11 round trip: the stored key parses back to the same fields
    parsed = alerts.parse_keys(keyed.select("alarm_id", "alarm_key", "created_at", "as_of", "current_price"))
    return parsed.select("alarm_id", "user_id", "symbol", "target", "direction", "created_at", "as_of",
                         "current_price", "alarm_key")


@register("alarm_remaining", "J11 R7",
          sql=SQL_ALARM_BASE + """
SELECT alarm_id, user_id, symbol, target, direction, created_at FROM live
WHERE alarm_id NOT IN (SELECT alarm_id FROM fired)""", doubles="target")
def q_alarm_remaining(spark, sf):
    t, live = _live_alarms(spark, sf)
    fired = alerts.triggered(live, alerts.current_prices(t))
    return alerts.still_active(live, fired).select("alarm_id", "user_id", "symbol", "target", "direction",
                                                  "created_at")


@register("alarm_counts", "A25",
          sql=SQL_ALARM_BASE + """
SELECT count(*) AS alarms, count(DISTINCT symbol) AS symbols, count(DISTINCT user_id) AS users FROM live""")
def q_alarm_counts(spark, sf):
    _, live = _live_alarms(spark, sf)
    return alerts.alarm_counts(live)


_WORDS = ["üst", "alt", "up", "down", "yukarı", "aşağı", "sideways"]


@register("alarm_directions", "F12",
          sql="""
SELECT c_custkey AS user_id, w AS direction_raw,
       CASE WHEN lower(trim(w)) IN ('üst', 'ust', 'üstü', 'up', 'yukari', 'yukarı') THEN 'up' ELSE 'down' END AS direction
FROM (SELECT c_custkey, ['üst', 'alt', 'up', 'down', 'yukarı', 'aşağı', 'sideways'][c_custkey % 7 + 1] AS w FROM customer)
WHERE lower(trim(w)) IN ('üst', 'ust', 'üstü', 'up', 'yukari', 'yukarı', 'alt', 'down', 'aşağı', 'asagi')""")
def q_alarm_directions(spark, sf):
    c = table(spark, sf, "customer")
    raw = c.select(F.col("c_custkey").alias("user_id"),
                   F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (F.col("c_custkey") % 7 + 1).cast("int"))
                   .alias("direction_raw"))
    return alerts.normalize_requests(raw)


# ------------------------------------------------------------ model runs ----
SQL_CHILDREN = with_ctes(fx.SQL_RUNS) + """,
parents AS (SELECT run_id AS parent_run_id, symbol AS coin_folder FROM runs WHERE parent_run_id IS NULL),
children AS (
  SELECT r.run_id, r.parent_run_id, p.coin_folder,
         coalesce(TRY_CAST(r.rmse AS DOUBLE), 9999.0) AS rmse, coalesce(TRY_CAST(r.r2 AS DOUBLE), 0.0) AS r2,
         (epoch_us(r.end_time) - epoch_us(r.start_time)) / 1000.0 AS duration_ms,
         upper(replace(r.run_name, '_', ' ')) AS model_name, r.start_time
  FROM runs r JOIN parents p USING (parent_run_id))"""


def _children(spark, sf):
    return runs.child_runs(fx.model_runs(spark, sf))


@register("model_leaderboard", "J6 F6 F7 F8 W14 W16 M6",
          sql=SQL_CHILDREN + f"""
SELECT *, concat_ws(' ', CASE WHEN "rank" = 1 THEN '{runs.BADGE_CHAMPION}' END,
                         CASE WHEN duration_ms = min(duration_ms) OVER () THEN '{runs.BADGE_FASTEST}' END,
                         CASE WHEN r2 > {C.R2_BADGE} THEN '{runs.BADGE_PRECISE}' END) AS badges
FROM (SELECT *, row_number() OVER (ORDER BY rmse, run_id) AS "rank" FROM children)""",
          doubles="rmse r2 duration_ms")
def q_leaderboard(spark, sf):
    return runs.leaderboard(_children(spark, sf))


@register("folder_champions", "W15",
          sql=SQL_CHILDREN + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY coin_folder ORDER BY rmse, run_id) AS rn
                            FROM children) WHERE rn = 1""", doubles="rmse r2 duration_ms")
def q_champions(spark, sf):
    return runs.folder_champions(_children(spark, sf))


@register("folder_ranks", "W14",
          sql=SQL_CHILDREN + """
SELECT *, row_number() OVER (PARTITION BY coin_folder ORDER BY rmse, run_id) AS folder_rank FROM children""",
          doubles="rmse r2 duration_ms")
def q_folder_ranks(spark, sf):
    return runs.folder_ranks(_children(spark, sf))


# ---------------------------------------------------------------- quotas ----
# a burst: time 32768 times as fast, all requests of three users;  a busy day: 96 times, four addresses
_BURST, _BUSY = (32768, 3, 20), (96, 200, 4)


@register("per_second_violations", "R8",
          sql=with_ctes("RECURSIVE " + fx.sql_busy(*_BURST), fx.SQL_USERS) + """,
limits AS (SELECT user_id, tier, per_second_limit FROM users JOIN (VALUES ('VIP', 50), ('PREMIUM', 10)) AS l(tier, per_second_limit) USING (tier)),
q AS (SELECT r.user_id, ts, row_number() OVER (PARTITION BY r.user_id ORDER BY ts, event_id) AS i
      FROM requests r JOIN limits USING (user_id)),
w AS (
  SELECT user_id, ts AS began, ts AS last_ts, i, 1 AS n FROM q WHERE i = 1
  UNION ALL
  SELECT q.user_id, CASE WHEN q.ts >= w.began + INTERVAL '1 second' THEN q.ts ELSE w.began END, q.ts, q.i,
         CASE WHEN q.ts >= w.began + INTERVAL '1 second' THEN 1 ELSE w.n + 1 END
  FROM w JOIN q ON q.user_id = w.user_id AND q.i = w.i + 1),
windows AS (SELECT user_id, began, max(i) - min(i) + 1 AS requests,
                   row_number() OVER () AS k FROM (
  SELECT *, sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS window_no FROM w)
  GROUP BY user_id, began, window_no)
SELECT user_id, began AS second, CAST(requests AS BIGINT) AS requests, tier, per_second_limit
FROM windows JOIN limits USING (user_id) WHERE requests > per_second_limit""")
def q_per_second(spark, sf):
    return quotas.per_second_violations(fx.busy_log(spark, sf, *_BURST), fx.users(spark, sf))


@register("free_daily_bans", "R9",
          sql=with_ctes(fx.sql_busy(*_BURST), fx.SQL_USERS) + f"""
SELECT user_id, min(ts) AS banned_at, min(day) AS ban_day FROM (
  SELECT user_id, ts, date_trunc('day', ts) AS day,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS n
  FROM requests WHERE user_id IN (SELECT user_id FROM users WHERE tier = 'FREE'))
WHERE n = {C.FREE_DAILY_CAP} GROUP BY user_id""")
def q_free_bans(spark, sf):
    return quotas.free_daily_bans(fx.busy_log(spark, sf, *_BURST), fx.users(spark, sf))


def _counter_sql(actions: str, success: str, limit: int, ttl: int) -> str:
    """The counter attempt by attempt: blocked is decided on what stands before the attempt."""
    return with_ctes("RECURSIVE " + fx.sql_busy(*_BUSY)) + f""",
a AS (SELECT ip AS key, ts, event_id, {success} AS ok, row_number() OVER (PARTITION BY ip ORDER BY ts, event_id) AS i
      FROM requests WHERE action IN ({actions})),
b AS (SELECT *, lag(ts) OVER (PARTITION BY key ORDER BY i) AS before FROM a),
e AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL '{ttl} seconds' THEN 1 ELSE 0 END)
                OVER (PARTITION BY key ORDER BY i) AS episode FROM b),
s AS (
  SELECT key, i, episode, ts, event_id, false AS blocked, CASE WHEN ok THEN 0 ELSE 1 END AS n,
         CASE WHEN ok THEN NULL ELSE ts + INTERVAL '{ttl} seconds' END AS expiry
  FROM e WHERE i = 1
  UNION ALL
  SELECT e.key, e.i, e.episode, e.ts, e.event_id, x.n0 >= {limit},
         CASE WHEN x.n0 >= {limit} THEN x.n0 WHEN e.ok THEN 0 ELSE x.n0 + 1 END,
         CASE WHEN x.n0 >= {limit} THEN x.expiry WHEN e.ok THEN NULL ELSE e.ts + INTERVAL '{ttl} seconds' END
  FROM (SELECT s.*, nxt.ts AS next_ts, CASE WHEN s.expiry IS NOT NULL AND nxt.ts > s.expiry THEN 0 ELSE s.n END AS n0
        FROM s JOIN e nxt ON nxt.key = s.key AND nxt.i = s.i + 1) x
  JOIN e ON e.key = x.key AND e.i = x.i + 1)
SELECT key, CAST(episode AS BIGINT) AS episode, ts, event_id, blocked, CAST(n AS INTEGER) AS count_after FROM s WHERE blocked"""


@register("login_locks", "R10",
          sql=_counter_sql("'error', 'signup'", "action = 'signup'", C.LOGIN_MAX_FAILURES, C.LOGIN_LOCK_SECONDS))
def q_login_locks(spark, sf):
    return quotas.login_locks(fx.busy_log(spark, sf, *_BUSY))


@register("registration_blocks", "R11",
          sql=_counter_sql("'signup'", "false", C.REGISTRATION_MAX_PER_IP, C.REGISTRATION_WINDOW_SECONDS))
def q_registration_blocks(spark, sf):
    return quotas.registration_blocks(fx.busy_log(spark, sf, *_BUSY))


@register("users_per_tier", "A24",
          sql=with_ctes(fx.SQL_USERS) + "SELECT tier, count(*) AS users FROM users GROUP BY tier")
def q_users_per_tier(spark, sf):
    return ops.users_per_tier(fx.users(spark, sf))


# ------------------------------------------------------------- misc ops ----
@register("route_purchase", "P16",
          sql="SELECT event_id, ts, user_id, event_type AS data_type, value FROM events WHERE event_type = 'purchase'")
def q_route(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", F.col("event_type").alias("data_type"),
                                          "value")
    return ops.route(e, "purchase")


_TICK_COLS = ("symbol price quantity volume_usd is_buyer_maker trade_side buy_wall_usd sell_wall_usd "
              "imbalance_ratio mark_price funding_rate liq_buy_usd liq_sell_usd").split()


@register("bronze_roundtrip", "P1 P2 F13",
          sql=with_ctes(fx.SQL_TICKS) + f"""
SELECT symbol AS kafka_key, ts AS ingest_time, {", ".join(_TICK_COLS[1:])}, ts FROM ticks""",
          doubles=" ".join(_TICK_COLS[1:]).replace("is_buyer_maker ", "").replace("trade_side ", ""))
def q_bronze(spark, sf):
    b = ops.bronze(ops.to_kafka_records(fx.ticks(spark, sf)))
    parsed = b.select("kafka_key", "ingest_time",
                      F.from_json("raw_payload", silver.TICK_SCHEMA).alias("v"))
    return parsed.select("kafka_key", "ingest_time", *[F.col(f"v.{c}").alias(c) for c in _TICK_COLS[1:]],
                         F.to_timestamp(F.col("v.timestamp")).cast("timestamp_ntz").alias("ts"))


@register("wallet_balances", "P19 F13",
          sql="""
SELECT * FROM (
  SELECT c_custkey AS account_id, 'USDT' AS asset, CAST(printf('%.2f', greatest(c_acctbal, 0)) AS DOUBLE) AS free,
         0.0 AS locked FROM customer
  UNION ALL
  SELECT c_custkey, 'BTC', 0.0, CAST(printf('%.2f', c_nationkey / 10.0) AS DOUBLE) FROM customer)
WHERE free > 0 OR locked > 0""", doubles="free locked")
def q_wallet(spark, sf):
    c = table(spark, sf, "customer")
    js = F.to_json(F.array(
        F.struct(F.lit("USDT").alias("asset"), F.format_string("%.2f", F.greatest("c_acctbal", F.lit(0.0))).alias("free"),
                 F.lit("0.00").alias("locked")),
        F.struct(F.lit("BTC").alias("asset"), F.lit("0.00").alias("free"),
                 F.format_string("%.2f", F.col("c_nationkey") / 10.0).alias("locked"))))
    return ops.nonzero_balances(c.select(F.col("c_custkey").alias("account_id"), js.alias("balances_json")))


@register("flow_tags", "P22 P23 F10",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + f"""
SELECT *,
  CASE WHEN abs(cvd) > {C.FLOW_WHALE_CVD} THEN 'WHALE' WHEN abs(cvd) < {C.FLOW_RETAIL_CVD} THEN 'RETAIL'
       ELSE 'INSTITUTIONAL' END AS flow_tag,
  CASE WHEN cvd > 0 AND imbalance_ratio > {C.FLOW_BULL_IMB} THEN 'BULL_AGGRESSIVE'
       WHEN cvd < 0 AND imbalance_ratio < {C.FLOW_BEAR_IMB} THEN 'BEAR_PRESSURE' ELSE 'ACCUMULATION' END AS flow_trend,
  least(greatest(50.0 + imbalance_ratio * 50, {C.SENTIMENT_MIN}), {C.SENTIMENT_MAX}) AS bull_pct
FROM win""", doubles="average_price volatility volume_usd cvd vpin_score wall_imbalance buy_wall_usd sell_wall_usd "
                     "imbalance_ratio mark_price funding_rate liq_buy_usd liq_sell_usd bull_pct")
def q_flow_tags(spark, sf):
    return ops.sentiment(ops.flow_tags(silver.window_metrics(fx.ticks(spark, sf))))


@register("dashboard_signals", "P24 P25",
          sql=SQL_LIVE_WINDOWS + f"""
SELECT *,
  CASE WHEN predicted_price > average_price THEN 'BUY' ELSE 'SELL' END AS model_signal,
  CASE WHEN "RSI" > {C.RSI_OVERBOUGHT} THEN 'OVERBOUGHT' WHEN "RSI" < {C.RSI_OVERSOLD} THEN 'OVERSOLD'
       ELSE 'NEUTRAL' END AS rsi_state,
  CASE WHEN vpin_score > {C.VPIN_FLOW_RISK} THEN 'TOXIC' ELSE 'CLEAN' END AS vpin_state,
  CASE WHEN cvd > 0 THEN 'BUY_PRESSURE' ELSE 'SELL_PRESSURE' END AS cvd_state,
  CASE WHEN "Bollinger_Upper" - average_price < average_price - "Bollinger_Lower" THEN 'NEAR_UPPER'
       ELSE 'NEAR_LOWER' END AS band_side
FROM live""", doubles="average_price predicted_price volume_usd volatility cvd vpin_score SMA_20 Std_Dev EMA12 EMA26 RSI "
                      "MACD Signal_Line Bollinger_Upper Bollinger_Lower")
def q_dashboard_signals(spark, sf):
    return ops.dashboard_signals(live_windows(spark, sf))


@register("trend_flags", "P26",
          sql=SQL_HISTORY + """
SELECT symbol, "timestamp", close, "MA99", CASE WHEN close > "MA99" THEN 'BULL' ELSE 'BEAR' END AS trend,
       CASE WHEN close >= open THEN 'UP' ELSE 'DOWN' END AS bar FROM hist_clean""", doubles="close MA99", digits=4)
def q_trend_flags(spark, sf):
    return ops.trend_flags(indicators.history_indicators(fx.daily_bars(spark, sf)))


@register("change_rating", "P27",
          sql=with_ctes(fx.SQL_BARS) + f"""
SELECT symbol, "timestamp", (close - open) / open * 100 AS change_pct,
       CASE WHEN (close - open) / open * 100 > {C.CHANGE_STRONG} THEN 'STRONG_BUY'
            WHEN (close - open) / open * 100 > 0 THEN 'BUY'
            WHEN (close - open) / open * 100 < -{C.CHANGE_STRONG} THEN 'STRONG_SELL'
            WHEN (close - open) / open * 100 < 0 THEN 'SELL' ELSE 'NEUTRAL' END AS rating
FROM bars""", doubles="change_pct")
def q_change_rating(spark, sf):
    b = fx.daily_bars(spark, sf)
    return ops.change_rating(b.select("symbol", "timestamp",
                                      ((F.col("close") - F.col("open")) / F.col("open") * 100).alias("change_pct")))


@register("prediction_delta", "P29 T1",
          sql=with_ctes(fx.SQL_TICKS) + """
SELECT symbol, ts AS processed_time, price AS average_price, mark_price AS predicted_price,
       mark_price - price AS delta
FROM ticks WHERE symbol = 'click' ORDER BY ts DESC, event_id DESC LIMIT 100""",
          doubles="average_price predicted_price delta")
def q_prediction_delta(spark, sf):
    m = market_rows(spark, sf).filter(F.col("symbol") == "click")
    return (m.orderBy(F.col("processed_time").desc(), F.col("event_id").desc()).limit(100)
            .select("symbol", "processed_time", "average_price", "predicted_price",
                    (F.col("predicted_price") - F.col("average_price")).alias("delta")))


@register("newest_rows", "S7 T1",
          sql=with_ctes(fx.SQL_TICKS) + """
SELECT symbol, price AS average_price, ts AS processed_time, event_id FROM ticks
ORDER BY ts DESC, event_id DESC LIMIT 1000""", doubles="average_price")
def q_newest(spark, sf):
    m = market_rows(spark, sf)
    return (m.orderBy(F.col("processed_time").desc(), F.col("event_id").desc()).limit(1000)
            .select("symbol", "average_price", "processed_time", "event_id"))


@register("symbols_sorted", "A17",
          sql=with_ctes(fx.SQL_TICKS) + "SELECT DISTINCT symbol FROM ticks ORDER BY symbol")
def q_symbols(spark, sf):
    return fx.ticks(spark, sf).select("symbol").distinct().orderBy("symbol")


@register("distinct_rows", "A16 P6",
          sql="SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL")
def q_distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").dropna().distinct()


@register("symbols_trainable", "A18",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + f"""
SELECT symbol, count(*) AS "rows" FROM win GROUP BY symbol HAVING count(*) > {C.MIN_ROWS_PER_SYMBOL}""")
def q_symbols_trainable(spark, sf):
    return ops.rows_per_symbol(silver.window_metrics(fx.ticks(spark, sf)))


@register("trainable_rows", "J10",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + f"""
SELECT window_start, symbol, average_price FROM win
WHERE symbol IN (SELECT symbol FROM win GROUP BY symbol HAVING count(*) > {C.MIN_ROWS_PER_SYMBOL})""",
          doubles="average_price")
def q_trainable_rows(spark, sf):
    w = silver.window_metrics(fx.ticks(spark, sf)).select("window_start", "symbol", "average_price")
    return ops.trainable_rows(w)


@register("training_readiness", "A19",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + f"""
SELECT count(*) AS total_rows, count(*) >= {C.MIN_ROWS_PER_SYMBOL} AS ready FROM win""")
def q_readiness(spark, sf):
    return ops.training_readiness(silver.window_metrics(fx.ticks(spark, sf)))


@register("daily_digest", "A26",
          sql=with_ctes(fx.SQL_TICKS, SQL_SILVER, fx.SQL_RUNS, fx.SQL_QUOTES) + f""",
day_prices AS (SELECT day, symbol, venue, arg_max(price, (quote_id, price)) AS price FROM quotes GROUP BY ALL),
day_spreads AS (
  SELECT day, symbol, {spark_round_sql("(max(price) - min(price)) / min(price) * 100", 4)} AS spread_pct,
         arg_min(venue, (price, venue)) AS best_buy, arg_max(venue, (price, venue)) AS best_sell
  FROM day_prices GROUP BY ALL HAVING count(*) >= 2),
spreads AS (
  SELECT day, symbol AS best_arbitrage, spread_pct AS best_spread_pct, best_buy, best_sell FROM (
    SELECT *, row_number() OVER (PARTITION BY day ORDER BY spread_pct DESC, symbol) AS k FROM day_spreads) WHERE k = 1),
parents AS (SELECT run_id AS parent_run_id, symbol AS coin_folder FROM runs WHERE parent_run_id IS NULL),
children AS (
  SELECT r.run_id, coalesce(TRY_CAST(r.rmse AS DOUBLE), 9999.0) AS rmse, coalesce(TRY_CAST(r.r2 AS DOUBLE), 0.0) AS r2,
         upper(replace(r.run_name, '_', ' ')) AS model_name, r.start_time
  FROM runs r JOIN parents p USING (parent_run_id)),
per_sym AS (
  SELECT date_trunc('day', window_start) AS day, symbol, count(*) AS n,
         count(*) FILTER (WHERE vpin_score > {C.VPIN_FLOW_RISK} OR anomaly_wash_trading OR anomaly_spoofing) AS sig,
         count(*) FILTER (WHERE buy_wall_usd > sell_wall_usd * {C.WHALE_WALL_RATIO}
                             OR sell_wall_usd > buy_wall_usd * {C.WHALE_WALL_RATIO}) AS whale
  FROM silver GROUP BY 1, 2),
market AS (SELECT day, CAST(sum(sig) AS BIGINT) AS total_signals, CAST(sum(whale) AS BIGINT) AS whale_events,
                  arg_min(symbol, (-n, symbol)) AS top_symbol FROM per_sym GROUP BY day),
models AS (SELECT date_trunc('day', start_time) AS day, count(*) AS ml_update_count,
                  arg_min(model_name, (rmse, run_id)) AS champion_model, arg_min(r2, (rmse, run_id)) AS champion_r2
           FROM children GROUP BY 1)
SELECT day, coalesce(total_signals, 0) AS total_signals, coalesce(whale_events, 0) AS whale_events, top_symbol,
       coalesce(ml_update_count, 0) AS ml_update_count, champion_model, champion_r2,
       best_arbitrage, best_spread_pct, best_buy, best_sell
FROM market FULL OUTER JOIN models USING (day) FULL OUTER JOIN spreads USING (day)""", doubles="champion_r2 best_spread_pct")
def q_daily_digest(spark, sf):
    return ops.daily_digest(silver.silver(fx.ticks(spark, sf)), _children(spark, sf),
                            derivatives.daily_best_spread(fx.venue_quotes(spark, sf)))


# -------------------------------------------------------------------- ML ----
@register("prediction_metrics", "A27",
          sql=with_ctes(fx.SQL_TICKS) + """
SELECT symbol, count(*) AS n, sqrt(sum((price - mark_price) * (price - mark_price)) / count(*)) AS rmse,
       1.0 - avg((price - mark_price) * (price - mark_price)) / var_pop(price) AS r2
FROM ticks GROUP BY symbol""", doubles="rmse r2", digits=4)
def q_prediction_metrics(spark, sf):
    from quantsilo.operators import ml
    return ml.regression_metrics(fx.ticks(spark, sf), ["symbol"], label="price", prediction="mark_price")


@register("model_league", "M4 M6 J10 A18 A19")
def q_model_league(spark, sf):
    """Train the league on the silver features of every trainable symbol; the run table (M6)."""
    from quantsilo.operators import ml
    ready = ops.trainable_rows(silver.window_metrics(fx.ticks(spark, sf)))
    feats = indicators.chronological_split(indicators.training_features(ready, order="window_start", keep=True))
    symbols = sorted(r.symbol for r in ready.select("symbol").distinct().collect())   # the gate's small symbol list
    runs_df, _ = ml.train_league(feats, symbols)
    return runs_df


#: Features of the scoring models, few enough for their normal equations to be said in SQL.
_SCORING = ["average_price", "momentum"]


@register("batch_scoring", "M5",
          sql=with_ctes(fx.SQL_TICKS, SQL_FEATURES) + """,
m AS (
  SELECT symbol, avg(target_price) AS my, avg(average_price) AS m1, avg(momentum) AS m2,
         covar_pop(average_price, average_price) AS c11, covar_pop(momentum, momentum) AS c22,
         covar_pop(average_price, momentum) AS c12, covar_pop(average_price, target_price) AS c1y,
         covar_pop(momentum, target_price) AS c2y
  FROM (SELECT * FROM feat WHERE average_price IS NOT NULL AND momentum IS NOT NULL AND target_price IS NOT NULL)
  WHERE symbol <> 'error' GROUP BY symbol HAVING count(*) > 20),
b AS (SELECT *, (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS b1,
             (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) AS b2 FROM m)
SELECT f.symbol, f.window_start, f.average_price, f.momentum,
       """ + spark_round_sql("coalesce(my - b1 * m1 - b2 * m2 + b1 * f.average_price + b2 * f.momentum, f.average_price)", 5) + """
         AS predicted_price
FROM feat f LEFT JOIN b USING (symbol)""", doubles="average_price momentum predicted_price", digits=4)
def q_batch_scoring(spark, sf):
    """Every window scored by its symbol's model; 'error' has none, and the first windows of a symbol no momentum."""
    from quantsilo.operators import ml
    w = silver.window_metrics(fx.ticks(spark, sf))
    rows = indicators.training_features(w, order="window_start", complete=False)
    models = ml.fit_linear(rows.filter(F.col("symbol") != "error"), _SCORING)
    return ml.score_linear(rows, models, _SCORING).select("symbol", "window_start", *_SCORING, "predicted_price")


# ----------------------------------------------------- exports / panels ----
@register("recent_export_premium", "P18",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS) + """
SELECT symbol, average_price AS price, volume_usd, cvd, vpin_score AS vpin FROM win
WHERE processed_time >= (SELECT max(processed_time) FROM win) - INTERVAL 12 HOURS""",
          doubles="price volume_usd cvd vpin")
def q_recent_export(spark, sf):
    from quantsilo.sources import io
    return io.recent_export(silver.window_metrics(fx.ticks(spark, sf)), "PREMIUM")


@register("recent_export_tiers", "P18",
          sql=with_ctes(fx.SQL_TICKS, SQL_WINDOWS, fx.SQL_USERS) + """
SELECT t.tier, symbol, average_price AS price, volume_usd, cvd, vpin_score AS vpin
FROM win, (SELECT DISTINCT tier FROM users) t JOIN (VALUES ('PREMIUM', 12), ('VIP', 24)) AS l(tier, hours) USING (tier)
WHERE processed_time >= (SELECT max(processed_time) FROM win) - to_hours(hours)""",
          doubles="price volume_usd cvd vpin")
def q_recent_export_tiers(spark, sf):
    from quantsilo.sources import io
    return io.recent_export_by_tier(silver.window_metrics(fx.ticks(spark, sf)), fx.users(spark, sf))


@register("newest_buckets", "T6 A6",
          sql=with_ctes(fx.SQL_TICKS) + """
SELECT row_number() OVER (ORDER BY minute DESC, symbol) AS position, * FROM (
  SELECT symbol, date_trunc('minute', ts) AS minute, avg(price) AS avg_price, max(price) AS max_price,
         min(price) AS min_price, count(*) AS trade_count FROM ticks GROUP BY 1, 2)""",
          doubles="avg_price max_price min_price")
def q_newest_buckets(spark, sf):
    return gold.newest_first(gold.minute_summary(market_rows(spark, sf)))


@register("free_panel", "A29",
          sql=with_ctes(fx.SQL_TICKS) + """,
now_t AS (SELECT max(ts) AS now_ts FROM ticks)
SELECT t.symbol,
       avg(price) FILTER (WHERE ts > now_ts - INTERVAL 24 HOURS) AS avg_p,
       max(price) FILTER (WHERE ts > now_ts - INTERVAL 24 HOURS) AS max_p,
       min(price) FILTER (WHERE ts > now_ts - INTERVAL 24 HOURS) AS min_p,
       arg_max(price, (ts, event_id)) FILTER (WHERE ts <= now_ts - INTERVAL 1 MINUTE) AS delayed_price
FROM ticks t, now_t GROUP BY t.symbol""", doubles="avg_p max_p min_p delayed_price")
def q_free_panel(spark, sf):
    return ops.free_panel(fx.ticks(spark, sf))


def _vendor_frame(bars_df, keep):
    """Bars of the symbols with an odd (or even) first digit as a vendor delivers them."""
    odd = F.substring("symbol", 1, 1).cast("int") % 2 == 1
    b = bars_df.filter(odd if keep == "odd" else ~odd)
    return b.select(
        F.col("timestamp").alias("Date"), F.concat(F.lit("C"), F.substring("symbol", 1, 1), F.lit("-USD")).alias("ticker"),
        *[F.col(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")])


@register("bar_union", "U1 F3 F4",
          sql=with_ctes(fx.SQL_BARS) + """
SELECT "timestamp", regexp_replace('C' || substr(symbol, 1, 1) || '-USD', '-USD$', 'USDT') AS symbol,
       open, high, low, close, CASE WHEN CAST(substr(symbol, 1, 1) AS INTEGER) % 2 = 1 THEN volume END AS volume,
       year("timestamp") AS year,
       CASE WHEN CAST(substr(symbol, 1, 1) AS INTEGER) % 2 = 0 THEN close * 0.5 END AS adjusted FROM bars""",
          doubles="open high low close volume adjusted")
def q_bar_union(spark, sf):
    from quantsilo.operators import bars
    b = fx.daily_bars(spark, sf)
    # one vendor sends no adjusted close, the other no volume
    one = bars.normalize_bars(_vendor_frame(b, "odd"))
    two = bars.normalize_bars(_vendor_frame(b, "even")).withColumn("adjusted", F.col("close") * 0.5).drop("volume")
    return bars.union_bars([one, two]).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


_TR_HEADERS = ["Müşteri No", "Adı Soyadı", "Ülke Kodu", "Bakiye (₺)", "Sektör"]


@register("clean_headers", "P7",
          sql="""
SELECT c_custkey AS "musteri_no", c_name AS "adi_soyadi", c_nationkey AS "ulke_kodu", c_acctbal AS "bakiye____",
       lower(regexp_replace(translate(trim(c_mktsegment), 'ığüşöçİĞÜŞÖÇ', 'igusocIGUSOC'), '[^a-zA-Z0-9]', '_', 'g'))
         AS "sektor"
FROM customer""", doubles="bakiye____")
def q_clean_headers(spark, sf):
    from quantsilo.sources import io
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    raw = c.toDF(*_TR_HEADERS)                      # an upload with local-language headers
    clean = raw.toDF(*[io.clean_name(h) for h in raw.columns])
    return clean.withColumn("sektor", io.clean_values("sektor"))


@register("adhoc_sql", "S21 S22",
          sql=with_ctes(fx.SQL_TICKS) + """
SELECT symbol, count(*) AS trades, sum(volume_usd) AS notional FROM ticks GROUP BY symbol""",
          doubles="notional")
def q_adhoc_sql(spark, sf):
    from quantsilo.sources import io
    io.materialize(fx.ticks(spark, sf), "qs_ticks")                         # S21: view
    return io.run_sql(spark, "SELECT symbol, count(*) AS trades, sum(volume_usd) AS notional "
                             "FROM qs_ticks GROUP BY symbol")               # S22
