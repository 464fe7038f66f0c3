"""Market-shaped inputs derived from the driver tables.

The reference consumes exchange ticks, order books, option quotes, venue
prices, alarms, request logs and model runs.  The test data holds TPC-H-like
tables and an ``events`` stream instead, so each input below is a
deterministic projection of a driver table (see FIXTURES.md section C).
Every projection is a narrow ``select`` over one table: no shuffle, columns
pruned at the scan, and it grows linearly with the data.

Each view has a twin SQL common-table expression (``SQL_*``) used by the
DuckDB oracle, so both engines start from identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo.sources.tables import table


def _qty() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


# ---------------------------------------------------------------- ticks ----
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat trade ticks (the 14-field silver input) from ``events``.

    symbol = event_type, price = value, quantity = props.k, side by id parity,
    walls, mark, funding and liquidations by fixed id moduli.
    """
    e = table(spark, sf_dir, "events")
    eid, price, qty = F.col("event_id"), F.col("value"), _qty()
    buy = price * (F.lit(1) + eid % 7)
    sell = price * (F.lit(1) + eid % 5)
    total = buy + sell
    maker = (eid % 2) == 1
    return e.select(
        F.col("event_type").alias("symbol"),
        price.alias("price"),
        qty.alias("quantity"),
        (price * qty).alias("volume_usd"),
        maker.alias("is_buyer_maker"),
        F.when(maker, "SELL").otherwise("BUY").alias("trade_side"),
        buy.alias("buy_wall_usd"),
        sell.alias("sell_wall_usd"),
        F.when(total > 0, (buy - sell) / total).otherwise(F.lit(0.0)).alias("imbalance_ratio"),
        (price * (F.lit(1) + (eid % 11 - 5) / 10000.0)).alias("mark_price"),
        ((eid % 13 - 6) / 10000.0).alias("funding_rate"),
        F.when(eid % 17 == 0, price * qty).otherwise(F.lit(0.0)).alias("liq_buy_usd"),
        F.when(eid % 19 == 0, price * qty).otherwise(F.lit(0.0)).alias("liq_sell_usd"),
        F.col("ts"),
        eid.alias("event_id"),
    )


SQL_TICKS = """ticks AS (
  SELECT event_type AS symbol,
         value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume_usd,
         event_id % 2 = 1 AS is_buyer_maker,
         CASE WHEN event_id % 2 = 1 THEN 'SELL' ELSE 'BUY' END AS trade_side,
         value * (1 + event_id % 7) AS buy_wall_usd,
         value * (1 + event_id % 5) AS sell_wall_usd,
         CASE WHEN value * (1 + event_id % 7) + value * (1 + event_id % 5) > 0
              THEN (value * (1 + event_id % 7) - value * (1 + event_id % 5))
                   / (value * (1 + event_id % 7) + value * (1 + event_id % 5))
              ELSE 0.0 END AS imbalance_ratio,
         value * (1 + (event_id % 11 - 5) / 10000.0) AS mark_price,
         (event_id % 13 - 6) / 10000.0 AS funding_rate,
         CASE WHEN event_id % 17 = 0 THEN value * CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 0.0 END AS liq_buy_usd,
         CASE WHEN event_id % 19 = 0 THEN value * CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 0.0 END AS liq_sell_usd,
         ts,
         event_id
  FROM events)"""


# ------------------------------------------------------ exchange messages ----
def exchange_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw exchange messages (trade / depth / mark / liquidation) from ``events``.

    kind by event_type: view -> depth, signup -> mark, error -> liquidation,
    the rest -> trade.  symbol = 'S' || user_id % 8.  ``kind_rank`` orders
    book-type messages before a trade at the same instant.
    """
    e = table(spark, sf_dir, "events")
    eid, v, qty = F.col("event_id"), F.col("value"), _qty()
    kind = (F.when(F.col("event_type") == "view", "depth")
            .when(F.col("event_type") == "signup", "mark")
            .when(F.col("event_type") == "error", "liquidation")
            .otherwise("trade"))
    return e.select(
        F.concat(F.lit("s"), (F.col("user_id") % 8).cast("string")).alias("raw_symbol"),
        kind.alias("kind"),
        F.when(kind == "trade", 1).otherwise(0).alias("kind_rank"),
        F.col("ts"),
        eid.alias("event_id"),
        v.cast("string").alias("p"),
        qty.cast("string").alias("q"),
        ((eid % 2) == 1).alias("m"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("T"),
        (v * (F.lit(1) + eid % 7)).alias("bid_wall"),
        (v * (F.lit(1) + eid % 5)).alias("ask_wall"),
        ((eid % 13 - 6) / 10000.0).alias("r"),
        F.when(eid % 2 == 0, "SELL").otherwise("BUY").alias("liq_side"),
    )


SQL_MESSAGES = """messages AS (
  SELECT 's' || CAST(user_id % 8 AS VARCHAR) AS raw_symbol,
         CASE event_type WHEN 'view' THEN 'depth' WHEN 'signup' THEN 'mark'
                         WHEN 'error' THEN 'liquidation' ELSE 'trade' END AS kind,
         CASE WHEN event_type IN ('view', 'signup', 'error') THEN 0 ELSE 1 END AS kind_rank,
         ts,
         event_id,
         value AS p_num,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS q_num,
         event_id % 2 = 1 AS m,
         epoch_us(ts) // 1000 AS T,
         value * (1 + event_id % 7) AS bid_wall,
         value * (1 + event_id % 5) AS ask_wall,
         (event_id % 13 - 6) / 10000.0 AS r,
         CASE WHEN event_id % 2 = 0 THEN 'SELL' ELSE 'BUY' END AS liq_side
  FROM events)"""


# ------------------------------------------------------------ order books ----
def depth_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth snapshots: one book per l_orderkey, open lines are bids, filled lines asks.

    Levels are ``[price, qty]`` string pairs as the exchange sends them.
    Shuffle on l_orderkey with a handful of lines per key: no hot group.
    """
    li = table(spark, sf_dir, "lineitem")
    level = F.array((F.col("l_extendedprice") / F.col("l_quantity")).cast("string"),
                    F.col("l_quantity").cast("string"))
    return (li.groupBy(F.col("l_orderkey").alias("book_id"))
            .agg(F.coalesce(F.collect_list(F.when(F.col("l_linestatus") == "O", level)),
                            F.array()).alias("bids"),
                 F.coalesce(F.collect_list(F.when(F.col("l_linestatus") == "F", level)),
                            F.array()).alias("asks")))


# ------------------------------------------------------------------- bars ----
def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars: symbol = o_orderpriority, one bar per order date."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("timestamp"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


SQL_BARS = """bars AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS "timestamp",
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""


# ----------------------------------------------------------- venue quotes ----
def venue_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, venue, price, quote_id): symbol = part, venue = supplier, unit price.

    ``quote_id`` (order key, line number) orders quotes of the same venue.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.concat(F.lit("V"), F.col("l_suppkey").cast("string")).alias("venue"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("quote_id"),
        F.date_trunc("day", "l_shipdate").alias("day"),
    )


SQL_QUOTES = """quotes AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS symbol,
         'V' || CAST(l_suppkey AS VARCHAR) AS venue,
         l_extendedprice / l_quantity AS price,
         l_orderkey * 1000 + l_linenumber AS quote_id, date_trunc('day', l_shipdate) AS day
  FROM lineitem)"""


# ---------------------------------------------------------------- options ----
def option_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw option book summaries: (instrument_name, open_interest) from ``part``.

    coin = p_brand, strike = p_retailprice, type C for even p_size else P, oi = p_size.
    """
    p = table(spark, sf_dir, "part")
    typ = F.when(F.col("p_size") % 2 == 0, "C").otherwise("P")
    return p.select(
        F.concat_ws("-", F.col("p_brand"), F.lit("27DEC24"),
                    F.col("p_retailprice").cast("string"), typ).alias("instrument_name"),
        F.col("p_size").cast("double").alias("open_interest"),
    )


SQL_OPTIONS = """options AS (
  SELECT p_brand AS coin, p_retailprice AS strike,
         CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END AS type,
         CAST(p_size AS DOUBLE) AS oi
  FROM part WHERE p_size > 0)"""


# ----------------------------------------------------------------- supply ----
def coin_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circulating supply per symbol 'S<n>' for even nation keys (odd ones are unknown)."""
    n = table(spark, sf_dir, "nation")
    return (n.filter(F.col("n_nationkey") % 2 == 0)
            .select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("symbol"),
                    ((F.col("n_nationkey") + 1) * 1000000.0).alias("supply")))


SQL_SUPPLY = """supply AS (
  SELECT 'S' || CAST(n_nationkey AS VARCHAR) AS symbol, (n_nationkey + 1) * 1000000.0 AS supply
  FROM nation WHERE n_nationkey % 2 = 0)"""


# ----------------------------------------------------------------- alarms ----
_ALARM_SYMBOL = ("click", "error", "purchase", "signup", "view")


def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price alarms: one per customer row, owned by user c_custkey % 97 (so users hold many),
    symbol by nation, target from balance, direction by key parity."""
    c = table(spark, sf_dir, "customer")
    sym = F.element_at(F.array(*[F.lit(s) for s in _ALARM_SYMBOL]),
                       (F.col("c_nationkey") % 5 + 1).cast("int"))
    return c.select(
        F.col("c_custkey").alias("alarm_id"),
        (F.col("c_custkey") % 97).alias("user_id"),
        sym.alias("symbol"),
        F.round(F.abs(F.col("c_acctbal")) / 20.0, 2).alias("target"),
        F.when(F.col("c_custkey") % 2 == 0, "up").otherwise("down").alias("direction"),
        F.timestamp_add("DAY", (F.col("c_custkey") % 45).cast("int"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("created_at"),
    )


SQL_ALARMS = """alarms AS (
  SELECT c_custkey AS alarm_id, c_custkey % 97 AS user_id,
         CASE c_nationkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                              WHEN 3 THEN 'signup' ELSE 'view' END AS symbol,
         CAST(round(CAST(CAST(abs(c_acctbal) / 20.0 AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS target,
         CASE WHEN c_custkey % 2 = 0 THEN 'up' ELSE 'down' END AS direction,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 45 AS INTEGER)) AS created_at
  FROM customer)"""


# ------------------------------------------------------------------ users ----
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension: tier by key modulo 3 (VIP, PREMIUM, FREE)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    tier = F.when(k % 3 == 0, "VIP").when(k % 3 == 1, "PREMIUM").otherwise("FREE")
    return c.select(k.alias("user_id"), F.col("c_name").alias("username"), tier.alias("tier"))


SQL_USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS username,
         CASE c_custkey % 3 WHEN 0 THEN 'VIP' WHEN 1 THEN 'PREMIUM' ELSE 'FREE' END AS tier
  FROM customer)"""


# ------------------------------------------------------------ request log ----
def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API request log: every event is a request; 'error' a failed login, 'signup' a success."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id"), F.col("ts"), F.col("event_id"),
        F.col("event_type").alias("action"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 20).cast("string")).alias("ip"),
    )


SQL_REQUESTS = """requests AS (
  SELECT user_id, ts, event_id, event_type AS action,
         '10.0.0.' || CAST(user_id % 20 AS VARCHAR) AS ip
  FROM events)"""


def busy_log(spark: SparkSession, sf_dir: str, squeeze: int, users: int, ips: int) -> DataFrame:
    """The request log of a busy day: time runs ``squeeze`` times as fast, over few users and addresses."""
    start = F.lit("2024-01-01").cast("timestamp")
    e = table(spark, sf_dir, "events")
    t = F.unix_micros(start) + F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)) / squeeze)
    return e.select(
        (F.col("user_id") % users + 1).alias("user_id"), F.timestamp_micros(t.cast("long")).cast("timestamp_ntz").alias("ts"),
        "event_id", F.col("event_type").alias("action"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % ips).cast("string")).alias("ip"))


def sql_busy(squeeze: int, users: int, ips: int) -> str:
    return f"""requests AS (
  SELECT user_id % {users} + 1 AS user_id,
         make_timestamp(CAST(epoch_us(TIMESTAMP '2024-01-01') + floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / {squeeze}) AS BIGINT)) AS ts,
         event_id, event_type AS action, '10.0.0.' || CAST(user_id % {ips} AS VARCHAR) AS ip
  FROM events)"""


# ------------------------------------------------------------- model runs ----
_RUN_NAMES = ("Deep_Forest", "Quick_Forest", "Plain_Line")


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking-server run table: a parent run per nation, a child run per supplier.

    Metrics arrive as strings (some unparsable, some missing); children whose
    supplier key is a multiple of 9 point at a parent that does not exist.
    """
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    parents = n.select(
        F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.concat(F.lit("COIN_"), F.col("n_name")).alias("run_name"),
        F.col("n_name").alias("symbol"),
        F.lit(None).cast("string").alias("rmse"),
        F.lit(None).cast("string").alias("r2"),
        base.alias("start_time"),
        base.alias("end_time"),
    )
    k = F.col("s_suppkey")
    start = F.timestamp_add("MINUTE", k.cast("int"), base)
    name = F.element_at(F.array(*[F.lit(x) for x in _RUN_NAMES]), (k % 3 + 1).cast("int"))
    parent = F.when(k % 9 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey"))
    children = s.select(
        F.concat(F.lit("c"), k.cast("string")).alias("run_id"),
        F.concat(F.lit("p"), parent.cast("string")).alias("parent_run_id"),
        name.alias("run_name"),
        F.lit(None).cast("string").alias("symbol"),
        F.when(k % 11 == 0, F.lit(None))
         .when(k % 13 == 0, F.lit("n/a"))
         .otherwise(F.concat((k % 50).cast("string"), F.lit("."),
                             F.lpad((k * 104729 % 10000).cast("string"), 4, "0"))).alias("rmse"),
        F.concat(F.lit("0."), F.lpad((k * 7919 % 1000000).cast("string"), 6, "0")).alias("r2"),
        start.alias("start_time"),
        F.timestamp_add("MILLISECOND", (k % 97 * 1000 + 250).cast("int"), start).alias("end_time"),
    )
    return parents.unionByName(children)


SQL_RUNS = """runs AS (
  SELECT 'p' || CAST(n_nationkey AS VARCHAR) AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id,
         'COIN_' || n_name AS run_name, n_name AS symbol,
         CAST(NULL AS VARCHAR) AS rmse, CAST(NULL AS VARCHAR) AS r2,
         TIMESTAMP '2024-01-01 00:00:00' AS start_time, TIMESTAMP '2024-01-01 00:00:00' AS end_time
  FROM nation
  UNION ALL
  SELECT 'c' || CAST(s_suppkey AS VARCHAR),
         'p' || CAST(CASE WHEN s_suppkey % 9 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS VARCHAR),
         CASE s_suppkey % 3 WHEN 0 THEN 'Deep_Forest' WHEN 1 THEN 'Quick_Forest' ELSE 'Plain_Line' END,
         CAST(NULL AS VARCHAR),
         CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 13 = 0 THEN 'n/a'
              ELSE CAST(s_suppkey % 50 AS VARCHAR) || '.' || lpad(CAST(s_suppkey * 104729 % 10000 AS VARCHAR), 4, '0') END,
         '0.' || lpad(CAST(s_suppkey * 7919 % 1000000 AS VARCHAR), 6, '0'),
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(s_suppkey AS INTEGER)),
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(s_suppkey AS INTEGER))
           + to_milliseconds(CAST(s_suppkey % 97 * 1000 + 250 AS BIGINT))
  FROM supplier)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
