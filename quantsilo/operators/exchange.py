"""Exchange messages -> enriched trade ticks.

The reference keeps per-symbol state in one process (last book, last mark,
liquidations since the previous trade) and stamps it on every trade.  Here
the same semantics are two as-of operations over the message log:

* J1: last depth / mark message at or before each trade (``fill_forward``),
* J2: each liquidation belongs to the next trade of its symbol
  (``fill_backward`` of the trade id), then sums per trade.

Order is (ts, kind_rank, event_id): book-type messages precede a trade at
the same instant.  Both as-of steps run per (symbol, day) with a
day-summary carry, so a hot symbol never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import millis_to_time
from quantsilo.plans import ordered

ORDER = ["ts", "kind_rank", "event_id"]


def normalize_trades(trades: DataFrame, *extra) -> DataFrame:
    """P10: raw aggTrade fields -> price, quantity, notional, side, trade time (+ ``extra`` columns)."""
    price, qty = F.col("p").cast("double"), F.col("q").cast("double")
    return trades.select(
        F.upper("raw_symbol").alias("symbol"), price.alias("price"), qty.alias("quantity"),
        (price * qty).alias("volume_usd"), F.col("m").alias("is_buyer_maker"),
        F.when(F.col("m"), "SELL").otherwise("BUY").alias("trade_side"),
        millis_to_time("T").alias("timestamp"), "ts", "event_id", *extra)


def liquidation_notional(liqs: DataFrame) -> DataFrame:
    """Forced-order notional; a SELL liquidation is counted as liq_buy, otherwise liq_sell."""
    usd = F.col("p").cast("double") * F.col("q").cast("double")
    return liqs.select("*", F.when(F.col("liq_side") == "SELL", usd).otherwise(F.lit(0.0)).alias("liq_buy"),
                       F.when(F.col("liq_side") == "SELL", F.lit(0.0)).otherwise(usd).alias("liq_sell"))


def wall_imbalance(buy: Column, sell: Column) -> Column:
    """(b - s) / (b + s), 0 when the book is empty."""
    total = buy + sell
    return F.when(total > 0, (buy - sell) / total).otherwise(F.lit(0.0))


def enrich_trades(messages: DataFrame, block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """J1 + J2 + P10 + P12 + P13: the producer's 16-field trade tick from the message log."""
    kind = F.col("kind")
    m = (messages.withColumn("symbol", F.upper("raw_symbol"))
         .withColumn("bw", F.when(kind == "depth", F.col("bid_wall")))
         .withColumn("aw", F.when(kind == "depth", F.col("ask_wall")))
         .withColumn("mp", F.when(kind == "mark", F.col("p").cast("double")))
         .withColumn("fr", F.when(kind == "mark", F.col("r")))
         .withColumn("next_trade", F.when(kind == "trade", F.col("event_id"))))
    m = ordered.arrange(m, ["symbol"], ORDER, block_rows)
    m = ordered.fill(m, forward=["bw", "aw", "mp", "fr"], backward=["next_trade"])      # J1, J2
    liq = (liquidation_notional(m.filter((kind == "liquidation") & F.col("next_trade").isNotNull()))
           .groupBy("symbol", F.col("next_trade").alias("event_id"))
           .agg(F.sum("liq_buy").alias("liq_buy_usd"), F.sum("liq_sell").alias("liq_sell_usd")))
    base = normalize_trades(m.filter(kind == "trade"),
                            F.coalesce("bw", F.lit(0.0)).alias("buy_wall_usd"),
                            F.coalesce("aw", F.lit(0.0)).alias("sell_wall_usd"),
                            F.coalesce("mp", F.lit(0.0)).alias("mark_price"),
                            F.coalesce("fr", F.lit(0.0)).alias("funding_rate"))
    out = base.join(liq, ["symbol", "event_id"], "left").na.fill(0.0, ["liq_buy_usd", "liq_sell_usd"])
    return out.select(
        "symbol", "price", "quantity", "volume_usd", "is_buyer_maker", "trade_side",
        "buy_wall_usd", "sell_wall_usd",
        wall_imbalance(F.col("buy_wall_usd"), F.col("sell_wall_usd")).alias("imbalance_ratio"),
        "mark_price", "funding_rate", "liq_buy_usd", "liq_sell_usd", "timestamp", "ts", "event_id")


def _level_sum(levels: str) -> Column:
    """Sum of price * qty over ``[price, qty]`` string pairs."""
    notional = F.transform(F.col(levels), lambda x: x[0].cast("double") * x[1].cast("double"))
    return F.aggregate(notional, F.lit(0.0), lambda a, b: a + b)


def book_walls(books: DataFrame) -> DataFrame:
    """P11 + P12 + P20 + P31: walls, imbalance, whale class, book shares."""
    b = books.select("book_id", _level_sum("bids").alias("buy_wall_usd"), _level_sum("asks").alias("sell_wall_usd"))
    buy, sell = F.col("buy_wall_usd"), F.col("sell_wall_usd")
    total1 = buy + sell + 1
    denom = F.when(buy + sell > 0, buy + sell).otherwise(F.lit(1.0))
    return b.select(
        "*", wall_imbalance(buy, sell).alias("imbalance_ratio"),
        (buy / total1 * 100).alias("buy_pct"), (sell / total1 * 100).alias("sell_pct"),
        F.when(buy > sell * C.WHALE_WALL_RATIO, "STRONG_BID_WALL")
         .when(sell > buy * C.WHALE_WALL_RATIO, "STRONG_ASK_WALL").otherwise("BALANCED").alias("wall_class"),
        F.least(buy / denom, F.lit(1.0)).alias("bid_share"),
        F.least(sell / denom, F.lit(1.0)).alias("ask_share"))


def funding_class(df: DataFrame, col: str = "funding_rate") -> DataFrame:
    """Funding rate class."""
    return df.withColumn("funding_class", F.when(F.col(col) > C.FUNDING_HIGH, "HIGH")
                         .when(F.col(col) < C.FUNDING_LOW, "NEGATIVE").otherwise("NORMAL"))


def large_trades(df: DataFrame, min_usd: float = C.LARGE_TRADE_USD) -> DataFrame:
    """Tape filter: big notional or any liquidation."""
    return df.filter((F.col("volume_usd") > min_usd) | (F.col("liq_buy_usd") > 0) | (F.col("liq_sell_usd") > 0))
