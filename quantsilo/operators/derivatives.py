"""Options max pain and cross-venue arbitrage.

Max pain without the strike x option product: pain at strike K is

    K * sum(call oi, s < K) - sum(call s*oi, s < K)
  + sum(put s*oi, s > K)  - K * sum(put oi, s > K)

so after one aggregate per (coin, strike) - partial aggregation collapses a
hot coin to its distinct strikes - four prefix/suffix sums over the sorted
strikes give every candidate's pain.  Ties go to the lowest strike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import instrument_parts
from quantsilo.plans.joins import broadcast_if_small

#: Strikes and open interest as exact numbers; sums of pains then compare exactly.
EXACT = "decimal(12,4)"
_SUM = "decimal(20,4)"


def parse_options(raw: DataFrame) -> DataFrame:
    """'COIN-EXPIRY-STRIKE-TYPE' -> (coin, strike, type, oi); only 4-part names with oi > 0."""
    p = raw.select(instrument_parts("instrument_name").alias("i"),
                   F.coalesce(F.col("open_interest"), F.lit(0.0)).alias("oi"))
    return (p.filter(F.col("i").isNotNull() & F.col("i.strike").isNotNull() & (F.col("oi") > 0))
            .select(F.col("i.coin").alias("coin"), F.col("i.strike").alias("strike"),
                    F.col("i.type").alias("type"), "oi"))


def strike_set(options: DataFrame) -> DataFrame:
    """Distinct strikes per coin."""
    return options.select("coin", "strike").distinct()


def pain_curve(options: DataFrame) -> DataFrame:
    """Total pain at every listed strike of each coin, as an exact decimal.

    A coin's rows collapse to its distinct strikes, which are few, before they meet in one task.
    """
    is_c, is_p = F.col("type") == "C", F.col("type") == "P"
    exact = options.withColumns({c: F.col(c).cast(EXACT) for c in ("strike", "oi")})
    zero = F.lit(0).cast(EXACT)
    per = (exact.groupBy("coin", "strike")
           .agg(F.sum(F.when(is_c, F.col("oi")).otherwise(zero)).alias("c_oi"),
                F.sum(F.when(is_c, F.col("strike") * F.col("oi")).otherwise(zero)).alias("c_soi"),
                F.sum(F.when(is_p, F.col("oi")).otherwise(zero)).alias("p_oi"),
                F.sum(F.when(is_p, F.col("strike") * F.col("oi")).otherwise(zero)).alias("p_soi")))
    below = Window.partitionBy("coin").orderBy("strike").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("coin").orderBy(F.desc("strike")).rowsBetween(Window.unboundedPreceding, -1)
    k = F.col("strike")

    def total(c, w):
        return F.coalesce(F.sum(c).over(w), zero)

    pain = (k * total("c_oi", below).cast(_SUM) - total("c_soi", below)
            + total("p_soi", above) - k * total("p_oi", above).cast(_SUM))
    return per.select("coin", "strike", pain.alias("pain"))


def max_pain(options: DataFrame) -> DataFrame:
    """Strike with the least total pain per coin (lowest strike on true ties)."""
    best = F.min(F.struct("pain", "strike"))
    return (pain_curve(options).groupBy("coin").agg(best.alias("b"), F.count(F.lit(1)).alias("strikes"))
            .select("coin", F.col("b.strike").cast("double").alias("max_pain_strike"),
                    F.col("b.pain").cast("double").alias("min_pain"), "strikes"))


def latest_quotes(quotes: DataFrame, order: str = "quote_id") -> DataFrame:
    """Last quote per (symbol, venue), the dearer of two with one id: the venue -> price map of the reference."""
    return quotes.groupBy("symbol", "venue").agg(F.max(F.struct(order, "price"))["price"].alias("price"))


def arbitrage(venue_prices: DataFrame, min_venues: int = 2,
              signal_pct: float = C.ARBITRAGE_SIGNAL_PCT, high_pct: float = C.ARBITRAGE_HIGH_TIER_PCT,
              keys: tuple = ("symbol",)) -> DataFrame:
    """A15 + P30: cheapest / dearest venue, spread in USD and percent (rounded 4), signal, tier."""
    agg = (venue_prices.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("venues"),
                F.min_by("venue", F.struct("price", "venue")).alias("min_exchange"),
                F.max_by("venue", F.struct("price", F.col("venue"))).alias("max_exchange"),
                F.min("price").alias("min_price"), F.max("price").alias("max_price"))
           .filter(F.col("venues") >= min_venues))
    spread = F.col("max_price") - F.col("min_price")
    pct = F.try_divide(spread, F.col("min_price")) * 100
    return agg.select(
        *keys, "venues", "min_exchange", "max_exchange", "min_price", "max_price",
        F.round(spread, 4).alias("spread_usd"), F.round(pct, 4).alias("spread_pct"),
        F.when(pct > signal_pct, "OPPORTUNITY").otherwise("BALANCED").alias("signal"),
        F.when(F.round(pct, 4) >= high_pct, "HIGH").otherwise("LIQUIDITY_GAP").alias("tier"))


def price_board(venue_prices: DataFrame, arb: DataFrame) -> DataFrame:
    """P30 + T4 + A15: every venue's price of each symbol that ``arb`` lists, dearest first, with its price tag.

    ``place`` counts from the dearest; the cheapest venue is BEST BUY, the dearest BEST SELL, both without
    ties (``arbitrage`` names one venue each).  A symbol's rows are its venues, of which there are few.
    """
    dear = Window.partitionBy("symbol").orderBy(F.desc("price"), "venue")
    tag = (F.when(F.col("venue") == F.col("min_exchange"), "BEST BUY")
           .when(F.col("venue") == F.col("max_exchange"), "BEST SELL"))
    return (venue_prices.join(arb.select("symbol", "min_exchange", "max_exchange", "spread_pct", "tier"), "symbol")
            .select("symbol", "venue", "price", F.row_number().over(dear).alias("place"), tag.alias("price_tag"),
                    "spread_pct", "tier"))


def daily_best_spread(quotes: DataFrame) -> DataFrame:
    """The widest spread of each day (A26): the last quote of each venue that day, best symbol by percent, then name."""
    last = quotes.groupBy("day", "symbol", "venue").agg(F.max(F.struct("quote_id", "price"))["price"].alias("price"))
    day = arbitrage(last, keys=("day", "symbol"))
    first = F.min_by(F.struct("symbol", "spread_pct", "min_exchange", "max_exchange"), F.struct(-F.col("spread_pct"), F.col("symbol")))
    return day.groupBy("day").agg(first.alias("b")).select(
        "day", F.col("b.symbol").alias("best_arbitrage"), F.col("b.spread_pct").alias("best_spread_pct"),
        F.col("b.min_exchange").alias("best_buy"), F.col("b.max_exchange").alias("best_sell"))


def top_spreads(arb: DataFrame, venue_prices: DataFrame, k: int = 6, per_symbol: int = 3) -> DataFrame:
    """The k widest spreads, each with its ``per_symbol`` cheapest venues (T4 ascending)."""
    top = arb.orderBy(F.col("spread_pct").desc(), F.col("symbol")).limit(k).select("symbol", "spread_pct")
    cand = venue_prices.join(F.broadcast(top), "symbol")   # k rows: fixed-size broadcast
    w = Window.partitionBy("symbol").orderBy("price", "venue")
    return (cand.withColumn("venue_rank", F.row_number().over(w))
            .filter(F.col("venue_rank") <= per_symbol))


def market_cap(prices: DataFrame, supply: DataFrame) -> DataFrame:
    """Price x circulating supply through a size-checked broadcast lookup join."""
    return (prices.join(broadcast_if_small(supply), "symbol", "left")
            .withColumn("market_cap", F.col("price") * F.col("supply")))
