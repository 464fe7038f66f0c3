"""Registered queries: exchange enrichment, order books, max pain, arbitrage (J1, J2, J5, J9, A14, A15, P10-P31, T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.operators import derivatives, exchange
from quantsilo.plans.catalog import register, spark_round_sql
from quantsilo.sources import fixtures as fx
from quantsilo.sources.fixtures import with_ctes

# ------------------------------------------------------- enriched trades ----
SQL_ENRICHED = with_ctes(fx.SQL_MESSAGES) + """,
m AS (SELECT upper(raw_symbol) AS symbol, kind, kind_rank, ts, event_id, p_num, q_num, m, T, r, liq_side,
             CASE WHEN kind = 'depth' THEN bid_wall END AS bw, CASE WHEN kind = 'depth' THEN ask_wall END AS aw,
             CASE WHEN kind = 'mark' THEN p_num END AS mp, CASE WHEN kind = 'mark' THEN r END AS fr,
             CASE WHEN kind = 'trade' THEN event_id END AS nt
      FROM messages),
f AS (SELECT *, last_value(bw IGNORE NULLS) OVER wb AS bw2, last_value(aw IGNORE NULLS) OVER wb AS aw2,
             last_value(mp IGNORE NULLS) OVER wb AS mp2, last_value(fr IGNORE NULLS) OVER wb AS fr2,
             first_value(nt IGNORE NULLS) OVER wf AS next_trade
      FROM m
      WINDOW wb AS (PARTITION BY symbol ORDER BY ts, kind_rank, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wf AS (PARTITION BY symbol ORDER BY ts, kind_rank, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
liq AS (SELECT symbol, next_trade AS event_id,
               sum(CASE WHEN liq_side = 'SELL' THEN p_num * q_num ELSE 0.0 END) AS liq_buy_usd,
               sum(CASE WHEN liq_side = 'SELL' THEN 0.0 ELSE p_num * q_num END) AS liq_sell_usd
        FROM f WHERE kind = 'liquidation' AND next_trade IS NOT NULL GROUP BY 1, 2),
t AS (SELECT symbol, p_num AS price, q_num AS quantity, p_num * q_num AS volume_usd, m AS is_buyer_maker,
             CASE WHEN m THEN 'SELL' ELSE 'BUY' END AS trade_side,
             coalesce(bw2, 0.0) AS buy_wall_usd, coalesce(aw2, 0.0) AS sell_wall_usd,
             coalesce(mp2, 0.0) AS mark_price, coalesce(fr2, 0.0) AS funding_rate,
             epoch_ms(T) AS "timestamp", ts, event_id
      FROM f WHERE kind = 'trade'),
enriched AS (
  SELECT symbol, price, quantity, volume_usd, is_buyer_maker, trade_side, buy_wall_usd, sell_wall_usd,
         CASE WHEN buy_wall_usd + sell_wall_usd > 0
              THEN (buy_wall_usd - sell_wall_usd) / (buy_wall_usd + sell_wall_usd) ELSE 0.0 END AS imbalance_ratio,
         mark_price, funding_rate, coalesce(liq.liq_buy_usd, 0.0) AS liq_buy_usd,
         coalesce(liq.liq_sell_usd, 0.0) AS liq_sell_usd, "timestamp", ts, event_id
  FROM t LEFT JOIN liq USING (symbol, event_id))"""

_ENR_DOUBLES = ("price quantity volume_usd buy_wall_usd sell_wall_usd imbalance_ratio mark_price funding_rate "
                "liq_buy_usd liq_sell_usd")


def _enriched(spark, sf):
    return exchange.enrich_trades(fx.exchange_messages(spark, sf))


@register("enriched_trades", "J1 J2 P10 P12 P13 F14",
          sql=SQL_ENRICHED + "\nSELECT * FROM enriched", doubles=_ENR_DOUBLES)
def q_enriched(spark, sf):
    return _enriched(spark, sf)


@register("large_trade_tape", "P15 T2 T1",
          sql=SQL_ENRICHED + f"""
SELECT * FROM enriched
WHERE volume_usd > {C.LARGE_TRADE_USD} OR liq_buy_usd > 0 OR liq_sell_usd > 0
ORDER BY ts DESC, event_id DESC LIMIT 50""", doubles=_ENR_DOUBLES)
def q_tape(spark, sf):
    return exchange.large_trades(_enriched(spark, sf)).orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50)


@register("symbol_filter", "P17",
          sql=SQL_ENRICHED + "\nSELECT * FROM enriched WHERE symbol = upper('s3')", doubles=_ENR_DOUBLES)
def q_symbol_filter(spark, sf):
    return _enriched(spark, sf).filter(F.col("symbol") == F.upper(F.lit("s3")))


@register("funding_classes", "P21",
          sql=SQL_ENRICHED + f"""
SELECT symbol, CASE WHEN funding_rate > {C.FUNDING_HIGH} THEN 'HIGH' WHEN funding_rate < {C.FUNDING_LOW}
                    THEN 'NEGATIVE' ELSE 'NORMAL' END AS funding_class, count(*) AS trades
FROM enriched GROUP BY 1, 2""")
def q_funding_classes(spark, sf):
    return exchange.funding_class(_enriched(spark, sf)).groupBy("symbol", "funding_class").agg(
        F.count(F.lit(1)).alias("trades"))


@register("market_cap", "P28 J9",
          sql=SQL_ENRICHED + ",\n" + fx.SQL_SUPPLY + """
SELECT l.symbol, l.price, s.supply, l.price * s.supply AS market_cap
FROM (SELECT symbol, arg_max(price, (ts, event_id)) AS price FROM enriched GROUP BY symbol) l
LEFT JOIN supply s USING (symbol)""", doubles="price supply market_cap")
def q_market_cap(spark, sf):
    last = _enriched(spark, sf).groupBy("symbol").agg(F.max_by("price", F.struct("ts", "event_id")).alias("price"))
    return derivatives.market_cap(last, fx.coin_supply(spark, sf))


# ----------------------------------------------------------- order books ----
@register("order_book_walls", "P11 P12 P20 P31",
          sql="""
WITH b AS (
  SELECT l_orderkey AS book_id,
         sum(CASE WHEN l_linestatus = 'O' THEN (l_extendedprice / l_quantity) * l_quantity ELSE 0.0 END) AS buy_wall_usd,
         sum(CASE WHEN l_linestatus = 'F' THEN (l_extendedprice / l_quantity) * l_quantity ELSE 0.0 END) AS sell_wall_usd
  FROM lineitem GROUP BY 1)
SELECT book_id, buy_wall_usd, sell_wall_usd,
       CASE WHEN buy_wall_usd + sell_wall_usd > 0
            THEN (buy_wall_usd - sell_wall_usd) / (buy_wall_usd + sell_wall_usd) ELSE 0.0 END AS imbalance_ratio,
       buy_wall_usd / (buy_wall_usd + sell_wall_usd + 1) * 100 AS buy_pct,
       sell_wall_usd / (buy_wall_usd + sell_wall_usd + 1) * 100 AS sell_pct,
       CASE WHEN buy_wall_usd > sell_wall_usd * 2.5 THEN 'STRONG_BID_WALL'
            WHEN sell_wall_usd > buy_wall_usd * 2.5 THEN 'STRONG_ASK_WALL' ELSE 'BALANCED' END AS wall_class,
       least(buy_wall_usd / CASE WHEN buy_wall_usd + sell_wall_usd > 0 THEN buy_wall_usd + sell_wall_usd ELSE 1.0 END, 1.0) AS bid_share,
       least(sell_wall_usd / CASE WHEN buy_wall_usd + sell_wall_usd > 0 THEN buy_wall_usd + sell_wall_usd ELSE 1.0 END, 1.0) AS ask_share
FROM b""", doubles="buy_wall_usd sell_wall_usd imbalance_ratio buy_pct sell_pct bid_share ask_share")
def q_books(spark, sf):
    return exchange.book_walls(fx.depth_books(spark, sf))


# --------------------------------------------------------------- options ----
@register("max_pain", "A14 J5 F1 U2",
          sql=with_ctes(fx.SQL_OPTIONS) + """,
exact AS (SELECT coin, type, CAST(strike AS DECIMAL(12, 4)) AS strike, CAST(oi AS DECIMAL(12, 4)) AS oi FROM options),
strikes AS (SELECT DISTINCT coin, strike FROM exact),
pain AS (
  SELECT s.coin, s.strike,
         sum(CASE WHEN o.type = 'C' AND s.strike > o.strike THEN (s.strike - o.strike) * o.oi
                  WHEN o.type = 'P' AND s.strike < o.strike THEN (o.strike - s.strike) * o.oi
                  ELSE 0 END) AS pain
  FROM strikes s JOIN exact o ON o.coin = s.coin GROUP BY 1, 2)
SELECT coin, CAST(arg_min(strike, (pain, strike)) AS DOUBLE) AS max_pain_strike, CAST(min(pain) AS DOUBLE) AS min_pain,
       count(*) AS strikes
FROM pain GROUP BY coin""", doubles="max_pain_strike min_pain", digits=4)
def q_max_pain(spark, sf):
    return derivatives.max_pain(derivatives.parse_options(fx.option_quotes(spark, sf)))


@register("strike_set", "U2 F1",
          sql=with_ctes(fx.SQL_OPTIONS) + "SELECT DISTINCT coin, strike FROM options", doubles="strike")
def q_strikes(spark, sf):
    return derivatives.strike_set(derivatives.parse_options(fx.option_quotes(spark, sf)))


# ------------------------------------------------------------- arbitrage ----
_SPREAD = spark_round_sql("max_price - min_price", 4)
_PCT = spark_round_sql("(max_price - min_price) / min_price * 100", 4)

SQL_ARB = with_ctes(fx.SQL_QUOTES) + f""",
vp AS (SELECT symbol, venue, arg_max(price, (quote_id, price)) AS price FROM quotes GROUP BY 1, 2),
agg AS (SELECT symbol, count(*) AS venues, arg_min(venue, (price, venue)) AS min_exchange,
               arg_max(venue, (price, venue)) AS max_exchange, min(price) AS min_price, max(price) AS max_price
        FROM vp GROUP BY symbol HAVING count(*) >= 2),
arb AS (
  SELECT symbol, venues, min_exchange, max_exchange, min_price, max_price,
         {_SPREAD} AS spread_usd,
         {_PCT} AS spread_pct,
         CASE WHEN (max_price - min_price) / min_price * 100 > {C.ARBITRAGE_SIGNAL_PCT} THEN 'OPPORTUNITY'
              ELSE 'BALANCED' END AS signal,
         CASE WHEN {_PCT} >= {C.ARBITRAGE_HIGH_TIER_PCT} THEN 'HIGH' ELSE 'LIQUIDITY_GAP' END AS tier
  FROM agg)"""


def _venue_prices(spark, sf):
    return derivatives.latest_quotes(fx.venue_quotes(spark, sf))


@register("price_board", "A15 P30 T4",
          sql=SQL_ARB + """
SELECT vp.symbol, vp.venue, vp.price, row_number() OVER (PARTITION BY vp.symbol ORDER BY vp.price DESC, vp.venue) AS place,
       CASE WHEN vp.venue = min_exchange THEN 'BEST BUY' WHEN vp.venue = max_exchange THEN 'BEST SELL' END AS price_tag,
       spread_pct, tier
FROM vp JOIN arb USING (symbol)""", doubles="price spread_pct")
def q_price_board(spark, sf):
    vp = _venue_prices(spark, sf)
    return derivatives.price_board(vp, derivatives.arbitrage(vp))


@register("arbitrage", "A15 F9",
          sql=SQL_ARB + "\nSELECT * FROM arb",
          doubles="min_price max_price spread_usd spread_pct")
def q_arbitrage(spark, sf):
    return derivatives.arbitrage(_venue_prices(spark, sf))


@register("top_spreads", "T3",
          sql=SQL_ARB + """,
top AS (SELECT symbol, spread_pct FROM arb ORDER BY spread_pct DESC, symbol LIMIT 6)
SELECT * FROM (
  SELECT vp.symbol, vp.venue, vp.price, top.spread_pct,
         row_number() OVER (PARTITION BY vp.symbol ORDER BY vp.price, vp.venue) AS venue_rank
  FROM vp JOIN top USING (symbol))
WHERE venue_rank <= 3""", doubles="price spread_pct")
def q_top_spreads(spark, sf):
    vp = _venue_prices(spark, sf)
    return derivatives.top_spreads(derivatives.arbitrage(vp), vp)
