"""Silver windows, anomalies, max pain, arbitrage and exchange enrichment against brute force."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from quantsilo.operators import derivatives, exchange, gold, silver

T0 = dt.datetime(2024, 1, 1)


def _ticks(spark, rows):
    schema = ("symbol string, price double, quantity double, volume_usd double, is_buyer_maker boolean, "
              "trade_side string, buy_wall_usd double, sell_wall_usd double, imbalance_ratio double, "
              "mark_price double, funding_rate double, liq_buy_usd double, liq_sell_usd double, "
              "ts timestamp_ntz, event_id long")
    return spark.createDataFrame(rows, schema)


def _tick(i, sec, price, side, buy=10.0, sell=5.0, sym="X"):
    return (sym, price, 1.0, price, side == "SELL", side, buy, sell, 0.0, price, 0.0, 0.0, 0.0,
            T0 + dt.timedelta(seconds=sec), i)


def test_window_metrics_semantics(spark):
    # two ticks at the same instant: the higher event id is the "last" one; NULL side counts as a sell
    rows = [_tick(1, 1, 10.0, "BUY", buy=100.0), _tick(2, 1, 20.0, None, buy=7.0), _tick(3, 7, 30.0, "BUY")]
    w = silver.window_metrics(_ticks(spark, rows)).orderBy("window_start").collect()
    first = [r for r in w if r.window_start == T0 - dt.timedelta(seconds=5)][0]
    assert first.buy_wall_usd == 7.0 and first.trade_side is None
    assert first.cvd == 10.0 - 20.0
    assert first.vpin_score == abs(-10.0) / (30.0 + 1)
    assert first.volatility == 5.0          # population std of {10, 20}
    assert len(w) == 3                       # ticks at 1s and 7s -> windows starting -5, 0 and 5


def test_anomaly_needs_six_windows_and_flags_spike(spark):
    rows = [_tick(i, 5 * i, 10.0 + (i % 3), "BUY") for i in range(70)] + [_tick(999, 350, 5000.0, "BUY")]
    s = silver.anomaly_flags(silver.window_metrics(_ticks(spark, rows)), block_rows=30)
    flags = {r.window_start: (r.anomaly_wash_trading, r.anomaly_score) for r in s.collect()}
    # before six windows exist nothing is flagged
    early = [v for k, v in flags.items() if k < T0 + dt.timedelta(seconds=15)]
    assert all(f == (False, 0.0) for f in early)
    spike = [v for k, v in flags.items() if k >= T0 + dt.timedelta(seconds=345)]
    assert spike and all(wash for wash, _ in spike)
    assert sum(wash for wash, _ in flags.values()) == len(spike)


def test_quality_report_and_not_null(spark):
    df = spark.createDataFrame([("A", 1.0, None, T0), ("A", -1.0, 0.1, None)],
                               "symbol string, average_price double, volatility double, processed_time timestamp_ntz")
    r = gold.quality_report(df).collect()[0]
    assert (r.bad_prices, r.null_volatility, r.null_time, r.result) == (1, 1, 1, "FAILED")
    t = {x.test_name: x.failures for x in gold.not_null_tests(df).collect()}
    assert t == {"not_null_symbol": 0, "not_null_processed_time": 1}
    assert gold.read_or_none(spark, "/nonexistent/quantsilo/table") is None


def test_max_pain_equals_brute_force(spark):
    opts = [("BTC-27DEC24-100-C", 5.0), ("BTC-27DEC24-110-P", 3.0), ("BTC-27DEC24-90-P", 4.0),
            ("BTC-27DEC24-120-C", 2.0), ("BAD-NAME", 1.0), ("ETH-27DEC24-50-C", 0.0),
            ("ETH-27DEC24-50-P", 1.0), ("ETH-27DEC24-60-C", 1.0)]
    raw = spark.createDataFrame(opts, "instrument_name string, open_interest double")
    parsed = derivatives.parse_options(raw)
    got = {r.coin: r.max_pain_strike for r in derivatives.max_pain(parsed).collect()}
    o = [(n.split("-")[0], float(n.split("-")[2]), n.split("-")[3], oi) for n, oi in opts
         if len(n.split("-")) == 4 and oi > 0]
    want = {}
    for coin, group in itertools.groupby(sorted(o), key=lambda x: x[0]):
        g = list(group)
        best = None
        for k in sorted({s for _, s, _, _ in g}):
            pain = sum((k - s) * oi for _, s, t, oi in g if t == "C" and k > s)
            pain += sum((s - k) * oi for _, s, t, oi in g if t == "P" and k < s)
            if best is None or pain < best[0]:
                best = (pain, k)
        want[coin] = best[1]
    assert got == want


def test_arbitrage_needs_two_venues(spark):
    q = spark.createDataFrame([("A", "V1", 100.0), ("A", "V2", 100.1), ("B", "V1", 5.0)],
                              "symbol string, venue string, price double")
    r = derivatives.arbitrage(q).collect()
    assert len(r) == 1 and r[0].min_exchange == "V1" and r[0].max_exchange == "V2"
    assert r[0].spread_usd == 0.1 and r[0].signal == "OPPORTUNITY" and r[0].tier == "LIQUIDITY_GAP"


def test_enrich_trades_state_and_interval_sums(spark):
    def msg(i, sec, kind, p="10", q="2", liq_side="SELL", bw=None, aw=None):
        return ("s1", kind, 1 if kind == "trade" else 0, T0 + dt.timedelta(seconds=sec), i, p, q, False,
                int((T0 + dt.timedelta(seconds=sec)).timestamp() * 1000), bw, aw, 0.001, liq_side)
    rows = [msg(1, 0, "trade"),                                  # no state yet -> zeros
            msg(2, 1, "depth", bw=30.0, aw=10.0),
            msg(3, 2, "liquidation", p="5", q="2", liq_side="SELL"),
            msg(4, 3, "liquidation", p="1", q="1", liq_side="BUY"),
            msg(5, 4, "trade"),
            msg(6, 5, "mark", p="11"),
            msg(7, 5, "trade")]                                  # same instant: mark applies first
    schema = ("raw_symbol string, kind string, kind_rank int, ts timestamp_ntz, event_id long, p string, "
              "q string, m boolean, T long, bid_wall double, ask_wall double, r double, liq_side string")
    out = {r.event_id: r for r in exchange.enrich_trades(spark.createDataFrame(rows, schema), block_rows=2).collect()}
    assert out[1].buy_wall_usd == 0.0 and out[1].liq_buy_usd == 0.0
    assert out[5].liq_buy_usd == 10.0 and out[5].liq_sell_usd == 1.0 and out[5].imbalance_ratio == 0.5
    assert out[7].liq_buy_usd == 0.0 and out[7].mark_price == 11.0 and out[7].symbol == "S1"
