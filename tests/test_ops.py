"""Alarms, quotas, runs and small operators."""

import datetime as dt
import random

import pytest

from quantsilo.functions import scalar as S
from quantsilo.operators import alerts, ops, quotas, runs
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def test_alarm_keys_and_directions(spark):
    keys = spark.createDataFrame([("alarm:7:BTCUSDT:100.5:up",), ("alarm:7:BTC:x:up",), ("bad:key",),
                                  ("alarm:1:2:3",)], "alarm_key string")
    p = alerts.parse_keys(keys).collect()
    assert [(r.user_id, r.symbol, r.target, r.direction) for r in p] == [(7, "BTCUSDT", 100.5, "up")]
    d = spark.createDataFrame([("Üst",), (" yukarı ",), ("asagi",), ("sideways",)], "direction_raw string")
    assert [r.direction for r in alerts.normalize_requests(d).collect()] == ["up", "up", "down"]


def test_alarm_trigger_anti_and_cap(spark):
    a = spark.createDataFrame([(i, 1, "X", 10.0 + i, "up" if i % 2 else "down", T0) for i in range(15)],
                              "alarm_id long, user_id long, symbol string, target double, direction string, "
                              "created_at timestamp_ntz")
    capped = alerts.cap_per_user(a)
    assert sorted(r.alarm_id for r in capped.collect()) == list(range(10))
    prices = spark.createDataFrame([("X", 15.0)], "symbol string, current_price double")
    fired = alerts.triggered(capped, prices)
    ids = sorted(r.alarm_id for r in fired.collect())
    # up fires when price >= target (targets 11,13 ≤ 15 for odd ids 1,3,5), down when price <= target
    assert ids == [1, 3, 5, 6, 8]
    assert sorted(r.alarm_id for r in alerts.still_active(capped, fired).collect()) == [0, 2, 4, 7, 9]


def _replay_python(times, successes, limit, ttl):
    count, expiry, blocked = 0, None, []
    for t, ok in zip(times, successes):
        if expiry is not None and t > expiry:
            count, expiry = 0, None
        if count >= limit:
            blocked.append(True)
            continue
        blocked.append(False)
        count, expiry = (0, None) if ok else (count + 1, t + ttl)
    return blocked


def test_login_lock_matches_python_loop(spark):
    secs = [0, 10, 20, 30, 40, 50, 60, 2000, 2010, 2020, 2030, 2040, 2041, 2942, 2943, 9000]
    ok = [False] * len(secs)
    ok[2] = True                                      # a success clears the counter
    rows = [("1.1.1.1", T0 + dt.timedelta(seconds=s), i, "signup" if k else "error")
            for i, (s, k) in enumerate(zip(secs, ok))]
    req = spark.createDataFrame(rows, "ip string, ts timestamp_ntz, event_id long, action string")
    got = sorted(r.event_id for r in quotas.login_locks(req).collect())
    want = [i for i, b in enumerate(_replay_python([T0 + dt.timedelta(seconds=s) for s in secs], ok, 5,
                                                   dt.timedelta(seconds=900))) if b]
    assert got == want and want


def test_registration_cap(spark):
    secs = [0, 100, 200, 300, 3000, 3801, 3802, 8000]
    rows = [("9.9.9.9", T0 + dt.timedelta(seconds=s), i, "signup") for i, s in enumerate(secs)]
    req = spark.createDataFrame(rows, "ip string, ts timestamp_ntz, event_id long, action string")
    got = sorted(r.event_id for r in quotas.registration_blocks(req).collect())
    want = [i for i, b in enumerate(_replay_python([T0 + dt.timedelta(seconds=s) for s in secs],
                                                   [False] * len(secs), 3, dt.timedelta(seconds=3600))) if b]
    assert got == want == [3, 4]


@pytest.mark.parametrize("block_rows", [5, 64, 10_000])
@pytest.mark.parametrize("limit,ttl,with_success", [(5, 900, True), (3, 3600, False)])
def test_counters_split_in_blocks_match_the_loop(spark, block_rows, limit, ttl, with_success):
    rnd = random.Random(block_rows + limit)
    rows, want = [], []
    for ip, gap in (("a", 60), ("b", 700), ("c", 5)):               # 'c' is one endless episode
        at, times, oks = 0, [], []
        for _ in range(300):
            at += rnd.choice([0, 1, gap, gap, 2 * gap])
            times.append(T0 + dt.timedelta(seconds=at))
            oks.append(with_success and rnd.random() < 0.15)
        base = len(rows)
        rows += [(ip, t, base + i, "ok" if k else "no") for i, (t, k) in enumerate(zip(times, oks))]
        blocked = _replay_python(times, oks, limit, dt.timedelta(seconds=ttl))
        want += [base + i for i, b in enumerate(blocked) if b]
    d = spark.createDataFrame(rows, "ip string, ts timestamp_ntz, event_id long, action string")
    got = quotas.renewable_counter_blocks(d, "ip", limit, ttl, F.col("action") == "ok", block_rows=block_rows)
    assert sorted(r.event_id for r in got.collect()) == want and len(want) > 100


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_windows_open_at_the_first_hit(spark, block_rows):
    rnd, rows, want = random.Random(1), [], []
    for user in (1, 2, 3):
        at, times = 0, []
        for _ in range(250):
            at += rnd.choice([0, 30, 60, 90, 1000] if user < 3 else [20, 50])
            times.append(at)
        rows += [(user, T0 + dt.timedelta(milliseconds=t), 1000 * user + i) for i, t in enumerate(times)]
        began, n = times[0], 0
        for t in [*times, 10 ** 9]:
            if t >= began + 1000:
                if n > 10:
                    want.append((user, began, n))
                began, n = t, 0
            n += 1
    d = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long")
    users = spark.createDataFrame([(k, "PREMIUM") for k in (1, 2, 3)], "user_id long, tier string")
    got = quotas.per_second_violations(d, users, block_rows=block_rows).collect()
    assert sorted((r.user_id, round((r.second - T0).total_seconds() * 1000), r.requests) for r in got) == want and len(want) > 10


def test_free_daily_ban_and_per_second(spark):
    users = spark.createDataFrame([(1, "FREE"), (2, "PREMIUM")], "user_id long, tier string")
    rows = [(1, T0 + dt.timedelta(milliseconds=10 * i), i, "view", "ip") for i in range(1002)]
    rows += [(2, T0 + dt.timedelta(milliseconds=50 * i), 5000 + i, "view", "ip") for i in range(12)]
    req = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_id long, action string, ip string")
    bans = quotas.free_daily_bans(req, users).collect()
    assert len(bans) == 1 and bans[0].banned_at == T0 + dt.timedelta(milliseconds=10 * 1000)
    v = quotas.per_second_violations(req, users).collect()
    assert [(r.user_id, r.requests) for r in v] == [(2, 12)]


def test_leaderboard_badges(spark):
    rows = [("p1", None, "COIN_A", "A", None, None, T0, T0),
            ("c1", "p1", "Deep_Forest", None, "0.5", "0.99", T0, T0 + dt.timedelta(milliseconds=300)),
            ("c2", "p1", "Quick_Forest", None, "n/a", "0.5", T0, T0 + dt.timedelta(milliseconds=100)),
            ("c3", "p9", "Plain_Line", None, "0.1", "0.2", T0, T0)]     # orphan: dropped
    r = spark.createDataFrame(rows, "run_id string, parent_run_id string, run_name string, symbol string, "
                                    "rmse string, r2 string, start_time timestamp_ntz, end_time timestamp_ntz")
    lb = {x.run_id: x for x in runs.leaderboard(runs.child_runs(r)).collect()}
    assert set(lb) == {"c1", "c2"}
    assert lb["c2"].rmse == 9999.0 and lb["c2"].model_name == "QUICK FOREST"
    assert lb["c1"].badges == f"{runs.BADGE_CHAMPION} {runs.BADGE_PRECISE}"
    assert lb["c2"].badges == runs.BADGE_FASTEST


def test_scalar_functions(spark):
    df = spark.createDataFrame([("BTC-USD", "BTC-27DEC24-95000-C", 1700000000123)], "s string, i string, ms long")
    r = df.select(S.usd_to_usdt("s").alias("a"), S.instrument_parts("i").alias("p"),
                  S.millis_to_time("ms").alias("t"), S.clamp(F.lit(120.0), 5, 95).alias("c")).collect()[0]
    assert r.a == "BTCUSDT" and r.p.strike == 95000.0 and r.p.type == "C" and r.c == 95.0
    assert r.t == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_wallet_and_route(spark):
    acc = spark.createDataFrame([(1, '[{"asset":"BTC","free":"0.5","locked":"0"},'
                                     '{"asset":"ETH","free":"0","locked":"0"}]')], "account_id long, balances_json string")
    assert [(r.asset, r.free) for r in ops.nonzero_balances(acc).collect()] == [("BTC", 0.5)]
    ev = spark.createDataFrame([("a",), ("b",)], "data_type string")
    assert ops.route(ev, "ALL").count() == 2 and ops.route(ev, "a").count() == 1
