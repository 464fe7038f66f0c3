"""Request-guard analytics over an API request log.

The reference enforces these limits online with expiring counters; here the
same rules are evaluated over the request history, as Spark jobs:

* R8 per-second caps: a user's window starts at the first request after the
  window before has ended, so windows are the orbit of the user's first
  request under 'the first request one second or more after this one'.
* R9 free daily cap: the 1001st request of a user's day bans the user; the
  ban time is the earliest such request.  Request ordinals per (user, day)
  come from ``plans.ordered``, so a hot user is split.
* R10 / R11 renewable counters that block after N: every counted failure
  renews the expiry, blocked attempts do not, and a success clears the login
  counter.  From an attempt that finds the counter empty the next such
  attempt is known: the one after the first success among the next N, or, if
  all N fail, the first one after the lock has expired.  The attempts that
  find it empty are orbits (``plans.orbits``); an attempt is blocked when the
  last of them before it locks and lies N or more attempts back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import trunc_time
from quantsilo.plans import orbits, ordered
from quantsilo.plans.joins import broadcast_if_small


def _micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def _episodes(rows: DataFrame, gap_micros: int, at_gap: bool) -> DataFrame:
    """Rows of ``ordered.arrange`` with ``_new``: nothing of the key's history before the row still counts.

    That is a row without a predecessor, or one that follows it by more than the gap (``at_gap``: or just that).
    """
    r = ordered.rolling(rows, lambda w: [F.lag("_t", 1).over(w).alias("_prev")], lookback=1)
    gap = F.col("_t") - F.col("_prev")
    far = gap >= gap_micros if at_gap else gap > gap_micros
    return r.withColumn("_new", F.col("_prev").isNull() | far).drop("_prev")


def _longest(rows: DataFrame) -> int:
    """The most rows of an episode (``episode`` numbered within the key); one number."""
    return rows.groupBy("_key", "episode").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def per_second_violations(requests: DataFrame, users: DataFrame, limits=C.QUOTA_PER_SECOND,
                          block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Windows of one second, each from a user's first request in it, with more requests than the tier's cap.

    Returns user_id, second (the window's first request), requests, tier, per_second_limit.
    """
    lim = requests.sparkSession.createDataFrame(list(limits), "tier string, per_second_limit int")
    tiers = users.select("user_id", "tier").join(F.broadcast(lim), "tier")      # a row a tier
    r = requests.join(broadcast_if_small(tiers), "user_id").withColumn("_t", _micros("ts"))
    r = ordered.arrange(r.select("user_id", "ts", "event_id", "tier", "per_second_limit", "_t"), ["user_id"],
                        ["ts", "event_id"], block_rows)
    r = _episodes(r, 1_000_000, at_gap=True).withColumn("_end", F.col("_t") + 1_000_000)
    r = ordered.stored(ordered.running(r, F.col("_new").cast("long"), "sum", "episode"))
    succ = ordered.stored(orbits.next_at(r, "_t", "_end", inclusive=True))
    opened = orbits.mark(r.join(succ, "_g", "left"), "_new", "successor", _longest(r))
    # requests of a window: up to the successor, or the key's end
    first = r.join(opened, "_g").join(succ, "_g", "left")
    last = r.groupBy("_key").agg((F.max("_g") + 1).alias("_stop"))
    windows = first.join(last, "_key", "left").withColumn("requests", F.coalesce("successor", "_stop") - F.col("_g"))
    return windows.filter(F.col("requests") > F.col("per_second_limit")).select(
        "user_id", F.col("ts").alias("second"), "requests", "tier", "per_second_limit")


def free_daily_bans(requests: DataFrame, users: DataFrame, cap: int = C.FREE_DAILY_CAP) -> DataFrame:
    """First time a FREE user's daily request count passes ``cap``; the ban is permanent."""
    free = users.filter(F.col("tier") == "FREE").select("user_id")
    r = (requests.join(broadcast_if_small(free), "user_id", "left_semi")
         .withColumn("day", trunc_time("day", "ts")).select("user_id", "day", "ts", "event_id"))
    r = ordered.sequence(ordered.arrange(r, ["user_id", "day"], ["ts", "event_id"]), "_n")
    return (r.filter(F.col("_n") == cap)        # 0-based: the (cap+1)-th request of the day
            .groupBy("user_id").agg(F.min("ts").alias("banned_at"), F.min("day").alias("ban_day")))


def renewable_counter_blocks(events: DataFrame, key: str, limit: int, ttl_seconds: int,
                             success: F.Column | None = None, block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Attempts rejected by a counter that blocks at ``limit`` and expires ``ttl`` after the last counted hit.

    Returns key, episode (the key's history split where attempts are more than the ttl apart, from 1), ts,
    event_id, blocked and count_after, for blocked attempts.
    """
    ok = F.coalesce(success, F.lit(False)) if success is not None else F.lit(False)
    ttl = ttl_seconds * 1_000_000
    e = events.select(F.col(key).cast("string").alias("key"), "ts", "event_id", ok.alias("_ok"), _micros("ts").alias("_t"))
    e = _episodes(ordered.arrange(e, ["key"], ["ts", "event_id"], block_rows), ttl, at_gap=False)
    e = ordered.running(e, F.col("_new").cast("long"), "sum", "episode")

    def ahead(w):
        """From an empty counter at this attempt: the first success among ``limit``, and the time of the last of them."""
        step = lambda c, k: F.lead(c, k).over(w) if k else F.col(c)     # noqa: E731
        same = [F.coalesce(step("episode", k) == F.col("episode"), F.lit(False)) for k in range(limit)]
        cleared = F.coalesce(*[F.when(same[k] & step("_ok", k), F.lit(k)) for k in range(limit)])
        return [cleared.alias("_cleared"), F.when(same[-1], step("_t", limit - 1)).alias("_last_t")]

    e = ordered.rolling(e, ahead, lookahead=limit - 1)
    locks = F.col("_cleared").isNull() & F.col("_last_t").isNotNull()
    e = ordered.stored(e.withColumn("_expiry", F.when(locks, F.col("_last_t") + ttl)))
    after_lock = orbits.next_at(e, "_t", "_expiry", inclusive=False)
    e = e.join(after_lock, "_g", "left")
    e = e.withColumn("_succ", F.when(F.col("_cleared").isNotNull(), F.col("_g") + F.col("_cleared") + 1)
                     .otherwise(F.col("successor"))).drop("successor")
    e = ordered.stored(e)
    # a success may be a key's last attempt; the row after it is then another key's, which begins anyway
    empty = orbits.mark(e, "_new", "_succ", _longest(e))
    e = e.join(empty.withColumn("_empty", F.lit(True)), "_g", "left")
    e = ordered.fill_forward(
        e.withColumn("_from", F.when(F.col("_empty"), F.struct(F.col("_g").alias("g"), F.col("_expiry").isNotNull().alias("locks")))),
        ["_from"])
    blocked = F.col("_from.locks") & (F.col("_g") - F.col("_from.g") >= limit)
    return e.filter(blocked).select("key", "episode", "ts", "event_id", F.lit(True).alias("blocked"),
                                    F.lit(limit).alias("count_after"))


def login_locks(requests: DataFrame) -> DataFrame:
    """Login attempts per IP ('error' = failure, 'signup' = success) refused by the 5-failure lock."""
    attempts = requests.filter(F.col("action").isin("error", "signup"))
    return renewable_counter_blocks(attempts, "ip", C.LOGIN_MAX_FAILURES, C.LOGIN_LOCK_SECONDS,
                                    success=F.col("action") == "signup")


def registration_blocks(requests: DataFrame) -> DataFrame:
    """Registrations ('signup') per IP refused by the 3-per-hour cap."""
    regs = requests.filter(F.col("action") == "signup")
    return renewable_counter_blocks(regs, "ip", C.REGISTRATION_MAX_PER_IP, C.REGISTRATION_WINDOW_SECONDS)
