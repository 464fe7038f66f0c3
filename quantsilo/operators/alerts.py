"""Price alarms (F11, F12, J4, J11, A25, A28, R7 batch form).

An alarm is checked against the *current* price of its symbol, as the
reference worker does each cycle.  Current prices are one row per symbol
(an aggregate of the tick stream), so the check is a hash join of alarms
with a size-checked broadcast of that table plus the direction predicate -
never an alarm x tick product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import alarm_key, alarm_key_parts, normalize_direction
from quantsilo.plans import topk
from quantsilo.plans.joins import broadcast_if_small, with_stats


def with_keys(alarms: DataFrame) -> DataFrame:
    """F11 (encode): the 'alarm:{user}:{symbol}:{target}:{direction}' key."""
    return alarms.withColumn("alarm_key", alarm_key("user_id", "symbol", "target", "direction"))


def parse_keys(keys: DataFrame, col: str = "alarm_key") -> DataFrame:
    """F11 (decode): 5-part keys only; bad targets dropped."""
    p = keys.select("*", alarm_key_parts(col).alias("_p"))
    return (p.filter(F.col("_p").isNotNull() & F.col("_p.target").isNotNull())
            .select(*keys.columns, "_p.user_id", "_p.symbol", "_p.target", "_p.direction"))


def normalize_requests(requests: DataFrame, raw_col: str = "direction_raw") -> DataFrame:
    """direction synonyms -> up / down; unknown words are rejected (dropped)."""
    return (requests.withColumn("direction", normalize_direction(raw_col))
            .filter(F.col("direction").isNotNull()))


def cap_per_user(alarms: DataFrame, cap: int = C.MAX_ALARMS_PER_USER) -> DataFrame:
    """A user keeps at most ``cap`` alarms (earliest first) - skew-safe top-k per user."""
    return topk.top_k_per_key(alarms, ["user_id"], ["created_at", "alarm_id"], cap)


def live_alarms(alarms: DataFrame, as_of: DataFrame, ttl_days: int = C.ALARM_TTL_DAYS) -> DataFrame:
    """R7 expiry: created at or before ``as_of`` and younger than ``ttl_days``.

    ``as_of`` is a one-row frame with column ``as_of``.
    """
    a = with_stats(alarms, as_of)
    return a.filter((F.col("created_at") <= F.col("as_of"))
                    & (F.col("as_of") < F.timestamp_add("DAY", F.lit(ttl_days), F.col("created_at"))))


def current_prices(ticks: DataFrame, symbol: str = "symbol", price: str = "price",
                   order=("ts", "event_id")) -> DataFrame:
    """Latest price per symbol (one row per symbol, partial aggregation)."""
    return ticks.groupBy(symbol).agg(F.max_by(price, F.struct(*order)).alias("current_price"))


def triggered(alarms: DataFrame, prices: DataFrame) -> DataFrame:
    """Equi-join on symbol + direction-dependent range predicate."""
    hit = (((F.col("direction") == "up") & (F.col("current_price") >= F.col("target")))
           | ((F.col("direction") == "down") & (F.col("current_price") <= F.col("target"))))
    return alarms.join(broadcast_if_small(prices), "symbol").filter(hit)


def still_active(alarms: DataFrame, fired: DataFrame) -> DataFrame:
    """Alarms that did not fire stay (left anti join on the alarm identity)."""
    return alarms.join(fired.select("alarm_id"), "alarm_id", "left_anti")


def alarm_counts(alarms: DataFrame) -> DataFrame:
    """Active-key counts (alarms, distinct symbols) in one aggregate."""
    return alarms.agg(F.count(F.lit(1)).alias("alarms"), F.countDistinct("symbol").alias("symbols"),
                      F.countDistinct("user_id").alias("users"))
