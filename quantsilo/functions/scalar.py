"""Scalar column functions (F1-F14).  All are built-in Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quantsilo import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# instrument name 'COIN-EXPIRY-STRIKE-TYPE' -> parts; only 4-part names are valid
def instrument_parts(name) -> Column:
    parts = F.split(_c(name), "-")
    ok = F.size(parts) == 4
    return F.struct(
        F.when(ok, F.element_at(parts, 1)).alias("coin"),
        F.when(ok, F.element_at(parts, 2)).alias("expiry"),
        F.when(ok, F.element_at(parts, 3).try_cast("double")).alias("strike"),
        F.when(ok, F.element_at(parts, 4)).alias("type"),
    )


# time truncation kept as timestamp_ntz (engine-neutral wall clock)
def trunc_time(unit: str, ts) -> Column:
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


# '-USD' suffix -> 'USDT'
def usd_to_usdt(sym) -> Column:
    return F.regexp_replace(_c(sym), "-USD$", "USDT")


# parse to UTC and take the year
def utc_year(ts) -> Column:
    return F.year(_c(ts))


# weekday and month names
def weekday_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


def month_name(ts) -> Column:
    return F.date_format(_c(ts), "MMMM")


# numeric coercion with a default
def to_number(x, default: float) -> Column:
    return F.coalesce(_c(x).try_cast("double"), F.lit(float(default)))


# duration in milliseconds
def duration_ms(start, end) -> Column:
    return (F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))) / 1000.0


# F8: '_' -> ' ' and upper case
def display_name(x) -> Column:
    return F.upper(F.replace(_c(x), F.lit("_"), F.lit(" ")))


# rounding
def round_to(x, digits: int) -> Column:
    return F.round(_c(x), digits)


# greatest / least / abs are the built-ins F.greatest, F.least, F.abs
def clamp(x, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


# alarm key 'alarm:{user}:{symbol}:{target}:{direction}'; non 5-part keys -> NULL struct
def alarm_key_parts(key) -> Column:
    parts = F.split(_c(key), ":")
    ok = (F.size(parts) == 5) & (F.element_at(parts, 1) == "alarm")
    return F.when(ok, F.struct(
        F.element_at(parts, 2).try_cast("long").alias("user_id"),
        F.element_at(parts, 3).alias("symbol"),
        F.element_at(parts, 4).try_cast("double").alias("target"),
        F.element_at(parts, 5).alias("direction"),
    ))


def alarm_key(user, symbol, target, direction) -> Column:
    return F.concat_ws(":", F.lit("alarm"), _c(user).cast("string"), _c(symbol),
                       _c(target).cast("string"), _c(direction))


# direction synonyms -> 'up' / 'down' / NULL
def normalize_direction(raw) -> Column:
    x = F.lower(F.trim(_c(raw)))
    return (F.when(x.isin(*C.ALARM_UP_WORDS), "up")
            .when(x.isin(*C.ALARM_DOWN_WORDS), "down"))


# JSON encode / decode
def encode_json(*cols) -> Column:
    return F.to_json(F.struct(*cols))


def decode_json(x, schema) -> Column:
    return F.from_json(_c(x), schema)


# epoch milliseconds -> timestamp (wall clock, UTC)
def millis_to_time(ms) -> Column:
    return F.timestamp_millis(_c(ms)).cast("timestamp_ntz")


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of failing on a zero divisor (ANSI mode)."""
    return F.try_divide(_c(a), _c(b))
