"""Small operators: routing, classification tags, membership, digests, bronze records.

(A16-A19, A24, A26, J10, P2, P16, P19, P22-P27, P29)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from quantsilo import config as C
from quantsilo.functions.scalar import clamp, trunc_time
from quantsilo.operators.silver import TICK_SCHEMA
from quantsilo.plans import ordered


# ------------------------------------------------------------- routing ------
def route(events: DataFrame, data_type: str, col: str = "data_type") -> DataFrame:
    """Keep one message type; 'ALL' passes everything."""
    return events if data_type == "ALL" else events.filter(F.col(col) == data_type)


# ----------------------------------------------------------- bronze ---------
def to_kafka_records(ticks: DataFrame) -> DataFrame:
    """Ticks as Kafka-like records: binary key/value, partition and offset, broker timestamp (producer side of S1/S2).

    A symbol's ticks share a partition, as with a keyed producer; offsets grow with the event id.
    """
    payload = F.to_json(F.struct(
        *[F.col(f.name) for f in TICK_SCHEMA.fields if f.name != "timestamp"],
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    return ticks.select(F.col("symbol").cast("binary").alias("key"), payload.cast("binary").alias("value"),
                        F.pmod(F.crc32(F.col("symbol").cast("binary")), F.lit(8)).cast("int").alias("partition"),
                        F.col("event_id").cast("long").alias("offset"), F.col("ts").alias("timestamp"))


def bronze(records: DataFrame) -> DataFrame:
    """Schema-agnostic bronze row (kafka_key, raw_payload, ingest_time)."""
    return records.select(F.col("key").cast("string").alias("kafka_key"),
                          F.col("value").cast("string").alias("raw_payload"),
                          F.col("timestamp").cast("timestamp_ntz").alias("ingest_time"))


# ------------------------------------------------------------ wallet --------
BALANCES = ArrayType(StructType([StructField("asset", StringType()), StructField("free", StringType()),
                                 StructField("locked", StringType())]))


def nonzero_balances(accounts: DataFrame, col: str = "balances_json") -> DataFrame:
    """Parse the balance array and keep assets with free > 0 or locked > 0."""
    arr = F.from_json(F.col(col), BALANCES)
    keep = F.filter(arr, lambda b: (b["free"].cast("double") > 0) | (b["locked"].cast("double") > 0))
    return (accounts.select("*", F.explode(keep).alias("b"))
            .select(*[c for c in accounts.columns if c != col],
                    F.col("b.asset").alias("asset"), F.col("b.free").cast("double").alias("free"),
                    F.col("b.locked").cast("double").alias("locked")))


# ----------------------------------------------------------- tags -----------
def flow_tags(df: DataFrame, cvd: str = "cvd", imb: str = "imbalance_ratio") -> DataFrame:
    """Flow size tag from |cvd| and trend from (cvd, imbalance)."""
    a = F.abs(F.col(cvd))
    return df.select(
        "*",
        F.when(a > C.FLOW_WHALE_CVD, "WHALE").when(a < C.FLOW_RETAIL_CVD, "RETAIL")
         .otherwise("INSTITUTIONAL").alias("flow_tag"),
        F.when((F.col(cvd) > 0) & (F.col(imb) > C.FLOW_BULL_IMB), "BULL_AGGRESSIVE")
         .when((F.col(cvd) < 0) & (F.col(imb) < C.FLOW_BEAR_IMB), "BEAR_PRESSURE")
         .otherwise("ACCUMULATION").alias("flow_trend"))


def sentiment(df: DataFrame, imb: str = "imbalance_ratio") -> DataFrame:
    """Bull percentage 50 + 50 * imbalance clamped to 5..95."""
    return df.withColumn("bull_pct", clamp(F.lit(50.0) + F.col(imb) * 50, C.SENTIMENT_MIN, C.SENTIMENT_MAX))


def dashboard_signals(df: DataFrame) -> DataFrame:
    """P24 + P25: model, RSI, VPIN and CVD signals and Bollinger band proximity per silver window.

    ``vpin_score`` and ``cvd`` are the window's; missing ones count as 0.
    """
    vpin, cvd = F.coalesce("vpin_score", F.lit(0.0)), F.coalesce("cvd", F.lit(0.0))
    return df.select(
        "*",
        F.when(F.col("predicted_price") > F.col("average_price"), "BUY").otherwise("SELL").alias("model_signal"),
        F.when(F.col("RSI") > C.RSI_OVERBOUGHT, "OVERBOUGHT").when(F.col("RSI") < C.RSI_OVERSOLD, "OVERSOLD")
         .otherwise("NEUTRAL").alias("rsi_state"),
        F.when(vpin > C.VPIN_FLOW_RISK, "TOXIC").otherwise("CLEAN").alias("vpin_state"),
        F.when(cvd > 0, "BUY_PRESSURE").otherwise("SELL_PRESSURE").alias("cvd_state"),
        F.when(F.col("Bollinger_Upper") - F.col("average_price") < F.col("average_price") - F.col("Bollinger_Lower"),
               "NEAR_UPPER").otherwise("NEAR_LOWER").alias("band_side"))


def trend_flags(df: DataFrame) -> DataFrame:
    """Bull / bear against MA99; up / down bar."""
    return df.select("symbol", "timestamp", "close", "MA99",
                     F.when(F.col("close") > F.col("MA99"), "BULL").otherwise("BEAR").alias("trend"),
                     F.when(F.col("close") >= F.col("open"), "UP").otherwise("DOWN").alias("bar"))


def change_rating(df: DataFrame, change: str = "change_pct") -> DataFrame:
    """24 h change in percent -> five classes."""
    c = F.col(change)
    return df.withColumn("rating", F.when(c > C.CHANGE_STRONG, "STRONG_BUY").when(c > 0, "BUY")
                         .when(c < -C.CHANGE_STRONG, "STRONG_SELL").when(c < 0, "SELL").otherwise("NEUTRAL"))


# ---------------------------------------------------------- membership ------
def rows_per_symbol(df: DataFrame, minimum: int = C.MIN_ROWS_PER_SYMBOL) -> DataFrame:
    """Symbols with more than ``minimum`` rows."""
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > minimum)


def trainable_rows(df: DataFrame, minimum: int = C.MIN_ROWS_PER_SYMBOL) -> DataFrame:
    """Rows of symbols with enough history (left semi join); ``df`` is evaluated once."""
    rows = ordered.stored(df)
    return rows.join(rows_per_symbol(rows, minimum).select("symbol"), "symbol", "left_semi")


def training_readiness(df: DataFrame, minimum: int = C.MIN_ROWS_PER_SYMBOL) -> DataFrame:
    """One row: total rows and whether training may start."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("ready", F.col("total_rows") >= minimum)


def users_per_tier(users: DataFrame) -> DataFrame:
    """A24."""
    return users.groupBy("tier").agg(F.count(F.lit(1)).alias("users"))


def daily_digest(silver_rows: DataFrame, children: DataFrame, spreads: DataFrame | None = None) -> DataFrame:
    """Per day - signals, whale events, busiest symbol, model updates, the day's champion, the best spread.

    ``spreads`` are rows of ``derivatives.daily_best_spread``.
    """
    day = trunc_time("day", "window_start")
    sig = ((F.col("vpin_score") > C.VPIN_FLOW_RISK) | F.col("anomaly_wash_trading") | F.col("anomaly_spoofing"))
    whale = ((F.col("buy_wall_usd") > F.col("sell_wall_usd") * C.WHALE_WALL_RATIO)
             | (F.col("sell_wall_usd") > F.col("buy_wall_usd") * C.WHALE_WALL_RATIO))
    per_sym = silver_rows.groupBy(day.alias("day"), "symbol").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(sig).alias("_sig"), F.count_if(whale).alias("_whale"))
    market = per_sym.groupBy("day").agg(
        F.sum("_sig").alias("total_signals"), F.sum("_whale").alias("whale_events"),
        F.min_by("symbol", F.struct(-F.col("_n"), F.col("symbol"))).alias("top_symbol"))
    models = children.groupBy(trunc_time("day", "start_time").alias("day")).agg(
        F.count(F.lit(1)).alias("ml_update_count"),
        F.min_by("model_name", F.struct("rmse", "run_id")).alias("champion_model"),
        F.min_by("r2", F.struct("rmse", "run_id")).alias("champion_r2"))
    digest = market.join(models, "day", "full")
    if spreads is not None:
        digest = digest.join(spreads, "day", "full")
    return digest.na.fill(0, ["total_signals", "whale_events", "ml_update_count"])


def free_panel(ticks: DataFrame, price: str = "price", time_col: str = "ts") -> DataFrame:
    """24 h average / high / low and the price as of one minute ago, per symbol.

    'Now' is the newest tick; one aggregate with conditional inputs (no self-join).
    """
    from quantsilo.plans.joins import with_stats
    t = with_stats(ticks, ticks.agg(F.max(time_col).alias("_now")))
    recent = F.col(time_col) > F.col("_now") - F.expr("INTERVAL 24 HOURS")
    delayed = F.col(time_col) <= F.col("_now") - F.expr("INTERVAL 1 MINUTE")
    return t.groupBy("symbol").agg(
        F.avg(F.when(recent, F.col(price))).alias("avg_p"), F.max(F.when(recent, F.col(price))).alias("max_p"),
        F.min(F.when(recent, F.col(price))).alias("min_p"),
        F.max_by(price, F.when(delayed, F.struct(time_col, "event_id"))).alias("delayed_price"))
