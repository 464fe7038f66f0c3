"""Silver layer: per-symbol sliding-window order-flow metrics and anomaly flags.

A1-A5 are one hash aggregate keyed by (window, symbol) with partial
(map-side) aggregation; every "last value" is a ``max_by`` over the total
order ``(ts, event_id)`` so results are deterministic.  W12-W13 look back 30
windows per symbol through ``plans.ordered.rolling`` so a hot symbol is
split into bounded blocks instead of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from quantsilo import config as C
from quantsilo.plans import ordered

# The 14-field tick message
TICK_SCHEMA = (StructType()
               .add("symbol", StringType()).add("price", DoubleType()).add("quantity", DoubleType())
               .add("volume_usd", DoubleType()).add("is_buyer_maker", BooleanType())
               .add("trade_side", StringType()).add("buy_wall_usd", DoubleType())
               .add("sell_wall_usd", DoubleType()).add("imbalance_ratio", DoubleType())
               .add("mark_price", DoubleType()).add("funding_rate", DoubleType())
               .add("liq_buy_usd", DoubleType()).add("liq_sell_usd", DoubleType())
               .add("timestamp", StringType()))

# The 29-column silver row (M1 output)
SILVER_COLUMNS = [
    "symbol", "average_price", "volume_usd", "is_buyer_maker", "trade_side", "processed_time",
    "volatility", "predicted_price", "cvd", "buy_wall_usd", "sell_wall_usd", "imbalance_ratio",
    "mark_price", "funding_rate", "liq_buy_usd", "liq_sell_usd", "vpin_score", "wall_imbalance",
    "liq_up_10x", "liq_dn_10x", "liq_up_25x", "liq_dn_25x", "liq_up_50x", "liq_dn_50x",
    "liq_up_100x", "liq_dn_100x", "anomaly_wash_trading", "anomaly_spoofing", "anomaly_score",
]

LAST_COLUMNS = ["is_buyer_maker", "trade_side", "buy_wall_usd", "sell_wall_usd",
                "imbalance_ratio", "mark_price", "funding_rate"]


def parse_ticks(raw: DataFrame, value_col: str = "value", event_time: bool = True) -> DataFrame:
    """JSON payload -> the tick columns that ``window_metrics`` takes.

    With ``event_time`` the ISO ``timestamp`` field becomes the event time;
    otherwise arrival time is used, as the reference does.  ``event_id``, the
    order of ticks of one instant, is the broker's (partition, offset); records
    without them (bronze rows) are ordered by their payload.
    """
    broker = [c for c in ("partition", "offset") if c in raw.columns]
    payload = F.col(value_col).cast("string")
    tie = F.struct(*broker) if len(broker) == 2 else F.struct(payload.alias("payload"))
    flat = raw.select(F.from_json(payload, TICK_SCHEMA).alias("v"), tie.alias("event_id")).select("v.*", "event_id")
    ts = F.to_timestamp("timestamp") if event_time else F.current_timestamp()
    return flat.withColumn("ts", ts.cast("timestamp_ntz")).drop("timestamp")


def signed_volume(df: DataFrame, side: str = "trade_side", volume: str = "volume_usd") -> DataFrame:
    """+volume for BUY, -volume otherwise (NULL side counts as a sell)."""
    return df.withColumn("volume_delta", F.when(F.col(side) == "BUY", F.col(volume))
                         .otherwise(-F.col(volume)))


def window_metrics(ticks: DataFrame, window: str = C.SILVER_WINDOW, slide: str = C.SILVER_SLIDE,
                   price: str = "price", time_col: str = "ts", tie: str = "event_id") -> DataFrame:
    """A1-A5 (+P4): sliding-window aggregate per symbol.

    Output: window_start, window_end, symbol, average_price, volatility (population),
    volume_usd, cvd, vpin_score, wall_imbalance, the 7 last-value columns,
    liq_buy_usd, liq_sell_usd, processed_time (time of the window's last tick).
    """
    d = signed_volume(ticks)
    order = F.struct(F.col(time_col), F.col(tie))
    last = F.max_by(F.struct(*[F.col(c) for c in LAST_COLUMNS]), order)
    agg = (d.groupBy(F.window(time_col, window, slide).alias("w"), "symbol")
           .agg(F.avg(price).alias("average_price"),
                F.stddev_pop(price).alias("volatility"),
                F.sum("volume_usd").alias("volume_usd"),
                F.sum("volume_delta").alias("cvd"),
                last.alias("_last"),
                F.sum("liq_buy_usd").alias("liq_buy_usd"),
                F.sum("liq_sell_usd").alias("liq_sell_usd"),
                F.max(time_col).alias("processed_time")))
    out = agg.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol",
        "average_price", "volatility", "volume_usd", "cvd",
        (F.abs(F.col("cvd")) / (F.col("volume_usd") + 1)).alias("vpin_score"),
        (F.col("_last.buy_wall_usd") / (F.col("_last.sell_wall_usd") + 1)).alias("wall_imbalance"),
        *[F.col(f"_last.{c}").alias(c) for c in LAST_COLUMNS],
        "liq_buy_usd", "liq_sell_usd", "processed_time")
    return fill_numeric(out, 0.0)


def fill_numeric(df: DataFrame, value: float = 0.0) -> DataFrame:
    """NULL numerics -> value."""
    return df.na.fill(value)


def liquidation_bands(df: DataFrame, price: str = "average_price", bands=C.LIQ_BANDS) -> DataFrame:
    """Liquidation price levels for each leverage, up and down."""
    cols = []
    for lev, frac in bands:
        cols.append((F.col(price) * (1 + frac)).alias(f"liq_up_{lev}x"))
        cols.append((F.col(price) * (1 - frac)).alias(f"liq_dn_{lev}x"))
    return df.select("*", *cols)


def anomaly_flags(windows: DataFrame, key: str = "symbol", order: str = "window_start",
                  volume: str = "volume_usd", imbalance: str = "wall_imbalance",
                  history: int = C.ANOMALY_HISTORY, min_rows: int = C.ANOMALY_MIN_ROWS,
                  z: float = C.ANOMALY_Z, eps: float = C.ANOMALY_EPS,
                  block_rows: int = ordered.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Z-scores against the last ``history`` windows (current included).

    Population std + eps; flags need more than five rows of history.
    wash = vol_z > z; spoof = |imb_z| > z and volume < half the mean; score = max |z|.
    """
    df = ordered.arrange(windows, [key], [order], block_rows)

    def build(w):
        f = w.rowsBetween(-(history - 1), 0)
        return [F.count(F.lit(1)).over(f).alias("_n"),
                F.avg(volume).over(f).alias("_vm"), F.stddev_pop(volume).over(f).alias("_vs"),
                F.avg(imbalance).over(f).alias("_im"), F.stddev_pop(imbalance).over(f).alias("_is")]

    r = ordered.rolling(df, build, lookback=history - 1)
    vol_z = (F.col(volume) - F.col("_vm")) / (F.col("_vs") + eps)
    imb_z = (F.col(imbalance) - F.col("_im")) / (F.col("_is") + eps)
    enough = F.col("_n") >= min_rows
    r = r.select("*", vol_z.alias("_vz"), imb_z.alias("_iz"))
    return (r.withColumn("anomaly_wash_trading", F.when(enough, F.col("_vz") > z).otherwise(F.lit(False)))
            .withColumn("anomaly_spoofing",
                        F.when(enough, (F.abs(F.col("_iz")) > z) & (F.col(volume) < F.col("_vm") * C.SPOOF_VOLUME_FRACTION))
                        .otherwise(F.lit(False)))
            .withColumn("anomaly_score",
                        F.when(enough, F.greatest(F.abs(F.col("_vz")), F.abs(F.col("_iz")))).otherwise(F.lit(0.0)))
            .drop("_n", "_vm", "_vs", "_im", "_is", "_vz", "_iz", *ordered.HELPERS))


def silver(ticks: DataFrame, predictions: DataFrame | None = None, **kw) -> DataFrame:
    """M1 as native columns: windows -> prediction (M5 fallback) -> bands -> anomalies.

    ``predictions`` (optional) holds (symbol, window_start, predicted_price);
    without a model the prediction is the window's own average price.
    """
    w = window_metrics(ticks, **kw)
    if predictions is not None:
        w = (w.join(predictions, ["symbol", "window_start"], "left")
             .withColumn("predicted_price", F.coalesce("predicted_price", "average_price")))
    else:
        w = w.withColumn("predicted_price", F.col("average_price"))
    w = liquidation_bands(w)
    w = anomaly_flags(w)
    return w.select("window_start", "window_end", *SILVER_COLUMNS)


SERVING_DROP = ["liq_up_10x", "liq_dn_10x", "liq_up_25x", "liq_dn_25x", "liq_up_50x", "liq_dn_50x",
                "liq_up_100x", "liq_dn_100x", "anomaly_wash_trading", "anomaly_spoofing", "anomaly_score"]


def serving_projection(silver_df: DataFrame) -> DataFrame:
    """The serving table keeps 18 columns (bands and anomaly columns dropped)."""
    return silver_df.drop(*SERVING_DROP)
