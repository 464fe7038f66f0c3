"""Gold summaries, staging projection, data tests and the quality gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo.functions.scalar import trunc_time
from quantsilo.plans import ordered
from quantsilo.sources import io


def minute_summary(market: DataFrame, price: str = "average_price",
                   time_col: str = "processed_time") -> DataFrame:
    """Per (symbol, minute): average / max / min price and row count."""
    return (market.groupBy("symbol", trunc_time("minute", time_col).alias("minute"))
            .agg(F.avg(price).alias("avg_price"), F.max(price).alias("max_price"),
                 F.min(price).alias("min_price"), F.count(F.lit(1)).alias("trade_count")))


def newest_first(summary: DataFrame, bucket: str = "minute", tie: str = "symbol") -> DataFrame:
    """Buckets with their place in the order newest first, ties by symbol (``position`` from 1)."""
    placed = ordered.arrange(summary, [], [F.col(bucket).desc(), F.col(tie)])
    return ordered.drop_helpers(placed.withColumn("position", F.col("_g") + 1))


def staging(market: DataFrame) -> DataFrame:
    """Staging view with the absolute prediction error."""
    return market.select(
        "symbol",
        F.col("average_price").alias("current_price"),
        F.col("predicted_price").alias("ai_prediction"),
        F.abs(F.col("average_price") - F.col("predicted_price")).alias("prediction_error"),
        F.col("processed_time").alias("event_timestamp"))


def hourly_model_performance(stg: DataFrame) -> DataFrame:
    """Per (symbol, hour): mean actual, mean predicted, MAE, row count."""
    return (stg.groupBy("symbol", trunc_time("hour", "event_timestamp").alias("observation_hour"))
            .agg(F.avg("current_price").alias("avg_actual_price"),
                 F.avg("ai_prediction").alias("avg_predicted_price"),
                 F.avg("prediction_error").alias("mean_absolute_error"),
                 F.count(F.lit(1)).alias("tick_count")))


def not_null_tests(df: DataFrame, columns=("symbol", "processed_time")) -> DataFrame:
    """One aggregate pass; a row per tested column with its failure count."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'not_null_{c}', `{c}`" for c in columns)
    return (agg.selectExpr(f"stack({len(columns)}, {stack}) AS (test_name, failures)")
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))


def quality_report(silver: DataFrame, price: str = "average_price") -> DataFrame:
    """A20 + P14: all three rules in a single aggregate (one scan, partial aggregation).

    A non-positive price or a missing time fails the gate; missing volatility only warns.
    """
    agg = silver.agg(F.count(F.lit(1)).alias("total_rows"),
                     F.count_if(F.col(price) <= 0).alias("bad_prices"),
                     F.count_if(F.col("volatility").isNull()).alias("null_volatility"),
                     F.count_if(F.col("processed_time").isNull()).alias("null_time"))
    return agg.select(
        "*",
        F.when(F.col("bad_prices") > 0, "FAIL").otherwise("PASS").alias("price_check"),
        F.when(F.col("null_volatility") > 0, "WARN").otherwise("PASS").alias("volatility_check"),
        F.when(F.col("null_time") > 0, "FAIL").otherwise("PASS").alias("time_check"),
        F.when(F.col("total_rows") == 0, "EMPTY")
         .when((F.col("bad_prices") > 0) | (F.col("null_time") > 0), "FAILED")
         .otherwise("PASSED").alias("result"))


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A missing or empty table -> None (callers exit cleanly); any other failure of the read is raised."""
    df = io.read_if_there(spark, path, fmt)
    return None if df is None or df.isEmpty() else df
