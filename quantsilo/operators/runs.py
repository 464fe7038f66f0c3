"""Model-run analytics.

Global leaderboard ranks are the ordinals of ``plans.ordered.arrange``: sampled range
partitions, sorted, with the sizes of the partitions before; no window without a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.functions.scalar import display_name, duration_ms, to_number
from quantsilo.plans import ordered, topk
from quantsilo.plans.joins import with_stats

# Badge texts shown on the leaderboard (fixed values)
BADGE_CHAMPION = "🏆 ŞAMPİYON"
BADGE_FASTEST = "⚡ EN HIZLI"
BADGE_PRECISE = "💎 HASSAS"


def child_runs(runs: DataFrame) -> DataFrame:
    """J6 + F6 + F7 + F8: children joined to their parent's symbol; orphans dropped."""
    parents = runs.filter(F.col("parent_run_id").isNull()).select(
        F.col("run_id").alias("parent_run_id"), F.col("symbol").alias("coin_folder"))
    children = runs.filter(F.col("parent_run_id").isNotNull()).drop("symbol")
    c = children.join(parents, "parent_run_id")       # parents: one per symbol, AQE broadcasts
    return c.select(
        "run_id", "parent_run_id", "coin_folder",
        to_number("rmse", C.RMSE_MISSING).alias("rmse"),
        to_number("r2", 0.0).alias("r2"),
        duration_ms("start_time", "end_time").alias("duration_ms"),
        display_name("run_name").alias("model_name"),
        "start_time")


def folder_champions(children: DataFrame) -> DataFrame:
    """Best (lowest RMSE, then run id) model per symbol folder."""
    return topk.top_k_per_key(children, ["coin_folder"], ["rmse", "run_id"], 1)


def folder_ranks(children: DataFrame, k: int | None = None) -> DataFrame:
    """W14 per folder: rank by RMSE inside each symbol's folder, all rows or the best ``k``."""
    if k:
        return topk.top_k_per_key(children, ["coin_folder"], ["rmse", "run_id"], k, rank_col="folder_rank")
    ranked = ordered.sequence(ordered.arrange(children, ["coin_folder"], ["rmse", "run_id"]), "_seq")
    return ordered.drop_helpers(ranked.withColumn("folder_rank", (F.col("_seq") + 1).cast("int")).drop("_seq"))


def leaderboard(children: DataFrame) -> DataFrame:
    """W14 global rank by RMSE + W16 badges (champion, fastest, R2 above threshold).

    The rank is a row's place in the range-partitioned order plus the rows of the ranges before.
    """
    placed = ordered.arrange(children, [], ["rmse", "run_id"])
    ranked = ordered.drop_helpers(placed.withColumn("rank", F.col("_g") + 1))
    stats = placed.agg(F.min("duration_ms").alias("_fastest"))
    r = with_stats(ranked, stats)
    badges = F.concat_ws(" ",
                         F.when(F.col("rank") == 1, F.lit(BADGE_CHAMPION)),
                         F.when(F.col("duration_ms") == F.col("_fastest"), F.lit(BADGE_FASTEST)),
                         F.when(F.col("r2") > C.R2_BADGE, F.lit(BADGE_PRECISE)))
    return r.withColumn("badges", badges).drop("_fastest")
