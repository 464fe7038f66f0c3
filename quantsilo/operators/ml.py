"""Per-symbol model league, scoring and metrics.

The reference trains three boosting regressors per symbol on one machine.
Those libraries are not available here, so the league uses ``pyspark.ml``
estimators (gradient-boosted trees, random forest, linear regression) on the
same seven features and the same chronological 80/20 split.  Each fit is a
distributed job over one symbol's rows; the driver only iterates over the
(small) list of symbols that passed the row-count gate (A18).

Metrics (A27) are SQL aggregates - RMSE and R2 for every (symbol, model) in
one pass - not per-model driver loops.

Batch scoring (M5) holds models as rows: linear ones come from one aggregate
over all symbols, and one join scores every row.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.plans import ordered, topk
from quantsilo.plans.joins import broadcast_if_small
from quantsilo.session import ensure_checkpoint_dir

FEATURES = ["volatility", "lag_1", "lag_3", "ma_5", "ma_10", "momentum", "volatility_change"]
TARGET = "target_price"
#: Rows of a symbol that one task of a fit takes, about.
FIT_ROWS = 50_000


def league_estimators(seed: int = 42) -> dict:
    """The three contenders (names follow the reference's league)."""
    return {
        "GBT_Boost": GBTRegressor(featuresCol="features", labelCol=TARGET, maxIter=100, stepSize=0.05,
                                  maxDepth=5, seed=seed),
        "RandomForest_Fast": RandomForestRegressor(featuresCol="features", labelCol=TARGET, numTrees=100,
                                                   maxDepth=5, seed=seed),
        "Linear_Base": LinearRegression(featuresCol="features", labelCol=TARGET),
    }


def regression_metrics(pred: DataFrame, keys: list[str], label: str = TARGET,
                       prediction: str = "prediction") -> DataFrame:
    """RMSE and R2 per key in one aggregate: sqrt(mean sq err), 1 - SS_res / SS_tot.

    SS_tot comes from the variance, whose centred sums do not cancel for large labels.
    """
    err = F.col(label) - F.col(prediction)
    agg = pred.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("_mse"), F.var_pop(label).alias("_var"))
    return agg.select(*keys, "n", F.sqrt("_mse").alias("rmse"),
                      (F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"))


def train_league(split_features: DataFrame, symbols: list[str], estimators: dict | None = None,
                 parallelism: int = 8, fit_rows: int = FIT_ROWS):
    """M4: fit every contender per symbol on training rows, score the test rows.

    The features are computed once into the shared folder.  A fit is many small jobs (boosting has one for
    each level of each tree), so a symbol's rows are checkpointed in as many partitions as they need, one for
    each ``fit_rows``: a job has no tasks over other symbols' rows or over none, and its tasks carry no plan.
    The (symbol, model) fits are submitted concurrently so the cluster runs several training jobs at a time.
    Returns (runs, models): runs = (symbol, model_name, n, rmse, r2, is_winner) (M6), models =
    {(symbol, model_name): fitted model}.
    """
    estimators = estimators or league_estimators()
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    ensure_checkpoint_dir(split_features.sparkSession)
    stored = ordered.stored(split_features.select("symbol", "is_train", *FEATURES, TARGET))
    sizes = {r["symbol"]: r["count"] for r in stored.where(F.col("symbol").isin(symbols)).groupBy("symbol").count().collect()}
    data = {}
    for sym in symbols:
        parts = -(-sizes.get(sym, 1) // fit_rows)
        data[sym] = (assembler.transform(stored.where(F.col("symbol") == sym).coalesce(parts))
                     .select("symbol", "is_train", "features", TARGET).checkpoint())

    def fit(job):
        sym, name = job
        rows = data[sym]
        m = estimators[name].copy().fit(rows.filter("is_train"))
        pred = m.transform(rows.filter("NOT is_train")).select(
            "symbol", F.lit(name).alias("model_name"), TARGET, "prediction")
        return (sym, name), m, pred

    jobs = [(s, n) for n in estimators for s in symbols]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(fit, jobs))
    models = {k: m for k, m, _ in done}
    preds = [p for _, _, p in done]
    if not preds:
        return None, models
    scored = reduce(DataFrame.unionByName, preds)
    runs = regression_metrics(scored, ["symbol", "model_name"])
    best = topk.top_k_per_key(runs, ["symbol"], ["rmse", "model_name"], 1).select(
        "symbol", F.col("model_name").alias("_w"))
    runs = (runs.join(best, "symbol").withColumn("is_winner", F.col("model_name") == F.col("_w")).drop("_w"))
    return runs, models


# ------------------------------------------------------------ models as rows ----
def _moment(i: int, j: int) -> str:
    return f"_c{i}_{j}"


def fit_linear(rows: DataFrame, features: list[str], target: str = TARGET, key: str = "symbol",
               minimum: int = C.MIN_ROWS_PER_SYMBOL) -> DataFrame:
    """One least-squares model a key, as a row: (key, n, intercept, coefficients in the order of ``features``).

    All covariances come from one aggregate over rows without nulls (map-side combined, so a hot key is
    no hot task); the normal equations of a key are solved on its one summary row.  Keys with ``minimum``
    rows or fewer, or with dependent features, have no model.
    """
    cols = [*features, target]
    known = rows.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k + 1)]
    sums = known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(cols[i], cols[j]).alias(_moment(i, j)) for i, j in pairs]).filter(F.col("n") > minimum)
    kind = sums.schema[key].dataType.simpleString()

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                gram = np.array([[r[_moment(min(i, j), max(i, j))] for j in range(k)] for i in range(k)])
                scale = np.sqrt(np.diag(gram))
                if not (scale > 0).all():
                    continue
                unit = gram / np.outer(scale, scale)
                if np.linalg.cond(unit) > 1e10:
                    continue
                b = np.linalg.solve(unit, np.array([r[_moment(i, k)] for i in range(k)]) / scale) / scale
                out.append((r[key], r["n"], float(r[f"_m{k}"] - b @ [r[f"_m{i}"] for i in range(k)]), b.tolist()))
            yield pd.DataFrame(out, columns=[key, "n", "intercept", "coefficients"])

    return sums.mapInPandas(solve, f"`{key}` {kind}, n long, intercept double, coefficients array<double>")


def score_linear(rows: DataFrame, models: DataFrame, features: list[str], key: str = "symbol",
                 price: str = "average_price", out: str = "predicted_price") -> DataFrame:
    """M5: every row's prediction by its key's model in one pass; the price where there is no model or a feature is null.

    Models are joined as rows (``broadcast_if_small``), so their number does not change the plan.
    """
    m = models.select(F.col(key).alias("_key"), "intercept", "coefficients")
    x = F.array(*[F.col(f).cast("double") for f in features])
    hit = F.aggregate(F.zip_with(x, "coefficients", lambda a, b: a * b), F.col("intercept"), lambda s, v: s + v)
    return (rows.join(broadcast_if_small(m), rows[key] == m["_key"], "left")
            .withColumn(out, F.round(F.coalesce(hit, F.col(price)), 5)).drop("_key", "intercept", "coefficients"))
