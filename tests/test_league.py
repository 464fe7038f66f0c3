"""The model league: fits run over their own symbol's rows, in no more tasks than these need."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression

from quantsilo.operators import ml


@pytest.mark.parametrize("fit_rows,parts", [(50_000, 1), (40, 3)])
def test_league_fits_each_symbol_in_its_own_partitions(spark, monkeypatch, fit_rows, parts):
    rng = np.random.default_rng(1)
    rows = []
    for sym, w in (("a", 2.0), ("b", -1.0), ("c", 0.5)):
        for k in range(100):
            x = rng.normal(size=len(ml.FEATURES)).tolist()
            rows.append((sym, k < 80, *x, w * x[0] + 1))
    schema = "symbol string, is_train boolean, " + ", ".join(f"{c} double" for c in [*ml.FEATURES, ml.TARGET])
    df = spark.createDataFrame(rows, schema).repartition(32)
    seen = []

    class Fit:
        def copy(self):
            return self

        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), {r.symbol for r in train.select("symbol").distinct().collect()}))
            return LinearRegression(featuresCol="features", labelCol=ml.TARGET).fit(train)

    runs, models = ml.train_league(df, ["a", "b"], {"one": Fit()}, fit_rows=fit_rows)
    assert sorted(models) == [("a", "one"), ("b", "one")]
    assert [s for _, s in sorted(seen, key=lambda x: min(x[1]))] == [{"a"}, {"b"}]
    assert max(n for n, _ in seen) <= parts
    got = {r.symbol: r for r in runs.collect()}
    assert {s: r.n for s, r in got.items()} == {"a": 20, "b": 20}
    assert all(r.rmse < 1e-6 and r.is_winner for r in got.values())
