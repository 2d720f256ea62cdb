"""Model-based forecasts with ``pyspark.ml`` (M1-M5, C2/C4 model forms).

One model per target (pollutant or weather variable), fitted on every key at
once. The key enters as the mean label of its training rows, a feature of
bounded size from one aggregation, so work and bin counts scale with the data and not with
the number of keys. Keys without training rows get no forecast.

Training tables are monthly aggregates (bounded by keys × months), cut from
their lineage with a reliable ``checkpoint()`` before fitting, so losing an
executor during the many fitting jobs never re-scans the daily tables.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session

ESTIMATORS = {
    "gbt": GBTRegressor,
    "rf": RandomForestRegressor,
    "dt": DecisionTreeRegressor,
    "linear": LinearRegression,
}


def estimator(kind: str, label: str, pred: str, features: str = "features"):
    """Spark ML defaults (20 trees, depth 5, step 0.1 for GBT, 32 bins; the estimators'
    default seeds, which are fixed, so fits are reproducible), as in the source."""
    return ESTIMATORS[kind](featuresCol=features, labelCol=label, predictionCol=pred)


def stable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (``spark.checkpoint.dir``); AQE sizes its partitions."""
    session.shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def training_frame(train: DataFrame, name_col: str, key_cols, feature_cols, label_col: str = "value") -> DataFrame:
    """The columns a fit needs, label as ``_label``, rows with a missing value dropped."""
    return train.select(name_col, *key_cols, *[c for c in feature_cols if c not in key_cols],
                        F.col(label_col).cast("double").alias("_label")).dropna()


def _no_forecast(score: DataFrame, mine: DataFrame, name, name_col: str, key_cols, pred_col: str) -> DataFrame:
    """The result of a name without training rows: the columns of a forecast, no row."""
    return score.join(mine, list(key_cols)).select(F.lit(name).alias(name_col), *key_cols, "year", "month",
                                                   F.lit(None).cast("double").alias(pred_col))


def pooled_forecast(train: DataFrame, score: DataFrame, name_col: str, names, key_cols, feature_cols,
                    label_col: str = "value", kind: str = "gbt", pred_col: str = "prediction",
                    parallelism: int = 6, prepared: bool = False) -> DataFrame:
    """One pooled model per name; returns (name, keys, year, month, prediction).

    ``prepared``: ``train`` is already ``stable(training_frame(...))``, and ``score`` is stored.
    """
    if not prepared:
        train, score = stable(training_frame(train, name_col, key_cols, feature_cols, label_col)), stable(score)
    feats = [c for c in feature_cols if c not in key_cols]
    # one row per (name, key): the key's feature, and the pairs that may be forecast
    means = stable(train.groupBy(name_col, *key_cols).agg(F.avg("_label").alias("_key_mean")))

    def fit_one(n):
        mine = means.where(F.col(name_col) == F.lit(n)).drop(name_col)
        if mine.isEmpty():
            return _no_forecast(score, mine, n, name_col, key_cols, pred_col)
        # a fixed order of the (monthly) rows: bagging draws by partition and position
        t = (train.where(F.col(name_col) == F.lit(n)).join(mine, list(key_cols))
             .repartition(*key_cols).sortWithinPartitions(*key_cols, *feats, "_label"))
        s = (score.select(*key_cols, "year", "month", *[c for c in feats if c not in ("year", "month")])
             .join(mine, list(key_cols)))
        assemble = VectorAssembler(inputCols=["_key_mean", *feats], outputCol="features")
        model = Pipeline(stages=[assemble, estimator(kind, "_label", pred_col)]).fit(t)
        return (model.transform(s)
                .select(F.lit(n).alias(name_col), *key_cols, "year", "month", F.col(pred_col).cast("double")))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(names)))) as pool:
        parts = list(pool.map(fit_one, names))
    return reduce(DataFrame.unionByName, parts)


def within_linear_forecast(train: DataFrame, score: DataFrame, name_col: str, names, key_cols, feature_cols,
                           label_col: str = "value", pred_col: str = "prediction", prepared: bool = False) -> DataFrame:
    """One least-squares fit per name with an intercept for each key; returns (name, keys, year, month, prediction).

    The intercepts are taken out by centring label and features on their key's means, so a fit has as
    many coefficients as features, whatever the number of keys. ``prepared`` as in ``pooled_forecast``.
    """
    if not prepared:
        train, score = stable(training_frame(train, name_col, key_cols, feature_cols, label_col)), stable(score)
    feats = [c for c in feature_cols if c not in key_cols]
    means = stable(train.groupBy(name_col, *key_cols).agg(
        F.avg("_label").alias("_key_mean"), *[F.avg(c).alias(f"_mean_{c}") for c in feats]))
    centred = [(F.col(c).cast("double") - F.col(f"_mean_{c}")).alias(f"_c_{c}") for c in feats]
    assemble = VectorAssembler(inputCols=[f"_c_{c}" for c in feats], outputCol="features", handleInvalid="skip")

    def fit_one(n):
        mine = means.where(F.col(name_col) == F.lit(n)).drop(name_col)
        if mine.isEmpty():
            return _no_forecast(score, mine, n, name_col, key_cols, pred_col)
        t = train.where(F.col(name_col) == F.lit(n)).join(mine, list(key_cols)).select(
            (F.col("_label") - F.col("_key_mean")).alias("_label"), *centred)
        s = (score.where(F.col(name_col) == F.lit(n)) if name_col in score.columns else score).join(mine, list(key_cols))
        s = s.select(*key_cols, "year", "month", "_key_mean", *centred)
        fit = LinearRegression(labelCol="_label", predictionCol="_slope", fitIntercept=False, solver="normal")
        model = Pipeline(stages=[assemble, fit]).fit(t)
        return model.transform(s).select(F.lit(n).alias(name_col), *key_cols, "year", "month",
                                         (F.col("_key_mean") + F.col("_slope")).alias(pred_col))

    with ThreadPoolExecutor(max_workers=max(1, min(6, len(names)))) as pool:
        parts = list(pool.map(fit_one, names))
    return reduce(DataFrame.unionByName, parts)
