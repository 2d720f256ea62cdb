"""Regression trees and boosted trees, one model a group (M3-M5), all groups in one shuffle.

A group is the monthly series of a region and a name, so its rows are bounded by the months observed, never by the
daily readings: Spark deals the groups out, and a small numpy function grows each group's trees where its rows are. Rows to be
forecast carry no label and go down the same trees.

Features are cut into at most ``BINS`` bins, halfway between distinct values (equal numbers of distinct values in each bin where
there are more). Trees grow level by level from counts and sums of the labels in each bin; ties go to the first feature, then
the first bin. Sums are in fixed point and exact, so the order of the rows does not matter. Boosting is for squared error:
the first tree fits the labels, each further one twice the residuals, shrunk by ``STEP``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import FIXED_STEPS

BINS, DEPTH, TREES, STEP = 32, 5, 20, 0.1


def cut_points(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Ascending thresholds between the distinct ``values``, ``bins - 1`` at most."""
    v = np.unique(values)
    steps = min(len(v), bins)
    at = np.arange(1, steps) * len(v) // max(steps, 1)
    return (v[at - 1] + v[at]) / 2


def best_split(bins: np.ndarray, target: np.ndarray) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of a node's rows; gain 0 if there is none.

    ``target`` holds whole numbers. The gain ``n_l n_r (mean_l - mean_r)^2 / n`` comes from an exact difference.
    """
    n, total, best = len(target), target.sum(), (0.0, 0, 0)
    for f in range(bins.shape[1]):
        held, place = np.unique(bins[:, f], return_inverse=True)
        sums = np.zeros(len(held), dtype=target.dtype)
        np.add.at(sums, place, target)
        left, nl = np.cumsum(sums)[:-1], np.cumsum(np.bincount(place))[:-1]
        apart = (left * (n - nl) - (total - left) * nl).astype(float)
        gain = apart * apart / (nl.astype(float) * (n - nl) * n)
        if len(gain) and gain.max() > best[0]:
            best = float(gain.max()), f, int(held[gain.argmax()])
    return best


def grown(bins: np.ndarray, target: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """The mean target of each row's leaf; only ``known`` rows shape the tree."""
    node = np.ones(len(bins), dtype=np.int64)
    for _ in range(depth):
        for name in np.unique(node[known]):
            here = node == name
            gain, f, b = best_split(bins[here & known], target[here & known])
            if gain > 0:
                node[here] = 2 * name + (bins[here, f] > b)
    value = np.zeros(len(bins))
    for name in np.unique(node[known]):
        own = target[(node == name) & known]
        value[node == name] = float(int(own.sum())) / (len(own) * float(FIXED_STEPS))
    return value


def predictions(x: np.ndarray, y: np.ndarray, trees: int, depth: int, step: float, bins: int) -> np.ndarray:
    """Predictions for all rows; rows whose ``y`` is not a number have no say in them."""
    known = ~np.isnan(y)
    binned = np.column_stack([np.searchsorted(cut_points(c[known], bins), c, side="left") for c in x.T])
    out = np.zeros(len(y))
    for t in range(trees):
        wanted = np.where(known, y if t == 0 else 2.0 * (y - out), 0.0)
        target = np.floor(wanted * FIXED_STEPS + 0.5)
        # whole numbers of any size where products of sums and counts might pass 64 bits
        exact = target.astype(np.int64) if np.abs(target).max() * len(y) ** 2 < 2.0 ** 61 else np.array([int(v) for v in target], dtype=object)
        out = out + (1.0 if t == 0 else step) * grown(binned, exact, known, depth)
    return out


def fit_and_forecast(train: DataFrame, score: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], features: Sequence[str],
                     label: str, trees: int = TREES, depth: int = DEPTH, step: float = STEP, bins: int = BINS, fitted: bool = False) -> DataFrame:
    """``group_cols, year, month, prediction`` of each group of ``train`` at the rows of ``score`` with its ``key_cols``.

    ``trees=1`` is a single decision tree. ``fitted`` adds the training rows' own values, with ``_label`` (null elsewhere).
    Rows lacking a feature, the label or a key are left out; a group without training rows gets no forecast.
    """
    xs = [f"_x{i}" for i in range(len(features))]
    columns = ["year", "month", *[F.col(c).cast("double").alias(x) for c, x in zip(features, xs, strict=True)]]
    own = train.select(*group_cols, *columns, F.col(label).cast("double").alias("_label")).dropna()
    ahead = score.select(*key_cols, *columns).dropna().join(own.select(*group_cols).distinct(), list(key_cols))
    rows = own.unionByName(ahead.withColumn("_label", F.lit(None).cast("double")))
    out_cols = [*group_cols, "year", "month", "prediction", "_label"]

    def one(group: pd.DataFrame) -> pd.DataFrame:
        value = predictions(group[xs].to_numpy(float), group["_label"].to_numpy(float), trees, depth, step, bins)
        return group.assign(prediction=value)[out_cols]

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields} | {"prediction": "double"}
    out = rows.groupBy(*group_cols).applyInPandas(one, ", ".join(f"`{c}` {types[c]}" for c in out_cols))
    return out if fitted else out.where("_label IS NULL").drop("_label")
