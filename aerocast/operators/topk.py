"""Grouped top-k (O2): the first ``n`` rows of every group in a fixed order.

Used on monthly tables, whose groups are bounded by the number of months of a
key (never by the number of daily readings), so a group always fits a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_group(df: DataFrame, group_cols, order_cols, n: int) -> DataFrame:
    """Rows with ``row_number() <= n`` over ``partitionBy(group_cols).orderBy(order_cols)``.

    The order must be total within a group (D4: year, then month) so the cut is
    reproducible.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
