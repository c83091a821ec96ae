"""Plain forms that the distributed operators are checked against."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def dense_rank_key(df, order_cols, key):
    """``dense_rank() over (order by ...)`` in one task, missing values last."""
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return df.select(F.dense_rank().over(w).cast("bigint").alias(key), *df.columns)
