"""Approximate distinct customers from mergeable sketches (opt-in).

``marts.agg_payments_daily`` counts distinct customers exactly, which cannot be added up: a month is no
sum of its days.  A sketch per day, product and country (HyperLogLog, Spark's own) is stored once; sketches of any
days are merged into one and give the month's or the country's customers without reading a fact again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the sketch's registers: the standard error is 0.8 % (1.04 / sqrt(2^14)), a sketch at most 16 kB.
LG_REGISTERS = 14
STANDARD_ERROR = 1.04 / (1 << LG_REGISTERS) ** 0.5


def customer_sketches(payments: DataFrame, group: list[str], customer: str = "customer_id", lg: int = LG_REGISTERS) -> DataFrame:
    """One sketch of the customers per group (NULL customers are nobody); a group without any has an empty sketch."""
    return payments.groupBy(*group).agg(F.hll_sketch_agg(F.col(customer), F.lit(lg)).alias("customers"))


def merged(sketches: DataFrame, group: list[str | Column]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*group).agg(F.hll_union_agg("customers", F.lit(False)).alias("customers"))


def estimated(sketches: DataFrame, name: str = "active_customers") -> DataFrame:
    """Customers by each sketch's registers alone: a sketch that was never merged also keeps an estimate that depends
    on the order of its rows, which a union gives up."""
    return sketches.select(*[c for c in sketches.columns if c != "customers"], F.hll_sketch_estimate(F.hll_union("customers", "customers")).alias(name))
