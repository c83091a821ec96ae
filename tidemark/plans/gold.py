"""One build of all layers for one input folder; each table is made once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import dims, facts, marts, staging
from tidemark.session import configure, stage
from tidemark.sources import fixtures

class Build:
    """raw -> staging -> dimensions -> facts -> aggregates (dependency order)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    # Staging feeds two to five gold models.  Payments carry the product of
    # each order (lineitem x part, aggregated), the heaviest step of the
    # build: they are written once and read by every model.  Customers and
    # sessions are narrow derivations that each reader re-derives with only
    # the columns it needs (Parquet column pruning).
    @cached_property
    def _stg_payments(self) -> DataFrame:
        return stage(self.stg_payments, "stg_payments")

    @property
    def _stg_customers(self) -> DataFrame:
        return self.stg_customers

    @property
    def _stg_sessions(self) -> DataFrame:
        return self.stg_sessions

    # raw
    @cached_property
    def raw_customers(self) -> DataFrame:
        return fixtures.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def raw_payments(self) -> DataFrame:
        return fixtures.raw_payments(self.spark, self.sf_dir)

    @cached_property
    def raw_sessions(self) -> DataFrame:
        return fixtures.raw_sessions(self.spark, self.sf_dir)

    # staging
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw_payments)

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stg_sessions(self.raw_sessions)

    # Members of the small dimensions: one grouping-sets pass per table,
    # materialised once (small) and read by every dimension.
    @cached_property
    def _pay_members(self) -> DataFrame:
        return dims.payment_members(self._stg_payments).checkpoint()

    @cached_property
    def _ses_members(self) -> DataFrame:
        return dims.session_members(self._stg_sessions).checkpoint()

    # dimensions
    @cached_property
    def dim_country(self) -> DataFrame:
        return dims.dim_country(self._stg_customers, self._stg_payments, self._stg_sessions,
                                self._pay_members, self._ses_members)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self._stg_customers)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self._stg_payments, self._stg_sessions, self._pay_members, self._ses_members)

    @cached_property
    def dim_device(self) -> DataFrame:
        return dims.dim_device(self._stg_sessions, self._ses_members)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self._stg_payments, self._pay_members)

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return dims.dim_campaign(self._stg_sessions, self._ses_members)

    # facts
    @cached_property
    def fact_payments(self) -> DataFrame:
        return facts.fact_payments(self._stg_payments, self.dim_customer, self.dim_product,
                                   self.dim_country, self.dim_date)

    @cached_property
    def fact_sessions(self) -> DataFrame:
        return facts.fact_sessions(self._stg_sessions, self.dim_customer, self.dim_country,
                                   self.dim_device, self.dim_campaign, self.dim_date)

    # aggregates
    @cached_property
    def agg_payments_daily(self) -> DataFrame:
        return marts.agg_payments_daily(self.fact_payments)

    @cached_property
    def agg_sessions_daily(self) -> DataFrame:
        return marts.agg_sessions_daily(self.fact_sessions)

    @cached_property
    def agg_customer_summary(self) -> DataFrame:
        return marts.agg_customer_summary(self.dim_customer, self._stg_payments, self._stg_sessions)

    @cached_property
    def agg_customer_summary_fanout(self) -> DataFrame:
        return marts.agg_customer_summary(self.dim_customer, self._stg_payments, self._stg_sessions, fanout=True)


MODEL_NAMES = [
    "raw_customers", "raw_payments", "raw_sessions",
    "stg_customers", "stg_payments", "stg_sessions",
    "dim_country", "dim_customer", "dim_date", "dim_device", "dim_product", "dim_campaign",
    "fact_payments", "fact_sessions",
    "agg_payments_daily", "agg_sessions_daily", "agg_customer_summary", "agg_customer_summary_fanout",
]
