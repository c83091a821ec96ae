"""Gold aggregates kept up to date from the changes of staging.

Staging tables are tables with a commit log, so what changed since a state was brought up to date
is known from the log: the rows that went and the rows that came.  Each state below is a keyed
log table of sums by natural keys; the changes, with weight -1 or +1, are added up by
key and only files that may hold one of these keys are rewritten.  A group whose count falls to zero
goes.  Every state's commit carries the versions that it has taken in, so a run stopped anywhere is
taken up by the next one, and nothing is counted twice.

* ``payers``: payments per (day, product, country) and customer;
* ``payments_daily``: sums per (day, product, country), and of its payers the number of known customers.  It follows
  the payers' own changes, and customers that became known or unknown since, whose payers are looked up by customer;
* ``sessions_daily``: sums and counts per (day, device, country), from which the averages follow;
* ``customer_payments``, ``customer_sessions``: totals per customer.  The latest session is a maximum, which cannot be
  taken back: customers that lost their latest session are looked up in staging again.

Surrogate keys change when a member is added, so they are joined on reading (``agg_*``), from the small
tables of groups; facts are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import left_join_dim
from tidemark.operators.tablelog import Change, Commit, LogTable
from tidemark.schemas import MONEY_SUM
from tidemark.session import stage

PAY_GROUP = ["order_day", "product", "country"]
SES_GROUP = ["session_day", "device", "country"]
DEFAULT_BUCKETS = 64


def group_key(cols: list[str]):
    """One text per group, NULLs included."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


class IncrementalGold:
    """The states under ``<root>/gold_state`` over the log tables ``<root>/staging/stg_*``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.staging = {e: LogTable(spark, f"{self.root}/staging/stg_{e}") for e in ("customers", "payments", "sessions")}

    def state(self, name: str, key: str) -> LogTable:
        return LogTable(self.spark, f"{self.root}/gold_state/{name}", key=key, buckets=self.buckets)

    def applied(self, table: LogTable, source: str) -> int:
        c = table.latest()
        return c.info.get("applied", {}).get(source, 0) if c else 0

    # --- bringing up to date -------------------------------------------------------
    def apply(self) -> dict[str, int]:
        """Takes in all changes of staging up to now; returns the number of keys touched in each state."""
        now = {e: c.version if (c := t.latest()) else 0 for e, t in self.staging.items()}
        self._found: dict = {}
        out = {"payers": self._payers(now), "payments_daily": self._payments_daily(now), "sessions_daily": self._sessions_daily(now),
               "customer_payments": self._customer_payments(now), "customer_sessions": self._customer_sessions(now)}
        self._found = {}
        return out

    def _changes(self, entity: str, since: int, until: int) -> DataFrame | None:
        """Weighted rows of a staging table between two versions, written once a run."""
        if since == until:
            return None
        if (entity, since, until) not in self._found:
            got = self.staging[entity].changes(since, until)
            self._found[entity, since, until] = stage(got, f"changes-{entity}") if got is not None else None
        return self._found[entity, since, until]

    def _add(self, table: LogTable, row_key: str, delta: DataFrame, keep: list[str], sums: dict[str, str], applied: dict,
             before: dict, maxima: list[str] | None = None) -> int:
        """Adds ``delta`` to the rows with its keys; rows whose ``n`` becomes zero go.  Nothing happens where the
        state is not at ``before`` any more (another run took the changes in)."""
        delta = stage(delta, "delta")
        cols = [F.col(c) for c in keep]
        value = [F.sum(c).cast(t).alias(c) for c, t in sums.items()] + [F.max(c).alias(c) for c in maxima or []]

        def build(state: Commit | None) -> Change | None:
            at = state.info.get("applied", {}) if state else {}
            if any(at.get(k, 0) != v for k, v in before.items()):
                return None
            schema = state.schema if state else delta.schema
            met = table.may_hold(delta, state)
            rows = delta.select(*schema.names)
            touched = delta.select(row_key).distinct()
            if met:
                rows = rows.unionByName(table.read_files(met, schema))
            summed = rows.groupBy(row_key, *cols).agg(*value).where(F.col("n") != 0).select(*[F.col(f.name).cast(f.dataType) for f in schema])
            return Change("add", schema, table.write_rows(summed), met, info={"applied": {**at, **applied}}, result=touched.count())

        done = table.commit(build)
        return done.result if done else 0

    def _payers(self, now: dict) -> int:
        table = self.state("payers", "customer_id")
        since = self.applied(table, "payments")
        delta = self._changes("payments", since, now["payments"])
        if delta is None:
            return 0
        rows = (delta.where(F.col("customer_id").isNotNull()).withColumn("gid", group_key(PAY_GROUP))
                .groupBy("gid", "customer_id").agg(F.sum("_weight").cast("long").alias("n")).where("n <> 0")
                .select(F.to_json(F.struct("customer_id", "gid")).alias("pid"), "customer_id", "gid", "n"))
        return self._add(table, "pid", rows, ["customer_id", "gid"], {"n": "long"}, {"payments": now["payments"]}, {"payments": since})

    def _payments_daily(self, now: dict) -> int:
        table, payers, customers = self.state("payments_daily", "gid"), self.state("payers", "customer_id"), self.staging["customers"]
        at = payers.latest()
        until = {"payments": now["payments"], "customers": now["customers"], "payers": at.version if at else 0}
        since = {k: self.applied(table, k) for k in until}
        if since == until:
            return 0
        schema = ("gid string, order_day date, product string, country string, n long, "
                  "revenue decimal(28,2), amount decimal(28,2), active long")
        parts = [self.spark.createDataFrame([], schema)]
        delta = self._changes("payments", since["payments"], until["payments"])
        if delta is not None:
            w = F.col("_weight")
            parts.append(delta.withColumn("gid", group_key(PAY_GROUP)).groupBy("gid", *PAY_GROUP).agg(
                F.sum(w).cast("long").alias("n"), F.sum(F.coalesce(F.col("net_revenue"), F.lit(0)) * w).cast(MONEY_SUM).alias("revenue"),
                F.sum(F.coalesce(F.col("amount"), F.lit(0)) * w).cast(MONEY_SUM).alias("amount"), F.lit(0).cast("long").alias("active")))
        moved = []
        met = payers.changes(since["payers"], until["payers"]) if until["payers"] != since["payers"] else None
        if met is not None and until["customers"]:
            known = customers.read(until["customers"]).select("customer_id")
            moved.append(met.where("n > 0").join(known, "customer_id", "left_semi").select("gid", F.col("_weight").alias("active")))
        other = self._changes("customers", since["customers"], until["customers"])
        if other is not None and since["payers"]:
            turned = other.groupBy("customer_id").agg(F.sum("_weight").cast("int").alias("turn")).where("turn <> 0")
            turned = stage(turned, "turned")
            old = payers.at(since["payers"])
            rows = payers.read_files(payers.may_hold(turned, old), old.schema).where("n > 0")
            moved.append(rows.join(turned, "customer_id").select("gid", F.col("turn").alias("active")))
        for m in moved:
            fields = F.from_json("gid", "order_day date, product string, country string").alias("g")
            parts.append(m.groupBy("gid").agg(F.sum("active").cast("long").alias("active")).where("active <> 0").select("gid", "active", fields)
                         .select("gid", "g.*", F.lit(0).cast("long").alias("n"), F.lit(0).cast(MONEY_SUM).alias("revenue"),
                                 F.lit(0).cast(MONEY_SUM).alias("amount"), "active"))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        sums = {"n": "long", "revenue": "decimal(28,2)", "amount": "decimal(28,2)", "active": "long"}
        rows = rows.groupBy("gid", *PAY_GROUP).agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()])
        rows = rows.where("n <> 0 OR revenue <> 0 OR amount <> 0 OR active <> 0")
        return self._add(table, "gid", rows, PAY_GROUP, sums, until, since)

    def _sessions_daily(self, now: dict) -> int:
        table = self.state("sessions_daily", "gid")
        since = self.applied(table, "sessions")
        delta = self._changes("sessions", since, now["sessions"])
        if delta is None:
            return 0
        w = F.col("_weight")
        number = {"pageviews": F.col("pageviews"), "duration": F.col("session_duration_s"), "bounced": F.col("bounced").cast("int"), "converted": F.col("converted").cast("int")}
        aggs = [F.sum(w).cast("long").alias("n")]
        for name, c in number.items():
            aggs += [F.sum(F.coalesce(c, F.lit(0)).cast("long") * w).cast("long").alias(name), F.sum(F.when(c.isNotNull(), w).otherwise(0)).cast("long").alias(f"n_{name}")]
        names = ["n", *[x for name in number for x in (name, f"n_{name}")]]
        rows = delta.withColumn("gid", group_key(SES_GROUP)).groupBy("gid", *SES_GROUP).agg(*aggs).where(" OR ".join(f"{x} <> 0" for x in names))
        return self._add(table, "gid", rows, SES_GROUP, {x: "long" for x in names}, {"sessions": now["sessions"]}, {"sessions": since})

    def _customer_payments(self, now: dict) -> int:
        table = self.state("customer_payments", "customer_id")
        since = self.applied(table, "payments")
        delta = self._changes("payments", since, now["payments"])
        if delta is None:
            return 0
        w = F.col("_weight")
        rows = delta.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
            F.sum(w).cast("long").alias("n"), F.sum(F.coalesce(F.col("net_revenue"), F.lit(0)) * w).cast(MONEY_SUM).alias("revenue")).where("n <> 0 OR revenue <> 0")
        return self._add(table, "customer_id", rows, [], {"n": "long", "revenue": "decimal(28,2)"}, {"payments": now["payments"]}, {"payments": since})

    def _customer_sessions(self, now: dict) -> int:
        table = self.state("customer_sessions", "customer_id")
        since = self.applied(table, "sessions")
        delta = self._changes("sessions", since, now["sessions"])
        if delta is None:
            return 0
        delta = delta.where(F.col("customer_id").isNotNull())
        rows = delta.groupBy("customer_id").agg(
            F.sum("_weight").cast("long").alias("n"), F.max(F.when(F.col("_weight") > 0, F.col("session_start"))).alias("last_session"),
            F.max(F.when(F.col("_weight") < 0, F.col("session_start"))).alias("lost"))
        rows = stage(rows, "sessions")
        old = table.latest()
        if old is not None and since:
            # a customer whose latest session went: all its sessions are looked at again
            lost = rows.where(F.col("lost").isNotNull()).select("customer_id", "lost")
            held = table.read_files(table.may_hold(lost, old), old.schema).select("customer_id", F.col("last_session").alias("held"))
            hurt = stage(lost.join(held, "customer_id").where("lost >= held").select("customer_id"), "hurt")
            if hurt.head(1):
                return self._recount_sessions(table, rows, hurt, old, now, since)
        rows = rows.select("customer_id", "n", "last_session").where("n <> 0 OR last_session IS NOT NULL")
        return self._add(table, "customer_id", rows, [], {"n": "long"}, {"sessions": now["sessions"]}, {"sessions": since}, ["last_session"])

    def _recount_sessions(self, table: LogTable, rows: DataFrame, hurt: DataFrame, old: Commit, now: dict, since: int) -> int:
        """As an addition, but for the ``hurt`` customers the row is made from their sessions in staging."""
        sessions = self.staging["sessions"].read(now["sessions"]).select("customer_id", "session_start")
        fresh = (sessions.join(hurt, "customer_id", "left_semi").groupBy("customer_id")
                 .agg(F.count(F.lit(1)).alias("n"), F.max("session_start").alias("last_session")))
        delta = stage(rows.select("customer_id", "n", "last_session").join(hurt, "customer_id", "left_anti"), "delta")
        fresh = stage(fresh, "fresh")

        def build(state: Commit | None) -> Change | None:
            if state.info.get("applied", {}).get("sessions", 0) != since:
                return None
            met = table.may_hold(rows, state)
            kept = table.read_files(met, state.schema).join(hurt, "customer_id", "left_anti")
            summed = (kept.unionByName(delta).groupBy("customer_id")
                      .agg(F.sum("n").cast("long").alias("n"), F.max("last_session").alias("last_session")).where(F.col("n") != 0))
            name = table.write_rows(summed.unionByName(fresh).select(*state.schema.names))
            return Change("recount", state.schema, name, met, info={"applied": {**state.info["applied"], "sessions": now["sessions"]}}, result=rows.count())

        done = table.commit(build)
        return done.result if done else 0

    # --- reading ----------------------------------------------------------------------
    def groups(self, name: str, key: str, schema: str) -> DataFrame:
        found = self.state(name, key).read()
        return found if found is not None else self.spark.createDataFrame([], schema)

    def payments_by_group(self) -> DataFrame:
        """order_day, product, country and the four measures of a day's payments."""
        rows = self.groups("payments_daily", "gid", "order_day date, product string, country string, n long, revenue decimal(28,2), amount decimal(28,2), active long")
        return rows.select(*PAY_GROUP, F.col("revenue").alias("total_net_revenue"), F.col("amount").alias("total_amount"),
                           F.col("n").alias("total_orders"), F.col("active").alias("active_customers"))

    def sessions_by_group(self) -> DataFrame:
        """session_day, device, country and the five measures of a day's sessions."""
        numbers = ["pageviews", "duration", "bounced", "converted"]
        rows = self.groups("sessions_daily", "gid", "session_day date, device string, country string, n long, " + ", ".join(f"{x} long, n_{x} long" for x in numbers))
        mean = lambda x: F.when(F.col(f"n_{x}") > 0, F.col(x).cast("double") / F.col(f"n_{x}"))
        return rows.select(*SES_GROUP, F.col("n").alias("total_sessions"), F.when(F.col("n_pageviews") > 0, F.col("pageviews")).alias("total_pageviews"),
                           mean("duration").alias("avg_session_duration_s"), mean("bounced").alias("bounce_rate"), mean("converted").alias("conversion_rate"))

    def agg_payments_daily(self, dim_product: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
        """``marts.agg_payments_daily`` without reading a fact."""
        rows = self.payments_by_group()
        rows = left_join_dim(rows, dim_product.select(F.col("product_name").alias("product"), "product_key"), "product")
        rows = left_join_dim(rows, dim_country.select(F.col("country_name").alias("country"), "country_key"), "country")
        rows = left_join_dim(rows, dim_date.select(F.col("full_date").alias("order_day"), F.col("date_key").alias("order_date_key")), "order_day")
        return rows.select("order_date_key", "product_key", "country_key", "total_net_revenue", "total_amount", "total_orders", "active_customers")

    def agg_sessions_daily(self, dim_device: DataFrame, dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
        """``marts.agg_sessions_daily`` without reading a fact."""
        rows = self.sessions_by_group()
        rows = left_join_dim(rows, dim_device.select(F.col("device_name").alias("device"), "device_key"), "device")
        rows = left_join_dim(rows, dim_country.select(F.col("country_name").alias("country"), "country_key"), "country")
        rows = left_join_dim(rows, dim_date.select(F.col("full_date").alias("session_day"), F.col("date_key").alias("session_date_key")), "session_day")
        return rows.select("session_date_key", "device_key", "country_key", "total_sessions", "total_pageviews",
                           "avg_session_duration_s", "bounce_rate", "conversion_rate")

    def agg_customer_summary(self, dim_customer: DataFrame) -> DataFrame:
        """``marts.agg_customer_summary`` from the totals per customer."""
        pay = self.groups("customer_payments", "customer_id", "customer_id string, n long, revenue decimal(28,2)")
        ses = self.groups("customer_sessions", "customer_id", "customer_id string, n long, last_session timestamp_ntz")
        rows = (dim_customer.join(pay.select("customer_id", F.col("n").alias("_orders"), F.col("revenue").alias("total_revenue")), "customer_id", "left")
                .join(ses.select("customer_id", F.col("n").alias("_sessions"), "last_session"), "customer_id", "left"))
        return rows.select("customer_key", "country", "industry", "company_size", F.coalesce("_orders", F.lit(0)).cast("bigint").alias("total_orders"),
                           "total_revenue", "last_session", F.coalesce("_sessions", F.lit(0)).cast("bigint").alias("total_sessions"), "signup_date", "is_churned")
