"""The streaming upsert equals the batch upsert and replays to nothing."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import dml
from tidemark.operators.publish import current, versions
from tidemark.operators.quality import same_rows
from tidemark.plans.gold import Build
from tidemark.schemas import RAW_CUSTOMERS
from tidemark.sources import landing
from tidemark.streaming.upsert_stream import run_stream


def test_stream_equals_batch_and_reruns_empty(spark, tmp_path):
    base = str(tmp_path)
    raw = Build(spark, SF_SMALL).raw_customers
    first = raw.withColumn("company_name", F.concat(F.lit("old "), "company_name"))
    landing.write_landing(landing.paginate(first, "customers", "customer_id"), f"{base}/landing/run=0")
    landing.write_landing(landing.paginate(raw, "customers", "customer_id"), f"{base}/landing/run=1")
    ran = run_stream(spark, f"{base}/landing/*", "customers", f"{base}/ckpt", f"{base}/raw")
    assert ran
    got = current(spark, f"{base}/raw", "customers", RAW_CUSTOMERS)
    # batch form: every landed row, later run wins
    rows = landing.read_envelopes(spark, f"{base}/landing/*", "customers").withColumn(
        "_run", F.regexp_extract(F.input_file_name(), r"run=(\d)", 1).cast("int"))
    typed = landing.to_raw(rows, "customers", keep=["_run", "page", "pos"])
    want = dml.upsert(spark.createDataFrame([], RAW_CUSTOMERS), typed, "customer_id",
                      order=["_run", "page", "pos"], revive="is_deleted")
    assert same_rows(got, want)
    n = len(versions(spark, f"{base}/raw", "customers"))
    again = run_stream(spark, f"{base}/landing/*", "customers", f"{base}/ckpt", f"{base}/raw")
    assert again == []
    assert len(versions(spark, f"{base}/raw", "customers")) == n


def test_in_place_stream_equals_versioned(spark, tmp_path):
    from tidemark.operators.inplace import read_bucketed
    from tidemark.schemas import RAW_SESSIONS
    base = str(tmp_path)
    raw = Build(spark, SF_SMALL).raw_sessions
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for i, part in enumerate((raw.where(F.col("session_start") <= cut), raw)):
        landing.write_landing(landing.paginate(part, "sessions", "session_id"), f"{base}/landing/run={i}")
    run_stream(spark, f"{base}/landing/*", "sessions", f"{base}/ck1", f"{base}/v")
    run_stream(spark, f"{base}/landing/*", "sessions", f"{base}/ck2", f"{base}/p", in_place=True)
    versioned = current(spark, f"{base}/v", "sessions", RAW_SESSIONS)
    in_place = spark.read.parquet(f"{base}/p/sessions")
    assert same_rows(in_place.select(*versioned.columns), versioned)
    assert same_rows(versioned, raw)
    # customers, update mode, by buckets
    cust = Build(spark, SF_SMALL).raw_customers
    landing.write_landing(landing.paginate(cust, "customers", "customer_id"), f"{base}/lc/run=0")
    run_stream(spark, f"{base}/lc/*", "customers", f"{base}/ck3", f"{base}/v")
    run_stream(spark, f"{base}/lc/*", "customers", f"{base}/ck4", f"{base}/p", in_place=True, buckets=16)
    a = current(spark, f"{base}/v", "customers")
    b = read_bucketed(spark, f"{base}/p/customers")
    assert same_rows(b.select(*a.columns), a)


def test_bounded_micro_batches_give_the_same_table(spark, tmp_path):
    from tidemark.schemas import RAW_SESSIONS
    base = str(tmp_path)
    raw = Build(spark, SF_SMALL).raw_sessions
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for i, part in enumerate((raw.where(F.col("session_start") <= cut), raw.where(F.col("session_start") > cut))):
        landing.write_landing(landing.paginate(part, "sessions", "session_id").coalesce(1), f"{base}/landing/run={i}")
    ran = run_stream(spark, f"{base}/landing/*", "sessions", f"{base}/ck", f"{base}/t", max_files_per_trigger=1)
    assert len(ran) == 2
    assert same_rows(current(spark, f"{base}/t", "sessions", RAW_SESSIONS), raw)
