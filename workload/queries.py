"""One query per operator. Each takes ``(spark, sf_dir)``."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import sources
from martloom.config import Lifetime, RunConfig
from martloom.functions import (
    change_flag,
    date_suffix,
    narrow,
    partition_value,
    report_date,
    retention_cutoff,
    target_file_count,
)
from martloom.operators import (
    HotKeys,
    append_row,
    count_where,
    declare_table,
    filter_report_date,
    last_partition,
    left_join,
    max_where,
    overwrite_partitions,
    recover_partitions,
    recreate_table,
    stamp_load,
    truncate_partitions,
)
from martloom.plans import (
    CORPORATE_MART,
    JobFailed,
    Step,
    apply_retention,
    build_mart,
    change_of_run,
    compact_partitions,
    compaction_plan,
    force_reload,
    last_step,
    mart_rows,
    previous_count,
    record_run,
    resolve_date,
    resume_after,
    retention_plan,
    run_mart_job,
    run_stats,
    run_steps,
    write_run_stats,
)
from martloom.plans.audit import RUN_STATS_SCHEMA, STAT_APPLICATION
from martloom.plans.job import mart_step
from martloom.session import run_start
from martloom.sources.literals import literal_rows
from workload.standins import (
    MONTH,
    MONTHLY_SCHEMA,
    ORDERS_MART,
    Workspace,
    audit_history,
    corporate_profile,
    corporate_reference,
    given,
    monthly_columns,
    monthly_orders,
    orders_profile,
    shared_monthly,
)

RUN = "2024-01-16 06:00:00"
_PART = "report_dt"
_SMALL_BLOCK = 512


# Sources


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.scan_table(spark, shared_monthly(spark, sf_dir)).select(
        "o_orderkey", "o_totalprice", _PART
    )


def scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.scan_partition(spark, shared_monthly(spark, sf_dir), _PART, MONTH)


def scan_partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = sources.table_location(spark, shared_monthly(spark, sf_dir))
    schema = MONTHLY_SCHEMA[:-1]
    return sources.scan_partition_path(spark, f"{location}/{_PART}={MONTH}", schema)


def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.list_partitions(spark, shared_monthly(spark, sf_dir))


def newest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_partition(sources.list_partitions(spark, shared_monthly(spark, sf_dir)))


def _sizes(spark: SparkSession, table: str) -> DataFrame:
    location = sources.table_location(spark, table)
    return sources.partition_sizes(sources.partition_inventory(spark, location, _PART), _PART)


def _files_seen_by_scan(spark: SparkSession, table: str) -> DataFrame:
    """Files and bytes per partition as the table's own scan reports them."""
    return (
        spark.table(table)
        .select(_PART, "_metadata.file_path", "_metadata.file_size")
        .distinct()
        .groupBy(_PART)
        .agg(F.count("*").alias("scan_files"), F.sum("file_size").alias("scan_bytes"))
    )


def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_monthly(spark, sf_dir)
    listed = sources.partition_inventory(spark, sources.table_location(spark, table), _PART)
    named = F.col("path").endswith(".parquet") & (F.col("length") > 0)
    per_partition = listed.groupBy(_PART).agg(
        F.count("*").alias("files"), F.every(named).alias("all_parquet")
    )
    return per_partition.join(_files_seen_by_scan(spark, table), _PART, "left").select(
        _PART, "all_parquet", F.col("files").eqNullSafe(F.col("scan_files")).alias("files_agree")
    )


def partition_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_monthly(spark, sf_dir)
    return _sizes(spark, table).join(_files_seen_by_scan(spark, table), _PART, "left").select(
        _PART, F.col("bytes").eqNullSafe(F.col("scan_bytes")).alias("bytes_agree")
    )


def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    table = Workspace(spark).monthly(orders)
    started = run_start(spark)
    while run_start(spark) == started:
        time.sleep(0.1)
    started = run_start(spark)
    overwrite_partitions(monthly_columns(orders.where(F.col("o_totalprice") > 499000)), table)
    location = sources.table_location(spark, table)
    return sources.touched_partitions(spark, location, _PART, started).select(_PART)


# Table definition and sinks


def create_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(Workspace(spark).monthly(monthly_orders(spark, sf_dir), external=True))


def recreate_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    table = space.monthly(monthly_orders(spark, sf_dir), external=True)
    wider = MONTHLY_SCHEMA[:-1].add("note", "string").add(MONTHLY_SCHEMA[-1])
    recreate_table(spark, table, wider, sources.table_location(spark, table), _PART)
    return spark.table(table).select("o_orderkey", "note", _PART)


def recreate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns declared in other types than their files have: a wider number,
    a narrower one, and numbers as text."""
    space = Workspace(spark)
    table = space.monthly(monthly_orders(spark, sf_dir), external=True)
    types = {"o_orderkey": T.StringType(), "o_custkey": T.IntegerType(), "o_totalprice": T.DecimalType(12, 2)}
    changed = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in MONTHLY_SCHEMA])
    recreate_table(spark, table, changed, sources.table_location(spark, table), _PART)
    return spark.table(table).select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("string").alias("price"), _PART)


def recovered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    table, folder = space.table("found"), space.path("found")
    rows = monthly_columns(monthly_orders(spark, sf_dir))
    rows.hint("rebalance", _PART).write.partitionBy(_PART).parquet(folder)
    declare_table(spark, table, MONTHLY_SCHEMA, _PART, folder)
    recover_partitions(spark, table)
    return spark.table(table).select("o_orderkey", "o_custkey", _PART)


def overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    table = Workspace(spark).monthly(orders)
    changed = filter_report_date(orders, MONTH).withColumn("o_totalprice", -F.col("o_totalprice"))
    overwrite_partitions(monthly_columns(changed), table)
    return spark.table(table).select("o_orderkey", "o_totalprice", _PART)


def overwrite_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    table = Workspace(spark).monthly(orders)
    overwrite_partitions(monthly_columns(filter_report_date(orders, "1900-01-01")), table)
    return spark.table(table).select("o_orderkey", "o_totalprice", _PART)


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Workspace(spark).audit(audit_history(spark, sf_dir))
    rows = count_where(given(spark, sf_dir, "orders")).first()["rows"]
    append_row(spark, table, ctl_loading=-1, ctl_validfrom=RUN, count_rows=rows)
    return spark.table(table)


def truncated_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Workspace(spark).monthly(monthly_orders(spark, sf_dir))
    truncate_partitions(spark, table, "1996-03-01", "2000-10-01")
    recover_partitions(spark, table)
    return spark.table(table).select("o_orderkey", _PART)


def truncated_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``truncated_partitions``; what is left is what the files hold."""
    table = Workspace(spark).monthly(monthly_orders(spark, sf_dir), external=True)
    truncate_partitions(spark, table, "1996-03-01", "2000-10-01")
    recover_partitions(spark, table)
    return spark.table(table).select("o_orderkey", _PART)


def published_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    monthly = spark.table(shared_monthly(spark, sf_dir))
    change = change_of_run(audit_history(spark, sf_dir), monthly).first()["is_change"]
    newest = newest_partition(spark, sf_dir).select(partition_value("partition", _PART).alias("d")).first()["d"]
    declare_table(spark, space.table("run_stats"), RUN_STATS_SCHEMA)
    write_run_stats(run_stats(spark, 7, 42, RUN, newest, change, today=RUN[:10]), space.table("run_stats"))
    own = (F.col("value") == spark.sparkContext.applicationId).cast("string")
    value = F.when(F.col("stat_id") == STAT_APPLICATION, own).otherwise(F.col("value"))
    return spark.table(space.table("run_stats")).withColumn("value", value)


# Projections, filters, scalar functions


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_load(given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 7, RUN)


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_report_date(spark.table(shared_monthly(spark, sf_dir)), MONTH).select(
        "o_orderkey", "o_totalprice", _PART
    )


def narrow_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey") * 7, F.col("o_totalprice")
    whole, text = F.floor(price), F.substring("o_orderpriority", 1, 1)
    small, big, double = T.ShortType(), T.LongType(), T.DoubleType()
    return orders.select(
        "o_orderkey",
        narrow(key, small, "key", "null", source=big).alias("key_small"),
        narrow(whole, small, "price", "null", source=big).alias("price_small"),
        narrow(text, small, "priority", source=T.StringType()).alias("priority_small"),
        narrow(price, T.FloatType(), "price", source=double).alias("price_float"),
        narrow(price * 1e35, T.FloatType(), "price", "null", source=double).alias("price_huge"),
    )


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/marts/status="), "o_orderstatus", F.lit("/report_dt="), _PART)
    return monthly_orders(spark, sf_dir).select("o_orderkey", path.alias("path"))


def partition_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select(
        "o_orderkey",
        partition_value("path", _PART).alias("date_value"),
        partition_value("path", "status").alias("status_value"),
        partition_value("path", "absent").alias("absent_value"),
    )


def report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select(
        "o_orderkey", report_date("path").alias("first_date"), date_suffix("path").alias("suffix")
    )


def retention_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("string")
    started = F.to_timestamp_ntz(F.concat(F.substring(ordered, 1, 10), F.lit(" 06:30:00")))
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        retention_cutoff(started, Lifetime(months=14)).alias("months_only"),
        retention_cutoff(started, Lifetime(days=3, months=1, years=2)).alias("mixed"),
    )


def target_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents").select(
        "doc_id", target_file_count("n_chars", 512).alias("files")
    )


def change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders of a month as the previous count, all as the current."""
    status = F.col("o_orderstatus")
    finished = F.count_if(status == "F")
    return (
        monthly_orders(spark, sf_dir)
        .groupBy(_PART)
        .agg(F.when(finished > 0, finished).alias("previous"), F.count("*").alias("current"))
        .select(
            _PART,
            change_flag("previous", "current").alias("is_change"),
            change_flag("current", "current").alias("same"),
            change_flag("current", "current", force=True).alias("forced"),
        )
    )


# Joins


def mart_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_profile(spark, sf_dir).select("o_orderkey", "o_custkey", "total", _PART)
    customers = given(spark, sf_dir, "customer")
    return left_join(orders, customers, "o_custkey", "c_custkey", ["c_mktsegment", "c_nationkey"])


def left_join_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return left_join(documents, given(spark, sf_dir, "labels"), "doc_id", "doc_id", ["quality", "toxic"])


def left_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = given(spark, sf_dir, "orders")
    return left_join(customers, orders, "c_custkey", "o_custkey", ["o_orderkey", "o_totalprice"])


def left_join_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the lines share one right key, below a thousandth of the left
    rows; keys are ``int`` on the left and ``bigint`` on the right."""
    lines = given(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey") + 1)
    orders = given(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") < 4, F.lit(1)).otherwise(F.col("o_custkey").cast("int") + 1).alias("line_key"),
        "o_orderkey",
    )
    return left_join(
        orders,
        lines.select(key.alias("key"), "l_orderkey", "l_linenumber"),
        "line_key",
        "key",
        ["l_orderkey", "l_linenumber"],
        HotKeys(rows_per_task=1000),
    )


# Aggregates


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem")
    return count_where(lines, "l_quantity > 25 and l_returnflag = 'R'", alias="n_rows")


def counted_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_where(given(spark, sf_dir, "lineitem"), alias="n_rows")


def largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_where(given(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus = 'O'")


def largest_of_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_where(given(spark, sf_dir, "orders"), "o_totalprice", "o_totalprice < 0")


def last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_step(audit_history(spark, sf_dir))


def previous_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return previous_count(audit_history(spark, sf_dir))


# Composite jobs


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one mart month, without the write."""
    profile = orders_profile(spark, sf_dir, MONTH)
    return mart_rows(profile, given(spark, sf_dir, "customer"), ORDERS_MART, MONTH, 7, RUN)


def mart_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Workspace(spark).table("mart")
    declare_table(spark, table, ORDERS_MART.schema, _PART)
    profile = orders_profile(spark, sf_dir, MONTH)
    build_mart(spark, table, profile, given(spark, sf_dir, "customer"), ORDERS_MART, MONTH, 7, RUN)
    return spark.table(table)


def corporate_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile is computed once, as a stored table; then the mart."""
    space = Workspace(spark)
    table = space.table("mart")
    declare_table(spark, table, CORPORATE_MART.schema, _PART)
    features, profile = corporate_profile(spark, sf_dir, MONTH), space.table("profile")
    declare_table(spark, profile, features.select(*CORPORATE_MART.from_profile).schema, _PART)
    overwrite_partitions(features, profile, rebalance=False)
    reference = corporate_reference(spark, sf_dir)
    build_mart(spark, table, spark.table(profile), reference, CORPORATE_MART, MONTH, 7, RUN)
    return spark.table(table)


def resolved_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_monthly(spark, sf_dir)
    newest = resolve_date(spark, table, _PART, "1990-01-01", force=False)
    return filter_report_date(spark.table(table), newest).select("o_orderkey", _PART)


def _status_step(table: str, sf_dir: str, status: str) -> Step:
    def transform(spark: SparkSession, _) -> DataFrame:
        return monthly_columns(monthly_orders(spark, sf_dir).where(F.col("o_orderstatus") == status))

    return Step(table, transform)


def resumed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps, of which those up to the audited one are skipped."""
    space = Workspace(spark)
    audit = space.audit(audit_history(spark, sf_dir))
    groups, counts = {}, []
    for number, status in enumerate("FOP", start=1):
        table = space.table(f"status_{status.lower()}")
        declare_table(spark, table, MONTHLY_SCHEMA, _PART)
        groups[number] = [_status_step(table, sf_dir, status)]
        counts.append((number, table))
    run_steps(spark, groups, {}, done=resume_after(spark, audit, recovery=True))
    frames = [
        count_where(spark.table(table), alias="n_rows").select(F.lit(number).alias("step"), "n_rows")
        for number, table in counts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    table, folder = space.table("mart"), space.path("mart")
    declare_table(spark, table, ORDERS_MART.schema, _PART, folder)
    profile, customers = orders_profile(spark, sf_dir), given(spark, sf_dir, "customer")
    for load_id, month in enumerate(("2001-05-01", "2001-06-01", MONTH), start=1):
        build_mart(spark, table, profile, customers, ORDERS_MART, month, load_id, RUN)
    force_reload(spark, table, ORDERS_MART)
    build_mart(spark, table, profile, customers, ORDERS_MART, "2001-06-01", 9, RUN)
    return spark.table(table)


def change_of_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_of_run(audit_history(spark, sf_dir), spark.table(shared_monthly(spark, sf_dir)))


def planned_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the bytes that the table's own scan reports."""
    table = shared_monthly(spark, sf_dir)
    plan = compaction_plan(_sizes(spark, table), _SMALL_BLOCK)
    due = F.floor(F.col("scan_bytes") / _SMALL_BLOCK) + 1
    fits = F.col("target_files").eqNullSafe(due) & (due > 1)
    return plan.join(_files_seen_by_scan(spark, table), _PART, "left").select(_PART, fits.alias("fits"))


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files per month, then as many as their bytes ask for: several
    for each month, so many that some have to be merged."""
    orders = monthly_columns(monthly_orders(spark, sf_dir))
    started = run_start(spark)
    table = Workspace(spark).table("monthly")
    declare_table(spark, table, MONTHLY_SCHEMA, _PART)
    overwrite_partitions(orders.repartition(6), table, rebalance=False)
    sizes = _sizes(spark, table)
    block = sizes.agg(F.max("largest")).first()[0]
    before = compaction_plan(sizes, block).select(_PART, "target_files")
    # The plan is kept as values: it describes files that are about to go.
    planned = literal_rows(spark, before.collect(), before.schema)
    compact_partitions(spark, table, started, block)
    per_month = spark.table(table).groupBy(_PART).agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )
    after = _sizes(spark, table).select(_PART, "files").join(planned, _PART)
    return per_month.join(after, _PART, "left").select(
        _PART, "n_rows", "low", "high", F.col("files").eqNullSafe(F.col("target_files")).alias("as_planned")
    )


def compacted_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status and month: a partition is a month of one status. A
    second pass finds nothing to rewrite."""
    keys = ("o_orderstatus", _PART)
    table = Workspace(spark).table("two_levels")
    declare_table(spark, table, MONTHLY_SCHEMA, keys)
    started = run_start(spark)
    orders = monthly_columns(monthly_orders(spark, sf_dir))
    overwrite_partitions(orders.repartition(3), table, rebalance=False)
    compact_partitions(spark, table, started)
    again = compact_partitions(spark, table, started)
    location = sources.table_location(spark, table)
    sizes = sources.partition_sizes(sources.partition_inventory(spark, location, keys), keys)
    settled = compaction_plan(sizes).select(*keys, (F.col("files") <= F.col("target_files")).alias("within_plan"))
    per_partition = spark.table(table).groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )
    return per_partition.join(settled, list(keys), "left").withColumn("n_again", F.lit(len(again)))


def planned_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with a very large order count as touched by the run."""
    table = shared_monthly(spark, sf_dir)
    touched = spark.table(table).where(F.col("o_totalprice") > 499000)
    touched = touched.select(F.concat(F.lit(f"{_PART}="), _PART).alias("partition"))
    listed = sources.list_partitions(spark, table)
    return retention_plan(listed, touched, _PART, "2001-07-31 06:00:00", Lifetime(months=14))


def applied_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifetime reaches back to 2000-06-01, itself the last to expire."""
    table = Workspace(spark).monthly(monthly_orders(spark, sf_dir))
    started = run_start(spark)
    days = (date.fromisoformat(started[:10]) - date(2000, 6, 1)).days
    apply_retention(spark, table, _PART, started, Lifetime(days=days))
    return spark.table(table).select("o_orderkey", _PART)


def retained_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifetime reaches back to 2000-06-01, itself the last to expire."""
    table = Workspace(spark).monthly(monthly_orders(spark, sf_dir), external=True)
    started = run_start(spark)
    days = (date.fromisoformat(started[:10]) - date(2000, 6, 1)).days
    apply_retention(spark, table, _PART, started, Lifetime(days=days))
    return spark.table(table).select("o_orderkey", _PART)


def step_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step 1 writes two tables at once, step 2 joins them into the mart."""
    space = Workspace(spark)
    orders, customers, mart = (space.table(name) for name in ("orders_m", "customers_m", "mart"))
    declare_table(spark, orders, MONTHLY_SCHEMA, _PART)
    known = given(spark, sf_dir, "customer")
    declare_table(spark, customers, known.schema)
    declare_table(spark, mart, ORDERS_MART.schema, _PART)

    def joined(spark: SparkSession, params) -> DataFrame:
        rows = spark.table(orders).withColumnRenamed("o_totalprice", "total")
        return mart_rows(rows, spark.table(customers), ORDERS_MART, params["load_date"], 8, RUN)

    groups = {
        1: [
            Step(orders, lambda s, _: monthly_columns(monthly_orders(s, sf_dir))),
            Step(customers, lambda s, _: given(s, sf_dir, "customer"), whole=True),
        ],
        2: [Step(mart, joined)],
    }
    outcome = run_steps(spark, groups, {"load_date": MONTH})
    if outcome.error:
        raise outcome.error
    return spark.table(mart)


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: a forced one, and one after a month lost its open orders."""
    space = Workspace(spark)
    orders, audit = monthly_columns(monthly_orders(spark, sf_dir)), space.audit()
    table = space.monthly(orders)
    newest = f"{_PART}={resolve_date(spark, table, _PART, MONTH, force=False)}"
    record_run(spark, audit, table, 1, "2024-01-16 06:00:00", newest, True, 1, 1)
    overwrite_partitions(filter_report_date(orders, MONTH).where("o_orderstatus <> 'O'"), table)
    record_run(spark, audit, table, 2, "2024-02-16 06:00:00", newest, False, 1, 1)
    record_run(spark, audit, table, 3, "2024-03-16 06:00:00", newest, False, 0, 1)
    return spark.table(audit)


def _job_config(space: Workspace, sf_dir: str) -> RunConfig:
    """An external mart over a stored profile and a stored reference table."""
    spark = space.spark
    declare_table(spark, space.table("profile"), orders_profile(spark, sf_dir).schema, _PART)
    overwrite_partitions(orders_profile(spark, sf_dir), space.table("profile"))
    customers = given(spark, sf_dir, "customer")
    declare_table(spark, space.table("reference"), customers.schema)
    customers.write.insertInto(space.table("reference"))
    return RunConfig(
        target=space.table("mart"),
        spec=ORDERS_MART,
        profile=space.table("profile"),
        reference=space.table("reference"),
        lifetime=Lifetime(years=1),
        default_date=MONTH,
        location=space.path("mart"),
        audit_location=space.path("audit"),
        entity_id=42,
    )


def _job(spark: SparkSession, sf_dir: str) -> RunConfig:
    config = _job_config(Workspace(spark), sf_dir)
    run_mart_job(spark, config, 11, run_start="2001-07-16 06:00:00", force=True, today="2001-07-16")
    run_mart_job(spark, config, 12, run_start="2001-08-16 06:00:00", today="2001-08-16")
    return config


def mart_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced run and a refresh of the same month: the stored mart."""
    return spark.table(_job(spark, sf_dir).target)


def mart_job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_job(spark, sf_dir).audit_table)


def job_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose second step fails, and its recovery, which runs only that
    step: the rows of both tables with the load that wrote them."""
    space = Workspace(spark)
    config, second = _job_config(space, sf_dir), space.table("second")
    declare_table(spark, second, ORDERS_MART.schema, _PART)

    def failing(spark: SparkSession, params) -> DataFrame:
        broken = F.raise_error(F.lit("not today")).cast("float")
        return spark.table(config.target).withColumn("total", broken)

    def working(spark: SparkSession, params) -> DataFrame:
        return spark.table(config.target).withColumn("ctl_loading", F.lit(params["load_id"]))

    first = mart_step(config)
    try:
        groups = {1: [first], 2: [Step(second, failing)]}
        run_mart_job(spark, config, 21, groups, run_start="2001-07-16 06:00:00", force=True)
    except JobFailed:
        pass
    groups = {1: [first], 2: [Step(second, working)]}
    run_mart_job(spark, config, 22, groups, run_start="2001-08-16 06:00:00", recovery=True)
    audit = spark.table(config.audit_table).select("ctl_loading", "last_success_step", "is_change")
    rows = spark.table(config.target).unionByName(spark.table(second)).select("ctl_loading", "o_orderkey")
    return rows.join(audit, "ctl_loading", "left")


QUERIES = {
    "scan_table": scan_table,
    "scan_partition": scan_partition,
    "scan_partition_path": scan_partition_path,
    "list_partitions": list_partitions,
    "last_partition": newest_partition,
    "partition_inventory": partition_inventory,
    "partition_sizes": partition_sizes,
    "touched_partitions": touched_partitions,
    "create_mart": create_mart,
    "recreate_mart": recreate_mart,
    "recreate_types": recreate_types,
    "recover_partitions": recovered_partitions,
    "overwrite_partition": overwrite_partition,
    "overwrite_empty": overwrite_empty,
    "audit_append": audit_append,
    "truncate_partitions": truncated_partitions,
    "truncate_external": truncated_external,
    "run_stats": published_stats,
    "stamp_load": stamped,
    "filter_report_date": filtered,
    "narrow_cast": narrow_cast,
    "partition_value": partition_values,
    "report_date": report_dates,
    "retention_cutoff": retention_cutoffs,
    "target_file_count": target_file_counts,
    "change_flag": change_flags,
    "mart_left_join": mart_left_join,
    "left_join_unmatched": left_join_unmatched,
    "left_join_fanout": left_join_fanout,
    "left_join_hot_keys": left_join_hot_keys,
    "count_where": counted,
    "count_all": counted_all,
    "max_where": largest,
    "max_empty": largest_of_none,
    "last_step": last_success,
    "previous_count": previous_rows,
    "mart_rows": entry_rows,
    "mart_build": mart_build,
    "corporate_mart": corporate_mart,
    "resolve_date": resolved_date,
    "resume_steps": resumed_steps,
    "force_reload": reloaded,
    "change_of_run": change_of_mart,
    "compaction_plan": planned_compaction,
    "compact_partition": compacted,
    "compact_two_levels": compacted_two_levels,
    "retention_plan": planned_retention,
    "retention_apply": applied_retention,
    "retention_external": retained_external,
    "step_job": step_job,
    "run_audit": run_audit,
    "mart_job": mart_job,
    "mart_job_audit": mart_job_audit,
    "job_recovery": job_recovery,
}
