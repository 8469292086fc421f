"""Plans that must hold at any size: what is pruned, pushed and shuffled."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import sources
from martloom.functions import narrow_to
from martloom.operators import HotKeys, count_where, left_join, max_where
from martloom.plans import last_step, mart_rows, previous_count
from workload.queries import QUERIES
from workload.standins import (
    MONTH,
    ORDERS_MART,
    audit_history,
    given,
    monthly_orders,
    orders_profile,
    shared_monthly,
)

SF_DIR = "/root/testdata/sf0.01"

# Queries that only read, so that their whole work is in the plan.
PURE = (
    "scan_table scan_partition list_partitions last_partition partition_inventory partition_sizes "
    "stamp_load filter_report_date narrow_cast partition_value report_date retention_cutoff "
    "target_file_count change_flag mart_left_join left_join_unmatched left_join_fanout "
    "left_join_hot_keys count_where count_all max_where max_empty last_step previous_count mart_rows "
    "resolve_date change_of_run compaction_plan retention_plan"
).split()


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mart_reads_one_partition_and_only_its_columns(spark):
    profile = spark.table(shared_monthly(spark, SF_DIR)).withColumnRenamed("o_totalprice", "total")
    text = plan(mart_rows(profile, given(spark, SF_DIR, "customer"), ORDERS_MART, MONTH, 1, "x"))
    assert "PartitionFilters: [isnotnull(report_dt" in text and f"/report_dt={MONTH}]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in text


def test_mart_month_reaches_an_unpartitioned_scan_as_a_range(spark):
    rows = mart_rows(
        orders_profile(spark, SF_DIR, MONTH), given(spark, SF_DIR, "customer"), ORDERS_MART, MONTH, 1, "x"
    )
    assert "GreaterThanOrEqual(o_orderdate,2001-07-01T00:00), LessThan(o_orderdate,2001-08-01T00:00)" in plan(rows)


def test_mart_shuffles_only_for_the_join(spark, no_broadcast):
    profile, customers = orders_profile(spark, SF_DIR, MONTH), given(spark, SF_DIR, "customer")
    text = plan(mart_rows(profile, customers, ORDERS_MART, MONTH, 1, "x"))
    tree = text.split("(1) Scan")[0]
    assert tree.count("Exchange") == 2
    assert "SortMergeJoin LeftOuter" in text


def test_pieces_are_part_of_the_join_key(spark, no_broadcast):
    orders, customers = monthly_orders(spark, SF_DIR), given(spark, SF_DIR, "customer")
    joined = left_join(customers, orders, "c_custkey", "o_custkey", ["o_orderkey"], HotKeys(rows_per_task=15))
    text = plan(joined)
    assert "SortMergeJoin LeftOuter" in text
    assert "hashpartitioning(c_custkey" in text and "hashpartitioning(__right_key" in text and "__piece" in text


def test_join_without_hot_keys_is_plain(spark):
    orders, customers = monthly_orders(spark, SF_DIR), given(spark, SF_DIR, "customer")
    assert "__piece" not in plan(left_join(orders, customers, "o_custkey", "c_custkey", ["c_name"]))


def test_counts_read_no_columns_and_predicates_are_pushed(spark):
    table = spark.table(shared_monthly(spark, SF_DIR))
    assert "ReadSchema: struct<>" in plan(count_where(table))
    text = plan(max_where(given(spark, SF_DIR, "lineitem"), "l_quantity", "l_tax > 0.05"))
    assert "GreaterThan(l_tax,0.05)" in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text


@pytest.mark.parametrize("lookup", [last_step, previous_count])
def test_audit_lookups_are_one_pass(spark, lookup):
    text = plan(lookup(audit_history(spark, SF_DIR)))
    assert text.count("Scan parquet  (") == 1
    assert "Join" not in text and "Window" not in text


def test_inventory_reads_no_contents(spark):
    location = sources.table_location(spark, shared_monthly(spark, SF_DIR))
    text = plan(sources.partition_sizes(sources.partition_inventory(spark, location, "report_dt"), "report_dt"))
    assert "content" not in text
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in text


def test_narrowing_stays_in_generated_code(spark):
    schema = T.StructType([T.StructField("n", T.ShortType()), T.StructField("report_dt", T.StringType())])
    text = plan(narrow_to(spark.range(10).select(F.col("id").alias("n"), F.lit("d").alias("report_dt")), schema))
    assert "codegen id" in text and "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", PURE)
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
