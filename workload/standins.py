"""Mart inputs made from the given tables, and tables written from them."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.config import MartSpec
from martloom.operators import declare_table, overwrite_partitions
from martloom.plans import AUDIT_SCHEMA
from martloom.session import scratch_dir

MONTH = "2001-07-01"

MONTHLY_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), True, {"comment": "order"}),
        T.StructField("o_custkey", T.LongType(), True, {"comment": "customer"}),
        T.StructField("o_orderstatus", T.StringType(), True, {"comment": "status"}),
        T.StructField("o_totalprice", T.DoubleType(), True, {"comment": "amount"}),
        T.StructField("o_orderpriority", T.StringType(), True, {"comment": "priority"}),
        T.StructField("report_dt", T.StringType(), True, {"comment": "first day of the order's month"}),
    ]
)

ORDERS_MART = MartSpec(
    schema=T.StructType(
        [
            T.StructField("ctl_loading", T.IntegerType()),
            T.StructField("ctl_validfrom", T.StringType()),
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("c_mktsegment", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("total", T.FloatType()),
            T.StructField("report_dt", T.StringType()),
        ]
    ),
    profile_key="o_custkey",
    reference_key="c_custkey",
    from_reference=("c_mktsegment", "c_nationkey"),
)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def monthly_orders(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """Orders with ``report_dt``, the first day of the order's month. A month
    is asked for as a range of the stored column, which the scan can use."""
    orders = given(spark, sf_dir, "orders")
    if month:
        first = date.fromisoformat(month)
        after = date(first.year + first.month // 12, first.month % 12 + 1, 1)
        ordered = F.col("o_orderdate")
        orders = orders.where(
            (ordered >= F.to_timestamp_ntz(F.lit(f"{first} 00:00:00")))
            & (ordered < F.to_timestamp_ntz(F.lit(f"{after} 00:00:00")))
        )
    report_dt = F.trunc(F.col("o_orderdate").cast("date"), "month").cast("string")
    return orders.withColumn("report_dt", report_dt)


def orders_profile(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    orders = monthly_orders(spark, sf_dir, month).withColumnRenamed("o_totalprice", "total")
    return orders.drop("o_orderdate")


def corporate_profile(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """One row per customer and month with the corporate mart's features."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return (
        monthly_orders(spark, sf_dir, month)
        .groupBy(F.col("o_custkey").cast("string").alias("inn"), "report_dt")
        .agg(
            F.max(F.dayofmonth(F.col("o_orderdate").cast("date"))).alias("days_from_registration"),
            F.count_if(status == "O").alias("op_tech_other_bank_cnt"),
            F.max(price).alias("balance_rs"),
            F.count_if(status == "F").alias("out_tech_our_bank_contragents"),
            F.count_if(status == "P").alias("in_tech_our_bank_contragents"),
            F.count("*").alias("in_tech_our_bank_cnt"),
            F.min(price).alias("op_tech_our_bank_amt"),
            F.count_if(priority == "1-URGENT").alias("op_pays_our_bank_cnt"),
            F.count_if(priority == "2-HIGH").alias("out_pays_our_bank_cnt"),
            F.count_if(priority == "5-LOW").alias("in_pays_our_bank_contragents"),
            F.max(F.when(status == "F", price)).alias("op_pays_our_bank_amt"),
        )
    )


def corporate_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; those of nation 20 and above have no key, so their
    profiles stay unmatched."""
    return given(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") < 20, F.col("c_custkey").cast("string")).alias("inn"),
        F.col("c_nationkey").cast("string").alias("okved_cd"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("sector"),
        F.when(F.col("c_acctbal") < 0, "debtor").otherwise("holder").alias("kopf_nm"),
    )


def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per event, as if each event were a run."""
    started = F.substring(F.col("ts").cast("string"), 1, 19)
    return given(spark, sf_dir, "events").select(
        (F.col("event_id") % 2147483647).cast("int").alias("ctl_loading"),
        started.alias("ctl_validfrom"),
        F.concat(F.lit("report_dt="), F.substring(started, 1, 10)).alias("partitions"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_force_load"),
        (F.col("user_id") % 4).cast("int").alias("last_success_step"),
        F.lit(3).alias("last_step_in_general"),
        F.col("user_id").alias("count_rows"),
        F.lit(1).alias("is_change"),
    )


def monthly_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*MONTHLY_SCHEMA.fieldNames())


class Workspace:
    """A database of its own in the shared scratch folder. Results are lazy, so
    its files outlive the call that made them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_dir(spark)
        self.database = f"martloom_{uuid.uuid4().hex}"
        spark.sql(
            "CREATE DATABASE IDENTIFIER(:d) LOCATION :folder",
            args={"d": self.database, "folder": f"{self.folder}/managed"},
        )
        # The catalog's entries end with the session; so do the files.
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def monthly(self, rows: DataFrame, name: str = "monthly", external: bool = False) -> str:
        """A table partitioned by month, declared and filled."""
        table = self.table(name)
        location = self.path(name) if external else None
        declare_table(self.spark, table, MONTHLY_SCHEMA, "report_dt", location)
        overwrite_partitions(monthly_columns(rows), table)
        return table

    def audit(self, rows: DataFrame | None = None) -> str:
        table = self.table("audit")
        declare_table(self.spark, table, AUDIT_SCHEMA)
        if rows is not None:
            rows.select(*AUDIT_SCHEMA.fieldNames()).write.insertInto(table)
        return table


_shared: dict[tuple[str, str], str] = {}


def shared_monthly(spark: SparkSession, sf_dir: str) -> str:
    """The monthly orders table, written once per application for all queries
    that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shared or not spark.catalog.tableExists(_shared[key]):
        _shared[key] = Workspace(spark).monthly(monthly_orders(spark, sf_dir))
    return _shared[key]
