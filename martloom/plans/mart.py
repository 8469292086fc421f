"""Mart build: one report date of a profile, enriched, stamped, stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.config import MartSpec
from martloom.functions import narrow_to, partition_value
from martloom.operators.ddl import redeclare_table
from martloom.operators.joins import HotKeys, left_join
from martloom.operators.partitions import NULL_PARTITION, stored_value, truncate_partitions
from martloom.operators.projections import filter_report_date, stamp_load
from martloom.operators.sinks import overwrite_partitions
from martloom.sources.footers import MOST_FILES, rows_at_most, stored_files
from martloom.sources.tables import is_external, list_partitions, table_location


def _column(name: str, type_: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, type_, True, {"comment": comment})


# Names, types and order of the corporate mart's columns.
CORPORATE_MART = MartSpec(
    schema=T.StructType(
        [
            _column("ctl_loading", T.IntegerType(), "load id"),
            _column("ctl_validfrom", T.StringType(), "run start"),
            _column("inn", T.StringType(), "tax id"),
            _column("okved_cd", T.StringType(), "activity code"),
            _column("segment", T.StringType(), "segment"),
            _column("sector", T.StringType(), "sector"),
            _column("kopf_nm", T.StringType(), "legal form"),
            _column("days_from_registration", T.ShortType(), "days since registration"),
            _column("op_tech_other_bank_cnt", T.ShortType(), "payments, other bank accounts"),
            _column("balance_rs", T.FloatType(), "month-end balance"),
            _column("out_tech_our_bank_contragents", T.ShortType(), "counterparties, outgoing"),
            _column("in_tech_our_bank_contragents", T.ShortType(), "counterparties, incoming"),
            _column("in_tech_our_bank_cnt", T.ShortType(), "payments, incoming"),
            _column("op_tech_our_bank_amt", T.FloatType(), "payment amount"),
            _column("op_pays_our_bank_cnt", T.ShortType(), "payments between accounts"),
            _column("out_pays_our_bank_cnt", T.ShortType(), "outgoing payments between accounts"),
            _column("in_pays_our_bank_contragents", T.ShortType(), "counterparties between accounts"),
            _column("op_pays_our_bank_amt", T.FloatType(), "payment amount between accounts"),
            _column("report_dt", T.StringType(), "report date"),
        ]
    ),
    profile_key="inn",
    reference_key="inn",
    from_reference=("okved_cd", "segment", "sector", "kopf_nm"),
)


def mart_rows(
    profile: DataFrame,
    reference: DataFrame,
    spec: MartSpec,
    date: str,
    load_id: int,
    run_start: str,
    on_overflow: str = "raise",
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """The rows of one report date in the mart's column order and types.

    The date filter and the column lists come first, so both reach the scans.
    """
    wanted = dict.fromkeys((spec.profile_key, *spec.from_profile))
    slice_ = filter_report_date(profile, date, spec.partition_column).select(*wanted)
    joined = left_join(
        slice_, reference, spec.profile_key, spec.reference_key, spec.from_reference, hot_keys
    )
    stamped = stamp_load(joined, load_id, run_start, spec.load_id_column, spec.run_start_column)
    return narrow_to(stamped.select(*spec.schema.fieldNames()), spec.schema, on_overflow)


def build_mart(
    spark: SparkSession,
    target: str,
    profile: DataFrame,
    reference: DataFrame,
    spec: MartSpec,
    date: str,
    load_id: int,
    run_start: str,
    on_overflow: str = "raise",
    hot_keys: HotKeys | None = HotKeys(),
) -> None:
    """Compute one report date and replace that partition of ``target``: once,
    in files of about a block."""
    rows = mart_rows(profile, reference, spec, date, load_id, run_start, on_overflow, hot_keys)
    overwrite_partitions(rows, target, on_overflow, rebalance="blocks")


def newest_loaded_date(spark: SparkSession, table: str, partition_column: str) -> str | None:
    """Largest partition value that has rows; None when there is none.

    Same answer as a maximum over the rows, but read from the partition list:
    the newest partition normally has rows, and the footer of a file of it says
    so. No Spark job runs, but for a partition with very many empty files.
    """
    values = (
        list_partitions(spark, table)
        .select(partition_value("partition", partition_column).alias("value"))
        .where(F.col("value") != NULL_PARTITION)
        .distinct()
        .collect()
    )
    for value in sorted((stored_value(row["value"]) for row in values), reverse=True):
        if _has_rows(spark.table(table).where(F.col(partition_column) == value)):
            return value
    return None


def _has_rows(rows: DataFrame) -> bool:
    """Whether a part of a stored table has a row: its footers say, file by
    file; beyond a few files, a query for one row does."""
    files = stored_files(rows)
    if files is not None:
        if not rows_at_most(rows.sparkSession, files[:MOST_FILES], 0):
            return True
        if len(files) <= MOST_FILES:
            return False
    return bool(rows.select(F.lit(1)).head(1))


def resolve_date(
    spark: SparkSession, table: str, partition_column: str, default_date: str, force: bool
) -> str:
    """The date to load. A given date is replaced by the newest one already
    loaded, unless the load is forced; without a date nothing is resolved."""
    if force:
        if not default_date:
            raise ValueError("a forced load needs a date: it removes every partition and loads that one")
        return default_date
    if not default_date:
        return default_date
    newest = newest_loaded_date(spark, table, partition_column)
    if newest is None:
        raise ValueError(f"{table} is empty: run a forced load first")
    return newest


def force_reload(spark: SparkSession, table: str, spec: MartSpec) -> None:
    """Remove every partition and apply the current table definition. The
    caller then loads the one date it was given."""
    truncate_partitions(spark, table)
    if is_external(spark, table):
        redeclare_table(spark, table, spec.schema, table_location(spark, table), spec.partitions)
