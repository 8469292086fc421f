from datetime import datetime, timedelta

import pytest
from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import Lifetime
from martloom.functions import (
    change_flag,
    date_suffix,
    in_date_suffix_range,
    narrow_to,
    partition_value,
    report_date,
    retention_cutoff,
    target_file_count,
)
from martloom.functions.narrowing import narrow

SHORT = T.StructType([T.StructField("n", T.ShortType())])


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_partition_text(spark):
    paths = spark.createDataFrame(
        [
            ("hdfs://n/t/platform=WEB/report_dt=2022-10-05",),
            ("report_dt=2022-10-04/part-0.parquet",),
            ("report_dt=2022-10-04/report_dt=2020-01-01",),
            ("no partition here",),
            ("short",),
        ],
        "p string",
    )
    assert values(paths, partition_value("p", "report_dt")) == [
        "2022-10-05", "2022-10-04", "2022-10-04", "", "",
    ]
    assert values(paths, report_date("p")) == ["2022-10-05", "2022-10-04", "2022-10-04", "", ""]
    assert values(paths, date_suffix("p"))[0] == "2022-10-05"
    assert values(paths, date_suffix("p"))[4] == "short"


def test_partition_name_is_not_a_pattern(spark):
    paths = spark.createDataFrame([("axb=1/a.b=2",)], "p string")
    assert values(paths, partition_value("p", "a.b")) == ["2"]


@pytest.mark.parametrize(
    ("low", "high", "kept"),
    [
        ("", "", ["01", "02", "03"]),
        ("2024-01-02", "", ["02", "03"]),
        ("", "2024-01-02", ["01", "02"]),
        ("2024-01-02", "2024-01-02", ["02"]),
        ("2024-01-03", "2024-01-01", []),
    ],
)
def test_date_suffix_range(spark, low, high, kept):
    rows = spark.createDataFrame([(f"report_dt=2024-01-0{i}",) for i in (1, 2, 3)], "p string")
    inside = rows.where(in_date_suffix_range("p", low, high)).collect()
    assert sorted(row["p"][-2:] for row in inside) == kept


@pytest.mark.parametrize(
    ("start", "lifetime", "cutoff"),
    [
        ("2024-03-31 06:00:00", Lifetime(months=1), "2024-02-29 06:00:00"),
        ("2024-02-29 06:00:00", Lifetime(years=1), "2023-02-28 06:00:00"),
        ("2024-03-31 06:00:00", Lifetime(months=1, days=1), "2024-02-28 06:00:00"),
        ("2024-01-01 00:00:00", Lifetime(days=1), "2023-12-31 00:00:00"),
    ],
)
def test_retention_cutoff(spark, start, lifetime, cutoff):
    row = spark.createDataFrame([(start,)], "s string")
    assert values(row, retention_cutoff(F.to_timestamp("s"), lifetime)) == [cutoff]
    assert values(row, retention_cutoff(F.to_timestamp_ntz("s"), lifetime)) == [cutoff]


def test_retention_cutoff_ignores_summer_time(spark):
    row = spark.createDataFrame([("2024-04-02 00:30:00",), ("2024-11-05 00:30:00",)], "s string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cutoffs = values(row, retention_cutoff(F.to_timestamp("s"), Lifetime(days=30)))
        gap = values(row.limit(1), retention_cutoff(F.to_timestamp_ntz(F.lit("2024-04-10 02:30:00")), Lifetime(months=1)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert cutoffs == ["2024-03-03 00:30:00", "2024-10-06 00:30:00"]
    assert gap == ["2024-03-10 02:30:00"]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.datetimes(datetime(1990, 1, 1), datetime(2040, 1, 1)), min_size=1, max_size=40),
    st.integers(0, 400), st.integers(0, 40), st.integers(0, 9),
)
def test_retention_cutoff_agrees_with_calendar_subtraction(spark, starts, days, months, years):
    if not (days or months or years):
        days = 1
    starts = [start.replace(microsecond=0) for start in starts]
    rows = spark.createDataFrame([(str(start),) for start in starts], "s string")
    got = values(rows, retention_cutoff(F.to_timestamp_ntz("s"), Lifetime(days, months, years)))
    want = [start - relativedelta(days=days, months=months, years=years) for start in starts]
    assert got == [w.strftime("%Y-%m-%d %H:%M:%S") for w in want]


@pytest.mark.parametrize(
    "lifetime", [{}, {"days": 0, "months": 0, "years": 0}, {"days": -1}, {"months": 1.5}, {"years": ""}]
)
def test_lifetime_must_be_positive(lifetime):
    with pytest.raises(ValueError):
        Lifetime(**lifetime)


def test_target_file_count(spark):
    block = 128
    sizes = spark.createDataFrame([(0,), (1,), (127,), (128,), (129,), (256,), (2**60,)], "b bigint")
    assert values(sizes, target_file_count("b", block)) == [1, 1, 1, 2, 2, 3, 2**53 + 1]


def test_change_flag(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, None)], "p bigint, c bigint")
    assert values(rows, change_flag("p", "c")) == [0, 1, 1, 0]
    assert values(rows, change_flag("p", "c", force=True)) == [1, 1, 1, 1]


def test_narrowing_to_null(spark):
    rows = spark.createDataFrame([(32767,), (32768,), (-32768,), (-32769,), (None,)], "n int")
    assert [r["n"] for r in narrow_to(rows, SHORT, "null").collect()] == [32767, None, -32768, None, None]


@pytest.mark.parametrize("kind", ["double", "decimal(20,2)", "bigint", "float"])
@pytest.mark.parametrize("to", [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()])
def test_narrowing_of_numbers_agrees_with_try_cast(spark, kind, to):
    edges = [f"{s}{2 ** b + d}{f}" for b in (7, 15, 31) for s in ("", "-") for d in (-1, 0, 1) for f in ("", ".99")]
    numbers = spark.createDataFrame([(e,) for e in [*edges, "0", None, "NaN", "Infinity"]], "s string")
    rows = numbers.select(F.col("s").try_cast(kind).alias("n"), F.col("s").try_cast(kind).try_cast(to).alias("want"))
    out = narrow_to(rows.select("n"), T.StructType([T.StructField("n", to)]), "null")
    assert [r["n"] for r in out.collect()] == [r["want"] for r in rows.collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_narrowing_raises_in_either_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fine = spark.createDataFrame([(32767,), (None,)], "n int")
        assert [r["n"] for r in narrow_to(fine, SHORT).collect()] == [32767, None]
        with pytest.raises(PySparkException, match="32768"):
            narrow_to(spark.createDataFrame([(32768,)], "n int"), SHORT).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_narrowing_text(spark):
    rows = spark.createDataFrame([("7",), (None,)], "n string")
    assert [r["n"] for r in narrow_to(rows, SHORT).collect()] == [7, None]
    with pytest.raises(PySparkException, match="seven"):
        narrow_to(spark.createDataFrame([("seven",)], "n string"), SHORT).collect()


def test_narrowing_matches_columns_by_name(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.FloatType())])
    rows = spark.createDataFrame([(1.5, 2)], "b double, a int")
    out = narrow_to(rows, schema)
    assert out.dtypes == [("a", "int"), ("b", "float")]
    assert out.first() == (2, 1.5)
    with pytest.raises(ValueError, match="missing"):
        narrow_to(rows.drop("a"), schema)
    with pytest.raises(ValueError, match="unknown"):
        narrow_to(rows.withColumn("c", F.lit(1)), schema)


def test_unneeded_checks_leave_no_trace(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType())])
    rows = spark.createDataFrame([(1, 2.0)], "n int, x float")
    plan = narrow_to(rows, schema)._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" not in plan


def test_run_start_text_is_second_resolution(spark):
    from martloom.session import run_start

    before = datetime.now() - timedelta(days=1)
    assert datetime.strptime(run_start(spark), "%Y-%m-%d %H:%M:%S") > before


@pytest.mark.parametrize("source", [T.DoubleType(), None], ids=["known", "unknown"])
def test_doubles_beyond_a_float_do_not_become_infinite(spark, source):
    df = spark.createDataFrame([(1e300,), (1.5,), (float("inf"),), (float("nan"),), (None,)], "x double")
    kept = df.select(narrow(F.col("x"), T.FloatType(), "x", "null", source).alias("y")).collect()
    assert [repr(r["y"]) for r in kept] == ["None", "1.5", "inf", "nan", "None"]
    with pytest.raises(Exception, match="does not fit float"):
        df.select(narrow(F.col("x"), T.FloatType(), "x", source=source)).collect()
    texts = spark.createDataFrame([("1e300",), ("-Infinity",), ("1e400",), ("2",)], "x string")
    kept = texts.select(narrow(F.col("x"), T.FloatType(), "x", "null", T.StringType()).alias("y")).collect()
    assert [repr(r["y"]) for r in kept] == ["None", "-inf", "None", "2.0"]


def test_sources_that_fit_a_float_are_not_checked(spark):
    for name in ("float", "int", "bigint", "decimal(38,0)"):
        df = spark.range(1).selectExpr(f"CAST(id AS {name}) AS x")
        text = df.select(narrow(F.col("x"), T.FloatType(), "x", source=df.schema["x"].dataType))._jdf.queryExecution().toString()
        assert "raise_error" not in text and "CASE" not in text
