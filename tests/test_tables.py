import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import sources
from martloom.operators import (
    append_row,
    count_where,
    declare_table,
    last_partition,
    max_where,
    overwrite_partitions,
    recover_partitions,
    recreate_table,
    redeclare_table,
    truncate_partitions,
)

SCHEMA = T.StructType(
    [
        T.StructField("a", T.ShortType(), True, {"comment": "it's a number"}),
        T.StructField("report_dt", T.StringType(), True, {"comment": "day"}),
    ]
)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "a int, report_dt string")


def stored(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


def partitions(spark, table):
    return sorted(r["partition"] for r in sources.list_partitions(spark, table).collect())


@pytest.fixture(params=["managed", "external"])
def mart(request, spark, space):
    location = space.path("mart") if request.param == "external" else None
    declare_table(spark, space.table("mart"), SCHEMA, "report_dt", location)
    return space.table("mart")


def test_declaration(spark, space, mart):
    facts = sources.table_facts(spark, mart)
    assert facts.partition_columns == ("report_dt",)
    assert facts.overwrite_mode == "dynamic"
    assert facts.location.endswith("/mart")
    assert spark.table(mart).dtypes == [("a", "smallint"), ("report_dt", "string")]
    comments = {c.name: c.description for c in spark.catalog.listColumns(mart)}
    assert comments == {"a": "it's a number", "report_dt": "day"}
    declare_table(spark, mart, SCHEMA, "report_dt")
    assert partitions(spark, mart) == []
    assert last_partition(sources.list_partitions(spark, mart)).collect() == []


def test_overwrite_replaces_only_its_partitions(spark, mart):
    overwrite_partitions(rows(spark, (1, "d1"), (2, "d2"), (3, "d3")), mart)
    overwrite_partitions(rows(spark, (9, "d2")), mart)
    overwrite_partitions(rows(spark, (9, "d2")), mart)
    assert stored(spark, mart) == [(1, "d1"), (3, "d3"), (9, "d2")]
    overwrite_partitions(rows(spark, (9, "d2")).where("false"), mart)
    assert stored(spark, mart) == [(1, "d1"), (3, "d3"), (9, "d2")]
    assert partitions(spark, mart) == [f"report_dt=d{i}" for i in (1, 2, 3)]
    assert last_partition(sources.list_partitions(spark, mart)).first()["partition"] == "report_dt=d3"


def test_overwrite_does_not_depend_on_the_session(spark, mart):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        overwrite_partitions(rows(spark, (1, "d1"), (2, "d2")), mart)
        overwrite_partitions(rows(spark, (3, "d2")), mart)
        assert stored(spark, mart) == [(1, "d1"), (3, "d2")]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_overwrite_refuses_a_table_in_static_mode(spark, space):
    spark.sql(
        f"CREATE TABLE {space.table('plain')} (a smallint, report_dt string) "
        "USING parquet PARTITIONED BY (report_dt)"
    )
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        with pytest.raises(ValueError, match="dynamic"):
            overwrite_partitions(rows(spark, (1, "d1")), space.table("plain"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def test_rebalance_splits_a_heavy_date_and_merges_light_ones(spark, space):
    schema = T.StructType().add("a", T.LongType()).add("t", T.StringType()).add("report_dt", T.StringType())
    declare_table(spark, space.table("mart"), schema, "report_dt")
    day = F.when(F.col("id") % 3 == 0, "heavy").otherwise(F.concat(F.lit("d"), F.col("id") % 40))
    data = spark.range(0, 60000, 1, 12).select(
        F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 512).alias("t"), day.alias("report_dt")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        overwrite_partitions(data, space.table("mart"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    paths = spark.table(space.table("mart")).groupBy("report_dt").agg(
        F.countDistinct("_metadata.file_path").alias("files"), F.count("*").alias("n")
    )
    files = {r["report_dt"]: (r["files"], r["n"]) for r in paths.collect()}
    assert files.pop("heavy")[0] >= 4
    assert sum(n for _, n in files.values()) == 40000
    assert sum(f for f, _ in files.values()) < 12 * len(files) / 2


def test_overwrite_narrows_and_fails_whole(spark, mart):
    overwrite_partitions(rows(spark, (1, "d1")), mart)
    with pytest.raises(PySparkException):
        overwrite_partitions(rows(spark, (2, "d1"), (40000, "d2")), mart)
    assert stored(spark, mart) == [(1, "d1")]
    overwrite_partitions(rows(spark, (2, "d1"), (40000, "d2")), mart, on_overflow="null")
    assert stored(spark, mart) == [(2, "d1"), (None, "d2")]


def test_scan_partition(spark, mart):
    overwrite_partitions(rows(spark, (1, "2024-01-01"), (2, "2024-01-02")), mart)
    one = sources.scan_partition(spark, mart, "report_dt", "2024-01-02")
    assert one.columns == ["a"] and [r["a"] for r in one.collect()] == [2]
    folder = f"{sources.table_location(spark, mart)}/report_dt=2024-01-01"
    assert sources.scan_partition_path(spark, folder, SCHEMA[:-1]).collect() == [(1,)]
    assert [r["a"] for r in sources.scan_table(spark, mart).orderBy("a").collect()] == [1, 2]


def test_recreate_keeps_files_and_applies_the_new_definition(spark, space):
    table, folder = space.table("mart"), space.path("ext")
    declare_table(spark, table, SCHEMA, "report_dt", folder)
    overwrite_partitions(rows(spark, (1, "d1"), (2, "d2")), table)
    wider = SCHEMA[:-1].add("b", "string").add(SCHEMA[-1])
    recreate_table(spark, table, wider, folder, "report_dt")
    assert stored(spark, table) == [(1, None, "d1"), (2, None, "d2")]


def test_recreate_starts_from_nothing_and_refuses_managed_tables(spark, space):
    recreate_table(spark, space.table("new"), SCHEMA, space.path("new"), "report_dt")
    assert stored(spark, space.table("new")) == []
    declare_table(spark, space.table("kept"), SCHEMA, "report_dt")
    with pytest.raises(ValueError, match="managed"):
        recreate_table(spark, space.table("kept"), SCHEMA, space.path("kept"), "report_dt")


def test_recover_adds_new_and_drops_stale_partitions(spark, space):
    table, folder = space.table("mart"), space.path("ext")
    declare_table(spark, table, SCHEMA, "report_dt", folder)
    overwrite_partitions(rows(spark, (1, "d1")), table)
    found = spark.createDataFrame([(5, "d5")], "a smallint, report_dt string")
    found.write.mode("append").partitionBy("report_dt").parquet(folder)
    assert stored(spark, table) == [(1, "d1")]
    recover_partitions(spark, table)
    assert stored(spark, table) == [(1, "d1"), (5, "d5")]
    nothing = spark.createDataFrame([], "a smallint, report_dt string").write.mode("overwrite")
    nothing.option("partitionOverwriteMode", "static").partitionBy("report_dt").parquet(folder)
    assert len(partitions(spark, table)) == 2
    recover_partitions(spark, table)
    assert partitions(spark, table) == []


@pytest.mark.parametrize(
    ("low", "high", "left"),
    [
        ("2024-01-02", "2024-01-03", ["2024-01-01", "2024-01-04"]),
        ("", "2024-01-01", ["2024-01-02", "2024-01-03", "2024-01-04"]),
        ("2024-01-04", "", ["2024-01-01", "2024-01-02", "2024-01-03"]),
        ("", "", []),
    ],
)
def test_truncate(spark, mart, low, high, left):
    overwrite_partitions(rows(spark, *((i, f"2024-01-0{i}") for i in (1, 2, 3, 4))), mart)
    assert truncate_partitions(spark, mart, low, high) == 4 - len(left)
    assert partitions(spark, mart) == [f"report_dt={d}" for d in left]
    recover_partitions(spark, mart)
    assert [d for _, d in stored(spark, mart)] == left


def test_truncate_of_odd_and_null_values(spark, mart):
    overwrite_partitions(rows(spark, (1, "a b:c/d'e%"), (2, None), (3, "2024-01-01")), mart)
    assert len(partitions(spark, mart)) == 3
    assert truncate_partitions(spark, mart, "2024-01-01", "2024-01-01") == 1
    assert stored(spark, mart) == [(1, "a b:c/d'e%"), (2, None)]
    assert truncate_partitions(spark, mart, "2") == 2
    recover_partitions(spark, mart)
    assert stored(spark, mart) == []


def test_truncate_of_two_level_partitions(spark, space):
    schema = T.StructType.fromDDL("a int, platform string, report_dt string")
    table = space.table("two")
    spark.sql(
        f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet "
        f"OPTIONS (partitionOverwriteMode='dynamic') PARTITIONED BY (platform, report_dt) "
        f"LOCATION '{space.path('two')}'"
    )
    data = [(1, "web", "2022-10-04"), (2, "app", "2022-10-05"), (3, "web", "2022-10-05")]
    overwrite_partitions(spark.createDataFrame(data, schema), table)
    truncate_partitions(spark, table, "2022-10-05", "2022-10-05")
    recover_partitions(spark, table)
    assert stored(spark, table) == [(1, "web", "2022-10-04")]


def test_append_row(spark, space):
    table = space.table("log")
    declare_table(spark, table, T.StructType.fromDDL("id int, note string, n bigint"))
    append_row(spark, table, id=1, n=5)
    append_row(spark, table, note="x")
    assert stored(spark, table) == [(1, None, 5), (None, "x", None)]
    with pytest.raises(ValueError, match="current_count"):
        append_row(spark, table, id=1, current_count=5)


def test_aggregates(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b"), (None, "b")], "n int, k string")
    assert count_where(df).first()[0] == 3
    assert count_where(df, "k = 'b'").first()[0] == 2
    assert count_where(df, F.col("n") > 1).first()[0] == 1
    assert max_where(df, "n").first()[0] == 5
    assert max_where(df, "k", "n = 1").first()[0] == "a"
    assert max_where(df, "n", "1=0").collect() == [(None,)]


def retyped(schema, **types):
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in schema])


WIDE = T.StructType().add("a", T.IntegerType()).add("b", T.LongType()).add("c", T.StringType()).add("report_dt", T.StringType())


def test_changed_types_apply_to_old_files(spark, space):
    table, folder = space.table("mart"), space.path("ext")
    declare_table(spark, table, WIDE, "report_dt", folder)
    data = [(1, 5, "7", "d1"), (None, 6, None, "d2"), (3, None, "9", None)]
    overwrite_partitions(spark.createDataFrame(data, WIDE), table)
    changed = retyped(WIDE, a=T.StringType(), b=T.IntegerType(), c=T.DoubleType())
    changed = T.StructType([*changed[:-1], T.StructField("new", T.LongType()), changed[-1]])
    recreate_table(spark, table, changed, folder, "report_dt")
    assert stored(spark, table) == sorted([("1", 5, 7.0, None, "d1"), (None, 6, None, None, "d2"), ("3", None, 9.0, None, None)], key=repr)
    overwrite_partitions(spark.createDataFrame([("x", 1, 1.5, 2, "d2")], changed), table)
    assert len(stored(spark, table)) == 3
    # Nothing to do the second time.
    modified = sources.folder_times(spark, folder, 1)
    recreate_table(spark, table, changed, folder, "report_dt")
    assert sources.folder_times(spark, folder, 1) == modified


def test_a_value_that_does_not_fit_leaves_the_definition(spark, space):
    table, folder = space.table("mart"), space.path("ext")
    declare_table(spark, table, WIDE, "report_dt", folder)
    overwrite_partitions(spark.createDataFrame([(1, 5, "x", "d1"), (2, 2**40, "y", "d2")], WIDE), table)
    narrow = retyped(WIDE, b=T.IntegerType())
    with pytest.raises(PySparkException, match="does not fit"):
        recreate_table(spark, table, narrow, folder, "report_dt")
    assert stored(spark, table) == [(1, 5, "x", "d1"), (2, 2**40, "y", "d2")]
    overwrite_partitions(spark.createDataFrame([(2, 9, "y", "d2")], WIDE), table)
    assert redeclare_table(spark, table, narrow, folder, "report_dt")
    assert stored(spark, table) == [(1, 5, "x", "d1"), (2, 9, "y", "d2")]


def test_changed_types_of_an_unpartitioned_table(spark, space):
    table, folder = space.table("log"), space.path("log")
    schema = T.StructType.fromDDL("id int, note string")
    redeclare_table(spark, table, schema, folder)
    for n in range(3):
        append_row(spark, table, id=n, note=str(n))
    changed = T.StructType.fromDDL("id string, note int, more string")
    assert redeclare_table(spark, table, changed, folder)
    append_row(spark, table, id="x")
    assert stored(spark, table) == sorted([("0", 0, None), ("1", 1, None), ("2", 2, None), ("x", None, None)], key=repr)
    assert not redeclare_table(spark, table, changed, folder)


def test_changed_types_in_two_levels(spark, space):
    table, folder = space.table("two"), space.path("two")
    schema = T.StructType.fromDDL("a int, platform string, report_dt string")
    declare_table(spark, table, schema, ("platform", "report_dt"), folder)
    overwrite_partitions(spark.createDataFrame([(1, "a/b", "d1"), (2, "WEB", "d 2"), (3, None, "d1")], schema), table)
    recreate_table(spark, table, retyped(schema, a=T.StringType()), folder, ("platform", "report_dt"))
    assert stored(spark, table) == sorted([("1", "a/b", "d1"), ("2", "WEB", "d 2"), ("3", None, "d1")], key=repr)
