import time
from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import Lifetime, sources
from martloom.operators import declare_table, overwrite_partitions, recover_partitions, truncate_partitions
from martloom.plans import (
    apply_retention,
    compact_partitions,
    compaction_plan,
    newest_loaded_date,
    resolve_date,
    retention_plan,
)
from martloom.session import run_start, scratch_dir
from martloom.sources.literals import literal_rows

SCHEMA = T.StructType().add("a", T.LongType()).add("t", T.StringType()).add("report_dt", T.StringType())


def next_second(spark):
    """The start of a new second, later than every file written before."""
    now = run_start(spark)
    while (later := run_start(spark)) == now:
        time.sleep(0.05)
    return later


def make(spark, space, days, n=400, external=False):
    table = space.table("mart")
    declare_table(spark, table, SCHEMA, "report_dt", space.path("mart") if external else None)
    day = F.element_at(F.array(*(F.lit(d) for d in days)), (F.col("id") % len(days) + 1).cast("int"))
    rows = spark.range(0, n * len(days), 1, 6).select(
        F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 512).alias("t"), day.alias("report_dt")
    )
    overwrite_partitions(rows, table, rebalance=False)
    return table


def sizes(spark, table):
    inventory = sources.partition_inventory(spark, sources.table_location(spark, table), "report_dt")
    return sources.partition_sizes(inventory, "report_dt")


def files(spark, table):
    return {r["report_dt"]: r["files"] for r in sizes(spark, table).collect()}


def content(spark, table):
    checks = F.count("*"), F.sum("a"), F.countDistinct("t")
    return sorted(tuple(r) for r in spark.table(table).groupBy("report_dt").agg(*checks).collect())


def test_inventory_of_an_empty_table(spark, space):
    declare_table(spark, space.table("mart"), SCHEMA, "report_dt", space.path("mart"))
    assert files(spark, space.table("mart")) == {}
    assert compact_partitions(spark, space.table("mart")) == []
    assert apply_retention(spark, space.table("mart"), "report_dt", run_start(spark), Lifetime(days=1)) == 0


def test_inventory_ignores_markers_and_files_outside_partitions(spark, space):
    table = make(spark, space, ["d1"], external=True)
    location = sources.table_location(spark, table)
    spark.range(1).write.parquet(f"{location}/stray")
    assert set(files(spark, table)) == {"d1"}


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata", "+03:00"])
def zone(request, spark):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_touched_partitions_and_since(spark, space, zone):
    table = make(spark, space, ["d1", "d2", "d3"])
    started = next_second(spark)
    overwrite_partitions(spark.table(table).where("report_dt = 'd2'"), table)
    touched = sources.touched_partitions(spark, sources.table_location(spark, table), "report_dt", started)
    assert [r["report_dt"] for r in touched.collect()] == ["d2"]
    location = sources.table_location(spark, table)
    since = sources.partition_inventory(spark, location, "report_dt", since=started)
    assert {r["report_dt"] for r in since.collect()} == {"d2"}
    modified = F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss")
    newest = since.select(F.max(modified)).first()[0]
    same_second = sources.partition_inventory(spark, location, "report_dt", since=newest)
    assert {r["report_dt"] for r in same_second.collect()} == {"d2"}


def test_compaction_plan(spark):
    given = spark.createDataFrame(
        [("a", 3, 0), ("b", 3, 127), ("c", 3, 128), ("d", 3, 129)], "report_dt string, files int, bytes bigint"
    )
    plan = {r["report_dt"]: r["target_files"] for r in compaction_plan(given, 128).collect()}
    assert plan == {"b": 1, "c": 2, "d": 2}


@pytest.mark.parametrize("external", [False, True])
def test_compaction_merges_files_and_keeps_rows(spark, space, external):
    table = make(spark, space, ["d1", "d2"], external=external)
    before = content(spark, table)
    assert files(spark, table) == {"d1": 6, "d2": 6}
    report = compact_partitions(spark, table)
    assert [(r["report_dt"], r["target_files"]) for r in report] == [("d1", 1), ("d2", 1)]
    assert files(spark, table) == {"d1": 1, "d2": 1}
    assert content(spark, table) == before
    assert compact_partitions(spark, table) == []


def test_compaction_splits_by_bytes(spark, space):
    table = make(spark, space, ["d1", "d2"], n=2000)
    before = content(spark, table)
    block = max(r["bytes"] for r in sizes(spark, table).collect()) // 3
    report = compact_partitions(spark, table, block_bytes=block)
    assert {r["report_dt"]: r["target_files"] for r in report} == files(spark, table)
    assert all(r["target_files"] in (3, 4) for r in report)
    assert content(spark, table) == before
    per_file = spark.table(table).groupBy("_metadata.file_path").count()
    counts = [r["count"] for r in per_file.collect()]
    assert max(counts) < 2 * min(counts)


def test_compaction_of_touched_partitions_only(spark, space, zone):
    table = make(spark, space, ["d1", "d2", "d3"])
    started = next_second(spark)
    again = spark.table(table).where("report_dt = 'd2'").repartition(4)
    overwrite_partitions(again, table, rebalance=False)
    before = content(spark, table)
    assert [r["report_dt"] for r in compact_partitions(spark, table, started)] == ["d2"]
    assert files(spark, table) == {"d1": 6, "d2": 1, "d3": 6}
    assert content(spark, table) == before


def test_compaction_counts_older_files_of_a_touched_partition(spark, space):
    table = make(spark, space, ["d1", "d2"])
    started = next_second(spark)
    extra = spark.createDataFrame([(-1, "x", "d1")], SCHEMA)
    extra.write.insertInto(table)
    before = content(spark, table)
    report = compact_partitions(spark, table, started)
    assert [(r["report_dt"], r["files"]) for r in report] == [("d1", 7)]
    assert content(spark, table) == before


def test_compaction_of_null_and_odd_partition_values(spark, space):
    table = make(spark, space, ["d1"])
    odd = spark.createDataFrame([(i, str(i), d) for i in range(40) for d in (None, "a:b c'%")], SCHEMA)
    overwrite_partitions(odd.repartition(5), table, rebalance=False)
    before = spark.table(table).count()
    compact_partitions(spark, table)
    assert all(n == 1 for n in files(spark, table).values())
    assert spark.table(table).count() == before
    assert spark.table(table).where("report_dt is null").count() == 40
    assert spark.table(table).where(F.col("report_dt") == "a:b c'%").count() == 40


def test_retention_plan_boundary(spark):
    days = ["2024-02-28", "2024-02-29", "2024-03-01", "2024-01-01"]
    listed = spark.createDataFrame([(f"report_dt={d}",) for d in days], "partition string")
    touched = spark.createDataFrame([("report_dt=2024-01-01",)], "partition string")
    plan = retention_plan(listed, touched, "report_dt", "2024-03-31 00:00:00", Lifetime(months=1))
    assert {r["value"]: r["expired"] for r in plan.collect()} == {
        "2024-02-28": True, "2024-02-29": True, "2024-03-01": False, "2024-01-01": False,
    }
    assert {r["cutoff"] for r in plan.collect()} == {"2024-02-29 00:00:00"}


@pytest.mark.parametrize("external", [False, True])
def test_retention_drops_files_and_catalog_entries(spark, space, external):
    today = date.fromisoformat(run_start(spark)[:10])
    days = [str(today - timedelta(days=n)) for n in (30, 11, 10, 9, 0)]
    table = make(spark, space, days, external=external)
    started = next_second(spark)
    refreshed = spark.table(table).where(F.col("report_dt") == days[0])
    time.sleep(1.1)
    overwrite_partitions(refreshed, table)
    assert apply_retention(spark, table, "report_dt", started, Lifetime(days=10)) == 2
    left = {days[0], days[3], days[4]}
    assert set(files(spark, table)) == left
    names = {r["partition"] for r in sources.list_partitions(spark, table).collect()}
    assert names == {f"report_dt={d}" for d in left}
    assert {r[0] for r in spark.table(table).select("report_dt").distinct().collect()} == left


def test_date_resolution(spark, space):
    table = make(spark, space, ["2024-01-31", "2024-02-29"])
    assert resolve_date(spark, table, "report_dt", "2020-01-01", force=False) == "2024-02-29"
    assert resolve_date(spark, table, "report_dt", "2020-01-01", force=True) == "2020-01-01"
    assert resolve_date(spark, table, "report_dt", "", force=False) == ""
    with pytest.raises(ValueError, match="needs a date"):
        resolve_date(spark, table, "report_dt", "", force=True)


def test_newest_date_skips_partitions_without_rows(spark, space):
    table = make(spark, space, ["2024-01-31"])
    overwrite_partitions(spark.createDataFrame([(1, "x", None)], SCHEMA), table)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (report_dt='2024-05-31')")
    assert newest_loaded_date(spark, table, "report_dt") == "2024-01-31"
    declare_table(spark, space.table("none"), SCHEMA, "report_dt")
    assert newest_loaded_date(spark, space.table("none"), "report_dt") is None
    with pytest.raises(ValueError, match="empty"):
        resolve_date(spark, space.table("none"), "report_dt", "2024-01-01", force=False)


def stub_session(shared, master):
    conf = SimpleNamespace(get=lambda key, default: shared if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder_follows_the_session(spark):
    named = stub_session("hdfs:///shared/", "yarn")
    first, second = scratch_dir(named), scratch_dir(named)
    assert first.startswith("hdfs:///shared/martloom/") and first != second
    assert scratch_dir(stub_session(None, "local[8]")).startswith("/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(stub_session(None, "yarn"))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_dir(spark).startswith(shared)


def test_jobs_do_not_grow_with_the_partitions_dropped(spark, space):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (2, 12):
        table = f"{space.database}.ext{n}"
        declare_table(spark, table, SCHEMA, "report_dt", space.path(f"ext{n}"))
        rows = spark.range(60).selectExpr("id AS a", "'x' AS t", f"CONCAT('2020-01-', LPAD(id % {n} + 1, 2, '0')) AS report_dt")
        overwrite_partitions(rows.select(*spark.table(table).columns), table)
        group = f"drop-{n}"
        spark.sparkContext.setJobGroup(group, group)
        truncate_partitions(spark, table, "2020-01-01", "2020-12-31")
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        recover_partitions(spark, table)
        assert spark.table(table).count() == 0 and sources.list_partitions(spark, table).count() == 0
    assert jobs[0] == jobs[1]


TWO_LEVELS = T.StructType().add("a", T.LongType()).add("platform", T.StringType()).add("report_dt", T.StringType())


def make_two_levels(spark, space, days):
    table = space.table("two")
    declare_table(spark, table, TWO_LEVELS, ("platform", "report_dt"))
    platform = F.when(F.col("id") % 2 == 0, "WEB").otherwise("a/b")
    day = F.element_at(F.array(*(F.lit(d) for d in days)), (F.floor(F.col("id") / 2) % len(days) + 1).cast("int"))
    rows = spark.range(0, 400, 1, 4).select(F.col("id").alias("a"), platform.alias("platform"), day.alias("report_dt"))
    overwrite_partitions(rows, table, rebalance=False)
    return table


def test_compaction_of_two_levels_ends(spark, space):
    table = make_two_levels(spark, space, ["d1", "d2"])
    before = sorted(tuple(r) for r in spark.table(table).collect())
    report = compact_partitions(spark, table, files_per_job=2)
    names = {r["partition"] for r in sources.list_partitions(spark, table).collect()}
    assert [r["partition"] for r in report] == sorted(names) and len(names) == 4
    assert {(r["files"], r["target_files"]) for r in report} == {(4, 1)}
    assert sorted(tuple(r) for r in spark.table(table).collect()) == before
    assert compact_partitions(spark, table) == []


def test_a_run_on_one_of_many_dates_lists_one_folder(spark, space):
    table = make_two_levels(spark, space, ["d1", "d2", "d3"])
    started = next_second(spark)
    one = spark.table(table).where("report_dt = 'd2' and platform = 'WEB'")
    overwrite_partitions(one.repartition(3), table, rebalance=False)
    location = sources.table_location(spark, table)
    folders = sources.changed_folders(spark, location, 2, started)
    assert [f.split("/two/")[1] for f in folders] == ["platform=WEB/report_dt=d2"]
    assert [r["partition"] for r in compact_partitions(spark, table, started)] == ["platform=WEB/report_dt=d2"]


def test_a_touched_platform_does_not_protect_another(spark, space):
    today = date.fromisoformat(run_start(spark)[:10])
    old, new = str(today - timedelta(days=30)), str(today)
    table = make_two_levels(spark, space, [old, new])
    started = next_second(spark)
    time.sleep(1.1)
    overwrite_partitions(spark.table(table).where(f"platform = 'WEB' and report_dt = '{old}'"), table)
    assert apply_retention(spark, table, "report_dt", started, Lifetime(days=10)) == 1
    left = {tuple(r) for r in spark.table(table).select("platform", "report_dt").distinct().collect()}
    assert left == {("WEB", old), ("WEB", new), ("a/b", new)}


def test_merging_keeps_rows_in_the_order_of_their_files(spark, space):
    table = space.table("mart")
    declare_table(spark, table, SCHEMA, "report_dt")
    for start in range(0, 6000, 1000):
        # Falling within each file, so that no sort by value can pass for it.
        rows = spark.range(start, start + 1000, 1, 1).select((-F.col("id")).alias("a"), F.lit("t").alias("t"), F.lit("d1").alias("report_dt"))
        rows.write.insertInto(table)
    assert files(spark, table) == {"d1": 6}
    largest = sizes(spark, table).first()["largest"]
    report = compact_partitions(spark, table, block_bytes=5 * largest // 2)
    assert [(r["merge"], r["target_files"]) for r in report] == [(True, 3)] and files(spark, table) == {"d1": 3}
    for (name,) in spark.table(table).select("_metadata.file_path").distinct().collect():
        got = [r["a"] for r in spark.read.parquet(name).collect()]
        assert len(got) in (1000, 2000, 3000)
        runs = [got[i : i + 1000] for i in range(0, len(got), 1000)]
        assert all(run == list(range(run[0], run[0] - 1000, -1)) for run in runs)


def test_merging_shuffles_nothing(spark, space):
    table = make(spark, space, ["d1"])
    rows = spark.table(table).where("report_dt = 'd1'").withColumn("report_dt", F.lit("d1")).coalesce(2)
    assert "Exchange" not in rows._jdf.queryExecution().toString()
    group = "merge"
    spark.sparkContext.setJobGroup(group, group)
    tracker = spark.sparkContext.statusTracker()
    assert [r["merge"] for r in compact_partitions(spark, table)] == [True]
    writing = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Two jobs at most list and sum up; the write has one stage.
    assert len(writing[0].stageIds) == 1 or min(len(w.stageIds) for w in writing) == 1


def test_large_files_are_split_and_small_ones_merged_in_one_call(spark, space):
    table = make(spark, space, ["d1", "d2"], n=2000)
    one = spark.table(table).where("report_dt = 'd2'").coalesce(1)
    overwrite_partitions(one, table, rebalance=False)
    before = content(spark, table)
    block = sizes(spark, table).where("report_dt = 'd1'").first()["largest"] * 2
    report = {r["report_dt"]: r for r in compact_partitions(spark, table, block_bytes=block)}
    assert report["d1"]["merge"] and not report["d2"]["merge"]
    assert files(spark, table) == {d: r["target_files"] for d, r in report.items()}
    assert content(spark, table) == before and compact_partitions(spark, table, block_bytes=10**9)


def test_slack_leaves_well_filled_files_alone(spark, space):
    table = make(spark, space, ["d1"])
    block = sizes(spark, table).first()["bytes"] // 4
    target = sizes(spark, table).first()["bytes"] // block + 1
    assert files(spark, table) == {"d1": 6} and target == 5
    assert compact_partitions(spark, table, block_bytes=block, slack=2.0) == []
    assert len(compact_partitions(spark, table, block_bytes=block)) == 1
    assert files(spark, table) == {"d1": 5}


def test_one_date_is_written_in_blocks(spark, space):
    table = space.table("mart")
    declare_table(spark, table, SCHEMA, "report_dt")
    rows = spark.range(0, 160_000, 1, 16).select(F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 512).alias("t"), F.lit("d1").alias("report_dt"))
    kept = {key: spark.conf.get(key, None) for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    started = run_start(spark)
    for block in (100_000_000, 6_000_000, 2_000_000):
        written = overwrite_partitions(rows, table, rebalance="blocks", block_bytes=block)
        assert written == {"report_dt=d1": 160_000}
        found = sizes(spark, table).first()
        target = found["bytes"] // block + 1
        assert found["files"] <= 2 * target and found["largest"] <= 1.5 * block
        assert compact_partitions(spark, table, started, block, slack=2.0) == []
    assert found["files"] >= 5
    assert kept == {key: spark.conf.get(key, None) for key in kept}


def test_many_empty_newest_partitions_cost_no_job(spark, space):
    table = make(spark, space, ["2024-01-31"])
    names = [str(date(2024, 3, 1) + timedelta(days=n)) for n in range(50)]
    spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"PARTITION (report_dt='{n}')" for n in names))
    empty = literal_rows(spark, [], SCHEMA).coalesce(1)
    location = sources.table_location(spark, table)
    empty.drop("report_dt").write.mode("append").parquet(f"{location}/report_dt={names[-1]}")
    spark.sparkContext.setJobGroup("newest", "newest")
    try:
        assert newest_loaded_date(spark, table, "report_dt") == "2024-01-31"
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("newest")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_listing_takes_a_few_tasks_however_long_the_files(spark, space):
    table = make(spark, space, ["d1", "d2"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        listed = sources.partition_inventory(spark, sources.table_location(spark, table), "report_dt")
        tasks = listed.rdd.getNumPartitions()
        assert tasks <= 4 * spark.sparkContext.defaultParallelism and listed.count() == 12
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_run_times_run_no_job(spark, space, zone):
    spark.sparkContext.setJobGroup("times", "times")
    now = run_start(spark)
    bound = sources.files._millis(spark, now)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("times")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(bound / 1000 - time.time()) < 5
    assert spark.range(1).select(F.unix_millis(F.to_timestamp(F.lit(now)))).first()[0] == bound
