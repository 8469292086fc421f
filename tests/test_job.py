import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import Lifetime, RunConfig
from martloom.operators import append_row, declare_table, overwrite_partitions, overwrite_table, redeclare_table
from martloom.operators.sinks import base_folder, file_system, table_files
from martloom.plans import audit as audit_plan
from martloom.plans import compaction, job
from martloom.plans import (
    AUDIT_SCHEMA,
    CORPORATE_MART,
    COUNTS_SCHEMA,
    JobFailed,
    Step,
    change_of_run,
    compact_table,
    current_rows,
    last_step,
    mart_rows,
    previous_count,
    resume_after,
    run_mart_job,
    run_stats,
    run_steps,
)
from martloom.plans.job import mart_step
from martloom.sources import table_location

PROFILE = (
    "inn string, days_from_registration int, op_tech_other_bank_cnt int, balance_rs double, "
    "out_tech_our_bank_contragents int, in_tech_our_bank_contragents int, in_tech_our_bank_cnt int, "
    "op_tech_our_bank_amt double, op_pays_our_bank_cnt int, out_pays_our_bank_cnt int, "
    "in_pays_our_bank_contragents int, op_pays_our_bank_amt double, report_dt string"
)
REFERENCE = "inn string, okved_cd string, segment string, sector string, kopf_nm string, unused string"


def profile_row(inn, date, days=1):
    return (inn, days, 2, 3.5, 4, 5, 6, 7.25, 8, 9, 10, 11.0, date)


def reference_rows(spark):
    return spark.createDataFrame(
        [("1", "ok1", "s1", "c1", "k1", "u"), ("2", "ok2", "s2", "c2", "k2", "u"),
         ("2", "ok3", "s3", "c3", "k3", "u"), (None, "x", "x", "x", "x", "u")],
        REFERENCE,
    )


def audit(spark, *rows):
    """Rows of (run start, load id, last step, count)."""
    full = [(load, start, None, 0, step, 3, count, 0) for start, load, step, count in rows]
    return spark.createDataFrame(full, AUDIT_SCHEMA)


def test_mart_rows(spark):
    profile = spark.createDataFrame(
        [profile_row("1", "d1"), profile_row("2", "d1"), profile_row("3", "d1"), profile_row(None, "d1"),
         profile_row("1", "d2")],
        PROFILE,
    )
    out = mart_rows(profile, reference_rows(spark), CORPORATE_MART, "d1", 7, "2024-01-16 06:00:00")
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in CORPORATE_MART.schema]
    rows = sorted(((r["inn"], r["okved_cd"]) for r in out.collect()), key=repr)
    assert rows == [("1", "ok1"), ("2", "ok2"), ("2", "ok3"), ("3", None), (None, None)]
    first = out.where("inn = '1'").first()
    assert (first["ctl_loading"], first["ctl_validfrom"]) == (7, "2024-01-16 06:00:00")
    assert (first["op_pays_our_bank_amt"], first["report_dt"]) == (11.0, "d1")


def test_audit_lookups(spark):
    none = audit(spark)
    assert last_step(none).first()["last_step"] == 0
    assert previous_count(none).first()["previous"] is None
    runs = audit(
        spark,
        ("2024-01-01 00:00:00", 1, 3, 100), ("2024-02-01 00:00:00", 2, 1, 70),
        ("2024-02-01 00:00:00", 3, 2, 60),
    )
    assert last_step(runs).first()["last_step"] == 2
    assert previous_count(runs).first()["previous"] == 60


@pytest.mark.parametrize(
    ("rows", "size", "force", "flag"),
    [((), 5, False, 1), ((5,), 5, False, 0), ((4,), 5, False, 1), ((5,), 5, True, 1), ((None,), 0, False, 1)],
)
def test_change_of_run(spark, rows, size, force, flag):
    history = audit(spark, *(("2024-01-01 00:00:00", 1, 1, n) for n in rows))
    row = change_of_run(history, spark.range(size), force).first()
    assert (row["current"], row["is_change"]) == (size, flag)


def test_run_stats(spark):
    rows = run_stats(spark, 7, 42, "2024-01-16 06:00:00", "2024-01-01", 1, today="2024-01-16").collect()
    assert {(r["stat_id"], r["value"]) for r in rows} == {
        (1, "2024-01-16"), (2, "1"), (5, "2024-01-01"), (11, "2024-01-16 06:00:00"),
        (15, spark.sparkContext.applicationId),
    }
    assert {(r["loading_id"], r["entity_id"]) for r in rows} == {(7, 42)}


SCHEMA = "n int, report_dt string"


@pytest.fixture()
def tables(spark, space):
    from pyspark.sql import types as T

    names = [space.table(f"t{i}") for i in range(1, 5)]
    for name in names:
        declare_table(spark, name, T.StructType.fromDDL(SCHEMA), "report_dt")
    return names


def one_row(n):
    return lambda spark, params: spark.createDataFrame([(n * params["factor"], "d")], SCHEMA)


def broken(spark, params):
    return spark.range(1).select(F.raise_error(F.lit("broken step")).cast("int").alias("n"), F.lit("d").alias("report_dt"))


def numbers(spark, tables):
    return [[r["n"] for r in spark.table(t).collect()] for t in tables]


def test_steps_run_in_order_and_stop_at_a_failure(spark, tables):
    a, b, c, d = tables
    groups = {2: [Step(b, broken), Step(c, one_row(3))], 1: [Step(a, one_row(1))], 3: [Step(d, one_row(4))]}
    outcome = run_steps(spark, groups, {"factor": 10})
    assert (outcome.last_success, outcome.in_general, outcome.complete) == (1, 3, False)
    assert "broken step" in str(outcome.error)
    first, failed, sibling, later = numbers(spark, tables)
    # The failure cancels its sibling, unless that was quicker.
    assert (first, failed, later) == ([10], [], []) and sibling in ([], [30])

    groups[2][0] = Step(b, lambda s, p: s.table(a).withColumn("n", F.col("n") + 1))
    outcome = run_steps(spark, groups, {"factor": 100}, done=outcome.last_success)
    assert outcome.complete and outcome.error is None
    assert numbers(spark, tables) == [[10], [11], [300], [400]]
    assert outcome.written[c] == {"report_dt=d": 1}


@pytest.mark.parametrize("numbers_", [(0, 1), (1, 3), (2,)])
def test_steps_must_be_contiguous(spark, tables, numbers_):
    with pytest.raises(ValueError, match="without gaps"):
        run_steps(spark, {n: [Step(tables[0], one_row(1))] for n in numbers_}, {"factor": 1})
    assert numbers(spark, tables)[0] == []


def test_resume_point(spark, space):
    table = space.audit(audit(spark, ("2024-01-01 00:00:00", 1, 2, 10)))
    assert resume_after(spark, table, recovery=True) == 2
    assert resume_after(spark, table, recovery=False) == 0
    assert resume_after(spark, space_without_runs(spark), recovery=True) == 0


def space_without_runs(spark):
    from workload.standins import Workspace

    return Workspace(spark).audit()


@pytest.fixture(params=["managed", "external"])
def config(request, spark, space):
    from pyspark.sql import types as T

    profile = T.StructType.fromDDL(PROFILE)
    declare_table(spark, space.table("profile"), profile, "report_dt")
    rows = [profile_row(str(i), d) for d in ("2024-01-01", "2024-02-01") for i in range(1, 6)]
    overwrite_partitions(spark.createDataFrame(rows, profile), space.table("profile"))
    reference_rows(spark).write.saveAsTable(space.table("reference"))
    external = request.param == "external"
    return RunConfig(
        target=space.table("mart"), spec=CORPORATE_MART, profile=space.table("profile"),
        reference=space.table("reference"), lifetime=Lifetime(years=100), default_date="2024-01-01",
        location=space.path("mart") if external else None,
        audit_location=space.path("audit") if external else None, entity_id=42,
    )


def audit_rows(spark, config):
    columns = ("ctl_loading", "partitions", "is_force_load", "last_success_step", "count_rows", "is_change")
    return [tuple(r) for r in spark.table(config.audit_table).orderBy("ctl_validfrom").select(*columns).collect()]


def dates(spark, config):
    mart = spark.table(config.target).groupBy("report_dt", "ctl_loading").count()
    return sorted(tuple(r) for r in mart.collect())


def test_a_run_from_first_load_to_failure_and_recovery(spark, config):
    with pytest.raises(ValueError, match="empty"):
        run_mart_job(spark, config, 1)

    report = run_mart_job(spark, config, 2, run_start="2024-02-16 06:00:00", force=True)
    assert report.load_date == "2024-01-01"
    assert dates(spark, config) == [("2024-01-01", 2, 6)]

    later = replace(config, default_date="2024-02-01")
    report = run_mart_job(spark, later, 3, run_start="2024-02-17 06:00:00")
    assert report.load_date == "2024-01-01", "a run without force refreshes the newest loaded date"
    assert dates(spark, config) == [("2024-01-01", 3, 6)]

    groups = {1: [mart_step(config)], 2: [Step(config.target, broken)]}
    with pytest.raises(JobFailed, match="step 1 of 2"):
        run_mart_job(spark, config, 4, groups, run_start="2024-02-18 06:00:00")

    groups[2] = [Step(config.target, lambda s, p: s.table(config.target).where("inn = '1'"))]
    run_mart_job(spark, config, 5, groups, run_start="2024-02-19 06:00:00", recovery=True)
    assert dates(spark, config) == [("2024-01-01", 4, 1)], "step 1 was skipped on recovery"

    newest = "report_dt=2024-01-01"
    assert audit_rows(spark, config) == [
        (2, newest, 1, 1, 6, 1), (3, newest, 0, 1, 6, 0), (4, newest, 0, 1, 6, 0), (5, newest, 0, 2, 1, 1),
    ]
    stats = spark.table(config.statistics_table).where("stat_id = 5").select("loading_id", "value")
    assert sorted(tuple(r) for r in stats.collect()) == [(n, "2024-01-01") for n in (2, 3, 5)]


def test_forced_load_replaces_everything(spark, config):
    run_mart_job(spark, config, 1, run_start="2024-02-16 06:00:00", force=True)
    with pytest.raises(ValueError, match="needs a date"):
        run_mart_job(spark, replace(config, default_date=""), 2, force=True)
    assert dates(spark, config) == [("2024-01-01", 1, 6)]
    later = replace(config, default_date="2024-02-01")
    run_mart_job(spark, later, 3, run_start="2024-02-17 06:00:00", force=True)
    assert dates(spark, config) == [("2024-02-01", 3, 6)]


def test_config_is_checked(config):
    with pytest.raises(ValueError, match="db.table"):
        replace(config, target="mart")
    with pytest.raises(ValueError, match="positive"):
        replace(config, block_bytes=0)
    with pytest.raises(ValueError, match="both"):
        replace(config, location="/x", audit_location=None)
    assert config.audit_table == f"{config.database}.kpd_report_mart"
    with pytest.raises(ValueError, match="missing"):
        replace(CORPORATE_MART, from_reference=("nope",))
    assert CORPORATE_MART.from_profile[0] == "inn" and CORPORATE_MART.from_profile[-1] == "report_dt"
    assert len(CORPORATE_MART.schema) == 19


def test_a_step_replaces_an_unpartitioned_table_only_when_it_succeeds(spark, space):
    from pyspark.sql import types as T

    staging = space.table("staging")
    declare_table(spark, staging, T.StructType.fromDDL(SCHEMA))
    groups = {1: [Step(staging, one_row(1), whole=True)], 2: [Step(staging, broken, whole=True)]}
    outcome = run_steps(spark, groups, {"factor": 10})
    assert (outcome.last_success, outcome.in_general) == (1, 2)
    assert numbers(spark, [staging]) == [[10]]
    groups[2] = [Step(staging, lambda s, p: s.table(staging).withColumn("n", F.col("n") + 1), whole=True)]
    assert run_steps(spark, groups, {"factor": 10}, done=outcome.last_success).complete
    assert numbers(spark, [staging]) == [[11]]
    refused = run_steps(spark, {1: [Step(staging, one_row(1))]}, {"factor": 1})
    assert "not partitioned" in str(refused.error)


def test_an_unchanged_table_is_not_declared_again(spark, space):
    from martloom.operators import redeclare_table

    table, folder = space.table("mart"), space.path("mart")
    assert redeclare_table(spark, table, CORPORATE_MART.schema, folder, CORPORATE_MART.partitions)
    assert not redeclare_table(spark, table, CORPORATE_MART.schema, folder, CORPORATE_MART.partitions)
    wider = CORPORATE_MART.schema[:-1].add("note", "string").add(CORPORATE_MART.schema[-1])
    assert redeclare_table(spark, table, wider, folder, CORPORATE_MART.partitions)


def test_a_failing_table_ends_its_siblings(spark, tables):
    def endless(spark, params):
        # A minute of work in tasks that can be cancelled.
        slow = spark.range(0, 200_000_000, 1, 400).select(F.sum(F.crc32(F.sha2(F.col("id").cast("string"), 512))).alias("n"))
        return slow.select((F.col("n") % 7).cast("int").alias("n"), F.lit("d").alias("report_dt"))

    def late_failure(spark, params):
        time.sleep(2)
        return broken(spark, params)

    started = time.monotonic()
    outcome = run_steps(spark, {1: [Step(tables[0], endless), Step(tables[1], late_failure)]}, {})
    assert time.monotonic() - started < 20
    assert "broken step" in str(outcome.error) and numbers(spark, tables[:2]) == [[], []]
    assert run_steps(spark, {1: [Step(tables[0], one_row(1))]}, {"factor": 2}).complete


def test_steps_have_a_pool_each(spark, tables):
    pools = []

    def noted(spark, params):
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return one_row(1)(spark, params)

    assert run_steps(spark, {1: [Step(t, noted) for t in tables]}, {"factor": 1}).complete
    assert sorted(pools) == sorted(tables)


def folders_in(spark, location):
    system, path = file_system(spark, location)
    return [c.getPath().getName() for c in system.listStatus(path) if c.isDirectory()]


@pytest.mark.parametrize("external", [False, True])
def test_replacing_a_table_is_one_change(spark, space, external):
    table = space.table("whole")
    declare_table(spark, table, T.StructType.fromDDL(SCHEMA), location=space.path("whole") if external else None)
    base = table_location(spark, table)
    overwrite_table(one_row(1)(spark, {"factor": 1}), table)
    first = table_location(spark, table)
    assert numbers(spark, [table]) == [[1]] and base_folder(first) == base != first
    halfway = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("second write"))).cast("int").alias("n"), F.lit("d").alias("report_dt")
    )
    with pytest.raises(Exception, match="second write"):
        overwrite_table(halfway, table)
    assert numbers(spark, [table]) == [[1]] and table_location(spark, table) == first
    assert len(folders_in(spark, base)) == 1
    overwrite_table(spark.table(table).withColumn("n", F.col("n") + 1), table)
    assert numbers(spark, [table]) == [[2]] and len(folders_in(spark, base)) == 1
    overwrite_table(spark.table(table).where("false"), table)
    assert numbers(spark, [table]) == [[]]
    one_row(5)(spark, {"factor": 1}).write.insertInto(table)
    assert numbers(spark, [table]) == [[5]]


def test_a_replaced_table_is_found_again_when_declared(spark, space):
    table, folder = space.table("whole"), space.path("whole")
    schema = T.StructType.fromDDL(SCHEMA)
    assert redeclare_table(spark, table, schema, folder)
    overwrite_table(one_row(4)(spark, {"factor": 1}), table)
    assert not redeclare_table(spark, table, schema, folder), "its declared folder is the same"
    spark.sql(f"DROP TABLE {table}")
    assert redeclare_table(spark, table, schema, folder)
    assert numbers(spark, [table]) == [[4]]


def test_small_tables_stay_in_few_files(spark, space):
    table = space.audit()
    for n in range(100):
        append_row(spark, table, ctl_loading=n, ctl_validfrom="x")
        if n % 25 == 24:
            compact_table(spark, table, loose_files=10)
    assert len(table_files(spark, table_location(spark, table))) == 1
    append_row(spark, table, ctl_loading=100)
    assert compact_table(spark, table) == 0
    assert sorted(r["ctl_loading"] for r in spark.table(table).collect()) == list(range(101))


def test_rows_appended_during_a_compaction_stay(spark, space):
    table = space.audit()
    append_row(spark, table, ctl_loading=1)
    files = list(table_files(spark, table_location(spark, table)))
    rows = spark.read.schema(AUDIT_SCHEMA).parquet(*files)
    append_row(spark, table, ctl_loading=2)
    overwrite_table(rows, table, replaced=files)
    assert sorted(r["ctl_loading"] for r in spark.table(table).collect()) == [1, 2]


def test_runs_leave_few_audit_files(spark, config, monkeypatch):
    monkeypatch.setattr(compaction, "LOOSE_FILES", 2)
    monkeypatch.setattr(job, "compact_table", lambda s, t, b: compaction.compact_table(s, t, b, compaction.LOOSE_FILES))
    run_mart_job(spark, config, 1, run_start="2024-02-16 06:00:00", force=True)
    for n in range(2, 6):
        run_mart_job(spark, config, n, run_start=f"2024-02-{15 + n} 06:00:00")
    for table in (config.audit_table, config.statistics_table, config.counts_table):
        assert len(table_files(spark, table_location(spark, table))) <= 2
    assert [r[0] for r in audit_rows(spark, config)] == [1, 2, 3, 4, 5]
    assert spark.table(config.statistics_table).count() == 25


def test_a_run_writes_its_date_once(spark, config):
    report = run_mart_job(spark, config, 2, run_start="2024-02-16 06:00:00", force=True)
    assert report.compacted == []
    again = run_mart_job(spark, config, 3)
    assert again.compacted == []
    paths = spark.table(config.target).select("_metadata.file_path").distinct().count()
    assert paths == 1


@pytest.fixture()
def counted(spark, space):
    table, counts = space.table("mart"), space.table("counts")
    declare_table(spark, table, T.StructType.fromDDL(SCHEMA), "report_dt")
    declare_table(spark, counts, COUNTS_SCHEMA)
    rows = spark.range(60).select(F.col("id").cast("int").alias("n"), F.concat(F.lit("d"), F.col("id") % 3).alias("report_dt"))
    overwrite_partitions(rows, table)
    return table, counts


def test_only_changed_partitions_are_counted(spark, counted, monkeypatch):
    table, counts = counted
    asked, rows_of = [], audit_plan.rows_of
    monkeypatch.setattr(audit_plan, "rows_of", lambda s, t, names: asked.append(names) or rows_of(s, t, names))
    monkeypatch.setattr(audit_plan, "_SETTLED_MS", -60_000)
    assert current_rows(spark, table, counts) == 60
    assert asked.pop() == ["report_dt=d0", "report_dt=d1", "report_dt=d2"]
    assert current_rows(spark, table, counts) == 60 and not asked
    time.sleep(1.1)
    written = overwrite_partitions(spark.createDataFrame([(1, "d1"), (2, "d1")], SCHEMA), table)
    assert written == {"report_dt=d1": 2}
    assert current_rows(spark, table, counts, written) == 42 and not asked
    spark.createDataFrame([(1, "d2")], SCHEMA).write.insertInto(table)
    assert current_rows(spark, table, counts) == 43 and asked.pop() == ["report_dt=d2"]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (report_dt='d0')")
    assert current_rows(spark, table, counts) == 23 and not asked
    text = rows_of(spark, table, ["report_dt=d2"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<>" in text and "d2" in text


def test_fresh_counts_are_not_trusted(spark, counted):
    """A folder's time may be as coarse as a second."""
    times = {"report_dt=a": ("x", 1_000_000), "report_dt=b": ("x", 1_000_000), "report_dt=c": ("x", 0), "report_dt=d": ("x", 5)}
    known = {
        "report_dt=a": {"modified": 1_000_000, "counted": 1_001_000},
        "report_dt=b": {"modified": 1_000_000, "counted": 1_003_000},
        "report_dt=c": {"modified": 0, "counted": 9_000_000},
    }
    assert audit_plan.partitions_to_count(times, known, {"report_dt=d": 3}) == ["report_dt=a", "report_dt=c"]


def test_odd_values_are_counted_by_their_folders(spark, counted):
    table, counts = counted
    odd = spark.createDataFrame([(1, None), (2, "a b:c/d'e%")], SCHEMA)
    assert overwrite_partitions(odd, table) is None
    assert overwrite_partitions(odd.where("n = 1"), table) is None
    assert overwrite_partitions(odd.where("n = 2"), table) is None
    assert overwrite_partitions(odd.where("false"), table) is None
    assert current_rows(spark, table, counts) == 62
