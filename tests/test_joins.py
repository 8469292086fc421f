import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators import HotKeys, joins, left_join
from martloom.operators.joins import heavy_buckets, hot_keys_of

ALL_HOT = HotKeys(rows_per_task=1)


def nested_loop(left, right):
    out = []
    for key, value in left:
        hits = [v for k, v in right if key is not None and k == key]
        out += [(key, value, v) for v in hits] or [(key, value, None)]
    return sorted(out, key=repr)


def run(spark, left, right, hot):
    l = spark.createDataFrame(left, "k string, a int")
    r = spark.createDataFrame(right, "k string, b int")
    return sorted((tuple(x) for x in left_join(l, r, "k", "k", ["b"], hot).collect()), key=repr)


LEFT = [("x", i) for i in range(40)] + [(None, i) for i in range(30)] + [("y", 1), ("z", 2), ("q", 3)]
RIGHT = (
    [("x", i) for i in range(25)] + [("y", i) for i in range(60)] + [(None, 9), ("z", 5), ("unused", 6)]
)


@pytest.mark.parametrize("hot", [None, HotKeys(), ALL_HOT], ids=["plain", "default", "split"])
@pytest.mark.parametrize(
    ("left", "right"),
    [
        (LEFT, RIGHT),
        ([(None, 1)], [(None, 2)]),
        ([("a", 1), ("a", 1)], [("a", 2), ("a", 2)]),
        ([("a", 1), ("b", 2)], []),
        ([], [("a", 1)]),
    ],
    ids=["mixed", "null-keys", "duplicates", "empty-right", "empty-left"],
)
def test_matches_a_nested_loop(spark, left, right, hot):
    assert run(spark, left, right, hot) == nested_loop(left, right)


KEYS = st.sampled_from(["a", "b", "c", "d", "", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 3)), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(ROWS, ROWS, st.sampled_from([1, 3, 7]))
def test_split_join_of_any_rows(spark, left, right, held):
    assert run(spark, left, right, HotKeys(held)) == nested_loop(left, right)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_rows_of_a_hot_right_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(40).selectExpr("'hot' AS k", "id AS a").repartition(3)
        right = spark.range(4000).selectExpr("IF(id % 2 = 0, 'hot', CAST(id AS string)) AS k", "id AS b")
        joined = left_join(left, right, "k", "k", ["b"], HotKeys(rows_per_task=100))
        assert "__piece" in plan_of(joined)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 40 * 2000 and max(sizes) < 40 * 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_left_rows_stay_when_the_right_table_changes(spark):
    left = spark.range(100).selectExpr("IF(id < 50, 'x', 'y') AS k", "id AS a")
    spark.sql("DROP TABLE IF EXISTS changing")
    spark.sql("CREATE TABLE changing (k string, b int, p int) USING parquet PARTITIONED BY (p)")
    for before, after, met in (("x", "y", 50), ("y", "nothing", 0)):
        spark.createDataFrame([(before, i, 0) for i in range(20)], "k string, b int, p int").write.insertInto("changing", overwrite=True)
        joined = left_join(left, spark.table("changing"), "k", "k", ["b"], HotKeys(rows_per_task=5))
        spark.createDataFrame([(after, 1, 0)], "k string, b int, p int").write.insertInto("changing", overwrite=True)
        rows = joined.collect()
        assert {r["a"] for r in rows} == set(range(100))
        assert sum(r["b"] is not None for r in rows) == met
    spark.sql("DROP TABLE changing")


def test_key_types_are_compared_as_their_common_type(spark):
    left = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "k int, a int")
    right = spark.createDataFrame([(1, i) for i in range(9)] + [(2**40, 5)], "k bigint, b int")
    joined = left_join(left, right, "k", "k", ["b"], HotKeys(rows_per_task=2))
    assert "__piece" in plan_of(joined) and joined.schema["k"].dataType.simpleString() == "int"
    assert sorted((r["a"], r["b"]) for r in joined.collect() if r["a"] == 1) == [(1, i) for i in range(9)]
    assert sorted(r["a"] for r in joined.collect() if r["b"] is None) == [2, 3]
    doubles = spark.createDataFrame([(1.0, 5), (1.0, 6), (float("nan"), 7), (float("nan"), 8)], "k double, b int")
    left = spark.createDataFrame([(1.0, 1), (float("nan"), 3)], "k double, a int")
    got = left_join(left, doubles, "k", "k", ["b"], ALL_HOT).collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(1, 5), (1, 6), (3, 7), (3, 8)]
    with pytest.raises(ValueError, match="one type"):
        left_join(spark.createDataFrame([("1", 1)], "k string, a int"), right, "k", "k", ["b"])


def test_small_right_side_is_broadcast_without_pieces(spark):
    left = spark.range(1000).selectExpr("CAST(id % 3 AS string) AS k", "id AS a")
    right = spark.read.parquet("/root/testdata/sf0.01/nation.parquet").selectExpr("CAST(n_nationkey AS string) AS k", "n_regionkey AS b")
    text = plan_of(left_join(left, right, "k", "k", ["b"]))
    assert "BroadcastHashJoin" in text and "__piece" not in text


def test_sessions_that_do_not_split_are_refused(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, a int")
    right = spark.createDataFrame([("a", 1)], "k string, b int")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.raises(ValueError, match="skewJoin"):
            left_join(rows, right, "k", "k", ["b"])
        assert left_join(rows, right, "k", "k", ["b"], None).count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_name_clash_is_an_error(spark):
    left = spark.createDataFrame([("a", 1)], "k string, b int")
    with pytest.raises(ValueError, match="both sides"):
        left_join(left, left, "k", "k", ["b"])


def test_policy_bounds():
    with pytest.raises(ValueError):
        HotKeys(rows_per_task=0)


@pytest.fixture()
def stored_right(spark, tmp_path):
    """A stored right side: half of its rows share a key."""
    rows = spark.range(0, 4000, 1, 4).selectExpr("IF(id % 2 = 0, 'hot', CAST(id AS string)) AS k", "id AS b")
    rows.write.parquet(str(tmp_path / "right"))
    return spark.read.parquet(str(tmp_path / "right"))


def jobs_of(spark, made):
    """What ``made`` returns, and how many jobs it ran."""
    group = f"join-{time.monotonic()}"
    spark.sparkContext.setJobGroup(group, group)
    out = made()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, n


def test_footers_settle_a_small_right_side(spark, stored_right):
    left = spark.range(40).selectExpr("'hot' AS k", "id AS a")
    joined, jobs = jobs_of(spark, lambda: left_join(left, stored_right.where("b >= 0"), "k", "k", ["b"], HotKeys(rows_per_task=4000)))
    assert jobs == 0 and "__piece" not in plan_of(joined)
    joined, jobs = jobs_of(spark, lambda: left_join(left, stored_right, "k", "k", ["b"], HotKeys(rows_per_task=3999)))
    assert 0 < jobs <= 2 and "__piece" not in plan_of(joined), "a histogram alone"
    doubled = stored_right.join(spark.range(2).withColumnRenamed("id", "copy"))
    assert jobs_of(spark, lambda: left_join(left, doubled, "k", "k", ["b"], HotKeys(rows_per_task=5000)))[1] > 0


def test_a_task_shuffles_no_more_rows_than_buckets(spark, stored_right):
    policy = HotKeys(rows_per_task=100, buckets=16)
    heavy = heavy_buckets(stored_right, "k", policy)
    heavy.collect()
    text = plan_of(heavy)
    assert "functions=[partial_count" in text and text.count("Exchange hashpartitioning(_groupingexpression") >= 1
    before = stored_right.groupBy(F.spark_partition_id().alias("p"), F.pmod(F.xxhash64("k"), F.lit(16)).alias("b")).count()
    assert all(r["n"] <= 16 for r in before.groupBy("p").agg(F.count("*").alias("n")).collect())
    assert hot_keys_of(stored_right, "k", policy).collect() == [("hot", 20)]
    # Most buckets are heavy by their many light keys: the exact count tells.
    assert heavy.count() > 4


def test_light_keys_in_heavy_buckets_are_not_split(spark, stored_right):
    left = spark.range(40).selectExpr("'1' AS k", "id AS a")
    light = stored_right.where("k <> 'hot'")
    joined = left_join(left, light, "k", "k", ["b"], HotKeys(rows_per_task=50, buckets=4))
    assert "__piece" not in plan_of(joined) and joined.count() == 40


def test_many_hot_keys_are_counted_by_the_query(spark, monkeypatch):
    monkeypatch.setattr(joins, "_STATED_KEYS", 1)
    assert run(spark, LEFT, RIGHT, ALL_HOT) == nested_loop(LEFT, RIGHT)


def test_derived_right_sides_need_whole_retries(spark, stored_right):
    left = spark.range(40).selectExpr("'hot' AS k", "id AS a")
    key = "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch"
    spark.conf.set(key, "false")
    try:
        derived = stored_right.groupBy("k", "b").count()
        with pytest.raises(ValueError, match="enableFullRetryOnMismatch"):
            left_join(left, derived, "k", "k", ["b"], HotKeys(rows_per_task=100))
        assert left_join(left, stored_right, "k", "k", ["b"], HotKeys(rows_per_task=100)).count() == 40 * 2000
        assert left_join(left, derived, "k", "k", ["b"], HotKeys(rows_per_task=5000)).count() == 40 * 2000
    finally:
        spark.conf.set(key, "true")
