import random
import re

import pytest
from pyspark.sql import functions as F

from tablewright.operators import joins
from tests.conftest import rows


def test_join_needs_keys(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        joins.join(df, df, None)
    with pytest.raises(ValueError):
        joins.join(df, df, "id", "cross")


def test_range_join_against_brute_force(spark):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), rng.uniform(-50, 50)) for i in range(300)]
    spans = []
    for j in range(60):
        low = rng.uniform(-60, 50)
        spans.append((j, rng.choice("ab"), low, low + rng.choice([0.0, 0.001, 0.5, 1, 4, 8, 33, 200])))
    got = joins.range_join(
        spark.createDataFrame(points, "p int, k string, v double"),
        spark.createDataFrame(spans, "s int, k string, lo double, hi double"),
        "v",
        "lo",
        "hi",
        on=["k"],
    )
    want = sorted((p, s) for p, k, v in points for s, k2, lo, hi in spans if k == k2 and lo <= v < hi)
    assert sorted((r["p"], r["s"]) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_range_join_without_intervals(spark):
    points = spark.range(5).withColumn("v", F.col("id") * 1.0)
    spans = spark.createDataFrame([], "lo double, hi double")
    assert joins.range_join(points, spans, "v", "lo", "hi").isEmpty()


@pytest.mark.parametrize("groups_fit", [False, True])
def test_asof_join_against_brute_force(spark, many_partitions, groups_fit):
    rng = random.Random(5)

    def key(i):
        return "hot" if i % 3 == 0 else rng.choice("abcdef")

    left = [(i, key(i), rng.randint(0, 100)) for i in range(300)]
    right = [(i, key(i), rng.randint(0, 100), rng.choice([None, 1.5, 2.5])) for i in range(250)]
    got = joins.asof_join(
        spark.createDataFrame(left, "id int, k string, t int"),
        spark.createDataFrame(right, "rid int, k string, rt int, v double").select("k", "rt", "rid", "v"),
        "k",
        "t",
        "rt",
        "id",
        groups_fit,
    )
    want = []
    for i, k, t in left:
        before = [(rt, rid) for rid, rk, rt, _ in right if rk == k and rt <= t]
        want.append((i, max(before)[1] if before else None))
    assert sorted((r["id"], r["rid"]) for r in got.collect()) == sorted(want)


def test_asof_join_nulls_match_nothing(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5), (3, "a", None)], "id int, k string, t int")
    right = spark.createDataFrame([("a", None, 10), (None, 1, 20), ("a", 7, 30)], "k string, rt int, v int")
    got = joins.asof_join(left, right, "k", "t", "rt", "id")
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, None), (2, None), (3, None)]


def test_range_join_dates_open_ends_and_infinity(spark):
    days = spark.sql("select id, date_add(date'2024-01-01', cast(id as int)) d, id * 1.0D v from range(40)")
    spans = spark.sql("select 1 s, date'2024-01-05' lo, date'2024-01-08' hi union all select 2, null, date'2024-01-03' union all select 3, date'2024-02-08', null")
    got = sorted((r["id"], r["s"]) for r in joins.range_join(days, spans, "d", "lo", "hi").collect())
    assert got == [(0, 2), (1, 2), (4, 1), (5, 1), (6, 1), (38, 3), (39, 3)]
    moments = days.select("id", F.timestamp_seconds(F.col("id") * 60).alias("m"))
    spans = spark.sql("select 1 s, timestamp_seconds(120) lo, timestamp_seconds(240) hi")
    assert sorted(r["id"] for r in joins.range_join(moments, spans, "m", "lo", "hi").collect()) == [2, 3]
    wide = spark.sql("select 1 s, -double('infinity') lo, 2.0D hi union all select 2, 38.0D, double('infinity') union all select 3, 3.0D, 3.0D")
    points = days.select("v").union(spark.sql("select double('nan') union all select null union all select double('-infinity')"))
    got = sorted((r["v"], r["s"]) for r in joins.range_join(points, wide, "v", "lo", "hi").collect())
    assert got == [(float("-inf"), 1), (0.0, 1), (1.0, 1), (38.0, 2), (39.0, 2)]


def test_points_are_multiplied_by_the_levels_at_most(spark):
    points = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    spans = spark.range(60).select((F.col("id") * 3.0).alias("lo"), (F.col("id") * 3.0 + F.pow(F.lit(1.7), F.col("id") % 40)).alias("hi"))
    out = joins.range_join(points, spans, "v", "lo", "hi")
    want = points.join(spans, (F.col("v") >= F.col("lo")) & (F.col("v") < F.col("hi"))).count()
    assert out.count() == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert max(len(x.split(",")) for x in re.findall(r"explode\(\[([\d,]+)\]\)", plan)) <= 4
