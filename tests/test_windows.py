"""The ordered window functions give what plain windows give, over blocks of large groups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.operators import windows
from tablewright.session import materialize_blocks
from tests.conftest import rows

HOT = 50


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key; keys and values also hold nulls."""
    rng = random.Random(7)
    data = []
    for i in range(1200):
        key = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", *[f"k{j}" for j in range(30)]])
        value = None if rng.random() < 0.15 else float(rng.randint(-20, 20))
        data.append((key, rng.randint(0, 40), i, value))
    return spark.createDataFrame(data, "k string, t int, id int, x double").repartition(5).cache()


def test_recycled_null_keys(skewed):
    w = Window.partitionBy("k")
    got = windows.recycled(skewed, "k", n=F.count(F.lit(1)), s=F.sum("x"))
    want = skewed.select("*", F.count(F.lit(1)).over(w).alias("n"), F.sum("x").over(w).alias("s"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["count", "sum", "min", "max", "last"])
def test_running(many_partitions, skewed, kind):
    measure = {"m": (kind, "x")}
    split = windows.running(skewed, "k", ["t", "id"], measure)
    plain = windows.running(skewed, "k", ["t", "id"], measure, groups_fit=True)
    assert rows(split) == rows(plain)
    assert "_block" not in split.columns


def test_running_uses_several_blocks(many_partitions, skewed):
    blocks = skewed.repartitionByRange("k", "t", "id").withColumn("b", F.spark_partition_id())
    assert blocks.where("k = 'hot'").select("b").distinct().count() > 1


def test_cumulative(many_partitions, skewed):
    split = windows.cumulative(skewed, "k", ["t", "id"], "x")
    plain = windows.cumulative(skewed, "k", ["t", "id"], "x", groups_fit=True)
    assert rows(split.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("order", [["t", "id"], ["t"]])
def test_ranked(many_partitions, skewed, order):
    exact = ["rank", "dense_rank", "percent_rank", "cume_dist"]
    if len(order) == 2:
        exact += ["row_number", "ntile"]
    split = windows.ranked(skewed, "k", order, buckets=7)
    plain = windows.ranked(skewed, "k", order, buckets=7, groups_fit=True)
    assert rows(split.select("id", *exact)) == rows(plain.select("id", *exact))
    numbers = split.groupBy("k").agg(F.count_distinct("row_number").alias("d"), F.max("row_number").alias("m"))
    assert numbers.where("d <> m").isEmpty()


def test_shifted(many_partitions, skewed):
    args = dict(lags={"a": ("x", 3), "b": ("id", 1)}, leads={"c": ("x", 2)})
    split = windows.shifted(skewed, "k", ["t", "id"], block_rows=HOT, **args)
    plain = windows.shifted(skewed, "k", ["t", "id"], groups_fit=True, **args)
    assert rows(split) == rows(plain)


def test_framed(many_partitions, skewed):
    values = {"s": F.sum("x"), "n": F.count("x"), "top": F.max("x")}
    split = windows.framed(skewed, "k", ["t", "id"], 4, 3, values, block_rows=HOT)
    plain = windows.framed(skewed, "k", ["t", "id"], 4, 3, values, groups_fit=True)
    assert rows(split) == rows(plain)


def test_range_framed(many_partitions, skewed):
    values = {"s": ("sum", "x"), "n": ("count", F.lit(1)), "m": ("mean", "x"), "lo": ("min", "x")}
    some = skewed.withColumn("t", F.when(F.col("id") % 11 != 0, F.col("t")))
    got = windows.range_framed(some, "k", "t", 3, 2, values)
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-3, 2)
    plain = some.select("*", F.sum("x").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"), F.avg("x").over(w).alias("m"), F.min("x").over(w).alias("lo"))
    assert rows(got.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("before, after", [(3, 2), (0, 0), (15, 0), (0, 30), (1000, 1000)])
def test_range_framed_over_blocks(many_partitions, monkeypatch, skewed, before, after):
    """Groups with a full cell go over blocks: frames inside a step, over two and over many."""
    monkeypatch.setattr(windows, "STEP_ROWS", 7)
    values = {"s": ("sum", "x"), "n": ("count", F.lit(1)), "m": ("mean", "x"), "lo": ("min", "x"), "hi": ("max", "x")}
    some = skewed.withColumn("t", F.when(F.col("id") % 11 != 0, F.col("t") + F.col("id") % 7 * 0.125))
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-before, after)
    plain = some.select("*", F.sum("x").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"), F.avg("x").over(w).alias("m"), F.min("x").over(w).alias("lo"), F.max("x").over(w).alias("hi"))
    for cell_rows in (1, 60):
        got = windows.range_framed(some, "k", "t", before, after, values, cell_rows)
        assert rows(got.select(*plain.columns)) == rows(plain)
    alone = windows.range_framed(some, [], "t", before, after, {"n": ("count", F.lit(1))}, 5)
    w = Window.partitionBy(F.lit(0)).orderBy("t").rangeBetween(-before, after)
    assert rows(alone) == rows(some.select("*", F.count(F.lit(1)).over(w).alias("n")))


def test_range_framed_blocks_are_few(monkeypatch, skewed):
    """As many blocks as the rows need, and each is ordered when it is written."""
    made = []

    def kept(*args, **more):
        made.append(materialize_blocks(*args, **more))
        return made[-1]

    monkeypatch.setattr(windows, "materialize_blocks", kept)
    monkeypatch.setattr(windows, "STEP_ROWS", 7)
    got = windows.range_framed(skewed, "k", "t", 3, 2, {"s": ("sum", "x"), "lo": ("min", "x")}, 1)
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-3, 2)
    assert rows(got) == rows(skewed.select("*", F.sum("x").over(w).alias("s"), F.min("x").over(w).alias("lo")))
    (blocks,) = made
    assert blocks.select("_block").distinct().count() == 1
    order = Window.partitionBy("_block", "_group").orderBy("_nth")
    falls = blocks.withColumn("_p", F.col("t") + F.element_at(F.array(F.lit(-3), F.lit(0), F.lit(2)), F.col("_kind") + 1))
    assert falls.withColumn("_before", F.lag("_p").over(order)).where("_p < _before").isEmpty()


def test_blocks_number_their_rows(many_partitions, skewed):
    blocks = materialize_blocks(skewed, "blocks", [F.col("t"), F.col("id")], "_block", "_bucket", 4, nth="_nth", drop=("x",))
    assert set(blocks.columns) == {"k", "t", "id", "_nth", "_block", "_bucket"}
    numbered = blocks.withColumn("_want", F.row_number().over(Window.partitionBy("_block").orderBy("t", "id")) - 1)
    assert numbered.where("_want <> _nth").isEmpty() and numbered.select("_block").distinct().count() == 4


def test_range_framed_by_dates_and_moments(many_partitions, skewed):
    dated = skewed.withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t"))).withColumn("m", F.timestamp_seconds(F.col("t") * 3600))
    want = rows(windows.range_framed(dated, "k", "t", 3, 2, {"n": ("count", F.lit(1))}))
    assert rows(windows.range_framed(dated, "k", "d", 3, dt.timedelta(days=2), {"n": ("count", F.lit(1))})) == want
    assert rows(windows.range_framed(dated, "k", "m", 3 * 3600, dt.timedelta(hours=2), {"n": ("count", F.lit(1))})) == want


@pytest.mark.parametrize("by", [windows.By("x", desc=True), windows.By("x", nulls_last=True), windows.By("x", True, False)])
def test_orders(many_partitions, skewed, by):
    order = [by, "id"]
    got, want = windows.ranked(skewed, "k", order), windows.ranked(skewed, "k", order, groups_fit=True)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    last = {"m": ("last", "x"), "s": ("sum", "x")}
    assert rows(windows.running(skewed, "k", order, last)) == rows(windows.running(skewed, "k", order, last, groups_fit=True))


def test_no_keys(many_partitions, skewed):
    assert rows(windows.ranked(skewed, [], "id")) == rows(windows.ranked(skewed, [], "id", groups_fit=True))
    assert rows(windows.shifted(skewed, [], "id", {"a": ("x", 2)}, block_rows=HOT)) == rows(windows.shifted(skewed, [], "id", {"a": ("x", 2)}, groups_fit=True))
    assert {r["n"] for r in windows.win_n(skewed, []).collect()} == {1200}


def test_groups_of_only_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None)], "k string, x double")
    assert rows(windows.quantiles(df, "k", "x", {"q": 0.5})) == [("a", None), ("b", 1.0)]
    assert rows(windows.flattened(df.select("k", F.col("x").cast("string").alias("x")), "k", "x", "f")) == [("a", None), ("b", "1.0")]


def test_flattened(many_partitions, skewed):
    texts = skewed.select("k", F.col("x").cast("int").cast("string").alias("s"))
    split = windows.flattened(texts, "k", "s", "f", "|", block_rows=7)
    plain = texts.groupBy("k").agg(F.array_join(F.sort_array(F.collect_list("s")), "|").alias("f"))
    assert rows(split) == rows(plain) == rows(windows.flattened(texts, "k", "s", "f", "|"))


def test_long_runs_of_equal_rows_span_blocks(many_partitions, spark):
    same = spark.range(3000).select(F.lit("k").alias("k"), F.lit(1).alias("t"), F.lit(1.0).alias("x"))
    out = windows.running(same, "k", "t", {"n": ("count", F.lit(1)), "s": ("sum", "x")})
    got = out.agg(F.count_distinct("n").alias("d"), F.max("s").alias("s")).first()
    assert (got["d"], got["s"]) == (3000, 3000.0)
    ranks = windows.ranked(same, "k", "t")
    r = ranks.agg(F.max("rank").alias("r"), F.count_distinct("row_number").alias("d"), F.min("cume_dist").alias("c")).first()
    assert (r["r"], r["d"], r["c"]) == (1, 3000, 1.0)


def test_nth_values(many_partitions, skewed):
    split = windows.nth_values(skewed, "k", ["t", "id"], "x", n=3)
    plain = windows.nth_values(skewed, "k", ["t", "id"], "x", n=3, groups_fit=True)
    assert rows(split) == rows(plain)


def test_quantiles(many_partitions, skewed):
    got = windows.quantiles(skewed, "k", "x", {"q10": 0.1, "q50": 0.5, "q100": 1.0})
    want = skewed.where("x is not null").groupBy("k").agg(
        *[F.percentile("x", p).alias(n) for n, p in (("q10", 0.1), ("q50", 0.5), ("q100", 1.0))]
    )
    for g, w in zip(rows(got), rows(want)):
        assert g[0] == w[0] and g[1:] == pytest.approx(w[1:])


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    assert rows(windows.top_k(df, "k", [F.desc("v")], 1)) == [("a", 3), ("a", 3), ("b", 1)]
    assert len(rows(windows.top_k(df, "k", [F.desc("v")], 1, ties=False))) == 2


def test_absent_window_functions():
    for name in ("all", "any", "cor", "cov", "n_distinct", "median"):
        with pytest.raises(NotImplementedError):
            windows.win_absent(name)
