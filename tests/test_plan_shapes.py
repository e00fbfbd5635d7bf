"""What the physical plans have to look like."""

import re

import pytest

from tablewright.operators import joins, windows
from tablewright.plans import catalogue

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    execution = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution()
    return spark._jvm.PythonSQLUtils.explainString(execution, "formatted")


def test_columns_and_filters_reach_the_scan(spark):
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>", plan(spark, "select_variables"))
    p = plan(spark, "filter")
    assert "GreaterThanOrEqual(l_shipdate" in p and "l_extendedprice" not in p


def test_limits_are_not_sorted_whole(spark):
    assert "TakeOrderedAndProject" in plan(spark, "max_results")
    assert "TakeOrderedAndProject" in plan(spark, "sql_fetch_n")
    assert "TakeOrderedAndProject" in plan(spark, "list_first")


def test_top_k_cuts_before_the_shuffle(spark):
    p = plan(spark, "top_k")
    assert "rank(l_extendedprice" in p and ", 10, Partial" in p and ", 10, Final" in p


@pytest.mark.parametrize("name", ["read_streams", "read_sample", "batch_preprocess", "file_chunks", "win_n", "coerce_types"])
def test_no_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n.startswith(("join", "win", "agg", "sql", "dir", "list", "sync"))])
def test_no_cartesian_product_and_no_global_window(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    if "Window" in p:
        assert "SinglePartition" not in p


def shuffled_rows(spark, run):
    """Rows that are written to shuffles while ``run`` runs."""
    context = spark.sparkContext
    store, bus = context._jsc.sc().statusStore(), context._jsc.sc().listenerBus()

    def stages():
        bus.waitUntilEmpty()
        none = context._gateway.new_array(spark._jvm.double, 0)
        found = store.stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
        return {found.apply(k).stageId(): found.apply(k).shuffleWriteRecords() for k in range(found.size())}

    before = stages()
    run()
    return sum(n for k, n in stages().items() if k not in before)


@pytest.mark.parametrize("keys", [["o_orderpriority"], ["o_custkey"], []])
@pytest.mark.parametrize("kind", ["ranked", "running", "shifted", "quantiles"])
def test_ordered_windows_move_rows_once(spark, many_partitions, keys, kind):
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderpriority", "o_custkey", "o_orderdate", "o_totalprice")
    n = df.count()
    calls = {
        "ranked": lambda: windows.ranked(df, keys, "o_orderdate"),
        "running": lambda: windows.running(df, keys, "o_orderdate", {"s": ("sum", "o_totalprice")}),
        "shifted": lambda: windows.shifted(df, keys, "o_orderdate", {"a": ("o_totalprice", 2)}),
        "quantiles": lambda: windows.quantiles(df, keys, "o_totalprice", {"m": 0.5}),
    }
    frames = []
    moved = shuffled_rows(spark, lambda: frames.append(calls[kind]()) or frames[0].write.format("noop").mode("overwrite").save())
    # each block passes on its own groups' values where they are the result
    groups = df.select(*keys).distinct().count() + 8 if kind == "quantiles" and keys else 8
    assert n <= moved <= n + groups + 8 * 16
    p = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in p and "Bucketed: true" in p


def test_asof_join_moves_each_side_once(spark, many_partitions):
    events = spark.read.parquet(f"{SF}/events.parquet")
    left = events.where("event_type <> 'view'").select("user_id", "event_id", "ts")
    right = events.where("event_type = 'view'").select("user_id", events["ts"].alias("seen"), events["value"].alias("v"))
    run = lambda: joins.asof_join(left, right, "user_id", "ts", "seen", "event_id").write.format("noop").mode("overwrite").save()
    # the right side once more, to make its rows of one time one
    assert shuffled_rows(spark, run) <= left.count() + 2 * right.count() + 8 * 16
