"""SQL, verb, join, aggregate, window and set-operation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablewright.functions import aggregate as agg
from tablewright.operators import joins, windows
from tablewright.operators.aggregates import pivot_wider_found, summarise
from tablewright.plans import sql
from tablewright.plans.registry import register, table, tables
from tablewright.session import shared_dir

c = F.col

# --- SQL

_REVENUE = """
    SELECT n_name, COUNT(*) AS n, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM customer
    INNER JOIN orders ON c_custkey = o_custkey
    INNER JOIN lineitem ON l_orderkey = o_orderkey
    INNER JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
    GROUP BY n_name
"""


@register("sql_query", _REVENUE.replace("TIMESTAMP '1996-01-01 00:00:00'", "TIMESTAMP '1996-01-01'"))
def sql_query(spark, sf_dir):
    return sql.query(
        spark,
        _REVENUE.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"),
        tables(spark, sf_dir, "customer", "orders", "lineitem", "nation"),
    )


@register(
    "scoped_query",
    "SELECT c_mktsegment, COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean FROM orders "
    "JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
)
def scoped_query(spark, sf_dir):
    """Bare names that mean something in this scope only."""
    scope = {"purchases": table(spark, sf_dir, "orders"), "buyers": table(spark, sf_dir, "customer")}
    text = (
        "SELECT c_mktsegment, COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean FROM purchases "
        "JOIN buyers ON o_custkey = c_custkey GROUP BY c_mktsegment"
    )
    return sql.query(spark, text, workflow=scope)


@register(
    "mapped_tables",
    "SELECT l_suppkey, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem "
    "JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY l_suppkey",
)
def mapped_tables(spark, sf_dir):
    """A query written for other table names."""
    source = sql.datasource(tables(spark, sf_dir, "lineitem", "orders"), [("lineitem", "items")])
    text = (
        "SELECT l_suppkey, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity FROM items "
        "JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY l_suppkey"
    )
    return sql.query(spark, text, source)


@register("sql_fetch_n", "SELECT l_orderkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey LIMIT 20")
def sql_fetch_n(spark, sf_dir):
    rows = sql.query(
        spark,
        "SELECT l_orderkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey",
        tables(spark, sf_dir, "lineitem"),
    )
    return sql.fetch(rows, 20)


@register("sql_row_count", "SELECT COUNT(*) AS row_count FROM lineitem WHERE l_discount > 0.05")
def sql_row_count(spark, sf_dir):
    text = "SELECT * FROM lineitem WHERE l_discount > 0.05"
    return sql.row_count(sql.query(spark, text, tables(spark, sf_dir, "lineitem")))


@register(
    "sql_parameters",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 1000",
)
def sql_parameters(spark, sf_dir):
    return sql.query(
        spark,
        "SELECT c_custkey, c_mktsegment FROM customer "
        "WHERE array_contains(:segments, c_mktsegment) AND c_acctbal > :least",
        tables(spark, sf_dir, "customer"),
        parameters={"segments": ["BUILDING", "MACHINERY"], "least": 1000.0},
    )


@register(
    "sql_parameter_list",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def sql_parameter_list(spark, sf_dir):
    """A long list of values, held in a table."""
    values = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return sql.in_values(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", values)


@register(
    "run_transform",
    "SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey",
)
def run_transform(spark, sf_dir):
    path = shared_dir(spark, "transform")
    text = "SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM _source_ GROUP BY o_custkey"
    name = "transform_" + path.rsplit("-", 1)[-1]
    return sql.run_transform(table(spark, sf_dir, "orders"), text, name, path)


# --- verbs


@register(
    "filter",
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE (l_quantity BETWEEN 10 AND 20 OR l_returnflag IN ('A', 'R')) AND NOT l_linestatus = 'O'
      AND l_tax IS NOT NULL AND l_shipdate >= TIMESTAMP '1996-06-01'
    """,
)
def filter_(spark, sf_dir):
    kept = table(spark, sf_dir, "lineitem").where(
        (c("l_quantity").between(10, 20) | c("l_returnflag").isin("A", "R"))
        & ~(c("l_linestatus") == "O")
        & c("l_tax").isNotNull()
        & (c("l_shipdate") >= F.lit("1996-06-01").cast("timestamp_ntz"))
    )
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


@register("select_rename", "SELECT c_name AS customer_name, c_custkey AS id, c_mktsegment FROM customer")
def select_rename(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_mktsegment")
    return df.withColumnsRenamed({"c_name": "customer_name", "c_custkey": "id"})


@register(
    "mutate",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, "
    "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem",
)
def mutate(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    df = df.withColumn("net", c("l_extendedprice") * (1 - c("l_discount")))
    return df.select("l_orderkey", "l_linenumber", "net", (c("net") * (1 + c("l_tax"))).alias("gross"))


@register("arrange", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def arrange(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return df.orderBy(c("o_orderdate").desc_nulls_last(), "o_totalprice")


@register("distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@register(
    "top_k",
    "SELECT l_returnflag, l_quantity, l_orderkey, l_extendedprice FROM lineitem "
    "QUALIFY RANK() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) <= 10",
)
def top_k(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_orderkey", "l_extendedprice")
    return windows.top_k(df, "l_returnflag", [F.desc("l_extendedprice")], 10)


@register(
    "group_summarise",
    "SELECT l_suppkey, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity, MAX(l_shipdate) AS last_ship, "
    "COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey",
)
def group_summarise(spark, sf_dir):
    return summarise(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        {"n": agg.n(), "quantity": F.round(F.sum("l_quantity"), 2), "last_ship": F.max("l_shipdate")},
        distinct={"parts": "l_partkey"},
    )


@register("select_except", "SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def select_except(spark, sf_dir):
    return sql.query(spark, "SELECT * EXCEPT (c_acctbal, c_nationkey) FROM customer", tables(spark, sf_dir, "customer"))


@register(
    "pivot_wider",
    "SELECT l_returnflag, ROUND(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 2) AS F, "
    "ROUND(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 2) AS O FROM lineitem GROUP BY l_returnflag",
)
def pivot_wider(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return pivot_wider_found(lines, "l_returnflag", "l_linestatus", F.round(F.sum("l_quantity"), 2))


@register(
    "pivot_longer",
    "SELECT l_orderkey, l_partkey, 'l_discount' AS name, l_discount AS value FROM lineitem "
    "UNION ALL SELECT l_orderkey, l_partkey, 'l_tax', l_tax FROM lineitem",
)
def pivot_longer(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").unpivot(
        ["l_orderkey", "l_partkey"], ["l_discount", "l_tax"], "name", "value"
    )


@register(
    "case_when",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'medium'
           ELSE 'large' END AS size_class, NULLIF(l_returnflag, 'N') AS returned, COALESCE(NULLIF(l_tax, 0.0), -1) AS tax
    FROM lineitem
    """,
)
def case_when(spark, sf_dir):
    size = F.when(c("l_quantity") < 10, "small").when(c("l_quantity") < 40, "medium").otherwise("large")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey",
            "l_linenumber",
            size.alias("size_class"),
            F.nullif("l_returnflag", F.lit("N")).alias("returned"),
            F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        )
        .fillna({"tax": -1.0})
    )


# --- joins


@register(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.join(table(spark, sf_dir, "orders"), customer, "o_custkey").select(
        "o_orderkey", "c_name", "o_totalprice"
    )


_RICH = "(SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000)"


def _rich(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_acctbal > 5000").select("c_custkey", "c_name")


def _joined(how: str):
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        rich = _rich(spark, sf_dir)
        return joins.join(orders, rich, orders["o_custkey"] == rich["c_custkey"], how)

    return run


register("join_left", f"SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders LEFT JOIN {_RICH} ON o_custkey = c_custkey")(
    _joined("left")
)
for _how, _word in (("semi", ""), ("anti", "NOT")):
    register(
        f"join_{_how}",
        f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey {_word} IN (SELECT c_custkey FROM {_RICH})",
    )(_joined(f"left_{_how}"))


@register(
    "join_right",
    "SELECT l.doc_id AS labelled, quality, d.doc_id, lang FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id",
)
def join_right(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(c("doc_id").alias("labelled"), "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.join(labels, docs, c("labelled") == c("doc_id"), "right")


@register(
    "join_full",
    "SELECT c_custkey, p_partkey, c_name, p_name FROM customer FULL JOIN part "
    "ON c_custkey = p_partkey AND c_mktsegment <> 'BUILDING'",
)
def join_full(spark, sf_dir):
    """Unmatched rows on both sides."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    on = (c("c_custkey") == c("p_partkey")) & (c("c_mktsegment") != "BUILDING")
    return joins.join(customer, part, on, "full").drop("c_mktsegment")


_PROMOTED = "8035 + (c_custkey * 37) % 2400"


@register(
    "join_range",
    f"""
    SELECT c_custkey AS start_key, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total
    FROM (SELECT *, DATE_DIFF('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day FROM orders)
    JOIN (SELECT c_custkey, {_PROMOTED} AS low, {_PROMOTED} + 30 * (1 + c_nationkey) AS high FROM customer)
      ON o_custkey = c_custkey AND day >= low AND day < high
    GROUP BY c_custkey
    """,
)
def join_range(spark, sf_dir):
    """Each customer's orders within an interval of their own, of 30 to 750 days."""
    points = table(spark, sf_dir, "orders").select(
        c("o_custkey").alias("key"), F.unix_date(c("o_orderdate").cast("date")).alias("day"), "o_totalprice"
    )
    low = F.expr(_PROMOTED)
    spans = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("key"), low.alias("low"), (low + 30 * (1 + c("c_nationkey"))).alias("high")
    )
    near = joins.range_join(points, spans, "day", "low", "high", on=["key"])
    return near.groupBy(c("key").alias("start_key")).agg(agg.n().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register(
    "join_range_time",
    """
    SELECT event_id, user_id FROM events
    JOIN (SELECT user_id, MIN(ts) AS low, MIN(ts) + INTERVAL 1 DAY AS high FROM events GROUP BY user_id) USING (user_id)
    WHERE ts >= low AND (ts < high OR user_id % 7 = 0)
    """,
)
def join_range_time(spark, sf_dir):
    """Events of each user's first day; for some users the interval has no end."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy("user_id").agg(F.min("ts").alias("low"))
    end = F.when(c("user_id") % 7 != 0, c("low") + F.expr("INTERVAL 1 DAY"))
    out = joins.range_join(events.select("event_id", "user_id", "ts"), first.withColumn("high", end), "ts", "low", "high", on=["user_id"])
    return out.select("event_id", "user_id")


@register(
    "join_asof",
    """
    SELECT a.event_id, a.user_id, a.ts, b.event_id AS view_id, b.ts AS viewed_at
    FROM (SELECT * FROM events WHERE event_type <> 'view') a
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts >= b.ts
    """,
)
def join_asof(spark, sf_dir):
    """Each other event with the user's last view before it."""
    events = table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("user_id", c("event_id").alias("view_id"), c("ts").alias("viewed_at"))
    others = events.where("event_type <> 'view'").select("user_id", "event_id", "ts")
    return joins.asof_join(others, views, "user_id", "ts", "viewed_at", "event_id")


# --- aggregates

_G = ["l_returnflag", "l_linestatus"]


def _aggregate(name: str, columns: dict) -> None:
    select = ", ".join(f"{text} AS {k}" for k, (_, text) in columns.items())

    @register(f"agg_{name}", f"SELECT l_returnflag, l_linestatus, {select} FROM lineitem GROUP BY ALL")
    def run(spark, sf_dir):
        made = [make().alias(k) for k, (make, _) in columns.items()]
        return table(spark, sf_dir, "lineitem").groupBy(*_G).agg(*made)


_aggregate("n", {"n": (agg.n, "COUNT(*)")})
_aggregate("all", {"all_taxed": (lambda: agg.all_(c("l_tax") > 0), "BOOL_AND(l_tax > 0)")})
_aggregate("any", {"any_large": (lambda: agg.any_(c("l_quantity") > 49), "BOOL_OR(l_quantity > 49)")})
_aggregate("sd", {"sd": (lambda: F.round(agg.sd("l_quantity"), 6), "ROUND(STDDEV_SAMP(l_quantity), 6)")})
_aggregate("var", {"var": (lambda: F.round(agg.var("l_quantity"), 6), "ROUND(VAR_SAMP(l_quantity), 6)")})
_aggregate(
    "cor",
    {"cor": (lambda: F.round(agg.cor("l_quantity", "l_extendedprice"), 8), "ROUND(CORR(l_quantity, l_extendedprice), 8)")},
)
_aggregate(
    "cov",
    {"cov": (lambda: F.round(agg.cov("l_quantity", "l_discount"), 8), "ROUND(COVAR_SAMP(l_quantity, l_discount), 8)")},
)
_aggregate("n_distinct", {"parts": (lambda: agg.n_distinct("l_partkey"), "COUNT(DISTINCT l_partkey)")})
_aggregate(
    "median",
    {"median": (lambda: agg.median("l_extendedprice", 1_000_000), "QUANTILE_DISC(l_extendedprice, 0.5)")},
)
_aggregate(
    "basic",
    {
        "total": (lambda: F.round(F.sum("l_extendedprice"), 2), "ROUND(SUM(l_extendedprice), 2)"),
        "mean": (lambda: F.round(F.avg("l_extendedprice"), 6), "ROUND(AVG(l_extendedprice), 6)"),
        "smallest": (lambda: F.min("l_shipdate"), "MIN(l_shipdate)"),
        "largest": (lambda: F.max("l_shipdate"), "MAX(l_shipdate)"),
    },
)


@register(
    "join_asof_nulls",
    """
    WITH a AS (SELECT event_id, NULLIF(user_id, 3) AS user_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts
               FROM events WHERE event_type <> 'view'),
    b AS (SELECT event_id, NULLIF(user_id, 3) AS user_id, CASE WHEN event_id % 4 <> 0 THEN ts END AS ts
          FROM events WHERE event_type = 'view')
    SELECT a.event_id, MAX(b.ts) AS viewed_at FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.ts >= b.ts GROUP BY a.event_id
    """,
)
def join_asof_nulls(spark, sf_dir):
    """Null keys and null times match nothing."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.nullif("user_id", F.lit(3)))
    views = events.where("event_type = 'view'").select("user_id", F.when(c("event_id") % 4 != 0, c("ts")).alias("viewed_at"))
    others = events.where("event_type <> 'view'").select("user_id", "event_id", F.when(c("event_id") % 5 != 0, c("ts")).alias("ts"))
    return joins.asof_join(others, views, "user_id", "ts", "viewed_at", "event_id").select("event_id", "viewed_at")


@register(
    "agg_quantile_nulls",
    "SELECT l_suppkey, ROUND(QUANTILE_CONT(CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity END, 0.4), 6) AS q40 FROM lineitem GROUP BY l_suppkey",
)
def agg_quantile_nulls(spark, sf_dir):
    """A group of only nulls has a null quantile."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(c("l_suppkey") % 3 != 0, c("l_quantity")).alias("x"))
    return windows.quantiles(rows, "l_suppkey", "x", {"q40": 0.4}).select("l_suppkey", F.round("q40", 6).alias("q40"))


@register(
    "agg_flatten_nulls",
    "SELECT l_orderkey, STRING_AGG(NULLIF(l_linestatus, 'O'), '-' ORDER BY l_linestatus) AS statuses FROM lineitem GROUP BY l_orderkey",
)
def agg_flatten_nulls(spark, sf_dir):
    """A group without texts has a null."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.nullif("l_linestatus", F.lit("O")).alias("s"))
    return windows.flattened(rows, "l_orderkey", "s", "statuses", "-")


@register(
    "agg_quantile",
    "SELECT l_returnflag, l_linestatus, ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 6) AS q25, "
    "ROUND(QUANTILE_CONT(l_extendedprice, 0.9), 6) AS q90 FROM lineitem GROUP BY ALL",
)
def agg_quantile(spark, sf_dir):
    out = windows.quantiles(table(spark, sf_dir, "lineitem"), _G, "l_extendedprice", {"q25": 0.25, "q90": 0.9})
    return out.select(*_G, F.round("q25", 6).alias("q25"), F.round("q90", 6).alias("q90"))


@register(
    "agg_flatten",
    "SELECT l_orderkey, STRING_AGG(l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS flags "
    "FROM lineitem GROUP BY l_orderkey",
)
def agg_flatten(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("f"))
    return windows.flattened(flags, "l_orderkey", "f", "flags", ",")


@register(
    "agg_first_last",
    "SELECT o_custkey, ARG_MIN(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, "
    "ARG_MAX(o_totalprice, (o_orderdate, o_orderkey)) AS last_price FROM orders GROUP BY o_custkey",
)
def agg_first_last(spark, sf_dir):
    at = F.struct("o_orderdate", "o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(agg.first_by("o_totalprice", at).alias("first_price"), agg.last_by("o_totalprice", at).alias("last_price"))
    )


_SUMS = "l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem GROUP BY"


def _sums():
    return agg.n().alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")


@register("agg_rollup", f"SELECT {_SUMS} ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup(*_G).agg(*_sums())


@register("agg_cube", f"SELECT {_SUMS} CUBE (l_returnflag, l_linestatus)")
def agg_cube(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube(*_G).agg(*_sums())


@register("agg_grouping_sets", f"SELECT {_SUMS} GROUPING SETS ((l_returnflag), (l_linestatus))")
def agg_grouping_sets(spark, sf_dir):
    sets = [[c("l_returnflag")], [c("l_linestatus")]]
    return table(spark, sf_dir, "lineitem").groupingSets(sets, *_G).agg(*_sums())


# --- windows


@register("win_n", "SELECT l_orderkey, l_partkey, l_suppkey, COUNT(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem")
def win_n(spark, sf_dir):
    return windows.win_n(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey"), "l_suppkey")


@register(
    "win_sd",
    "SELECT l_orderkey, l_partkey, ROUND(STDDEV_SAMP(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS sd FROM lineitem",
)
def win_sd(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return windows.win_sd(df, "l_suppkey", "l_quantity").select("l_orderkey", "l_partkey", F.round("sd", 6).alias("sd"))


@register(
    "win_var",
    "SELECT l_orderkey, l_partkey, ROUND(VAR_SAMP(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS var FROM lineitem",
)
def win_var(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return windows.win_var(df, "l_suppkey", "l_quantity").select("l_orderkey", "l_partkey", F.round("var", 6).alias("var"))


@register(
    "win_recycled",
    "SELECT l_orderkey, l_partkey, ROUND(SUM(l_quantity) OVER w, 2) AS total, ROUND(AVG(l_quantity) OVER w, 6) AS mean, "
    "MIN(l_quantity) OVER w AS least, MAX(l_quantity) OVER w AS most FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)",
)
def win_recycled(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return windows.recycled(
        df,
        "l_suppkey",
        total=F.round(F.sum("l_quantity"), 2),
        mean=F.round(F.avg("l_quantity"), 6),
        least=F.min("l_quantity"),
        most=F.max("l_quantity"),
    ).drop("l_suppkey", "l_quantity")


@register(
    "win_rank",
    """
    SELECT o_orderkey, ROW_NUMBER() OVER w AS row_number, RANK() OVER w AS rank,
           DENSE_RANK() OVER w AS dense_rank, PERCENT_RANK() OVER w AS percent_rank,
           CUME_DIST() OVER w AS cume_dist, NTILE(4) OVER w AS ntile
    FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey)
    """,
)
def win_rank(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return windows.ranked(df, "o_orderpriority", ["o_totalprice", "o_orderkey"]).drop("o_orderpriority", "o_totalprice")


@register(
    "win_rank_desc",
    """
    SELECT event_id, ROW_NUMBER() OVER w AS row_number, NTILE(5) OVER w AS ntile FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY CASE WHEN event_id % 9 <> 0 THEN value END DESC NULLS FIRST, event_id)
    """,
)
def win_rank_desc(spark, sf_dir):
    """Largest first, nulls before them."""
    df = table(spark, sf_dir, "events").select("event_type", "event_id", F.when(c("event_id") % 9 != 0, c("value")).alias("v"))
    out = windows.ranked(df, "event_type", [windows.By("v", desc=True, nulls_last=False), "event_id"], buckets=5)
    return out.select("event_id", "row_number", "ntile")


@register(
    "win_n_all",
    """
    SELECT o_orderkey, COUNT(*) OVER () AS n, LAG(o_orderkey, 2) OVER (ORDER BY o_orderdate DESC, o_orderkey) AS before
    FROM orders
    """,
)
def win_n_all(spark, sf_dir):
    """All rows as one group."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    order = [windows.By("o_orderdate", desc=True), "o_orderkey"]
    out = windows.shifted(windows.win_n(df, []), [], order, {"before": ("o_orderkey", 2)})
    return out.drop("o_orderdate")


@register(
    "win_range_frame_date",
    """
    SELECT o_orderkey, COUNT(*) OVER w AS n FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day RANGE BETWEEN INTERVAL 20 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING)
    """,
)
def win_range_frame_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", c("o_orderdate").cast("date").alias("day"))
    out = windows.range_framed(orders, "o_orderpriority", "day", dt.timedelta(days=20), 3, {"n": ("count", F.lit(1))})
    return out.select("o_orderkey", "n")


@register(
    "win_rank_ties",
    """
    SELECT o_orderkey, RANK() OVER w AS rank, DENSE_RANK() OVER w AS dense_rank,
           PERCENT_RANK() OVER w AS percent_rank, CUME_DIST() OVER w AS cume_dist
    FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate)
    """,
)
def win_rank_ties(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    out = windows.ranked(df, "o_orderstatus", "o_orderdate")
    return out.select("o_orderkey", "rank", "dense_rank", "percent_rank", "cume_dist")


@register(
    "win_lag_lead",
    """
    SELECT event_id, LAG(value, 2) OVER w AS two_before, LEAD(event_type) OVER w AS next_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def win_lag_lead(spark, sf_dir):
    out = windows.shifted(
        table(spark, sf_dir, "events"),
        "user_id",
        ["ts", "event_id"],
        lags={"two_before": ("value", 2)},
        leads={"next_type": ("event_type", 1)},
    )
    return out.select("event_id", "two_before", "next_type")


@register(
    "win_first_last",
    """
    SELECT event_id, FIRST_VALUE(value) OVER w AS first_value, LAST_VALUE(value) OVER w AS last_value,
           NTH_VALUE(value, 3) OVER w AS nth_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def win_first_last(spark, sf_dir):
    out = windows.nth_values(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value", n=3)
    return out.select("event_id", "first_value", "last_value", "nth_value")


@register(
    "win_cumsum",
    """
    SELECT o_orderkey, SUM(cents) OVER w AS cum_sum, SUM(cents) OVER w / COUNT(*) OVER w AS cum_mean,
           MIN(cents) OVER w AS cum_min, MAX(cents) OVER w AS cum_max
    FROM (SELECT *, ROUND(o_totalprice * 100) AS cents FROM orders)
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def win_cumsum(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("cents", F.round(c("o_totalprice") * 100))
    df = df.select("o_orderpriority", "o_orderdate", "o_orderkey", "cents")
    out = windows.cumulative(df, "o_orderpriority", ["o_orderdate", "o_orderkey"], "cents")
    return out.select("o_orderkey", "cum_sum", "cum_mean", "cum_min", "cum_max")


@register(
    "win_frame",
    """
    SELECT event_id, ROUND(AVG(value) OVER w, 6) AS mean, MAX(value) OVER w AS most
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)
    """,
)
def win_frame(spark, sf_dir):
    out = windows.framed(
        table(spark, sf_dir, "events"),
        "user_id",
        ["ts", "event_id"],
        3,
        2,
        {"mean": F.avg("value"), "most": F.max("value")},
    )
    return out.select("event_id", F.round("mean", 6).alias("mean"), "most")


@register(
    "win_range_frame",
    """
    SELECT o_orderkey, COUNT(*) OVER w AS n, ROUND(SUM(o_totalprice) OVER w, 2) AS total
    FROM (SELECT *, DATE_DIFF('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day FROM orders)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY day RANGE BETWEEN 60 PRECEDING AND CURRENT ROW)
    """,
)
def win_range_frame(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.unix_date(c("o_orderdate").cast("date")))
    out = windows.range_framed(
        orders, "o_custkey", "day", 60, 0, {"n": ("count", F.lit(1)), "total": ("sum", "o_totalprice")}
    )
    return out.select("o_orderkey", "n", F.round("total", 2).alias("total"))


@register(
    "win_range_frame_dense",
    """
    SELECT o_orderkey, COUNT(*) OVER w AS n, MIN(o_orderkey) OVER w AS lowest, MAX(o_custkey) OVER w AS highest, SUM(o_custkey) OVER w AS total
    FROM orders
    WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice RANGE BETWEEN 50000 PRECEDING AND 10000 FOLLOWING)
    """,
)
def win_range_frame_dense(spark, sf_dir):
    """Three groups, nearly all values distinct: the frames go over blocks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    values = {"n": ("count", F.lit(1)), "lowest": ("min", "o_orderkey"), "highest": ("max", "o_custkey"), "total": ("sum", "o_custkey")}
    out = windows.range_framed(orders, "o_orderstatus", "o_totalprice", 50_000, 10_000, values, cell_rows=1000)
    return out.select("o_orderkey", *values)


# --- set operations


def _keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(c("o_custkey").alias("k"))
    customer = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(c("c_custkey").alias("k"))
    return orders, customer


_LEFT, _RIGHT = "SELECT o_custkey AS k FROM orders", "SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0"


@register("union_all", f"{_LEFT} UNION ALL {_RIGHT}")
def union_all(spark, sf_dir):
    left, right = _keys(spark, sf_dir)
    return left.unionByName(right)


@register("union_distinct", f"{_LEFT} UNION {_RIGHT}")
def union_distinct(spark, sf_dir):
    left, right = _keys(spark, sf_dir)
    return left.unionByName(right).distinct()


@register("intersect", f"{_LEFT} INTERSECT {_RIGHT}")
def intersect(spark, sf_dir):
    left, right = _keys(spark, sf_dir)
    return left.intersect(right)


@register("except", f"{_LEFT} EXCEPT {_RIGHT}")
def except_(spark, sf_dir):
    left, right = _keys(spark, sf_dir)
    return left.subtract(right)


@register("except_all", f"{_LEFT} EXCEPT ALL {_RIGHT}")
def except_all(spark, sf_dir):
    left, right = _keys(spark, sf_dir)
    return left.exceptAll(right)
