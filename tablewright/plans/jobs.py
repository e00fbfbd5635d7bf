"""Sink, streaming-insert and data-management queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import aggregate as agg
from tablewright.operators import profile as prof
from tablewright.operators import sinks
from tablewright.plans.reads import ORDERS
from tablewright.plans.registry import register, table
from tablewright.session import shared_dir
from tablewright.sources import delimited
from tablewright.sources.uploads import UploadTable
from tablewright.streaming.inserts import insert_rows_stream, insert_uploads_stream
from tablewright.types import logical_type
from tablewright.types import schema as declare

EVENTS = declare(
    {
        "event_id": "integer",
        "ts": "dateTime",
        "user_id": "integer",
        "event_type": "string",
        "value": "float",
        "props": "string",
    }
)


def _table_name(path: str) -> str:
    return "out_" + path.rsplit("-", 1)[-1]


@register("to_dataset", "SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem")
def to_dataset(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return sinks.to_dataset(df.select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")))


@register("export_csv", "SELECT * FROM orders")
def export_csv(spark, sf_dir):
    path = sinks.export(table(spark, sf_dir, "orders"), shared_dir(spark, "export"), delimiter="\t")
    return delimited.read_delimited(spark, path, ORDERS, delimiter="\t")


@register("export_parquet", "SELECT * FROM lineitem")
def export_parquet(spark, sf_dir):
    path = sinks.export(table(spark, sf_dir, "lineitem"), shared_dir(spark, "export"), "parquet")
    return spark.read.parquet(path)


@register("export_overwrite", "SELECT * FROM customer WHERE c_acctbal >= 0")
def export_overwrite(spark, sf_dir):
    """A second export to the same place replaces the first."""
    df, path = table(spark, sf_dir, "customer"), shared_dir(spark, "export")
    sinks.export(df, path, "parquet")
    sinks.export(df.where("c_acctbal >= 0"), path, "parquet", overwrite=True)
    return spark.read.parquet(path)


@register(
    "export_manifest",
    r"""
    SELECT 'order_lines_2024_' AS directory, TRUE AS named,
           CAST(SUM(STRLEN(CAST(l_orderkey AS VARCHAR) || ',' || l_returnflag) + 1) AS BIGINT) AS bytes
    FROM lineitem
    """,
)
def export_manifest(spark, sf_dir):
    """Files of an export in at least two parts, without their header lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag").repartition(4)
    manifest = sinks.export_files(lines, shared_dir(spark, "export"), "Order lines (2024)", "csv")
    header = len("l_orderkey,l_returnflag\n")
    return manifest.groupBy(F.split("target", "/")[0].alias("directory")).agg(
        F.bool_and(F.col("target").rlike(r"/\d{6}[.]csv$")).alias("named"),
        F.sum(F.col("size") - header).alias("bytes"),
    )


@register("output_table", "SELECT c_custkey, 'POINT(' || c_nationkey || ' 0)' AS place, TRUE AS marked FROM customer")
def output_table(spark, sf_dir):
    place = F.concat(F.lit("POINT("), "c_nationkey", F.lit(" 0)")).alias("place")
    path = shared_dir(spark, "output")
    df = table(spark, sf_dir, "customer").select("c_custkey", place)
    out = sinks.output_table(df, _table_name(path), path, geography_variables=["place"])
    return out.withColumn("marked", F.lit(logical_type(out.schema["place"]) == "geography"))


@register(
    "output_table_append",
    "SELECT c_custkey AS k, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier",
)
def output_table_append(spark, sf_dir):
    path = shared_dir(spark, "output")
    name = _table_name(path)
    for t, k, v in (("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal")):
        rows = table(spark, sf_dir, t).select(F.col(k).alias("k"), F.col(v).alias("balance"))
        sinks.output_table(rows, name, path, append=True)
    return spark.table(name)


@register(
    "output_table_append_path",
    "SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation",
)
def output_table_append_path(spark, sf_dir):
    """Rows added at a path under a name that the catalog does not know."""
    path = shared_dir(spark, "output")
    name = _table_name(path)
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    sinks.output_table(region, name, path)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return sinks.output_table(nation, f"{name}_more", path, append=True)


@register("parquet_layout", "SELECT * FROM lineitem")
def parquet_layout(spark, sf_dir):
    path = shared_dir(spark, "layout")
    sinks.write_layout(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


@register("write_verified", "SELECT COUNT(*) AS written, COUNT(*) AS found FROM lineitem")
def write_verified(spark, sf_dir):
    path = shared_dir(spark, "verified")
    written = sinks.write_verified(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path).agg(agg.n().alias("found")).withColumn("written", F.lit(written).cast("bigint"))


def _json_rows(spark, sf_dir):
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return table(spark, sf_dir, "events").select(F.to_json(F.struct("*"), micros).alias("value"))


@register("insert_rows", "SELECT * FROM events")
def insert_rows(spark, sf_dir):
    path = shared_dir(spark, "inserted")
    sinks.insert_rows(_json_rows(spark, sf_dir), path, EVENTS)
    return spark.read.parquet(path)


@register("insert_rows_stream", "SELECT * FROM events")
def insert_rows_stream_(spark, sf_dir):
    """JSON files through a stream; a second run finds nothing new."""
    source, target, state = (shared_dir(spark, n) for n in ("rows", "streamed", "state"))
    _json_rows(spark, sf_dir).repartition(4).write.text(source)
    for _ in range(2):
        insert_rows_stream(spark, source, target, state, EVENTS, max_files_per_trigger=2).awaitTermination()
    return spark.read.schema(EVENTS).parquet(target)


@register("insert_uploads_stream", "SELECT * FROM events")
def insert_uploads_stream_(spark, sf_dir):
    """The same rows into a table of uploads, one per batch."""
    source, state = shared_dir(spark, "rows"), shared_dir(spark, "state")
    _json_rows(spark, sf_dir).repartition(4).write.text(source)
    inserted = UploadTable(spark, shared_dir(spark, "uploads"), EVENTS)
    insert_uploads_stream(source, inserted, "rows", state, EVENTS, max_files_per_trigger=2).awaitTermination()
    return inserted.read()


# --- column statistics and labels

_NUMBERS = {"o_orderkey": "integer", "o_custkey": "integer", "o_totalprice": "float"}
_PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{f.name}' AS variable, '{logical_type(f)}' AS type, COUNT(*) AS rows,
        COUNT(*) - COUNT({f.name}) AS nulls, {f"ROUND(AVG({f.name}), 6)" if f.name in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS mean,
        {f"ROUND(STDDEV_SAMP({f.name}), 6)" if f.name in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS sd
        FROM orders"""
    for f in ORDERS
)


@register("profile", _PROFILE_SQL)
def profile(spark, sf_dir):
    out = prof.profile(table(spark, sf_dir, "orders"))
    return out.select("variable", "type", "rows", "nulls", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


@register(
    "profile_range",
    """
    SELECT 'o_orderkey' AS variable, CAST(MIN(o_orderkey) AS VARCHAR) AS min, CAST(MAX(o_orderkey) AS VARCHAR) AS max FROM orders
    UNION ALL SELECT 'o_custkey', CAST(MIN(o_custkey) AS VARCHAR), CAST(MAX(o_custkey) AS VARCHAR) FROM orders
    UNION ALL SELECT 'o_orderstatus', MIN(o_orderstatus), MAX(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', CAST(MIN(o_totalprice) AS VARCHAR), CAST(MAX(o_totalprice) AS VARCHAR) FROM orders
    UNION ALL SELECT 'o_orderdate', CAST(MIN(o_orderdate) AS VARCHAR), CAST(MAX(o_orderdate) AS VARCHAR) FROM orders
    UNION ALL SELECT 'o_orderpriority', MIN(o_orderpriority), MAX(o_orderpriority) FROM orders
    """,
)
def profile_range(spark, sf_dir):
    return prof.profile(table(spark, sf_dir, "orders")).select("variable", "min", "max")


@register("profile_all")
def profile_all(spark, sf_dir):
    """All statistics of the widest table; the sketches have no exact SQL."""
    return prof.profile(table(spark, sf_dir, "lineitem"))


_UPLOADS_SQL = " UNION ALL ".join(
    f"""SELECT '{f.name}' AS variable, '{logical_type(f)}' AS type, COUNT(*) AS rows,
        COUNT(*) - COUNT({f.name}) AS nulls, CAST(MIN({f.name}) AS VARCHAR) AS min, CAST(MAX({f.name}) AS VARCHAR) AS max,
        {f"ROUND(AVG({f.name}), 6)" if f.name in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS mean,
        {f"ROUND(STDDEV_SAMP({f.name}), 6)" if f.name in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS sd
        FROM orders WHERE o_orderkey % 3 > 0 OR o_orderpriority <> '5-LOW'"""
    for f in ORDERS
)


@register("profile_uploads", _UPLOADS_SQL)
def profile_uploads(spark, sf_dir):
    """Statistics of three uploads, asked for after each, with one of them replaced."""
    orders, stored = table(spark, sf_dir, "orders"), UploadTable(spark, shared_dir(spark, "uploads"), ORDERS)
    for k in range(3):
        stored.upload(orders.where(F.col("o_orderkey") % 3 == k), f"part_{k}")
        stored.profile()
    kept = orders.where("o_orderkey % 3 = 0 AND o_orderpriority <> '5-LOW'")
    stored.upload(kept, "part_0", replace_on_conflict=True)
    out = stored.profile()
    return out.select("variable", "type", "rows", "nulls", "min", "max", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


_SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@register(
    "profile_bounds",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS variable, COUNT({c}) AS numbers, COUNT(DISTINCT {c}) AS n_distinct,"
        " TRUE AS distinct_near, TRUE AS median_near FROM lineitem"
        for kind in ("table", "uploads")
        for c in _SKETCHED
    ),
)
def profile_bounds(spark, sf_dir):
    """The sketches of a table and of its uploads against exact values: distinct counts
    within 6 %, and medians with 48 to 52 % of the rows on either side at least."""
    lines = table(spark, sf_dir, "lineitem").select(*_SKETCHED)
    stored = UploadTable(spark, shared_dir(spark, "uploads"))
    for k in range(4):
        stored.upload(lines.where(F.pmod(F.xxhash64("l_orderkey", "l_partkey"), F.lit(4)) == k), f"part_{k}")
    found = prof.profile(lines).withColumn("kind", F.lit("table"))
    found = found.unionByName(stored.profile().withColumn("kind", F.lit("uploads")))
    long = lines.select(*[F.col(c).cast("double").alias(c) for c in _SKETCHED]).unpivot([], list(_SKETCHED), "variable", "value")
    exact = long.where("value IS NOT NULL").groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    below = F.sum(F.when(F.col("value") < F.col("median"), F.col("n")).otherwise(0))
    up_to = F.sum(F.when(F.col("value") <= F.col("median"), F.col("n")).otherwise(0))
    numbers, n_distinct = F.sum("n"), F.count(F.lit(1))
    return exact.join(found.select("kind", "variable", "approx_distinct", "median"), "variable").groupBy("kind", "variable").agg(
        numbers.alias("numbers"),
        n_distinct.alias("n_distinct"),
        (F.abs(F.first("approx_distinct") - n_distinct) <= 0.06 * n_distinct).alias("distinct_near"),
        ((below <= 0.52 * numbers) & (up_to >= 0.48 * numbers)).alias("median_near"),
    )


@register(
    "profile_top_values",
    "SELECT variable, value, n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS variable, CAST({f} AS VARCHAR) AS value, COUNT(*) AS n FROM lineitem GROUP BY 2"
        for f in ("l_linenumber", "l_returnflag", "l_linestatus", "l_suppkey", "l_partkey")
    )
    + ") QUALIFY ROW_NUMBER() OVER (PARTITION BY variable ORDER BY n DESC, value) <= 10",
)
def profile_top_values(spark, sf_dir):
    chosen = ["l_linenumber", "l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"]
    return prof.top_values(table(spark, sf_dir, "lineitem").select(*chosen))


@register(
    "value_labels",
    """
    SELECT label, label_from_table, COUNT(*) AS n FROM (
        SELECT CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS label,
               CASE toxic WHEN 1 THEN 'toxic' ELSE NULL END AS label_from_table FROM labels)
    GROUP BY ALL
    """,
)
def value_labels(spark, sf_dir):
    """Labels from a column's metadata, which outlive a parquet round trip, and from a table."""
    described = prof.describe_columns(
        table(spark, sf_dir, "labels"),
        labels={"quality": "Quality of the text"},
        value_labels={"quality": {0: "poor", 1: "good"}},
    )
    path = sinks.export(described, shared_dir(spark, "described"), "parquet")
    known = spark.createDataFrame([(1, "toxic")], "value int, label string")
    decoded = prof.decode_values(spark.read.parquet(path), "quality", "label")
    decoded = prof.decode_values(decoded, "toxic", "label_from_table", known)
    return decoded.groupBy("label", "label_from_table").agg(agg.n().alias("n"))


