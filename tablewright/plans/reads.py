"""Read, ingestion and schema-reconciliation queries."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import aggregate as agg
from tablewright.operators import batch, copies, schema, sinks
from tablewright.operators.aggregates import summarise
from tablewright.plans import sql
from tablewright.plans.registry import register, table
from tablewright.session import shared_dir
from tablewright.sources import delimited, files, ingest, reader, splits
from tablewright.sources.uploads import UploadTable
from tablewright.sources.versions import Dataset
from tablewright.types import field
from tablewright.types import schema as declare

ORDERS = declare(
    {
        "o_orderkey": "integer",
        "o_custkey": "integer",
        "o_orderstatus": "string",
        "o_totalprice": "float",
        "o_orderdate": "dateTime",
        "o_orderpriority": "string",
    }
)
LINEITEM = declare(
    {
        "l_orderkey": "integer",
        "l_quantity": "float",
        "l_extendedprice": "float",
        "l_discount": "float",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "date",
    }
)


@register(
    "pricing_summary",
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS sum_qty,
           ROUND(AVG(l_extendedprice), 4) AS avg_price, ROUND(STDDEV_SAMP(l_discount), 8) AS sd_discount,
           COUNT(DISTINCT l_orderkey) AS n_orders, QUANTILE_DISC(l_extendedprice, 0.5) AS median_price
    FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01'
    GROUP BY l_returnflag, l_linestatus
    """,
)
def pricing_summary(spark, sf_dir):
    rows = reader.read_table(spark, f"{sf_dir}/lineitem.parquet", LINEITEM.names, declared=LINEITEM)
    rows = rows.where(F.col("l_shipdate") < F.lit("2001-01-01").cast("date"))
    return summarise(
        rows,
        ["l_returnflag", "l_linestatus"],
        {
            "n": agg.n(),
            "sum_qty": F.round(F.sum("l_quantity"), 2),
            "avg_price": F.round(F.avg("l_extendedprice"), 4),
            "sd_discount": F.round(agg.sd("l_discount"), 8),
            "median_price": agg.median("l_extendedprice", 1_000_000),
        },
        distinct={"n_orders": "l_orderkey"},
        sketches=True,
    ).orderBy("l_returnflag", "l_linestatus")


# --- table reads


@register("read_table", "SELECT * FROM orders")
def read_table(spark, sf_dir):
    return reader.read_table(spark, f"{sf_dir}/orders.parquet", declared=ORDERS)


@register("select_variables", "SELECT l_shipdate, l_orderkey FROM lineitem")
def select_variables(spark, sf_dir):
    return reader.read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_ShipDate", "nope", "L_ORDERKEY"])


@register(
    "max_results",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def max_results(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return reader.read_frame(ordered, ["o_orderkey", "o_totalprice"], max_results=100)


_BUCKET_SQL = "(('0x' || SUBSTR(MD5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % {n})"


def _order_streams(spark, sf_dir) -> DataFrame:
    return reader.read_streams(
        table(spark, sf_dir, "orders"), 8, ["o_orderkey"], ["O_ORDERKEY", "o_totalprice"]
    )


@register("read_streams", f"SELECT o_orderkey, o_totalprice, {_BUCKET_SQL.format(n=8)} AS stream_id FROM orders")
def read_streams(spark, sf_dir):
    return _order_streams(spark, sf_dir)


@register(
    "read_stream_counts",
    f"SELECT {_BUCKET_SQL.format(n=8)} AS stream_id, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total "
    "FROM orders GROUP BY 1",
)
def read_stream_counts(spark, sf_dir):
    return _order_streams(spark, sf_dir).groupBy("stream_id").agg(
        agg.n().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@register("read_splits", "SELECT o_orderkey, o_totalprice FROM orders")
def read_splits(spark, sf_dir):
    """Several files of several row groups, read split by split."""
    path = shared_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders").repartition(6)
    orders.write.option("parquet.block.size", 1 << 16).option("parquet.page.row.count.limit", 500).parquet(path)
    found = splits.plan_splits(spark, path, 5)
    return reduce(DataFrame.unionAll, [found.read(k, ["O_ORDERKEY", "o_totalprice"]) for k in range(found.count)])


@register("read_split_plan", "SELECT COUNT(*) AS n, COUNT(*) AS planned, 0 AS twice FROM lineitem")
def read_split_plan(spark, sf_dir):
    """No row group is in two splits, and the splits have all rows."""
    found = splits.plan_splits(spark, f"{sf_dir}/lineitem.parquet", 3)
    read = reduce(DataFrame.unionAll, [found.read(k, ["l_orderkey"]) for k in range(found.count)])
    planned = found.plan().groupBy("file", "row_group").agg(agg.n().alias("times"), F.sum("rows").alias("rows"))
    planned = planned.agg(F.sum("rows").alias("planned"), F.count_if(F.col("times") > 1).cast("int").alias("twice"))
    one = planned.first()
    return read.agg(agg.n().alias("n"), *[F.lit(one[c]).alias(c) for c in ("planned", "twice")])


@register(
    "read_sample",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE {_BUCKET_SQL.format(n=10000)} < 1000",
)
def read_sample(spark, sf_dir):
    sample = reader.sample_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 10.0)
    return sample.select("o_orderkey", "o_custkey")


@register(
    "read_geography",
    "SELECT c_custkey, 'POINT(' || c_nationkey || ' ' || c_custkey || ')' AS place FROM customer",
)
def read_geography(spark, sf_dir):
    point = F.concat(F.lit("POINT("), "c_nationkey", F.lit(" "), "c_custkey", F.lit(")"))
    places = table(spark, sf_dir, "customer").select(
        "c_custkey", point.alias("place", metadata=field("place", "geography").metadata)
    )
    df, column = reader.read_geography(places, ["c_custkey", "PLACE"])
    return df.where(F.col(column).isNotNull())


@register("read_empty", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity < 0")
def read_empty(spark, sf_dir):
    chosen = reader.read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipdate"])
    return chosen.where(F.col("l_quantity") < 0)


# --- schema reconciliation


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("string").alias(n) for n in df.columns])


@register(
    "coerce_types",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           TRY_CAST(o_orderpriority AS BIGINT) AS o_orderpriority
    FROM orders
    """,
)
def coerce_types(spark, sf_dir):
    stored = _as_text(table(spark, sf_dir, "orders"))
    strict = schema.coerce_types(stored, ORDERS)
    # the priority is no number, which only a lenient cast lets pass
    return schema.coerce_types(strict, declare({"o_orderpriority": "integer"}), lenient=True)


@register(
    "coerce_time",
    """
    SELECT event_id, CAST(HOUR(ts) AS INTEGER) AS h, CAST(MINUTE(ts) AS INTEGER) AS m,
           CAST(SECOND(ts) AS INTEGER) AS s, CAST(ts AS TIME) >= TIME '12:00:00' AS afternoon
    FROM events
    """,
)
def coerce_time(spark, sf_dir):
    stored = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm:ss.SSSSSS").alias("at"))
    typed = schema.coerce_types(stored, declare({"at": "time"}))
    return typed.select(
        "event_id",
        F.hour("at").alias("h"),
        F.minute("at").alias("m"),
        F.second("at").alias("s"),
        (F.col("at") >= F.lit("12:00:00").cast("time(6)")).alias("afternoon"),
    )


_WIDE = declare({"c_custkey": "integer", "c_name": "string", "joined": "date", "score": "float", "active": "boolean"})


@register(
    "fill_missing_columns",
    """
    SELECT c_custkey, c_name, CAST(NULL AS DATE) AS joined, CAST(NULL AS DOUBLE) AS score,
           CAST(NULL AS BOOLEAN) AS active
    FROM customer
    """,
)
def fill_missing_columns(spark, sf_dir):
    return schema.fill_missing_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _WIDE)


@register("reorder_columns", "SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def reorder_columns(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return schema.reorder_columns(df.select(*reversed(LINEITEM.names)), LINEITEM)


def _order_uploads(df: DataFrame) -> dict[str, DataFrame]:
    """All orders in three pieces: whole, without a column, and reordered with a text key."""
    status = F.col("o_orderstatus")
    others = df.where(~status.isin("F", "O") | status.isNull())
    return {
        "filled": df.where(status == "F"),
        "open": df.where(status == "O").drop("o_orderpriority"),
        "partial": others.select(
            F.col("o_custkey").cast("string").alias("O_CUSTKEY"), *[c for c in df.columns if c != "o_custkey"]
        ),
    }


_MERGED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority
    FROM orders
"""


@register("merge_uploads", _MERGED_SQL)
def merge_uploads(spark, sf_dir):
    return schema.merge_uploads(list(_order_uploads(table(spark, sf_dir, "orders")).values()), ORDERS)


# --- uploads


def _upload_table(spark, sf_dir, **options) -> UploadTable:
    uploads = UploadTable(spark, shared_dir(spark, "uploads"), **options)
    for name, df in _order_uploads(table(spark, sf_dir, "orders")).items():
        uploads.upload(df, name)
    return uploads


@register("merge_append", _MERGED_SQL)
def merge_append(spark, sf_dir):
    return _upload_table(spark, sf_dir, declared=ORDERS).read()


@register("merge_replace", "SELECT * FROM orders WHERE o_orderstatus = 'P'")
def merge_replace(spark, sf_dir):
    return _upload_table(spark, sf_dir, declared=ORDERS, merge_strategy="replace").read()


@register(
    "read_upload",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'O'",
)
def read_upload(spark, sf_dir):
    return _upload_table(spark, sf_dir).read_upload("open")


@register(
    "upload_replace",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'partial' END AS _upload,
           COUNT(*) AS n, ROUND(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE o_totalprice END), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def upload_replace(spark, sf_dir):
    uploads = _upload_table(spark, sf_dir, declared=ORDERS)
    again = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(1.0))
    uploads.upload(again, "open", replace_on_conflict=True)
    return uploads.read(tagged=True).groupBy("_upload").agg(
        agg.n().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@register(
    "upload_if_not_exists",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'partial' END AS _upload,
           COUNT(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT 'open_1', COUNT(*) FROM orders
    """,
)
def upload_if_not_exists(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    uploads = _upload_table(spark, sf_dir, declared=ORDERS)
    uploads.upload(orders, "open", if_not_exists=True)
    uploads.upload(orders, "open", rename_on_conflict=True)
    return uploads.read(tagged=True).groupBy("_upload").agg(agg.n().alias("n"))


@register("upload_staged", "SELECT * FROM orders")
def upload_staged(spark, sf_dir):
    """A failing upload leaves nothing; the good one is there."""
    orders = table(spark, sf_dir, "orders")
    uploads = UploadTable(spark, shared_dir(spark, "uploads"), ORDERS)
    broken = orders.withColumn("o_custkey", F.raise_error(F.col("o_orderstatus")).cast("bigint"))
    uploads.upload(broken, "broken", raise_on_fail=False)
    uploads.upload(orders, "good")
    return uploads.read()


# --- batch functions


@register(
    "batch_preprocess",
    "SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem WHERE l_returnflag = 'R'",
)
def batch_preprocess(spark, sf_dir):
    def revenue(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = rows.filter(pc.equal(rows["l_returnflag"], "R"))
        if rows.num_rows == 0:
            return None
        amount = pc.multiply(rows["l_extendedprice"], pc.subtract(1.0, rows["l_discount"]))
        return pa.RecordBatch.from_arrays([rows["l_orderkey"], amount], names=["l_orderkey", "revenue"])

    return reader.read_table(
        spark,
        f"{sf_dir}/lineitem.parquet",
        ["l_orderkey", "l_extendedprice", "l_discount", "l_returnflag"],
        batch_preprocessor=revenue,
        batch_schema="l_orderkey bigint, revenue double",
    )


@register("batch_preprocess_empty", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity < 0")
def batch_preprocess_empty(spark, sf_dir):
    def none_negative(rows):
        kept = rows.filter(pc.less(rows["l_quantity"], 0))
        return kept if kept.num_rows else None

    return reader.read_table(
        spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"], batch_preprocessor=none_negative
    )


@register(
    "file_chunks",
    """
    WITH w AS (SELECT source, lang, STRING_AGG(text || CHR(10), '' ORDER BY doc_id) AS content FROM documents GROUP BY source, lang)
    SELECT source, lang, chunk_no, chunk_no * 4096 AS start_byte, LEAST(chunk_no * 4096 + 4096, STRLEN(content)) - 1 AS end_byte,
           MD5(UNHEX(SUBSTR(HEX(ENCODE(content)), chunk_no * 8192 + 1, 8192))) AS digest
    FROM (SELECT *, UNNEST(RANGE(0, (STRLEN(content) + 4095) // 4096)) AS chunk_no FROM w)
    """,
)
def file_chunks(spark, sf_dir):
    from tablewright.plans.indexes import _place, _written

    path = _written(spark, sf_dir)
    chunks = files.stream_chunks(files.list_files(spark, path, "*.txt"), path, 4096)
    return chunks.select(*_place("name"), "chunk_no", "start_byte", "end_byte", F.md5("chunk").alias("digest"))


# --- delimited text and other sources


@register(
    "ingest_csv",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
    """,
)
def ingest_csv(spark, sf_dir):
    """Semicolons, two null markers, short records kept, long ones dropped."""
    orders = table(spark, sf_dir, "orders")
    marked = (
        F.when(F.col("o_orderpriority") == "2-HIGH", "-")
        .when(F.col("o_orderstatus") == "P", "NA")
        .otherwise(F.col("o_orderpriority"))
    )
    whole = F.concat_ws(";", "o_orderkey", "o_custkey", "o_totalprice", marked)
    line = (
        F.when(F.col("o_orderstatus") == "O", F.concat_ws(";", "o_orderkey", "o_custkey", "o_totalprice"))
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.concat(whole, F.lit(";more")))
        .otherwise(whole)
    )
    path = shared_dir(spark, "csv")
    orders.select(line).write.text(path)
    columns = {"o_orderkey": "integer", "o_custkey": "integer", "o_totalprice": "float", "o_orderpriority": "string"}
    return delimited.read_delimited(
        spark,
        path,
        declare(columns),
        delimiter=";",
        has_header_row=False,
        null_markers=["NA", "-"],
        allow_jagged_rows=True,
        skip_bad_records=True,
    )


@register(
    "ingest_csv_quoted",
    "SELECT conv_id, turn, role, text FROM conversations",
)
def ingest_csv_quoted(spark, sf_dir):
    """Quoted text with newlines, quotes and delimiters, with a header."""
    path = sinks.export(table(spark, sf_dir, "conversations"), shared_dir(spark, "csv"))
    columns = {"conv_id": "integer", "turn": "integer", "role": "string", "text": "string"}
    return delimited.read_delimited(spark, path, declare(columns), has_quoted_newlines=True)


@register("ingest_csv_headers", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def ingest_csv_headers(spark, sf_dir):
    """Three folders' files with columns in different orders, bound by their headers."""
    path = shared_dir(spark, "csv")
    names = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    for k in range(3):
        part = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 == k).select(*names[k:], *names[:k])
        part.write.mode("append").csv(path, header=True)
    columns = {"o_orderkey": "integer", "o_orderstatus": "string", "o_totalprice": "float"}
    return delimited.read_delimited(spark, path, declare(columns))


@register(
    "upload_file",
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def upload_file(spark, sf_dir):
    """Name, type, delimiter and the columns' types follow from the files."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    path = sinks.export(orders, f"{shared_dir(spark, 'csv')}/orders.csv")
    uploads = UploadTable(spark, shared_dir(spark, "uploads"))
    name = ingest.upload_file(uploads, path)
    return uploads.read_upload(name)


@register("ingest_parquet", "SELECT * FROM customer")
def ingest_parquet(spark, sf_dir):
    uploads = UploadTable(spark, shared_dir(spark, "uploads"))
    uploads.upload(delimited.read_parquet(spark, f"{sf_dir}/customer.parquet"), "customer.parquet")
    return uploads.read()


@register(
    "ingest_frame",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS label,
           COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def ingest_frame(spark, sf_dir):
    """An in-memory frame joined to a table."""
    frame = pa.table({"o_orderstatus": ["F", "O"], "label": ["filled", "open"]})
    labels = delimited.from_frame(spark, frame)
    return (
        table(spark, sf_dir, "orders")
        .join(labels, "o_orderstatus", "left")
        .groupBy("label")
        .agg(agg.n().alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


# --- versions


def _released(spark, sf_dir) -> Dataset:
    """Orders released in three versions, one status more in each."""
    dataset = Dataset(spark, shared_dir(spark, "dataset"))
    for tag, name in zip(("1.0", "v1.1", "v2_0"), ("filled", "open", "partial")):
        dataset.create_next_version()
        orders = _order_uploads(table(spark, sf_dir, "orders"))
        dataset.stage("orders").upload(schema.conform(orders[name], ORDERS), name)
        dataset.release(tag, ["orders"])
    return dataset


@register(
    "read_version",
    """
    SELECT version, o_orderstatus, COUNT(*) AS n, COUNT(o_orderpriority) AS with_priority FROM (
        SELECT v.version, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority
        FROM orders JOIN (VALUES ('v1.0', 'F'), ('v1.1', 'F'), ('v1.1', 'O'), ('current', 'F'), ('current', 'O'),
            ('current', 'P')) AS v(version, status) ON o_orderstatus = status)
    GROUP BY ALL
    """,
)
def read_version(spark, sf_dir):
    dataset = _released(spark, sf_dir)
    parts = [dataset.read("orders", v).withColumn("version", F.lit(v)) for v in ("v1.0", "v1.1", "current")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("version", "o_orderstatus").agg(
        agg.n().alias("n"), F.count("o_orderpriority").alias("with_priority")
    )


@register(
    "mapped_version",
    f"""
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus <> 'P' AND {_BUCKET_SQL.format(n=10000)} < 2000
    """,
)
def mapped_version(spark, sf_dir):
    """A query on a table mapped to another name, at an older version, in its sample."""
    source = sql.datasource(
        _released(spark, sf_dir),
        {"orders": "purchases"},
        names=["orders"],
        version="1.1",
        sample_keys={"orders": ["o_orderkey"]},
        sample_percent=20,
    )
    return sql.query(spark, "SELECT o_orderkey, o_orderstatus FROM purchases", source)


@register("release_version", _MERGED_SQL)
def release_version(spark, sf_dir):
    """The last release is taken back, so its rows are read from the next version again."""
    dataset = _released(spark, sf_dir)
    dataset.unrelease()
    return dataset.read("orders", "next")


@register("release_replace_undone", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def release_replace_undone(spark, sf_dir):
    """A release in place of all rows, taken back: the next version has its rows alone."""
    dataset = _released(spark, sf_dir)
    dataset.unrelease()
    dataset.release("3.0", ["orders"], replace=True)
    dataset.unrelease()
    return dataset.read("orders", "next").select("o_orderkey", "o_orderstatus")


# --- raw files


@register(
    "scan_files",
    "SELECT source, lang, CAST(SUM(STRLEN(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source, lang",
)
def scan_files(spark, sf_dir):
    path = shared_dir(spark, "files")
    table(spark, sf_dir, "documents").select("text", "source", "lang").write.partitionBy("source", "lang").text(path)
    found = files.list_files(spark, path, "*.{txt,csv}")
    return (
        found.select(F.split("name", "/").alias("p"), "size")
        .groupBy(
            F.regexp_replace(F.col("p")[0], "^source=", "").alias("source"),
            F.regexp_replace(F.col("p")[1], "^lang=", "").alias("lang"),
        )
        .agg(F.sum("size").alias("bytes"))
    )


@register(
    "copy_files",
    "SELECT source, lang, CAST(SUM(STRLEN(text) + 1) AS BIGINT) AS bytes, 'copy' AS first_time, 'skip' AS second_time "
    "FROM documents GROUP BY source, lang",
)
def copy_files(spark, sf_dir):
    """Files copied once and found there the second time; sizes are those at the target."""
    origin, target = shared_dir(spark, "files"), shared_dir(spark, "copied")
    table(spark, sf_dir, "documents").select("text", "source", "lang").write.partitionBy("source", "lang").text(origin)
    manifest = copies.manifest_of(spark, origin, "*.txt")
    first = copies.copy_files(manifest, origin, target).select("path", F.col("action").alias("first_time"))
    second = copies.copy_files(manifest, origin, target).select("path", F.col("action").alias("second_time"))
    there = files.list_files(spark, target).select(F.col("name").alias("path"), "size")
    parts = F.split("path", "/")
    return (
        there.join(first, "path")
        .join(second, "path")
        .groupBy(
            F.regexp_replace(parts[0], "^source=", "").alias("source"),
            F.regexp_replace(parts[1], "^lang=", "").alias("lang"),
        )
        .agg(F.sum("size").alias("bytes"), F.max("first_time").alias("first_time"), F.min("second_time").alias("second_time"))
    )


@register(
    "file_specs",
    "SELECT source || '/' || doc_id || '.txt' AS name, STRLEN(text) AS size, MD5(text) AS digest FROM documents",
)
def file_specs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("name", F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")))
    specs = files.specs_from_rows(docs, "name", "text")
    return specs.select("name", "size", F.md5("content").alias("digest"))
