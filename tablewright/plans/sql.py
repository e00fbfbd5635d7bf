"""SQL in a scope of named tables, parameters, and table-to-table transforms."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.sinks import output_table
from tablewright.sources.versions import Dataset

Tables = Mapping[str, DataFrame]


_OWN = threading.local()


def _own_session(spark: SparkSession) -> SparkSession:
    """A session of this thread that shares the catalog with ``spark`` and has its settings,
    but no temporary views."""
    if getattr(_OWN, "parent", None) is not spark:
        _OWN.parent, _OWN.session = spark, spark.newSession()
    own = _OWN.session
    theirs, ours = dict(spark.conf.getAll), dict(own.conf.getAll)
    for key, value in theirs.items():
        if ours.get(key) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key in ours.keys() - theirs.keys():
        if own.conf.isModifiable(key):
            own.conf.unset(key)
    return own


def _scoped(spark: SparkSession, sql: str, tables: Tables, args: Mapping | None) -> DataFrame:
    """``sql`` with bare names bound to ``tables``, then to the caller's views, then to the
    catalog's tables. The names are those of a session of their own, which gets the tables
    and hands the result back by global views under names that nobody else has. No view of
    the caller's is touched, so queries with equal names may be analysed side by side."""
    own, place = _own_session(spark), spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    taken = {n.lower() for n in tables}
    # the caller's views: in the database of global views no tables are listed besides
    views = [r["viewName"] for r in spark.sql(f"SHOW VIEWS IN {place}").collect() if not r["namespace"]]
    seen = {v: spark.table(v) for v in views if v.lower() not in taken and v.lower() in sql.lower()}
    made, names = [], []

    def passed(df: DataFrame, to: SparkSession) -> DataFrame:
        made.append(f"_{uuid.uuid4().hex}")
        df.createGlobalTempView(made[-1])
        return to.table(f"{place}.{made[-1]}")

    try:
        for name, df in {**seen, **tables}.items():
            passed(df, own).createOrReplaceTempView(name)
            names.append(name)
        return passed(own.sql(sql, args=args) if args else own.sql(sql), spark)
    finally:
        for name in names:
            own.catalog.dropTempView(name)
        for name in made:
            spark.catalog.dropGlobalTempView(name)


def query(
    spark: SparkSession,
    sql: str,
    tables: Tables | None = None,
    workflow: Tables | None = None,
    parameters: Mapping | None = None,
) -> DataFrame:
    """Run SQL with a default scope of a dataset's or a workflow's tables, not both.

    Names are bound and errors found here; rows are computed when used. A list parameter
    is used as ``array_contains(:name, x)``. With a scope, functions that are registered in
    the caller's session only are not known to the query.
    """
    if tables is not None and workflow is not None:
        raise ValueError("give a dataset or a workflow as the default scope, not both")
    args = {
        k: F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else value
        for k, value in (parameters or {}).items()
    }
    bound = tables or workflow
    if bound:
        return _scoped(spark, sql, bound, args)
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def fetch(df: DataFrame, n: int = -1) -> DataFrame:
    """The first n rows, all if n is negative; there is no cursor, so twice gives the same."""
    return df if n < 0 else df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def datasource(
    source: Dataset | Tables,
    mapped: Mapping[str, str] | list[tuple[str, str]] = (),
    names: Iterable[str] = (),
    version: str | None = None,
    sample_keys: Mapping[str, list[str]] | None = None,
    sample_percent: float = 1.0,
) -> dict[str, DataFrame]:
    """The tables a query gets, under the names they are mapped to; others keep theirs.

    A dataset is read at a version, and as a sample of the tables that ``sample_keys``
    names keys for. The tables of a workflow have neither.
    """
    if isinstance(source, Dataset):
        keys = sample_keys or {}
        tables = {
            n: source.read(n, version or "current", sample_keys=keys.get(n), sample_percent=sample_percent)
            for n in names
        }
    else:
        if sample_keys:
            raise ValueError("a workflow's tables have no samples: leave out sample_keys")
        if version is not None:
            raise ValueError("a workflow's tables have no versions: leave out version")
        tables = dict(source)
    renamed = dict(mapped)
    unknown = [n for n in renamed if n not in tables]
    if unknown:
        raise LookupError(f"no tables {', '.join(unknown)} to map")
    return {renamed.get(n, n): df for n, df in tables.items()}


def in_values(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column is among the values of a long parameter list (its first column)."""
    wanted = values.select(F.col(values.columns[0]).alias(column))
    return df.join(wanted, column, "left_semi")


def run_transform(
    source: DataFrame,
    sql: str,
    name: str,
    path: str,
    source_name: str = "_source_",
    parameters: Mapping | None = None,
    append: bool = False,
) -> DataFrame:
    """Source table, query, output table."""
    spark = source.sparkSession
    return output_table(query(spark, sql, {source_name: source}, parameters=parameters), name, path, append=append)
