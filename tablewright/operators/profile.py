"""Column statistics and value labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.windows import top_k
from tablewright.session import materialize
from tablewright.types import logical_type


def profile(df: DataFrame, distinct_error: float = 0.02, median_accuracy: int = 10_000) -> DataFrame:
    """One row per column, from one pass over the table.

    ``variable, type, rows, nulls, approx_distinct, min, max, mean, sd, median``; min and
    max as text; mean, sd and median of numbers only. Distinct counts and medians are
    mergeable sketches.
    """
    rows = F.count(F.lit(1))
    records = []
    for f in df.schema:
        x = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        orderable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))

        def value(expr, wanted=True, dtype="double"):
            return expr.cast(dtype) if wanted else F.lit(None).cast(dtype)

        records.append(
            F.struct(
                F.lit(f.name).alias("variable"),
                F.lit(logical_type(f)).alias("type"),
                rows.alias("rows"),
                (rows - F.count(x)).alias("nulls"),
                (F.approx_count_distinct(x, distinct_error) if orderable else value(x, False, "bigint")).alias(
                    "approx_distinct"
                ),
                (value(F.min(x), True, "string") if orderable else value(x, False, "string")).alias("min"),
                (value(F.max(x), True, "string") if orderable else value(x, False, "string")).alias("max"),
                (value(F.avg(x)) if number else value(x, False)).alias("mean"),
                (value(F.stddev_samp(x)) if number else value(x, False)).alias("sd"),
                (value(F.percentile_approx(x, 0.5, median_accuracy)) if number else value(x, False)).alias("median"),
            )
        )
    return df.agg(F.array(*records).alias("_r")).select(F.inline("_r"))


DISTINCT_LOG2 = 13  # registers of a distinct sketch: a standard error of 1.2 %
QUANTILE_K = 800  # of a quantile sketch: ranks off by some 0.4 % of the rows
SUMMARY = (
    "variable string, rows bigint, nulls bigint, min string, max string, numbers bigint, mean double, m2 double, "
    "distinct_sketch binary, quantile_sketch binary"
)


def _orderable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))


def _sketched(x: Column, dtype: T.DataType) -> Column:
    """A value as the distinct sketch takes it; equal values have one form."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return x.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (x + F.lit(0.0)).cast("string")  # one zero
    return x.cast("string")


def summarize(df: DataFrame, by: str) -> DataFrame:
    """What :func:`merge_summaries` needs of each value of the column ``by``: ``by`` and the
    columns of ``SUMMARY``, a row for each other column. One pass; the groups combine before
    the shuffle, so one may hold any share of the rows. A group's state is some 30 KB a
    column at most, whatever its rows.
    """
    rows, records = F.count(F.lit(1)), []
    for f in df.schema:
        if f.name == by:
            continue
        x = F.col(f"`{f.name}`")
        orderable, number = _orderable(f), isinstance(f.dataType, T.NumericType)
        y = x.cast("double")
        fields = {
            "variable": F.lit(f.name),
            "rows": rows,
            "nulls": rows - F.count(x),
            "min": F.min(x).cast("string") if orderable else None,
            "max": F.max(x).cast("string") if orderable else None,
            "numbers": F.count(x) if number else None,
            "mean": F.avg(y) if number else None,
            "m2": F.var_pop(y) * F.count(x) if number else None,
            "distinct_sketch": F.hll_sketch_agg(_sketched(x, f.dataType), DISTINCT_LOG2) if orderable else None,
            "quantile_sketch": F.kll_sketch_agg_double(y, QUANTILE_K) if number else None,
        }
        types = {c.name: c.dataType for c in T._parse_datatype_string(SUMMARY)}
        records.append(F.struct(*[(F.lit(None) if v is None else v).cast(types[n]).alias(n) for n, v in fields.items()]))
    if not records:
        return df.select(by).limit(0).join(df.sparkSession.createDataFrame([], SUMMARY), F.lit(True))
    return df.groupBy(by).agg(F.array(*records).alias("_r")).select(by, F.inline("_r"))


def merge_summaries(summaries: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of :func:`profile` for all the rows that the summaries stand for. A
    column of ``schema`` without a summary has no rows.

    Sums of squares are taken about the common mean, so nothing cancels. ``approx_distinct``
    and ``median`` come from merged sketches; the latter are of doubles.
    """
    spark = summaries.sparkSession
    variable = F.col("variable")
    orderable = [f for f in schema if _orderable(f)]

    def extreme(agg, column):
        # each column's values in its own type, since text has another order
        found = [agg(F.when(variable == f.name, F.col(column).cast(f.dataType))).cast("string") for f in orderable]
        return F.coalesce(*found, F.lit(None).cast("string"))

    same = Window.partitionBy("variable")  # one row for each summary
    weighted = F.sum(F.col("numbers") * F.col("mean")).over(same) / F.nullif(F.sum("numbers").over(same), F.lit(0))
    about = F.col("m2") + F.col("numbers") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2))
    numbers = F.sum("numbers")
    merged = (
        summaries.withColumn("_mean", weighted)
        .groupBy("variable")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_distinct"),
            extreme(F.min, "min").alias("min"),
            extreme(F.max, "max").alias("max"),
            F.first("_mean").alias("mean"),
            F.when(numbers > 1, F.sqrt(F.sum(about) / (numbers - 1))).alias("sd"),
            numbers.alias("_numbers"),
            F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
        )
    )
    nothing = F.col("rows").isNull()
    columns = [(f.name, logical_type(f), f in orderable) for f in schema]
    named = spark.createDataFrame(columns, "variable string, type string, _orderable boolean")
    return named.join(merged, "variable", "left").select(
        "variable",
        "type",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("nulls", F.lit(0)).alias("nulls"),
        F.when(F.col("_orderable"), F.when(nothing, F.lit(0)).otherwise(F.col("approx_distinct"))).cast("bigint").alias("approx_distinct"),
        "min",
        "max",
        "mean",
        "sd",
        F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_quantiles", F.lit(0.5))).alias("median"),
    )


def top_values(df: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent values of each column: ``variable, value, n``.

    Values are counted before they are ranked, and each task keeps k per column.
    """
    plain = [
        f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    ]
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in plain]).unpivot(
        [], plain, "variable", "value"
    )
    counts = long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, "variable", [F.desc("n"), F.asc("value")], k, ties=False)


def describe_columns(
    df: DataFrame,
    labels: Mapping[str, str] | None = None,
    descriptions: Mapping[str, str] | None = None,
    value_labels: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Set column labels, descriptions and value labels; they live in the field metadata."""
    labels, descriptions, value_labels = labels or {}, descriptions or {}, value_labels or {}
    for name in {*labels, *descriptions, *value_labels}:
        meta = dict(df.schema[name].metadata or {})
        if name in labels:
            meta["label"] = labels[name]
        if name in descriptions:
            meta["description"] = descriptions[name]
        if name in value_labels:
            meta["value_labels"] = {str(k): v for k, v in value_labels[name].items()}
        df = df.withMetadata(name, meta)
    return df


def decode_values(df: DataFrame, column: str, out: str, labels: DataFrame | None = None) -> DataFrame:
    """Replace codes by their labels.

    Uses the column's own value labels (a literal map), or a label table ``(value, label)``.
    """
    if labels is not None:
        # written, so that the planner knows its size and broadcasts it if small
        known = materialize(labels.select(F.col("value").alias("_value"), F.col("label").alias(out)), "labels")
        return df.join(known, df[column] == known["_value"], "left").drop("_value")
    pairs = (df.schema[column].metadata or {}).get("value_labels")
    if not pairs:
        raise LookupError(f"{column} has no value labels")
    mapping = F.create_map(*[F.lit(v) for kv in pairs.items() for v in kv])
    return df.withColumn(out, F.try_element_at(mapping, F.col(column).cast("string")))
