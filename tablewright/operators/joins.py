"""Joins. Equi joins leave the strategy to the planner: it broadcasts a side whose size
is known to be small, and adaptive execution splits hot keys of the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.windows import measured, running

KINDS = ("inner", "left", "right", "full", "left_semi", "left_anti")


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi join; an unconditional (cross) join is not offered."""
    if how not in KINDS:
        raise ValueError(f"unknown join kind: {how}")
    if on is None or (isinstance(on, (list, tuple)) and not on):
        raise ValueError("a join needs at least one key")
    return left.join(right, on, how)


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    low: str,
    high: str,
    on: Sequence[str] = (),
    levels: int = 4,
) -> DataFrame:
    """Join points to the intervals with ``low <= point < high`` (and equal ``on`` keys).

    Ends and points are numbers, dates or moments; a null end is open. An interval belongs
    to the smallest of ``levels`` cell widths that is at least its length; the widths are
    quantiles of the lengths. It meets two cells there or so, and a point has one cell for
    each level, so it is never multiplied by more than ``levels``. No width is more than a
    sixteenth of the range of the points, inside which longer intervals are cut: open ends
    and ends far away cost nothing. Null and NaN points match nothing.
    """
    at, _ = measured(points, point)
    begin, _ = measured(intervals, low)
    end, _ = measured(intervals, high)
    number = at.cast("double")
    finite = F.when(F.abs(number) < F.lit(float("inf")), number)
    there = points.agg(F.min(finite), F.max(finite)).first()
    least, most = (float(there[0]), float(there[1])) if there[0] is not None else (0.0, 0.0)

    def inside(x: Column, otherwise: float) -> Column:
        return F.least(F.greatest(F.coalesce(x.cast("double"), F.lit(otherwise)), F.lit(least)), F.lit(most))

    begins_by = F.coalesce(begin.cast("double") <= F.lit(most), F.lit(True))
    ends_after = F.coalesce(end.cast("double") > F.lit(least), F.lit(True))
    some = begins_by & ends_after & F.coalesce(end > begin, F.lit(True))
    sized = intervals.withColumns({"_first": inside(begin, least), "_last": inside(end, most)}).where(some)
    length = F.col("_last") - F.col("_first")
    shares = [1 - 0.5**k for k in range(1, levels)] + [1.0]
    found = sized.agg(F.percentile_approx(length, F.array(*[F.lit(q) for q in shares]))).first()[0] or [0.0]
    largest = max((most - least) / 16, 1e-9)
    widths = sorted({min(max(float(w), largest / 1e9), largest) for w in found})
    level = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        level = F.when(length <= widths[k], F.lit(k)).otherwise(level)
    wide = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_level") + 1)

    def cell(x: Column) -> Column:
        return F.floor((x - F.lit(least)) / wide)

    cells = sized.withColumn("_level", level).withColumn("_cell", F.explode(F.sequence(cell(F.col("_first")), cell(F.col("_last")))))
    spread = points.withColumn("_point", inside(number, least)).where(number.isNotNull() & ~F.isnan(number))
    spread = spread.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in range(len(widths))])))
    spread = spread.withColumn("_cell", cell(F.col("_point")))
    hit = F.coalesce(F.col(point) >= F.col(low), F.lit(True)) & F.coalesce(F.col(point) < F.col(high), F.lit(True))
    return spread.join(cells, [*on, "_level", "_cell"]).where(hit).drop("_level", "_cell", "_point", "_first", "_last")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    left_id: str,
    groups_fit: bool = False,
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Both sides are stacked and the last right row is carried forward, so nothing is
    paired. Of right rows at one time the largest in column order counts; they collapse
    before the shuffle. ``left_id`` is unique in ``left``. Unmatched rows get nulls; null
    keys and null times match nothing on either side.
    """
    known = F.col(key).isNotNull()
    dated = right.where(known & F.col(right_time).isNotNull())
    payload = F.struct(*[c for c in right.columns if c != key])
    latest = dated.groupBy(key, F.col(right_time).alias("_time")).agg(F.max(payload).alias("_right"))
    rows = left.select(
        key,
        F.col(left_time).alias("_time"),
        F.col(left_id).alias("_id"),
        F.struct(*[c for c in left.columns if c != key]).alias("_left"),
    )
    can = known & F.col("_time").isNotNull()
    # a right row has no id and sorts before the left rows of its time
    stacked = latest.unionByName(rows.where(can), allowMissingColumns=True)
    carried = running(stacked, key, ["_time", "_id"], {"_match": ("last", "_right")}, groups_fit)
    matched = carried.where(F.col("_left").isNotNull())
    alone = rows.where(~can).withColumn("_match", F.lit(None).cast(matched.schema["_match"].dataType))
    columns = [key, "_left", "_match"]
    return matched.select(*columns).unionByName(alone.select(*columns)).select(key, "_left.*", "_match.*")
