"""Window functions that hold when one group has a third of all rows.

``recycled`` aggregates (partial before the shuffle) and joins the group values back.
The ordered functions range-partition the rows by group *and* order, so that a large group
spans many blocks, work inside the blocks, and add what came before each block: the rows
move once. There is one path and one result schema for tables of any size. A caller who knows that each group
fits a task may say so with ``groups_fit=True`` and gets plain windows with the same result.

``order`` takes column names, ascending with nulls first, or :class:`By` for another
direction or place of nulls. ``keys`` may be empty: then all rows are one group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tablewright.functions import aggregate as agg
from tablewright.session import block_count, materialize, materialize_blocks

BLOCK_ROWS = 1_000_000  # rows of a cell where rows are numbered first
Keys = Sequence[str]


@dataclass(frozen=True)
class By:
    """A column to order by; nulls come first ascending and last descending by default."""

    column: str
    desc: bool = False
    nulls_last: bool | None = None

    def sort(self) -> Column:
        last = self.desc if self.nulls_last is None else self.nulls_last
        name = {(False, False): "asc_nulls_first", (False, True): "asc_nulls_last", (True, False): "desc_nulls_first", (True, True): "desc_nulls_last"}
        return getattr(F.col(self.column), name[self.desc, last])()


Order = str | By | Sequence[str | By]


def _names(x: str | Keys) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _orders(order: Order) -> list[By]:
    items = [order] if isinstance(order, (str, By)) else list(order)
    return [By(o) if isinstance(o, str) else o for o in items]


def _sorts(order: Order) -> list[Column]:
    return [o.sort() for o in _orders(order)]


def join_back(df: DataFrame, values: DataFrame, keys: str | Keys) -> DataFrame:
    """Left join on keys where null equals null; the key columns stay those of ``df``."""
    keys = _names(keys)
    if not keys:
        one = F.lit(0).alias("_one")  # a single row of group values
        return df.withColumn("_one", F.lit(0)).join(values.select("*", one), "_one", "left").drop("_one")
    right = values.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[c for c in values.columns if c not in keys],
    )
    on = reduce(Column.__and__, [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(right, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def recycled(df: DataFrame, keys: str | Keys, **values: Column) -> DataFrame:
    """Put each group's aggregate on every row of the group.

    The group values are written first, so the join knows their true size: small ones
    are broadcast and the rows never move; otherwise both sides shuffle and adaptive
    execution splits hot keys.
    """
    groups = df.groupBy(*_names(keys)).agg(*[v.alias(k) for k, v in values.items()])
    return join_back(df, materialize(groups, "groups"), keys)


def win_n(df, keys, name="n"):
    return recycled(df, keys, **{name: agg.n()})


def win_sd(df, keys, x, name="sd"):
    return recycled(df, keys, **{name: agg.sd(x)})


def win_var(df, keys, x, name="var"):
    return recycled(df, keys, **{name: agg.var(x)})


def win_absent(function: str):
    """``all``, ``any``, ``cor``, ``cov``, ``n_distinct`` and ``median`` have no window form."""
    raise NotImplementedError(f"{function}() is not available as a window function")


# --- blocks ------------------------------------------------------------------


@dataclass(frozen=True)
class Blocks:
    """Rows range-partitioned by group and order and written once, a file for each block.

    The files are read back as buckets, so windows and aggregates over (keys, block) run
    where a block is read: the rows move once. What the blocks hold of the groups that span
    several of them is carried by one row for each such group and block, at most two a block.
    """

    rows: DataFrame
    keys: list[str]
    order: list[By]

    PLACE = ("_block", "_bucket")

    @classmethod
    def of(cls, df: DataFrame, keys: str | Keys, order: Order) -> Blocks:
        keys, order = _names(keys), _orders(order)
        # the tie breaker lets a long run of equal rows span blocks too
        rows = df.withColumn("_tie", F.monotonically_increasing_id())
        sorts = [*[F.col(k) for k in keys], *_sorts(order), F.col("_tie")]
        return cls(materialize_blocks(rows, "blocks", sorts, *cls.PLACE), keys, order)

    def group(self) -> WindowSpec:
        """A group's rows in a block."""
        return Window.partitionBy(*self.keys, *self.PLACE)

    def ordered(self, ties: bool = False) -> WindowSpec:
        """The same in order; with ``ties``, rows equal in it are peers."""
        return self.group().orderBy(*_sorts(self.order), *([] if ties else ["_tie"]))

    def totals(self, rows: DataFrame, **values: Column) -> DataFrame:
        """Aggregates by group and block, for the first and the last group of each block:
        no other can span blocks."""
        found = rows.groupBy(*self.keys, *self.PLACE).agg(*[v.alias(k) for k, v in values.items()])
        if not self.keys:
            return found
        block = Window.partitionBy(*self.PLACE)
        place = F.row_number().over(block.orderBy(*self.keys))
        found = found.withColumns({"_place": place, "_groups": F.count(F.lit(1)).over(block)})
        return found.where("_place = 1 or _place = _groups")

    def along(self) -> WindowSpec:
        """The blocks of a group, in order."""
        return self.every().orderBy("_block")

    def every(self) -> WindowSpec:
        """The blocks of a group; without keys all are one group."""
        return Window.partitionBy(*(self.keys or [F.col("_block").isNull()]))

    def carried(self, totals: DataFrame, **values: Column) -> DataFrame:
        """(keys, block, values) of the groups that span blocks."""
        blocks = F.count(F.lit(1)).over(self.every()).alias("_blocks")
        named = [v.alias(k) for k, v in values.items()]
        return totals.select(*self.keys, "_block", *named, blocks).where("_blocks > 1").drop("_blocks")

    def with_carried(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        # two rows a block at most, so it is small next to what one task reads
        return join_back(rows, F.broadcast(carried), [*self.keys, "_block"])


BEFORE = (Window.unboundedPreceding, -1)
ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


# --- running measures --------------------------------------------------------

# kind -> (running expression, block total, combination with what came before)


def _sum(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


_COMBINE = {
    "count": _sum,
    "sum": _sum,
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
    "last": lambda before, here: F.coalesce(here, before),
}


def _over(kind: str, x: Column, w: WindowSpec) -> Column:
    if kind == "last":
        return F.last(x, ignorenulls=True).over(w)
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[kind](x).over(w)


def _total(kind: str, x: Column) -> Column:
    return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[kind](x)


def running(
    df: DataFrame,
    keys: str | Keys,
    order: Order,
    measures: Mapping[str, tuple[str, Column | str]],
    groups_fit: bool = False,
) -> DataFrame:
    """Measures from the first row of the group to the current one.

    ``measures``: new column -> (``count|sum|min|max|last``, expression); ``last`` is the
    last non-null value. Rows equal in ``order`` come in any order.
    """
    keys = _names(keys)
    exprs = {k: (kind, F.col(x) if isinstance(x, str) else x) for k, (kind, x) in measures.items()}
    frame = (Window.unboundedPreceding, Window.currentRow)
    if groups_fit:
        w = Window.partitionBy(*keys).orderBy(*_sorts(order)).rowsBetween(*frame)
        return df.withColumns({k: _over(kind, x, w) for k, (kind, x) in exprs.items()})

    blocks = Blocks.of(df.withColumns({f"_x_{k}": x for k, (_, x) in exprs.items()}), keys, order)
    w = blocks.ordered()
    local = blocks.rows.withColumns({k: _over(kind, F.col(f"_x_{k}"), w.rowsBetween(*frame)) for k, (kind, _) in exprs.items()})
    lasts = any(kind == "last" for kind, _ in exprs.values())
    totals = blocks.totals(
        local.withColumn("_nth", F.row_number().over(w)) if lasts else blocks.rows,
        **{
            f"_t_{k}": F.max_by(k, "_nth") if kind == "last" else _total(kind, F.col(f"_x_{k}"))
            for k, (kind, _) in exprs.items()
        },
    )
    earlier = blocks.along().rowsBetween(*BEFORE)
    carried = blocks.carried(
        totals,
        **{f"_b_{k}": _over("sum" if kind == "count" else kind, F.col(f"_t_{k}"), earlier) for k, (kind, _) in exprs.items()},
    )
    joined = blocks.with_carried(local, carried)
    combined = joined.withColumns({k: _COMBINE[kind](F.col(f"_b_{k}"), F.col(k)) for k, (kind, _) in exprs.items()})
    return combined.select(*df.columns, *[k for k in exprs if k not in df.columns])


def cumulative(df, keys, order, x: str, groups_fit: bool = False) -> DataFrame:
    """``cum_sum``, ``cum_min``, ``cum_max``, ``cum_mean`` of a column."""
    measures = {"cum_sum": ("sum", x), "cum_min": ("min", x), "cum_max": ("max", x), "_cum_n": ("count", x)}
    out = running(df, keys, order, measures, groups_fit)
    return out.withColumn("cum_mean", F.col("cum_sum") / F.nullif("_cum_n", F.lit(0))).drop("_cum_n")


RANKS = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")


def ranked(df: DataFrame, keys: str | Keys, order: Order, buckets: int = 4, groups_fit: bool = False) -> DataFrame:
    """``row_number, rank, dense_rank, percent_rank, cume_dist, ntile`` on every row, in
    this order; whole numbers are bigint. ``row_number`` and ``ntile`` break ties
    arbitrarily, as everywhere.
    """
    keys, by = _names(keys), _orders(order)
    if groups_fit:
        w = Window.partitionBy(*keys).orderBy(*_sorts(by))
        values = (F.row_number(), F.rank(), F.dense_rank(), F.percent_rank(), F.cume_dist(), F.ntile(buckets))
        kinds = ("bigint", "bigint", "bigint", "double", "double", "bigint")
        return df.withColumns({n: v.over(w).cast(t) for n, v, t in zip(RANKS, values, kinds, strict=True)})
    blocks = Blocks.of(df, keys, by)
    w, group = blocks.ordered(ties=True), blocks.group()
    upto = F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = {"_rn": F.row_number().over(w), "_rank": F.rank().over(w), "_dense": F.dense_rank().over(w)}
    local = blocks.rows.withColumns({**local, "_upto": upto, "_rows": F.count(F.lit(1)).over(group)})
    value = F.struct(*[o.column for o in by]) if by else F.struct(F.lit(0))
    found = blocks.totals(
        local,
        n=F.max("_rn").cast("bigint"),
        values=F.max("_dense"),
        first=F.min_by(value, "_rn"),
        last=F.max_by(value, "_rn"),
        n_first=F.count_if(F.col("_dense") == 1),
        n_last=F.max("_rn") - F.max("_rank") + 1,
    )
    # A run of equal rows may span blocks: ``joined`` says that it came from the block
    # before, ``goes_on`` that it goes on in the next one.
    along = blocks.along()
    before, upto_here = along.rowsBetween(*BEFORE), along.rowsBetween(Window.unboundedPreceding, 0)
    after = along.rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    same = lambda a, b: F.coalesce(a.eqNullSafe(b), F.lit(False))
    found = found.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(before), zero),
            "joined": same(F.col("first"), F.lag("last").over(along)),
            "goes_on": same(F.col("last"), F.lead("first").over(along)),
        }
    )
    begins = F.when((F.col("values") > 1) | ~F.col("joined"), F.col("before") + F.col("n") - F.col("n_last") + 1)
    ends = F.when((F.col("values") > 1) | ~F.col("goes_on"), F.col("before") + F.col("n_first"))
    found = found.withColumns({"begins": begins, "ends": ends})
    carried = blocks.carried(
        found,
        _b_rows=F.col("before"),
        _b_dense=F.coalesce(F.sum("values").over(before), zero) - F.sum(F.col("joined").cast("int")).over(upto_here),
        _b_first=F.when(F.col("joined"), F.last("begins", ignorenulls=True).over(before)),
        _b_last=F.when(F.col("goes_on"), F.first("ends", ignorenulls=True).over(after)),
        _b_values=F.col("values"),
        _b_all=F.sum("n").over(blocks.every()),
    )
    out = blocks.with_carried(local, carried)
    out = out.withColumn("_b_rows", F.coalesce("_b_rows", zero))
    rows = F.coalesce("_b_all", "_rows")
    first_run, last_run = F.col("_dense") == 1, F.col("_dense") == F.col("_b_values")
    low = F.coalesce(F.when(first_run, F.col("_b_first")), F.col("_b_rows") + F.col("_rank")) - 1
    high = F.coalesce(F.when(last_run, F.col("_b_last")), F.col("_b_rows") + F.col("_upto"))
    at = F.col("_b_rows") + F.col("_rn") - 1
    size = F.floor(rows / buckets).cast("bigint")
    larger = rows % buckets
    bucket = F.when(at < larger * (size + 1), F.floor(at / (size + 1)) + 1).otherwise(
        F.floor((at - larger * (size + 1)) / F.nullif(size, F.lit(0))) + larger + 1
    )
    values = {
        "row_number": at + 1,
        "rank": low + 1,
        "dense_rank": (F.coalesce("_b_dense", zero) + F.col("_dense")).cast("bigint"),
        "percent_rank": F.when(rows > 1, low / F.nullif(rows - 1, F.lit(0))).otherwise(F.lit(0.0)),
        "cume_dist": high / rows,
        "ntile": bucket.cast("bigint"),
    }
    kept = [c for c in df.columns if c not in RANKS]
    return out.select(*kept, *[v.alias(k) for k, v in values.items()])


def framed(
    df: DataFrame,
    keys: str | Keys,
    order: Order,
    before: int,
    after: int,
    values: Mapping[str, Column],
    block_rows: int = BLOCK_ROWS,
    groups_fit: bool = False,
) -> DataFrame:
    """Aggregates over ``before`` rows before to ``after`` rows after the current one.

    Rows whose frame lies in their block are done there. The few others, near the edges of
    blocks, are cut into cells of ``block_rows`` with what their frames reach into.
    """

    def over(w: WindowSpec, numbered: bool) -> dict[str, Column]:
        frame = (w.rangeBetween if numbered else w.rowsBetween)(-before, after)
        return {k: v.over(frame) for k, v in values.items()}

    return _blocked(df, _names(keys), order, before, after, over, block_rows, groups_fit)


def shifted(
    df: DataFrame,
    keys: str | Keys,
    order: Order,
    lags: Mapping[str, tuple[str, int]] | None = None,
    leads: Mapping[str, tuple[str, int]] | None = None,
    block_rows: int = BLOCK_ROWS,
    groups_fit: bool = False,
) -> DataFrame:
    """``lag`` and ``lead`` columns: new column -> (column, rows away)."""
    lags, leads = lags or {}, leads or {}
    away = {k: (x, -n) for k, (x, n) in lags.items()} | {k: (x, n) for k, (x, n) in leads.items()}

    def over(w: WindowSpec, numbered: bool) -> dict[str, Column]:
        if numbered:
            return {k: F.first(x).over(w.rangeBetween(n, n)) for k, (x, n) in away.items()}
        return {k: F.lead(x, n).over(w) for k, (x, n) in away.items()}

    back, ahead = max([-n for _, n in away.values()], default=0), max([n for _, n in away.values()], default=0)
    return _blocked(df, _names(keys), order, max(back, 0), max(ahead, 0), over, block_rows, groups_fit)


def _blocked(df, keys, order, before, after, over, block_rows, groups_fit) -> DataFrame:
    """``over(window, numbered)`` gives the values; ``numbered`` windows are ordered by the
    rows' numbers in their group, some of which may be missing."""
    if groups_fit:
        return df.withColumns(over(Window.partitionBy(*keys).orderBy(*_sorts(order)), False))
    blocks = Blocks.of(df, keys, order)
    along, one = blocks.along(), F.lit(1)
    count = F.count(one).over(along.rowsBetween(*BEFORE))
    carried = blocks.carried(
        blocks.totals(blocks.rows, n=F.count(one)),
        _b_n=F.coalesce(F.sum("n").over(along.rowsBetween(*BEFORE)), F.lit(0)),
        _earlier=count > 0,
        _later=F.lead("n").over(along).isNotNull(),
    )
    numbers = {"_rn": F.row_number().over(blocks.ordered()).cast("bigint"), "_rows": F.count(one).over(blocks.group())}

    def near(rows: int, ahead: int) -> Column:
        """Within so many rows after the block before, or before the next one."""
        reaches = (F.col("_earlier") & (F.col("_rn") <= rows)) | (F.col("_later") & (F.col("_rn") > F.col("_rows") - ahead))
        return F.coalesce(reaches, F.lit(False))

    made = list(over(blocks.ordered(), False))
    columns = [*[c for c in df.columns if c not in made], *made]
    inner = blocks.with_carried(blocks.rows.withColumns({**numbers, **{f"_v_{k}": v for k, v in over(blocks.ordered(), False).items()}}), carried)
    inner = inner.where(~near(before, after))
    inner = inner.select(*[F.col(f"_v_{c}").alias(c) if c in made else c for c in columns])
    reach = before + after
    edge = blocks.with_carried(blocks.rows.withColumns(numbers), carried).where(near(reach, reach))
    edge = edge.withColumns({"_wanted": near(before, after), "_rn": F.col("_b_n") + F.col("_rn")})
    size = max(block_rows, before, after, 1)
    home = F.floor((F.col("_rn") - 1) / size)
    first, last = F.floor((F.col("_rn") - 1 - after) / size), F.floor((F.col("_rn") - 1 + before) / size)
    copies = edge.withColumn("_home", home).withColumn("_at", F.explode(F.sequence(first, last)))
    cell = Window.partitionBy(*keys, "_at").orderBy("_rn")
    copies = copies.withColumns({f"_v_{k}": v for k, v in over(cell, True).items()})
    copies = copies.where(F.col("_wanted") & (F.col("_home") == F.col("_at")))
    return inner.unionByName(copies.select(*[F.col(f"_v_{c}").alias(c) if c in made else c for c in columns]))


def measured(df: DataFrame, column: str, *lengths) -> tuple[Column, list]:
    """A column as a number, and lengths in its unit: days for dates (whole numbers or
    timedelta), microseconds for moments (seconds or timedelta), itself for numbers."""
    kind = df.schema[column].dataType.typeName()
    span = lambda x, unit: x / dt.timedelta(**unit) if isinstance(x, dt.timedelta) else x
    if kind == "date":
        return F.unix_date(column).cast("bigint"), [int(span(x, {"days": 1})) for x in lengths]
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")), [round(span(x, {"seconds": 1}) * 1_000_000) for x in lengths]
    return F.col(column), list(lengths)


def range_framed(
    df: DataFrame,
    keys: str | Keys,
    order: str,
    before: float | dt.timedelta,
    after: float | dt.timedelta,
    values: Mapping[str, tuple[str, Column | str]],
    cell_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over rows whose ``order`` value is within ``before`` below and ``after`` above.

    ``order`` is a number, a date (distances in days) or a moment (in seconds); distances
    may be timedelta. ``values``: new column -> (``count|sum|min|max|mean``, expression).
    Rows of one value collapse first, the values are cut into cells as wide as the frame,
    and each value also goes to the neighbouring cells whose frames reach it. Groups that
    have a cell of more than ``cell_rows`` values are done over blocks instead.
    """
    keys = _names(keys)
    exprs = {k: (kind, F.col(x) if isinstance(x, str) else x) for k, (kind, x) in values.items()}
    parts, kinds = {}, {}
    for k, (kind, x) in exprs.items():
        if kind == "mean":
            parts |= {f"_s_{k}": F.sum(x), f"_n_{k}": F.count(x)}
            kinds |= {f"_s_{k}": "sum", f"_n_{k}": "sum"}
        else:
            parts[f"_{k}"] = _total(kind, x)
            kinds[f"_{k}"] = "sum" if kind == "count" else kind
    number, (before, after) = measured(df, order, before, after)
    peers = df.groupBy(*keys, order).agg(*[v.alias(k) for k, v in parts.items()]).withColumn("_v", number)
    peers = materialize(peers, "peers")
    v, width = F.col("_v"), max(before + after, 1e-9)
    home, first, last = F.floor(v / width), F.floor((v - after) / width), F.floor((v + before) / width)

    def in_cells(some: DataFrame) -> DataFrame:
        return some.withColumn("_home", home).withColumn("_at", F.explode_outer(F.sequence(first, last)))

    w = Window.partitionBy(*keys, "_at").orderBy("_v").rangeBetween(-before, after)
    # no more of these than there are rows / cell_rows
    sizes = in_cells(peers).groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high"))
    large = sizes.groupBy(*keys).agg(F.max("_n").alias("_most"), F.min("_low").alias("_low"), F.max("_high").alias("_high")).where(F.col("_most") > cell_rows)
    large = materialize(large.select(*keys, "_low", "_high", F.monotonically_increasing_id().alias("_group")), "large")
    several = not large.isEmpty()
    grouped = join_back(peers, large, keys) if several else peers
    cells = in_cells(grouped.where("_group is null or _v is null") if several else peers)
    framed_peers = cells.withColumns({k: _over(kind, F.col(k), w) for k, kind in kinds.items()})
    framed_peers = framed_peers.where(F.col("_home").eqNullSafe(F.col("_at"))).select(*keys, order, *kinds)
    if several:
        dense = grouped.where("_group is not null and _v is not null")
        # of three rows a value; the planner would take the join for the product of its sides
        blocks = block_count(peers.unionByName(peers).unionByName(peers))
        by_blocks = _framed_by_blocks(dense, order, number, before, after, kinds, blocks)
        framed_peers = framed_peers.unionByName(join_back(by_blocks, large.select(*keys, "_group"), "_group").select(*keys, order, *kinds))

    def value(k: str, kind: str) -> Column:
        return F.col(f"_s_{k}") / F.nullif(f"_n_{k}", F.lit(0)) if kind == "mean" else F.col(f"_{k}")

    found = framed_peers.select(*keys, order, *[value(k, kind).alias(k) for k, (kind, _) in exprs.items()])
    return join_back(df, found, [order, *keys])


STEP_ROWS = 256  # a moving frame costs Spark its length for each row, so frames are short


def _framed_by_blocks(peers: DataFrame, order: str, number: Column, before, after, kinds: Mapping[str, str], blocks: int) -> DataFrame:
    """(_group, order, aggregates) of frames in groups that one task need not hold.

    The ends of the frames are sorted into blocks together with the values, once, and blocks
    are cut into steps. A frame is the rest of its first step, the beginning of its last one,
    and what lies between: whole steps, aggregated for 1, 2, 4, ... of them, of which a frame
    takes two of each size at most. Ends move on together, so frames have at most twice as
    many pairs of first and last step as there are steps. One pass over the blocks finds both
    ends and the steps' totals; steps that hold a whole frame are read again for it.
    """
    low, here, high = 0, 1, 2
    ends = {low: F.col("_v") - F.lit(before), here: F.col("_v"), high: F.col("_v") + F.lit(after)}
    # rises with group and place, so that few comparisons of a sort need more
    bottom, top = F.col("_low").cast("double") - float(before), F.col("_high").cast("double") + float(after)
    part = lambda p: (p.cast("double") - bottom) / F.greatest(top - bottom, F.lit(1e-300))
    events = [
        peers.select("_group", order, F.lit(kind).alias("_kind"), p.alias("_p"), (F.col("_group") + F.least(F.greatest(part(p), F.lit(0.0)), F.lit(1.0))).alias("_rise"), *(kinds if kind == here else ()))
        for kind, p in ends.items()
    ]
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events)
    block, bucket = Blocks.PLACE
    sorts = [F.col(x) for x in ("_rise", "_group", "_p", "_kind", order)]
    rows = materialize_blocks(events, "blocks", sorts, block, bucket, blocks, nth="_nth", drop=("_p", "_rise"))
    most = rows.agg(F.max("_nth"), F.max(block)).first()
    step_bits = int((most[0] or 0) // STEP_ROWS).bit_length()  # of the number of a step in its block
    rows = rows.withColumn("_step", F.col(block).cast("bigint") * 2**step_bits + F.floor(F.col("_nth") / STEP_ROWS))
    is_here = F.col("_kind") == here
    step = Window.partitionBy("_step", "_group", bucket)  # the first is what Spark compares fastest
    upto = (Window.unboundedPreceding, 0)
    so_far, to_end = step.orderBy("_nth"), step.orderBy(F.desc("_nth"))

    passed = rows.withColumns({"_begins": F.row_number().over(so_far) == 1, **{f"_h{k}": _over(kind, F.col(k), so_far.rowsBetween(*upto)) for k, kind in kinds.items()}})
    passed = passed.withColumns({f"_l{k}": _over(kind, F.col(k), to_end.rowsBetween(*upto)) for k, kind in kinds.items()})
    of_end = [F.when(F.col("_kind") == low, F.col(f"_l{k}")).otherwise(F.col(f"_h{k}")).alias(f"_f{k}") for k in kinds]
    of_step = [F.when(F.col("_begins"), F.col(f"_l{k}")).alias(k) for k in kinds]
    passed = passed.where(~is_here | F.col("_begins")).select("_group", order, "_kind", "_step", "_begins", *of_end, *of_step)
    passed = materialize(passed, "ends")

    def at(kind: int, place: str, name: str) -> DataFrame:
        return passed.where(F.col("_kind") == kind).select("_group", order, F.col("_step").alias(place), *[F.col(f"_f{k}").alias(f"{name}{k}") for k in kinds])

    frames = materialize(at(low, "_first", "_l").join(at(high, "_last", "_h"), [order, "_group"]), "frames")

    # aligned runs of 2 ** level whole steps, and those that lie between two steps
    levels = F.sequence(F.lit(0), F.lit(step_bits + int(most[1] or 0).bit_length()))
    runs = passed.where("_begins").withColumn("_level", F.explode(levels)).withColumn("_run", F.expr("shiftright(_step, _level)"))
    runs = runs.groupBy("_run", "_level", "_group").agg(*[_total(kind, F.col(k)).alias(k) for k, kind in kinds.items()])
    spans = frames.where("_last > _first + 1").select("_group", "_first", "_last").distinct()
    begin = "shiftright(_first + shiftleft(1L, _level), _level)"  # of [_first + 1, _last), rounded inwards
    end = "shiftright(_last, _level)"
    pieces = spans.withColumn("_level", F.explode(levels)).withColumns({"_b": F.expr(begin), "_e": F.expr(end)}).where("_b < _e")
    odd = F.array_compact(F.array(F.when(F.col("_b") % 2 == 1, F.col("_b")), F.when(F.col("_e") % 2 == 1, F.col("_e") - 1)))
    pieces = pieces.withColumn("_run", F.explode(odd)).drop("_b", "_e")
    between = pieces.join(runs, ["_run", "_level", "_group"]).groupBy("_first", "_last", "_group")
    between = materialize(between.agg(*[_total(kind, F.col(k)).alias(f"_m{k}") for k, kind in kinds.items()]), "between")
    wide = frames.where("_first <> _last").join(between, ["_first", "_last", "_group"], "left")
    joined = [reduce(_COMBINE[kind], [F.col(f"_l{k}"), F.col(f"_m{k}"), F.col(f"_h{k}")]).alias(k) for k, kind in kinds.items()]

    # frames inside one step
    short = materialize(frames.where("_first = _last").select("_group", order, F.col("_first").alias("_step")), "short")
    inside = Window.partitionBy("_step", "_group").orderBy("_v").rangeBetween(-before, after)
    alone = rows.where(is_here).join(short.select("_step", "_group").distinct(), ["_step", "_group"], "left_semi")
    alone = alone.withColumn("_v", number).withColumns({f"_f{k}": _over(kind, F.col(k), inside) for k, kind in kinds.items()})
    alone = alone.join(short, [order, "_group"], "left_semi")
    return wide.select("_group", order, *joined).unionByName(alone.select("_group", order, *[F.col(f"_f{k}").alias(k) for k in kinds]))


def nth_values(df: DataFrame, keys: str | Keys, order: Order, x: str, n: int = 2, groups_fit: bool = False) -> DataFrame:
    """``first_value``, ``last_value`` and ``nth_value`` of the whole group on every row."""
    keys = _names(keys)
    if groups_fit:
        w = Window.partitionBy(*keys).orderBy(*_sorts(order))
        w = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found = {"first_value": F.first(x), "last_value": F.last(x), "nth_value": F.nth_value(x, n)}
        return df.withColumns({k: v.over(w) for k, v in found.items()})
    numbered = running(df, keys, order, {"_rn": ("count", F.lit(1))})
    return recycled(
        numbered,
        keys,
        first_value=F.min_by(F.struct(x), "_rn")[x],
        last_value=F.max_by(F.struct(x), "_rn")[x],
        nth_value=F.max(F.when(F.col("_rn") == n, F.col(x))),
    ).drop("_rn")


def quantiles(df: DataFrame, keys: str | Keys, x: str, probabilities: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group; a group of only nulls has null quantiles.

    The values are numbered in blocks, and each task passes on those at the wanted places.
    """
    keys = _names(keys)
    blocks = Blocks.of(df.select(*keys, x), keys, x)
    nonnull = F.count(x)
    carried = blocks.carried(
        blocks.totals(blocks.rows, n=nonnull),
        _b_n=F.coalesce(F.sum("n").over(blocks.along().rowsBetween(*BEFORE)), F.lit(0)),
        _b_all=F.sum("n").over(blocks.every()),
    )
    here = blocks.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocks.rows.withColumns({"_nth": nonnull.over(here), "_n": nonnull.over(blocks.group())})
    rows = blocks.with_carried(local, carried)
    nth = F.col("_nth") + F.coalesce("_b_n", F.lit(0))
    value = F.when(F.col(x).isNotNull(), F.col(x).cast("double"))
    picks = []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.coalesce("_b_all", "_n") - 1)
        picks += [
            F.max(F.when(nth == F.floor(at) + 1, value)).alias(f"_lo_{name}"),
            F.max(F.when(nth == F.ceil(at) + 1, value)).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_w_{name}"),
        ]
    out = rows.groupBy(*keys).agg(*picks)
    return out.select(
        *keys,
        *[
            (F.col(f"_lo_{k}") + (F.col(f"_hi_{k}") - F.col(f"_lo_{k}")) * F.col(f"_w_{k}")).alias(k)
            for k in probabilities
        ],
    )


def flattened(
    df: DataFrame, keys: str | Keys, x: str, name: str, sep: str = ", ", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The group's non-null texts in order, as one text per group; null if it has none.

    Equal texts collapse first. Texts are joined in blocks and then the blocks, so no task
    lists a group's rows; only the resulting text has to fit a cell.
    """
    keys = _names(keys)
    text = F.col(x)
    pieces = (
        df.groupBy(*keys, x)
        .agg(F.count(F.lit(1)).cast("int").alias("_n"))
        .withColumn("_piece", F.concat(F.repeat(F.concat(text, F.lit(sep)), F.col("_n") - 1), text))
    )

    def joined(column: str, at: str) -> Column:
        listed = F.sort_array(F.collect_list(F.when(F.col(column).isNotNull(), F.struct(at, column))))
        return F.when(F.size(listed) > 0, F.array_join(F.transform(listed, lambda s: s[column]), sep))

    numbered = running(pieces, keys, x, {"_rn": ("count", F.lit(1))})
    block = F.floor(F.col("_rn") / max(block_rows, 1)).alias("_at")
    pieces = numbered.groupBy(*keys, block).agg(joined("_piece", x).alias("_piece"))
    return pieces.groupBy(*keys).agg(joined("_piece", "_at").alias(name))


def top_k(df: DataFrame, keys: str | Keys, order: Sequence[Column], k: int, ties: bool = True) -> DataFrame:
    """The k first rows per group; ties with the k-th are kept unless told otherwise.

    Spark cuts each task's rows to the k first of each group before the shuffle.
    """
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn("_rank", rank.over(w)).where(F.col("_rank") <= k).drop("_rank")
