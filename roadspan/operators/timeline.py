"""Ordered per-key computations that do not depend on a key fitting in one task.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. That is the
right plan while no key is large, and it is what runs then. When a key holds more
rows than ``rows_per_slice`` its time axis is cut into slices:

* frames of fixed length (lag, lead, rolling statistics) get the few neighbouring
  rows of the adjacent slices added as a halo, are computed per (key, slice), and
  the halo is dropped again;
* running values (sum, max, count, first, last) are computed per (key, slice) and
  completed with the carry of all earlier slices, one small row per slice.

Slices are a function of the time column only, so the results are the same as those
of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadspan.operators.scaling import (
    BROADCAST_ROWS,
    materialise,
)

ROWS_PER_SLICE = 2_000_000
ROWS_PER_SLICE_CONF = "spark.roadspan.rowsPerSlice"

# Slice widths in seconds; each divides a day, so no slice crosses midnight.
NO_TIME = -(1 << 62)
WIDTHS = [86400, 43200, 21600, 10800, 3600, 1800, 600, 300, 60, 30, 10, 5, 1]


def hot_cuts(
    df: DataFrame, keys: list[str], ts: str, rows_per_slice: int | None = None
) -> DataFrame | None:
    """(keys, day, slice width) for the keys that need slicing; None when there are none.

    A frame with no more rows than a slice may have cannot hold a large key, so nothing
    else is counted then. Otherwise the rows are counted per key and minute, which reads
    only these two columns and combines before the shuffle. The width is the largest at
    which no slice of that day holds more rows than asked; where one minute does, it is
    a second. Rows without a time are one slice, a NULL key is a key like any other.
    """
    spark = df.sparkSession
    if rows_per_slice is None:
        configured = spark.conf.get(ROWS_PER_SLICE_CONF, None)
        rows_per_slice = int(configured) if configured else ROWS_PER_SLICE
    if df.count() <= rows_per_slice:
        return None

    seconds = F.unix_seconds(ts)
    per_minute = df.groupBy(
        *keys, _utc_day(ts).alias("_day"), F.floor(F.pmod(seconds, F.lit(86400)) / 60).alias("_minute")
    ).agg(F.count("*").alias("_rows"))
    hot = materialise(
        per_minute.withColumn("_total", F.sum("_rows").over(Window.partitionBy(*keys)))
        .filter(F.col("_total") > rows_per_slice)
        .drop("_total")
    )
    if hot.isEmpty():
        return None
    wide = F.array(*[F.lit(w) for w in WIDTHS if w >= 60])
    fits = (
        hot.select("*", F.explode(wide).alias("_w"))
        .groupBy(*keys, "_day", "_w", F.floor(F.col("_minute") * 60 / F.col("_w")).alias("_bucket"))
        .agg(F.sum("_rows").alias("_rows"))
        .groupBy(*keys, "_day", "_w")
        .agg(F.max("_rows").alias("_most"))
    )
    return materialise(
        fits.groupBy(*keys, "_day").agg(
            F.coalesce(F.max(F.when(F.col("_most") <= rows_per_slice, F.col("_w"))), F.lit(1)).alias("_width")
        )
    )


# Stands for "count the rows of the frame itself". A step that works on the result of
# other steps is given the cuts of the raw rows instead, so that nothing upstream runs
# just to be counted; cuts never change a result.
AUTO = "auto"
Cuts = DataFrame | None | str


def cuts_for(df: DataFrame, keys: list[str], ts: str, cuts: Cuts) -> DataFrame | None:
    return hot_cuts(df, keys, ts) if isinstance(cuts, str) else cuts


class Timeline:
    """Rows of many keys, each ordered by ``order`` (ascending, NULLs first).

    ``order`` must begin with the time column ``ts`` and should be total over
    distinct rows. ``cuts`` comes from :func:`hot_cuts`; None means plain windows.
    """

    def __init__(
        self, df: DataFrame, keys: list[str], order: list[str], cuts: DataFrame | None = None
    ):
        self.keys, self.order, self.sliced = keys, order, cuts is not None
        if cuts is not None:
            if cuts.count() <= BROADCAST_ROWS:
                cuts = F.broadcast(cuts)
            seconds = F.unix_seconds(order[0])
            # A slice of NULL marks a key that is not hot; hot rows without a time come first.
            start = F.coalesce(seconds - F.pmod(seconds, F.col("_width")), F.lit(NO_TIME))
            df = (
                join_null_safe(df.withColumn("_day", _utc_day(order[0])), cuts, [*keys, "_day"])
                .withColumn("_slice", F.when(F.col("_width").isNotNull(), start))
                .drop("_day", "_width")
            )
        self._df = df

    @property
    def df(self) -> DataFrame:
        return self._df.drop("_slice")

    def _with(self, df: DataFrame) -> Timeline:
        other = Timeline.__new__(Timeline)
        other.keys, other.order, other.sliced, other._df = self.keys, self.order, self.sliced, df
        return other

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Timeline:
        """Apply a row-wise change that keeps keys and order."""
        return self._with(change(self._df))

    def _window(self) -> WindowSpec:
        group = [*self.keys, "_slice"] if self.sliced else self.keys
        return Window.partitionBy(*group).orderBy(*self.order)

    def frame(
        self,
        before: int,
        after: int,
        columns: Callable[[WindowSpec], dict[str, Column]],
        within: str | None = None,
    ) -> Timeline:
        """Add window columns that look at most ``before`` rows back and ``after`` ahead.

        With ``within``, rows see only rows that agree in that column.
        """
        if within is not None:
            finer = self._with(self._df)
            finer.keys = [*self.keys, within]
            return self._with(finer.frame(before, after, columns)._df)
        if not self.sliced:
            return self._with(self._df.withColumns(columns(self._window())))
        rows = self._df.withColumn("_halo", F.lit(False))
        if before:
            rows = rows.unionByName(self._halo(before, ahead=False))
        if after:
            rows = rows.unionByName(self._halo(after, ahead=True))
        done = rows.withColumns(columns(self._window())).filter(~F.col("_halo")).drop("_halo")
        return self._with(done)

    def _halo(self, n: int, ahead: bool) -> DataFrame:
        """The ``n`` rows next to each slice, taken from the slices beside it."""
        hot = self._df.filter(F.col("_slice").isNotNull())
        edge_order = [F.col(c).asc() if ahead else F.col(c).desc() for c in self.order]
        edge = Window.partitionBy(*self.keys, "_slice").orderBy(*edge_order)
        fields = [c for c in hot.columns if c not in (*self.keys, "_slice")]
        ends = (
            hot.withColumn("_edge", F.row_number().over(edge))
            .filter(F.col("_edge") <= n)
            .groupBy(*self.keys, "_slice")
            .agg(F.sort_array(F.collect_list(F.struct("_edge", F.struct(*fields).alias("_row")))).alias("_rows"))
        )
        # _edge 1 is the row nearest to the neighbouring slice; every slice holds at
        # least one row, so n neighbouring slices are enough to find n rows.
        nearest_first = F.col("_slice").asc() if not ahead else F.col("_slice").desc()
        beside = Window.partitionBy(*self.keys).orderBy(nearest_first).rowsBetween(-n, -1)
        return (
            ends.withColumn("_near", F.flatten(F.reverse(F.collect_list("_rows").over(beside))))
            .select(*self.keys, "_slice", F.explode(F.slice("_near", 1, n)).alias("_near"))
            .select(*self.keys, "_slice", "_near._row.*", F.lit(True).alias("_halo"))
        )

    def running(self, values: dict[str, tuple[str, Column]]) -> Timeline:
        """Add running values over all rows of the key up to the current one.

        Each value is (kind, column) with kind sum, max, count, first or last;
        first and last skip NULLs.
        """
        w = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inner = {name: _fold(kind, col).over(w) for name, (kind, col) in values.items()}
        if not self.sliced:
            return self._with(self._df.withColumns(inner))

        rows = self._df.withColumns(inner)
        totals = (
            self._df.filter(F.col("_slice").isNotNull())
            .groupBy(*self.keys, "_slice")
            .agg(*[_total(kind, col, self.order).alias(name) for name, (kind, col) in values.items()])
        )
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = totals.select(
            *self.keys,
            "_slice",
            *[
                _fold("sum" if kind == "count" else kind, F.col(name)).over(earlier).alias(f"_carry_{name}")
                for name, (kind, _) in values.items()
            ],
        )
        joined = join_null_safe(rows, carry, [*self.keys, "_slice"])
        merged = {
            name: _merge(kind, F.col(f"_carry_{name}"), F.col(name))
            for name, (kind, _) in values.items()
        }
        return self._with(joined.withColumns(merged).drop(*[f"_carry_{n}" for n in values]))

    def totals(self, values: dict[str, tuple[str, Column]]) -> Timeline:
        """Add values over all rows of the key; kinds sum, max and count."""
        if not self.sliced:
            w = Window.partitionBy(*self.keys)
            return self._with(
                self._df.withColumns({name: _fold(kind, col).over(w) for name, (kind, col) in values.items()})
            )
        whole = self._df.groupBy(*self.keys).agg(
            *[_fold(kind, col).alias(name) for name, (kind, col) in values.items()]
        )
        return self._with(join_null_safe(self._df, whole, self.keys))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a NULL key meets a NULL key; the keys stay those of ``left``."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys]
    )
    return left.join(named, same, "left").drop(*[f"_right_{k}" for k in keys])


def _utc_day(ts: str) -> Column:
    return F.floor(F.unix_seconds(ts) / 86400)


def _total(kind: str, col: Column, order: list[str]) -> Column:
    """The value over a whole slice; combines before the shuffle."""
    place = F.when(col.isNotNull(), F.struct(*order))
    if kind == "first":
        return F.min_by(col, place)
    if kind == "last":
        return F.max_by(col, place)
    return _fold(kind, col)


def _fold(kind: str, col: Column) -> Column:
    return {
        "sum": lambda: F.sum(col),
        "max": lambda: F.max(col),
        "count": lambda: F.count(col),
        "first": lambda: F.first(col, ignorenulls=True),
        "last": lambda: F.last(col, ignorenulls=True),
    }[kind]()


def _merge(kind: str, carry: Column, own: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(carry.isNull(), own).when(own.isNull(), carry).otherwise(carry + own)
    if kind == "max":
        return F.greatest(carry, own)
    if kind == "first":
        return F.coalesce(carry, own)
    return F.coalesce(own, carry)
