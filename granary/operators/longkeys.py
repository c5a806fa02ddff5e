"""Windows over long keys: a prefix scan in stretches.

A window runs each key in one task, which is right until one page, text or user has more rows than a task
should sort. Here the keys with more than ``most`` rows are cut into stretches of their order, at quantiles that
come from a mergeable sketch. A window then runs within each stretch, in a task of its own; what it has to know of
the stretches before (the last value, a sum, a count) or after (the first value) is aggregated for each stretch,
scanned over the few stretches of a key, and looked up. One shuffle of the rows, as for a plain window.

Rows of equal order stand in one stretch, nulls of the order in the first, so the result is that of the plain
window. Tables without long keys get the plain window. ``by`` may be empty; null keys are a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.operators.lookups import sized

#: Rows of a key from which it is cut, and stretches that a key has at most.
LONG, STRETCHES = 1_000_000, 1024


class Stretches:
    """``rows`` with a column that numbers the stretches of their keys."""

    def __init__(self, df: DataFrame, by: Sequence[str], at: str, most: int = LONG):
        self.by, self.at = list(by), at
        self.column = next(n for n in (f"_stretch{k or ''}" for k in range(99)) if n not in df.columns)
        sizes = df.groupBy(*self.by).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
        largest = sizes.agg(F.max("_n")).first()[0]
        self.long = largest is not None
        if not self.long:
            self.rows = self.plain = df.withColumn(self.column, F.lit(0))
            return
        count = min(STRETCHES, -(-largest // most))
        shares = [k / count for k in range(1, count)] or [0.5]
        cuts = df.groupBy(*self.by).agg(F.count("*").alias("_n"), F.percentile_approx(at, shares).alias("_cuts")).where(F.col("_n") > most)
        cuts = cuts.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(self.by)], F.array_distinct("_cuts").alias("_cuts"))
        # How many cuts are not beyond a row, by halving: ten looks at up to 1023 cuts.
        halves = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))])
        number = F.aggregate(halves, F.lit(0), lambda n, h: F.when(F.get("_cuts", n + h - 1) <= F.col(at), n + h).otherwise(n))
        self.rows = df.join(sized(cuts), self._same("_by"), "left").withColumn(self.column, F.when(F.col("_cuts").isNull(), 0).otherwise(number)).select(*df.columns, self.column)
        self.plain = self.rows

    def _same(self, name: str) -> Column:
        out = F.lit(True)
        for k, c in enumerate(self.by):
            out = out & F.col(c).eqNullSafe(F.col(f"{name}{k}"))
        return out

    def _window(self, order: Sequence[Column | str]):
        return Window.partitionBy(*self.by, self.column).orderBy(*order)

    def _looked_up(self, rows: DataFrame, what: Column, needs: Sequence[str], scan: Column, after: bool = False) -> DataFrame:
        """rows with ``_carry``: ``scan`` (over ``_x``) of ``what`` of the other stretches of the key, before it or after. What
        needs columns of the table itself only is taken from there, so windows that were added before are not run for it."""
        each = (self.plain if set(needs) <= set(self.plain.columns) else rows).groupBy(*self.by, self.column).agg(what.alias("_x"))
        order = F.desc(self.column) if after else F.asc(self.column)
        w = Window.partitionBy(*self.by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        small = each.withColumn("_carry", scan.over(w)).where(F.col("_carry").isNotNull())  # at most STRETCHES rows of a key
        small = small.select(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(self.by)], F.col(self.column).alias("_of"), "_carry")
        return rows.join(sized(small), self._same("_key") & (F.col(self.column) == F.col("_of")), "left").drop("_of", *[f"_key{k}" for k in range(len(self.by))])

    def last(self, value: str, order: Sequence[str], name: str, inclusive: bool = True) -> Stretches:
        """``name``: the last value that is not null, up to a row or before it."""
        frame = self._window(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        rows = self.rows.withColumn("_local", F.last(value, ignorenulls=True).over(frame))
        if self.long:
            filled = F.col(value).isNotNull()
            rows = self._looked_up(rows, F.max_by(F.col(value), F.when(filled, F.struct(*order))), [value, *order], F.last("_x", ignorenulls=True))
            rows = rows.withColumn("_local", F.coalesce("_local", "_carry")).drop("_carry")
        return self._with(rows.drop(name) if name in self.rows.columns else rows, name)

    def running_sum(self, value: str | None, order: Sequence[Column | str], name: str) -> Stretches:
        """``name``: the sum of a column, or the number of rows, up to and with a row (rows of one order as they come)."""
        total = F.count("*") if value is None else F.sum(value)
        rows = self.rows.withColumn("_local", total.over(self._window(order).rowsBetween(Window.unboundedPreceding, 0)))
        if self.long:
            rows = self._looked_up(rows, total, [] if value is None else [value], F.sum("_x"))
            rows = rows.withColumn("_local", F.col("_local") + F.coalesce("_carry", F.lit(0))).drop("_carry")
        return self._with(rows, name)

    def neighbour(self, value: str, order: Sequence[str], name: str, after: bool = False) -> Stretches:
        """``name``: the value of the row before (or after), null where there is none. ``order`` is ascending and total."""
        w, packed = self._window(order), F.struct(F.col(value).alias("v"))
        rows = self.rows.withColumn("_local", (F.lead(packed) if after else F.lag(packed)).over(w))
        if self.long:
            edge = (F.min_by if after else F.max_by)(packed, F.struct(*order))
            rows = self._looked_up(rows, edge, [value, *order], F.last("_x", ignorenulls=True), after)
            rows = rows.withColumn("_local", F.coalesce("_local", "_carry")).drop("_carry")
        return self._with(rows.withColumn("_local", F.col("_local.v")), name)

    def _with(self, rows: DataFrame, name: str) -> Stretches:
        out = object.__new__(Stretches)
        out.by, out.at, out.column, out.long, out.plain = self.by, self.at, self.column, self.long, self.plain
        out.rows = rows.withColumnRenamed("_local", name)
        return out

    def adding(self, name: str, value: Column) -> Stretches:
        """The rows with one column more, of what stands in a row."""
        return self._with(self.rows.withColumn("_local", value), name)

    @property
    def table(self) -> DataFrame:
        return self.rows.drop(self.column)
