"""Data-quality checks.  A check finds violating rows; none means pass.

Row-level checks (not null, accepted values / range, arithmetic
consistency, row rules) expose a boolean *violation* expression, so all of
them on one table are counted in a single aggregate: one scan per table, and
none where they are observed while the table is written (:func:`observed`).
Orphan checks against one parent are counted in one pass over the parent and
all its children (:func:`orphan_counts`).  Uniqueness and ratios with a join run
their own aggregate or join.  SQL three-valued logic holds throughout: a NULL
operand does not violate a comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "table_name string, check_name string, column_name string, violations bigint, status string"


def _frame(df: DataFrame | Callable[[], DataFrame] | None) -> DataFrame | None:
    """A frame that a check compares with; it may be given as a function, so
    that it is only resolved when the check is made."""
    return df() if callable(df) else df


@dataclass
class RowCheck:
    """A check decided per row by ``violation`` (True = violating)."""
    name: str
    column: str
    severity: str = "error"

    def violation(self) -> Column:  # pragma: no cover - abstract
        raise NotImplementedError

    def rows(self, df: DataFrame) -> DataFrame:
        """The violating rows themselves."""
        return df.filter(self.violation())


@dataclass
class NotNull(RowCheck):
    def violation(self) -> Column:
        return F.col(self.column).isNull()


@dataclass
class AcceptedValues(RowCheck):
    values: Sequence = ()

    def violation(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(list(self.values))

    def rows(self, df: DataFrame) -> DataFrame:
        """Violating values with their row counts (``value_field, n_records``)."""
        return (df.filter(self.violation())
                  .groupBy(F.col(self.column).alias("value_field"))
                  .agg(F.count(F.lit(1)).alias("n_records")))


@dataclass
class AcceptedRange(RowCheck):
    min_value: object = None
    max_value: object = None
    inclusive: bool = True

    def violation(self) -> Column:
        c = F.col(self.column)
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & ((c >= self.min_value) if self.inclusive else (c > self.min_value))
        if self.max_value is not None:
            ok = ok & ((c <= self.max_value) if self.inclusive else (c < self.max_value))
        return ~ok  # NULL stays NULL: not a violation


@dataclass
class MeanConsistency(RowCheck):
    """``abs(mean - (a + b + c) / 3) > tolerance``."""
    parts: Sequence[str] = ()
    tolerance: float = 0.05

    def recomputed(self) -> Column:
        s = None
        for p in self.parts:
            s = F.col(p) if s is None else s + F.col(p)
        return s / F.lit(len(self.parts))

    def violation(self) -> Column:
        return F.abs(F.col(self.column) - self.recomputed()) > F.lit(self.tolerance)

    def rows(self, df: DataFrame) -> DataFrame:
        return (df.select(F.col(self.column).alias("mean"), self.recomputed().alias("recomputed_mean"))
                  .filter(F.abs(F.col("mean") - F.col("recomputed_mean")) > F.lit(self.tolerance)))


@dataclass
class SumConsistency(RowCheck):
    """``total != a + b + ...`` (exact, for counts)."""
    parts: Sequence[str] = ()

    def recomputed(self) -> Column:
        s = None
        for p in self.parts:
            s = F.col(p) if s is None else s + F.col(p)
        return s

    def violation(self) -> Column:
        return self.recomputed() != F.col(self.column)


@dataclass
class RowRule(RowCheck):
    """Any boolean rule over a row; ``expr`` is True for a *violation*."""
    expr: Column | None = None

    def violation(self) -> Column:
        return self.expr


@dataclass
class Tolerance(RowCheck):
    """``[guard AND] abs(column - expected) > tolerance``."""
    expected: Column | None = None
    tolerance: float = 0.01
    guard: Column | None = None

    def violation(self) -> Column:
        v = F.abs(F.col(self.column) - self.expected) > F.lit(self.tolerance)
        return v if self.guard is None else (self.guard & v)


@dataclass
class RatioConsistency:
    """``abs(ratio - (num / nullif(den, 0)) * scale) > tolerance``.

    With ``join_to``/``join_on`` the denominator comes from another table
    (inner join on ``join_on``); otherwise all three are row-level.
    """
    name: str
    column: str
    numerator: str
    denominator: str
    scale: float = 1.0
    tolerance: float = 0.05
    join_to: DataFrame | Callable[[], DataFrame] | None = None
    join_on: str | None = None
    severity: str = "error"

    def _source(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        ratio = F.col(self.column).alias("ratio")
        num = F.col(self.numerator).cast("double").alias("num")
        if self.join_to is not None and self.join_on:
            m = df.select(*keep, self.join_on, ratio, num)
            e = _frame(self.join_to).select(self.join_on, F.col(self.denominator).cast("double").alias("den"))
            return m.join(e, self.join_on, "inner")
        return df.select(*keep, ratio, F.col(self.denominator).cast("double").alias("den"), num)

    def rows(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Violating rows as ``(*keep, ratio, recomputed_ratio)``."""
        r = self._source(df, keep).withColumn(
            "recomputed_ratio", (F.col("num") / F.nullif(F.col("den"), F.lit(0.0))) * F.lit(self.scale))
        return (r.filter(F.abs(F.col("ratio") - F.col("recomputed_ratio")) > F.lit(self.tolerance))
                 .select(*keep, "ratio", "recomputed_ratio"))

    def is_row_level(self) -> bool:
        return self.join_to is None

    def violation(self) -> Column:
        rec = (F.col(self.numerator).cast("double")
               / F.nullif(F.col(self.denominator).cast("double"), F.lit(0.0))) * F.lit(self.scale)
        return F.abs(F.col(self.column) - rec) > F.lit(self.tolerance)


@dataclass
class Unique:
    """No two rows share ``columns`` (NULL keys ignored for one column)."""
    name: str
    columns: Sequence[str] = field(default_factory=list)
    severity: str = "error"

    @property
    def column(self) -> str:
        return ",".join(self.columns)

    def rows(self, df: DataFrame) -> DataFrame:
        cols = list(self.columns)
        src = df.select(*cols)
        if len(cols) == 1:
            src = src.filter(F.col(cols[0]).isNotNull())
        return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


@dataclass
class Relationships:
    """Every non-NULL ``column`` of the child exists as ``to_column`` in ``parent``."""
    name: str
    column: str
    parent: DataFrame | Callable[[], DataFrame] | None = None
    to_column: str | None = None
    severity: str = "error"

    def rows(self, df: DataFrame) -> DataFrame:
        to = self.to_column or self.column
        # an anti join ignores repeated parent keys, and without an aggregate
        # on either side a hot key's partition can be split
        p = _frame(self.parent).select(F.col(to).alias("__parent_key"))
        child = df.select(F.col(self.column).alias("from_field")).filter(F.col("from_field").isNotNull())
        return child.join(p, F.col("from_field") == F.col("__parent_key"), "left_anti")


@dataclass
class Skipped:
    """A check that cannot be made: what it compares with is not to be relied on."""
    name: str
    column: str
    severity: str = "error"


def _is_row_level(chk) -> bool:
    if isinstance(chk, RowCheck):
        return True
    if isinstance(chk, RatioConsistency):
        return chk.is_row_level()
    return False


def row_level(checks: Iterable) -> list:
    return [c for c in checks if _is_row_level(c)]


def _counts(checks: Sequence) -> list[Column]:
    return [F.count(F.when(c.violation(), 1)).alias(f"c{i}") for i, c in enumerate(checks)]


def _status(violations: Column, severity: Column) -> Column:
    return F.when(violations == 0, F.lit("pass")).otherwise(severity)


def observed(df: DataFrame, checks: Sequence) -> tuple[DataFrame, Observation | None]:
    """``df`` with its row-level checks counted while it is written (by the job
    that writes it, at no extra scan), and the observation that gets them."""
    if not checks:
        return df, None
    seen = Observation()
    return df.observe(seen, *_counts(checks)), seen


def report_of(spark: SparkSession, counted: Sequence[tuple], table: str) -> DataFrame:
    """The report of (check, violations) pairs that are known already."""
    rows = [(table, c.name, c.column, int(n), "pass" if n == 0 else c.severity) for c, n in counted]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def observed_report(spark: SparkSession, seen: Observation, checks: Sequence, table: str) -> DataFrame:
    """The report of checks that were observed during a write that has ended."""
    got = seen.get
    return report_of(spark, [(c, got[f"c{i}"]) for i, c in enumerate(checks)], table)


def orphan_counts(parent: DataFrame, to_column: str, children: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """(``child``, ``violations``) of every (name, frame, column): rows whose
    non-NULL column is no ``to_column`` of the parent.

    One pass: the parent's keys and all children's keys are tagged, put together
    and aggregated by key, so the parent is read once for all its children, and a
    hot key's rows are combined before the shuffle.  Several columns of one frame
    are read in one scan."""
    tagged = parent.select(F.col(to_column).alias("key"), F.lit(-1).alias("child")).where(F.col("key").isNotNull())
    by_frame: dict[int, list[int]] = {}
    for i, (_, df, _) in enumerate(children):
        by_frame.setdefault(id(df), []).append(i)
    for own in by_frame.values():
        df = children[own[0]][1]
        if len(own) == 1:
            keys = df.select(F.col(children[own[0]][2]).alias("key"), F.lit(own[0]).alias("child"))
        else:
            keys = df.select(F.inline(F.array(*[F.struct(F.col(children[i][2]).alias("key"), F.lit(i).alias("child"))
                                                for i in own])))
        tagged = tagged.union(keys.where(F.col("key").isNotNull()))
    held = tagged.groupBy("key").agg(F.max(F.col("child") == -1).alias("known"),
                                     *[F.count(F.when(F.col("child") == i, 1)).alias(f"n{i}") for i in range(len(children))])
    totals = held.where(~F.col("known")).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}")
                                               for i in range(len(children))])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(n).alias("child"), F.col(f"n{i}").cast("bigint").alias("violations"))
                                            for i, (n, _, _) in enumerate(children)])))


def orphan_report(checks: Sequence[tuple[str, DataFrame, Relationships]]) -> DataFrame | None:
    """The report of (table, frame, check) orphan checks, one pass per parent key."""
    checks = [(t, df, replace(c, parent=_frame(c.parent))) for t, df, c in checks]
    groups: dict[tuple, list] = {}
    for table, df, c in checks:
        groups.setdefault((id(c.parent), c.to_column or c.column), []).append((table, df, c))
    out = None
    for (_, to), own in groups.items():
        counts = orphan_counts(own[0][2].parent, to, [(str(i), df, c.column) for i, (_, df, c) in enumerate(own)])
        told = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c.name).alias("check_name"),
                                  F.lit(c.column).alias("column_name"), F.lit(c.severity).alias("severity"))
                         for t, _, c in own])[F.col("child").cast("int")]
        rep = counts.select(told.alias("m"), "violations").select(
            "m.table_name", "m.check_name", "m.column_name", "violations",
            _status(F.col("violations"), F.col("m.severity")).alias("status"))
        out = rep if out is None else out.unionByName(rep)
    return out


def evaluate(df: DataFrame, checks: Iterable, table: str, repeated: dict[tuple, DataFrame] | None = None) -> DataFrame | None:
    """Report ``(table_name, check_name, column_name, violations, status)``; None
    without checks.

    All row-level checks of the table are counted in ONE aggregate (one scan),
    orphan checks in one pass per parent key; each other check adds one job.
    ``repeated`` gives, by columns, the repeated keys where they are kept with
    the table: those uniqueness checks read no row of it.  ``status`` is ``pass``,
    the check's severity (``error`` / ``warn``) or ``skipped``.
    """
    checks = list(checks)
    parts: list[DataFrame] = []

    def as_report(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(table).alias("table_name"), "check_name", "column_name", "violations",
                           _status(F.col("violations"), F.col("severity")).alias("status"))
    flat = row_level(checks)
    if flat:
        meta = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                                  F.col(f"c{i}").cast("bigint").alias("violations"),
                                  F.lit(c.severity).alias("severity"))
                         for i, c in enumerate(flat)])
        parts.append(as_report(df.agg(*_counts(flat)).select(F.inline(meta))))
    orphans = [(table, df, c) for c in checks if isinstance(c, Relationships)]
    if orphans:
        parts.append(orphan_report(orphans))
    for c in checks:
        if _is_row_level(c) or isinstance(c, (Relationships, Skipped)):
            continue
        kept = (repeated or {}).get(tuple(c.columns)) if isinstance(c, Unique) else None
        v = (c.rows(df) if kept is None else kept).agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        parts.append(as_report(v.select(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                                        "violations", F.lit(c.severity).alias("severity"))))
    gone = [(table, c.name, c.column, None, "skipped") for c in checks if isinstance(c, Skipped)]
    if gone:
        parts.append(df.sparkSession.createDataFrame(gone, REPORT_SCHEMA))
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def gate(report: DataFrame, what: str = "quality checks") -> None:
    """Raise when a report has an ``error`` status (warnings never block)."""
    bad = report.filter(F.col("status") == "error").select("table_name", "check_name", "violations").collect()
    if bad:
        lines = ", ".join(f"{r.table_name}.{r.check_name}={r.violations}" for r in bad)
        raise QualityError(f"{what} failed: {lines}")


class QualityError(RuntimeError):
    pass
