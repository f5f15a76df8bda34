"""Data-quality checks as aggregations, their report, and the repair of a table that fails them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelake import fixed
from probelake.operators.filters import drop_null_rows, whitelist

SIZE = "Size"
COMPLETENESS = "Completeness"
UNIQUENESS = "Uniqueness"
CONTAINMENT = "Containment"

# Groups whose failed constraints are sent to every task; beyond, their rows are dealt over so many salts.
FEW_GROUPS = 100_000
SALTS = 64


@dataclass(frozen=True)
class Constraint:
    """One metric of a table and the value it has to reach."""

    kind: str
    column: str = ""
    at_least: float = 1.0
    allowed: tuple[str, ...] = ()

    @property
    def text(self) -> str:
        values = f" in [{','.join(self.allowed)}]" if self.kind == CONTAINMENT else ""
        return f"{self.kind}({self.column}{values})"

    def metric(self) -> Column:
        """The metric as an aggregate over all rows; uniqueness needs counts per value instead."""
        rows = F.count(F.lit(1))
        if self.kind == SIZE:
            return rows.cast("double")
        if self.kind == COMPLETENESS:
            return F.try_divide(F.count(F.col(self.column)).cast("double"), rows)
        if self.kind == CONTAINMENT:
            value = F.col(self.column)
            return F.avg((value.isNull() | value.isin(*self.allowed)).cast("double"))
        return F.lit(None).cast("double")

    def holds(self, metric: Column) -> Column:
        """Whether the metric is good enough; an undefined one is not."""
        reached = metric > 0 if self.kind == SIZE else metric >= self.at_least
        return F.coalesce(reached, F.lit(False))


def has_rows() -> Constraint:
    return Constraint(SIZE)


def complete(column: str, at_least: float) -> Constraint:
    """Non-NULL share of a column."""
    return Constraint(COMPLETENESS, column, at_least)


def unique(column: str) -> Constraint:
    """Values that occur once, as a share of the non-NULL rows, must be all."""
    return Constraint(UNIQUENESS, column)


def contained(column: str, allowed: Sequence[str]) -> Constraint:
    """All non-NULL values must be among the allowed."""
    return Constraint(CONTAINMENT, column, 1.0, tuple(allowed))


def measure(
    df: DataFrame,
    constraints: Sequence[Constraint],
    by: Sequence[str] = (),
    groups: DataFrame | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """All metrics as rows (``by`` columns, ``position`` in the list, ``metric``).

    ``groups`` (``by`` columns) names groups that are measured even if they have no rows: their size is 0. ``distinct``
    names columns of which no group has a value twice, as after a deduplication: their values are not counted again.

    Size, completeness and containment are one aggregation with partial sums in every task, so a group
    with most of the rows costs no more than others. Uniqueness counts rows per value first.
    """
    by = list(by)
    known = {i for i, c in enumerate(constraints) if c.kind == UNIQUENESS and c.column in distinct}
    metrics = F.array(
        *[
            F.struct(F.lit(i).alias("position"), (_all_once(c.column) if i in known else c.metric()).alias("metric"))
            for i, c in enumerate(constraints)
        ]
    )
    parts = df.groupBy(*by).agg(metrics.alias("metrics")).select(*by, F.inline("metrics"))
    for i, constraint in enumerate(constraints):
        if constraint.kind == UNIQUENESS and i not in known:
            parts = parts.unionByName(_uniqueness(df, constraint.column, by, i))
    if groups is not None:
        nothing = [F.lit(0.0 if c.kind == SIZE else None).cast("double") for c in constraints]
        rows = F.array(*[F.struct(F.lit(i).alias("position"), m.alias("metric")) for i, m in enumerate(nothing)])
        parts = parts.unionByName(groups.select(*by).distinct().select(*by, F.inline(rows)))
    return parts.groupBy(*by, "position").agg(F.max("metric").alias("metric"))


def _all_once(column: str) -> Column:
    return F.when(F.count(F.col(column)) > 0, F.lit(1.0))


def _uniqueness(df: DataFrame, column: str, by: list[str], position: int) -> DataFrame:
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("rows"))
    )
    share = F.try_divide(
        F.sum((F.col("rows") == 1).cast("long")).cast("double"), F.sum("rows")
    )
    return counts.groupBy(*by).agg(share.alias("metric")).select(
        *by, F.lit(position).alias("position"), "metric"
    )


def report(
    df: DataFrame,
    constraints: Sequence[Constraint],
    by: Sequence[str] = (),
    name: str = fixed.CHECK_NAME,
    level: str = fixed.CHECK_LEVEL,
    groups: DataFrame | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """One row per constraint (and value of ``by``) with its status and that of the whole check."""
    return report_of(measure(df, constraints, by, groups, distinct), constraints, by, name, level)


def report_of(
    metrics: DataFrame,
    constraints: Sequence[Constraint],
    by: Sequence[str] = (),
    name: str = fixed.CHECK_NAME,
    level: str = fixed.CHECK_LEVEL,
) -> DataFrame:
    """The report on metrics (``by`` columns, ``position``, ``metric``), wherever they come from."""
    position, metric = F.col("position"), F.col("metric")

    def per_constraint(value) -> Column:
        return F.element_at(F.array(*[value(c) for c in constraints]), position + 1)

    holds = per_constraint(lambda c: c.holds(metric))
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    checked = metrics.withColumn("holds", holds).withColumn("all_hold", F.min("holds").over(whole))
    found = F.coalesce(metric.cast("string"), F.lit("undefined"))
    return checked.select(
        *by,
        F.lit(name).alias("check"),
        F.lit(level).alias("check_level"),
        F.when(F.col("all_hold"), fixed.STATUS_SUCCESS).otherwise(level).alias("check_status"),
        per_constraint(lambda c: F.lit(c.text)).alias("constraint"),
        F.when(F.col("holds"), fixed.STATUS_SUCCESS).otherwise(fixed.STATUS_FAILURE).alias("constraint_status"),
        F.when(F.col("holds"), "")
        .otherwise(F.concat(F.lit("Value: "), found, F.lit(" does not meet the constraint requirement!")))
        .alias("constraint_message"),
    )


def failures(quality: DataFrame) -> DataFrame:
    """Rows of a report whose constraint failed."""
    return quality.where(F.col("constraint_status") != fixed.STATUS_SUCCESS)


def columns_to_drop(
    constraint: Constraint, droppable: Sequence[str], substring_match: bool = False
) -> list[str]:
    """Columns whose NULLs go when ``constraint`` fails.

    By default the constraint's own column. ``substring_match`` takes every column whose name occurs in
    the constraint's text, so that a failure on ``is_ip_valid`` also drops rows without ``id``.
    """
    if substring_match:
        return [c for c in droppable if c in constraint.text]
    return [c for c in droppable if c == constraint.column]


def remediate(
    df: DataFrame,
    quality: DataFrame,
    constraints: Sequence[Constraint],
    droppable: Sequence[str] | None = None,
    by: Sequence[str] = (),
    substring_match: bool = False,
) -> DataFrame:
    """Remove the rows that made checks fail; with no failure ``df`` comes back unchanged.

    A failed completeness or containment drops rows with a NULL in the column; any failure on a
    column with a list of allowed values also drops the other values. ``by`` decides this per group.
    """
    if droppable is None:
        droppable = [c.column for c in constraints if c.kind in (COMPLETENESS, CONTAINMENT)]
    droppable = list(dict.fromkeys(droppable))
    if by:
        return _remediate_groups(df, quality, constraints, droppable, list(by), substring_match)
    # At most one row per constraint.
    failed_texts = {row.constraint for row in failures(quality).select("constraint").collect()}
    failed = [c for c in constraints if c.text in failed_texts]
    drop = [column for c in failed for column in columns_to_drop(c, droppable, substring_match)]
    if drop:
        df = drop_null_rows(df, drop)
    for column, allowed in _whitelists(constraints).items():
        if column in drop:
            df = whitelist(df, column, allowed)
    return df


def _whitelists(constraints: Sequence[Constraint]) -> dict[str, tuple[str, ...]]:
    return {c.column: c.allowed for c in constraints if c.kind == CONTAINMENT}


def _remediate_groups(
    df: DataFrame,
    quality: DataFrame,
    constraints: Sequence[Constraint],
    droppable: Sequence[str],
    by: list[str],
    substring_match: bool,
) -> DataFrame:
    """The same decision for every group in one plan: a join with the failed constraints per group.

    What failed is one number per group, a bit per constraint. Up to ``FEW_GROUPS`` groups that is broadcast, a
    few MB. Beyond that a salt spreads the rows of a large group over many tasks, and the numbers are repeated
    for every salt.
    """
    if not any(c.column for c in constraints):
        return df
    if len(constraints) > 63:
        raise ValueError("at most 63 constraints can be repaired by group")
    bit = F.coalesce(
        *[F.when(F.col("constraint") == c.text, F.lit(1 << i)) for i, c in enumerate(constraints)]
    )
    plan = failures(quality).groupBy(*by).agg(F.bit_or(bit.cast("bigint")).alias("__failed"))
    plan = plan.select(*[F.col(b).alias(f"__{b}") for b in by], "__failed")
    salt = F.lit(0).cast("bigint")
    if plan.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        plan = F.broadcast(plan.withColumn("__salt", salt))
    else:
        salts = F.sequence(salt, F.lit(SALTS - 1).cast("bigint"))
        plan = plan.withColumn("__salt", F.explode(salts))
        salt = F.pmod(F.xxhash64(*sorted({c.column for c in constraints if c.column})), F.lit(SALTS))
    same_group = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]
    whitelists = _whitelists(constraints)
    keep = F.lit(True)
    for i, constraint in enumerate(constraints):
        for column in columns_to_drop(constraint, droppable, substring_match):
            bad = F.col(column).isNull()
            if column in whitelists:
                bad = bad | ~F.col(column).isin(*whitelists[column])
            failed = F.coalesce(F.getbit("__failed", F.lit(i)) == 1, F.lit(False))
            keep = keep & ~(failed & bad)
    return df.join(plan, [*same_group, salt == F.col("__salt")], "left").where(keep).select(*df.columns)
