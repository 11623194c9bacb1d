"""Data-quality expectations: enforce them, count them, keep what they reject.

A condition whose result is NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfline.schemas import EVENT_TYPES, ORDER_STATUSES


@dataclass(frozen=True)
class Expectation:
    """A named SQL condition; rows that fail it are dropped, or only counted."""

    name: str
    condition: str
    drop: bool = True

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


ORDER_CHECKS = (
    Expectation("valid_order_id", "order_id IS NOT NULL"),
    Expectation("valid_customer", "customer_id IS NOT NULL"),
    Expectation("positive_amount", "total_amount > 0"),
    Expectation("valid_status", _one_of("status", ORDER_STATUSES), drop=False),
)
CLICK_CHECKS = (
    Expectation("valid_event_id", "event_id IS NOT NULL"),
    Expectation("valid_event_type", _one_of("event_type", EVENT_TYPES), drop=False),
)


def _accepted(checks: Sequence[Expectation]) -> Column:
    return reduce(Column.__and__, [check.holds() for check in checks if check.drop], F.lit(True))


def enforce(rows: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """Rows that hold every dropping expectation. Works on batches and on streams."""
    return rows.filter(_accepted(checks))


def _passed(checks: Sequence[Expectation]) -> list[Column]:
    return [F.count_if(check.holds()).alias(check.name) for check in checks]


def observed(rows: DataFrame, dataset: str | Observation, checks: Sequence[Expectation]) -> DataFrame:
    """The same rows; a running query reports the pass counts under ``dataset``.

    Put this before :func:`enforce`, so that dropped rows are counted. The counts are in the
    ``observedMetrics`` of a stream's progress, or in a batch ``Observation``.
    """
    return rows.observe(dataset, F.count(F.lit(1)).alias("rows_seen"), *_passed(checks))


def metrics(rows: DataFrame, dataset: str, checks: Sequence[Expectation]) -> DataFrame:
    """(dataset, constraint_name, action, passed, failed), one row per check, in one pass."""
    counted = rows.agg(F.count(F.lit(1)).alias("_rows"), *_passed(checks))
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(check.name).alias("constraint_name"),
            F.lit("drop" if check.drop else "warn").alias("action"),
            F.col(check.name).alias("passed"),
            (F.col("_rows") - F.col(check.name)).alias("failed"),
        )
        for check in checks
    ]
    return counted.select(F.inline(F.array(*lines)))


def reasons(checks: Sequence[Expectation]) -> Column:
    """Names of the dropping expectations that a row fails; empty for a row that is kept."""
    failed = [F.when(~check.holds(), F.lit(check.name)) for check in checks if check.drop]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def metric_lines(seen: dict[str, int], dataset: str, checks: Sequence[Expectation]) -> list[tuple]:
    """The lines of :func:`metrics` from counts that a query has observed."""
    return [
        (dataset, c.name, "drop" if c.drop else "warn", seen[c.name], seen["rows_seen"] - seen[c.name]) for c in checks
    ]


METRICS = "dataset string, constraint_name string, action string, passed bigint, failed bigint"


def added_up(lines: DataFrame) -> DataFrame:
    """Metrics of several batches as one."""
    return lines.groupBy("dataset", "constraint_name", "action").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )


def rejects(rows: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """Dropped rows with the names of the expectations they failed, for a side table."""
    return rows.filter(~_accepted(checks)).withColumn("reasons", reasons(checks))
