"""Declarative data checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

@dataclass(frozen=True)
class Check:
    """A row-level check: rows for which ``fails`` is true are failures."""

    name: str
    column: str
    fails: Column


def not_null_check(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def accepted_values_check(column: str, values: Sequence[str]) -> Check:
    """NULL passes."""
    c = F.col(column)
    return Check("accepted_values", column, c.isNotNull() & ~c.isin(*values))


def row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of a table in one pass: one aggregate, then one row per check."""
    counts = df.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)])
    return _one_row_per_check(counts, [(c.name, c.column) for c in checks])


def _one_row_per_check(counts: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, (name, column) in enumerate(checks)
    ])
    return counts.select(F.inline(rows))


def keyed_checks(df: DataFrame, key: str, checks: Sequence[Check]) -> DataFrame:
    """The unique check of ``key`` and all row-level checks in one evaluation of ``df``.

    For lazy models: they are computed once, and one that is already
    partitioned by its key is grouped without another shuffle.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.count_if(c.fails).alias(f"k{i}") for i, c in enumerate(checks, 1)],
    )
    repeated = F.col(key).isNotNull() & (F.col("n") > 1)
    counts = per_key.agg(
        F.count_if(repeated).alias("c0"),
        *[F.coalesce(F.sum(f"k{i}"), F.lit(0)).alias(f"c{i}") for i in range(1, len(checks) + 1)],
    )
    return _one_row_per_check(counts, [("unique", key), *((c.name, c.column) for c in checks)])


def failing_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    return failing_keys(df, column).agg(F.count("*").alias("failures")).select(
        F.lit("unique").alias("check_name"), F.lit(column).alias("column_name"), "failures"
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return row_checks(df, [not_null_check(c) for c in columns])


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return row_checks(df, [accepted_values_check(column, values)])


def payment_cap_check(cap: float = 1.1) -> Check:
    """A payment above ``cap`` times the order total. No payment, no failure."""
    over = F.col("payment_amount_vnd") > F.col("total_vnd") * F.lit(cap)
    return Check("payment_not_exceeds_order", "payment_amount_vnd", over)


def positive_revenue_check(floor: int = 0) -> Check:
    """An order total below ``floor``."""
    return Check("positive_revenue", "total_vnd", F.col("total_vnd") < F.lit(floor))


def valid_status_check(values: Sequence[str]) -> Check:
    return Check("valid_order_status", "order_status", ~F.col("order_status").isin(*values))


def failures(df: DataFrame, check: Check) -> DataFrame:
    """Singular form: one row with the count when there are failures, else no row."""
    counted = df.where(check.fails).agg(F.count("*").alias("failures"))
    return counted.where(F.col("failures") > 0)


@dataclass(frozen=True)
class ModelChecks:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    #: Makers of further row checks; columns are built only when the checks run.
    extra: tuple[Callable[[], Check], ...] = ()
    #: A lazy model, worth a wider grouping to be evaluated once only. A stored
    #: table is rather read twice, with the key alone in the shuffle.
    lazy: bool = False

    def rows(self) -> list[Check]:
        return [
            *(not_null_check(c) for c in self.not_null),
            *(accepted_values_check(c, v) for c, v in self.accepted),
            *(make() for make in self.extra),
        ]


def run_checks(models: dict[str, DataFrame], spec: dict[str, ModelChecks]) -> DataFrame:
    """One row per check over all models; lazy models are evaluated once."""
    parts = []
    for model, checks in spec.items():
        df = models[model]
        if checks.lazy and len(checks.unique) == 1:
            found = [keyed_checks(df, checks.unique[0], checks.rows())]
        else:
            found = [unique(df, c) for c in checks.unique]
            if checks.rows():
                found.append(row_checks(df, checks.rows()))
        parts.extend(f.withColumn("model", F.lit(model)) for f in found)
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        "check_name", "model", "column_name", "failures",
        (F.col("failures") == 0).alias("passed"),
    )


class ChecksFailed(AssertionError):
    pass


def assert_checks(report: DataFrame) -> int:
    """Fail when any check failed; returns the number of checks. The report has one row each."""
    rows = report.collect()
    broken = [f"{r.model}.{r.column_name} {r.check_name}: {r.failures}"
              for r in rows if not r.passed]
    if broken:
        raise ChecksFailed("; ".join(sorted(broken)))
    return len(rows)
