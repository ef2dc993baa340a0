"""Expectations with three severities, quarantine, clean split and row-fate reconciliation.

A rule is a name and a predicate (SQL text or Column).  An *expectation* describes
what a row must satisfy; it is met only if the predicate is TRUE, so NULL violates it.
A *quarantine reason* describes a fault; it fires only if the predicate is TRUE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens import values as V
from ledgerlens.functions.columns import ColumnLike, all_hold, any_holds, holds, predicate, query_time

Rules = Mapping[str, ColumnLike]


def violation_counts(rules: Rules) -> list[Column]:
    return [F.count_if(~holds(p)).alias(name) for name, p in rules.items()]


def expect(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation | str]:
    """Warn: keep every row and count violations while the data flows by.

    Batch: read ``Observation.get`` after the action that consumes the frame.
    Stream: the returned name keys ``query.recentProgress[i].observedMetrics``.
    """
    handle = name if df.isStreaming else Observation(name)
    return df.observe(handle, *violation_counts(rules)), handle


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Drop: keep only the rows that meet every rule."""
    return df.filter(all_hold(rules.values()))


def expect_or_fail(df: DataFrame, rules: Rules, guard: str | None = None) -> DataFrame:
    """Fail: abort the job at the first violating row, without a pass of its own.

    The check is part of the ``guard`` column (default: the first one), so it runs whenever
    that column is read or written; a plan that prunes the column also prunes the check.
    The always-true partition term is nondeterministic to the optimizer and keeps it from
    moving later filters on the guard column below it, where the check would see rows that an
    earlier filter has yet to remove.
    """
    if not rules:
        return df
    guard = guard or df.columns[0]
    checked: Column | None = None
    for name, p in rules.items():
        broken = ~holds(p) if checked is not None else ~(holds(p) & (F.spark_partition_id() >= 0))
        stop = F.raise_error(F.lit(f"expectation failed: {name}")).cast(df.schema[guard].dataType)
        checked = F.when(broken, stop) if checked is None else checked.when(broken, stop)
    return df.withColumn(guard, checked.otherwise(F.col(guard)))


@dataclass(frozen=True)
class Contract:
    """The expectations of one dataset."""

    warn: Rules = field(default_factory=dict)
    drop: Rules = field(default_factory=dict)
    fail: Rules = field(default_factory=dict)
    guard: str | None = None

    @property
    def rules(self) -> dict[str, ColumnLike]:
        return {**self.fail, **self.drop, **self.warn}

    def enforce(self, df: DataFrame, fail: bool = True) -> DataFrame:
        """Apply the row-changing severities (drop, then fail)."""
        kept = expect_or_drop(df, self.drop) if self.drop else df
        return expect_or_fail(kept, self.fail, self.guard) if fail else kept

    def watch(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation | str]:
        """Count violations of every rule on ``df``, before anything is dropped."""
        return expect(df, self.rules, name)


def expectation_profile(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: how many rows passed and failed.  One pass, one aggregate."""
    counted = df.agg(
        *[F.struct(F.count_if(holds(p)).alias("passed"), F.count_if(~holds(p)).alias("failed")).alias(name)
          for name, p in rules.items()]
    )
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("c")) for n in rules])
    return counted.select(F.explode(entries).alias("e")).select("e.rule", "e.c.passed", "e.c.failed")


# -- quarantine ---------------------------------------------------------------
def failure_reasons(reasons: Rules, sep: str = ", ") -> Column:
    """Names of the reasons that fire, in the given order; empty text if none does."""
    return F.concat_ws(sep, *[F.when(predicate(p), F.lit(name)) for name, p in reasons.items()])


def null_reasons(*columns: str) -> dict[str, str]:
    return {f"null_{c}": f"{c} IS NULL" for c in columns}


def quarantine(
    df: DataFrame, reasons: Rules, layer: str | None = None, as_of: Column | datetime | None = None
) -> DataFrame:
    """Rows with at least one reason, labelled.  The filter is the plain OR of the reasons,
    so it can be pushed towards the scan; labels are built for the kept rows only."""
    out = df.filter(any_holds(reasons.values())).withColumn("failure_reasons", failure_reasons(reasons))
    if layer is not None:
        out = out.withColumn("quarantine_layer", F.lit(layer))
    return out.withColumns({"quarantine_ts": query_time(as_of), "quarantine_status": F.lit(V.PENDING)})


def clean(df: DataFrame, predicates: Sequence[ColumnLike] | Rules) -> DataFrame:
    """Rows for which every predicate is TRUE."""
    preds = predicates.values() if isinstance(predicates, Mapping) else predicates
    return df.filter(all_hold(preds))


def with_fate(df: DataFrame, predicates: Rules, reasons: Rules) -> DataFrame:
    """Add ``row_fate``: what the clean filter and the quarantine do with each row together."""
    is_clean = all_hold(predicates.values())
    is_held = any_holds(reasons.values())
    fate = (
        F.when(is_clean & is_held, "both")
        .when(is_clean, "clean")
        .when(is_held, "quarantine")
        .otherwise("unaccounted")
    )
    return df.withColumn("row_fate", fate)


def row_fate(df: DataFrame, predicates: Rules, reasons: Rules) -> DataFrame:
    """Row count per fate; every input row is in exactly one."""
    return with_fate(df, predicates, reasons).groupBy("row_fate").agg(F.count("*").alias("row_count"))


def quarantine_pct(q: ColumnLike, total: ColumnLike, scale: int = 4) -> Column:
    q, total = (F.col(c) if isinstance(c, str) else c for c in (q, total))
    return F.when(total > 0, F.round(q / F.nullif(total, F.lit(0)) * 100, scale)).otherwise(F.lit(0.0))
