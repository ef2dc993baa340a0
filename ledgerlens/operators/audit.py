"""Run-level audits and gates.

An audit is a one-row DataFrame.  Its parts are one-row aggregates over different
inputs, put side by side by ``combine_scalars``; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import any_holds, json_list, json_map
from ledgerlens.operators.relational import count_rows, latest, top_k


def combine_scalars(*one_row: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side.

    A union of single rows and one aggregate: no join is involved, and the result is one
    row whatever the inputs hold.
    """
    names = [c for df in one_row for c in df.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def top_reasons(held: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent failure reasons as rows (failure_reasons, count)."""
    counted = held.groupBy("failure_reasons").agg(F.count("*").alias("count"))
    return top_k(counted, [F.desc("count"), F.asc("failure_reasons")], k)


def held_summary(
    held: DataFrame,
    rows: str = "quarantine_rows",
    top: str = "top_failure_reasons",
    k: int = 5,
    count_name: str = "count",
) -> DataFrame:
    """Quarantine size and ``top_reasons`` as one JSON cell (``[]`` if empty), in one scan.

    The rows are first counted per label.  Labels are combinations of a fixed set of reasons, so
    the list that is sorted has a size that does not depend on the data.
    """
    counted = held.groupBy("failure_reasons").agg(F.count("*").alias("n"))
    rank = F.struct((-F.col("n")).alias("n"), F.col("failure_reasons"))
    cell = json_list(rank, F.col("failure_reasons"), F.col("n").alias(count_name), limit=k)
    return scalars(counted, **{rows: F.coalesce(F.sum("n"), F.lit(0)), top: cell})


def distribution(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Row count per value of a category column, as rows; NULL is written ``NULL``."""
    key = F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias(column)
    return count_rows(df.select(key), [column], count_name)


#: Entries of a JSON cell, characters of a value in it, and the entry for all values that have none.
CELL_ENTRIES, CELL_CHARS, OTHERS = 1000, 100, "(others)"


def bounded(counted: DataFrame, key: str, count: str, entries: int = CELL_ENTRIES, sums: Sequence[str] = ()) -> DataFrame:
    """At most ``entries`` + 1 rows of a table with a row per value: the most frequent ones (of equally frequent ones the smaller values),
    and one row ``OTHERS`` with the sums of all others.

    Values are cut to ``CELL_CHARS`` characters and NULL is written ``NULL``; values that are then alike are one row.  The counts of the
    rows add up to those of the table.  The choice is a distributed top-k; the table is scanned once, as both uses
    share its exchange.
    """
    added = [F.sum(c).alias(c) for c in dict.fromkeys((count, *sums))]
    short = F.substring(F.coalesce(F.col(key).cast("string"), F.lit("NULL")), 1, CELL_CHARS)
    rows = counted.select(short.alias(key), *dict.fromkeys((count, *sums))).groupBy(key).agg(*added)
    most = rows.orderBy(F.desc(count), key).limit(entries).select(F.col(key).alias("_kept"))
    named = rows.join(F.broadcast(most), F.col(key) == F.col("_kept"), "left")
    return named.groupBy(F.coalesce("_kept", F.lit(OTHERS)).alias(key)).agg(*added)


def distribution_json(df: DataFrame, column: str, alias: str, rows: str | None = None, entries: int = CELL_ENTRIES) -> DataFrame:
    """``distribution`` as one JSON cell and, if ``rows`` is given, the row total; in one scan.

    The cell has the ``entries`` most frequent values and one entry for all others, so that its size does not depend on the data.
    """
    counted = bounded(distribution(df, column), column, "count", entries)
    total = {rows: F.coalesce(F.sum("count"), F.lit(0))} if rows else {}
    return scalars(counted, **{alias: json_map(column, "count"), **total})


def audit_status(fail_when: Sequence[Column]) -> Column:
    """FAIL if any condition is TRUE, else PASS."""
    return F.when(any_holds(fail_when), "FAIL").otherwise("PASS")


class AuditGateError(AssertionError):
    """The latest audit row does not allow the run to continue."""


def gate_checks(
    audit: DataFrame,
    max_quarantine_pct: float = 5.0,
    require_pass: bool = False,
    require_no_sanctioned: bool = False,
    order: str = "run_ts",
) -> DataFrame:
    """The gate as rows (check, passed), evaluated on the latest audit row."""
    checks = {"has_rows": F.col("total_rows") > 0, "quarantine_rate": F.col("quarantine_pct") <= max_quarantine_pct}
    if require_no_sanctioned:
        checks["no_sanctioned"] = F.col("sanctioned_count") == 0
    if require_pass:
        checks["status_pass"] = F.col("audit_status") == "PASS"
    rows = [F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()]
    return latest(audit, order).select(F.explode(F.array(*rows)).alias("r")).select("r.check", "r.passed")


def check_audit(audit: DataFrame, **gate) -> None:
    """Raise unless every check passes.  Reads at most one row per check."""
    outcome = gate_checks(audit, **gate).collect()
    failed = [r["check"] for r in outcome if not r["passed"]]
    if not outcome:
        raise AuditGateError("no audit row")
    if failed:
        raise AuditGateError("audit gate failed: " + ", ".join(failed))


def scalars(df: DataFrame, **metrics: Column) -> DataFrame:
    """One-row aggregate with named metrics."""
    return df.agg(*[m.alias(n) for n, m in metrics.items()])
