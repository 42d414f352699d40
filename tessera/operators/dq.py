"""Data-quality checks that produce result rows (Q1-Q16).

A result row: table_name, check_name, category, severity, passed, failing, total,
rate, details. ``rate = failing / total`` when total > 0; ``details`` is JSON text
with alphabetically ordered keys and is only set when the check failed.

Row-level checks of one table (not-null, range, vocabulary, format, cross-column)
are fused into ONE aggregation pass (``row_checks``); set-level checks
(uniqueness, foreign keys) add exactly one shuffle each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.vocabularies import BLOCKING_SEVERITIES as BLOCKING
from tessera.vocabularies import DQ_CATEGORIES as CATEGORIES
from tessera.vocabularies import DQ_SEVERITIES as SEVERITIES

RESULT_COLUMNS = ("table_name", "check_name", "category", "severity", "passed", "failing",
                  "total", "rate", "details")


class DQFailure(ValueError):
    """Raised once, after all checks ran, when any blocking check failed."""


def _validate(category: str, severity: str) -> None:
    if category not in CATEGORIES:
        raise ValueError(f"Unknown DQ category: {category!r}")
    if severity not in SEVERITIES:
        raise ValueError(f"Unknown DQ severity: {severity!r}")


def details_json(fields: Mapping[str, Column]) -> Column:
    """G1: JSON text of a details dict with keys in alphabetical order."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def safe_rate(num: Column, den: Column, digits: int = 6) -> Column:
    """M1: ratio only when the denominator is positive."""
    return F.when(den > 0, F.round(num / den, digits))


def result(one_row: DataFrame, *, table_name: str, check_name: str, category: str, severity: str,
           failing: Column, total: Column, passed: Column | None = None,
           details: Mapping[str, Column] | None = None) -> DataFrame:
    """Shape a one-row aggregate into a DQ result row."""
    _validate(category, severity)
    failing = failing.cast("bigint")
    total = total.cast("bigint")
    passed = (failing == 0) if passed is None else passed
    det = details_json(details) if details else F.lit(None).cast("string")
    return one_row.select(
        F.lit(table_name).alias("table_name"), F.lit(check_name).alias("check_name"),
        F.lit(category).alias("category"), F.lit(severity).alias("severity"),
        passed.alias("passed"), failing.alias("failing"), total.alias("total"),
        safe_rate(failing, total).alias("rate"),
        F.when(~passed, det).alias("details"))


@dataclass(frozen=True)
class RowCheck:
    """A per-row failure predicate evaluated inside the fused table pass."""
    check_name: str
    category: str
    failed: Column
    severity: str = "fail"


def row_checks(df: DataFrame, table_name: str, checks: Sequence[RowCheck]) -> DataFrame:
    """Evaluate all row-level checks of one table in a single aggregate, one result row each."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    for i, c in enumerate(checks):
        _validate(c.category, c.severity)
        aggs.append(F.coalesce(F.sum(F.when(c.failed, 1).otherwise(0)), F.lit(0)).alias(f"__f{i}"))
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c.check_name).alias("check_name"), F.lit(c.category).alias("category"),
                 F.lit(c.severity).alias("severity"), F.col(f"__f{i}").cast("bigint").alias("failing"))
        for i, c in enumerate(checks)]))
    out = one.select(F.col("__total").alias("total"), rows.alias("r")).select("total", "r.*")
    return out.select(F.lit(table_name).alias("table_name"), "check_name", "category", "severity",
                      (F.col("failing") == 0).alias("passed"), "failing", "total",
                      safe_rate(F.col("failing"), F.col("total")).alias("rate"),
                      F.when(F.col("failing") > 0,
                             F.to_json(F.struct(F.col("failing").alias("failing_rows")))).alias("details"))


def not_null(cols: Sequence[str], check_name: str | None = None, severity: str = "fail") -> RowCheck:
    """Row check: any of the columns is NULL."""
    pred = None
    for c in cols:
        pred = F.col(c).isNull() if pred is None else (pred | F.col(c).isNull())
    return RowCheck(check_name or "not_null_" + "_".join(cols), "nullability", pred, severity)


def in_range(col: str, low, high, check_name: str | None = None, severity: str = "fail") -> RowCheck:
    """Row check: a non-NULL value outside [low, high]."""
    c = F.col(col)
    return RowCheck(check_name or f"range_{col}", "range", c.isNotNull() & ~c.between(low, high), severity)


def in_vocab(col: str, values: Sequence[str], check_name: str | None = None, severity: str = "fail") -> RowCheck:
    """Row check: NULL or a value outside the vocabulary."""
    c = F.col(col)
    return RowCheck(check_name or f"vocab_{col}", "business_rule", c.isNull() | ~c.isin(*values), severity)


def unique(df: DataFrame, keys: Sequence[str], *, table_name: str, check_name: str,
           severity: str = "fail") -> DataFrame:
    """Q2: failing = number of key groups holding more than one row; total = rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    one = g.agg(F.sum(F.when(F.col("__n") > 1, 1).otherwise(0)).alias("__dups"),
                F.sum("__n").alias("__rows"))
    return result(one, table_name=table_name, check_name=check_name, category="uniqueness",
                  severity=severity, failing=F.coalesce(F.col("__dups"), F.lit(0)),
                  total=F.coalesce(F.col("__rows"), F.lit(0)),
                  details={"duplicate_key_groups": F.col("__dups"),
                           "keys": F.array(*[F.lit(k) for k in keys])})


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str, *, table_name: str,
                check_name: str, severity: str = "fail") -> DataFrame:
    """failing = child rows whose key has no parent (a NULL key counts as an
    orphan); details carry the distinct orphan key count. One shuffle join."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct().withColumn("__hit", F.lit(True))
    j = child.select(key).join(p, F.col(key) == F.col("__pk"), "left")
    one = j.agg(F.sum(F.when(F.col("__hit").isNull(), 1).otherwise(0)).alias("__orph"),
                F.count(F.lit(1)).alias("__rows"),
                F.count_distinct(F.when(F.col("__hit").isNull(), F.col(key))).alias("__orph_keys"))
    return result(one, table_name=table_name, check_name=check_name, category="referential",
                  severity=severity, failing=F.coalesce(F.col("__orph"), F.lit(0)), total=F.col("__rows"),
                  details={"orphan_key_values": F.col("__orph_keys")})


def cardinality(df: DataFrame, *, table_name: str, check_name: str, min_rows: int | None = None,
                max_rows: int | None = None, severity: str = "warn") -> DataFrame:
    """Q2: row count within [min_rows, max_rows]; failing = the count when outside."""
    one = df.agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    ok = F.lit(True)
    if min_rows is not None:
        ok = ok & (n >= min_rows)
    if max_rows is not None:
        ok = ok & (n <= max_rows)
    return result(one, table_name=table_name, check_name=check_name, category="cardinality",
                  severity=severity, failing=F.when(ok, 0).otherwise(n), total=n, passed=ok,
                  details={"actual": n, "expected_max": F.lit(max_rows).cast("bigint"),
                           "expected_min": F.lit(min_rows).cast("bigint")})


def rowcount_equals(df: DataFrame, other: DataFrame, *, table_name: str, other_name: str,
                    check_name: str, severity: str = "fail") -> DataFrame:
    """Each side keeps its own filter (the two frames are filtered by the caller)."""
    both = (df.select(F.lit(1).alias("__x"), F.lit(0).alias("__y"))
            .unionByName(other.select(F.lit(0).alias("__x"), F.lit(1).alias("__y"))))
    one = both.agg(F.sum("__x").alias("__a"), F.sum("__y").alias("__b")).fillna(0)
    diff = F.abs(F.col("__a") - F.col("__b"))
    return result(one, table_name=table_name, check_name=check_name, category="referential",
                  severity=severity, failing=diff, total=F.col("__a"), passed=diff == 0,
                  details={"actual": F.col("__a"), "other": F.lit(other_name), "other_rows": F.col("__b")})


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack result frames in the canonical column order."""
    out = parts[0].select(*RESULT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*RESULT_COLUMNS))
    return out


def raise_if_blocking(results: DataFrame) -> None:
    """Q13: evaluate all checks, then raise once listing every blocking failure."""
    bad = results.filter(~F.col("passed") & F.col("severity").isin(*BLOCKING)).select(
        F.concat_ws(".", "table_name", "check_name").alias("name"))
    worst = bad.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("name")).alias("names")).first()
    if worst.n:  # one row for each declared check: their number is that of the code, not of the data
        raise DQFailure(f"{worst.n} blocking checks failed: {', '.join(worst.names)}")


class ResultLog:
    """Gathers result frames and appends them to the DQ log in ONE write.

    Used as a context manager, the buffer is flushed when the block ends — on
    success and on failure — so failed checks are persisted before the job dies.
    A flush that fails on the success path fails the job (it is never swallowed)."""

    def __init__(self, log_path: str, run_id: str, pipeline_reference: str, run_order: int | None = None):
        import time
        self.log_path = log_path
        self.run_id = run_id
        self.pipeline_reference = pipeline_reference
        self.run_order = run_order if run_order is not None else time.time_ns()  # orders runs in the log
        self._buffer: list[DataFrame] = []

    @property
    def waiting(self) -> int:
        return len(self._buffer)

    def record(self, results: DataFrame) -> None:
        missing = [c for c in RESULT_COLUMNS if c not in results.columns]
        if missing:
            raise ValueError(f"not a DQ result frame, missing {missing}")
        self._buffer.append(results.select(*RESULT_COLUMNS))

    def flush(self) -> int:
        if not self._buffer:
            return 0
        from tessera.sources import lake
        out = union_results(self._buffer).select(F.lit(self.run_id).alias("run_id"),
                                                 F.lit(self.pipeline_reference).alias("pipeline_reference"),
                                                 F.lit(self.run_order).cast("bigint").alias("run_order"),
                                                 *RESULT_COLUMNS)
        n = len(self._buffer)
        lake.append(out, self.log_path)
        self._buffer.clear()
        return n

    def __enter__(self) -> "ResultLog":
        return self

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc_type is None:
            self.flush()  # a failure here propagates
        else:
            try:
                self.flush()
            except Exception as flush_error:  # noqa: BLE001 - keep the original error primary
                exc.add_note(f"DQ flush also failed: {flush_error}")
        return False
