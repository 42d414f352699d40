"""Shared SQL fragments for oracle statements (DuckDB dialect)."""

from __future__ import annotations


def dq_row(table: str, check: str, category: str, severity: str, *, failing: str, total: str,
           source: str, details: str | None = None, passed: str | None = None) -> str:
    """SELECT producing one DQ result row from a one-row source with columns
    named by ``failing`` / ``total`` expressions."""
    passed = passed or f"({failing}) = 0"
    det = f"CASE WHEN NOT ({passed}) THEN CAST({details} AS VARCHAR) END" if details else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{category}' AS category, "
            f"'{severity}' AS severity, {passed} AS passed, CAST({failing} AS BIGINT) AS failing, "
            f"CAST({total} AS BIGINT) AS total, "
            f"CASE WHEN ({total}) > 0 THEN ROUND(CAST({failing} AS DOUBLE) / ({total}), 6) END AS rate, "
            f"{det} AS details FROM {source}")


def row_check_sql(table: str, source: str, checks: list[tuple[str, str, str, str]]) -> str:
    """checks: (check_name, category, severity, failed_predicate)."""
    aggs = ", ".join(f"COALESCE(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END), 0) AS f{i}" for i, (_, _, _, pred) in enumerate(checks))
    parts = []
    for i, (name, cat, sev, _) in enumerate(checks):
        parts.append(dq_row(table, name, cat, sev, failing=f"f{i}", total="n", source="a",
                            details=f"json_object('failing_rows', CAST(f{i} AS BIGINT))"))
    return f"WITH a AS (SELECT COUNT(*) AS n, {aggs} FROM {source}) " + " UNION ALL ".join(parts)
