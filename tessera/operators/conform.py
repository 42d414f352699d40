"""Conformance of codes to shared dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform_distinct(fact: DataFrame, code_cols: Sequence[str], conform: Callable[[DataFrame], DataFrame],
                     out_col: str) -> DataFrame:
    """Conform each distinct code combination once, then join the result back.

    ``conform(distinct_codes_df) -> df(code_cols..., out_col)`` is a column-level
    transformation (lookup joins, overrides, regex guards) run on the distinct codes
    only. The distinct is a partial-aggregated shuffle; the join back is planned by
    AQE from the measured size of the conformed map (a few thousand codes become a
    broadcast at runtime; an unexpectedly large map stays a shuffle join)."""
    codes = fact.select(*code_cols).distinct()
    conformed = conform(codes).select(*[F.col(c).alias(f"__c_{c}") for c in code_cols], out_col)
    cond = [F.col(c).eqNullSafe(F.col(f"__c_{c}")) for c in code_cols]
    return fact.join(conformed, cond, "left").drop(*[f"__c_{c}" for c in code_cols])


def unconformed(conformed_fact: DataFrame, code_cols: Sequence[str], out_col: str) -> DataFrame:
    """The distinct codes that did not conform (returned alongside, never dropped silently)."""
    return conformed_fact.filter(F.col(out_col).isNull()).select(*code_cols).distinct()


def whitelist(c: Column, allowed: Sequence[str]) -> Column:
    """Out-of-vocabulary -> NULL."""
    return F.when(c.isin(*allowed), c)


def conform_region(df: DataFrame, type_col: str, code_col: str, state_map: DataFrame,
                   overrides: dict[str, str], out_col: str = "geoid") -> DataFrame:
    """region code -> geoid. ``state_map(src, dst)`` maps the 2-digit state
    prefix; a county keeps its 3-digit suffix; listed county overrides win; an
    unmapped prefix or a malformed suffix gives NULL (for a blocking DQ check)."""
    code = F.trim(F.col(code_col))
    m = state_map.groupBy(F.col("src").alias("__src")).agg(F.min("dst").alias("__fips"))  # one row a code
    j = df.join(m, F.substring(code, 1, 2) == F.col("__src"), "left")
    suffix = F.substring(code, 3, 3)
    ov = F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv]) if overrides else None
    t = F.col(type_col)
    val = (F.when(t == "ste", F.col("__fips"))
           .when((t == "cty") & F.col("__fips").isNotNull() & suffix.rlike(r"^[0-9]{3}$"), F.concat(F.col("__fips"), suffix)))
    if ov is not None:
        val = F.when((t == "cty") & ov[code].isNotNull(), ov[code]).otherwise(val)
    return j.withColumn(out_col, val).drop("__src", "__fips")
