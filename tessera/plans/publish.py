"""Gated publish (U10): stage, validate, publish only without blocking failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import dq
from tessera.sources import lake


def publish(spark: SparkSession, frame: DataFrame, checks: Callable[[DataFrame], DataFrame], *, published: str,
            dq_log: str, run_id: str, raise_on_block: bool = True,
            on_published: Callable[[str], None] | None = None) -> bool:
    """Write the frame once, as a version folder that no pointer names; run the checks on it,
    append their results to the DQ log (on success and on failure), and add the pointer
    only when no blocking check of this run failed. A second try under the same run id is
    judged by its own results alone."""
    version = lake.write_version(spark, frame, published)
    written = spark.read.parquet(version)
    results = checks(written).checkpoint()  # judged and logged from one evaluation
    with dq.ResultLog(dq_log, run_id, "gated_publish") as log:  # persisted either way
        log.record(results)
    if not results.filter(~F.col("passed") & F.col("severity").isin(*dq.BLOCKING)).isEmpty():
        if raise_on_block:
            dq.raise_if_blocking(results)
        return False
    lake.point_to(spark, published, version)
    if on_published is not None:  # registration happens only after a successful publish
        on_published(version)
    return True
