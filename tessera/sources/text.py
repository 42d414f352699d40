"""Line-oriented text sources: positional, fixed-width, code/title, headers, links
(S4-S7, S10-S12). Each parser takes a DataFrame of lines (column ``value``, as
``spark.read.text`` yields) and returns typed columns — split/substring/regex
expressions, no Python per line."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select(F.col("value").cast("string")).write.mode("overwrite").text(path)


def positional_split(lines: DataFrame, positions: Mapping[str, int], *, sep: str = "|",
                     min_fields: int = 0, where: Column | None = None) -> DataFrame:
    """Headerless delimited rows picked by position; short rows skipped."""
    parts = F.split(F.col("value"), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    df = lines.select(parts.alias("__f")).filter(F.size("__f") > min_fields)
    df = df.select(*[F.get(F.col("__f"), i).alias(name) for name, i in positions.items()])
    return df.filter(where) if where is not None else df


def fixed_width(lines: DataFrame, spans: Mapping[str, tuple[int, int | None]], *, min_len: int = 0) -> DataFrame:
    """Fixed-width columns by (1-based start, length or None for rest-of-line);
    lines shorter than ``min_len`` are skipped."""
    v = F.col("value")
    df = lines.filter(F.length(v) >= min_len)
    cols = []
    for name, (start, length) in spans.items():
        cols.append((F.substring(v, start, length) if length else F.expr(f"substring(value, {start})")).alias(name))
    return df.select(*cols)


def strict_flag(flag: Column, what: str = "flag") -> Column:
    """A '0'/'1' flag as boolean; any other value fails the job (naming it)."""
    return F.when(flag.isin("0", "1"), flag == "1").otherwise(
        F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(flag, F.lit("NULL")))).cast("boolean"))


def code_title(lines: DataFrame, code_pattern: str) -> DataFrame:
    """Keep lines shaped ``<code> <title>`` (banners and notes fail the pattern)."""
    pat = rf"^\s*({code_pattern})\s+(\S.*?)\s*$"
    v = F.col("value")
    return lines.filter(v.rlike(pat)).select(F.regexp_extract(v, pat, 1).alias("code"),
                                             F.regexp_extract(v, pat, 2 + code_pattern.count("(") - code_pattern.count("(?")).alias("title"))


def carry_forward(df: DataFrame, group: Sequence[str], order: str, header: Column, reset: Column,
                  out: str = "header", bucket_size: int = 100_000) -> DataFrame:
    """Carry the latest header down onto following lines; a reset line clears it.

    Each header or reset line is an event; a line takes the latest event at or
    before it. Lines are windowed per (file, line bucket), so one huge file is split
    across tasks; a line with no event yet in its bucket takes the last event of the
    nearest earlier bucket, read from a per-(file, bucket) aggregate."""
    otype = df.schema[order].dataType
    ev = (F.when(header, F.struct(F.lit(True).alias("h"), F.col(order).alias("v")))
           .when(reset, F.struct(F.lit(False).alias("h"), F.lit(None).cast(otype).alias("v"))))
    d = df.withColumn("__ev", ev).withColumn("__b", F.floor(F.col(order) / bucket_size))
    w = Window.partitionBy(*group, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__in", F.last("__ev", ignorenulls=True).over(w))
    ends = d.groupBy(*group, "__b").agg(F.max_by("__ev", F.when(F.col("__ev").isNotNull(), F.col(order))).alias("__end"))
    wb = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__link", F.last("__end", ignorenulls=True).over(wb)).drop("__end")
    d = d.join(ends, [*group, "__b"], "left")
    e = F.coalesce(F.col("__in"), F.col("__link"))
    return d.withColumn(out, F.when(e["h"], e["v"])).drop("__ev", "__b", "__in", "__link")


def extract_links(html: Column, *, drop_parents: bool = True) -> Column:
    """Href targets in document order, query/fragment stripped, parent links and blanks
    dropped, duplicates removed keeping the first occurrence."""
    raw = F.regexp_extract_all(html, F.lit(r'(?i)\bhref="([^"]*)"'), 1)
    cleaned = F.transform(raw, lambda x: F.regexp_replace(x, r"[?#].*$", ""))
    keep = F.filter(cleaned, lambda x: (x != "") & (~x.startswith("..") if drop_parents else F.lit(True)))
    return F.array_distinct(keep)


def listed_files(html: Column, suffix: str) -> Column:
    """The files of one kind (``.csv``, any case) that a directory page links to, in
    document order without repeats. Only bare file names count: a link with a path or a
    query names something else. The attribute name may be of any case."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(rf'(?i)\bhref="([^"?/#]+{re.escape(suffix)})"'), 1))


def name_fields(name: Column, pattern: str, fields: Mapping[str, int]) -> list[Column]:
    """Fields of a file/URL name by regex group; NULL for every field when the
    name does not match (callers drop those rows)."""
    ok = name.rlike(pattern)
    return [F.when(ok, F.regexp_extract(name, pattern, g)).alias(f) for f, g in fields.items()]


# Wide daily rows have 6 key fields then 31 day fields; values at or
# below the sentinel threshold mean "missing".
WIDE_KEY_FIELDS = ("region_type", "region_code", "region_name", "year", "month", "variable")
WIDE_DAY_FIELDS = 31
SENTINEL_AT_OR_BELOW = -999.0


def wide_day_lines(lines: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Headerless wide rows (6 keys + 31 days) -> one row per real day.

    Blank lines are skipped; any other line must have exactly 37 fields or the job
    fails naming the line; days past the month end are dropped; sentinel values
    become NULL rows. Quoted fields may contain commas."""
    from tessera.operators.reshape import wide_days_to_long
    names = [*WIDE_KEY_FIELDS, *[f"d{d}" for d in range(1, WIDE_DAY_FIELDS + 1)]]
    schema = ", ".join(f"{c} string" for c in names)
    keep = ["source_file"] if source_file is not None else []
    body = lines.filter(F.trim("value") != "").select("value", *([source_file.alias("source_file")] if keep else []))
    bare = F.regexp_replace("value", r'"[^"]*"', "")  # commas inside quotes do not count
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(names)} fields, got "), n_fields.cast("string"), F.lit(": "), F.substring("value", 1, 80)))
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "escape": '"'}
    line = F.when(n_fields == len(names), F.col("value")).otherwise(wrong.cast("string"))
    checked = body.select(*keep, F.from_csv(line, schema, options).alias("__f"))
    # values stay text until days past the month's end, which may be blank, are gone
    keyed = checked.select(*[F.col("__f")[k].alias(k) for k in names], *keep)
    keyed = keyed.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int")) \
                 .withColumn("variable", F.lower("variable"))
    ids = ["region_type", "region_code", "region_name", "variable"] + (["source_file"] if source_file is not None else [])
    days = wide_days_to_long(keyed, ids, "year", "month", names[len(WIDE_KEY_FIELDS):],
                             is_sentinel=lambda x: x.cast("double") <= SENTINEL_AT_OR_BELOW)
    return days.withColumn("value", F.col("value").cast("double"))


# File-name pattern of wide daily files and the fields it carries.
WIDE_FILE_PATTERN = r"^(prcp|tavg|tmax|tmin)-(\d{4})(\d{2})-([a-z0-9]{2,3})-(scaled|prelim)\.csv$"
WIDE_FILE_FIELDS = {"variable": 1, "year": 2, "month": 3, "region_type": 4, "status": 5}
