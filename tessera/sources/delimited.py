"""Delimited and typed-payload readers.

All reads are ``spark.read.csv`` / ``spark.read.parquet`` (distributed, splittable);
header handling and alias resolution happen on the schema, values are shaped with
column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def header_key(name: str) -> str:
    """A header reduced to its lower-case ASCII letters and digits; byte-order marks fall away with the rest."""
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())


def pick_header(headers: Iterable[str], *, exact: Iterable[str] = (), token: Iterable[str] = (),
                without: Iterable[str] = ()) -> str | None:
    """The header that fits best. Equality with an alias scores above holding a token
    (and none of ``without``); among equals the leftmost wins; no score, no header."""
    wanted, parts, barred = (set(map(header_key, x)) for x in (exact, token, without))

    def score(key: str) -> int:
        held = any(p in key for p in parts) and not any(x in key for x in barred)
        return 2 * (key in wanted) + held

    ranked = max(((score(header_key(h)), -at, h) for at, h in enumerate(headers)), default=(0, 0, None))
    return ranked[2] if ranked[0] else None


def require_columns(columns: Iterable[str], required: Iterable[str], what: str = "source") -> None:
    """P10: fail with the whole missing set, not the first miss."""
    have = {header_key(c) for c in columns}
    missing = sorted(r for r in required if header_key(r) not in have)
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def schema_problems(df: DataFrame, declared: T.StructType, *, allow_extra: bool = False) -> list[str]:
    """Q16: required columns present, types as declared, nothing unexpected."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in declared.fields:
        if f.name not in actual:
            out.append(f"missing column {f.name}")
        elif actual[f.name] != f.dataType:
            out.append(f"column {f.name} is {actual[f.name].simpleString()}, declared {f.dataType.simpleString()}")
    if not allow_extra:
        extra = sorted(set(actual) - {f.name for f in declared.fields})
        out.extend(f"unexpected column {c}" for c in extra)
    return out


def _pick(df: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """First present alias per field (case-insensitive); a missing field is ''."""
    by_norm = {}
    for c in df.columns:
        by_norm.setdefault(header_key(c), c)
    cols = []
    for out, names in fields.items():
        src = next((by_norm[header_key(n)] for n in names if header_key(n) in by_norm), None)
        val = F.coalesce(F.trim(F.col(f"`{src}`").cast("string")), F.lit("")) if src else F.lit("")
        cols.append(val.alias(out))
    return df.select(*cols)


def _not_all_blank(df: DataFrame) -> DataFrame:
    any_value = None
    for c in df.columns:
        v = F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) != ""
        any_value = v if any_value is None else (any_value | v)
    return df.filter(any_value)


def read_header_delimited(spark: SparkSession, path: str, fields: Mapping[str, Sequence[str]], *,
                          sep: str = "\t", quoted: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Header-driven delimited read. Headers match case-insensitively (a
    BOM on the first header is ignored), the first present alias wins, a missing
    column reads as '', values are trimmed, all-blank rows are dropped."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", encoding) \
                  .option("inferSchema", False).option("mode", "PERMISSIVE")
    r = r.option("quote", '"').option("escape", '"') if quoted else r.option("quote", "\u0000")
    raw = _not_all_blank(r.csv(path))
    return _pick(raw, fields)


def sniff_delimiter(spark: SparkSession, path: str, candidates: Sequence[str] = (",", "|")) -> str:
    """The candidate delimiter that occurs most in the first line."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    return max(candidates, key=lambda c: line.count(c))


def read_relationship(spark: SparkSession, path: str, fields: Mapping[str, Sequence[str]],
                      required: Sequence[str], pad: Mapping[str, int] | None = None) -> DataFrame:
    """Delimiter-sniffed file with header aliases; a required field that no
    alias resolves raises; id fields are zero-padded (strict: malformed -> NULL)."""
    from tessera.functions.codes import pad_id_strict
    sep = sniff_delimiter(spark, path)
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    present = {f for f, names in fields.items()
               if any(header_key(n) in {header_key(c) for c in raw.columns} for n in names)}
    missing = sorted(set(required) - present)
    if missing:
        raise ValueError(f"relationship file {path} lacks required fields {missing}")
    out = _pick(raw, fields)
    for f, w in (pad or {}).items():
        out = out.withColumn(f, pad_id_strict(F.col(f), w))
    return out


def read_code_map(spark: SparkSession, path: str, *, src: str, dst: str, src_width: int, dst_width: int,
                  sep: str = ",") -> DataFrame:
    """Code -> code lookup; both sides zero-padded (wider codes stay whole); other
    columns (names) are deliberately ignored; rows with a blank side are dropped."""
    from tessera.functions.codes import pad_id
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    m = _pick(raw, {"src": (src,), "dst": (dst,)})
    m = m.filter((F.col("src") != "") & (F.col("dst") != ""))
    return m.select(pad_id("src", src_width).alias("src"), pad_id("dst", dst_width).alias("dst"))


def read_cast(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-read a parquet payload and cast column by column to the declared schema."""
    df = spark.read.parquet(path)
    require_columns(df.columns, schema.fieldNames(), path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
