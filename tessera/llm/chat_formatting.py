"""Chat formatting: multi-party perspective rotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Messages in one output row; a longer dialogue goes on in further rows.
BLOCK = 64


def rotate_perspectives(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Render every dialogue once for each participant, with that speaker as the assistant.

    The speaker's messages become ``<|assistant|>``, those of others ``<|user name=...|>``,
    system messages stay ``<|system|>`` (system is no participant). Returns per dialogue and
    speaker one row, or, past ``block`` messages, one for every part of at most ``block``:
    (``conv_col``, speaker, part, n_messages, n_masked, start, rendered, mask). ``start`` is the
    part's first character in the whole rendering; ``mask`` lists the speaker's own texts,
    those to train on, as offset:length in characters of the whole rendering, joined by commas.

    A dialogue that holds a third of all rows is split: turns are ranked inside spans of
    ``block`` turn numbers, and only blocks of bounded size are gathered. Spans and lengths
    are then summed from one row a block.

    Messages sort by turn (null last), role, text. A null role speaks as "unknown"; null text
    counts as empty; null dialogue ids form one dialogue; repeated rows are repeated messages.
    A dialogue of system messages alone, like an empty table, gives no rows.
    """
    rows = df.select(df[conv_col].alias("conv"), df[turn_col].cast("long").alias("turn"),
                     F.coalesce(df[role_col].cast("string"), F.lit("unknown")).alias("role"),
                     F.coalesce(df[text_col], F.lit("")).alias("text"))
    speakers = (rows.where("role <> 'system'").groupBy("conv", "role").agg(F.count(F.lit(1)).alias("n"))
                .select(F.col("conv").alias("c"), F.col("role").alias("speaker")))
    span = F.floor(F.col("turn") / F.lit(block))
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    ranked = (rows.withColumn("span", span)
              .withColumn("rk", F.row_number().over(Window.partitionBy("conv", "span").orderBy(*order)))
              .withColumn("cut", F.floor((F.col("rk") - 1) / F.lit(block))))

    own = F.col("role") == F.col("speaker")
    head = (F.when(own, F.lit("<|assistant|>\n")).when(F.col("role") == "system", F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), "role", F.lit("|>\n"))))
    seen = ranked.join(speakers, F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", "speaker", "span", "cut", "rk", own.alias("own"), head.alias("head"), "text")
    msgs = F.sort_array(F.collect_list(F.struct("rk", "own", "head", "text")))
    blocks = seen.groupBy("conv", "speaker", "span", "cut").agg(msgs.alias("m"))
    piece = lambda x: F.concat(x["head"], x["text"], F.lit("\n"))
    blocks = blocks.select(
        "conv", "speaker", "span", "cut", "m", F.array_join(F.transform("m", piece), "").alias("rendered"))
    blocks = blocks.withColumn("n_chars", F.char_length("rendered").cast("long"))
    line = Window.partitionBy("conv", "speaker").orderBy(F.col("span").asc_nulls_last(), "cut")
    blocks = blocks.withColumn("part", F.row_number().over(line) - 1).withColumn(
        "start", F.coalesce(F.sum("n_chars").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    # running offsets inside a block, which holds at most `block` messages
    zero = F.struct(F.col("start").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc, x):
        here = acc["at"] + F.char_length(x["head"])
        note = F.concat(here.cast("string"), F.lit(":"), F.char_length(x["text"]).cast("string"))
        return F.struct((here + F.char_length(x["text"]) + 1).alias("at"),
                        F.when(x["own"], F.concat(acc["spans"], F.array(note))).otherwise(acc["spans"]).alias("spans"))

    mask = F.aggregate("m", zero, step, lambda acc: F.array_join(acc["spans"], ","))
    return blocks.select(
        F.col("conv").alias(conv_col), "speaker", "part", F.size("m").alias("n_messages"),
        F.size(F.filter("m", lambda x: x["own"])).alias("n_masked"), "start", "rendered", mask.alias("mask"))
