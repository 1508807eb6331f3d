"""Chat formatting by rotating the perspective of a dialogue with several parties.

For every participant the whole dialogue is rendered with that speaker as the assistant and all others as
named users; the mask spans what the assistant says, with its end marker. The system isn't a participant
and keeps its own marker.

A rendering comes in pieces of ``PIECE`` messages, each with the place of its first character: in order of
piece they concatenate to the rendering, so the longest dialogue is never gathered at once. Messages
are numbered through their dialogue by a sort over ranges of (dialogue, turn, speaker, text), which
deals a dialogue of any length, or any number of equal messages, over many tasks; places come from
sums over blocks of pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.plans.materialize import materialize

PIECE, BLOCK, SALT = 256, 1024, 16
SYSTEM, UNKNOWN, END = "system", "unknown", "<|end|>\n"


def _numbered(said: DataFrame) -> DataFrame:
    """``said`` with at, the place of each message in its dialogue from 0 on."""
    # the row's number splits equal messages, of which any order will do
    order = ["conv_id", "turn", "speaker", "said", "row"]
    parts = int(said.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = said.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    dealt = materialize(dealt.withColumn("task", F.spark_partition_id()))
    own = F.row_number().over(Window.partitionBy("task", "conv_id").orderBy(*order[1:])) - 1
    counts = dealt.groupBy("task", "conv_id").agg(F.count("*").alias("n"))
    before = counts.select("task", F.col("conv_id").alias("c"), (F.sum("n").over(Window.partitionBy("conv_id").orderBy("task")) - F.col("n")).alias("before"))
    spread = before.where("before > 0")  # a dialogue goes on in few tasks
    numbered = dealt.withColumn("own", own).join(spread.withColumnRenamed("task", "t"), (F.col("task") == F.col("t")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return numbered.withColumn("at", (F.col("own") + F.coalesce("before", F.lit(0))).cast("long")).drop("own", "before", "t", "c", "row", "task")


def rotate(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, piece, start, n_turns, rendered, mask) for each participant of each dialogue.

    turns: conv_id, turn, role, text; other columns are unused. Messages are ordered by turn (null first),
    speaker and text, and repeated rows are messages of their own. A null text is empty, a null role the
    speaker "unknown", a null conv_id a dialogue like others. "<|" in a text and any of "<|>" or line breaks in
    a name can't pass for markers. Dialogues of the system alone and empty tables give no rows. start: code
    points of the rendering before the piece; mask: [start, end) in code points of the whole rendering.
    """
    speaker = F.regexp_replace(F.coalesce("role", F.lit(UNKNOWN)), "[<|>\\n\\r]", "_")
    said = turns.select("conv_id", "turn", speaker.alias("speaker"), F.regexp_replace(F.coalesce("text", F.lit("")), "<\\|", "< |").alias("said"))
    said = _numbered(said).withColumn("piece", F.floor(F.col("at") / PIECE).cast("long"))
    messages = said.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list(F.struct("at", "speaker", "said"))).alias("messages"))
    who = said.where(F.col("speaker") != SYSTEM).groupBy("conv_id", "speaker").agg(F.max("piece").alias("_"))
    # a long dialogue meets its participants in runs of pieces
    runs = said.groupBy("conv_id").agg(F.floor(F.max("piece") / SALT).alias("runs"))
    who = who.join(runs.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    who = who.select(F.col("conv_id").alias("who_conv"), F.col("speaker").alias("perspective"), F.explode(F.sequence(F.lit(0).cast("long"), "runs")).alias("run"))
    each = messages.join(who, F.col("conv_id").eqNullSafe(F.col("who_conv")) & (F.floor(F.col("piece") / SALT) == F.col("run")))
    shown = F.transform("messages", lambda m: F.struct(_head(m["speaker"]).alias("head"), m["said"].alias("said"), (m["speaker"] == F.col("perspective")).alias("own")))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("spans"))

    def step(done: Column, m: Column) -> Column:
        a = done["at"] + F.length(m["head"])
        b = a + F.length(m["said"]) + len(END) - 1
        return F.struct((b + 1).alias("at"), F.when(m["own"], F.array_append(done["spans"], F.array(a, b))).otherwise(done["spans"]).alias("spans"))

    pieces = materialize(each.withColumn("shown", shown).select(
        "conv_id", "perspective", "piece", F.floor(F.col("piece") / BLOCK).alias("block"), F.size("shown").cast("long").alias("n_turns"),
        F.array_join(F.transform("shown", lambda m: F.concat(m["head"], m["said"], F.lit(END))), "").alias("rendered"),
        F.aggregate("shown", begin, step, lambda done: done["spans"]).alias("mask"),
    ).withColumn("chars", F.length("rendered").cast("long")))
    rendering = ["conv_id", "perspective"]
    sums = pieces.groupBy(*rendering, "block").agg(F.sum("chars").alias("sum"))
    blocks = sums.withColumn("before", F.sum("sum").over(Window.partitionBy(*rendering).orderBy("block")) - F.col("sum")).where("block > 0")
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), "before")
    within = F.sum("chars").over(Window.partitionBy(*rendering, "block").orderBy("piece")) - F.col("chars")
    placed = pieces.withColumn("within", within).join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b")), "left")
    placed = placed.withColumn("start", F.col("within") + F.coalesce("before", F.lit(0)))
    mask = F.transform("mask", lambda s: F.transform(s, lambda x: x + F.col("start")))
    return placed.select(*rendering, "piece", "start", "n_turns", "rendered", mask.alias("mask"))


def _head(speaker: Column) -> Column:
    return (
        F.when(speaker == F.col("perspective"), F.lit("<|assistant|>\n"))
        .when(speaker == SYSTEM, F.lit("<|system|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>\n")))
    )


def query(turns: DataFrame) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ",")
    return rotate(turns).select(
        "conv_id", "perspective", "piece", "start", "n_turns", F.size("mask").cast("long").alias("n_own"),
        F.length("rendered").cast("long").alias("n_chars"), F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"), spans.alias("mask"),
    )


ORACLE_SQL = """
WITH said AS (
  SELECT conv_id, turn, regexp_replace(coalesce(role, 'unknown'), '[<|>\\n\\r]', '_', 'g') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, said) - 1 AS place FROM said),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
shown AS (
  SELECT s.*, s.place // 256 AS piece, w.perspective, s.speaker = w.perspective AS own,
         CASE WHEN s.speaker = w.perspective THEN '<|assistant|>' || chr(10)
              WHEN s.speaker = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || s.speaker || '|>' || chr(10) END AS head
  FROM numbered s JOIN who w ON s.conv_id IS NOT DISTINCT FROM w.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(said) + 8) OVER (PARTITION BY conv_id, perspective ORDER BY place ROWS UNBOUNDED PRECEDING) AS after
  FROM shown)
SELECT conv_id, perspective, piece, CAST(min(after - length(head) - length(said) - 8) AS BIGINT) AS start, count(*) AS n_turns,
       CAST(sum(CASE WHEN own THEN 1 ELSE 0 END) AS BIGINT) AS n_own,
       CAST(sum(length(head) + length(said) + 8) AS BIGINT) AS n_chars,
       sha256(string_agg(head || said || '<|end|>' || chr(10), '' ORDER BY place)) AS rendered_sha256,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(after - 8 - length(said) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(after - 1 AS BIGINT) AS VARCHAR) END, ',' ORDER BY place), '') AS mask
FROM placed GROUP BY conv_id, piece, perspective
"""
