"""Preference formatting: chosen and rejected conversations as one prompt and two
masked completions.

The prompt is the longest common prefix of turns: all turns before the first turn
number at which the two sides differ in role or text. It is rendered once; what follows is rendered
for each side. A row of the result is one rendered turn of a part
('prompt', 'chosen', 'rejected') with its loss mask: only assistant turns of a completion
are trained on. A conversation is never gathered into one row, so its length is free;
``rendered`` makes one text of each part for conversations that fit in a row.

DataFrame functions only: one aggregate marks on which sides a turn stands, one
finds where the sides part, and a join brings that to the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.llm.common import table

# Turn markers of the chat format
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def _side(turns: DataFrame, pair: Column, side: int, turn: str, role: str, text: str) -> DataFrame:
    """Null turns come before all others; a null role or text is empty."""
    first = F.coalesce(F.col(turn).cast("long"), F.lit(-(2**63)))
    return turns.select(pair.alias("pair_id"), first.alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.lit(side).alias("side"))


def preference_turns(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(pair_id, part, turn, role, segment, masked, status).

    ``masked`` is true where no loss is taken. ``status`` is 'pair', 'same' (no turn
    differs: all is prompt), 'chosen only' or 'rejected only' (no turn of the other side: no
    prompt). Repeated rows of a turn count once; of a turn number with several rows all must be equal
    on both sides; rows without a pair id belong to no pair and are left out; empty
    tables give an empty result."""
    c, r = _side(chosen, F.col(pair), 0, turn, role, text), _side(rejected, F.col(pair), 1, turn, role, text)
    return _format(c.union(r).where("pair_id is not null"))


def _format(sides: DataFrame) -> DataFrame:
    on = [F.max((F.col("side") == k).cast("int")).alias(name) for k, name in ((0, "in_chosen"), (1, "in_rejected"))]
    turns = sides.groupBy("pair_id", "turn", "role", "text").agg(*on)
    differs = F.col("in_chosen") + F.col("in_rejected") < 2
    pairs = turns.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("parts_at"), F.max("in_chosen").alias("c"), F.max("in_rejected").alias("r"))
    status = F.when(F.col("r") == 0, "chosen only").when(F.col("c") == 0, "rejected only").when(F.col("parts_at").isNull(), "same").otherwise("pair")
    both = turns.join(pairs.select("pair_id", "parts_at", status.alias("status")), "pair_id")
    prompt = F.col("parts_at").isNull() | (F.col("turn") < F.col("parts_at"))
    completions = F.filter(F.array(F.when(F.col("in_chosen") == 1, F.lit("chosen")), F.when(F.col("in_rejected") == 1, F.lit("rejected"))), lambda x: x.isNotNull())
    part = F.explode(F.when(prompt, F.array(F.lit("prompt"))).otherwise(completions)).alias("part")
    segment = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    rows = both.select("pair_id", part, "turn", "role", segment.alias("segment"), "status")
    return rows.select("pair_id", "part", "turn", "role", "segment", ((F.col("part") == "prompt") | (F.col("role") != TRAINED)).alias("masked"), "status")


def rendered(turns: DataFrame) -> DataFrame:
    """(pair_id, part, text, trained): one text for each part and the (start, length) of its
    trained characters. For parts that fit in a row."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "segment", "masked")))
    parts = turns.groupBy("pair_id", "part").agg(ordered.alias("s"))
    step = F.aggregate(
        "s",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["segment"])).alias("at"),
            F.when(x["masked"], a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(x["segment"]).alias("length"))))).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return parts.select("pair_id", "part", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("text"), step.alias("trained"))


def op1_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation 2k is taken as chosen, 2k + 1 as rejected, of pair k."""
    conv = table(spark, sf_dir, "conversations")
    side = F.pmod("conv_id", F.lit(2))
    turns = conv.withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    return preference_turns(turns.where(side == 0), turns.where(side == 1))


QUERIES = {"op1_preference_chat": op1_preference_chat}
ORACLE = {
    "op1_preference_chat": f"""
WITH t AS (
  SELECT floor(conv_id / 2)::BIGINT AS pair_id, coalesce(turn, -9223372036854775808) AS turn, coalesce(role, '') AS role,
    coalesce(text, '') AS text, max((conv_id % 2 = 0)::INT) AS c, max((conv_id % 2 <> 0)::INT) AS r
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL),
p AS (SELECT pair_id, min(turn) FILTER (WHERE c + r < 2) AS parts_at, max(c) AS cs, max(r) AS rs FROM t GROUP BY pair_id),
j AS (
  SELECT t.*, parts_at, CASE WHEN rs = 0 THEN 'chosen only' WHEN cs = 0 THEN 'rejected only' WHEN parts_at IS NULL THEN 'same' ELSE 'pair' END AS status
  FROM t JOIN p USING (pair_id)),
s AS (
  SELECT *, 'prompt' AS part FROM j WHERE parts_at IS NULL OR turn < parts_at
  UNION ALL SELECT *, 'chosen' FROM j WHERE turn >= parts_at AND c = 1
  UNION ALL SELECT *, 'rejected' FROM j WHERE turn >= parts_at AND r = 1)
SELECT pair_id, part, turn, role, '{START}' || role || chr(10) || text || '{END}' || chr(10) AS segment,
  part = 'prompt' OR role <> '{TRAINED}' AS masked, status FROM s"""
}
