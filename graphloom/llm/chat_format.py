"""Preference formatting: the common turns of two conversations as one prompt, and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions.checkpoints import checkpoint
from graphloom.llm.common import partitions, table

TRAINED = "assistant"


def _render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))
    return F.array_join(F.transform(turns, one), "")


def _mask(turns: Column, trained: str) -> Column:
    """[from, to) in characters of the rendered turns for each turn of the trained role: its text and end mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(held: Column, t: Column) -> Column:
        begin = held["at"] + F.length(t["role"]) + 5
        end = begin + F.length(t["text"]) + 7
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == trained, F.concat(held["spans"], span)).otherwise(held["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda held: held["spans"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", trained: str = TRAINED) -> DataFrame:
    """``pairs`` with ``n_prompt`` (turns in common), ``prompt``, ``chosen_text``, ``rejected_text`` and their masks.

    ``chosen`` and ``rejected`` are arrays of (role, text). The longest common prefix is rendered once, as the prompt;
    the masks mark what a model is trained on, the texts of the trained role with their end marks. If one side is null
    there is no pair: nothing is common, and the null side's text and mask are null. Equal sides leave empty completions.
    Columns named as an output are replaced, others kept; each row is judged alone.
    """
    c, r = F.col(chosen), F.col(rejected)
    shorter = F.least(F.size(c), F.size(r))
    same = F.transform(F.sequence(F.lit(1), shorter), lambda i: F.get(c, i - 1).eqNullSafe(F.get(r, i - 1)))
    differs = F.array_position(same, False).cast("int")
    common = F.when(c.isNull() | r.isNull(), 0).when(shorter == 0, 0).when(differs == 0, shorter).otherwise(differs - 1)
    out = pairs.withColumn("n_prompt", common)
    rest = lambda x: F.slice(x, F.col("n_prompt") + 1, F.greatest(F.size(x) - F.col("n_prompt"), F.lit(0)))
    prompt = F.coalesce(_render(F.slice(F.coalesce(c, r), F.lit(1), F.col("n_prompt"))), F.lit(""))
    out = out.withColumn("prompt", prompt).withColumn("__gl_c", rest(c)).withColumn("__gl_r", rest(r))
    out = out.withColumn("chosen_text", _render(F.col("__gl_c"))).withColumn("rejected_text", _render(F.col("__gl_r")))
    return out.withColumn("chosen_mask", _mask(F.col("__gl_c"), trained)).withColumn("rejected_mask", _mask(F.col("__gl_r"), trained)).drop("__gl_c", "__gl_r")


def preference_pairs(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``pair_id`` (the chosen key), ``chosen_id``, ``rejected_id``, ``chosen``, ``rejected`` from a table of turns.

    Conversations with the same first turn are ranked by key; the even ranks are chosen over the odd rank that follows.
    The last one of an odd group has no partner and a null rejected side. Turns go by number, then role and text; a null
    role is ``unknown`` and null text empty. Turns that repeat a number, or are rows twice, are turns of their own. Rows
    without a key belong to no conversation and are left out; keys are whole numbers, and one that cannot be cast to a long
    raises an error. Columns other than the four named are left out; an empty table gives an empty result.

    Ranks come from a sort of the keys alone, cut into ranges wherever they lie within a first turn, so a first turn that
    most conversations share is ranked by many tasks.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("unknown")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    talks = turns.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("conv")).agg(F.array_sort(F.collect_list(one)).alias("all"))
    talks = talks.select("conv", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    keys = turns.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("conv")).agg(F.min(one).alias("opening"))
    named = F.concat(F.octet_length("opening.role").cast("string"), F.lit(":"), "opening.role", "opening.text")  # told apart wherever the role ends
    keys = keys.select("conv", F.sha2(named, 256).alias("first"))
    ranges = checkpoint(keys.repartitionByRange(2 * partitions(turns.sparkSession), "first", "conv").withColumn("range", F.spark_partition_id()))
    sizes = ranges.groupBy("first", "range").count()
    before = sizes.select("first", "range", F.coalesce(F.sum("count").over(Window.partitionBy("first").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = ranges.withColumn("own", F.row_number().over(Window.partitionBy("first", "range").orderBy("conv")) - 1).join(before, ["first", "range"])
    rank = (F.col("own") + F.col("before")).cast("long")
    places = ranked.select("conv", "first", F.floor(rank / 2).alias("pair"), (rank % 2 == 0).alias("even"))
    sides = talks.join(places, "conv").select("first", "pair", "even", F.struct("conv", "turns").alias("talk"))
    pairs = sides.groupBy("first", "pair").agg(F.max(F.when(F.col("even"), F.col("talk"))).alias("c"), F.max(F.when(~F.col("even"), F.col("talk"))).alias("r"))
    return pairs.select(F.col("c.conv").alias("pair_id"), F.col("c.conv").alias("chosen_id"), F.col("r.conv").alias("rejected_id"), F.col("c.turns").alias("chosen"), F.col("r.turns").alias("rejected"))


def spans(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = format_pairs(preference_pairs(table(spark, sf_dir, "conversations")))
    return made.select("chosen_id", "rejected_id", "n_prompt", "prompt", "chosen_text", "rejected_text", spans("chosen_mask").alias("chosen_mask"), spans("rejected_mask").alias("rejected_mask"))


def _sql_render(turns: str) -> str:
    return f"array_to_string(list_transform({turns}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')"


def _sql_mask(turns: str) -> str:
    before = f"coalesce(list_sum(list_transform({turns}[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0)"
    own = f"CAST({before} + length({turns}[i].role) + 5 AS BIGINT)"
    return f"CASE WHEN {turns} IS NULL THEN NULL ELSE array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {turns}[i].role = '{TRAINED}'), lambda i: {own} || '-' || ({own} + length({turns}[i].text) + 7)), ',') END"


ORACLE = f"""
WITH talks AS (
  SELECT conv_id AS conv, list(struct_pack(role := coalesce(role, 'unknown'), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), ranked AS (
  SELECT conv, turns, turns[1] AS first, row_number() OVER (PARTITION BY turns[1] ORDER BY conv) - 1 AS rank FROM talks
), pairs AS (
  SELECT c.conv AS chosen_id, r.conv AS rejected_id, c.turns AS c, r.turns AS r
  FROM ranked c LEFT JOIN ranked r ON r.first = c.first AND r.rank = c.rank + 1 WHERE c.rank % 2 = 0
), cut AS (
  SELECT *, CASE WHEN r IS NULL THEN 0 ELSE coalesce(list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda i: c[i] = r[i]), false) - 1, least(len(c), len(r))) END AS k FROM pairs
), fixed AS (
  SELECT *, CASE WHEN r IS NOT NULL AND k < 0 THEN least(len(c), len(r)) ELSE k END AS n FROM cut
), rest AS (
  SELECT chosen_id, rejected_id, n, c[1:n] AS p, c[n + 1:] AS cr, CASE WHEN r IS NULL THEN NULL ELSE r[n + 1:] END AS rr FROM fixed
)
SELECT chosen_id, rejected_id, CAST(n AS INTEGER) AS n_prompt, {_sql_render('p')} AS prompt, {_sql_render('cr')} AS chosen_text,
  CASE WHEN rr IS NULL THEN NULL ELSE {_sql_render('rr')} END AS rejected_text, {_sql_mask('cr')} AS chosen_mask, {_sql_mask('rr')} AS rejected_mask
FROM rest
"""

QUERIES = {"op7_chat_format": op7_chat_format}
ORACLES = {"op7_chat_format": ORACLE}
