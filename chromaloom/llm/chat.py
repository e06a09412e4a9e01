"""Multi-party perspective rotation of conversations (operator 4).

For every participant the dialogue is rendered with that speaker as the assistant and all others
as users with their names; turns of ``FIXED`` roles keep their role in every rendering and are no
participants.  The mask lists the character ranges to learn from: each of the assistant's texts
with its end mark.

``rotate`` gives one row per participant with the whole dialogue.  ``rotate_parts`` gives the same
in parts of ``PART`` consecutive turn numbers, with offsets into the whole: the shuffle moves and
sorts turns by part, so a long conversation is spread over many tasks, and a dialogue that would not fit
in a row (2 GB) can be had in parts alone.

Defined results: a null or empty role speaks as ``unknown`` and is no participant, also where
somebody of that name takes part; a null text is an empty turn; null turns come last; ties are
ordered by role and text, repeated rows are repeated turns.  A null conv_id is a conversation of
its own.  A conversation without participants, and an empty table, give no row.  ``<|`` in texts and
names is written ``<\\|``, so that no text can end a turn.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART = 512
FIXED = ("system",)
BEGIN, END = "<|im_start|>", "<|im_end|>"
SPANS = "array<struct<begin:bigint,end:bigint>>"


def _escaped(text):
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def _parts(conversations: DataFrame, part: int) -> DataFrame:
    """conv_id, participant, part, n_turns, text, size, spans: offsets within the part."""
    named = F.coalesce("role", F.lit("")) != ""
    role = F.when(named, F.col("role")).otherwise(F.lit("unknown"))
    name = F.regexp_replace(_escaped(role), "[\\r\\n]", " ")
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", role.alias("role"), _escaped(F.col("text")).alias("text"), named.alias("named"), name.alias("name"))
    dealt = conversations.select("conv_id", F.floor(F.col("turn") / part).cast("long").alias("part"), turn.alias("t"))
    parts = dealt.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    able = conversations.filter(named).filter(~F.col("role").isin(*FIXED))
    cast = able.select(F.col("conv_id").alias("_conv"), F.col("role").alias("participant")).distinct()
    each = parts.join(cast, F.col("conv_id").eqNullSafe(F.col("_conv")))
    mine = lambda t: t["named"] & (t["role"] == F.col("participant"))
    head = lambda t: F.concat(F.lit(BEGIN), F.when(t["named"] & t["role"].isin(*FIXED), t["role"]).when(mine(t), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), t["name"])), F.lit("\n"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END + "\n"))), "")
    sizes = F.transform("turns", lambda t: F.struct(F.length(head(t)).cast("long").alias("head"), (F.length(t["text"]) + len(END)).cast("long").alias("body"), mine(t).alias("mine")))
    step = lambda a, x: F.struct(
        (a["at"] + x["head"] + x["body"] + 1).alias("at"),
        F.when(x["mine"], F.concat(a["spans"], F.array(F.struct((a["at"] + x["head"]).alias("begin"), (a["at"] + x["head"] + x["body"]).alias("end"))))).otherwise(a["spans"]).alias("spans"),
    )
    laid = F.aggregate(sizes, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans")), step)
    out = each.select("conv_id", "participant", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), laid.alias("laid"))
    return out.select("conv_id", "participant", "part", "n_turns", "text", F.col("laid.at").alias("size"), F.col("laid.spans").alias("spans"))


def _moved(spans, by):
    return F.transform(spans, lambda s: F.struct((s["begin"] + by).alias("begin"), (s["end"] + by).alias("end")))


def rotate(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, participant, n_turns, text, spans (array of begin and end of each target): whole dialogues."""
    piece = F.struct(F.col("part").isNull().alias("last"), "part", "n_turns", "text", "size", "spans")
    whole = _parts(conversations, part).groupBy("conv_id", "participant").agg(F.sort_array(F.collect_list(piece)).alias("parts"))
    step = lambda a, p: F.struct((a["at"] + p["size"]).alias("at"), F.concat(a["spans"], _moved(p["spans"], a["at"])).alias("spans"))
    spans = F.aggregate("parts", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("spans")), step, lambda a: a["spans"])
    turns = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n_turns"])
    return whole.select("conv_id", "participant", turns.alias("n_turns"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), spans.alias("spans"))


def rotate_parts(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, participant, part, n_turns, begin, text, spans: a row per part of a dialogue.

    ``begin`` is where the part's text begins in the whole rendering, and spans are offsets into
    the whole, too: prefix sums of the parts' sizes, joined without moving texts twice.
    The part of null turns is null and the last one.
    """
    parts = _parts(conversations, part)
    order = W.partitionBy("conv_id", "participant").orderBy(F.col("part").isNull(), "part")
    begins = parts.select("conv_id", "participant", "part", "size").withColumn("begin", F.sum("size").over(order) - F.col("size"))
    begins = begins.select(F.col("conv_id").alias("_c"), F.col("participant").alias("_p"), F.col("part").alias("_n"), "begin")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("participant") == F.col("_p")) & F.col("part").eqNullSafe(F.col("_n"))
    return parts.join(begins, on).select("conv_id", "participant", "part", "n_turns", "begin", "text", _moved(F.col("spans"), F.col("begin")).alias("spans"))


def op4_chat_rotation(spark, sf_dir: str) -> DataFrame:
    out = rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    mask = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["begin"].cast("string"), s["end"].cast("string"))), ";")
    return out.select("conv_id", "participant", "n_turns", "text", mask.alias("mask"))


ORACLE = r"""
with t as (
  select conv_id, turn is null as l, turn, coalesce(role, '') <> '' as named,
         coalesce(nullif(role, ''), 'unknown') as role,
         replace(coalesce(text, ''), '<|', '<\|') as text,
         regexp_replace(replace(coalesce(nullif(role, ''), 'unknown'), '<|', '<\|'), '[\r\n]', ' ', 'g') as name
  from conversations),
p as (select distinct conv_id, role as participant from conversations
      where coalesce(role, '') not in ('', 'system')),
h as (select t.*, p.participant, named and role = participant as mine,
             '<|im_start|>' || case when named and role = 'system' then role when named and role = participant then 'assistant'
                                    else 'user name=' || name end || chr(10) as head
      from t join p on t.conv_id is not distinct from p.conv_id),
o as (select *, length(head) as hl, length(text) + 10 as bl,
             coalesce(sum(length(head) + length(text) + 11) over (
               partition by conv_id, participant order by l, turn, role, text, named
               rows between unbounded preceding and 1 preceding), 0)::bigint as st
      from h)
select conv_id, participant, count(*)::bigint as n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' order by l, turn, role, text, named) as text,
       coalesce(string_agg((st + hl)::varchar || ':' || (st + hl + bl)::varchar, ';' order by l, turn, role, text, named)
                filter (where mine), '') as mask
from o group by conv_id, participant
"""
