"""Preference pairs of conversations as one prompt and two masked completions.

The prompt is the longest common prefix of turns (role and text) of the chosen
and the rejected conversation, rendered once. What follows in each is its
completion; its mask lists the character spans to train on: what the assistant
says, with its end mark. All of it is window, array and string functions.

Very long texts are only concatenated; an empty table gives no rows; columns other
than conv_id, turn, role and text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.common import table

#: Fixed values of the rendering: a turn is OPEN role CLOSE text END.
OPEN, CLOSE, END, TRAINED = "<|", "|>\n", "<|end|>\n", "assistant"
#: Neighbouring ids among which an answer is looked for.
NEAR = 64


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, with their places in its rendering.

    Order: turn (nulls last), role, text. Rows that repeat all four columns count
    once; null role and text are empty; rows without conv_id are left out.
    """
    t = (conversations.where("conv_id is not null")
         .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
         .distinct())
    head, body = F.concat(F.lit(OPEN), "role", F.lit(CLOSE)), F.concat("text", F.lit(END))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    k = F.row_number().over(in_order)
    stop = F.sum(F.length(head) + F.length(body)).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    placed = t.select("conv_id", k.alias("k"), "role", "text", F.concat(head, body).alias("shown"), stop.alias("stop"),
                      (stop - F.length(body)).alias("start"))
    return placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("k", "role", "text", "shown", "start", "stop"))).alias("turns"))


def _completion(turns: str) -> list[Column]:
    rest = f"slice({turns}, n + 1, size({turns}))"
    base = f"if(n = 0, 0L, get({turns}, n - 1).stop)"
    return [F.expr(f"array_join(transform({rest}, x -> x.shown), '')"),
            F.expr(f"transform(filter({rest}, x -> x.role = '{TRAINED}'), "
                   f"x -> named_struct('start', x.start - {base}, 'stop', x.stop - {base}))")]


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen_id, rejected_id) rendered: n_prompt_turns, prompt, chosen, chosen_spans,
    rejected, rejected_spans, usable.

    usable: both completions have something to train on. Conversations that are
    equal, or of which one continues the other, give an empty completion. Pairs
    with an unknown conversation are left out; a conversation may be in many.
    """
    turns = rendered_turns(conversations)
    chosen = turns.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    rejected = turns.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.select("pair_id", "chosen_id", "rejected_id").join(chosen, "chosen_id").join(rejected, "rejected_id")
    same = F.expr("array_position(zip_with(c, r, (x, y) -> x.role <=> y.role and x.text <=> y.text), false)")
    both = both.withColumn("n", F.when(same == 0, F.size("c")).otherwise(same - 1).cast("int"))
    (text_c, spans_c), (text_r, spans_r) = _completion("c"), _completion("r")
    return both.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_prompt_turns"),
        F.expr("array_join(transform(slice(c, 1, n), x -> x.shown), '')").alias("prompt"),
        text_c.alias("chosen"), spans_c.alias("chosen_spans"), text_r.alias("rejected"), spans_r.alias("rejected_spans"),
        ((F.size(spans_c) > 0) & (F.size(spans_r) > 0)).alias("usable"))


def neighbours(conversations: DataFrame) -> DataFrame:
    """Pairs for a table whose even conv_ids are answers to prefer to the odd ones after them."""
    ids = conversations.where("conv_id is not null").select("conv_id").distinct()
    each = ids.groupBy(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).agg(
        F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id"))
    return each.where("chosen_id < rejected_id")


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preferences for a table that has none: (conversations, pairs) for ``format_pairs``.

    Every conversation is chosen over itself with its last assistant turn taken from
    another conversation: the next conv_id that has one among ``NEAR`` neighbouring ids,
    after the last of them the first. So the two share all turns up to that one. One without
    an assistant turn, or alone among its neighbours, is paired with itself: all of it is prompt.
    pairs: pair_id (the conv_id), chosen_id, rejected_id (text), donor_id.
    """
    t = (conversations.where("conv_id is not null")
         .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).distinct())
    place = F.struct(F.col("turn").isNull().alias("a"), F.col("turn").alias("b"), F.col("text").alias("c"))
    last = t.where(F.col("role") == TRAINED).groupBy("conv_id").agg(F.max(place).alias("last"))
    ring = Window.partitionBy(F.floor(F.col("conv_id") / NEAR)).orderBy("conv_id")
    mine = F.struct(F.col("conv_id").alias("donor_id"), F.col("last.c").alias("answer"))
    donors = last.select("conv_id", "last", F.coalesce(F.lead(mine).over(ring), F.first(mine).over(ring)).alias("from"))
    swapped = (t.join(donors, "conv_id", "left")
               .withColumn("text", F.when((F.col("role") == TRAINED) & (place == F.col("last")), F.col("from.answer")).otherwise(F.col("text"))))
    name = F.col("conv_id").cast("string")
    both = (t.withColumn("conv_id", F.concat(F.lit("c"), name))
            .unionByName(swapped.select(F.concat(F.lit("r"), name).alias("conv_id"), "turn", "role", "text")))
    pairs = (t.select("conv_id").distinct().join(donors, "conv_id", "left")
             .select(F.col("conv_id").alias("pair_id"), F.concat(F.lit("c"), name).alias("chosen_id"),
                     F.concat(F.lit("r"), name).alias("rejected_id"), "from.donor_id"))
    return both, pairs


def _spans(col: str) -> Column:
    return F.array_join(F.transform(col, lambda x: F.concat_ws("-", x["start"].cast("string"), x["stop"].cast("string"))), ";")


def query(spark, sf_dir: str) -> DataFrame:
    both, pairs = swapped_answers(table(spark, sf_dir, "conversations"))
    return (format_pairs(both, pairs).join(pairs.select("pair_id", "donor_id"), "pair_id")
            .select("pair_id", "donor_id", "n_prompt_turns", "prompt", "chosen", _spans("chosen_spans").alias("chosen_spans"),
                    "rejected", _spans("rejected_spans").alias("rejected_spans"), "usable"))


SQL = """
with t as (select distinct conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
l as (select conv_id, turn, x from (select *, row_number() over (partition by conv_id order by turn desc nulls first, x desc) n
      from t where r = 'assistant') where n = 1),
g as (select conv_id, turn, x, coalesce(lead(conv_id) over w, first(conv_id) over w) donor_id, coalesce(lead(x) over w, first(x) over w) answer
      from l window w as (partition by conv_id // 64 order by conv_id)),
u as (select conv_id pair_id, 'c' side, turn, r, x from t
      union select t.conv_id, 'r', t.turn, t.r, case when r = 'assistant' and g.turn is not distinct from t.turn and g.x = t.x and g.conv_id is not null
                                                     then answer else t.x end from t left join g using (conv_id)),
s as (select pair_id, side, r, x, row_number() over w k, '<|' || r || '|>' || chr(10) || x || '<|end|>' || chr(10) s,
             length(x) + 8 body from u window w as (partition by pair_id, side order by turn nulls last, r, x)),
d as (select pair_id, k from s group by pair_id, k having count(*) < 2 or count(distinct r) > 1 or count(distinct x) > 1),
p as (select pair_id, max(k) most from s group by pair_id),
n as (select pair_id, coalesce(min(d.k) - 1, any_value(most)) n from p left join d using (pair_id) group by pair_id),
c as (select s.*, n.n, sum(length(s)) over (partition by pair_id, side, s.k > n.n order by s.k) stop from s join n using (pair_id)),
f as (select pair_id, any_value(n) n_prompt_turns,
  coalesce(string_agg(s, '' order by k) filter (side = 'c' and k <= n), '') prompt,
  coalesce(string_agg(s, '' order by k) filter (side = 'c' and k > n), '') chosen,
  coalesce(string_agg((stop - body) || '-' || stop, ';' order by k) filter (side = 'c' and k > n and r = 'assistant'), '') chosen_spans,
  coalesce(string_agg(s, '' order by k) filter (side = 'r' and k > n), '') rejected,
  coalesce(string_agg((stop - body) || '-' || stop, ';' order by k) filter (side = 'r' and k > n and r = 'assistant'), '') rejected_spans
  from c group by pair_id)
select pair_id, donor_id, cast(n_prompt_turns as bigint) n_prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans,
       chosen_spans <> '' and rejected_spans <> '' usable from f left join (select conv_id pair_id, donor_id from g) using (pair_id)
"""
