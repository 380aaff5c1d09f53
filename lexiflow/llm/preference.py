"""Preference formatting (operator 7), native functions only.

The chosen and the rejected conversation of a pair share a prefix of equal turns.
It is rendered once, as the prompt; what follows on either side is rendered as a
completion with the character spans that a loss may see: the texts of assistant
turns with their end mark.  Everything happens within a row, so pairs need no
shuffle; only collecting turns to conversations groups, by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import free_name

#: The marks around a turn.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"

_TURNS = "array<struct<role: string, text: string>>"


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns (role, text) of each conversation by turn, role and text.

    Null roles and texts count as empty; turns without a conversation id are one
    conversation (of id null); repeated rows are repeated turns.
    """
    said = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    got = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("t"))
    return got.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def swapped_replies(chats: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): each conversation, and the same up to its last assistant
    turn with the last reply of the conversation of the next id in its place.

    Where no such conversation or reply exists the rejected side ends there; a
    conversation without an assistant turn is rejected as it stands.
    """
    at = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1).otherwise(0)))
    own = chats.withColumn("at", F.coalesce(at, F.lit(0)))
    reply = own.where("at > 0").select((F.col("conv_id") - 1).alias("conv_id"), F.get("turns", F.col("at") - 1).alias("reply"))
    both = own.join(reply, "conv_id", "left")
    kept = F.slice("turns", F.lit(1), F.greatest(F.col("at") - 1, F.lit(0)))
    given = F.when(F.col("reply").isNull(), F.array().cast(_TURNS)).otherwise(F.array("reply"))
    rejected = F.when(F.col("at") == 0, F.col("turns")).otherwise(F.concat(kept, given))
    return both.select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))


def common_prefix(a: Column, b: Column) -> Column:
    """The number of equal turns at the start of two conversations."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def _safe(text: Column) -> Column:
    """Text in which no mark can be taken for a turn's."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(OPEN), _safe(t["role"]), F.lit(CLOSE), _safe(t["text"]), F.lit(END))
    return F.array_join(F.transform(turns, one), "")


def loss_spans(turns: Column) -> Column:
    """start:end (code points, end exclusive) of assistant texts with their end marks, comma-joined."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + F.char_length(_safe(t["role"])) + len(OPEN + CLOSE)
        end = begin + F.char_length(_safe(t["text"])) + len(END)
        spans = F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(F.concat_ws(":", begin, end)))).otherwise(s["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with both turn columns replaced by prompt_turns, prompt, the two completions
    and their loss spans; other columns stay.

    Equal conversations have empty completions, conversations that differ from the
    first turn on an empty prompt; a null conversation counts as one without turns.
    """
    a, b = (F.coalesce(F.col(c), F.array().cast(_TURNS)) for c in (chosen, rejected))
    mine = {c.lower() for c in (chosen, rejected, "prompt_turns", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans")}
    others = [F.col(c) for c in pairs.columns if c.lower() not in mine]
    left, right, size = (free_name(pairs, n) for n in ("_a", "_b", "_k"))
    cut = pairs.select(*others, a.alias(left), b.alias(right)).withColumn(size, common_prefix(F.col(left), F.col(right)))
    rest = [F.slice(c, F.col(size) + 1, F.greatest(F.size(c), F.lit(1))) for c in (left, right)]
    return cut.select(
        *others,
        F.col(size).alias("prompt_turns"),
        render(F.slice(left, F.lit(1), F.col(size))).alias("prompt"),
        render(rest[0]).alias("chosen"),
        loss_spans(rest[0]).alias("chosen_spans"),
        render(rest[1]).alias("rejected"),
        loss_spans(rest[1]).alias("rejected_spans"),
    )


ORACLE = r"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn, coalesce(role, ''), coalesce(text, '')) as i,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations),
n as (select conv_id, count(*) as size, coalesce(max(case when role = 'assistant' then i end), 0) as last from t group by conv_id),
rej as (
  select t.conv_id, t.i, t.role, t.text from t join n using (conv_id) where n.last = 0 or t.i < n.last
  union all
  select n.conv_id, n.last, r.role, r.text from n join n m on m.conv_id = n.conv_id + 1 join t r on r.conv_id = m.conv_id and r.i = m.last where n.last > 0),
d as (
  select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.i, r.i) as i
  from t c full join rej r on c.conv_id = r.conv_id and c.i = r.i
  where c.i is null or r.i is null or c.role <> r.role or c.text <> r.text),
k as (select n.conv_id, coalesce(min(d.i) - 1, max(n.size)) as k from n left join d on d.conv_id = n.conv_id group by n.conv_id),
s as (
  select conv_id, 'c' as side, i, role, text from t union all select conv_id, 'r', i, role, text from rej),
e as (
  select s.conv_id, s.side, s.i, s.role, s.i > k.k as after,
         '<|' || replace(s.role, '<|', '<\|') || '|>' || chr(10) as head,
         replace(s.text, '<|', '<\|') || '<|end|>' || chr(10) as body
  from s join k on k.conv_id = s.conv_id),
p as (
  select *, coalesce(sum(length(head) + length(body)) over (partition by conv_id, side, after order by i rows between unbounded preceding and 1 preceding), 0) as head_at
  from e)
select k.conv_id, cast(k.k as int) as prompt_turns,
  coalesce(string_agg(head || body, '' order by i) filter (where side = 'c' and not after), '') as prompt,
  coalesce(string_agg(head || body, '' order by i) filter (where side = 'c' and after), '') as chosen,
  coalesce(string_agg(cast(head_at + length(head) as bigint) || ':' || cast(head_at + length(head) + length(body) as bigint), ',' order by i)
    filter (where side = 'c' and after and role = 'assistant'), '') as chosen_spans,
  coalesce(string_agg(head || body, '' order by i) filter (where side = 'r' and after), '') as rejected,
  coalesce(string_agg(cast(head_at + length(head) as bigint) || ':' || cast(head_at + length(head) + length(body) as bigint), ',' order by i)
    filter (where side = 'r' and after and role = 'assistant'), '') as rejected_spans
from k left join p on p.conv_id = k.conv_id
group by k.conv_id, k.k
"""
