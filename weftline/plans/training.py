"""Training rows derived from conversation turns: each sentence of a turn is one message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators import training as P
from weftline.operators.ordering import dense_index
from weftline.plans import Catalog, Tables
from weftline.plans.retrieval import sql_tokens

catalog = Catalog()
ORDER = ["file", "line_no"]

OPENING = """case conv_id % 9 when 0 then ' OK,  thanks! ' when 1 then 'Now what?' when 2 then 'Got it.'
      when 3 then 'same opening ' || (turn % 3) when 4 then '' else {first} end"""


def rows(t: Tables) -> DataFrame:
    parts = F.split("text", r"\. ")
    message = """transform(_p, (p, i) -> named_struct(
        'role', if(i % 2 = 0, 'user', 'assistant'),
        'content', case when i = 0 then {opening}
            when i % 2 = 1 and conv_id % 2 = 0 then concat('[{{"type": "tool_use", "name":"Read"}}] ', p) else p end))"""
    messages = F.expr(message.format(opening=OPENING.format(first="p")))
    return t.conversations.withColumn("_p", parts).select(
        F.concat(F.lit("f"), F.col("conv_id") % 4).alias("file"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("line_no"),
        F.when(F.expr("turn % 5 = 4"), F.col("text")).alias("text"),
        F.when(F.expr("turn % 5 <> 4"), messages).alias("messages"))


SQL_ROWS = f"""
 p0 as (select *, string_split(text, '. ') as ps from conversations),
 tr as (select 'f' || (conv_id % 4) as file, conv_id * 100 + turn as line_no,
   case when turn % 5 = 4 then text end as ready,
   case when turn % 5 <> 4 then list_transform(ps, lambda p, i: {{
     'role': case when i % 2 = 1 then 'user' else 'assistant' end,
     'content': case when i = 1 then {OPENING.format(first='p')}
       when i % 2 = 0 and conv_id % 2 = 0 then '[{{"type": "tool_use", "name":"Read"}}] ' || p else p end}}) end as m
   from p0),
 f as (select *, coalesce(m[1].content, '') as first_user,
   regexp_replace(lower(regexp_replace(coalesce(m[1].content, ''), '^\\s+|\\s+$', '', 'g')), '\\s+', ' ', 'g') as nt
   from tr)
"""
_STARTS = " or ".join(f"nt = '{p}' or starts_with(nt, '{p} ') or starts_with(nt, '{p}?')" for p in P.FOLLOW_UP_STARTS)
SQL_FOLLOW = (f"(nt = '' or nt in ({', '.join(repr(a) for a in P.ACKNOWLEDGEMENTS)}) "
              f"or regexp_matches(nt, '{P.ONE_WORD_ACK}') or {_STARTS} "
              f"or (length(nt) <= 40 and regexp_matches(nt, '{P.TWO_FILLERS}')))")
SQL_RENDER = """list_aggregate(list_transform(m, lambda x: case when x.role = 'assistant'
   then '<|start|>assistant<|channel|>final<|message|>' || x.content || '<|end|>'
   else '<|start|>user<|message|>' || x.content || '<|end|>' end), 'string_agg', '')"""
SQL_PREPARED = f"""with {SQL_ROWS},
 g as (select *, m is not null and {SQL_FOLLOW} as follow,
   coalesce(ready, {SQL_RENDER}) as text from f),
 h as (select *, case when m is not null and not follow then row_number() over (
     partition by m is not null and not follow, first_user[1:120] order by file, line_no) end as seen,
   len({sql_tokens('text')})::BIGINT as n_tokens,
   list_sum(list_transform(list_filter(m, lambda x: x.role = 'assistant'),
     lambda x: len(regexp_extract_all(x.content, '"type":\\s*"tool_use"')))) as calls from g),
 prep as (select file, line_no, text, n_tokens, case when follow then 'follow-up'
   when m is not null and seen > 1 then 'repeated opening'
   when m is not null and m[len(m)].role <> 'assistant' then 'no final answer'
   when m is not null and calls > 2 then 'too many tool calls'
   when m is not null and len(m) > 7 then 'too many messages'
   when n_tokens > 1024 then 'too many tokens' end as reason from h)
"""


def kept(t: Tables) -> DataFrame:
    return P.prepare(rows(t), ORDER).filter("reason IS NULL")


@catalog.add("pr_01_08_prepared_rows", f"{SQL_PREPARED} select file, line_no, text, n_tokens, reason from prep")
def _(t):
    return P.prepare(rows(t), ORDER).select(*ORDER, "text", "n_tokens", "reason")


@catalog.add("pr_02_first_user_text", f"with {SQL_ROWS} select file, line_no, first_user from f")
def _(t):
    return rows(t).select(*ORDER, P.first_user_text(F.col("messages")).alias("first_user"))


@catalog.add("pr_03_follow_up_filter", f"with {SQL_ROWS} select file, line_no, {SQL_FOLLOW} as follow_up from f")
def _(t):
    return rows(t).select(*ORDER, P.is_follow_up(P.first_user_text(F.col("messages"))).alias("follow_up"))


@catalog.add("pr_09_split", f"""
{SQL_PREPARED}, k as (select * from prep where reason is null),
r as (select *, row_number() over (order by md5('42:' || file || ':' || line_no), file, line_no) as i,
  count(*) over () as n from k)
select file, line_no, i <= greatest(1, floor(n * 0.2)) as is_valid from r""")
def _(t):
    return P.split(kept(t), ORDER).select(*ORDER, "is_valid")


@catalog.add("pr_10_token_statistics", f"""
{SQL_PREPARED}, k as (select n_tokens, row_number() over (order by n_tokens) - 1 as i, count(*) over () as n
  from prep where reason is null)
select min(n_tokens) as min_tokens, max(case when i = n // 2 then n_tokens end) as median_tokens,
  (sum(n_tokens) // count(*))::BIGINT as mean_tokens, max(n_tokens) as max_tokens from k""")
def _(t):
    return P.token_statistics(kept(t))


@catalog.add("pr_11_reason_counts", f"""
{SQL_PREPARED} select coalesce(reason, 'kept') as reason, count(*) as n from prep group by 1""")
def _(t):
    return P.reason_counts(P.prepare(rows(t), ORDER))


@catalog.add("pr_12_instruction_text", """
select conv_id, turn::BIGINT as turn, '### Instruction: ' || role || chr(10) || '### Response: ' || text as text
from conversations""")
def _(t):
    return t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                                  P.instruction_text(F.col("role"), F.col("text")).alias("text"))


SQL_IDS = "list_transform(ws, lambda w: ('0x' || md5(w)[1:6])::BIGINT)"


@catalog.add("pr_13_completion_labels", f"""
with w as (select conv_id, turn, list_filter(string_split_regex('### Instruction: ' || role || chr(10) ||
    case when turn % 3 = 2 then '### Answer: ' else '### Response: ' end || text, '\\s+'), lambda x: x <> '') as ws
  from conversations),
l as (select conv_id, turn, ws, case when ws[4:5] = ['###', 'Response:'] then 5 else len(ws) end as masked from w)
select conv_id, turn::BIGINT as turn, array_to_string(list_transform({SQL_IDS},
  lambda x, i: case when i <= masked then -100 else x end), ',') as labels from l""")
def _(t):
    body = F.expr("concat('### Instruction: ', role, '\\n', if(turn % 3 = 2, '### Answer: ', '### Response: '), text)")
    tokens = F.transform(X.split_words(body), lambda w: F.struct(
        w.alias("text"), F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("bigint").alias("id")))
    labels = P.completion_labels(tokens, ["###", "Response:"])
    return t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                                  F.array_join(labels.cast("array<string>"), ",").alias("labels"))


@catalog.add("pr_14_padded_ids", f"""
with w as (select conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as ws from conversations),
i as (select conv_id, turn, {SQL_IDS} as ids, len(ws) as n from w)
select conv_id, turn::BIGINT as turn,
  array_to_string(list_concat(ids[1:64], list_transform(range(greatest(64 - n, 0)), lambda x: 0)), ',') as ids,
  least(n, 64)::BIGINT as attended from i""")
def _(t):
    ids = F.transform(X.split_words("text"), lambda w: F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("bigint"))
    base = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), ids.alias("ids"))
    mask = F.aggregate(P.attention_mask(F.col("ids"), 64), F.lit(0), lambda a, x: a + x)
    return base.select("conv_id", "turn", F.array_join(P.pad(F.col("ids"), 64).cast("array<string>"), ",").alias("ids"),
                       mask.cast("bigint").alias("attended"))


@catalog.add("pr_15_masked_tokens", """
with w as (select conv_id, turn, unnest(range(len(ws))) as pos, unnest(ws) as word from (
   select conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as ws from conversations)),
h as (select *, ('0x' || md5(word)[1:4])::BIGINT as token_id, md5('42:' || conv_id || ':' || turn || ':' || pos) as h from w),
k as (select *, ('0x' || h[1:4])::DOUBLE / 65536 < 0.15 as chosen, ('0x' || h[5:8])::BIGINT / 65536.0 as kind from (
   select * replace (h as h) from h))
select conv_id, turn::BIGINT as turn, pos::BIGINT as pos, token_id,
  case when chosen and kind < 0.8 then 65536 when chosen and kind < 0.9 then ('0x' || h[9:14])::BIGINT % 65536
    else token_id end::BIGINT as input_id,
  case when chosen then token_id else -100 end::BIGINT as label from k""".replace("('0x' || h[1:4])::DOUBLE", "('0x' || h[1:4])::BIGINT"))
def _(t):
    words = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                                   F.posexplode(X.split_words("text")).alias("pos", "word"))
    tokens = words.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"),
                          F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("bigint").alias("token_id"))
    return P.masked_tokens(tokens, ["conv_id", "turn", "pos"], 65536, 65536)


@catalog.add("pr_16_user_questions", f"""
{SQL_PREPARED}, q as (select (row_number() over (order by file, line_no) - 1)::VARCHAR as id,
  regexp_replace(regexp_extract(text, '(?s)user<\\|message\\|>(.*?)<\\|end\\|>', 1), '^\\s+|\\s+$', '', 'g') as q from prep)
select id, q[1:500] as text from q where q <> ''""")
def _(t):
    numbered = dense_index(P.prepare(rows(t), ORDER).select(*ORDER, "text"), ORDER, "row_no")
    return P.user_questions(numbered)
