"""Threads over transcript records derived from the conversation table.

Each turn is a record; every fifth conversation has a branch at turn 2, odd assistant turns
call a tool, and one uuid in some files is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import threads as T
from weftline.plans import Catalog, Tables
from weftline.session import cut_lineage

catalog = Catalog()


def records(t: Tables) -> DataFrame:
    turns = t.conversations.select(
        "conv_id", "turn", F.col("role").alias("type"), "text",
        F.explode(F.expr("if(conv_id % 5 = 0 and turn = 2, array('', 'b'), if(conv_id % 11 = 3 and turn = 1, array('', 'd'), array('')))"))
        .alias("twin"))
    words = F.expr("if(twin = 'd', concat('again ', text), text)")
    tool = F.to_json(F.array(F.struct(
        F.lit("tool_use").alias("type"), F.expr("if(conv_id % 9 = 4, 'Other', 'Read')").alias("name"),
        F.struct(F.col("turn").alias("at")).alias("input"))))
    blocks = F.to_json(F.array(F.struct(F.lit("thinking").alias("type"), F.lit("x").alias("text")),
                               F.struct(F.lit("text").alias("type"), words.alias("text"))))
    result = F.to_json(F.array(F.struct(F.lit("tool_result").alias("type"), words.alias("content"))))
    content = (
        F.when((F.col("type") == "assistant") & (F.col("turn") % 4 == 1), tool)
        .when(F.col("type") == "assistant", blocks)
        .when(F.expr("turn % 4 = 2 and conv_id % 2 = 0"), result)
        .otherwise(F.to_json(words_variant(words))))
    return turns.select(
        F.concat(F.lit("f"), F.col("conv_id") % 3).alias("file"),
        (F.col("conv_id") * 100 + F.col("turn") * 2 + F.expr("if(twin = '', 0, 1)")).alias("line_no"),
        F.expr("concat(conv_id, '-', turn, if(twin = 'b', 'b', ''))").alias("uuid"),
        F.expr("if(turn = 0, null, concat(conv_id, '-', turn - 1))").alias("parent"),
        "type", content.alias("content"))


def words_variant(words):
    return words.cast("variant")


SQL_RECORDS = """
 r as (select 'f' || (conv_id % 3) as file,
     conv_id * 100 + turn * 2 + case when twin = '' then 0 else 1 end as line_no,
     conv_id || '-' || turn || case when twin = 'b' then 'b' else '' end as uuid,
     case when turn = 0 then null else conv_id || '-' || (turn - 1) end as parent, role as type, conv_id, turn,
     case when twin = 'd' then 'again ' || text else text end as words
   from (select *, unnest(case when conv_id % 5 = 0 and turn = 2 then ['', 'b']
       when conv_id % 11 = 3 and turn = 1 then ['', 'd'] else [''] end) as twin from conversations)),
 c as (select * from r where type in ('user', 'assistant')),
 node as (select file, uuid, min(line_no) as first_line, arg_max(parent, line_no) as parent,
     arg_max(type, line_no) as type, arg_max(words, line_no) as words, any_value(conv_id) as conv_id,
     any_value(turn) as turn from c group by file, uuid),
 leaf as (select file, uuid, first_line from node n
     where not exists (select 1 from c where c.file = n.file and c.parent = n.uuid))
"""
SQL_WALK = f"""
with recursive {SQL_RECORDS},
 walk as (select file, uuid as leaf, 0 as depth, uuid from leaf
   union all
   select w.file, w.leaf, w.depth + 1, p.uuid from walk w join node n on n.file = w.file and n.uuid = w.uuid
     join node p on p.file = n.file and p.uuid = n.parent where w.depth + 1 < 60)
"""
SQL_MESSAGES = f"""{SQL_WALK},
 msg as (select file, uuid, type as role, text from (select *,
     case when type = 'assistant' and turn % 4 = 1 and conv_id % 9 <> 4
       then '[{{"type":"tool_use","name":"Read","input":{{"at":' || turn || '}}}}]'
     when type = 'assistant' and turn % 4 = 1 then null
     when type = 'assistant' then regexp_replace(words, '^\\s+|\\s+$', '', 'g')
     when turn % 4 = 2 and conv_id % 2 = 0
       then '[{{"type":"tool_result","content":' || to_json(words[1:800])::VARCHAR || '}}]'
     else regexp_replace(words, '^\\s+|\\s+$', '', 'g') end as text from node) where text <> ''),
 tm as (select file, leaf, m.role, m.text, row_number() over (partition by file, leaf order by depth desc) as p
   from walk join msg m using (file, uuid)),
 tl as (select file, leaf, list({{'role': role, 'content': text}} order by p) as m from tm group by file, leaf)
"""
SQL_VALID = """(len({m}) >= 2 and {m}[1].role = 'user' and {m}[1].content[1] <> '[' and {m}[len({m})].role = 'assistant'
  and len(list_filter({m}, lambda x: x.role = 'assistant' and x.content[1] = '[')) >= 1
  and len(list_filter(range(2, len({m}) + 1), lambda i: {m}[i].role = {m}[i - 1].role)) = 0)"""
SQL_EXAMPLES = f"""{SQL_MESSAGES},
 v as (select *, {SQL_VALID.format(m='m')} as ok from tl),
 w0 as (select file, leaf, m[(s + 1)::BIGINT:(s + 12)::BIGINT] as w, s from (
     select *, unnest(range(0, len(m) - 1, 2)) as s from v where not (ok and len(m) <= 12))),
 w1 as (select file, leaf, s, case when w[len(w)].role = 'assistant' then w else w[1:len(w) - 1] end as w from w0),
 w2 as (select *, {SQL_VALID.format(m='w')} as ok from w1),
 ex as (select file, leaf, 0::BIGINT as win, m from v where ok and len(m) <= 12
   union all select file, leaf, row_number() over (partition by file, leaf order by s) - 1, w from w2 where ok),
 exo as (select ex.*, first_line from ex join leaf on leaf.file = ex.file and leaf.uuid = ex.leaf),
 dd as (select * from exo qualify row_number() over (partition by m[1].content[1:100] order by file, first_line, win) = 1)
"""
SQL_SHOW = "array_to_string(list_transform({m}, lambda x: x.role || ':' || x.content), '|')"


def show(m: str = "messages"):
    return F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|")


def walked(t: Tables):
    r = records(t)
    table = cut_lineage(T.nodes(r))
    ends = T.leaves(r, table)
    return r, table, ends, T.walk_up(table, ends)


@catalog.add("th_01_nodes", f"""
with {SQL_RECORDS} select file, uuid, first_line, parent, type from node""")
def _(t):
    return T.nodes(records(t)).select("file", "uuid", "first_line", "parent", "type")


@catalog.add("th_02_leaves", f"with {SQL_RECORDS} select file, uuid, first_line from leaf")
def _(t):
    r = records(t)
    return T.leaves(r, T.nodes(r))


@catalog.add("th_03_walks", f"{SQL_WALK} select file, leaf, depth::BIGINT as depth, uuid from walk")
def _(t):
    return walked(t)[3].select("file", "leaf", F.col("depth").cast("bigint").alias("depth"), "uuid")


@catalog.add("th_04_threads", f"""
{SQL_WALK} select file, leaf, string_agg(uuid, '>' order by depth desc) as path from walk group by file, leaf""")
def _(t):
    return T.threads(walked(t)[3]).select("file", "leaf", F.array_join("path", ">").alias("path"))


@catalog.add("th_05_08_node_messages", f"{SQL_MESSAGES} select file, uuid, role, text from msg")
def _(t):
    r = records(t)
    return T.node_messages(r, T.nodes(r))


@catalog.add("th_09_thread_validity", f"""
{SQL_MESSAGES} select file, leaf, len(m)::BIGINT as n, {SQL_VALID.format(m='m')} as valid from tl""")
def _(t):
    r, table, _, walks = walked(t)
    threaded = T.thread_messages(walks, T.node_messages(r, table))
    return threaded.select("file", "leaf", F.size("messages").cast("bigint").alias("n"),
                           T.is_valid(F.col("messages")).alias("valid"))


@catalog.add("th_10_11_examples", f"""
{SQL_EXAMPLES} select file, leaf, win::BIGINT as win, {SQL_SHOW.format(m='m')} as shown from exo""")
def _(t):
    r, table, _, walks = walked(t)
    found = T.examples(T.thread_messages(walks, T.node_messages(r, table)))
    return found.select("file", "leaf", F.col("window").cast("bigint").alias("win"), show().alias("shown"))


@catalog.add("th_12_distinct_openings", f"""
{SQL_EXAMPLES} select file, first_line, win::BIGINT as win, {SQL_SHOW.format(m='m')} as shown from dd""")
def _(t):
    r, table, ends, walks = walked(t)
    threaded = T.thread_messages(walks, T.node_messages(r, table)).join(
        ends.withColumnRenamed("uuid", "leaf"), ["file", "leaf"])
    kept = T.distinct_openings(T.examples(threaded), ["file", "first_line", "window"])
    return kept.select("file", "first_line", F.col("window").cast("bigint").alias("win"), show().alias("shown"))


@catalog.add("th_13_sampled_examples", f"""
{SQL_EXAMPLES} select file, first_line, win::BIGINT as win from dd
order by md5('42:' || file || ':' || first_line || ':' || win), file, first_line, win limit 500""")
def _(t):
    found = T.build_examples(records(t))
    return found.select("file", "first_line", F.col("window").cast("bigint").alias("win"))
