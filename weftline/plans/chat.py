"""Conversation exports derived from the conversation table: one export row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import export
from weftline.plans import Catalog, Tables

catalog = Catalog()


def exports(t: Tables) -> DataFrame:
    """Every line of a turn becomes a message node; some nodes lack message, content or time."""
    lines = F.split("text", "\n")
    one = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    entries = F.expr("transform(_lines, s -> struct(concat('n', s.i) AS key, "
                     + node_sql() + " AS value))")
    base = t.conversations.withColumn("_lines", one)
    return base.select(
        "conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("ord"),
        F.expr("if(turn = 4, null, concat(substr(text, 1, 12), ' Q/A: ', role))").alias("title"),
        F.expr("if(turn = 3, null, concat('c', conv_id % 50))").alias("id"),
        F.expr("if(turn % 2 = 0, cast(conv_id as string), null)").alias("create_time"),
        F.map_from_entries(entries).alias("mapping"))


def node_sql() -> str:
    return """
      named_struct('id', concat('n', s.i), 'parent', cast(null AS string), 'children', cast(array() AS array<string>),
        'message', if(s.i % 5 = 3, null, named_struct(
          'id', concat('m', s.i),
          'author', named_struct('role', element_at(array('system', 'USER', 'assistant'), s.i % 3 + 1)),
          'create_time', if(s.i % 4 = 1, null, cast(100 - (s.i * 7) % 11 AS string)),
          'content', if(s.i % 7 = 6, null, named_struct('content_type', 'text',
              'parts', array(s.line, if(s.i % 2 = 0, '', 'more')))))))"""


SQL_EXPORTS = """
 ex as (select conv_id, turn, conv_id * 100 + turn as ord,
   case when turn = 4 then null else substr(text, 1, 12) || ' Q/A: ' || role end as title,
   case when turn = 3 then null else 'c' || (conv_id % 50) end as id,
   case when turn % 2 = 0 then conv_id::VARCHAR end as create_time, string_split(text, chr(10)) as lines
   from conversations),
 n as (select ord, unnest(range(len(lines))) as i, unnest(lines) as line from ex),
 msg as (select ord, i, line, (['system', 'USER', 'assistant'])[i % 3 + 1] as role,
   case when i % 4 = 1 then 0.0 else 100 - (i * 7) % 11 end::DOUBLE as ts
   from n where i % 5 <> 3 and i % 7 <> 6)
"""
SQL_TITLES = "select ord, coalesce(id, '') as id, coalesce(title, 'Untitled Conversation ' || ord) as title from ex"


@catalog.add("cx_01_sorted_titles", f"""
with {SQL_EXPORTS}
select ord, id, title, (row_number() over (order by lower(title), ord) - 1)::BIGINT as idx from ({SQL_TITLES})""")
def _(t):
    return export.sorted_titles(exports(t))


@catalog.add("cx_02_by_id", f"""
with {SQL_EXPORTS} select ord, id, title from ex where id = 'c7' order by ord limit 1""")
def _(t):
    return export.by_id(exports(t), "c7").select("ord", "id", "title")


@catalog.add("cx_03_by_title", f"""
with {SQL_EXPORTS} select ord, title from ex where title <> '' and contains(lower(title), 'la ')""")
def _(t):
    return export.by_title(exports(t), "LA ").select("ord", "title")


@catalog.add("cx_04_messages", f"""
with {SQL_EXPORTS}
select conv_id, turn::BIGINT as turn, (row_number() over (partition by ord order by ts, i) - 1)::BIGINT as seq,
  i::BIGINT as pos, ts, msg.role, line as first_part from msg join ex using (ord)""")
def _(t):
    m = export.messages(exports(t), ["conv_id", "turn"])
    return m.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("seq").cast("bigint").alias("seq"),
                    F.col("pos").cast("bigint").alias("pos"), "ts", "role", F.col("parts")[0].alias("first_part"))


SQL_MARKDOWN = f"""
with {SQL_EXPORTS},
b as (select ord, string_agg('## ' || upper(role[1]) || lower(role[2:]) || chr(10) || chr(10) ||
    case when line <> '' then line || chr(10) || chr(10) else '' end ||
    case when i % 2 = 0 then '' else 'more' || chr(10) || chr(10) end, '' order by ts, i) as body
  from msg group by ord)
select ord, regexp_replace(replace(lower(coalesce(title, 'Conversation_' || ord)), ' ', '_'), '[\\\\/*?:"<>|]', '_', 'g')
    || '.md' as file_name,
  '# ' || coalesce(title, 'Conversation_' || ord) || chr(10) || chr(10) ||
  coalesce('**Created:** ' || create_time || chr(10) || chr(10), '') ||
  coalesce('**Conversation ID:** ' || id || chr(10) || chr(10), '') || coalesce(body, '') as content
from ex left join b using (ord)
"""


@catalog.add("cx_05_markdown", SQL_MARKDOWN)
def _(t):
    return export.render(exports(t))


@catalog.add("cx_06_role_names", """
select role, upper(role[1]) || lower(role[2:]) as shown, count(*) as n
from (select case when turn % 2 = 0 then upper(role) else role || ' Bot' end as role from conversations) group by 1, 2""")
def _(t):
    from weftline.functions import text as X

    roles = t.conversations.select(F.expr("if(turn % 2 = 0, upper(role), concat(role, ' Bot'))").alias("role"))
    return roles.groupBy("role", X.capitalize("role").alias("shown")).agg(F.count(F.lit(1)).alias("n"))


@catalog.add("cx_07_file_names", """
select page_id, regexp_replace(replace(lower(url || ' "A|B*" <c>'), ' ', '_'), '[\\\\/*?:"<>|]', '_', 'g') as file_name
from pages""")
def _(t):
    return t.pages.select("page_id", export.file_name(F.concat("url", F.lit(' "A|B*" <c>'))).alias("file_name"))


@catalog.add("cx_08_by_position", f"""
with {SQL_EXPORTS}
select ord, title from ex where ord in (select ord from ({SQL_TITLES}) order by lower(title), ord limit 1 offset 25)""")
def _(t):
    return export.by_position(exports(t), 25).select("ord", "title")


@catalog.add("cx_09_title_search_extract", f"""
with {SQL_EXPORTS}
select ord, id, create_time, len(lines)::BIGINT as n_nodes from ex
where ord in (select ord from ({SQL_TITLES}) where contains(lower(title), 'en'))""")
def _(t):
    found = export.extract_by_title_search(exports(t), "EN")
    return found.select("ord", "id", "create_time", F.size("mapping").cast("bigint").alias("n_nodes"))


@catalog.add("cx_10_thread_view", """
select conv_id as thread_id, turn::BIGINT as created_at, role,
  case when turn % 5 = 4 then '[No content]' when turn % 5 = 3 then '[Image received]'
    when turn % 5 = 2 then '[File received]' else regexp_replace(text, '^\\s+|\\s+$', '', 'g') end as message
from conversations""")
def _(t):
    block = F.expr("""
        case when turn % 5 = 4 then cast(array() as array<struct<type: string, text: string>>)
             else array(named_struct('type', case turn % 5 when 3 then 'image_file' when 2 then 'file' else 'text' end,
                                     'text', text)) end""")
    rows = t.conversations.select(F.col("conv_id").alias("thread_id"), F.col("turn").cast("bigint").alias("created_at"),
                                  "role", block.alias("content"))
    return export.thread_view(rows)
