"""Raw model outputs derived from conversation turns, evaluation reports, corpus search."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import corpus_search as G
from weftline.operators import trigrams
from weftline.operators import model_outputs as M
from weftline.plans import Catalog, Tables

catalog = Catalog()
KEYS = ["conv_id", "turn"]
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"

# one expression text for both engines; A and B together are the whole turn
RAW = """case (conv_id + turn) % 7
  when 0 then concat('<|channel|>analysis<|message|>', a, '<|end|><|start|>assistant<|channel|>final<|message|>', b, '<|return|>')
  when 1 then text
  when 2 then concat('<|channel|>final<|message|>', a, '<|end|><|channel|>final<|message|>', b, '<|end|>tail')
  when 3 then concat(b, ' <read>{"path":"x"}</read> after <tool_call>{"tool": "grep", "args": {"pat":"y"}}</tool_call> <glob>bad</glob> ', a)
  when 4 then concat(a, NL, 'User: ', b)
  when 5 then concat('<tool_call>{"tool": "bash", "args": {}}</tool_call> ', a, ' <tool_call>{"tool": "glob", "args": {"pat":"z"}} ', b)
  else concat('[{"type": "tool_use", "name": "Read", "input": {"at":1}}]', if_blank) end"""


def outputs(t: Tables):
    base = t.conversations.withColumns({"a": F.expr("substr(text, 1, 40)"), "b": F.expr("substr(text, 41)")})
    raw = RAW.replace("NL", "'\\n'").replace("if_blank", "if(turn % 2 = 0, '', ' ')")
    return base.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "text", F.expr(raw).alias("raw"))


SQL_RAW = ("with o as (select conv_id, turn::BIGINT as turn, text, "
           + RAW.replace("NL", "chr(10)").replace("if_blank", "case when turn % 2 = 0 then '' else ' ' end")
           + " as raw from (select *, text[1:40] as a, text[41:] as b from conversations))")
SQL_LAST = "string_split(raw, '<|channel|>final<|message|>')[-1]"


def sql_before(x: str, mark: str) -> str:
    return f"string_split({x}, '{mark}')[1]"


SQL_FINAL = STRIP.format(x=sql_before(sql_before(sql_before(SQL_LAST, "<|return|>"), "<|end|>"), "<|start|>"))
SQL_BARE = STRIP.format(x=f"regexp_replace({SQL_LAST}, '<\\|[^>]+\\|>', '', 'g')")


@catalog.add("ev_01_final_text", f"{SQL_RAW} select conv_id, turn, {SQL_FINAL} as final from o")
def _(t):
    return outputs(t).select(*KEYS, M.final_text(F.col("raw")).alias("final"))


@catalog.add("ev_02_without_tokens", f"{SQL_RAW} select conv_id, turn, {SQL_BARE} as plain from o")
def _(t):
    return outputs(t).select(*KEYS, M.without_tokens(F.col("raw")).alias("plain"))


@catalog.add("ev_03_channels", f"""{SQL_RAW}
select conv_id, turn, case when contains(raw, '<|channel|>analysis<|message|>') then
   nullif({STRIP.format(x=sql_before("string_split(raw, '<|channel|>analysis<|message|>')[2]", "<|end|>"))}, '') end as thinking,
  case when contains(raw, '<|channel|>final<|message|>') then
   {STRIP.format(x=sql_before(sql_before("string_split(raw, '<|channel|>final<|message|>')[2]", "<|end|>"), "<|return|>"))}
   else {STRIP.format(x="regexp_replace(raw, '<\\|[^>]+\\|>', '', 'g')")} end as content from o""")
def _(t):
    thinking, content = M.split_channels(F.col("raw"))
    return outputs(t).select(*KEYS, thinking.alias("thinking"), content.alias("content"))


@catalog.add("ev_04_tool_arrays", f"{SQL_RAW} select conv_id, turn, starts_with(raw, '[') as is_tool from o")
def _(t):
    return outputs(t).select(*KEYS, M.is_tool_array(F.col("raw")).alias("is_tool"))


@catalog.add("ev_05_06_tool_calls", f"""{SQL_RAW}
select conv_id, turn, case (conv_id + turn) % 7
  when 3 then 'read{{"path":"x"}} grep{{"pat":"y"}}' when 5 then 'glob{{"pat":"z"}}' else '' end as calls from o""")
def _(t):
    calls = M.tool_calls(F.col("raw"))
    return outputs(t).select(*KEYS, F.array_join(
        F.transform(calls, lambda c: F.concat(c["name"], c["args"])), " ").alias("calls"))


@catalog.add("ev_05_closed_tool_calls", f"""{SQL_RAW},
c as (select conv_id, turn, list_concat(list_concat(list_concat(
    list_transform(list_filter(regexp_extract_all(raw, '(?s)<read>(.*?)</read>', 1), lambda x: json_valid(x)), lambda x: 'read' || x),
    list_transform(list_filter(regexp_extract_all(raw, '(?s)<glob>(.*?)</glob>', 1), lambda x: json_valid(x)), lambda x: 'glob' || x)),
    list_transform(list_filter(regexp_extract_all(raw, '(?s)<grep>(.*?)</grep>', 1), lambda x: json_valid(x)), lambda x: 'grep' || x)),
    list_transform(list_filter(regexp_extract_all(raw, '(?s)<tool_call>\\s*(\\{{.*?\\}})\\s*</tool_call>', 1),
      lambda x: json_valid(x) and (x::JSON ->> 'tool') in ('read', 'glob', 'grep')),
      lambda x: (x::JSON ->> 'tool') || (x::JSON -> 'args')::VARCHAR)) as calls from o)
select conv_id, turn, array_to_string(calls, ' ') as calls from c""")
def _(t):
    calls = M.tool_calls(F.col("raw"), lenient=False)
    return outputs(t).select(*KEYS, F.array_join(
        F.transform(calls, lambda c: F.concat(c["name"], c["args"])), " ").alias("calls"))


@catalog.add("ev_07_first_call_only", f"""{SQL_RAW}
select conv_id, turn, case when contains(raw, '</tool_call>') then raw[1:instr(raw, '</tool_call>') + 11]
  when contains(raw, '</read>') then raw[1:instr(raw, '</read>') + 6]
  when contains(raw, '</glob>') then raw[1:instr(raw, '</glob>') + 6]
  when contains(raw, '</grep>') then raw[1:instr(raw, '</grep>') + 6] else raw end as cut from o""")
def _(t):
    return outputs(t).select(*KEYS, M.first_call_only(F.col("raw")).alias("cut"))


@catalog.add("ev_08_without_leak", f"""{SQL_RAW}
select conv_id, turn, case when contains(raw, chr(10) || 'User:')
  then {STRIP.format(x="string_split(raw, chr(10) || 'User:')[1]")} else raw end as cut from o""")
def _(t):
    return outputs(t).select(*KEYS, M.without_leak(F.col("raw")).alias("cut"))


@catalog.add("ev_09_display_text", f"""{SQL_RAW}
select conv_id, turn, {STRIP.format(x="regexp_replace(raw, '(?s)<tool_call>.*?</tool_call>|<(?:read|glob|grep)>.*?</(?:read|glob|grep)>', '', 'g')")} as shown
from o""")
def _(t):
    return outputs(t).select(*KEYS, M.display_text(F.col("raw")).alias("shown"))


@catalog.add("ev_10_flattened_content", """
select conv_id, turn::BIGINT as turn, case when turn % 3 = 0 then text else
  text || chr(10) || '<tool_call>{"tool": "' || role || '", "args": {"n":' || turn || '}}</tool_call>' || chr(10) ||
  'Tool result: ' || text end as flat from conversations""")
def _(t):
    blocks = F.to_json(F.array(
        F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("name"),
                 F.lit(None).cast("struct<n:int>").alias("input"), F.lit(None).cast("string").alias("content")),
        F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.col("role").alias("name"),
                 F.struct(F.col("turn").cast("int").alias("n")).alias("input"), F.lit(None).cast("string").alias("content")),
        F.struct(F.lit("tool_result").alias("type"), F.lit(None).cast("string").alias("text"),
                 F.lit(None).cast("string").alias("name"), F.lit(None).cast("struct<n:int>").alias("input"),
                 F.col("text").alias("content"))))
    content = F.when(F.col("turn") % 3 == 0, F.to_json(F.col("text").cast("variant"))).otherwise(blocks)
    return t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                                  M.flatten_content(content).alias("flat"))


@catalog.add("ev_11_converted_requests", f"""{SQL_RAW}
select conv_id, turn, 'You are a concise coding assistant with tool access.' || chr(10) || chr(10) || 'Use tools.' as system,
  least(4, turn + 1)::BIGINT as n_messages,
  case when contains(raw, '<|channel|>') then {SQL_FINAL} else raw end as last_content, turn % 2 = 0 as stream,
  1024 as max_tokens from o""")
def _(t):
    history = F.expr("transform(sequence(0, cast(turn as int)), i -> named_struct('role', if(i % 2 = 0, 'user', 'assistant'),"
                     " 'content', array(named_struct('type', 'text', 'text', raw))))")
    body = F.to_json(F.struct(history.alias("messages"), (F.col("turn") % 2 == 0).alias("stream")))
    done = outputs(t).withColumn("r", M.convert_request(body, "Use tools."))
    return done.select(
        *KEYS, F.col("r.messages")[0]["content"].alias("system"),
        (F.size("r.messages") - 1).cast("bigint").alias("n_messages"),
        F.element_at("r.messages", -1)["content"].alias("last_content"), "r.stream", "r.max_tokens")


@catalog.add("ev_12_converted_responses", f"""{SQL_RAW}
select conv_id, turn, case when not starts_with({SQL_FINAL}, '[') then {SQL_FINAL} end as text,
  case when starts_with({SQL_FINAL}, '[') then 'tool_use' else 'end_turn' end as stop_reason,
  turn as input_tokens, 0::BIGINT as output_tokens from o""")
def _(t):
    body = F.to_json(F.struct(
        F.array(F.struct(F.struct(F.col("raw").alias("content")).alias("message"))).alias("choices"),
        F.struct(F.col("turn").alias("prompt_tokens")).alias("usage")))
    done = outputs(t).withColumn("r", M.convert_response(body))
    return done.select(*KEYS, "r.text", "r.stop_reason", "r.input_tokens",
                       F.col("r.output_tokens").cast("bigint").alias("output_tokens"))


MODELS = ["m0", "m1", "Qwen2.5-3B", "m3"]


def evaluation_log(t: Tables):
    return t.conversations.select(
        F.expr("if(conv_id % 3 = 2, 'Qwen2.5-3B', concat('m', conv_id % 3))").alias("model"), F.expr("concat('prompt | ', conv_id div 4)").alias("prompt"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("step"), F.col("text").alias("answer"),
        F.expr("cast(length(text) div 10 as double) / 100").alias("latency"),
        F.concat("text", "text").alias("tool_result"))


SQL_RESULTS = """
 lg as (select case when conv_id % 3 = 2 then 'Qwen2.5-3B' else 'm' || (conv_id % 3) end as model, 'prompt | ' || (conv_id // 4) as prompt, conv_id * 100 + turn as step,
   text as answer, (length(text) // 10) / 100.0::DOUBLE as latency, text || text as tool_result from conversations),
 rs as (select model, prompt, arg_max(answer, step) as answer, sum(latency) as latency, count(*) as steps,
   arg_max(tool_result, step)[1:800] as tool_result from lg group by model, prompt)
"""


@catalog.add("ev_13_results", f"""
with {SQL_RESULTS} select model, prompt, answer, round(latency, 6) as latency, steps, tool_result from rs""")
def _(t):
    return M.evaluation_results(evaluation_log(t)).withColumn("latency", F.round("latency", 6))


def _sql_cell(m: str) -> str:
    return (f"replace(replace(coalesce(max(case when model = '{m}' then answer end), '*(no result)*'), chr(10), '<br>'), "
            f"'|', '\\|') as \"{m}_answer\", coalesce(printf('%.2f', max(case when model = '{m}' then latency end)) || 's', '—') "
            f"as \"{m}_latency\"")


SQL_PIVOT = f"""
with {SQL_RESULTS}, wide as (select prompt, {', '.join(_sql_cell(m) for m in MODELS)} from rs group by prompt)"""


@catalog.add("ev_14_pivot_report", f"{SQL_PIVOT} select * from wide")
def _(t):
    return M.pivot_results(M.evaluation_results(evaluation_log(t)), MODELS)


@catalog.add("ev_14_report_lines", f"""{SQL_PIVOT},
l as (select prompt, ['### Q: ' || prompt, '', '| | m0 | m1 | Qwen2.5-3B | m3 |', '|---|---|---|---|---|',
  '| **Answer** | ' || m0_answer || ' | ' || m1_answer || ' | ' || "Qwen2.5-3B_answer" || ' | ' || m3_answer || ' |',
  '| **Latency** | ' || m0_latency || ' | ' || m1_latency || ' | ' || "Qwen2.5-3B_latency" || ' | ' || m3_latency || ' |', ''] as ls from wide)
select prompt, unnest(range(7))::BIGINT as line_no, unnest(ls) as line from l""")
def _(t):
    lines = M.report_lines(M.pivot_results(M.evaluation_results(evaluation_log(t)), MODELS), MODELS)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


@catalog.add("ev_15_cells_and_titles", """
select doc_id, replace(replace(text || '|', chr(10), '<br>'), '|', '\\|') as cell,
  case when length(text) > 60 then text[1:60] || '…' else text end as title from documents""")
def _(t):
    return t.documents.select("doc_id", M.cell(F.concat("text", F.lit("|"))).alias("cell"),
                              M.short_title(F.col("text")).alias("title"))


def tool_log(t: Tables):
    return t.conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("step"), F.expr("if(turn % 3 = 0, '', text)").alias("response"),
        F.array(F.struct(F.lit("read").alias("tool"), F.concat(F.lit('{"n":'), F.col("turn"), F.lit("}")).alias("args"),
                         F.col("role").alias("result"))).alias("tool_calls"))


@catalog.add("ev_16_tool_log", """
select conv_id, turn::BIGINT as step, case when turn % 3 = 0 then '' else text || chr(10) end || chr(10) || '**→ read({"n":' || turn ||
  '})**' || chr(10) || '```' || chr(10) || role || chr(10) || '```' as block from conversations""")
def _(t):
    return M.tool_log_blocks(tool_log(t), ["conv_id"])


@catalog.add("ev_16_tool_log_texts", """
with b as (select conv_id, turn, case when turn % 3 = 0 then '' else text || chr(10) end || chr(10) || '**→ read({"n":' || turn ||
  '})**' || chr(10) || '```' || chr(10) || role || chr(10) || '```' as block from conversations)
select conv_id, string_agg(block, chr(10) || chr(10) order by turn) as tool_log from b group by conv_id""")
def _(t):
    return M.tool_logs(tool_log(t), ["conv_id"], per=3)


@catalog.add("ev_17_scenarios", """
with s as (select distinct 'train_from_layer_' || (p_partkey % 37) as name from part where p_partkey % 3 <> 0)
select name, regexp_extract(name, '(\\d+)$', 1)::BIGINT as number,
  (row_number() over (order by regexp_extract(name, '(\\d+)$', 1)::BIGINT, name) - 1)::BIGINT as idx from s""")
def _(t):
    names = t.part.select(F.expr("if(p_partkey % 3 = 0, concat('other_', p_name), "
                                 "concat('train_from_layer_', p_partkey % 37))").alias("name"))
    return M.scenario_order(names, "name", "train_from_layer_")


def corpus(t: Tables):
    return t.documents.select(
        F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), "text")


SQL_CORPUS = "cp as (select source || '/' || lang || '/' || doc_id || '.txt' as path, text from documents)"
SQL_PATH_LINES = f"""{SQL_CORPUS},
 ln as (select path, unnest(range(1, len(ls) + 1)) as line_no, unnest(ls) as line from (
   select path, string_split(case when text like '%' || chr(10) then text[1:-2] else text end, chr(10)) as ls
   from cp where text <> ''))"""


@catalog.add("gr_01_line_slices", f"""
with {SQL_PATH_LINES}, n as (select cp.path, count(ln.line_no) as n from cp left join ln using (path) group by cp.path),
s as (select path, string_agg(lpad(line_no::VARCHAR, greatest(4, length(line_no::VARCHAR))::INT, ' ') || '| ' || line, chr(10) order by line_no) as body
  from ln where line_no between 3 and 7 group by path)
select path, case when n < 2 then 'error: offset 2 out of range (file has ' || n || ' lines)'
  else coalesce(body, '') || case when n > 7 then chr(10) || '... (' || (n - 7) || ' more lines)' else '' end end as shown
from n left join s using (path)""")
def _(t):
    return corpus(t).select("path", G.read_slice(F.col("text"), 2, 5).alias("shown"))


@catalog.add("gr_02_regex_search", f"""
with {SQL_PATH_LINES}, h as (select path, line_no, rtrim(line, ' ') as line from ln where regexp_matches(line, '(?i)[a-z]+tion[.,]')),
r as (select *, row_number() over (order by path, line_no) as i, count(*) over () as n from h)
select path, line_no::BIGINT as line_no, path || ':' || line_no || ':' || line as hit, greatest(n - 80, 0)::BIGINT as more
from r where i <= 80""")
def _(t):
    return G.grep(corpus(t), "(?i)[a-z]+tion[.,]").withColumn("line_no", F.col("line_no").cast("bigint"))


@catalog.add("gr_02_indexed_search", catalog.sql["gr_02_regex_search"])
def _(t):
    """The same search over the stored index: blocks without the required trigrams are not read."""
    return G.grep_index(trigrams.build_index(corpus(t)), "(?i)[a-z]+tion[.,]")


@catalog.add("gr_03_path_listing", f"""
with {SQL_CORPUS} select path from cp where regexp_matches(path, '^(?:.*/)?en/[^/]*\\.txt$')""")
def _(t):
    return G.list_paths(corpus(t).select("path"), "**/en/*.txt")


@catalog.add("gr_04_exact_replace", """
with c as (select page_id, html, (length(html) - length(replace(html, '<li>', ''))) // 4 as n from pages)
select page_id, case when n = 1 then html[1:instr(html, '<li>') - 1] || '[*]' || html[instr(html, '<li>') + 4:] else html end as once,
  case when n = 0 then 'error: old_string not found' when n > 1 then 'error: old_string appears ' || n || ' times (use all=true)'
    else 'ok' end as once_status,
  replace(html, '<li>', '[*]') as every, case when n = 0 then 'error: old_string not found' else 'ok' end as every_status from c""")
def _(t):
    old, new = F.lit("<li>"), F.lit("[*]")
    once, s1 = G.replace_exact(F.col("html"), old, new)
    every, s2 = G.replace_exact(F.col("html"), old, new, everywhere=True)
    return t.pages.select("page_id", once.alias("once"), s1.alias("once_status"), every.alias("every"),
                          s2.alias("every_status"))


@catalog.add("gr_05_capped_output", """
select doc_id, case when length(text) > 2000 then text[1:2000] || chr(10) || '... [truncated ' || (length(text) - 2000) || ' chars]'
  else text end as shown from documents""")
def _(t):
    return t.documents.select("doc_id", G.capped(F.col("text"), 2000).alias("shown"))


@catalog.add("ud_06_tool_dispatch", f"""
with {SQL_PATH_LINES},
kinds as (select item_id as i, case when item_id % 6 = 5 then null else item_id // 2 end as call_id,
    case item_id % 6 when 0 then 'read' when 1 then 'grep' when 2 then 'glob' when 3 then 'draw' when 4 then 'grep' else 'grep' end as name
  from benchmark),
many as (select o_orderkey % 7 as call_id, 'glob' as name, 'src' || (o_orderkey % 9) || '/*/' || o_orderkey || '.txt' as pat from orders)
select call_id, name, line_no::BIGINT as seq, path || ':' || line_no || ':' || line as output
  from kinds, ln where i % 6 in (1, 5) and contains(line, 'tion' || chr((97 + i % 26)::INT))
union all select call_id, name, 0, path from kinds, cp where i % 6 = 2 and regexp_matches(path, '^src[^/]*/[^/]*/' || i || '[^/]*\\.txt$')
union all select call_id, name, 0, 'error: unknown tool ''draw''' from kinds where i % 6 = 3
union all select call_id, name, 0, 'error: missing ), unterminated subpattern at position 0' from kinds where i % 6 = 4
union all select call_id, name, 0, coalesce((select string_agg(lpad(line_no::VARCHAR, 4, ' ') || '| ' || line, chr(10) order by line_no) ||
    case when max(line_no) > 3 then chr(10) || '... (' || (max(line_no) - 3) || ' more lines)' else '' end
    from (select path, case when line_no <= 3 then line end as line, line_no from ln) z where z.path = 'src2/en/' || i || '.txt'),
  'error: not a file: src2/en/' || i || '.txt') from kinds where i % 6 = 0
union all select many.call_id, many.name, 0, cp.path from many join cp
  on string_split(cp.path, '/')[1] = string_split(pat, '/')[1] and string_split(cp.path, '/')[3] = string_split(pat, '/')[3]""")
def _(t):
    """Ids repeat or are null, one call in six has a broken pattern, and every order asks for a search."""
    i = F.col("item_id")
    few = t.benchmark.select(
        F.when(i % 6 != 5, F.floor(i / 2)).cast("bigint").alias("call_id"),
        F.expr("element_at(array('read', 'grep', 'glob', 'draw', 'grep', 'grep'), cast(item_id % 6 as int) + 1)").alias("name"),
        F.expr("""case item_id % 6
            when 0 then concat('{"path": "src2/en/', item_id, '.txt", "limit": 3}')
            when 2 then concat('{"pat": "src*/*/', item_id, '*.txt"}')
            when 4 then '{"pat": "("}'
            else concat('{"pat": "tion', char(97 + item_id % 26), '"}') end""").alias("args"))
    key = F.col("o_orderkey")
    many = t.orders.select(
        (key % 7).alias("call_id"), F.lit("glob").alias("name"),
        F.concat(F.lit('{"pat": "src'), (key % 9).cast("string"), F.lit("/*/"), key.cast("string"), F.lit('.txt"}')).alias("args"))
    return G.run_calls(few.unionByName(many), corpus(t))


@catalog.add("sq_01_largest_order", """
select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey
order by o_totalprice desc, o_orderkey limit 1""")
def _(t):
    top = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)
    return t.customer.join(F.broadcast(top), F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "c_name", "o_totalprice")


@catalog.add("sq_02_best_customer", """
select c_name, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey
group by c_custkey, c_name order by sum(o_totalprice) desc, c_custkey limit 1""")
def _(t):
    # totals first: the join then carries one row per customer
    totals = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    named = totals.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return named.orderBy(F.desc("total"), "c_custkey").limit(1).select("c_name", F.round("total", 2).alias("total"))
