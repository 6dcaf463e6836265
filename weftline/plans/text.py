"""Tokens, summaries and brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import plugs
from weftline.functions import text as X
from weftline.operators import brands as B
from weftline.operators import dictionary
from weftline.operators import summaries as S
from weftline.operators import tokens as K
from weftline.plans import Catalog, Tables
from weftline.plans.retrieval import sql_tokens
from weftline.sources.readers import spread

catalog = Catalog()
V1 = "[,.?_!\"()'']|--|\\s"
SQL_TOKENS = (f"select doc_id, unnest(range(len(ts))) as pos, unnest(ts) as token "
              f"from (select doc_id, {sql_tokens('text')} as ts from documents)")
SQL_VOCAB = f"""
 bt as (select distinct unnest({sql_tokens('text')}) as token from benchmark),
 v0 as (select token, (row_number() over (order by token) - 1)::BIGINT as token_id from bt),
 v as (select * from v0 union all select '<|endoftext|>', count(*) from v0 union all select '<|unk|>', count(*) + 1 from v0)
"""


def vocab(t: Tables):
    return K.vocabulary(K.token_rows(t.benchmark, ["item_id"]), (K.END_OF_TEXT, K.UNKNOWN))


@catalog.add("tk_01_word_tokens", f"""
select doc_id, array_to_string({sql_tokens('text', V1)}, '|') as v1, array_to_string({sql_tokens('text')}, '|') as v2
from documents""")
def _(t):
    return t.documents.select("doc_id", F.array_join(X.word_tokens("text", X.TOKEN_SEPARATORS_V1), "|").alias("v1"),
                              F.array_join(X.word_tokens("text"), "|").alias("v2"))


@catalog.add("tk_02_vocabulary", f"""
select token, (row_number() over (order by token) - 1)::BIGINT as token_id
from (select distinct token from ({SQL_TOKENS}))
union all select '<|endoftext|>', count(distinct token) from ({SQL_TOKENS})
union all select '<|unk|>', count(distinct token) + 1 from ({SQL_TOKENS})""")
def _(t):
    return K.vocabulary(K.token_rows(t.documents, ["doc_id"]), (K.END_OF_TEXT, K.UNKNOWN))


@catalog.add("tk_03_encoded", f"""
with {SQL_VOCAB}, e as (select doc_id, pos, coalesce(token_id, (select token_id from v where token = '<|unk|>')) as id,
  token_id is null as unk from ({SQL_TOKENS}) left join v using (token))
select doc_id, count(*) as n, count_if(unk)::BIGINT as unknown, sum(id * (pos + 1))::BIGINT as checksum from e group by doc_id""")
def _(t):
    table = vocab(t)
    coded = K.encode(K.token_rows(t.documents, ["doc_id"]), table)
    unk = table.filter(F.col("token") == K.UNKNOWN).first()["token_id"]
    return coded.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("token_id") == unk).alias("unknown"),
        F.sum(F.col("token_id") * (F.col("pos") + 1)).alias("checksum"))


@catalog.add("tk_04_decoded", f"""
with {SQL_VOCAB}, e as (select doc_id, pos, coalesce(v.token, '<|unk|>') as token from ({SQL_TOKENS}) d left join v on v.token = d.token)
select doc_id, regexp_replace(string_agg(token, ' ' order by pos), '\\s+([,.?!"()''])', '\\1', 'g') as text from e group by doc_id""")
def _(t):
    table = vocab(t)
    return K.decode(K.encode(K.token_rows(t.documents, ["doc_id"]), table), table, ["doc_id"])


@catalog.add("tk_05_marked_stream", """
select doc_id, case when doc_id = (select max(doc_id) from documents) then text else text || ' <|endoftext|> ' end as piece
from documents""")
def _(t):
    return K.marked_stream(t.documents, "doc_id")


@catalog.add("tk_06_plugged_subwords", """
select doc_id, strlen(text)::BIGINT as n_ids, text as decoded from documents""")
def _(t):
    """A byte-level stand-in for a sub-word tokenizer, encoded and decoded again."""
    ids = plugs.encode_subwords("text", lambda: lambda texts: [list(x.encode()) for x in texts])
    coded = t.documents.select("doc_id", ids.alias("ids"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), plugs.decode_subwords(
        "ids", lambda: lambda rows: [bytes(int(i) for i in r).decode() for r in rows]).alias("decoded"))


SQL_CONV_IDS = """
 w as (select conv_id, turn, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''),
   lambda x: ('0x' || md5(x)[1:4])::BIGINT) as ids from conversations)"""


def conversation_ids(t: Tables):
    ids = F.transform(X.split_words("text"), lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("bigint"))
    return t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), ids.alias("ids"))


def joined(c):
    return F.array_join(c.cast("array<string>"), ",")


@catalog.add("tk_07_token_windows", f"""
with {SQL_CONV_IDS}, s as (select *, unnest(range(0, len(ids) - 8, 4)) as start from w where len(ids) > 8)
select conv_id, turn::BIGINT as turn, start::BIGINT as start, array_to_string(ids[start + 1:start + 8], ',') as input,
  array_to_string(ids[start + 2:start + 9], ',') as target from s""")
def _(t):
    rows = conversation_ids(t).select("conv_id", "turn", F.explode(K.token_windows(F.col("ids"), 8, 4)).alias("w"))
    return rows.select("conv_id", "turn", F.col("w.start").cast("bigint").alias("start"),
                       joined(F.col("w.input")).alias("input"), joined(F.col("w.target")).alias("target"))


@catalog.add("tk_08_growing_contexts", f"""
with {SQL_CONV_IDS}, s as (select *, unnest(range(0, len(ids) - 4, 4)) as start from w where len(ids) > 4),
g as (select *, unnest(range(1, 5)) as n from s)
select conv_id, turn::BIGINT as turn, (start + n)::BIGINT as at, array_to_string(ids[start + 1:start + n], ',') as context,
  ids[start + n + 1] as next from g""")
def _(t):
    wins = conversation_ids(t).select("conv_id", "turn", F.explode(K.token_windows(F.col("ids"), 4, 4)).alias("w"))
    five = F.concat(F.col("w.input"), F.array(F.element_at("w.target", -1)))
    pairs = wins.select("conv_id", "turn", "w.start", F.posexplode(K.growing_contexts(five)).alias("i", "p"))
    return pairs.select("conv_id", "turn", (F.col("start") + F.col("i") + 1).cast("bigint").alias("at"),
                        joined(F.col("p.context")).alias("context"), F.col("p.next").alias("next"))


@catalog.add("tk_09_batches", """
with r as (select conv_id, turn, row_number() over (order by conv_id, turn) - 1 as idx, count(*) over () as n from conversations)
select conv_id, turn::BIGINT as turn, (idx // 7)::BIGINT as batch from r where idx // 7 < n // 7""")
def _(t):
    rows = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"))
    return K.batches(rows, ["conv_id", "turn"], 7)


@catalog.add("tk_10_corpus_counts", f"""
select (select sum(length(text))::BIGINT from documents) as characters, count(*) as tokens,
  count(distinct token) as vocabulary from ({SQL_TOKENS})""")
def _(t):
    return K.corpus_counts(t.documents)


@catalog.add("tk_11_word_prefixes", """
with w as (select conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as ws from conversations),
p as (select *, unnest(range(1, len(ws) + 1)) as n from w)
select conv_id, turn::BIGINT as turn, n::BIGINT as n_words, array_to_string(ws[1:n], ' ') as prefix from p""")
def _(t):
    rows = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "text")
    return K.word_prefixes(rows, ["conv_id", "turn"]).withColumn("n_words", F.col("n_words").cast("bigint"))


@catalog.add("ud_03_token_counts", f"select doc_id, len({sql_tokens('text')})::BIGINT as n_tokens from documents")
def _(t):
    return t.documents.select("doc_id", plugs.token_count("text").alias("n_tokens"))


# ---------------------------------------------------------------- summaries

_STOPS = ", ".join(f"'{w}'" for w in S.STOP_WORDS)
_PUNCT = S.PUNCTUATION.replace("'", "''")
SQL_SENTENCES = """
 st as (select doc_id, list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'),
     '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') as ss from documents),
 se as (select doc_id, unnest(range(len(ss))) as sent, unnest(ss) as sentence from st)
"""
SQL_WORDS = f"""{SQL_SENTENCES},
 tw as (select doc_id, sent, unnest(range(len(ts))) as pos, unnest(ts) as word from (
   select doc_id, sent, {sql_tokens('sentence')} as ts from se)),
 cw as (select * from tw where word not in ({_STOPS}) and not contains('{_PUNCT}', word)),
 fq as (select doc_id, word, count(*) as n, min(sent * 1000000 + pos) as first_at from cw group by doc_id, word),
 fs as (select *, n / max(n) over (partition by doc_id) as share from fq),
 sc as (select doc_id, sent, sum(share) as score from cw join fs using (doc_id, word) group by doc_id, sent),
 rk as (select *, row_number() over (partition by doc_id order by round(score, 9) desc, sent) as rank from sc)
"""


@catalog.add("sm_01_sentences", f"with {SQL_SENTENCES} select doc_id, sent::BIGINT as sent, sentence from se")
def _(t):
    return S.sentence_rows(t.documents, "doc_id").withColumn("sent", F.col("sent").cast("bigint"))


@catalog.add("sm_02_03_keyword_frequencies", f"""
with {SQL_WORDS} select doc_id, word, n, round(share, 6) as share from fs""")
def _(t):
    freq = S.keyword_frequencies(S.content_words(t.documents, "doc_id"), "doc_id")
    return freq.select("doc_id", "word", "n", F.round("share", 6).alias("share"))


@catalog.add("sm_04_top_keywords", f"""
with {SQL_WORDS} select doc_id, rank::BIGINT as rank, word, n from (
  select *, row_number() over (partition by doc_id order by n desc, first_at) as rank from fs) where rank <= 5""")
def _(t):
    freq = S.keyword_frequencies(S.content_words(t.documents, "doc_id"), "doc_id")
    return S.top_keywords(freq, "doc_id").select("doc_id", F.col("rank").cast("bigint").alias("rank"), "word", "n")


@catalog.add("sm_05_07_sentence_scores", f"""
with {SQL_WORDS} select doc_id, sent::BIGINT as sent, rank::BIGINT as rank, round(score, 6) as score from rk""")
def _(t):
    ranked = S.ranked_sentences(S.sentence_scores(S.content_words(t.documents, "doc_id"), "doc_id"), "doc_id")
    return ranked.select("doc_id", F.col("sent").cast("bigint").alias("sent"), F.col("rank").cast("bigint").alias("rank"),
                         F.round("score", 6).alias("score"))


def _clean(x: str) -> str:
    strip = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
    return strip.format("regexp_replace(" + strip.format(x) + ", '^\"+|\"+$', '', 'g')")


@catalog.add("sm_06_08_summaries", f"""
with {SQL_WORDS},
 pk as (select doc_id, string_agg({_clean('sentence')}, ' ' order by rank) as picked from rk join se using (doc_id, sent)
   where rank <= 3 group by doc_id),
 fi as (select doc_id, string_agg({_clean('sentence')}, ' ' order by sent) as firsts from se where sent < 3 group by doc_id),
 kw as (select doc_id, string_agg(word || ':' || n, ' ' order by rank) as words from (
   select *, row_number() over (partition by doc_id order by n desc, first_at) as rank from fs) where rank <= 5 group by doc_id)
select doc_id, coalesce(picked, firsts, '') as summary, len(ss)::BIGINT as num_sentences, coalesce(words, '') as keywords,
  case when len(ss) = 0 then 'Enter some text to summarize.' end as error
from st left join pk using (doc_id) left join fi using (doc_id) left join kw using (doc_id)""")
def _(t):
    done = S.summarize(t.documents, "doc_id")
    words = F.array_join(F.transform("top_keywords", lambda w: F.concat_ws(":", w["word"], w["n"].cast("string"))), " ")
    return done.select("doc_id", "summary", F.col("num_sentences").cast("bigint").alias("num_sentences"),
                       words.alias("keywords"), "error")


# ---------------------------------------------------------------- brands

KNOWN = ["red", "red widget", "blue bolt", "small ring", "gear", "hot"]
TITLE = """concat(upper(substr(p_name, 1, 1)), substr(p_name, 2), case p_partkey % 7 when 0 then ' by Acme''s Tools'
   when 1 then ' Widget Set' when 2 then ' Nike® shoes' when 3 then concat(' ', p_brand) when 4 then ' from Zara Home 21'
   when 5 then ' X' else '' end)"""


def titles(t: Tables):
    # patterns cost far more than the rows weigh, so a table of few splits is spread before them
    return spread(t.part).select("p_partkey", F.expr(TITLE).alias("title"), "p_name", "p_brand", "p_type")


SQL_TITLES = "t as (select p_partkey, " + TITLE + " as title, p_name, p_brand, p_type from part)"
_LIST = ", ".join(f"'{b}'" for b in sorted(KNOWN, key=len, reverse=True))
SQL_KNOWN = f"list_filter([{_LIST}], lambda b: contains(lower(title), b))[1]"
SQL_TITLE_CASED = ("array_to_string(list_transform(string_split(lower(title[instr(lower(title), k)::BIGINT:"
                   "(instr(lower(title), k) + length(k) - 1)::BIGINT]), ' '), lambda w: upper(w[1]) || w[2:]), ' ')")


@catalog.add("bx_01_known_brands", f"""
with {SQL_TITLES}, k as (select *, {SQL_KNOWN} as k from t)
select p_partkey, case when k is not null then {SQL_TITLE_CASED} end as brand from k""")
def _(t):
    return titles(t).select("p_partkey", B.known_brand(F.col("title"), KNOWN).alias("brand"))


@catalog.add("bx_01_dictionary_brands", f"""
with {SQL_TITLES}, d as (select distinct unnest([lower(p_name), lower(p_brand), lower(p_type), concat(lower(p_name), ' ', lower(p_brand))]) as name from part),
k as (select p_partkey, title, name as k from t join d on name <> '' and contains(lower(title), name)
      qualify row_number() over (partition by p_partkey order by length(name) desc, name) = 1)
select p_partkey, title[instr(lower(title), k)::BIGINT:(instr(lower(title), k) + length(k) - 1)::BIGINT] as brand
from t left join k using (p_partkey, title)""")
def _(t):
    name, brand = F.lower("p_name"), F.lower("p_brand")
    names = t.part.select(F.explode(F.array(name, brand, F.lower("p_type"), F.concat(name, F.lit(" "), brand))).alias("name"))
    asked = titles(t).select("p_partkey", "title")
    found = dictionary.longest_names(asked.withColumn("low", F.lower("title")), "low", ["p_partkey", "title"], dictionary.build(names))
    cut = F.substr("title", (F.col("begin") + 1).cast("int"), F.length("name"))
    return asked.select("p_partkey").join(found.select("p_partkey", cut.alias("brand")), "p_partkey", "left")


@catalog.add("ud_04_dictionary_hits", """
with d as materialized (select distinct unnest(string_split_regex(lower(text), '\\s+')) as name from benchmark),
l as materialized (select doc_id, lower(text) as low from documents),
s as (select doc_id, count(*) as n_names, arg_max(name, (length(name), name)) as longest_name
      from l join d on name <> '' and contains(low, name) group by doc_id)
select doc_id, coalesce(n_names, 0) as n_names, longest_name from documents left join s using (doc_id)""")
def _(t):
    names = t.benchmark.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("name"))
    counts = dictionary.name_counts(t.documents.select("doc_id", F.lower("text").alias("low")), "low", ["doc_id"], dictionary.build(names))
    totals = counts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_names"), F.max_by("name", F.struct(F.length("name"), "name")).alias("longest_name"))
    return t.documents.select("doc_id").join(totals, "doc_id", "left").fillna(0, ["n_names"])


CANDIDATES = ("p_brand", "concat(p_name, ' Inc')", "p_name", "concat('Sony ', p_type)", "concat(p_type, ' of old')",
              "concat(p_name, ' ', p_name, ' x')", "'q'")
_SKIPS = " or ".join(f"regexp_matches(c, '{p}')" for p in B.SKIP_PATTERNS)


@catalog.add("bx_02_best_candidates", f"""
with {SQL_TITLES}, c as (select p_partkey, title, unnest(range({len(CANDIDATES)})) as i, unnest([{', '.join(CANDIDATES)}]) as c from t),
s as (select p_partkey, i, c, case when starts_with(lower(title), lower(c)) then 10 else 0 end
   + case when regexp_matches(lower(c), '{'|'.join(B.SCORED_BRANDS)}') then 15 else 0 end
   - case when length(c) > 20 then 5 else 0 end as score from c where length(c) between 2 and 30 and not ({_SKIPS}))
select t.p_partkey, arg_max(c, score * 100 - i) as brand from t left join s using (p_partkey) group by t.p_partkey""")
def _(t):
    found = F.array(*[F.expr(c) for c in CANDIDATES])
    return titles(t).select("p_partkey", B.best_candidate(F.col("title"), found).alias("brand"))


def _lead(p: str) -> str:
    p = p.replace("'", "''")
    return f"regexp_replace(regexp_extract(title, '{p}', 1), '^\\s+|\\s+$', '', 'g')"


@catalog.add("bx_03_leading_phrases", f"""
with {SQL_TITLES}, l as (select p_partkey, {_lead(B.LEADING_PHRASE)} as a, {_lead(B.LEADING_PRODUCT)} as b from t)
select p_partkey, coalesce(case when length(a) between 2 and 19 then a end, case when length(b) between 2 and 19 then b end) as brand
from l""")
def _(t):
    return titles(t).select("p_partkey", B.leading_phrase(F.col("title")).alias("brand"))


_FOUND = "[]::VARCHAR[]"
for _p, _g in B.TITLE_PATTERNS:
    _q = _p.replace("'", "''")
    _FOUND = f"list_concat({_FOUND}, regexp_extract_all(trim(title), '(?i){_q}', {_g}))"
_COMMON = ", ".join(f"'{w}'" for w in B.COMMON_WORDS)
SQL_PATTERN = f"""{SQL_TITLES}, f as (select *, list_filter(list_transform({_FOUND},
   lambda m: regexp_replace(regexp_replace(m, '^\\s+|\\s+$', '', 'g'), '^[®™"'']+|[®™"'']+$', '', 'g')),
   lambda b: length(b) > 1 and not regexp_matches(b, '^\\d+$') and lower(b) not in ({_COMMON})) as found from t),
 pb as (select p_partkey, title, p_brand, coalesce(found[1], '') as pattern from f)"""


@catalog.add("bx_04_pattern_brands", f"with {SQL_PATTERN} select p_partkey, pattern as brand from pb")
def _(t):
    return titles(t).select("p_partkey", B.pattern_brand(F.col("title")).alias("brand"))


SQL_MODEL = f"""{SQL_PATTERN}, mb as (select p_partkey, case when p_partkey % 11 = 0 then ''
   when p_partkey % 5 = 0 then p_brand else pattern end as brand from pb)"""


def extracted(t: Tables):
    title = F.when(F.col("p_partkey") % 11 != 0, F.col("title"))
    model = F.when(F.col("p_partkey") % 5 == 0, F.col("p_brand")).otherwise("")
    return titles(t).select("p_partkey", B.model_or_pattern(model, title).alias("brand"))


@catalog.add("bx_05_model_or_pattern", f"with {SQL_MODEL} select p_partkey, brand from mb")
def _(t):
    return extracted(t)


@catalog.add("bx_06_extraction_stats", f"""
with {SQL_MODEL}, s as (select count(*) as total, count_if(brand <> '')::BIGINT as found from mb)
select total, found, round(found / total, 6) as success_rate, round(1 - found / total, 6) as blank_rate from s""")
def _(t):
    return B.extraction_stats(extracted(t)).select(
        "total", "found", F.round("success_rate", 6).alias("success_rate"), F.round("blank_rate", 6).alias("blank_rate"))


@catalog.add("bx_07_top_brands", f"""
with {SQL_MODEL} select brand, count(*) as n from mb where brand <> '' group by brand order by n desc, brand limit 10""")
def _(t):
    return B.top_values(extracted(t))


@catalog.add("ud_05_annotated_entities", """
select doc_id, len(regexp_extract_all(text, '[0-9]+'))::BIGINT as n_numbers from documents""")
def _(t):
    """A plugged annotator; here a rule that marks numbers."""
    def factory():
        import re

        return lambda texts: [[(m, "NUMBER") for m in re.findall("[0-9]+", text)] for text in texts]

    return plugs.annotate(t.documents.select("doc_id", "text"), "text", factory).select(
        "doc_id", F.size("entities").cast("bigint").alias("n_numbers"))
