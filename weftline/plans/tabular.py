"""Tabular preparation, metrics and models over the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import vectors as V
from weftline.functions import text as X
from weftline.operators import learning, metrics, tabular
from weftline.operators.ordering import positional_join, seeded_hash
from weftline.plans import Catalog, Tables
from weftline.session import cut_lineage

catalog = Catalog()


def loans(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                           F.expr("if(o_orderkey % 10 = 0, null, o_totalprice)").alias("amount"))


@catalog.add("ml_01_null_split_samples", """
select * from (select 'train' as part, o_orderkey from orders where o_orderkey % 10 <> 0 order by md5('42:' || o_orderkey), o_orderkey limit 700)
union all select * from (select 'test', o_orderkey from orders where o_orderkey % 10 = 0 order by md5('42:' || o_orderkey), o_orderkey limit 100)""")
def _(t):
    known, unknown = tabular.split_by_null(loans(t), "amount")
    a = tabular.exact_sample(known, ["o_orderkey"], 700).select(F.lit("train").alias("part"), "o_orderkey")
    b = tabular.exact_sample(unknown, ["o_orderkey"], 100).select(F.lit("test").alias("part"), "o_orderkey")
    return a.unionByName(b)


@catalog.add("ml_02_05_labels", """
select o_orderkey as id, o_orderkey % 5 + 1 as score, case when o_orderkey % 5 + 1 < 3 then 1 else 0 end as low,
  greatest(least(o_orderkey % 5, 4), 0) as clipped, o_orderkey % 5 as zero_based,
  case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 0 end as approved, o_totalprice as price
from orders where o_orderkey % 7 <> 0""")
def _(t):
    raw = t.orders.select(F.col("o_orderkey"), (F.col("o_orderkey") % 5 + 1).alias("score"),
                          F.expr("case o_orderstatus when 'F' then 'Y' when 'O' then 'N' end").alias("decision"),
                          F.expr("if(o_orderkey % 7 = 0, null, o_orderstatus)").alias("name"),
                          F.col("o_totalprice").cast("string").alias("price"))
    named = tabular.named_prices(raw, "name", "price").withColumnRenamed("o_orderkey", "id")
    return named.withColumns({
        "low": tabular.low_score_label(F.col("score")), "clipped": tabular.clipped_label(F.col("score")),
        "zero_based": F.col("score") - 1, "approved": tabular.yes_no(F.col("decision")),
    }).drop("decision", "name")


@catalog.add("ml_06_exact_split", """
with r as (select o_orderkey, row_number() over (order by md5('42:' || o_orderkey), o_orderkey) as i, count(*) over () as n from orders)
select o_orderkey, i <= ceil(n * 0.3) as is_test from r""")
def _(t):
    return tabular.exact_split(t.orders.select("o_orderkey"), ["o_orderkey"], 0.3)


SQL_SCALE = """
 q as (select quantile_cont(p_retailprice, 0.75) - quantile_cont(p_retailprice, 0.25) as iqr, min(p_retailprice) as lo,
   max(p_retailprice) as hi from part),
 sc as (select p_partkey, p_retailprice as x, iqr, lo / iqr as lo, hi / iqr as hi, p_retailprice / iqr as r from part, q),
 pr as (select *, (r - lo) / (hi - lo) * 2 - 1 as y from sc)
"""


@catalog.add("ml_07_08_scaled_prices", f"""
with {SQL_SCALE} select p_partkey, round(r, 6) as robust, round(y, 6) as scaled,
  round(((y + 1) / 2 * (hi - lo) + lo) * iqr, 4) as restored from pr""")
def _(t):
    s = tabular.fit_scaling(t.part, "p_retailprice")
    done = t.part.select("p_partkey", (F.col("p_retailprice") / s.iqr).alias("r"),
                         s.apply(F.col("p_retailprice")).alias("y"))
    return done.select("p_partkey", F.round("r", 6).alias("robust"), F.round("y", 6).alias("scaled"),
                       F.round(s.invert(F.col("y")), 4).alias("restored"))


@catalog.add("ml_09_rmse_mae", """
select round(sqrt(avg((l_extendedprice - 1000 * l_quantity) * (l_extendedprice - 1000 * l_quantity))), 2) as rmse,
  round(avg(abs(l_extendedprice - 1000 * l_quantity)), 2) as mae from lineitem""")
def _(t):
    return metrics.rmse_mae(t.lineitem.withColumn("guess", F.col("l_quantity") * 1000), "l_extendedprice", "guess")


@catalog.add("ml_10_softmax_argmax", """
with m as (select vec_id, embedding::DOUBLE[] as v, list_max(embedding::DOUBLE[]) as top from embeddings),
e as (select vec_id, v, list_transform(v, lambda x: exp(x - top)) as ex, top from m),
s as (select vec_id, v, ex, list_sum(ex) as total, top from e)
select vec_id, round(exp(0) / total, 6) as p_best, (list_position(v, top) - 1)::BIGINT as best, round(ex[1] / total, 6) as p_first from s""")
def _(t):
    p = V.softmax("embedding")
    return t.embeddings.select("vec_id", F.round(F.array_max(p), 6).alias("p_best"), V.argmax("embedding").alias("best"),
                               F.round(p[0], 6).alias("p_first"))


def scored(t: Tables):
    p = (F.col("doc_id") * 37 % 101) / 101.0
    rows = t.labels.select("doc_id", F.col("quality").alias("y"), F.round(p, 2).alias("p"))
    return rows.withColumn("pred", (F.col("p") >= 0.5).cast("int"))


SQL_SCORED = """sc as (select doc_id, quality as y, round((doc_id * 37 % 101) / 101.0, 2) as p,
  case when round((doc_id * 37 % 101) / 101.0, 2) >= 0.5 then 1 else 0 end as pred from labels)"""


@catalog.add("ml_11_binary_metrics", f"""
with {SQL_SCORED}, c as (select count_if(y = 1 and pred = 1)::BIGINT as tp, count_if(y <> 1 and pred = 1)::BIGINT as fp,
  count_if(y = 1 and pred <> 1)::BIGINT as fn, count_if(y <> 1 and pred <> 1)::BIGINT as tn from sc)
select tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy, round(tp / (tp + fp), 6) as precision,
  round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c""")
def _(t):
    m = metrics.binary_metrics(scored(t), "y", "pred")
    return m.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


SQL_REPORT = """
 five as (select doc_id, (quality * 2 + toxic) as y, (doc_id * 37 % 101) % 4 as pred from labels),
 cl as (select distinct y as class from five union select distinct pred from five),
 rp as (select class, count_if(y = class and pred = class) as hit, count_if(pred = class) as claimed,
    count_if(y = class) as support from cl, five group by class),
 rr as (select class, coalesce(hit / nullif(claimed, 0), 0) as precision, coalesce(hit / nullif(support, 0), 0) as recall,
    coalesce(2 * hit / nullif(claimed + support, 0), 0) as f1, support from rp)
"""


def classes(t: Tables):
    return t.labels.select((F.col("quality") * 2 + F.col("toxic")).cast("bigint").alias("y"),
                           (F.col("doc_id") * 37 % 101 % 4).cast("bigint").alias("pred"))


@catalog.add("ml_12_weighted_metrics", f"""
with {SQL_REPORT} select round(sum(recall * support) / sum(support), 6) as accuracy,
  round(sum(precision * support) / sum(support), 6) as precision, round(sum(recall * support) / sum(support), 6) as recall,
  round(sum(f1 * support) / sum(support), 6) as f1 from rr""")
def _(t):
    m = metrics.weighted_metrics(classes(t), "y", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@catalog.add("ml_13_roc_auc", f"""
with {SQL_SCORED}, g as (select p, count_if(y = 1) as pos, count_if(y <> 1) as neg from sc group by p),
r as (select *, sum(neg) over (order by p) - neg as below from g)
select round((sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)))::DOUBLE, 6) as auc,
  round((2 * sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) - 1)::DOUBLE, 6) as gini from r""")
def _(t):
    m = metrics.roc_auc(scored(t), "y", "p")
    return m.select(F.round("auc", 6).alias("auc"), F.round("gini", 6).alias("gini"))


@catalog.add("ml_14_confusion_shares", f"""
with {SQL_SCORED} select y, round(count_if(pred = 0) / (select count(*) from sc), 6) as predicted_0,
  round(count_if(pred = 1) / (select count(*) from sc), 6) as predicted_1 from sc group by y""")
def _(t):
    m = metrics.confusion_shares(scored(t), "y", "pred", [0, 1])
    return m.select("y", F.round("predicted_0", 6).alias("predicted_0"), F.round("predicted_1", 6).alias("predicted_1"))


@catalog.add("ml_15_class_report", f"""
with {SQL_REPORT} select class::BIGINT as class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
  support::BIGINT as support from rr""")
def _(t):
    m = metrics.class_report(classes(t), "y", "pred")
    return m.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@catalog.add("ml_16_approval_rates", f"""
with {SQL_SCORED} select round(avg(y), 6) as actual_rate, round(avg(pred), 6) as predicted_rate,
  round(avg(case when y = 1 and pred = 1 then 1.0::DOUBLE else 0.0::DOUBLE end), 6) as matched_rate from sc""")
def _(t):
    m = metrics.approval_rates(scored(t), "y", "pred")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@catalog.add("ml_17_value_shares", """
select o_orderpriority, count(*) as n, round(count(*) / (select count(*) from orders), 6) as share from orders group by 1""")
def _(t):
    return metrics.value_shares(t.orders, "o_orderpriority").withColumn("share", F.round("share", 6))


@catalog.add("ml_18_credit_scores", f"""
with {SQL_SCORED} select doc_id, case when p > 0.5 then round_even(-350 * ln((p - 0.5) / (1.5 - p)), 0) end as credit_score from sc""")
def _(t):
    return scored(t).select("doc_id", tabular.credit_score(F.col("p")).alias("credit_score"))


def boosted_orders(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "c_acctbal", "c_mktsegment",
        ((F.col("o_totalprice") > 250_000) & (F.col("o_orderpriority") != "5-LOW")).cast("double").alias("label"))
    parts = cut_lineage(tabular.exact_split(rows, ["o_orderkey"], 0.3))
    features = ["o_totalprice", "o_orderpriority", "c_acctbal", "c_mktsegment"]
    return learning.boosted_scores(parts.filter("not is_test").drop("is_test"), parts.filter("is_test").drop("is_test"),
                                   features, "label")


@catalog.add("ml_19_boosted_scores")
def _(t):
    """Boosted trees that learn which orders are dear and not of low priority; model-dependent, so rows only."""
    return boosted_orders(t).select("o_orderkey", "approval", "credit_score")


@catalog.add("ml_19_boosted_quality", """
select ceil(count(*) * 0.3)::BIGINT as rows, 1::BIGINT as in_range, 1::BIGINT as half_of_constant
from orders join customer on o_custkey = c_custkey""")
def _(t):
    """Row count, probabilities in range, and a squared error of at most half the best constant's."""
    error = F.avg(F.pow(F.col("label") - F.col("approval"), 2))
    return boosted_orders(t).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.col("approval").between(0, 1).cast("bigint")).alias("in_range"),
        (error <= 0.5 * F.var_pop("label")).cast("bigint").alias("half_of_constant"))


@catalog.add("ml_20_forest_scenarios")
def _(t):
    """Random forests per embedding scenario; model-dependent, so rows only."""
    e = t.embeddings.withColumn("target", F.col("label").cast("double"))
    half = e.withColumn("embedding", F.slice("embedding", 1, 32))
    return learning.forest_scenarios({"whole": e, "first half": half}, "target", ["vec_id"])


@catalog.add("ml_22_first_seen_ids", """
with f as (select o_orderpriority, min(o_orderkey) as k from orders group by 1),
i as (select o_orderpriority, (row_number() over (order by k) - 1)::BIGINT as category_id from f)
select o_orderkey, category_id from orders join i using (o_orderpriority)""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return tabular.first_seen_ids(rows, "o_orderpriority", ["o_orderkey"]).select("o_orderkey", "category_id")


@catalog.add("ml_23_word_vectors")
def _(t):
    """Skip-gram word vectors over conversations; model-dependent, so rows only."""
    words = t.conversations.select(X.split_words("text").alias("words"))
    return learning.word_vectors(words, "words")


@catalog.add("ml_23_vocabulary", """
with w as (select unnest(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as word from conversations)
select word, 16::BIGINT as dims from w group by word having count(*) >= 3""")
def _(t):
    """Which words get a vector, with a minimum count, and its length."""
    words = t.conversations.select(X.split_words("text").alias("words"))
    return learning.word_vectors(words, "words", min_count=3).select("word", F.size("embedding").cast("bigint").alias("dims"))


@catalog.add("ml_24_analogies", """
with u as (select vec_id, label, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) as v,
    row_number() over (partition by label order by vec_id) as i from embeddings),
rq as (select label as question, vec_id as key, case when i = 3 then -1 else 1 end as sign, v from u where i <= 3),
qp as (select question, unnest(range(64)) as dim, unnest(v) * sign as x from rq),
qv as (select question, list(x order by dim) as qv from (select question, dim, avg(x) as x from qp group by all) group by question),
s as (select question, vec_id as key, list_cosine_similarity(v, qv) as score from u, qv
  where not exists (select 1 from rq where rq.question = qv.question and rq.key = u.vec_id)),
r as (select *, row_number() over (partition by question order by score desc, key) as rank from s)
select question::BIGINT as question, rank::BIGINT as rank, key, round(score, 6) as score from r where rank <= 5""")
def _(t):
    requests = analogy_requests(t)
    vectors = t.embeddings.select(F.col("vec_id").alias("key"), "embedding")
    found = learning.most_similar(vectors, requests, 5)
    return found.select(F.col("question").cast("bigint").alias("question"), "rank", "key", F.round("score", 6).alias("score"))


def analogy_requests(t: Tables):
    """Per label: the first two vectors count for, the third against."""
    left = t.embeddings.select(F.col("label").alias("question"), F.col("vec_id").alias("key"))
    picked = None
    for sign in (1, 1, -1):  # three small aggregates, never a whole label in one place
        first = left.groupBy("question").agg(F.min("key").alias("key")).withColumn("sign", F.lit(sign))
        picked = first if picked is None else picked.unionByName(first)
        left = left.join(F.broadcast(first.select("question", "key")), ["question", "key"], "left_anti")
    return picked


@catalog.add("ml_25_principal_components")
def _(t):
    """Two components of the vectors; their sign is arbitrary, so rows only."""
    return learning.principal_components(t.embeddings).select(
        "vec_id", F.col("components")[0].alias("x"), F.col("components")[1].alias("y"))


@catalog.add("ml_25_spread", """
select count(*) as n, 1::BIGINT as ordered, 1::BIGINT as centred, 1::BIGINT as uncorrelated from embeddings""")
def _(t):
    """What holds for principal components whatever their sign: order of spread, mean zero, no correlation."""
    p = learning.principal_components(t.embeddings).select(F.col("components")[0].alias("x"), F.col("components")[1].alias("y"))
    return p.agg(
        F.count(F.lit(1)).alias("n"), (F.var_pop("x") >= F.var_pop("y")).cast("bigint").alias("ordered"),
        ((F.abs(F.avg("x")) < 1e-6) & (F.abs(F.avg("y")) < 1e-6)).cast("bigint").alias("centred"),
        (F.abs(F.corr("x", "y")) < 1e-6).cast("bigint").alias("uncorrelated"))


@catalog.add("ml_26_moving_average", """
with w as (select user_id, ts, event_id, value, row_number() over (partition by user_id order by ts, event_id) as i,
  count(*) over (partition by user_id) as n, avg(value) over (partition by user_id order by ts, event_id rows between 2 preceding and current row) as m
  from events)
select user_id, event_id, round(case when n < 3 then value else m end, 6) as smooth from w where n < 3 or i >= 3""")
def _(t):
    done = tabular.moving_average(t.events, "user_id", ["ts", "event_id"], "value")
    return done.select("user_id", "event_id", F.round("smooth", 6).alias("smooth"))


SQL_SPANS = """
 tx as (select conv_id, turn, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) as n from conversations),
 sp as (select *, sum(n) over (order by conv_id, turn) as e from tx)
"""


@catalog.add("ml_27_frame_lookup", f"""
with {SQL_SPANS} select event_id, conv_id, turn::BIGINT as turn, (event_id - (e - n))::BIGINT as place
from events join sp on event_id >= e - n and event_id < e""")
def _(t):
    texts = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                                   F.size(X.split_words("text")).cast("bigint").alias("n"))
    spans = tabular.offsets(texts, ["conv_id", "turn"], "n")
    return tabular.locate(t.events.select("event_id"), "event_id", spans).select("event_id", "conv_id", "turn", "place")


LEXICON = {"the": 1.0, "and": 0.5, "les": -1.0, "und": 0.25, "of": -0.5, "de": 2.0}
_LEX = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in LEXICON.items())


@catalog.add("ml_28_prefix_scores", f"""
with lx(word, x) as (values {_LEX}),
w as (select conv_id, turn, unnest(range(1, len(ws) + 1)) as n_words, unnest(ws) as word from (select conv_id, turn,
   list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') as ws from conversations))
select conv_id, turn::BIGINT as turn, n_words::BIGINT as n_words,
  round(coalesce(avg(x) over (partition by conv_id, turn order by n_words), 0), 6) as score from w left join lx using (word)""")
def _(t):
    rows = t.conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "text")
    done = tabular.prefix_scores(rows, ["conv_id", "turn"], "text", LEXICON)
    return done.select("conv_id", "turn", F.col("n_words").cast("bigint").alias("n_words"), F.round("score", 6).alias("score"))


@catalog.add("ud_04_lexicon_scores", f"""
with lx(word, x) as (values {_LEX}),
w as (select doc_id, unnest(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) as word from documents),
s as (select doc_id, avg(x) as score from w join lx using (word) group by doc_id)
select doc_id, round(coalesce(score, 0), 6) as score from documents left join s using (doc_id)""")
def _(t):
    from weftline.functions import plugs

    return t.documents.select("doc_id", F.round(plugs.lexicon_score("text", LEXICON), 6).alias("score"))


@catalog.add("jn_01_suffixed_join", """
select o_custkey as custkey, o_orderkey, o_totalprice as amount_Assistant, c_acctbal as amount_Truth, c_name
from orders join customer on o_custkey = c_custkey""")
def _(t):
    left = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey", F.col("o_totalprice").alias("amount"))
    right = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"), "c_name")
    return tabular.join_with_suffixes(left, right, "custkey", ("_Assistant", "_Truth"))


@catalog.add("jn_02_positional_join", """
with a as (select o_orderkey, row_number() over (order by md5('1:' || o_orderkey), o_orderkey) - 1 as idx from orders),
b as (select c_custkey, row_number() over (order by md5('2:' || c_custkey), c_custkey) - 1 as idx from customer)
select coalesce(a.idx, b.idx)::BIGINT as idx, o_orderkey, c_custkey from a full outer join b on a.idx = b.idx""")
def _(t):
    left, right = t.orders.select("o_orderkey"), t.customer.select("c_custkey")
    return positional_join(left, [seeded_hash(1, "o_orderkey"), "o_orderkey"],
                           right, [seeded_hash(2, "c_custkey"), "c_custkey"])
