"""Queries over the other tables: linkage, roll-ups, windows, cursors, grounding, export. Each has its SQL beside it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions import text
from corpusmill.operators import boundary, gates, linkage, ordering, retrieval, rollup
from corpusmill.plans import pipelines, scan
from corpusmill.plans.text_queries import load
from corpusmill.sources import reports

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_LINKED = """
cur as (select conv_id * 100 + turn as line_num, text as q from conversations where role <> 'system'),
raw0 as (select line_num, q from cur where line_num % 7 <> 0
  union all select line_num + 50, q from cur where line_num % 7 = 0
  union all select line_num + 1000000, q from cur where line_num % 5 = 0 and line_num % 7 = 0),
ck as (select line_num, q, regexp_replace(q, '[\\s\\x0b\\x{a0}\\x{3000}]+', '', 'g') as k from cur),
rk as (select line_num, regexp_replace(q, '[\\s\\x0b\\x{a0}\\x{3000}]+', '', 'g') as k from raw0),
g as (select k, count(*) as n, min(line_num) as first from rk where k <> '' group by 1),
linked as (
  select ck.line_num, case when s.line_num is not null then 'SAME_LINE_Q_MATCH' when coalesce(g.n, 0) = 1 then 'MAPPED_BY_Q' when g.n > 1 then 'AMBIGUOUS_Q' else 'NO_RAW_MATCH' end as mapping_status,
    case when s.line_num is not null then ck.line_num when coalesce(g.n, 0) = 1 then g.first end as raw_line
  from ck left join rk s on s.line_num = ck.line_num and s.k = ck.k left join g on g.k = ck.k)"""


def _linked(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").where("role <> 'system'").select((F.col("conv_id") * 100 + F.col("turn")).alias("line_num"), F.col("text").alias("q"))
    n = F.col("line_num")
    raw = c.where(n % 7 != 0).unionByName(c.where(n % 7 == 0).select((n + 50).alias("line_num"), "q")).unionByName(c.where((n % 5 == 0) & (n % 7 == 0)).select((n + 1_000_000).alias("line_num"), "q"))
    return linkage.link_records(c, raw)


@query(f"with {_LINKED} select line_num, mapping_status, raw_line from linked")
def record_linkage_status(spark, sf_dir):
    return _linked(spark, sf_dir).select("line_num", "mapping_status", "raw_line")


@query(f"""with {_LINKED}
select 'mapping_status' as key, mapping_status as value, count(*) as n from linked group by 2
union all select 'raw_line', coalesce((raw_line % 3)::varchar, 'None'), count(*) from linked group by 2 union all select 'absent', 'UNKNOWN', count(*) from linked""")
def mapping_counts(spark, sf_dir):
    rows = _linked(spark, sf_dir).withColumn("raw_line", F.col("raw_line") % 3)
    return rollup.counts_by(rows, "mapping_status", "raw_line", "absent")


def _conversation_records(spark, sf_dir):
    """A record of each conversation: user turns ask, assistant turns are planners with a block."""
    c = load(spark, sf_dir, "conversations")
    answer = F.when(F.col("turn") % 4 == 3, F.col("text")).otherwise(F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>"), F.col("text")))
    p = F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", F.struct(F.concat(F.lit("p"), F.col("turn").cast("string")).alias("planner"), answer.alias("answer")).alias("p")))))
    return c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("q"), p.alias("p")).select(F.col("conv_id").alias("line_num"), "q", F.transform("p", lambda x: x["p"]).alias("planners"))


@query("""
with a as (select conv_id, count(*) filter (role = 'assistant') as m, count(*) filter (role = 'assistant' and turn % 4 <> 3) as old,
    count(*) filter (role = 'assistant' and (conv_id % 3 <> 0 or turn > 1) and conv_id % 10 <> 0) as n,
    count(*) filter (role = 'assistant' and turn % 4 <> 3 and (conv_id % 3 <> 0 or turn > 1) and conv_id % 10 <> 0) as now from conversations group by 1),
r as (select conv_id as line_num, conv_id % 2 = 0 as has_refs, conv_id % 5 = 0 as had_history, *  from a)
select line_num, array_to_string(list_filter([
  case when not has_refs and now = 0 and old > 0 then 'raw had refs/think but current has no refs and no think' end,
  case when not has_refs and old > now then 'think count decreased ' || old || '->' || now || ' while refs missing' end,
  case when had_history and old > now then 'history missing on a row whose think/planner count decreased' end,
  case when m > 0 and n = 0 then 'planners physically deleted ' || m || '->0' when m > n then 'planner count decreased ' || m || '->' || n end,
  case when has_refs and now = 0 then 'refs/history present but no think remains to purify' end], lambda x: x is not null), '; ') as structural from r""")
def structural_regression(spark, sf_dir):
    ref = F.array(F.struct(F.lit("s").alias("source"), F.lit("c").alias("context")))
    raw = _conversation_records(spark, sf_dir).withColumn("refs", ref).withColumn("has_refs_key", F.lit(True)).withColumn("has_history_key", F.col("line_num") % 5 == 0)
    keep = F.when(F.col("line_num") % 10 == 0, F.array().cast("array<struct<planner:string,answer:string>>")).otherwise(F.filter("planners", lambda p: (F.col("line_num") % 3 != 0) | (F.substring(p["planner"], 2, 9).cast("int") > 1)))
    cur = raw.withColumn("planners", keep).withColumn("has_refs_key", F.col("line_num") % 2 == 0).withColumn("has_history_key", F.lit(False))
    return scan.regressions(linkage.by_position(cur, raw)).select("line_num", F.array_join("structural", "; ").alias("structural"))


@query("""
with s as (select doc_id, quality, toxic, quality * 3 + 6.5 as a, 9.0 - toxic * 4 as b, (doc_id % 5) + 5.5 as c, 10.0 as d, (doc_id % 3) * 2 + 4.0 as e from labels)
select doc_id, round((a + b + c + d + e) / 5, 9) as mean, array_to_string(list_filter([case when a < 6 then 'grounding' end, case when b < 6 then 'isolation' end, case when c < 6 then 'explainability' end,
  case when d < 6 then 'professionalism' end, case when e < 6 then 'relevance' end], lambda x: x is not null), ',') as failed,
  least(a, b, c, d, e) >= 6 and doc_id % 9 <> 0 as passed from s""")
def judge_gate_5d(spark, sf_dir):
    i = F.col("doc_id")
    scores = [("grounding", F.col("quality") * 3 + 6.5), ("isolation", 9.0 - F.col("toxic") * 4), ("explainability", (i % 5) + 5.5), ("professionalism", F.lit(10.0)), ("relevance", (i % 3) * 2 + 4.0)]
    g = gates.five_scores(scores, i % 9 == 0)
    return load(spark, sf_dir, "labels").select("doc_id", F.round(g["mean"], 9).alias("mean"), F.array_join(g["failed"], ",").alias("failed"), g["passed"].alias("passed"))


@query("""
with r as (select l.doc_id, quality, toxic, case doc_id % 3 when 0 then 'standard_clinical' when 1 then 'refusal_boundary' else 'prompt_leakage' end as category,
    (doc_id % 8) / 8.0 as recall, toxic = 1 as refused, n_chars % 2 = 0 as schema_ok, quality * 4 + 4.0 as g from labels l join documents using (doc_id)),
s as (select *, schema_ok and not refused and recall >= 0.5 and g >= 6 and iso >= 6 as success,
  case category when 'prompt_leakage' then iso >= 6 when 'refusal_boundary' then g >= 6 else not refused and recall >= 0.4 and g >= 6 and iso >= 6 end as aligned from (select *, 9.0 - toxic * 4 as iso from r))
select count(*) as cases, round_even(avg(success::int) * 100, 2) as success_rate, round_even(avg(aligned::int) * 100, 2) as aligned_rate, round_even(avg(schema_ok::int) * 100, 2) as schema_ok_rate,
  round_even(avg((not refused)::int) * 100, 2) as refusal_avoidance_rate, round_even(avg(recall), 2) as average_recall, round_even(avg(g), 2) as mean_g from s""")
def eval_rollup(spark, sf_dir):
    j = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    category = F.when(F.col("doc_id") % 3 == 0, "standard_clinical").when(F.col("doc_id") % 3 == 1, "refusal_boundary").otherwise("prompt_leakage")
    r = j.select(category.alias("category"), ((F.col("doc_id") % 8) / 8).alias("recall"), (F.col("toxic") == 1).alias("refused"), (F.col("n_chars") % 2 == 0).alias("schema_ok"), (F.col("quality") * 4 + 4.0).alias("g"), (9.0 - F.col("toxic") * 4).alias("iso"), (F.col("toxic") != 1).alias("refusal_avoided"))
    s = r.withColumn("success", gates.eval_success(F.col("schema_ok"), F.col("refused"), F.col("recall"), F.array("g", "iso"))).withColumn("aligned", gates.aligned_success(F.col("category"), F.col("refused"), F.col("iso"), F.col("g"), F.col("recall"), F.array("g", "iso")))
    return rollup.eval_summary(s, ["g"])


@query("""
with e as (select event_id, value > 50 as ok from events), f as (select event_id from e where ok order by event_id limit 300)
select e.event_id, f.event_id is not null as chosen from e left join f using (event_id)""")
def running_limit(spark, sf_dir):
    return ordering.first_eligible(load(spark, sf_dir, "events"), "event_id", F.col("value") > 50, 300).select("event_id", "chosen")


@query("select user_id, event_type, min(event_id) as event_id from events group by 1, 2")
def first_occurrence(spark, sf_dir):
    return ordering.first_of_each(load(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id")


@query("""
select event_id, row_number() over (partition by user_id order by ts, event_id) as version,
  (row_number() over (partition by user_id order by ts, event_id) = count(*) over (partition by user_id))::int as is_active from events""")
def latest_version(spark, sf_dir):
    return ordering.numbered_versions(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("event_id", F.col("version").cast("bigint").alias("version"), "is_active")


@query("""
with s as (select user_id, event_id, sum((value > 80)::int) over (partition by user_id order by event_id rows unbounded preceding) as section from events)
select user_id, section::bigint as section, min(event_id) as first_line, max(event_id) as last_line, count(*) as n_lines from s where section > 0 group by 1, 2""")
def sections(spark, sf_dir):
    return ordering.sections(load(spark, sf_dir, "events"), "user_id", "event_id", F.col("value") > 80)


_STATUS = "case event_type when 'click' then 'success' when 'view' then 'skipped_view' when 'purchase' then 'rollback' else 'skipped' end"


def _statuses(spark, sf_dir):
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").withColumn("status", F.when(kind == "click", "success").when(kind == "view", "skipped_view").when(kind == "purchase", "rollback").otherwise("skipped"))


@query(f"""
with s as (select user_id, event_id, {_STATUS} as status from events where event_id > 100)
select coalesce(min(event_id) filter (status = 'rollback'), max(event_id) filter (status = 'success') + 1, 1) as next_start, min(event_id) as first_line, max(event_id) as last_line from s""")
def next_cursor(spark, sf_dir):
    return rollup.next_start(_statuses(spark, sf_dir).where("event_id > 100"), "event_id", "status")


@query(f"select {_STATUS} as status, count(*) as n, starts_with({_STATUS}, 'skipped') as is_skip from events group by 1, 3")
def run_status_rollup(spark, sf_dir):
    return rollup.run_statuses(_statuses(spark, sf_dir), "status")


_PLANNER_STATUS = "case when l_returnflag = 'A' and l_discount > 0.09 then 'failed' when l_returnflag = 'R' and l_linenumber > 3 then 'pruned' when l_linestatus = 'O' and l_tax < 0.02 then 'unchanged' when l_quantity = 50 then 'pending' when l_quantity = 49 then 'odd' else 'success' end"


@query(f"""
with s as (select l_orderkey, {_PLANNER_STATUS} as status from lineitem),
g as (select l_orderkey, count(*) as planners, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'pruned') as pruned, count(*) filter (status = 'success') as success, count(*) filter (status = 'unchanged') as unchanged, count(*) filter (status = 'pending') as pending from s group by 1)
select *, case when pending > 0 then 'pending' when failed > 0 or success + unchanged + pruned <> planners or success + unchanged = 0 then 'rollback' when unchanged = planners then 'unchanged' else 'success' end as run_status from g""")
def row_rollback(spark, sf_dir):
    status = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_discount") > 0.09), "failed").when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") > 3), "pruned")
        .when((F.col("l_linestatus") == "O") & (F.col("l_tax") < 0.02), "unchanged").when(F.col("l_quantity") == 50, "pending").when(F.col("l_quantity") == 49, "odd").otherwise("success")
    )
    return rollup.row_outcomes(load(spark, sf_dir, "lineitem").withColumn("status", status), "l_orderkey", "status")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
def seen_entities_anti(spark, sf_dir):
    seen = load(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return linkage.unseen(load(spark, sf_dir, "customer").select("c_custkey"), seen, "c_custkey")


@query("""
select p_brand, p_type from (select distinct p_brand, p_type from part) where (p_brand, p_type) not in (select (p_brand, p_type) from part where p_size < 10)
union select 'seed', n_name from nation""")
def intent_injection(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_brand", "p_type", "p_size")
    own = linkage.unseen(p.select("p_brand", "p_type"), p.where("p_size < 10"), "p_brand", "p_type")
    return own.unionByName(load(spark, sf_dir, "nation").select(F.lit("seed").alias("p_brand"), F.col("n_name").alias("p_type")))


@query("""
select '医疗实体【' || n_name || '】（类型: 普通实体）：' || case when n_nationkey % 2 = 0 then '暂无描述' else 'd' || n_nationkey end as context, '《图谱实体集:' || n_name || '》' as context_source,
  '概念定义: ' || n_name || ' (类型: 普通实体) - ' || case when n_nationkey % 2 = 0 then '暂无描述' else 'd' || n_nationkey end as ref, 'refs:《实体库:' || n_name || '》' as ref_source from nation
union all select '关联关系：【' || s_name || '】与【' || n_name || '】之间存在关联【in】（强度: ' || case when s_suppkey % 2 = 0 then 10 else s_suppkey end || '）', '《图谱关系集:' || s_name || '-' || n_name || '》',
  '知识关联: 【' || s_name || '】 --(in)--> 【' || n_name || '】', 'refs:《图谱关系:' || s_name || '-' || n_name || '》' from supplier join nation on s_nationkey = n_nationkey""")
def graph_context_refs(spark, sf_dir):
    n, s = load(spark, sf_dir, "nation"), load(spark, sf_dir, "supplier")
    nodes = n.select(F.col("n_name").alias("name"), F.lit(None).cast("string").alias("type"), F.when(F.col("n_nationkey") % 2 == 1, F.concat(F.lit(" d"), F.col("n_nationkey").cast("string"))).alias("description"))
    edges = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("sourceName"), F.col("n_name").alias("targetName"), F.lit("in").alias("relationship"), F.when(F.col("s_suppkey") % 2 == 1, F.col("s_suppkey").cast("int")).alias("relationshipStrength"))
    return pipelines.graph_context(nodes, edges)


@query("""
with idx as (select doc_id as row_id, source as entity_name, 'origin ' || lang || (doc_id % 97) as source, text as context from documents),
ask as (select p_partkey as query_id, case p_partkey // 50 % 5 when 0 then 'about src' || (p_partkey // 50 % 20) || '!' when 1 then 'the of ' || p_name when 2 then 'see fr' || (p_partkey // 50 % 97) || ', DE' || (p_partkey // 50 % 89)
    when 3 then 'ereri AND thereand, ' || p_name else 'nowhere RÉEUXPA ' || p_partkey end as query, case when p_partkey // 50 % 7 = 0 then 'src1' else 'none' || p_partkey end as entity from part where p_partkey % 50 = 0),
e as (select query_id, row_id from ask join idx on contains(lower(entity_name), lower(entity)) or contains(lower(query), lower(entity_name))),
rest as (select query_id, list_filter(regexp_split_to_array(trim(regexp_replace(query, '[^\\p{L}\\p{N}_\\s]', ' ', 'g')), '\\s+'), lambda w: length(w) > 1) as words from ask where query_id not in (select query_id from e)),
t as (select query_id, unnest(list_distinct(list_transform(words, lambda w: strip_accents(lower(w))))) as token from rest where not list_has_any(words, ['AND', 'OR', 'NOT'])),
k as (select row_id, unnest(list_distinct(regexp_extract_all(strip_accents(lower(source || ' ' || context || ' ' || entity_name)), '[\\p{L}\\p{N}]+'))) as token from idx),
f as (select query_id, row_id, row_number() over (partition by query_id order by row_id) as n from (select distinct query_id, row_id from t join k using (token))),
w as (select query_id, unnest(words[1:3]) as word, unnest(range(1, 4)) as place from rest where list_has_any(words, ['AND', 'OR', 'NOT'])),
l as (select query_id, place, row_id, context, row_number() over (partition by query_id, place order by row_id) as n from w join idx on contains(lower(context), lower(word)) where word is not null),
o as (select query_id, row_id, row_number() over (partition by query_id, context order by place, row_id) as n from l where n <= 3)
select query_id, row_id, 'entity_like_match' as method, 1 as tier from e union all select query_id, row_id, 'fts5_match', 1 from f where n <= 5 union all select query_id, row_id, 'keyword_like_match', 1 from o where n = 1
union all select query_id, page_id, 'web', 2 from ask join (select min(page_id) as page_id from pages) on true where query_id not in (select query_id from e union select query_id from f union select query_id from o)""")
def tiered_retrieval(spark, sf_dir):
    """Parts ask about documents, by entity, by words in any of three columns, by parts of words where the query is no list of words, and else the web."""
    d = load(spark, sf_dir, "documents")
    source = F.concat(F.lit("origin "), "lang", (F.col("doc_id") % 97).cast("string"))
    index = d.select(F.col("doc_id").alias("row_id"), F.col("source").alias("entity_name"), source.alias("source"), F.col("text").alias("context"))
    i = F.col("p_partkey")
    j = F.expr("p_partkey div 50")
    query = (
        F.when(j % 5 == 0, F.format_string("about src%d!", j % 20)).when(j % 5 == 1, F.concat(F.lit("the of "), "p_name")).when(j % 5 == 2, F.format_string("see fr%d, DE%d", j % 97, j % 89))
        .when(j % 5 == 3, F.concat(F.lit("ereri AND thereand, "), "p_name")).otherwise(F.format_string("nowhere RÉEUXPA %d", i))
    )
    entity = F.when(j % 7 == 0, "src1").otherwise(F.concat(F.lit("none"), i.cast("string")))
    asked = load(spark, sf_dir, "part").where(i % 50 == 0).select(i.alias("query_id"), query.alias("query"), entity.alias("entity"))
    web = load(spark, sf_dir, "pages").agg(F.min("page_id").alias("row_id"))
    second = asked.select("query_id").join(F.broadcast(web)).select("query_id", "row_id", F.lit("web").alias("method"))
    local, found = retrieval.local_hits(asked, index, texts=False)
    return retrieval.first_tier(local, second, found=(found,)).select("query_id", "row_id", "method", "tier")


@query("""
with a as (select conv_id as line_num, turn, row_number() over (partition by conv_id order by turn) - 1 as place, text from conversations where role = 'assistant'),
q as (select conv_id as line_num, arg_min(text, turn) as q, count(*) filter (role = 'assistant') as n from conversations group by 1)
select line_num, place::bigint as place, 'facet p' || turn as instruction, md5(q) as input_md5,
  md5(case when turn % 4 = 3 then text else '<think>' || chr(10) || array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '(?i)the ', '', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) || chr(10) || '</think>' || chr(10) || trim(text, ' ' || chr(9) || chr(10)) end) as output_md5
from a join q using (line_num)
union all select line_num, n::bigint, 'all', md5(q), md5('') from q""")
def sft_export(spark, sf_dir):
    records = _conversation_records(spark, sf_dir).withColumn("summary", F.lit(""))
    out = pipelines.sft_rows(records, ("the ",), "facet %s", "all")
    return out.select("line_num", F.col("place").cast("bigint").alias("place"), "instruction", F.md5("input").alias("input_md5"), F.md5("output").alias("output_md5"))


@query("""
select conv_id as line_num, row_number() over (partition by conv_id order by turn)::int as round, md5(text) as q_md5, length(case when turn % 2 = 0 then '' else trim(text, ' ' || chr(9) || chr(10) || chr(13)) end)::bigint as think_chars from conversations""")
def rounds_flatten(spark, sf_dir):
    c = load(spark, sf_dir, "conversations")
    answer = F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(F.concat(F.when(F.col("turn") % 4 == 3, "see ").otherwise(""), F.lit("<think>"), F.regexp_replace("text", "[<>]", "x"), F.lit("</think>"), F.col("text")))
    turns = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.struct(F.col("text").alias("q"), answer.alias("answer")).alias("r")))).alias("t"))
    rec = turns.select(F.col("conv_id").alias("line_num"), F.transform(F.slice("t", 1, F.size("t") - 1), lambda x: x["r"]).alias("history"), F.element_at("t", -1)["r"].alias("last"))
    out = pipelines.rounds(rec.select("line_num", "history", F.col("last.q").alias("q"), F.col("last.answer").alias("answer")))
    return out.select("line_num", "round", F.md5("q").alias("q_md5"), F.length("parts.think").cast("bigint").alias("think_chars"))


@query("""
select event_id, value, row_number() over (order by case event_type when 'purchase' then 0 when 'click' then 1 else 99 end, event_id) as place from events
qualify place <= 50""")
def severity_order(spark, sf_dir):
    kind = F.col("event_type")
    e = load(spark, sf_dir, "events").withColumn("severity", F.when(kind == "purchase", "CRITICAL").when(kind == "click", "HIGH").otherwise("NONE"))
    first = ordering.top(e, 50, ordering.severity_rank(F.col("severity")), "event_id")
    place = F.row_number().over(Window.orderBy(ordering.severity_rank(F.col("severity")), "event_id"))
    return first.select("event_id", "value", place.cast("bigint").alias("place"))


@query("""
with r as (select event_id, user_id % 50 as cache_key, ts, props from events)
select cache_key, arg_max(event_id, event_id) as event_id, arg_max(props, event_id) as response_json from r group by 1""")
def latest_cache(spark, sf_dir):
    e = load(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("cache_key"), "event_id", F.col("event_id").alias("created_at"), F.col("props").alias("response_json"))
    return reports.latest_cache(e).select("cache_key", "event_id", "response_json")


@query("""
select o_orderkey, case when o_orderkey % 6 = 0 then null else round(o_totalprice)::int end as score_in, case when o_orderkey % 6 = 0 then 90 else trunc(o_totalprice)::bigint end as score
from orders""")
def judge_defaults(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 6 == 0, F.lit(" x ")).otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")))
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 6 != 0, F.round("o_totalprice").cast("int")).alias("score_in"), text.truncate_int(raw).alias("score"))


@query("""
with k as (select doc_id, lang, sha256('premium' || chr(1) || 'judge' || chr(1) || lang) as req_id from documents)
select doc_id, case when lang in ('en', 'de') then 'ok ' || lang end as content, lang not in ('en', 'de') as pending from k""")
def replayed_requests(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", "lang")
    asked = boundary.requests(d, "judge", "premium", F.lit("judge"), F.col("lang"))
    answers = asked.where(F.col("lang").isin("en", "de")).select("req_id", "lang").distinct()
    responses = answers.select("req_id", F.concat(F.lit("ok "), "lang").alias("content"), F.lit("").alias("reasoning"), F.lit(None).cast("string").alias("error"))
    return boundary.replayed(asked, responses)[0].select("doc_id", "content", "pending")


@query("""
with v as (select p_partkey, row_number() over (partition by p_brand order by p_partkey) as n, p_brand, p_size from part)
select p_brand, min(n) filter (p_size > 25) as attempt, arg_min(p_partkey, n) filter (p_size > 25) as p_partkey from v where n <= 3 group by 1""")
def staged_attempts(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    n = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    tries = p.select("p_brand", "p_partkey", "p_size", n.alias("n")).where("n <= 3")
    attempts = [tries.where(F.col("n") == k).drop("n") for k in (1, 2, 3)]
    out = boundary.staged_attempts(tries.select("p_brand").distinct(), attempts, "p_brand", F.col("p_size") > 25)
    return out.select("p_brand", F.col("attempt").cast("bigint").alias("attempt"), "p_partkey")


@query("""
select page_id, url, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) as host from pages where regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) in (select regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) from pages where page_id % 10 = 0)""")
def domain_filter(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    domains = p.where("page_id % 10 = 0").select(F.try_parse_url("url", F.lit("HOST")).alias("domain")).distinct()
    return reports.domain_hits(p, "url", domains).select("page_id", "url", "host")
