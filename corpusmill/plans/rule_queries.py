"""Queries that put single rules to work over keys of the tables, each with its SQL. Cases are picked by key, so every row is read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import clean, fixed, shape, text, think
from corpusmill.operators import gates, linkage, ordering, rollup
from corpusmill.plans import pipelines, scan
from corpusmill.plans.text_queries import dealt, load
from corpusmill.sources import jsonl, reports

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def pick(key: Column, values) -> Column:
    """One of the values by key."""
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def said(key: str, values) -> str:
    """``pick`` in SQL."""
    listed = ", ".join("null" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values)
    return f"list_extract([{listed}], ({key} % {len(values)} + 1)::int)"


def part(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"), F.col("p_partkey")


@query("""
select p_partkey, '<think><facet = ' || p_brand || '>' || chr(10) || case when p_partkey % 3 = 0 then p_name || chr(10)
  else '问题拆解：' || chr(10) || '- ' || p_name || chr(10) || '- why' || chr(10) || '证据清单：' || chr(10) || '[证据R1：来源=' || p_brand || '，定位=p1，要点=' || p_name || ']' || chr(10) || '[证据R2：来源=b，定位=p2，要点=c]' || chr(10)
    || '推理链：' || chr(10) || '- S1: ' || p_name || chr(10) || '最终结论摘要：' || chr(10) || '- end ' || p_size || chr(10) end || '</think>' || chr(10) || 'body' as built,
  case p_partkey % 5 when 0 then '<think><facet = F>' || p_name || '</think>x' when 1 then '<think><facet = own>' || p_name || '</think>x' when 2 then '<think><facet = F>' || chr(10) || 'r' || chr(10) || '</think>' || chr(10) || p_name
    when 3 then '<think><facet = F>' || chr(10) || 'F切面推理过程' || chr(10) || '</think>' || chr(10) || p_name else '<thinking>' || p_name end as ensured
from part""")
def think_building(spark, sf_dir):
    """P12 and P13."""
    p, k = part(spark, sf_dir)
    evidence = F.array(F.struct(F.col("p_brand").alias("source"), F.lit("p1").alias("location"), F.col("p_name").alias("summary")), F.struct(F.lit("b").alias("source"), F.lit("p2").alias("location"), F.lit("c").alias("summary")))
    output = F.struct(
        F.array("p_name", F.lit("why")).alias("sub_questions"), evidence.alias("evidences"), F.array(F.struct(F.lit("S1").alias("step_id"), F.col("p_name").alias("logic"))).alias("reasoning_chains"),
        F.concat(F.lit("end "), F.col("p_size").cast("string")).alias("final_conclusion_summary"), F.lit("body").alias("answer_body"),
    )
    reasoning = F.when(k % 3 == 0, F.concat(F.lit("<think> "), "p_name", F.lit(" </think>"))).otherwise("")
    name = F.col("p_name")
    answer = F.when(k % 5 == 0, F.concat(F.lit("<think>"), name, F.lit("</think>x"))).when(k % 5 == 1, F.concat(F.lit("<think><facet = own>"), name, F.lit("</think>x"))).when(k % 5 == 4, F.concat(F.lit("<thinking>"), name)).otherwise(name)
    rows = p.withColumn("o", output)
    return rows.select("p_partkey", think.structured_think(F.col("o"), F.col("p_brand"), reasoning).alias("built"), think.ensure_think(answer, F.when(k % 5 == 2, " <think>r</think>"), F.lit("F")).alias("ensured"))


#: Answers of a judge: plain, fenced, broken, sparse, followed by text, two objects, single quotes, numbers that JSON lacks, the old name of depth, an array, quotes and braces inside a text.
_ANSWERS = (
    '{"semantic_purity_score": "<p>.9", "medical_rigor_score": <r>, "logical_depth_score": <d>, "reason": "ok [<p>]"}',
    'Here:\n```json\n{"semantic_purity_score": "<p>.9", "medical_rigor_score": <r>, "logical_depth_score": <d>, "reason": "ok [<p>]"}\n```',
    "no {idea", '{"semantic_purity_score": <p>, "logical_depth_score": <d>}', '{"semantic_purity_score": <p>} so it is', '{"semantic_purity_score": "<p>"} {"b": 1}',
    "{'semantic_purity_score': <p>}", '{"semantic_purity_score": NaN, "medical_rigor_score": <r>, "logical_depth_score": -Infinity, "reason": "it\'s NaN"}',
    '{"semantic_purity_score": <p>, "logical_coherence_score": 10}', "[<p>, <r>]", '{"semantic_purity_score": <p>, "reason": "a \\"b\\" } \'c\' \\\\", "medical_rigor_score": "x"}', '{"semantic_purity_score": <p>}}, "end"',
)


def _filled(template: Column, values: dict[str, Column]) -> Column:
    """A template with <name> places."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), value)
    return out


def _filled_sql(template: str, *names: str) -> str:
    out = "'" + template.replace("'", "''") + "'"
    for name in names:
        out = f"replace({out}, '<{name}>', {name})"
    return out


def _number_sql(name: str, default: int) -> str:
    """A number in the block, cut to a whole one; the default if there is none."""
    x = f"try_cast(trim(json_extract_string(block, '$.{name}')) as double)"
    return f"coalesce(case when isnan({x}) or isinf({x}) then null else trunc({x}) end, {default})::bigint"


@query("""
with j as (select o_orderkey as k, (60 + o_orderkey % 41)::varchar as p, (70 + o_orderkey % 31)::varchar as r, (50 + o_orderkey % 51)::varchar as d from orders),
w as (select k, case k % """ + str(len(_ANSWERS)) + " " + " ".join(f"when {i} then {_filled_sql(t, 'p', 'r', 'd')}" for i, t in enumerate(_ANSWERS)) + """ end as answer from j),
b as (select k, case when regexp_matches(answer, '(?s)\\{.*\\}') then regexp_extract(answer, '(?s)(\\{.*\\})', 1) else answer end as cut from w),
o as (select k, case when json_valid(cut) then case when json_type(cut) = 'OBJECT' then cut end end as block from b),
s as (select k, case when block is null then 0 else """ + _number_sql("semantic_purity_score", 90) + """ end as purity, case when block is null then 0 else """ + _number_sql("medical_rigor_score", 90) + """ end as rigor,
  case when block is null then 0 else """ + _number_sql("logical_depth_score", 90) + """ end as depth, case when block is null then 'Evaluation error' else coalesce(json_extract_string(block, '$.reason'), 'No explanation provided') end as reason from o)
select k as o_orderkey, purity, rigor, depth, reason, purity >= 85 and rigor >= 90 and depth >= case when k % 3 = 0 then 50 else 85 end as passed,
  purity < 85 and rigor >= 90 and depth >= case when k % 3 = 0 then 50 else 85 end as second,
  chr(10) || chr(10) || '【前一次清洗尝试质量不达标反馈：语义纯净度=' || purity || '/100, 医学严谨度=' || rigor || '/100, 逻辑深度=' || depth || '/100。】'
  || case when purity < 85 then chr(10) || '""" + fixed.FEEDBACK_CLAUSES[0].strip() + """' else '' end
  || case when rigor < 90 then chr(10) || '""" + fixed.FEEDBACK_CLAUSES[1].strip() + """' else '' end
  || case when depth < 85 then chr(10) || '""" + fixed.FEEDBACK_CLAUSES[2].strip() + """' else '' end as feedback from s""")
def judge_parsing(spark, sf_dir):
    """What a judge's answer comes to, whole objects and all that is not one."""
    k = F.col("o_orderkey")
    values = {n: F.format_string("%d", (k % m + b)) for n, m, b in (("p", 41, 60), ("r", 31, 70), ("d", 51, 50))}
    answer = _filled(F.element_at(F.array(*map(F.lit, _ANSWERS)), (k % len(_ANSWERS) + 1).cast("int")), values)
    rows = dealt(load(spark, sf_dir, "orders").select("o_orderkey")).select("o_orderkey", gates.judge_scores(answer).alias("s"))
    simple, scores = k % 3 == 0, [F.col(f"s.{n}") for n in ("purity", "rigor", "depth")]
    return rows.select("o_orderkey", "s.*", gates.purified_enough(F.col("s"), simple).alias("passed"), gates.needs_second_purge(F.col("s"), simple).alias("second"), text.feedback(*scores).alias("feedback"))


#: Ways an audit's answer is wrapped; the second place stands for the object.
_WRAPS = ("so ```json\n{x}\n```", "{x}", "{x} and more", "[{x}]", "{x}{x}", "say {x}\n\n", "```\n{x}```", "\u3000{x}", "[1, 2", "")


@query(f"""
with a as (select p_partkey as k, {said('p_partkey', ('KEEP', 'edit', 'DISCARD', 'odd', None))} as v, p_partkey % 7 = 0 as forced, p_partkey % 13 = 0 as own, p_partkey % 17 = 0 as late, p_name as n,
  {said('p_partkey', ('SAME_LINE', 'AMBIGUOUS_Q', 'MAPPED_BY_Q', 'NO_RAW_MATCH', None))} as m, case when p_partkey % 3 = 0 then '' else 't' end as th, {said('p_partkey', _WRAPS)} as wrap from part),
w as (select *, '{{' || case when v is null then '' else '"verdict":"' || v || '",' end || case when forced then '"is_forced_facet":true,' else '' end || case when own then '"recommended_action":"OWN",' else '' end
  || case when late then '"audit_status":"LATE",' else '' end || '"cot_quality_score":"' || k % 10 || '.7","cot_quality_issues":["' || n || '"]}}' as obj from a),
t as (select *, trim(replace(wrap, '{{x}}', obj), ' ' || chr(10) || chr(12288)) as answer from w),
f as (select *, case when contains(answer, '```') then trim(regexp_extract(answer, '(?s)```(?:json)?\\s*(.*?)\\s*```', 1), ' ' || chr(10)) else answer end as inside from t),
c as (select *, case when regexp_matches(inside, '(?s)\\{{.*\\}}') then regexp_extract(inside, '(?s)(\\{{.*\\}})', 1) else inside end as cut from f),
o as (select *, case when json_valid(cut) then case when json_type(cut) = 'OBJECT' then cut end end as block from c),
b as (select *, case when block is null then 'PARSE_ERROR' else coalesce(json_extract_string(block, '$.audit_status'), 'OK') end as status, upper(coalesce(json_extract_string(block, '$.verdict'), 'REVIEW')) as known from o),
r as (select *, case when block is not null and known in ('KEEP', 'EDIT', 'DISCARD') then known else 'REVIEW' end as verdict, coalesce(json_extract_string(block, '$.is_forced_facet') = 'true', false) as is_forced from b)
select k as p_partkey, status, verdict, case when block is null then 'MANUAL_REVIEW' else coalesce(json_extract_string(block, '$.recommended_action'), case when status <> 'OK' then 'MANUAL_REVIEW' when verdict = 'KEEP' then 'KEEP' when verdict = 'EDIT' then 'REWRITE'
  when verdict = 'DISCARD' and is_forced then 'PRUNE' else 'MANUAL_REVIEW' end) end as action, case when block is null then 'JSON解析失败' else json_extract_string(block, '$.cot_quality_issues[0]') end as issues, case when block is null then 0 else {_number_sql('cot_quality_score', 0)} end as quality,
  case when m is null or m in ('AMBIGUOUS_Q', 'NO_RAW_MATCH') then 'RAW_MAPPING_ERROR' when th = '' then 'MISSING_THINK' else 'AUDIT' end as before,
  case when m is null or m in ('AMBIGUOUS_Q', 'NO_RAW_MATCH') then 'RESTORE_OR_MAP_RAW' when th = '' then 'RESTORE_RAW_OR_REGENERATE' end as before_action from r""")
def audit_results(spark, sf_dir):
    """An audit's answer in every wrapping, names of parts among its issues."""
    p, k = part(spark, sf_dir)
    verdict = pick(k, ("KEEP", "edit", "DISCARD", "odd", None))
    fields = F.struct(
        verdict.alias("verdict"), F.when(k % 7 == 0, True).alias("is_forced_facet"), F.when(k % 13 == 0, "OWN").alias("recommended_action"), F.when(k % 17 == 0, "LATE").alias("audit_status"),
        F.format_string("%d.7", k % 10).alias("cot_quality_score"), F.array("p_name").alias("cot_quality_issues"),
    )
    answer = F.replace(pick(k, _WRAPS), F.lit("{x}"), F.to_json(fields))
    rows = p.select("p_partkey", gates.audit_result(answer).alias("r"), gates.audit_status(pick(k, ("SAME_LINE", "AMBIGUOUS_Q", "MAPPED_BY_Q", "NO_RAW_MATCH", None)), F.when(k % 3 == 0, " \n").otherwise("t")).alias("b"))
    return rows.select(
        "p_partkey", F.col("r.audit_status").alias("status"), F.col("r.verdict").alias("verdict"), F.col("r.recommended_action").alias("action"), F.array_join("r.cot_quality_issues", ",").alias("issues"),
        F.col("r.cot_quality_score").alias("quality"), F.col("b.status").alias("before"), F.col("b.recommended_action").alias("before_action"),
    )


_WANTED = ("gpt-4", "x-pro", "none", "v4", "deep")


@query(f"""
select p_partkey, case {said('p_partkey', _WANTED)} when 'gpt-4' then 'bsp-gpt-4' when 'x-pro' then 'x-pro' when 'v4' then 'a/v4/b' when 'deep' then case when p_partkey % 2 = 0 then 'base' else 'gpt-4o' end
  else case when p_partkey % 2 = 0 then 'base' else 'gpt-4o' end end as model,
  list_transform(list_filter(string_split(p_partkey || ',7 x,,9' || p_size, ','), lambda x: regexp_replace(x, '\\D', '', 'g') <> ''), lambda x: regexp_replace(x, '\\D', '', 'g')::bigint)::varchar as lines from part""")
def model_routing(spark, sf_dir):
    """F39 and F40."""
    p, k = part(spark, sf_dir)
    models = F.array(*map(F.lit, ("gpt-4o", "bsp-gpt-4", "x-pro", "my-x-pro-2", "a/v4/b", "deeper", "base")))
    chosen = text.model_match(pick(k, _WANTED), models, F.when(k % 2 == 0, "base").otherwise("absent"))
    lines = text.int_list(F.concat(k.cast("string"), F.lit(",7 x,,9"), F.col("p_size").cast("string"), F.lit(",99999999999999999999")))
    return p.select("p_partkey", chosen.alias("model"), F.concat(F.lit("["), F.array_join(lines.cast("array<string>"), ", "), F.lit("]")).alias("lines"))


_BODIES = ("涉及数据隐私", "谈供应链", "项目管理", "合规审计", "财务", "抱歉，不能回答", "正常")
_NAMES = ("rigorous data", "a Schema b", "示例视角", "临床", "api")
_THINKS = ("我们被要求输出", "JSON 与 refs", "见 P12 步骤", "由于需要，要求输出", "干净")


@query(f"""
with r as (select p_partkey, {said('p_partkey', _BODIES)} as b, {said('p_partkey', _NAMES)} as n, {said('p_partkey', _THINKS)} as t, case when p_partkey % 3 = 0 then '企业问题' else '问题' end as q from part)
select p_partkey, regexp_matches(b, '数据隐私|供应链|项目管理|合规审计') and not contains(q, '企业') as suspicious, contains(n, 'rigorous data') or contains(n, 'Schema') as corrupted, contains(b, '抱歉') or contains(b, '不能回答') as refused,
  array_to_string(list_filter([case when contains(t, '被要求') then '被要求' end, case when regexp_matches(t, 'JSON|[Ss]chema') then 'JSON/Schema' end, case when regexp_matches(t, 'refs|参考依据') then 'refs' end,
    case when regexp_matches(t, '\\b[Pp]\\d+\\b') then 'P1/P2/P3步骤' end, case when contains(t, '由于') and contains(t, '要求输出') then '格式自我讨论' end], lambda x: x is not null), ',') as traces,
  length(n || ' ' || t) between 4 and 80 and not regexp_matches(lower(n || ' ' || t), '示例\\s*视角|rigorous\\s+data\\s+processing\\s+api|\\bschema\\b|\\bjson\\b|\\bapi\\b') as explained from r""")
def answer_marks(spark, sf_dir):
    """P16, P18, P29, P31 and P38."""
    p, k = part(spark, sf_dir)
    body, name, block = pick(k, _BODIES), pick(k, _NAMES), pick(k, _THINKS)
    return p.select(
        "p_partkey", scan.suspicious(F.when(k % 3 == 0, "企业问题").otherwise("问题"), body).alias("suspicious"), scan.corrupted_planner(name).alias("corrupted"), gates.refused(body).alias("refused"),
        F.array_join(scan.think_noise(block), ",").alias("traces"), gates.explanation_ok(F.concat(name, F.lit(" "), block)).alias("explained"),
    )


_TERMS = ("“阿司匹林”", "", "输入有误", "很长" * 11, None)
_FIXES = ("OAT-1", "", "已修复为PBP", "abcdefghijklmnop", "PBP")


@query(f"""
with r as (select p_partkey, {said('p_partkey', _TERMS)} as t, {said('p_partkey', _FIXES)} as f, repeat('字', (p_partkey % 80)::int) as o, repeat('字', (p_partkey % 60)::int) as c from part)
select p_partkey, case p_partkey % 5 when 0 then '阿司匹林' else '原' end as term, case when length(o) >= 50 and length(c) > 0.7 * length(o) then length(c) else length(o) end::bigint as healed,
  case when f <> '' and length(f) < 15 and not contains(f, '修复') then f else 'OER-9' end as word, p_partkey % 100 > 85 and p_partkey % 2 = 0 as bypass,
  case when p_partkey % 4 = 0 then '药理机制' when p_partkey % 4 = 1 then '安全禁忌' when p_partkey % 4 = 2 then '指南推荐' else '通用' end as category from r""")
def acceptance_gates(spark, sf_dir):
    """P21, P45, P46, P47 and F25."""
    p, k = part(spark, sf_dir)
    original, cleaned = F.repeat(F.lit("字"), (k % 80).cast("int")), F.repeat(F.lit("字"), (k % 60).cast("int"))
    return p.select(
        "p_partkey", gates.smoothed_term(F.lit(" 原 "), pick(k, _TERMS)).alias("term"), F.length(gates.healed_text(original, cleaned)).cast("bigint").alias("healed"), gates.corrected_word(F.lit("OER-9"), pick(k, _FIXES)).alias("word"),
        gates.purity_bypass(k % 100 / 100, F.when(k % 2 == 0, "see Refs here").otherwise("clean")).alias("bypass"), text.reference_category(pick(k, ("说明书 适应症", "说明书 禁忌", "某指南", "说明书"))).alias("category"),
    )


_ASKED = ("有哪些不良反应", "如何达到稳态", "包含哪些成分", "普通问题", "口服剂量")
_FACETS = ("分子机制", "药物相互作用", "示例视角", "临床", "JSON schema", "Schema")
_SAID = ("FORCED_SKIP", "compatible_simple", "INCOMPATIBLE?", "COMPATIBLE", None, "invalid")


@query(f"""
with r as (select p_partkey as k, {said('p_partkey', _ASKED)} as q, {said('p_partkey', _FACETS)} as f, {said('p_partkey', _SAID)} as a from part),
s as (select *, case when q = '有哪些不良反应' and f = '分子机制' then '不良反应机制边界' when q = '如何达到稳态' and f = '药物相互作用' then '药代动力学与个体化剂量调整'
  when f in ('示例视角', 'JSON schema', 'Schema') then case q when '包含哪些成分' then '成分构成' when '有哪些不良反应' then '不良反应' when '口服剂量' then '剂量用法' when '如何达到稳态' then '药代动力学' else '临床事实核验' end else '' end as safe from r)
select k as p_partkey, safe, safe <> '' and k % 2 = 0 as downgrade, case a when 'FORCED_SKIP' then 'FORCED_SKIP' when 'compatible_simple' then 'COMPATIBLE_SIMPLE' else 'COMPATIBLE' end as verdict, coalesce(a, '') <> 'invalid' as valid from s""")
def safe_facets(spark, sf_dir):
    """P48, P49, P50 and X5."""
    p, k = part(spark, sf_dir)
    q, f, a = pick(k, _ASKED), pick(k, _FACETS), pick(k, _SAID)
    down = gates.downgrade_skip(q, f, F.when(k % 2 == 0, 1).otherwise(2))
    return p.select("p_partkey", gates.safe_facet(q, f).alias("safe"), down["downgrade"].alias("downgrade"), gates.compatibility(a).alias("verdict"), gates.facet_valid(a).alias("valid"))


@query("""
with r as (select conv_id as line_num, conv_id % 6 = 0 as bare, conv_id % 7 = 0 as no_think, conv_id % 11 = 0 as broken, conv_id % 5 <> 0 as listed from (select distinct conv_id from conversations)),
s as (select *, case when not listed then 'not_listed' when line_num < 20 then 'before_start' when broken then 'unreadable' when bare then 'already_purified' when no_think then 'no_think' end as why from r),
o as (select line_num, row_number() over (order by line_num) as n from s where why is null)
select s.line_num, case when s.why is null and o.n > 30 then 'over_limit' else s.why end as skip_reason, s.why is null and o.n <= 30 as chosen from s left join o using (line_num)""")
def skip_plan(spark, sf_dir):
    """An allow-list and a start line together, then what a row lacks, then the limit."""
    n = F.col("line_num")
    c = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("line_num")).distinct()
    answer = F.when(n % 7 == 0, "plain").otherwise(" <think>a</think>b")
    rows = c.select(
        "line_num", F.when(n % 11 == 0, "error").otherwise("ok").alias("parse_status"), (n % 6 != 0).alias("has_refs_key"), F.lit(False).alias("has_history_key"), F.array(F.struct(F.lit("p").alias("planner"), answer.alias("answer"))).alias("planners")
    )
    listed = rows.withColumn("on_list", n % 5 != 0)
    planned = pipelines.plan_run(listed.where("on_list"), 20, 30)
    off = listed.where("not on_list").select("line_num", F.lit("not_listed").alias("skip_reason"), F.lit(False).alias("chosen"))
    return planned.select("line_num", "skip_reason", "chosen").unionByName(off)


@query("""
select c_custkey, array_to_string(list_filter([case when c_custkey % 3 <> 0 then 'a' end, 'b', case when c_custkey % 3 <> 2 then 'c' end], lambda x: x is not null), ',') as kept,
  case when c_nationkey < 5 then 'n' || c_nationkey else 'general' end as shot, c_custkey % 4 = 0 as hit, case when c_custkey % 4 = 0 then 'v2' end as response from customer where c_custkey % 10 < 9""")
def lookups(spark, sf_dir):
    """Listed rows, positions taken out, a default, a cache of two versions."""
    c, k = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("c_custkey")
    rows = linkage.only_listed(c, c.where(k % 10 < 9), "c_custkey")
    drop = F.when(k % 3 == 0, F.array(F.lit(0))).when(k % 3 == 2, F.array(F.lit(2), F.lit(9)))
    shots = load(spark, sf_dir, "nation").where("n_nationkey < 5").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("shot"))
    rows = linkage.with_default(rows.withColumn("kept", F.array_join(linkage.drop_positions(F.array(F.lit("a"), F.lit("b"), F.lit("c")), drop), ",")), shots, "c_nationkey", "shot", "general")
    rows = rows.withColumn("cache_key", text.cache_key(F.lit("s"), k.cast("string")))
    old = rows.where(k % 4 == 0).select("cache_key", F.lit("v1").alias("response_json"), F.lit(1).alias("created_at"))
    hits, misses = linkage.cached(rows, old.unionByName(old.select("cache_key", F.lit("v2").alias("response_json"), F.lit(2).alias("created_at"))))
    out = hits.select("c_custkey", "kept", "shot", F.lit(True).alias("hit"), F.col("response_json").alias("response"))
    return out.unionByName(misses.select("c_custkey", "kept", "shot", F.lit(False).alias("hit"), F.lit(None).cast("string").alias("response")))


@query("""
with l as (select doc_id, '数据集第 ' || doc_id || ' 行' || chr(10) || '临床视角: **' || source || '**' || chr(10) || case when doc_id % 3 = 0 then 'SIG_A ' else '' end || text || case when doc_id % 2 = 0 then ' SIG_B' else '' end as v, text, source from documents)
select doc_id as file, 'SIG_A' as signature, doc_id::varchar as dataset_line, source as facet from l where doc_id % 3 = 0
union all select doc_id, 'SIG_B', case when position('SIG_B' in v) <= 501 then doc_id::varchar else 'unknown' end, case when position('SIG_B' in v) <= 501 - length('数据集第 ' || doc_id || ' 行') - 1 then source
  when position('SIG_B' in v) - 500 <= length('数据集第 ' || doc_id || ' 行') + 2 then source else 'unknown' end from l where doc_id % 2 = 0""")
def logged_signatures(spark, sf_dir):
    """F41 over logs made of whole texts."""
    d, k = load(spark, sf_dir, "documents"), F.col("doc_id")
    value = F.concat(F.format_string("数据集第 %d 行\n临床视角: **%s**\n", k, F.col("source")), F.when(k % 3 == 0, "SIG_A ").otherwise(""), F.col("text"), F.when(k % 2 == 0, " SIG_B").otherwise(""))
    return scan.logged(d.select(k.alias("file"), value.alias("value")), ("SIG_A", "SIG_B"))


@query("""
select p_partkey, p_name || ' (site:nmpa.gov.cn OR site:nhc.gov.cn OR site:dxy.cn OR site:yaozh.com OR site:medtrib.cn OR site:ncbi.nlm.nih.gov)' as restricted,
  p_name as unfenced, p_name as unquoted, '&lt;b a=&quot;1&quot;&gt;' || replace(p_name, '&', '&amp;') || '&#039;&lt;/b&gt;' as escaped, p_name || ' \\"q\\" {x}' as quoted,
  'USER ' || p_name || ' BOT' as templated, case when p_partkey % 2 = 0 then p_name else '<think>a ' || p_name end as body, p_name as synthesis, p_partkey % 2 as mentions from part""")
def small_texts(spark, sf_dir):
    """F29, F34, F35, F37, F38, F43, P6, P59 and A18."""
    p, k, n = *part(spark, sf_dir), F.col("p_name")
    answer = F.when(k % 2 == 0, F.concat(F.lit(" <think>a</think>\n"), n)).otherwise(F.concat(F.lit("<think>a "), n))
    refs = F.when(k % 2 == 1, F.array(F.struct(F.lit("https://ncbi.nlm.nih.gov/1").alias("source"), n.alias("context"))))
    return p.select(
        "p_partkey", text.restrict_domains(n, F.array(*map(F.lit, fixed.DOMAINS))).alias("restricted"), text.unfence(F.concat(F.lit("```json\n"), n, F.lit("\n```"))).alias("unfenced"), text.unquote(F.concat(F.lit(" “"), n, F.lit("\" "))).alias("unquoted"),
        text.escape_html(F.concat(F.lit('<b a="1">'), n, F.lit("'</b>"))).alias("escaped"), text.escape_quotes(F.concat(n, F.lit(' "q" {{x}}'))).alias("quoted"),
        text.chat_template(F.concat(F.lit("### Human: "), n, F.lit(" ### Assistant:")), {"### Human:": "USER", "### Assistant:": "BOT"}).alias("templated"), think.body_after_first(answer).alias("body"),
        think.synthesis_body(F.concat(F.lit("<think>x</think> "), n)).alias("synthesis"), rollup.mentions(refs, "ncbi.nlm.nih.gov").cast("bigint").alias("mentions"),
    )


@query("""
with l as (select l_orderkey, array_to_string(list_sort(list(l_returnflag)), ',') as facets, count(*) as n from lineitem group by 1),
r as (select count(*) as attempted, count(*) filter (l_quantity > 25) as passed from lineitem)
select l_orderkey, facets, n, attempted, passed, round(passed * 100.0 / attempted, 6)::double as pass_rate from l cross join r""")
def grouped_and_passed(spark, sf_dir):
    """A4 and A7."""
    lines = load(spark, sf_dir, "lineitem")
    rate = rollup.pass_rate(lines.withColumn("ok", F.col("l_quantity") > 25), "ok").withColumn("pass_rate", F.round("pass_rate", 6))
    grouped = rollup.grouped_logs(lines, "l_orderkey", "l_returnflag").withColumn("facets", F.array_join("facets", ","))
    return grouped.join(F.broadcast(rate))


_CASES = """
with c as (select doc_id as case_id, case doc_id % 3 when 0 then 'standard_clinical' when 1 then 'refusal_boundary' else 'prompt_leakage' end as category,
    case when doc_id % 10 = 0 then '抱歉' when doc_id % 4 = 0 then '{' || text || '}' else text end as body, quality, toxic, doc_id % 7 = 0 as unjudged from labels join documents using (doc_id)),
j as (select *, regexp_matches(body, '抱歉|无法协助|不能回答') as refused, starts_with(body, '{') and ends_with(body, '}') as schema_ok,
    len(list_filter(['the', 'der', 'and'], lambda w: contains(lower(body), w))) / 3.0 as recall from c),
s as (select *, case when unjudged then case when schema_ok and not refused then 10.0 else 2.0 end else quality * 4 + 4.0 end as grounding, case when unjudged then case when schema_ok and not refused then 10.0 else 2.0 end else 9.0 - toxic * 5 end as isolation from j),
e as (select *, schema_ok and not refused and recall >= 0.5 and grounding >= 6 and isolation >= 6 as success,
    case category when 'prompt_leakage' then isolation >= 6 when 'refusal_boundary' then grounding >= 6 else not refused and recall >= 0.4 and grounding >= 6 and isolation >= 6 end as aligned from s)"""


def _cases(spark, sf_dir):
    d = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    k = F.col("doc_id")
    body = F.when(k % 10 == 0, "抱歉").when(k % 4 == 0, F.concat(F.lit("{"), "text", F.lit("}"))).otherwise(F.col("text"))
    cases = d.select(k.alias("case_id"), pick(k, ("standard_clinical", "refusal_boundary", "prompt_leakage")).alias("category"), F.array(F.lit("the"), F.lit("Der"), F.lit("AND")).alias("expected"), F.concat(F.lit("<think>the</think>"), body).alias("answer"))
    judged = d.where(k % 7 != 0).select(k.alias("case_id"), (F.col("quality") * 4 + 4.0).alias("grounding"), (9.0 - F.col("toxic") * 5).alias("isolation"))
    return rollup.evaluated(cases, judged, ["grounding", "isolation"])


@query(_CASES + " select case_id, category, schema_ok, refused, round(recall, 9)::double as recall, grounding::double as grounding, isolation::double as isolation, success, aligned from e")
def eval_cases(spark, sf_dir):
    """Q11, P44 and the fallback scores of a judge that failed."""
    return _cases(spark, sf_dir).select("case_id", "category", "schema_ok", "refused", F.round("recall", 9).alias("recall"), "grounding", "isolation", "success", "aligned")


@query(_CASES + """ select count(*) as cases, round(avg(success::int) * 100, 2) as success_rate, round(avg(aligned::int) * 100, 2) as aligned_rate, round(avg(schema_ok::int) * 100, 2) as schema_ok_rate,
  round(avg((not refused)::int) * 100, 2) as refusal_avoidance_rate, round(avg(recall), 2)::double as average_recall, round(avg(grounding), 2)::double as mean_grounding, round(avg(isolation), 2)::double as mean_isolation from e""")
def eval_report(spark, sf_dir):
    """Q11 and A5."""
    return rollup.eval_summary(_cases(spark, sf_dir), ["grounding", "isolation"])


@query("""
with v as (select page_id, html, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?>.*?</script>', ' ', 'g'), '(?is)<style.*?>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[\\s\\x0b\\x{a0}\\x{3000}]+', ' ', 'g'), ' ') as t,
    case when page_id % 2 = 0 then 'the' else 'zzz' end as k, trim(regexp_extract(html, '(?i)<title>(.*?)</title>', 1)) as h, trim(regexp_extract(html, '(?i)<meta name="description" content="(.*?)">', 1)) as d from pages),
s as (select *, case when instr(t, k) > 0 then substring(t, greatest(1, instr(t, k) - 250)::int, (instr(t, k) + 250 - greatest(1, instr(t, k) - 250))::int) else '' end as s from v)
select page_id, case when d <> '' and contains(d, k) then '在线医学百科数据库实时抓取' when s <> '' or contains(h, k) then '39健康网在线实时抓取' else '在线公开检索系统抓取异常' end as source,
  md5(case when d <> '' and contains(d, k) then '【公开药品档案】: ' || d when s <> '' then '【39健康网实时检索】: 检索到关于药物【' || k || '】的相关描述: “...' || s || '...”。请详细阅读说明书或遵医嘱。'
    when contains(h, k) then '【39健康网实时检索】: 仅检索到网页标题: ' || h || '。未能获取正文详情。' else '【未收录或网络异常】: 当前未能在公开在线网络(39健康/百科)中抓取到关于【' || k || '】的详细真实数据，可能被防爬拦截，请参考医师建议。' end) as context_md5 from s""")
def page_references(spark, sf_dir):
    """What a page tells of a name, by falling steps."""
    ref = text.page_reference(F.col("html"), F.when(F.col("page_id") % 2 == 0, "the").otherwise("zzz"))
    return load(spark, sf_dir, "pages").select("page_id", ref.alias("r")).select("page_id", F.col("r.source").alias("source"), F.md5("r.context").alias("context_md5"))


@query("""
with r as (select c_custkey as k, (c_custkey % 20)::int as n from customer)
select k as c_custkey, case when n = 0 then '未提供 refs。若无法基于事实锚点判断，请明确标记为 MANUAL_REVIEW，不要臆断。'
  else array_to_string(list_concat(list_transform(generate_series(1, least(n, 16)), lambda i: '[' || i || '] source: s' || i || chr(10) || 'context: ' || case when i * 100 > 800 then repeat('x', 800) || '...' else repeat('x', i * 100) end),
    case when n > 16 then ['... 其余 ' || (n - 16) || ' 条 refs 已截断。'] else [] end), chr(10) || chr(10)) end as shown,
  length(array_to_string(list_transform(generate_series(1, n), lambda i: 's' || i || chr(10) || repeat('x', i * 100)), chr(10)))::bigint as evidence from r""")
def shortened_evidence(spark, sf_dir):
    """O6 and A19."""
    n = (F.col("c_custkey") % 20).cast("int")
    refs = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(F.concat(F.lit("s"), i.cast("string")).alias("source"), F.repeat(F.lit("x"), i * 100).alias("context"))))
    rows = dealt(load(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", refs.alias("refs"))
    return rows.select("c_custkey", ordering.shortened_refs(F.col("refs")).alias("shown"), F.length(clean.evidence_text(F.col("refs"))).cast("bigint").alias("evidence"))


@query("""
with v as (select c_custkey as k, list_transform(generate_series(1, (c_custkey % 11)::int), lambda i: '视角' || i) as v from customer), n as (select k, v, len(v) as n from v)
select k as c_custkey, array_to_string(case when n < 2 then [] when n > 8 then case when k % 2 = 0 then list_transform(generate_series(2, 9), lambda i: '视角' || i) else v[1:8] end when n between 3 and 7 then list_concat(v, ['新增']) else v end, ',') as labels from n""")
def facet_plans(spark, sf_dir):
    """The reducer's eight, the first eight, the expander's union, or none."""
    k = F.col("c_custkey")
    named = lambda i: F.concat(F.lit("视角"), i.cast("string"))
    n = (k % 11).cast("int")
    valid = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), named))
    reduced = F.when(k % 2 == 0, F.transform(F.sequence(F.lit(2), F.lit(9)), named)).otherwise(F.array(F.lit("视角2"), F.lit("{bad}")))
    expanded = F.array(F.lit("视角1"), F.lit(" 新增 "), F.lit("x"))
    return load(spark, sf_dir, "customer").select("c_custkey", F.array_join(gates.plan_facets(valid, reduced, expanded), ",").alias("labels"))


@query("""
with c as (select o_orderkey as line_num, o_orderpriority as raw from orders where o_orderkey % 5 <> 0), b as (select o_orderkey as line_num, 'old ' || o_orderpriority as raw from orders),
r as (select coalesce(c.line_num, b.line_num) as line_num, coalesce(b.raw, c.raw) as raw from c full join (select * from b where line_num between 100 and 5000) b using (line_num)),
p as (select line_num, raw from r where line_num <= 40000)
select 'restored' as step, line_num, raw from r union all select 'rewritten', line_num, raw from p union all select 'rewritten', line_num, raw from c where line_num > (select max(line_num) from p)
union all select 'tail', line_num, raw from c where line_num > 50000""")
def line_merges(spark, sf_dir):
    """A range from a backup, late lines kept, the tail that a backup lacks."""
    o = load(spark, sf_dir, "orders")
    cur = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("line_num"), F.col("o_orderpriority").alias("raw"))
    old = o.select(F.col("o_orderkey").alias("line_num"), F.concat(F.lit("old "), "o_orderpriority").alias("raw"))
    restored = jsonl.restored(cur, old, 100, 5000)
    steps = {"restored": restored, "rewritten": jsonl.rewritten(restored.where("line_num <= 40000"), cur), "tail": jsonl.missing_tail(cur, 50000)}
    out = None
    for name, rows in steps.items():
        own = rows.select(F.lit(name).alias("step"), "line_num", "raw")
        out = own if out is None else out.unionByName(own)
    return out


@query("""
select p_partkey, '{"Q": "' || p_name || '", "extra": ' || p_size || ', "planners": [{"planner": "p", "answer": "new"}], "summary": "s"}' as raw,
  array_to_string(list_filter([case when p_partkey % 2 = 0 then 'keep:' || p_name end, 'guide:' || case when p_partkey % 3 = 0 then 'x' else 'x' || p_name end], lambda x: x is not null), ',') as patched from part""")
def row_patches(spark, sf_dir):
    """Fields replaced and taken out, one facet dropped, a draft's tail cut."""
    p, k = part(spark, sf_dir)
    raw = F.concat(F.lit('{"Q": "'), "p_name", F.lit('", "extra": '), F.col("p_size").cast("string"), F.lit(', "history": [], "planners": [], "refs": null}'))
    changes = F.lit('{"planners": [{"planner": "p", "answer": "new"}], "summary": "s"}')
    first = F.struct(F.when(k % 2 == 0, "keep").otherwise("drop").alias("planner"), F.col("p_name").alias("answer"))
    second = F.struct(F.lit("guide").alias("planner"), F.concat(F.lit("x"), F.when(k % 3 == 0, F.concat(F.lit("DRAFT"), "p_name")).otherwise(F.col("p_name"))).alias("answer"))
    patched = F.transform(pipelines.repaired_row(F.array(first, second), "drop", "guide", "DRAFT"), lambda x: F.concat(x["planner"], F.lit(":"), x["answer"]))
    return p.select("p_partkey", jsonl.with_fields(raw, changes, ("history", "refs")).alias("raw"), F.array_join(patched, ",").alias("patched"))


@query("""
select p_partkey, case when p_partkey % 4 = 0 then '$.a[1].b: "properties"\\s*:' when p_partkey % 4 = 1 then '$.z: pydantic\\s+validation' end as leak from part""")
def prompt_leaks(spark, sf_dir):
    """The first leak of nested JSON, depth first."""
    p, k = part(spark, sf_dir)
    deep = F.struct(F.array(F.struct(F.lit("x").alias("b")), F.struct(F.when(k % 4 == 0, 'a "properties" : b').otherwise("y").alias("b"))).alias("a"), F.when(k % 4 < 2, "Pydantic  Validation").otherwise("fine").alias("z"))
    doc = F.when(k % 4 == 3, "no json").otherwise(F.to_json(deep))
    return p.select("p_partkey", gates.leak_in_json(doc).alias("leak"))


@query("""
with r as (select distinct user_id, event_type from events), o as (select user_id, event_type, min(event_id) as event_id from events group by 1, 2)
select user_id, event_type as context, event_id from o""")
def distinct_references(spark, sf_dir):
    """The first reference of each context."""
    e = load(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("context"), "event_id")
    return pipelines.distinct_refs(e, "user_id", "event_id").select("user_id", "context", "event_id")


@query("""
with t as (select doc_id, '<PubmedArticle><ArticleTitle>T' || doc_id || '</ArticleTitle>' || case when doc_id % 2 = 0 then '<Year>20' || lpad((doc_id % 30)::varchar, 2, '0') || '</Year>' else '<MedlineDate>2001 Jan</MedlineDate>' end as x from documents)
select doc_id, 'T' || doc_id as title, case when doc_id % 2 = 0 then '20' || lpad((doc_id % 30)::varchar, 2, '0') else '2001 Jan' end as date, 'A,B' as authors, 'AIM: u' || chr(10) || 'w' as abstract from t""")
def article_records(spark, sf_dir):
    """S28."""
    k = F.col("doc_id")
    when = F.when(k % 2 == 0, F.format_string("<Year>20%02d</Year>", k % 30)).otherwise("<MedlineDate>2001 Jan</MedlineDate>")
    xml = F.concat(F.format_string("<PubmedArticle><ArticleTitle>T%d</ArticleTitle>", k), when, F.lit('<LastName>A</LastName><LastName>B</LastName><AbstractText Label="AIM">u</AbstractText><AbstractText/><AbstractText>w</AbstractText></PubmedArticle>'))
    return reports.articles(load(spark, sf_dir, "documents").select("doc_id", xml.alias("xml"))).select("doc_id", "title", "date", F.array_join("authors", ",").alias("authors"), "abstract")


@query("""
with c as (select conv_id as line, arg_min(text, turn) as q, count(*) as n from conversations group by 1),
p as (select line, q, 0 as planner_index, 'p0' as facet, case when line % 5 = 0 then 'plain ' || n else '<think>t' || line || '</think>b' || n end as answer from c union all select line, q, 1, 'p1', '<think>u</think>c' from c),
k as (select regexp_replace(q, '[\\s\\x0b\\x{a0}\\x{3000}]+', '', 'g') as k, count(*) as n, min(line) as first from c where line % 3 <> 0 group by 1),
m as (select p.*, case when line % 3 <> 0 then 'SAME_LINE' when coalesce(k.n, 0) = 1 then 'MAPPED_BY_Q' when k.n > 1 then 'AMBIGUOUS_Q' else 'NO_RAW_MATCH' end as status0, case when line % 3 <> 0 then line when k.n = 1 then k.first end as raw_line
  from p left join k on k.k = regexp_replace(p.q, '[\\s\\x0b\\x{a0}\\x{3000}]+', '', 'g') and k.k <> ''),
s as (select *, case when status0 in ('AMBIGUOUS_Q', 'NO_RAW_MATCH') then 'RAW_MAPPING_ERROR' when not contains(answer, '<think>') then 'MISSING_THINK' when line % 7 = 0 then 'PENDING' else 'OK' end as audit_status from m)
select line, planner_index::bigint as planner_index, raw_line, status0 as raw_mapping_status, substring(sha256('{"answer": "' || answer || '", "planner": "' || facet || '"}'), 1, 16) as input_hash, audit_status,
  case when audit_status = 'OK' and planner_index = 0 then 'KEEP' when audit_status = 'OK' then 'EDIT' else 'REVIEW' end as verdict,
  case audit_status when 'RAW_MAPPING_ERROR' then 'RESTORE_OR_MAP_RAW' when 'MISSING_THINK' then 'RESTORE_RAW_OR_REGENERATE' when 'PENDING' then 'MANUAL_REVIEW' else case when planner_index = 0 then 'KEEP' else 'REWRITE' end end as recommended_action from s""")
def mapped_audit(spark, sf_dir):
    """Q4 and X13, replayed: conversations against a copy without each third one, answers for all but each seventh."""
    from corpusmill.plans.audit import audit

    n = F.col("line_num")
    c = load(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("line_num")).agg(F.min_by("text", "turn").alias("q"), F.count(F.lit(1)).alias("n"))
    first = F.when(n % 5 == 0, F.concat(F.lit("plain "), F.col("n").cast("string"))).otherwise(F.concat(F.lit("<think>t"), n.cast("string"), F.lit("</think>b"), F.col("n").cast("string")))
    planners = F.array(F.struct(F.lit("p0").alias("planner"), first.alias("answer")), F.struct(F.lit("p1").alias("planner"), F.lit("<think>u</think>c").alias("answer")))
    records = c.select("line_num", "q", F.lit("ok").alias("parse_status"), planners.alias("planners"), F.lit(None).cast("array<struct<source:string,context:string>>").alias("refs"), F.lit("").alias("summary"), F.lit(False).alias("has_history_key"))
    raw = records.where(n % 3 != 0)
    none = spark.createDataFrame([], "req_id string, content string, error string")
    asked = audit(records.where(n % 7 != 0), raw, none, 0, allow_unmapped=True)["pending"]
    responses = asked.select("req_id", F.when(F.contains("prompt", F.lit("\np0\n")), '{"verdict": "keep"}').otherwise('{"verdict": "EDIT"}').alias("content"), F.lit(None).cast("string").alias("error"))
    rows = audit(records, raw, responses, 0, allow_unmapped=True)["rows"]
    return rows.select("line", F.col("planner_index").cast("bigint").alias("planner_index"), "raw_line", "raw_mapping_status", "input_hash", "audit_status", "verdict", "recommended_action")


@query(f"""
with c as (select p_partkey as k, substring(p_name, 1, (p_partkey % 20)::int) as label, {said('p_partkey', ('efficacy', 'dosage', 'nope', None))} as category, (p_partkey % 90)::int as n, {said('p_partkey', ('直接相关', 'see json', 'a'))} as why, {said('p_partkey', ('low', 'HIGH', 'medium'))} as risk from part),
v as (select k, list_filter([
    case when length(label) < 2 then 'facets.0.label: string_too_short' when length(label) > 16 then 'facets.0.label: string_too_long' when length(regexp_replace(label, '[^A-Za-z]', '', 'g')) > 8 then 'facets.0.label: value_error facet contains too much English text' end,
    case when category is null then 'facets.0.category: missing' when category = 'nope' then 'facets.0.category: literal_error' end,
    case when n < 4 then 'facets.0.answer_scope: string_too_short' when n > 80 then 'facets.0.answer_scope: string_too_long' end,
    case why when 'see json' then 'facets.0.why_relevant: value_error \\bjson\\b' when 'a' then 'facets.0.why_relevant: string_too_short' end,
    case when risk = 'HIGH' then 'facets.0.risk_level: literal_error' end, case when k % 4 = 0 then 'facets: too_short' end], lambda x: x is not null) as codes from c)
select k as p_partkey, case when k % 11 = 0 then 'json_invalid' else array_to_string(codes, '; ') end as codes, k % 11 <> 0 and len(codes) = 0 as fits from v""")
def plan_violations(spark, sf_dir):
    """What is wrong with plans made of names of parts: missing, of wrong length, not among the choices, with text that is refused, too few, no JSON."""
    p, k = part(spark, sf_dir)
    own = F.struct(
        F.substring(F.col("p_name"), F.lit(1), (k % 20).cast("int")).alias("label"), pick(k, ("efficacy", "dosage", "nope", None)).alias("category"), F.repeat(F.lit("说"), (k % 90).cast("int")).alias("answer_scope"),
        pick(k, ("直接相关", "see json", "a")).alias("why_relevant"), pick(k, ("low", "HIGH", "medium")).alias("risk_level"),
    )
    good = F.struct(F.lit("适应症").alias("label"), F.lit("efficacy").alias("category"), F.lit("说明适应范围").alias("answer_scope"), F.lit("直接相关").alias("why_relevant"), F.lit("low").alias("risk_level"))
    plan = F.to_json(F.struct(F.when(k % 4 == 0, F.array(own)).otherwise(F.array(own, good)).alias("facets")))
    answer = F.when(k % 11 == 0, F.concat(plan, F.lit(" {}"))).otherwise(plan)
    rows = dealt(p.select("p_partkey", "p_name")).select("p_partkey", shape.checked(answer, shape.FACET_PLAN).alias("c"))
    return rows.select("p_partkey", F.array_join("c.codes", "; ").alias("codes"), F.col("c.json").isNotNull().alias("fits"))


def _escaped_sql(text_: str) -> str:
    out = f"replace(replace({text_}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
    for k in range(1, 32):
        named = {8: "b", 9: "t", 10: "n", 12: "f", 13: "r"}.get(k, f"u{k:04x}")
        out = f"replace({out}, chr({k}), chr(92) || '{named}')"
    return out


@query(f"""
with t as (select doc_id, text || chr((doc_id % 31 + 1)::int) || '"' || chr(92) || 'u001F' as v from documents), j as (select doc_id, '{{"doc_id": ' || doc_id || ', "v": "' || {_escaped_sql('v')} || '"}}' as j from t)
select doc_id, md5(j) as json_md5, left(sha256(j), 16) as input_hash from j""")
def python_json_texts(spark, sf_dir):
    """whole texts, each with a control character, quotes and an escape that is none, as Python writes them."""
    d, k = load(spark, sf_dir, "documents"), F.col("doc_id")
    value = F.concat("text", F.char((k % 31 + 1).cast("bigint")), F.lit('"\\u001F'))
    rows = d.select(k, text.python_json({"doc_id": k, "v": value}).alias("j"))
    return rows.select("doc_id", F.md5("j").alias("json_md5"), text.short_hash(F.col("j")).alias("input_hash"))
