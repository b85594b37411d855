"""Stored documents, their re-validation and display, answer shapes, and prompts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarterline.functions.arrays import where_late
from quarterline.operators import analytics as A
from quarterline.operators import claims as C
from quarterline.operators import documents as DOC
from quarterline.operators import drivers as D
from quarterline.operators import grounding as G
from quarterline.operators import narrative as N
from quarterline.operators import observations as O
from quarterline.operators import prompts as P
from quarterline.operators import qa as Q
from quarterline.plans import q_claims as QC
from quarterline.plans import q_drivers as QD
from quarterline.plans import q_grounding as QG
from quarterline.plans import q_narrative as QN
from quarterline.plans import q_observations as QO
from quarterline.plans import q_qa as QQ
from quarterline.plans.catalog import SCOPE_MIN_FISCAL_YEAR, Fixtures, register
from quarterline.plans.fixture_sql import with_all
from quarterline.session import scratch_path
from quarterline.sources import document_store as S
from quarterline.sources import testdata

K = QC.K
_ALL = QC.CLAIM_CTES + QC.ERROR_CTES + QC.RESPONSE_CTES


def _sql(select: str, extra: list | None = None) -> str:
    return with_all("fx_long", *QD._PK, extra=QG.GROUNDING_CTES + _ALL + (extra or [])) + "\n" + select


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _accepted(spark, sf_dir):
    return DOC.accepted_briefings(testdata.fx_responses(QC.Bundle(spark, sf_dir).briefings))


_LABEL = "'Entity ' || CAST(entity_id AS VARCHAR) || ' FY' || CAST(fiscal_year AS VARCHAR) || ' ' || fiscal_period"


@register("briefing_store", sql=_sql(f"""
SELECT {K}, {_LABEL} || CASE WHEN entity_id % 2 = 0 THEN ' revised' ELSE ' in brief' END AS headline, 6 AS insights,
  CAST(1 AS BIGINT) AS copies FROM accept WHERE accepted"""))
def q_briefing_store(spark, sf_dir):
    """Accepted briefings published to a bucketed store, the even entities' published again revised, and read back."""
    path = scratch_path(spark, "accepted")
    DOC.stored_rows(_accepted(spark, sf_dir)).write.parquet(path)
    rows, base = spark.read.parquet(path), scratch_path(spark, "briefings")
    S.publish(rows, base, buckets=8)
    revised = rows.where("entity_id % 2 = 0").withColumn("document", F.regexp_replace("document", '( in brief)(")', ' revised"'))
    S.publish(revised, base)
    doc = F.try_parse_json("document")
    return S.read(spark, base).groupBy(*S.KEY).agg(
        F.max(F.try_variant_get(doc, "$.headline", "string")).alias("headline"),
        F.max(F.size(F.try_variant_get(doc, "$.insights", "array<variant>"))).alias("insights"), F.count("*").alias("copies"))


def _renamed(ctes: list[tuple[str, str]], names: list[str], prefix: str = "", suffix: str = "",
             source: tuple[str, str] | None = None) -> list[tuple[str, str]]:
    """The same CTE chain under new names (references follow FROM / JOIN)."""
    pat = re.compile(r"\b(FROM|JOIN)\s+(" + "|".join(map(re.escape, names)) + r")\b")
    out = []
    for name, sql in ctes:
        sql = pat.sub(lambda m: f"{m.group(1)} {prefix}{m.group(2)}{suffix}", sql)
        if source:
            sql = sql.replace(f"FROM {source[0]}", f"FROM {source[1]}")
        out.append((f"{prefix}{name}{suffix}" if name in names else name, sql))
    return out


# Stored documents whose text was damaged (SQL that both engines read).
DAMAGED = "(entity_id * 3 + fiscal_year) % 11 = 0"


def _revalidate_sql() -> str:
    pipe = _renamed(QO._PIPE, [n for n, _ in QO._PIPE], prefix="o_")
    now = _renamed(QG.GROUNDING_CTES, [n for n, _ in QG.GROUNDING_CTES], suffix="_r", source=("fx_long", "o_facts"))
    st = QC._FST.replace("FROM bfig) c", f"FROM bfig WHERE ({K}) IN (SELECT ({K}) FROM stored)) c").replace(
        "LEFT JOIN gf g", "LEFT JOIN gf_r g")
    listed = "list({'r': role, 's': source_id, 'm': metric, 'v': value} ORDER BY role, metric)"
    extra = pipe + now + [
        ("stored", f"SELECT {K}, {DAMAGED} AS damaged FROM accept WHERE accepted"), ("fst_r", st),
        ("old_f", f"SELECT {K}, {listed} AS f FROM gf GROUP BY {K}"), ("new_f", f"SELECT {K}, {listed} AS f FROM gf_r GROUP BY {K}"),
        ("seen", f"""SELECT s.*, damaged OR new_f.f IS DISTINCT FROM old_f.f AS reevaluated, new_f.f IS NULL AS gone, coalesce(e.n, 0) AS n
          FROM stored s JOIN old_f USING ({K}) LEFT JOIN new_f USING ({K})
          LEFT JOIN (SELECT {K}, sum((status <> 'match')::INT) AS n FROM fst_r GROUP BY ALL) e USING ({K})""")]
    return with_all("fx_long", "fx_obs", *QD._PK, extra=QG.GROUNDING_CTES + _ALL + extra) + f"""
SELECT {K}, reevaluated, CAST(CASE WHEN reevaluated AND NOT damaged THEN n ELSE 0 END AS BIGINT) AS claim_errors,
  CASE WHEN damaged THEN 'malformed' WHEN NOT reevaluated THEN 'approved' WHEN gone THEN 'no_context'
       WHEN n > 0 THEN 'stale' ELSE 'approved' END AS status FROM seen"""


@register("briefing_revalidate", sql=_revalidate_sql())
def q_briefing_revalidate(spark, sf_dir):
    """A10: stored briefings, some damaged, re-validated against figures grounded on the facts derived from
    the filings, where restatements have since been applied; unchanged periods are not evaluated again."""
    accepted = where_late(_accepted(spark, sf_dir).select(*D.PACKET, "packet", "figures", "response", "accepted"), "accepted")
    stored = accepted.select(*D.PACKET, "packet", F.col("response").alias("document"), F.sha2("response", 256).alias("document_digest"),
                             DOC.knowledge_digest().alias("knowledge_digest"))
    stored = stored.withColumn("document", F.when(F.expr(DAMAGED), F.substring("document", 1, 70)).otherwise(F.col("document")))
    wide = A.quarterly_wide(O.facts_from_observations(Fixtures(spark, sf_dir).obs))
    analytics = A.scoped(A.quarterly_analytics(wide), SCOPE_MIN_FISCAL_YEAR)
    now = G.grounding_contexts(analytics, A.annual_complete_scoped(wide, SCOPE_MIN_FISCAL_YEAR))
    now = now.select(*D.PACKET, G.figure_array().alias("figures"))
    x = DOC.revalidated(stored.join(now, D.PACKET, "left"))
    return x.select(*D.PACKET, "reevaluated", "claim_errors", "status")


@register("display_selection", sql=_sql(f"""
SELECT r.entity_id, r.fiscal_year, r.fiscal_period,
  CASE WHEN r.is_valid AND coalesce(c.complete, false) THEN 'ai' ELSE 'deterministic' END AS mode,
  CASE WHEN NOT r.is_valid THEN '{DOC.NO_DRIVERS_STATUS}' WHEN NOT coalesce(c.complete, false) THEN '{DOC.NO_BRIEFING_STATUS}'
       ELSE '{DOC.VALIDATED_STATUS}' END AS status,
  CASE WHEN r.is_valid AND coalesce(c.complete, false) THEN {_LABEL.replace("entity_id", "r.entity_id").replace("fiscal_year", "r.fiscal_year").replace("fiscal_period", "r.fiscal_period")}
       || ' in brief: What the approved sources say about ' || {_LABEL.replace("entity_id", "r.entity_id").replace("fiscal_year", "r.fiscal_year").replace("fiscal_period", "r.fiscal_period")} || '.'
       ELSE t.body END AS content
FROM roles r LEFT JOIN compl c USING ({K}) LEFT JOIN insight_text t USING ({K})""", extra=QN.INSIGHT_TEXTS))
def q_display_selection(spark, sf_dir):
    """I8: the approved briefing's text where drivers are available and it re-validates, else the deterministic insights."""
    x = QC.Bundle(spark, sf_dir).validated
    return DOC.display_selection(x.withColumns({
        "complete": C.contract_failure().isNull(), "ai_text": F.concat_ws(": ", "headline", "executive_summary"),
        "fallback_text": F.array_join(F.transform(N.insight_array(), lambda i: i["body"]), " ")}))


# ------------------------------------------------------------------ answers
# How generated answers are broken, by (abs(session_id) * 3 + turn) % 19, and the rule each breaks.
ANSWER_MOD = 19
ANSWER_FAULTS = [
    ("none", None), ("truncated", None), ("status", "status: domain"), ("long_answer", "answer: length"),
    ("no_claims", "$: supported_facts"), ("number", "claims[0]: number_required"), ("managed", "claims[2]: numeric_management"),
    ("metric_names", "$: metric_names"), ("areas", "suggested_investigation_areas: too_many"), ("missing", "metric_names: missing"),
    ("explanation", "claims[0]: explanation_forbidden"), ("insufficient", "$: unsupported_facts"), ("version", "schema_version: domain"),
]


def answer_texts(answers):
    """Provider answers as JSON texts (``response``), some broken by key."""
    claims = F.transform("claims", lambda c: c.withField("value", c["value"].cast("string")))
    metrics = F.transform("claims", lambda c: c["metric"])
    k = (F.abs("session_id") * 3 + F.col("turn")) % ANSWER_MOD
    names = F.array(*[F.lit(n) for n, _ in ANSWER_FAULTS])
    x = answers.withColumn("_f", F.when(k < len(ANSWER_FAULTS), F.element_at(names, F.least(k + 1, F.lit(len(ANSWER_FAULTS))).cast("int")))
                           .otherwise("none"))
    f = F.col("_f")
    first = lambda change: F.transform(claims, lambda c, i: F.when(i == 0, change(c)).otherwise(c))
    third = lambda change: F.transform(claims, lambda c, i: F.when(i == 2, change(c)).otherwise(c))
    none = F.slice(claims, 1, 0)
    doc = F.struct(
        F.when(f == "version", "0.9").otherwise("1.0").alias("schema_version"),
        F.struct(F.col("claimed_fiscal_year").alias("fiscal_year"), F.col("claimed_fiscal_period").alias("fiscal_period")).alias("reporting_period"),
        F.when(f == "status", "maybe").when(f == "insufficient", "insufficient_context").otherwise("supported").alias("status"),
        F.when(f == "long_answer", F.repeat(F.lit("x"), 1201)).otherwise(F.col("answer_text")).alias("answer"),
        F.col("explanation").alias("plain_language_explanation"),
        F.when(f == "no_claims", none).when(f == "number", first(lambda c: c.withField("unit", F.lit(None).cast("string"))))
        .when(f == "explanation", first(lambda c: c.withField("management_explanation_id", F.lit("demand"))))
        .when(f == "managed", third(lambda c: c.withField("unit", F.lit("usd")))).otherwise(claims).alias("claims"),
        F.when(f == "missing", F.lit(None).cast("array<string>")).when(f == "no_claims", F.slice(metrics, 1, 0))
        .when(f == "metric_names", F.array(F.lit("revenue"))).otherwise(metrics).alias("metric_names"),
        F.col("answer_sources").alias("source_ids"),
        F.when(f == "areas", F.array_repeat(F.lit("margins"), 6)).otherwise(F.col("areas")).alias("suggested_investigation_areas"))
    text = F.to_json(doc)
    return x.withColumn("response", F.when(f == "truncated", F.substring(text, 1, 40)).otherwise(text)).drop("_f")


_ANSWER_RULES = "CASE fault " + " ".join(f"WHEN '{n}' THEN {_lit(r)}" for n, r in ANSWER_FAULTS if r) + " END"
_ANSWER_SHAPE = f"""SELECT session_id, turn, fault <> 'truncated' AS json_ok, CASE WHEN fault <> 'truncated' THEN list_sort(list_filter([
    {_ANSWER_RULES}, CASE WHEN fault = 'missing' THEN '$: metric_names' END], lambda x: x IS NOT NULL)) END AS shape_violations
FROM (SELECT *, CASE WHEN k < {len(ANSWER_FAULTS)} THEN [{', '.join(_lit(n) for n, _ in ANSWER_FAULTS)}][k + 1] ELSE 'none' END AS fault
      FROM (SELECT *, (abs(session_id) * 3 + turn) % {ANSWER_MOD} AS k FROM atx) a) b"""


def _qa_sql(select: str) -> str:
    return with_all("fx_long", *QD._PK, extra=QG.GROUNDING_CTES + QQ.QA_CTES + [("bdj", _DRIVERS_JSON)]) + "\n" + select


# The business-driver part of the context as JSON, keys in alphabetical order.
def _dec(v: str) -> str:
    return QC._PLAIN.format(v=f"CAST({v} AS DECIMAL(38,6))")


_PERIOD_J = "{'fiscal_period': h.fiscal_period, 'fiscal_year': h.fiscal_year::INT}"


def _facts_j(kind: str) -> str:
    return f"""(SELECT coalesce(list({{'classification': classification, 'label': label, 'metric': metric, 'qualifier': qualifier,
      'source_ids': source_ids, 'unit': unit, 'value': {_dec('value')}}} ORDER BY pos), []) FROM pk_facts f
      WHERE kind = '{kind}' AND {QC._on('f', 'h')})"""


def _side_j(direction: str) -> str:
    return f"(SELECT coalesce(list(segment ORDER BY rank), []) FROM rnk r WHERE direction = '{direction}' AND {QC._on('r', 'h')})"


_DRIVERS_JSON = f"""SELECT h.entity_id, h.fiscal_year, h.fiscal_period, CASE WHEN r.valid THEN
  '{{"availability":"available","derived_ranking":' || to_json({{'classification': 'derived',
    'contributions': (SELECT coalesce(list({{'absolute_revenue_change': CAST(absolute_revenue_change AS VARCHAR), 'classification': 'derived',
       'contribution_pct': CAST(CAST(contribution_pct AS DECIMAL(38,2)) AS VARCHAR), 'segment': segment, 'source_ids': source_ids}} ORDER BY segment), [])
       FROM contrib c WHERE {QC._on('c', 'h')}),
    'negative_contributors': {_side_j('negative')}, 'positive_contributors': {_side_j('positive')},
    'reporting_period': {_PERIOD_J}, 'total_revenue_change': CAST(r.reported_increase AS VARCHAR)}})
  || ',"packet":' || to_json({{'derived_metrics': CAST([] AS VARCHAR[]), 'entity': 'Entity ' || CAST(h.entity_id AS VARCHAR),
    'management_explanations': (SELECT coalesce(list({{'attribution': attribution, 'classification': classification,
       'explanation_id': explanation_id, 'source_ids': source_ids, 'statement': statement}} ORDER BY explanation_id), []) FROM pk_explanations e
       WHERE {QC._on('e', 'h')}),
    'product_indicators': {_facts_j('product_indicator')}, 'reported_facts': {_facts_j('reported_fact')},
    'reporting_period': {_PERIOD_J}, 'schema_version': '1.0',
    'segment_results': (SELECT list({{'classification': classification, 'current_revenue': CAST(current_revenue AS VARCHAR),
       'prior_year_revenue': CAST(prior_year_revenue AS VARCHAR), 'reported_growth_pct': {_dec('reported_growth_pct')},
       'segment': segment, 'source_ids': source_ids}} ORDER BY segment) FROM pk_segments s WHERE {QC._on('s', 'h')}),
    'sources': (SELECT list({{'reporting_period': {{'fiscal_period': source_fiscal_period, 'fiscal_year': source_fiscal_year::INT}},
       'source_id': source_id, 'source_type': source_type, 'title': title, 'url': url}}
       ORDER BY CASE WHEN url LIKE '%/press_release' THEN 0 WHEN url LIKE '%/metrics' THEN 1 ELSE 2 END) FROM pk_sources s
       WHERE {QC._on('s', 'h')})}})
  || ',"reporting_period":' || to_json({_PERIOD_J}) || ',"unavailable_reason":null}}'
  ELSE '{{"availability":"unavailable","derived_ranking":null,"packet":null,"reporting_period":' || to_json({_PERIOD_J})
  || ',"unavailable_reason":' || to_json(coalesce(r.first_violation, 'No approved business-driver packet exists for FY'
       || CAST(h.fiscal_year AS VARCHAR) || '-' || h.fiscal_period || '.')) || '}}' END AS bd
FROM ctx h LEFT JOIN recon r USING ({K})"""
_CONTEXT = QG._PROMPT.replace("',\"current_period\":'", "',\"business_drivers\":' || bd || ',\"current_period\":'").replace(
    " FROM ctx", f" FROM ctx JOIN bdj USING ({K})")


@register("briefing_prompts", sql=_qa_sql(f"""
SELECT {K}, {_lit(P.BRIEFING_INSTRUCTIONS)} AS system_instructions, context_json,
  {_lit(P.schema_text(DOC.BRIEFING))} AS output_schema_json FROM ({_CONTEXT}) c"""))
def q_briefing_prompts(spark, sf_dir):
    """H9: instructions, context with business drivers and output shape, per grounded period."""
    return P.briefing_prompts(QC.knowledge(Fixtures(spark, sf_dir)))


@register("qa_prompts", sql=_qa_sql(f"""
SELECT a.session_id, a.turn, {_lit(P.QA_INSTRUCTIONS)} AS system_instructions,
  regexp_replace(q.question, '^\\s+|\\s+$', '', 'g') AS question, c.context_json, coalesce(h.told, '[]') AS history_json,
  {_lit(P.schema_text(DOC.ANSWER))} AS output_schema_json
FROM ans a JOIN qs q USING (session_id, turn) JOIN ({_CONTEXT}) c
  ON c.entity_id = a.entity_id AND c.fiscal_year = a.fiscal_year AND c.fiscal_period = a.fiscal_period
LEFT JOIN (SELECT t.session_id, t.turn, to_json(list({{'answer': e.answer, 'question': e.question}} ORDER BY e.turn)) AS told
  FROM qs t JOIN LATERAL (SELECT * FROM ex WHERE ex.session_id = t.session_id AND ex.turn < t.turn ORDER BY ex.turn DESC LIMIT 3) e ON true
  GROUP BY t.session_id, t.turn) h ON h.session_id = a.session_id AND h.turn = a.turn
WHERE a.mode = 'provider_request'""").replace("\nSELECT a.session_id", """,
ex AS (SELECT session_id, turn, question, answer FROM (
    SELECT conv_id AS session_id, CAST(turn AS INTEGER) AS turn, role, text AS question,
      lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
      lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations) x
  WHERE role = 'user' AND next_role = 'assistant')
SELECT a.session_id""", 1))
def q_qa_prompts(spark, sf_dir):
    """Question, context, the last three exchanges and output shape, per provider request."""
    fx = Fixtures(spark, sf_dir)
    latest = Q.latest(P.with_context(N.with_summary(QC.knowledge(fx))))
    conversations = fx.table("conversations")
    asked = Q.answer(testdata.fx_questions(conversations, latest)).where(F.col("mode") == "provider_request")
    turns = conversations.where(F.col("role") == "user").select(
        F.col("conv_id").alias("session_id"), F.col("turn").cast("int").alias("turn"))
    history = Q.history(turns, testdata.fx_exchanges(conversations))
    return P.qa_prompts(asked.select("session_id", "turn", "question", "context_json"), history)


@register("answer_shape", sql=_qa_sql(_ANSWER_SHAPE))
def q_answer_shape(spark, sf_dir):
    """Every shape rule a provider answer breaks, with its path."""
    x = DOC.parsed(answer_texts(QQ.QABundle(spark, sf_dir).provider_answers), DOC.ANSWER)
    return x.select(*Q.TURN, "json_ok", "shape_violations")
