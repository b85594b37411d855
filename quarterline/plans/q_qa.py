"""Question-answering queries over the conversation turns of the test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from quarterline.operators import drivers as D
from quarterline.operators import narrative as N
from quarterline.operators import qa as Q
from quarterline.plans import q_claims as QC
from quarterline.plans import q_drivers as QD
from quarterline.plans import q_grounding as QG
from quarterline.plans import q_narrative as QN
from quarterline.plans.catalog import Fixtures, register
from quarterline.plans.fixture_sql import with_all
from quarterline.sources import testdata

K = "entity_id, fiscal_year, fiscal_period"


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BANK = "[" + ", ".join("repeat('x', 501)" if q == "x" * 501 else _s(q) for q in testdata.QUESTION_BANK) + "]"
_N = len(testdata.QUESTION_BANK)
_QS = f"""SELECT q.session_id, q.turn, q.question, q.entity_id, lp.fiscal_year, lp.fiscal_period FROM
  (SELECT conv_id AS session_id, CAST(turn AS INTEGER) AS turn, text AS question,
          CAST(conv_id % {testdata.SESSION_ENTITIES} AS BIGINT) AS entity_id
   FROM conversations WHERE role = 'user'
   UNION ALL
   SELECT -conv_id - 1, CAST(turn AS INTEGER), {_BANK}[((conv_id * 7 + turn) % {_N}) + 1],
          CAST(conv_id % {testdata.SESSION_ENTITIES} AS BIGINT)
   FROM conversations WHERE role = 'user') q
LEFT JOIN (SELECT {K} FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY fiscal_year DESC,
        fiscal_period DESC) AS rn FROM el) x WHERE rn = 1) lp USING (entity_id)"""
_NORM = "trim(regexp_replace(lower(question), '[^a-z0-9]+', ' ', 'g'))"


def _any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(nq, {_s(w)})" for w in words) + ")"


_ALIAS_CASE = "CASE " + " ".join(
    f"WHEN contains(nq, {_s(a)}) THEN {_s(Q.ALIASES[a])}" for a in sorted(Q.ALIASES, key=lambda a: -len(a))) + " END"
_DEF_CASE = "CASE lbl " + " ".join(f"WHEN {_s(k)} THEN {_s(v)}" for k, v in Q.DEFINITIONS.items()) + " END"
_DIFF = "(contains(nq, 'difference') AND contains(nq, 'qoq') AND contains(nq, 'yoy'))"
_GLOSS = (f"CASE WHEN {_DIFF} THEN {_s('QoQ: ' + Q.DEFINITIONS['QoQ growth'] + ' YoY: ' + Q.DEFINITIONS['YoY growth'])} "
          f"WHEN lbl IS NOT NULL THEN lbl || ': ' || {_DEF_CASE} END")
_ROUTE = (f"CASE WHEN gloss IS NOT NULL THEN 'glossary' "
          f"WHEN {_any(['perform well', 'strong quarter'])} THEN 'performance' "
          f"WHEN {_any(['explain this quarter', 'plain english', 'do not know finance'])} THEN 'explain' "
          f"WHEN {_any(['drove', 'drivers', 'growth'])} AND NOT contains(nq, 'mean') THEN 'drivers' "
          f"WHEN contains(nq, 'headwind') THEN 'headwind' "
          f"WHEN contains(nq, 'margin') AND {_any(['strong', 'profit', 'healthy'])} THEN 'margin' "
          f"WHEN contains(nq, 'investigate') OR contains(nq, 'attention') THEN 'investigate' ELSE 'none' END")
_SUMMARY = f"""SELECT {K}, first(headline) AS headline, arg_min(text, pos) AS first_point,
  string_agg(text, ' ' ORDER BY pos) AS all_points,
  max(CASE WHEN starts_with(text, 'Profitability') THEN text END) AS profitability_point
FROM pe GROUP BY ALL"""
_RK = f"""SELECT {K}, max(CASE WHEN direction = 'positive' AND rank = 1 THEN segment END) AS pos1,
  max(CASE WHEN direction = 'positive' AND rank = 2 THEN segment END) AS pos2,
  max(CASE WHEN direction = 'negative' AND rank = 1 THEN segment END) AS neg1 FROM rnk GROUP BY ALL"""
_QX = f"""SELECT q.*, nq, qlen, coalesce(qlen BETWEEN 1 AND {Q.MAX_QUESTION_LENGTH}, false) AS length_ok, q.fiscal_year IS NOT NULL AS grounded, gloss, {_ROUTE} AS r,
  s.headline, s.first_point, s.all_points, s.profitability_point, d.entity_id IS NOT NULL AS has, d.pos1, d.pos2, d.neg1
FROM (SELECT *, {_GLOSS} AS gloss FROM
       (SELECT *, CASE WHEN {_any(Q.GLOSSARY_TRIGGERS)} THEN {_ALIAS_CASE} END AS lbl FROM
         (SELECT *, {_NORM} AS nq, length(regexp_replace(question, '^\\s+|\\s+$', '', 'g')) AS qlen FROM qs) a) b) q
LEFT JOIN summ s USING ({K})
LEFT JOIN (SELECT v.*, rk.pos1, rk.pos2, rk.neg1 FROM (SELECT {K} FROM recon WHERE valid) v
           LEFT JOIN rkq rk USING ({K})) d USING ({K})"""
_DET = (f"CASE r WHEN 'glossary' THEN gloss "
        f"WHEN 'performance' THEN concat_ws(' ', headline, first_point) "
        f"WHEN 'explain' THEN concat_ws(' ', headline, all_points) "
        f"WHEN 'drivers' THEN CASE WHEN NOT has OR pos1 IS NULL THEN {_s(Q.NO_DRIVERS)} ELSE "
        f"'The largest approved positive segment contributors were ' || concat_ws(' and ', pos1, pos2) || '.' END "
        f"WHEN 'headwind' THEN CASE WHEN NOT has OR neg1 IS NULL THEN {_s(Q.NO_HEADWIND)} ELSE "
        f"'The main approved segment headwind was ' || neg1 || '.' END "
        f"WHEN 'margin' THEN coalesce(profitability_point, {_s(Q.MARGIN_DEFAULT)}) "
        f"WHEN 'investigate' THEN 'Useful next areas to investigate are ' || concat_ws(', ', "
        f"'revenue growth durability', 'margin direction', CASE WHEN has AND neg1 IS NOT NULL THEN "
        f"'the ' || neg1 || ' headwind' END) || '.' END")
_ANS = f"""SELECT session_id, turn, {K}, nq AS normalized, CAST(qlen AS INTEGER) AS question_length,
  CASE WHEN length_ok AND grounded THEN r END AS route, eligible AS provider_eligible, CAST(used AS INTEGER) AS provider_used_before,
  CASE WHEN NOT length_ok OR NOT grounded THEN 'insufficient_context' WHEN r <> 'none' THEN 'deterministic'
       WHEN eligible AND used >= {Q.MAX_PROVIDER_QUESTIONS} THEN 'insufficient_context' ELSE 'provider_request' END AS mode,
  CASE WHEN NOT length_ok THEN {_s(Q.LENGTH_MESSAGE)} WHEN NOT grounded THEN {_s(Q.NO_CONTEXT_MESSAGE)} WHEN r <> 'none' THEN {_DET}
       WHEN eligible AND used >= {Q.MAX_PROVIDER_QUESTIONS} THEN {_s(Q.QUOTA_MESSAGE)} END AS answer
FROM (SELECT *, coalesce(sum(CAST(eligible AS INTEGER)) OVER (PARTITION BY session_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
      FROM (SELECT *, length_ok AND grounded AND r = 'none' AS eligible FROM qx) e) u"""

_CUR = f"""SELECT {K}, first(source_id) AS src, max(CASE WHEN metric = 'revenue' THEN value END) AS revenue,
  max(CASE WHEN metric = 'net_margin_pct' THEN value END) AS net_margin_pct FROM gf WHERE role = 'current' GROUP BY ALL"""
_REQ = f"""SELECT a.session_id, a.turn, a.entity_id, a.fiscal_year, a.fiscal_period, c.src, c.revenue, c.net_margin_pct,
  (a.session_id + a.turn) % 6 AS p,
  'e' || CAST(a.entity_id AS VARCHAR) || '-fy' || CAST(a.fiscal_year AS VARCHAR) || '-' || a.fiscal_period
    || '-earnings_call' AS call
FROM ans a JOIN cur c USING ({K}) WHERE a.mode = 'provider_request'"""
_ACL = f"""SELECT session_id, turn, {K}, 0 AS claim_pos, 'revenue' AS metric,
  CASE WHEN p = 2 THEN 'derived_metric' WHEN p = 4 THEN 'ai_interpretation' ELSE 'reported_fact' END AS classification,
  CAST(CASE WHEN p = 1 THEN CAST(revenue AS DECIMAL(38,6)) + 1 ELSE CAST(revenue AS DECIMAL(38,6)) END
       AS DECIMAL(38,6)) AS value,
  CASE WHEN p = 5 THEN 'percent' ELSE 'usd' END AS unit,
  CASE WHEN p = 3 THEN ['unknown:source'] ELSE [src] END AS source_ids,
  CAST(NULL AS VARCHAR) AS management_explanation_id FROM req
UNION ALL SELECT session_id, turn, {K}, 1, 'net_margin_pct', 'derived_metric',
  CAST(CAST(net_margin_pct AS DECIMAL(38,6)) + 0.01 AS DECIMAL(38,6)), 'percent', [src], NULL FROM req
UNION ALL SELECT session_id, turn, {K}, 2, 'demand', 'management_explanation', NULL, NULL, [call], 'demand' FROM req"""
_ATX = f"""SELECT session_id, turn, {K},
  CASE WHEN p % 2 = 0 THEN 'Revenue was reported, and management cited demand.'
       ELSE 'Revenue grew; we recommend you buy.' END AS answer,
  CASE WHEN p = 3 THEN ['unknown:source', src, call] ELSE [src, call] END AS source_ids,
  fiscal_year - ((abs(session_id) + turn) % 13 = 0)::INT AS claimed_fiscal_year,
  CASE WHEN (abs(session_id) + turn) % 7 = 0 THEN {_s(testdata.ADVICE_EXPLANATION)}
       WHEN (abs(session_id) + turn) % 7 <> 1 THEN {_s(testdata.PLAIN_EXPLANATION)} END AS explanation,
  CASE WHEN (abs(session_id) + turn) % 11 = 0 THEN [{_s(testdata.PLAIN_AREA)}, {_s(testdata.ADVICE_AREA)}]
       ELSE [{_s(testdata.PLAIN_AREA)}] END AS areas
FROM req"""
_ROLE_RANK = "CASE role WHEN 'current' THEN 0 WHEN 'previous' THEN 1 WHEN 'prior_year' THEN 2 ELSE 3 END"
_CST = f"""SELECT c.session_id, c.turn, c.claim_pos, c.entity_id, c.fiscal_year, c.fiscal_period, c.metric,
  c.classification,
  CASE WHEN bs.session_id IS NOT NULL THEN 'unsupported_source'
       WHEN c.classification = 'management_explanation' THEN
         CASE WHEN e.explanation_id IS NOT NULL AND c.metric = e.explanation_id
                   AND list_sort(list_distinct(c.source_ids)) = list_sort(list_distinct(e.source_ids))
                   AND contains(lower(t.answer), 'management') THEN 'match' ELSE 'unsupported_management' END
       WHEN f.f_unit IS NOT NULL THEN
         CASE WHEN coalesce(c.classification IN (CASE WHEN c.metric IN ('revenue', 'gross_profit', 'operating_income',
                'net_income') THEN 'reported_fact' ELSE 'derived_metric' END, 'ai_interpretation')
                AND c.unit = f.f_unit AND {QC._match('c.value', 'f.f_value', 'c.unit')}, false)
              THEN 'match' ELSE 'mismatch' END
       WHEN a.unit IS NOT NULL THEN
         CASE WHEN coalesce(c.classification IN (CASE WHEN a.classification = 'reported' THEN 'reported_fact'
                ELSE 'derived_metric' END, 'ai_interpretation') AND c.unit = a.unit
                AND list_sort(list_distinct(c.source_ids)) = a.source_ids
                AND {QC._match('c.value', 'a.value', 'c.unit')}, false) THEN 'match' ELSE 'mismatch' END
       ELSE 'unsupported' END AS status
FROM acl c
LEFT JOIN (SELECT DISTINCT session_id, turn, claim_pos FROM (SELECT *, unnest(source_ids) AS source_id FROM acl) s
           WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE {QC._on('a', 's', ('source_id',))})) bs
  USING (session_id, turn, claim_pos)
LEFT JOIN (SELECT session_id, turn, claim_pos, arg_min(g.unit, {_ROLE_RANK}) AS f_unit,
                  arg_min(g.value, {_ROLE_RANK}) AS f_value
           FROM (SELECT *, unnest(source_ids) AS source_id FROM acl) s
           JOIN gf g ON {QC._on('g', 's', ('source_id', 'metric'))} GROUP BY ALL) f
  USING (session_id, turn, claim_pos)
LEFT JOIN approved a ON {QC._on('a', 'c', ('metric',))}
LEFT JOIN (SELECT * FROM pk_explanations WHERE ({K}) IN (SELECT ({K}) FROM recon WHERE valid)) e
  ON {QC._on('e', 'c')} AND e.explanation_id = c.management_explanation_id
LEFT JOIN atx t USING (session_id, turn)"""

QA_CTES = QC.CLAIM_CTES + QN.NARRATIVE_CTES + [
    ("qs", _QS), ("summ", _SUMMARY), ("rkq", _RK), ("qx", _QX), ("ans", _ANS),
    ("cur", _CUR), ("req", _REQ), ("acl", _ACL), ("atx", _ATX), ("cst", _CST),
]


def _sql(select: str) -> str:
    return with_all("fx_long", *QD._PK, extra=QG.GROUNDING_CTES + QA_CTES) + "\n" + select


class QABundle:
    """Questions on the knowledge row of their period, answered and checked; built lazily."""

    def __init__(self, spark, sf_dir):
        self.fx = Fixtures(spark, sf_dir)

    @cached_property
    def answers(self):
        latest = Q.latest(N.with_summary(QC.knowledge(self.fx)))
        return Q.answer(testdata.fx_questions(self.fx.table("conversations"), latest))

    @cached_property
    def provider_answers(self):
        return testdata.fx_answers(self.answers.where(F.col("mode") == "provider_request"))


@register("question_route", sql=_sql("SELECT * FROM ans"))
def q_question_route(spark, sf_dir):
    """Normalise, gate, route and answer every user turn."""
    return QABundle(spark, sf_dir).answers.select(*Q.ANSWER_COLUMNS)


@register("glossary_match", sql=_sql(
    f"SELECT session_id, turn, CASE WHEN {_DIFF} THEN 'QoQ/YoY' ELSE lbl END AS glossary_entry "
    "FROM (SELECT *, CASE WHEN " + _any(Q.GLOSSARY_TRIGGERS) + f" THEN {_ALIAS_CASE} END AS lbl FROM "
    f"(SELECT *, {_NORM} AS nq FROM qs) a) b WHERE {_DIFF} OR lbl IS NOT NULL"))
def q_glossary_match(spark, sf_dir):
    """H5: the glossary entry matched by each question (longest alias first)."""
    fx = Fixtures(spark, sf_dir)
    questions = testdata.fx_questions(fx.table("conversations"), Q.latest(QG.contexts(fx).select(*D.PACKET)))
    norm = Q.normalize(F.col("question"))
    diff = norm.contains("difference") & norm.contains("qoq") & norm.contains("yoy")
    entry = F.when(diff, F.lit("QoQ/YoY")).otherwise(Q.glossary_label(norm))
    return questions.select("session_id", "turn", entry.alias("glossary_entry")).where(
        F.col("glossary_entry").isNotNull())


@register("qa_quota", sql=_sql(
    f"SELECT session_id, turn, provider_eligible, provider_used_before, "
    f"provider_eligible AND provider_used_before >= {Q.MAX_PROVIDER_QUESTIONS} AS over_quota FROM ans"))
def q_qa_quota(spark, sf_dir):
    """Running per-session count of provider requests; the sixth is refused."""
    a = QABundle(spark, sf_dir).answers
    return a.select("session_id", "turn", "provider_eligible", "provider_used_before",
                    (F.col("provider_eligible") & (F.col("provider_used_before") >= Q.MAX_PROVIDER_QUESTIONS))
                    .alias("over_quota"))


@register("qa_history", sql="""
WITH ex AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS n FROM (
    SELECT conv_id AS session_id, CAST(turn AS INTEGER) AS turn, role, text AS question,
      lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
      lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations) x
  WHERE role = 'user' AND next_role = 'assistant') y WHERE n <= 20)
SELECT q.session_id, q.turn, count(h.turn) AS history_turns, min(h.turn) AS first_history_turn,
  max(h.turn) AS last_history_turn,
  coalesce(string_agg(h.question || ' -> ' || h.answer, chr(10) ORDER BY h.turn), '') AS history_text
FROM (SELECT conv_id AS session_id, CAST(turn AS INTEGER) AS turn FROM conversations WHERE role = 'user') q
LEFT JOIN LATERAL (SELECT turn, question, answer FROM ex WHERE ex.session_id = q.session_id AND ex.turn < q.turn
                   ORDER BY turn DESC LIMIT 3) h ON true
GROUP BY q.session_id, q.turn""")
def q_qa_history(spark, sf_dir):
    """The last three answered exchanges before each user turn, with their texts."""
    conversations = Fixtures(spark, sf_dir).table("conversations")
    turns = conversations.where(F.col("role") == "user").select(
        F.col("conv_id").alias("session_id"), F.col("turn").cast("int").alias("turn"))
    h = Q.history(turns, testdata.fx_exchanges(conversations))
    ids = F.transform("history", lambda s: s["turn"])
    return h.select("session_id", "turn", F.size("history").cast("bigint").alias("history_turns"),
                    F.array_min(ids).alias("first_history_turn"), F.array_max(ids).alias("last_history_turn"),
                    F.array_join(F.transform("history", lambda s: F.concat(s["question"], F.lit(" -> "), s["answer"])), "\n")
                    .alias("history_text"))


_ADV = "(?i)(^|[^\\p{L}\\p{N}_])" + Q.ADVICE_PATTERN + "([^\\p{L}\\p{N}_]|$)"
_PHRASE = "CASE doc_id % 10 " + " ".join(f"WHEN {k} THEN {_s(v)}" for k, v in testdata.ADVICE_PHRASES.items()) + \
    " ELSE '' END"


@register("advice_filter", sql=f"""
SELECT doc_id, regexp_matches(text || {_PHRASE}, {_s(_ADV)}) AS prohibited FROM documents""")
def q_advice_filter(spark, sf_dir):
    """H7: whole-word, case-insensitive prohibited-advice detection over every document."""
    docs = testdata.fx_advice_text(Fixtures(spark, sf_dir).table("documents"))
    return docs.select("doc_id", Q.advice_flag(F.col("text")).alias("prohibited"))


@register("answer_claim_status", sql=_sql("SELECT * FROM cst"))
def q_answer_claim_status(spark, sf_dir):
    """Provider answer claims against grounded figures, approved claims, explanations."""
    return Q.answer_claim_status(QABundle(spark, sf_dir).provider_answers)


_ADVICE_IN = f"regexp_matches(concat_ws(' ', t.answer, t.explanation, array_to_string(t.areas, ' ')), {_s(_ADV)})"
_AERR = f"""SELECT t.session_id, t.turn, t.entity_id, t.fiscal_year, t.fiscal_period,
  (t.claimed_fiscal_year <> t.fiscal_year)::INT AS slipped, coalesce(bad, 0) AS bad, ({_ADVICE_IN})::INT AS advice,
  coalesce(errs, 0) AS errs, coalesce(texts, []) AS texts
FROM atx t
LEFT JOIN (SELECT DISTINCT session_id, turn, 1 AS bad FROM (SELECT *, unnest(source_ids) AS source_id FROM atx) s
           WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE {QC._on('a', 's', ('source_id',))})) b
  USING (session_id, turn)
LEFT JOIN (SELECT session_id, turn, count(*) AS errs, list(CASE status
             WHEN 'unsupported_source' THEN 'Unsupported claim source for ' || metric || '.'
             WHEN 'unsupported_management' THEN 'Unsupported or unattributed management explanation.'
             ELSE 'Unsupported or mismatched claim: ' || metric || '.' END ORDER BY claim_pos) AS texts
           FROM cst WHERE status <> 'match' GROUP BY ALL) e USING (session_id, turn)"""


@register("answer_violations", sql=_sql(f"""
SELECT session_id, turn, entity_id, fiscal_year, fiscal_period, slipped::BIGINT AS period_mismatch,
  bad::BIGINT AS unsupported_sources, advice::BIGINT AS advice_language, errs::BIGINT AS claim_errors,
  (slipped + bad + advice + errs)::BIGINT AS total_errors, slipped + bad + advice + errs = 0 AS approved FROM ({_AERR}) v"""))
def q_answer_violations(spark, sf_dir):
    """Per provider answer -- period, unsupported sources, advice language in any text, claim errors."""
    return Q.answer_violations(Q.validated_answers(QABundle(spark, sf_dir).provider_answers))


@register("answer_errors", sql=_sql(f"""
SELECT session_id, turn, list_concat(list_filter([
    CASE WHEN slipped = 1 THEN {_s(Q.ANSWER_ERRORS['period'])} END, CASE WHEN bad = 1 THEN {_s(Q.ANSWER_ERRORS['sources'])} END,
    CASE WHEN advice = 1 THEN {_s(Q.ANSWER_ERRORS['advice'])} END], lambda x: x IS NOT NULL), texts) AS errors FROM ({_AERR}) v"""))
def q_answer_errors(spark, sf_dir):
    """All error texts of every provider answer, in the order of the checks."""
    v = Q.validated_answers(QABundle(spark, sf_dir).provider_answers)
    return v.select(*Q.TURN, F.transform("errors", lambda e: e["text"]).alias("errors"))


_MODES = f"""SELECT a.session_id, a.turn,
  CASE WHEN a.mode <> 'provider_request' THEN a.mode WHEN coalesce(ok, false) THEN 'grounded_ai' ELSE 'insufficient_context' END AS mode,
  CASE WHEN a.mode <> 'provider_request' THEN a.answer WHEN coalesce(ok, false) THEN t.answer
       ELSE {_s(Q.SAFE_FAILURE_MESSAGE)} END AS message,
  a.mode = 'provider_request' AS provider_request_made,
  CASE WHEN a.mode = 'provider_request' THEN CASE WHEN coalesce(ok, false) THEN t.source_ids ELSE CAST([] AS VARCHAR[]) END
       WHEN a.mode = 'deterministic' AND a.route <> 'glossary' THEN s.source_ids ELSE CAST([] AS VARCHAR[]) END AS source_ids
FROM ans a
LEFT JOIN (SELECT session_id, turn, slipped + bad + advice + errs = 0 AS ok FROM ({_AERR}) v) v USING (session_id, turn)
LEFT JOIN atx t USING (session_id, turn)
LEFT JOIN ({QN._SOURCES}) s ON s.entity_id = a.entity_id AND s.fiscal_year = a.fiscal_year AND s.fiscal_period = a.fiscal_period"""


@register("answer_mode", sql=_sql(f"SELECT session_id, turn, mode, message, provider_request_made FROM ({_MODES}) m"))
def q_answer_mode(spark, sf_dir):
    """H8: deterministic / grounded_ai / insufficient_context per question, after the answers are checked."""
    return _final_modes(spark, sf_dir).drop("source_ids")


def _final_modes(spark, sf_dir):
    # the generated answers stand on the questions' own rows; only requests look at them
    return Q.final_modes(Q.validated_answers(testdata.fx_answers(QABundle(spark, sf_dir).answers)))


@register("answer_sources", sql=_sql(f"SELECT session_id, turn, mode, source_ids FROM ({_MODES}) m WHERE len(source_ids) > 0"))
def q_answer_sources(spark, sf_dir):
    """The sources of every answer that names some: the summary's, or those of an approved provider answer."""
    return _final_modes(spark, sf_dir).where(F.size("source_ids") > 0).select(*Q.TURN, "mode", "source_ids")


@register("source_labels", sql=_sql(f"""
SELECT session_id, turn, string_agg(CASE WHEN s.title IS NOT NULL THEN s.title || ' (' || x.source_id || ')'
    ELSE x.source_id END, ', ' ORDER BY x.pos) AS source_labels, count(*) AS sources
FROM (SELECT session_id, turn, {K}, unnest(source_ids) AS source_id,
             unnest(range(len(source_ids))) AS pos FROM atx) x
LEFT JOIN pk_sources s ON {QC._on('s', 'x', ('source_id',))}
GROUP BY session_id, turn"""))
def q_source_labels(spark, sf_dir):
    """Cited sources rendered as ``title (id)`` in citation order."""
    return Q.source_labels(QABundle(spark, sf_dir).provider_answers)
