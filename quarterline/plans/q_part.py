"""The headline queries with one entity per part: many entities, few rows each.

The nation grain has 25 entities at every scale; these queries have as many
as the part table, so their work after the first aggregate grows with it.
The oracle is the nation statement over the other key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterline.operators import analytics as A
from quarterline.operators import drivers as D
from quarterline.operators import grounding as G
from quarterline.operators import observations as O
from quarterline.plans import q_claims, q_grounding, q_observations  # noqa: F401  (their oracles are reused)
from quarterline.plans.catalog import ORACLE, Fixtures, register

_NATION, _PART = "CAST(s.s_nationkey AS BIGINT) AS entity_id", "CAST(l.l_partkey AS BIGINT) AS entity_id"


def _sql(name: str) -> str:
    if _NATION not in ORACLE[name]:
        raise ValueError(f"{name} has no entity key to replace")
    return ORACLE[name].replace(_NATION, _PART)


@register("quarterly_analytics_part", sql=_sql("quarterly_analytics"))
def q_quarterly_analytics_part(spark, sf_dir):
    """E1-E5 per part."""
    return A.quarterly_analytics(A.quarterly_wide(Fixtures(spark, sf_dir, grain="part").long))


@register("derive_q4_part", sql=_sql("derive_q4"))
def q_derive_q4_part(spark, sf_dir):
    """C1 / G1 per part."""
    return O.facts_from_observations(Fixtures(spark, sf_dir, grain="part").obs)


@register("grounded_figures_part", sql=_sql("grounded_figures"))
def q_grounded_figures_part(spark, sf_dir):
    """I9 / B18 per part."""
    g = G.grounded_figures(q_grounding.contexts(Fixtures(spark, sf_dir, grain="part")))
    return g.withColumn("value", F.col("value").cast("string"))


@register("segment_contribution_part", sql=_sql("segment_contribution"))
def q_segment_contribution_part(spark, sf_dir):
    """E6 per part."""
    return D.contributions(Fixtures(spark, sf_dir, grain="part").packets)


@register("claim_status_part", sql=_sql("claim_status"))
def q_claim_status_part(spark, sf_dir):
    """C7 / D16 / I4 per part."""
    return q_claims._as_text(q_claims.Bundle(spark, sf_dir, grain="part").fig_status(), "value", "grounded_value")
