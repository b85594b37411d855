"""What is approved about a period, as one row: grounded figures and the packet in force.

Figures, packet records, approved claims and explanations of a period are
short lists, so they stand in arrays on the period's row.  Documents and
answers about the period are then checked by expressions over that row: one
join brings the row to them and no rule joins again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.functions.arrays import no_texts
from quarterline.operators import drivers as D
from quarterline.operators import grounding as G

PERIOD = G.PERIOD


def packets_in_force(packets: DataFrame) -> DataFrame:
    """Checked packets with contributions, rankings and the approved claims by metric."""
    x = D.checked(packets).withColumn("contributions", D.contribution_array())
    x = x.withColumn("_entries", D.approved_array())
    return x.withColumns({
        "approved": D.last_by_metric(F.col("_entries")),
        "positive": D.ranked_array(F.col("contributions"), True),
        "negative": D.ranked_array(F.col("contributions"), False)}).drop("_entries")


def knowledge(contexts: DataFrame, packets: DataFrame) -> DataFrame:
    """Grounding contexts with ``figures`` and ``packet`` (NULL where there is none; see ``available``)."""
    keep = ["valid", "first_violation", "reported_increase", "sources", "facts", "segments", "explanations", "contributions",
            "approved", "positive", "negative"]
    p = packets_in_force(packets).select(*PERIOD, F.struct(*keep).alias("packet"))
    return contexts.withColumn("figures", G.figure_array()).join(p, PERIOD, "left")


def available() -> Column:
    """An approved packet exists and passes its checks."""
    return F.coalesce(F.col("packet.valid"), F.lit(False))


def packet_list(name: str) -> Column:
    """A record list of the available packet; NULL where there is no packet at all."""
    return F.filter(F.col(f"packet.{name}"), lambda x: F.col("packet.valid"))


def figure_sources() -> Column:
    return F.array_distinct(F.transform("figures", lambda f: f["source_id"]))


def allowed_sources() -> Column:
    """The sources of the figures and, when it is available, of the packet."""
    own = F.coalesce(F.transform(packet_list("sources"), lambda s: s["source_id"]), no_texts())
    return F.array_distinct(F.concat(figure_sources(), own))


def source_of(role: str) -> Column:
    """The source of one grounding role, or NULL."""
    return F.get(F.filter("figures", lambda f: f["role"] == role), F.lit(0))["source_id"]
