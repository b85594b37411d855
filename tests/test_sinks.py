"""Sinks: CSV round trip, all-or-none export publishing, validated-only briefing persistence,
constraint-gated full-refresh load."""

import pytest
from pyspark.sql import functions as F

from quarterline.operators import analytics as A
from quarterline.operators import observations as O
from quarterline.operators import quality as Q
from quarterline.plans.catalog import Fixtures
from quarterline.sources import exports

from conftest import SMALL


def test_csv_round_trip_all_text(spark, tmp_path):
    facts = O.facts_from_observations(Fixtures(spark, SMALL).obs)
    path = str(tmp_path / "facts_csv")
    exports.write_csv(facts, path)
    back = exports.read_text_csv(spark, path, exports.FACT_CSV_COLUMNS)
    assert back.columns == exports.FACT_CSV_COLUMNS
    assert all(t == "string" for _, t in back.dtypes)
    assert back.count() == facts.count()
    assert back.where(Q.as_int("value").isNull()).count() == 0


def _frames(spark):
    wide = A.quarterly_wide(Fixtures(spark, SMALL).long)
    qa = A.quarterly_analytics(wide)
    return {"latest_quarter": A.latest_quarter(qa), "quarterly_analytics": qa,
            "annual_financials": A.annual_financials(A.annual_totals(wide)), "quarterly_financials": wide}


def test_publish_all_or_none(spark, tmp_path):
    target = str(tmp_path / "exports")
    report = exports.publish_exports(_frames(spark), target, 1998)
    assert report.where(~F.col("ok")).count() == 0
    latest = exports.read_exports(spark, target)["latest_quarter"]
    assert latest.count() == latest.select("entity_id").distinct().count()
    bad = _frames(spark)
    bad["latest_quarter"] = bad["quarterly_analytics"]  # many rows per entity: contract fails
    with pytest.raises(ValueError):
        exports.publish_exports(bad, target, 1998)
    assert exports.read_exports(spark, target)["latest_quarter"].count() == latest.count()  # the old set stays
    for frames in (bad, {n: f.drop("fiscal_year") for n, f in _frames(spark).items()}):
        with pytest.raises(ValueError):
            exports.publish_exports(frames, str(tmp_path / "exports2"), 1998)
    assert exports.read_exports(spark, str(tmp_path / "exports2")) == {}
    assert not list(tmp_path.glob("exports2/v-*"))  # nothing of a refused set stays


def test_a_refused_bucketed_load_leaves_the_table(spark):
    import uuid

    fx, name = Fixtures(spark, SMALL), f"quarterline_load_{uuid.uuid4().hex[:8]}"
    good = fx.long.drop("q")
    Q.save_bucketed(good, name, buckets=2)
    with pytest.raises(ValueError):
        Q.save_bucketed(good.unionByName(good.limit(1)), name, buckets=2)
    assert spark.table(name).count() == good.count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_staged")]
    Q.save_bucketed(good.where("fiscal_period = 'Q1'"), name, buckets=2)
    assert spark.table(name).select("fiscal_period").distinct().count() == 1


def test_load_refuses_constraint_violations(spark, tmp_path):
    fx = Fixtures(spark, SMALL)
    good = fx.long.drop("q")
    Q.load_table(good, str(tmp_path / "base"))
    assert spark.read.parquet(str(tmp_path / "base")).count() == good.count()
    with pytest.raises(ValueError):
        Q.load_table(fx.raw, str(tmp_path / "base2"))
