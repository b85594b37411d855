"""Registry of named queries: a Spark builder and (where SQL can say it) an oracle.

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables.  The oracle is one DuckDB statement over the raw tables.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarterline.session import reuse
from quarterline.sources import testdata

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

PLAN_MODULES = [
    "quarterline.plans.q_analytics",
    "quarterline.plans.q_observations",
    "quarterline.plans.q_quality",
    "quarterline.plans.q_drivers",
    "quarterline.plans.q_grounding",
    "quarterline.plans.q_claims",
    "quarterline.plans.q_narrative",
    "quarterline.plans.q_qa",
    "quarterline.plans.q_documents",
    "quarterline.plans.q_scans",
    "quarterline.plans.q_part",
]

# Fixture parameters.  The reference scopes its pages to FY2019+ and checks
# quality from FY2013 on data FY2010-FY2026; the test tables span
# FY1995-FY2002, so the same floors are placed at the same relative years.
SCOPE_MIN_FISCAL_YEAR = 1998
QUALITY_MIN_FISCAL_YEAR = 1996


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    for mod in PLAN_MODULES:
        importlib.import_module(mod)


@dataclass
class Fixtures:
    """Lazy fixture DataFrames for one query (built once per builder call)."""

    spark: SparkSession
    sf_dir: str
    grain: str = "nation"
    # keep the fact tables when many consumers share them (see session.reuse)
    shared: bool = False

    def __post_init__(self) -> None:
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = make()
        return self._cache[name]

    def table(self, name: str) -> DataFrame:
        return self._get("t_" + name, lambda: testdata.read_table(self.spark, self.sf_dir, name))

    def _maybe(self, df: DataFrame, name: str) -> DataFrame:
        return reuse(df) if self.shared else df

    @property
    def wide(self) -> DataFrame:
        return self._get("wide", lambda: self._maybe(testdata.fx_wide(self.spark, self.sf_dir, self.grain), "wide"))

    @property
    def long(self) -> DataFrame:
        return self._get("long", lambda: testdata.fx_long(self.spark, self.sf_dir, self.grain, wide=self.wide))

    @property
    def obs(self) -> DataFrame:
        return self._get("obs", lambda: testdata.fx_obs(self.spark, self.sf_dir, self.grain, long=self.long))

    @property
    def raw(self) -> DataFrame:
        return self._get("raw", lambda: testdata.fx_raw(self.long))

    @property
    def packets(self) -> DataFrame:
        return self._get("packets", lambda: testdata.fx_packets(self.segments))

    @property
    def segments(self) -> DataFrame:
        return self._get("segments", lambda: self._maybe(
            testdata.fx_segments(self.spark, self.sf_dir, self.grain), "segments"))
