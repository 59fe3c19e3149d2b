"""The medallion as lazily built layers over one bronze source.

``Medallion`` is the shared plan for batch queries: the same object can sit
on the fixture projection of the test tables (everything lazy, Catalyst sees
the whole lineage and prunes columns down to the parquet scan) or on the
persisted tables a job run wrote (``from_store``), where each layer is
a table boundary and gold never repeats silver's lineage.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_AS_OF, TABLES
from ..operators import distinct, gold, silver as silver_ops
from ..sinks.tables import TableStore
from ..sources.fixtures import fixture_bronze
from ..sources.reference import firmwide_exposure
from . import incremental, jobs


@dataclass(frozen=True)
class Params:
    as_of: _dt.date = DEFAULT_AS_OF                    # "today" for questions
    freshness_as_of: _dt.datetime = _dt.datetime(2001, 8, 2, 0, 0, 0)  # now() of the freshness counter
    trend_lob: str = "Motor"
    trend_days: int = 7
    preview_rows: int = 10


@dataclass
class Medallion:
    spark: SparkSession
    bronze: DataFrame
    params: Params = field(default_factory=Params)
    _silver: DataFrame | None = None
    _firmwide: DataFrame | None = None
    _gold: dict = field(default_factory=dict)
    _claims: tuple[DataFrame, DataFrame] | None = None     # stored bitmaps and other ids
    store: TableStore | None = None                        # where persisted layers are

    # --- constructors ------------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, params: Params | None = None) -> "Medallion":
        return cls(spark, fixture_bronze(spark, sf_dir), params or Params())

    @classmethod
    def from_store(cls, spark: SparkSession, store, params: Params | None = None) -> "Medallion":
        """Layers read back from persisted tables (after a job run)."""
        gold_tables = {}
        for key, name in (("by_lob_region", TABLES.gold_by_lob_region),
                          ("loss_ratio", TABLES.gold_loss_ratio),
                          ("daily", TABLES.gold_claims_daily)):
            if store.exists(name):
                gold_tables[key] = store.read(name)
        name = jobs.silver_table(store)
        silver = store.read(name).drop("_source", "_batch") if name else None
        fw = store.read(TABLES.firmwide) if store.exists(TABLES.firmwide) else None
        # bitmaps belong to the refreshed silver; a later rebuild leaves them behind
        claims = incremental.distinct_tables(store) if name == TABLES.silver_batches else None
        return cls(spark, jobs.read_bronze(store), params or Params(),
                   _silver=silver, _firmwide=fw, _gold=gold_tables, _claims=claims, store=store)

    def _stored(self, key: str, build):
        df = self._gold.get(key)
        return df if df is not None else build()

    def newest(self, n: int) -> DataFrame:
        """Bronze rows among which the ``n`` largest ids are; of a store only the batches
        that can hold one."""
        return jobs.read_newest(self.store, n) if self.store is not None else self.bronze

    @cached_property
    def typed(self) -> DataFrame:
        return silver_ops.silver_typed(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        if self._silver is not None:
            return self._silver.select(*[c for c in self._silver.columns if c != "event_date"])
        return silver_ops.kept_rows(self.typed)

    def silver_of(self, *columns: str, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
        """Some columns of silver and, with ``first`` and ``last``, only events of these
        days; over a derived silver both are cut before the rows are cleansed."""
        days = None
        if first is not None and last is not None:
            # event_ts passes through cleansing as it is: a range of it is the same range of bronze
            days = (F.col("event_ts") >= F.lit(first).cast("timestamp")) & (
                F.col("event_ts") < F.lit(last + _dt.timedelta(days=1)).cast("timestamp"))
        if self._silver is not None:
            rows = self.silver if days is None else self.silver.where(days)
            return rows.select(*columns)
        bronze = self.bronze if days is None else self.bronze.where(days)
        return silver_ops.kept_rows(silver_ops.silver_typed(bronze), columns)

    @cached_property
    def firmwide(self) -> DataFrame:
        return self._firmwide if self._firmwide is not None else firmwide_exposure(self.spark, self.params.as_of)

    @cached_property
    def by_lob_region(self) -> DataFrame:
        # split aggregates only when silver is a persisted table (cheap to scan twice)
        return self._stored("by_lob_region",
                            lambda: gold.claims_by_lob_region(
                                self.silver_of("lob", "region", "currency", "claim_id", "claim_amount", "is_large_loss", "event_ts"),
                                split=self._silver is not None))

    @cached_property
    def claims_agg(self) -> DataFrame:
        # additive: derived from the (small) by-lob-region gold when persisted
        return gold.claims_by_lob_region_agg(
            self._stored("by_lob_region", lambda: self.silver_of("lob", "region", "claim_amount")))

    @cached_property
    def loss_ratio(self) -> DataFrame:
        return self._stored("loss_ratio", lambda: gold.loss_ratio(self.claims_agg, self.firmwide))

    @cached_property
    def loss_ratio_compat(self) -> DataFrame:
        return gold.loss_ratio(self.claims_agg, self.firmwide, compat=True)

    @cached_property
    def daily(self) -> DataFrame:
        return self.daily_between(None, None)

    def daily_between(self, first: _dt.date | None, last: _dt.date | None) -> DataFrame:
        """Daily gold that holds these days at least."""
        return self._stored("daily", lambda: gold.claims_daily(
            self.silver_of("event_ts", "lob", "claim_amount", "report_lag_days", first=first, last=last)))

    @cached_property
    def distinct_claims(self) -> DataFrame:
        """True distinct claims from bitmaps: the stored ones' bit counts, or one pass over silver."""
        if self._claims:
            return distinct.distinct_everywhere(*self._claims)
        return distinct.distinct_in_one_pass(self.silver_of("claim_id"))
