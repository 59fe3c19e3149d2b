"""Every registered batch key gives the same rows over the persisted tables
(ingest + rebuild, or ingest + incremental refresh) as lazily over the raw
test tables."""

import pytest

from oracle_check import _digest

from claims_data import SF001
from lossline.config import DEFAULT_INGESTED_AT, FIXTURE_SOURCE
from lossline.plans import catalog, incremental, jobs
from lossline.plans.medallion import Medallion
from lossline.sinks.tables import TableStore
from lossline.sources.fixtures import fixture_source

import __spark_entry__ as entry


@pytest.mark.parametrize("mode", ["rebuild", "refresh"])
def test_persisted_equals_lazy_for_every_key(spark, mode):
    store = TableStore.scratch(spark, f"persisted-{mode}")
    jobs.ingest(spark, store, fixture_source(spark, SF001), FIXTURE_SOURCE, ingested_at=DEFAULT_INGESTED_AT)
    if mode == "rebuild":
        jobs.rebuild(spark, store)
    else:
        jobs.build_reference(spark, store)
        incremental.refresh(spark, store, state_partitions=4)
    persisted = Medallion.from_store(spark, store)
    lazy = Medallion.from_testdata(spark, SF001)
    for name, fn in catalog.QUERIES.items():
        a = _digest(entry._portable(fn(persisted)).toPandas())
        b = _digest(entry._portable(fn(lazy)).toPandas())
        assert a == b, name
