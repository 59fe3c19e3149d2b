"""Sorted datasets come back in their documented order (the value hash ignores it)."""

import pytest

from claims_data import SF001
from lossline.plans import catalog

ORDERED = {
    "bronze_latest": [("claim_txn_id", True)],
    "dash_incurred_by_lob": [("incurred_amount", True)],
    "dash_loss_ratio_by_lob": [("observed_loss_ratio", True)],
    "dash_loss_ratio_heat": [("observed_loss_ratio", True)],
    "dash_loss_ratio_pivot": [("lob", False)],
    "dash_daily_trend": [("event_date", False), ("lob", False)],
    "qa_incurred_by_lob_day": [("incurred_amount", True)],
    "qa_lob_trend_7d": [("event_date", False)],
    "qa_large_losses_by_lob": [("large_losses", True), ("lob", False)],
    "qa_lobs_over_target": [("observed_loss_ratio", True)],
    "qa_avg_lag_by_region": [("region", False)],
}


@pytest.mark.parametrize("name", ORDERED)
def test_rows_are_ordered(spark, name):
    """Ascending keys put NULL first and descending ones last, as Spark does."""
    rows = catalog.run(name, spark, SF001).collect()
    for a, b in zip(rows, rows[1:]):
        for column, descending in ORDERED[name]:
            x, y = (b[column], a[column]) if descending else (a[column], b[column])
            if x == y:
                continue
            assert x is None or (y is not None and x < y), (name, a, b)
            break
