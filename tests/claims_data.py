"""Test tables and source rows shared by the tests (not in conftest.py: a second
one lies in a subfolder, and only one module can have that name)."""

import datetime as dt
from decimal import Decimal

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def claim_row(txn_id, claim_id="CLM-1", policy_id="POL-1", lob="Motor", region="Germany", peril="Fire",
              status="Open", txn="Payment", amount="100.00", currency="EUR",
              incident=dt.date(2001, 7, 1), reported=dt.date(2001, 7, 3),
              event_ts=dt.datetime(2001, 7, 3, 12, 0, 0)):
    amt = None if amount is None else Decimal(amount)
    return (txn_id, claim_id, policy_id, lob, region, peril, status, txn, amt, currency,
            incident, reported, event_ts, event_ts)


def source_df(spark, rows):
    from lossline.schemas import CLAIM_TRANSACTION

    return spark.createDataFrame(rows, CLAIM_TRANSACTION)
