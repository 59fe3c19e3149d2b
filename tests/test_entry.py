"""Driver contract: entry smoke, every key runs, every oracle matches (sf0.001)."""

import duckdb
from oracle_check import TABLES, _digest

import __spark_entry__ as entry
from claims_data import SF001


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 48
    assert df.columns == ["lob", "region", "incurred_amount", "claim_txn_count", "gross_written_premium",
                          "target_loss_ratio", "observed_loss_ratio", "vs_target"]


def test_every_key_matches_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    sql = entry.oracle_sql()
    rows_only = []
    own = entry.llm_queries.QUERIES if entry.llm_queries is not None else {}
    for name, fn in entry.queries().items():
        if name in own:        # tested with their package
            continue
        got = _digest(fn(spark, SF001).toPandas())
        if name not in sql:
            rows_only.append(name)
            assert got[0] >= 0
            continue
        assert got == _digest(con.sql(sql[name]).df()), name
    assert rows_only == []
