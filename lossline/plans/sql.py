"""SQL access: persisted tables as catalog views, and the dashboard over them.

``register_views`` creates the schema if needed (``CREATE SCHEMA IF NOT
EXISTS``) and one view per table over its current version, with the table's
comment, so notebook users can keep writing SQL. ``register_dashboard`` adds
the dashboard datasets as temporary views over them; ``question_sql`` holds the
six business questions as SQL and equals the DataFrame questions (tested).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..config import TABLES
from ..operators import marts
from ..schemas import FIRMWIDE_COMMENT
from ..sinks.tables import TableStore
from . import jobs

VIEWS = {
    "claims_raw": (TABLES.bronze, "Bronze: claim transactions as ingested, with audit columns"),
    "claims": (None, "Silver: cleansed, typed, quality-checked claim transactions"),  # jobs.silver_table
    "gold_claims_by_lob_region": (TABLES.gold_by_lob_region, "Counts and incurred amounts by lob, region, currency"),
    "gold_loss_ratio": (TABLES.gold_loss_ratio, "Incurred claims against firmwide written premium"),
    "gold_claims_daily": (TABLES.gold_claims_daily, "Daily volume, incurred and reporting lag by lob"),
    "firmwide_exposure": (TABLES.firmwide, FIRMWIDE_COMMENT),
}


def _quote(text: str) -> str:
    """A Spark SQL string literal body: backslash and quote escaped."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def register_views(spark: SparkSession, store: TableStore, schema: str = "claims_lakehouse") -> list[str]:
    """(Re)point one view per existing table at its current version.

    A view reads that version until it is called again (the ``refresh`` and
    ``rebuild`` commands do so); a replaced version stays for the store's
    ``retain_s``. ``claims`` is the silver of the mode that wrote last.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    made = []
    for view, (table, comment) in VIEWS.items():
        table = table or jobs.silver_table(store)
        path = store.current_path(table) if table else None
        if path is None:
            continue
        columns = "* EXCEPT (_source, _batch)" if table == TABLES.silver_batches else "*"
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view} COMMENT '{_quote(comment)}' "
                  f"AS SELECT {columns} FROM parquet.`{path}`")
        made.append(f"{schema}.{view}")
    return made


def dashboard(spark: SparkSession, schema: str = "claims_lakehouse",
              as_of: _dt.datetime | None = None) -> dict[str, DataFrame]:
    """The six dashboard datasets over the views (``as_of`` for freshness: now)."""
    by_lob_region = spark.table(f"{schema}.gold_claims_by_lob_region")
    loss_ratio = spark.table(f"{schema}.gold_loss_ratio")
    return {
        "dash_kpis": marts.kpis(by_lob_region),
        "dash_incurred_by_lob": marts.incurred_by_lob(by_lob_region),
        "dash_loss_ratio_by_lob": marts.loss_ratio_by_lob(loss_ratio),
        "dash_loss_ratio_heat": marts.loss_ratio_heat(loss_ratio),
        "dash_daily_trend": marts.daily_trend(spark.table(f"{schema}.gold_claims_daily")),
        "dash_freshness": marts.freshness(spark.table(f"{schema}.claims"), as_of or _dt.datetime.now()),
    }


def register_dashboard(spark: SparkSession, schema: str = "claims_lakehouse",
                       as_of: _dt.datetime | None = None) -> list[str]:
    """The datasets as temporary views, for SQL users; their definition is ``marts``."""
    made = dashboard(spark, schema, as_of)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)


def question_sql(schema: str = "claims_lakehouse") -> dict[str, str]:
    """The six business questions as parameterised SQL over the views
    (``:as_of`` date, ``:start`` date, ``:lob`` string)."""
    lr = f"{schema}.gold_loss_ratio"
    daily = f"{schema}.gold_claims_daily"
    return {
        "qa_incurred_by_lob_day": f"""SELECT lob, sum(incurred_amount) AS incurred_amount,
            sum(claim_txn_count) AS claim_txn_count FROM {daily}
            WHERE event_date = :as_of AND event_month = trunc(:as_of, 'MM') GROUP BY lob ORDER BY incurred_amount DESC""",
        "qa_worst_region": f"""SELECT region, sum(incurred_amount) AS incurred_amount,
            sum(gross_written_premium) AS gross_written_premium,
            round(try_divide(sum(incurred_amount), sum(gross_written_premium)), 4) AS observed_loss_ratio,
            round(try_divide(sum(target_loss_ratio * gross_written_premium), sum(gross_written_premium)), 4)
              AS target_loss_ratio,
            round(try_divide(sum(incurred_amount), sum(gross_written_premium)), 4)
              - round(try_divide(sum(target_loss_ratio * gross_written_premium), sum(gross_written_premium)), 4)
              AS gap
            FROM {lr} GROUP BY region ORDER BY gap DESC NULLS LAST, region LIMIT 1""",
        "qa_lob_trend_7d": f"""SELECT event_date, lob, claim_txn_count, incurred_amount FROM {daily}
            WHERE lob = :lob AND event_date BETWEEN :start AND :as_of
              AND event_month BETWEEN trunc(:start, 'MM') AND trunc(:as_of, 'MM') ORDER BY event_date""",
        "qa_large_losses_by_lob": f"""SELECT lob, sum(large_loss_count) AS large_losses
            FROM {schema}.gold_claims_by_lob_region GROUP BY lob ORDER BY large_losses DESC, lob""",
        "qa_lobs_over_target": "SELECT * FROM dash_loss_ratio_by_lob WHERE observed_loss_ratio > target_loss_ratio",
        "qa_avg_lag_by_region": f"""SELECT region, avg(report_lag_days) AS avg_report_lag_days,
            count(report_lag_days) AS claims_with_lag FROM {schema}.claims GROUP BY region ORDER BY region""",
    }


def run_question(spark: SparkSession, name: str, schema: str = "claims_lakehouse", **params) -> DataFrame:
    """One business question; pass only the parameters its SQL names."""
    register_dashboard(spark, schema)
    text = question_sql(schema)[name]
    used = {k: v for k, v in params.items() if f":{k}" in text}
    return spark.sql(text, args=used or None)
