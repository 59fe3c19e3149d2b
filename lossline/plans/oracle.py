"""DuckDB SQL twins of the registered batch queries (the correctness oracle).

Each string runs on DuckDB against the raw test views (``orders``,
``customer``); a shared ``WITH`` prelude re-derives bronze, silver, the
firmwide table and gold in SQL. Output types are pinned so both engines
hand the same values to a comparison:

- decimals are returned as DOUBLE (the Spark side casts its exact decimals
  to DOUBLE at the same boundary), integer sums as BIGINT;
- Spark rounds decimal quotients HALF_UP exactly, while DuckDB divides
  decimals in floating point; quotients are therefore computed here on
  integer cents, ``(2 * a + b) // (2 * b)``, which is exact HALF_UP for
  non-negative ``a`` and positive ``b``.
"""

from __future__ import annotations

from ..config import EXTREME_AMOUNT_THRESHOLD, LARGE_LOSS_THRESHOLD, LOBS, VALID_CURRENCIES

_AS_OF = "DATE '2001-08-01'"
_FRESHNESS_AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"
_INGESTED_AT = "TIMESTAMP '2001-08-02 00:00:00'"
_SOURCE = "'testdata://orders+customer'"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _initcap(col: str) -> str:
    # single-word values only (every lob and region in the fixture)
    return f"(upper(left(trim({col}), 1)) || lower(substr(trim({col}), 2)))"


def _cents(expr: str) -> str:
    return f"CAST(round(({expr}) * 100) AS HUGEINT)"


def _ratio_units(num: str, den: str, num_scale: int, den_scale: int, out_scale: int) -> str:
    """round_half_up(num / den, out_scale) * 10^out_scale as an integer;
    ``num``/``den`` are integers carrying ``num_scale``/``den_scale`` decimals."""
    shift = out_scale - num_scale + den_scale
    scaled = f"({num}) * CAST({10 ** shift} AS HUGEINT)" if shift >= 0 else f"({num})"
    div = f"({den})" if shift >= 0 else f"({den}) * CAST({10 ** (-shift)} AS HUGEINT)"
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE (2 * {scaled} + {div}) // (2 * {div}) END"


def _units_to_double(units: str, scale: int) -> str:
    return f"(CAST({units} AS DOUBLE) / CAST({10 ** scale} AS DOUBLE))"


def _ratio4_money(num_money: str, den_money: str) -> str:
    return _ratio_units(_cents(num_money), _cents(den_money), 2, 2, 4)


PRELUDE = f"""
WITH bronze AS (
 SELECT o_orderkey + 1 AS claim_txn_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat(' CLM-', lpad(CAST(o_orderkey - o_orderkey % 3 AS VARCHAR), 7, '0')) END AS claim_id,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('POL-', lpad(CAST(o_custkey AS VARCHAR), 7, '0'), ' ') END AS policy_id,
  CASE (o_orderkey * 7 + o_custkey) % 25 WHEN 24 THEN 'Cyber' ELSE CASE (o_orderkey * 7 + o_custkey) % 6 WHEN 0 THEN 'property' WHEN 1 THEN ' MOTOR ' WHEN 2 THEN 'Liability' WHEN 3 THEN 'marine' WHEN 4 THEN 'Health' ELSE 'LIFE' END END AS lob,
  CASE c_nationkey % 8 WHEN 0 THEN 'Germany' WHEN 1 THEN ' france' WHEN 2 THEN 'ITALY' WHEN 3 THEN 'UK' WHEN 4 THEN 'Spain' WHEN 5 THEN 'switzerland ' WHEN 6 THEN 'Austria' ELSE 'Benelux' END AS region,
  CASE o_orderkey % 4 WHEN 0 THEN 'Fire' WHEN 1 THEN ' Theft' WHEN 2 THEN 'Collision' ELSE NULL END AS peril,
  CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Open' ELSE 'In Review' END AS claim_status,
  CASE o_orderkey % 4 WHEN 0 THEN 'Reserve' WHEN 1 THEN 'Payment' WHEN 2 THEN 'Recovery' ELSE 'Adjustment' END AS transaction_type,
  CAST(CASE WHEN o_orderkey % 211 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) * 20 WHEN o_orderkey % 89 = 0 THEN -CAST(o_totalprice AS DECIMAL(14,2)) ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS DECIMAL(14,2)) AS claim_amount,
  CASE WHEN o_orderkey % 83 = 0 THEN 'JPY' WHEN c_nationkey % 8 = 3 THEN 'gbp' WHEN c_nationkey % 8 = 5 THEN ' CHF' ELSE 'EUR' END AS currency,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS incident_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 - 2 AS INTEGER) AS reported_date,
  CAST(o_orderdate AS TIMESTAMP) AS event_ts,
  CAST(o_orderdate AS TIMESTAMP) AS created_at,
  {_INGESTED_AT} AS _ingested_at,
  {_SOURCE} AS _source
 FROM orders JOIN customer ON o_custkey = c_custkey
),
typed AS (
 SELECT CAST(claim_txn_id AS BIGINT) AS claim_txn_id,
  trim(claim_id) AS claim_id,
  trim(policy_id) AS policy_id,
  {_initcap('lob')} AS lob,
  {_initcap('region')} AS region,
  trim(peril) AS peril,
  trim(claim_status) AS claim_status,
  trim(transaction_type) AS transaction_type,
  CAST(claim_amount AS DECIMAL(14,2)) AS claim_amount,
  upper(trim(currency)) AS currency,
  CAST(incident_date AS DATE) AS incident_date,
  CAST(reported_date AS DATE) AS reported_date,
  CAST(event_ts AS TIMESTAMP) AS event_ts,
  CAST(_ingested_at AS TIMESTAMP) AS _ingested_at,
  CAST(date_trunc('month', CAST(event_ts AS TIMESTAMP)) AS TIMESTAMP) AS claim_month,
  CAST(claim_amount AS DECIMAL(14,2)) >= {LARGE_LOSS_THRESHOLD} AS is_large_loss,
  CAST(date_diff('day', CAST(incident_date AS DATE), CAST(reported_date AS DATE)) AS INTEGER) AS report_lag_days
 FROM bronze
),
flags AS (
 SELECT *,
  coalesce(claim_id IS NOT NULL, false) AS r_valid_claim_id,
  coalesce(policy_id IS NOT NULL, false) AS r_valid_policy_id,
  coalesce(claim_amount > 0, false) AS r_positive_amount,
  coalesce(lob IN ({_list(LOBS)}), false) AS r_valid_lob,
  coalesce(currency IN ({_list(VALID_CURRENCIES)}), false) AS r_valid_currency,
  coalesce(NOT (reported_date >= incident_date), false) AS w_dates_consistent,
  coalesce(NOT (claim_amount < {EXTREME_AMOUNT_THRESHOLD}), false) AS w_amount_not_extreme
 FROM typed
),
silver AS (
 SELECT claim_txn_id, claim_id, policy_id, lob, region, peril, claim_status, transaction_type,
  claim_amount, currency, incident_date, reported_date, event_ts, _ingested_at, claim_month,
  is_large_loss, report_lag_days
 FROM flags
 WHERE r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency
),
firmwide AS (
 SELECT lob, region,
  CAST(gwp AS DECIMAL(18,2)) AS gross_written_premium,
  CAST(gwp * (3 + 2 * u) AS DECIMAL(18,2)) AS total_exposure,
  CAST(round(CAST(gwp AS DOUBLE) / CAST(1500 + 3000 * u AS DOUBLE)) AS BIGINT) AS policy_count,
  CAST(1500 + 3000 * u AS DECIMAL(12,2)) AS avg_premium,
  CAST(target_lr AS DECIMAL(5,4)) AS target_loss_ratio,
  {_AS_OF} AS as_of_date
 FROM (
  SELECT lob, region, target_lr, CAST(base_premium * mult AS DECIMAL(18,2)) AS gwp,
   CAST((length(lob) * 31 + length(region) * 17) % 100 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS u
  FROM (VALUES ('Property', 90000000, 0.62), ('Motor', 120000000, 0.71), ('Liability', 60000000, 0.55),
               ('Marine', 35000000, 0.58), ('Health', 80000000, 0.78), ('Life', 70000000, 0.45)) l(lob, base_premium, target_lr)
  CROSS JOIN (VALUES ('Germany', 1.35), ('France', 1.15), ('Italy', 0.95), ('UK', 1.25), ('Spain', 0.85),
                     ('Switzerland', 0.80), ('Austria', 0.60), ('Benelux', 0.90)) r(region, mult)
 ) z
),
by_lob_region AS (
 SELECT lob, region, currency,
  count(*) AS claim_txn_count,
  count(DISTINCT claim_id) AS distinct_claims,
  sum(claim_amount) AS incurred_amount,
  {_units_to_double(_ratio_units("sum(CAST(claim_amount * 100 AS BIGINT))", "count(*)", 2, 0, 6), 6)} AS avg_claim_amount,
  max(claim_amount) AS max_claim_amount,
  count(*) FILTER (WHERE is_large_loss) AS large_loss_count,
  max(event_ts) AS last_event_ts
 FROM silver GROUP BY lob, region, currency
),
claims_agg AS (
 SELECT lob, region, sum(claim_amount) AS incurred_amount, count(*) AS claim_txn_count
 FROM silver GROUP BY lob, region
),
lr_fixed_raw AS (
 SELECT f.lob, f.region, coalesce(a.incurred_amount, 0) AS incurred,
  coalesce(a.claim_txn_count, 0) AS claim_txn_count, f.gross_written_premium, f.target_loss_ratio
 FROM firmwide f LEFT JOIN (
  SELECT lower(trim(lob)) AS k_lob, lower(trim(region)) AS k_region,
   sum(incurred_amount) AS incurred_amount, sum(claim_txn_count) AS claim_txn_count
  FROM claims_agg GROUP BY 1, 2) a
 ON lower(trim(f.lob)) = a.k_lob AND lower(trim(f.region)) = a.k_region
),
lr_compat_raw AS (
 SELECT f.lob, f.region, coalesce(a.incurred_amount, 0) AS incurred,
  coalesce(a.claim_txn_count, 0) AS claim_txn_count, f.gross_written_premium, f.target_loss_ratio
 FROM firmwide f LEFT JOIN claims_agg a ON f.lob = a.lob AND f.region = a.region
),
loss_ratio AS (
 SELECT lob, region, CAST(incurred AS DECIMAL(18,2)) AS incurred_amount, claim_txn_count,
  gross_written_premium, target_loss_ratio,
  {_ratio4_money('incurred', 'gross_written_premium')} AS observed_units
 FROM lr_fixed_raw
),
loss_ratio_compat AS (
 SELECT lob, region, CAST(incurred AS DECIMAL(18,2)) AS incurred_amount, claim_txn_count,
  gross_written_premium, target_loss_ratio,
  {_ratio4_money('incurred', 'gross_written_premium')} AS observed_units
 FROM lr_compat_raw
),
daily AS (
 SELECT CAST(event_ts AS DATE) AS event_date, lob,
  count(*) AS claim_txn_count,
  sum(claim_amount) AS incurred_amount,
  avg(report_lag_days) AS avg_report_lag_days
 FROM silver GROUP BY 1, 2
)
"""


def _lr_select(rel: str) -> str:
    return f"""SELECT lob, region, CAST(incurred_amount AS DOUBLE) AS incurred_amount,
 CAST(claim_txn_count AS BIGINT) AS claim_txn_count,
 CAST(gross_written_premium AS DOUBLE) AS gross_written_premium,
 CAST(target_loss_ratio AS DOUBLE) AS target_loss_ratio,
 {_units_to_double('observed_units', 4)} AS observed_loss_ratio,
 CASE WHEN observed_units > CAST(round(target_loss_ratio * 10000) AS HUGEINT) THEN 'OVER' ELSE 'UNDER' END AS vs_target
FROM {rel}"""


_BRONZE_COLS = ("claim_txn_id, claim_id, policy_id, lob, region, peril, claim_status, transaction_type, "
                "CAST(claim_amount AS DOUBLE) AS claim_amount, currency, incident_date, reported_date, "
                "event_ts, _source")

_SILVER_COLS = ("claim_txn_id, claim_id, policy_id, lob, region, peril, claim_status, transaction_type, "
                "CAST(claim_amount AS DOUBLE) AS claim_amount, currency, incident_date, reported_date, "
                "event_ts, _ingested_at, claim_month, is_large_loss, report_lag_days")

_BY_LOB_REGION = """SELECT lob, region, currency, claim_txn_count, distinct_claims,
 CAST(incurred_amount AS DOUBLE) AS incurred_amount, avg_claim_amount,
 CAST(max_claim_amount AS DOUBLE) AS max_claim_amount, large_loss_count, last_event_ts
FROM by_lob_region"""

_BY_LOB = f"""SELECT lob,
 {_units_to_double(_ratio4_money('sum(incurred_amount)', 'sum(gross_written_premium)'), 4)} AS observed_loss_ratio,
 round(avg(CAST(target_loss_ratio AS DOUBLE)), 4) AS target_loss_ratio,
 CAST(sum(gross_written_premium) AS DOUBLE) AS gross_written_premium,
 CAST(sum(incurred_amount) AS DOUBLE) AS incurred_amount
FROM loss_ratio GROUP BY lob"""

_WORST_REGION_UNITS = f"""SELECT region,
 sum(incurred_amount) AS incurred_amount,
 sum(gross_written_premium) AS gross_written_premium,
 {_ratio4_money('sum(incurred_amount)', 'sum(gross_written_premium)')} AS obs_units,
 {_ratio_units("sum(CAST(round(target_loss_ratio * 10000) AS HUGEINT) * " + _cents('gross_written_premium') + ")",
               "sum(" + _cents('gross_written_premium') + ")", 6, 2, 4)} AS tgt_units
FROM loss_ratio GROUP BY region"""


ORACLE_SQL: dict[str, str] = {
    "bronze_watermark": f"""SELECT _source, CAST(coalesce(max(claim_txn_id), 0) AS BIGINT) AS watermark,
 count(*) AS bronze_rows FROM bronze GROUP BY _source""",
    "bronze_increment": f"SELECT {_BRONZE_COLS} FROM bronze WHERE claim_txn_id > 0",
    "bronze_latest": f"SELECT {_BRONZE_COLS} FROM bronze ORDER BY claim_txn_id DESC LIMIT 10",
    "table_health": """SELECT 'silver.claims' AS table_name, 'OK' AS status, count(*) AS rows FROM silver
 UNION ALL SELECT 'gold.gold_loss_ratio', 'OK', count(*) FROM loss_ratio
 UNION ALL SELECT 'gold.gold_claims_by_lob_region', 'OK', count(*) FROM by_lob_region
 UNION ALL SELECT 'gold.gold_claims_daily', 'OK', count(*) FROM daily
 UNION ALL SELECT 'reference.firmwide_exposure', 'OK', count(*) FROM firmwide""",
    "silver_typed": f"SELECT {_SILVER_COLS} FROM typed",
    "silver_claims": f"SELECT {_SILVER_COLS} FROM silver",
    "dq_report": """SELECT count(*) AS bronze_rows,
 count(*) FILTER (WHERE r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency) AS silver_rows,
 count(*) FILTER (WHERE NOT (r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency)) AS dropped_rows,
 count(*) FILTER (WHERE NOT r_valid_claim_id) AS drop_valid_claim_id,
 count(*) FILTER (WHERE NOT r_valid_policy_id) AS drop_valid_policy_id,
 count(*) FILTER (WHERE NOT r_positive_amount) AS drop_positive_amount,
 count(*) FILTER (WHERE NOT r_valid_lob) AS drop_valid_lob,
 count(*) FILTER (WHERE NOT r_valid_currency) AS drop_valid_currency,
 count(*) FILTER (WHERE r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency AND w_dates_consistent) AS warn_dates_consistent,
 count(*) FILTER (WHERE r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency AND w_amount_not_extreme) AS warn_amount_not_extreme
FROM flags""",
    "dq_valid_keys": """SELECT claim_txn_id, claim_id, policy_id, r_valid_claim_id AS valid_claim_id,
 r_valid_policy_id AS valid_policy_id FROM flags WHERE NOT (r_valid_claim_id AND r_valid_policy_id)""",
    "dq_valid_domains": """SELECT claim_txn_id, lob, currency, r_valid_lob AS valid_lob,
 r_valid_currency AS valid_currency FROM flags WHERE NOT (r_valid_lob AND r_valid_currency)""",
    "dq_amount_rules": """SELECT claim_txn_id, CAST(claim_amount AS DOUBLE) AS claim_amount,
 r_positive_amount AS positive_amount, coalesce(claim_amount < 5000000, false) AS amount_not_extreme
 FROM flags WHERE NOT r_positive_amount OR w_amount_not_extreme""",
    "dq_dates_consistent": """SELECT claim_txn_id, incident_date, reported_date, report_lag_days,
 coalesce(reported_date >= incident_date, false) AS dates_consistent
 FROM silver WHERE coalesce(NOT (reported_date >= incident_date), false)""",
    "dq_quarantine": """SELECT claim_txn_id, claim_id, policy_id, lob, currency, CAST(claim_amount AS DOUBLE) AS claim_amount,
 concat_ws(',',
  CASE WHEN NOT r_valid_claim_id THEN 'valid_claim_id' END,
  CASE WHEN NOT r_valid_policy_id THEN 'valid_policy_id' END,
  CASE WHEN NOT r_positive_amount THEN 'positive_amount' END,
  CASE WHEN NOT r_valid_lob THEN 'valid_lob' END,
  CASE WHEN NOT r_valid_currency THEN 'valid_currency' END) AS failed_rules
FROM flags WHERE NOT (r_valid_claim_id AND r_valid_policy_id AND r_positive_amount AND r_valid_lob AND r_valid_currency)""",
    "_firmwide_exposure": """SELECT lob, region, CAST(gross_written_premium AS DOUBLE) AS gross_written_premium,
 CAST(total_exposure AS DOUBLE) AS total_exposure, policy_count, CAST(avg_premium AS DOUBLE) AS avg_premium,
 CAST(target_loss_ratio AS DOUBLE) AS target_loss_ratio, as_of_date FROM firmwide""",
    "_firmwide_by_lob": """SELECT lob, count(*) AS regions, CAST(sum(gross_written_premium) AS DOUBLE) AS gwp
 FROM firmwide GROUP BY lob ORDER BY lob""",
    "gold_claims_by_lob_region": _BY_LOB_REGION,
    "gold_loss_ratio": _lr_select("loss_ratio"),
    "gold_loss_ratio_compat": _lr_select("loss_ratio_compat"),
    "loss_ratio_unmatched": """SELECT a.lob, a.region, CAST(a.incurred_amount AS DOUBLE) AS incurred_amount,
 a.claim_txn_count FROM claims_agg a
 WHERE NOT EXISTS (SELECT 1 FROM firmwide f WHERE f.lob = a.lob AND f.region = a.region)""",
    "gold_claims_daily": """SELECT event_date, lob, claim_txn_count, CAST(incurred_amount AS DOUBLE) AS incurred_amount,
 avg_report_lag_days FROM daily""",
    "dash_kpis": """SELECT CAST(sum(incurred_amount) AS DOUBLE) AS total_incurred,
 CAST(sum(claim_txn_count) AS BIGINT) AS total_transactions,
 CAST(sum(distinct_claims) AS BIGINT) AS distinct_claims,
 CAST(sum(large_loss_count) AS BIGINT) AS large_losses FROM by_lob_region""",
    "kpi_distinct_claims": "SELECT count(DISTINCT claim_id) AS distinct_claims FROM silver",
    "claims_summary": """SELECT claim_id, count(*) AS claim_txn_count, CAST(sum(claim_amount) AS DOUBLE) AS incurred_amount,
 min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts FROM silver WHERE claim_id IS NOT NULL GROUP BY claim_id""",
    "kpi_distinct_bitmap": "SELECT count(DISTINCT claim_id) AS distinct_claims FROM silver",
    "dash_incurred_by_lob": """SELECT lob, CAST(sum(incurred_amount) AS DOUBLE) AS incurred_amount,
 CAST(sum(claim_txn_count) AS BIGINT) AS txns FROM by_lob_region GROUP BY lob ORDER BY incurred_amount DESC""",
    "dash_loss_ratio_by_lob": _BY_LOB + " ORDER BY observed_loss_ratio DESC",
    "dash_loss_ratio_heat": f"""SELECT lob, region, {_units_to_double('observed_units', 4)} AS observed_loss_ratio,
 CAST(target_loss_ratio AS DOUBLE) AS target_loss_ratio,
 CASE WHEN observed_units > CAST(round(target_loss_ratio * 10000) AS HUGEINT) THEN 'OVER' ELSE 'UNDER' END AS vs_target
FROM loss_ratio ORDER BY observed_loss_ratio DESC""",
    "dash_loss_ratio_pivot": "SELECT lob, " + ", ".join(
        f"max(CASE WHEN region = '{r}' THEN {_units_to_double('observed_units', 4)} END) AS \"{r}\""
        for r in ("Germany", "France", "Italy", "UK", "Spain", "Switzerland", "Austria", "Benelux")
    ) + " FROM loss_ratio GROUP BY lob ORDER BY lob",
    "dash_daily_trend": """SELECT event_date, lob, CAST(incurred_amount AS DOUBLE) AS incurred_amount, claim_txn_count
 FROM daily ORDER BY event_date, lob""",
    "dash_freshness": f"""SELECT max(event_ts) AS latest_event,
 date_diff('second', max(event_ts), {_FRESHNESS_AS_OF}) AS seconds_since_latest,
 count(*) AS silver_rows FROM silver""",
    "qa_incurred_by_lob_day": f"""SELECT lob, CAST(sum(incurred_amount) AS DOUBLE) AS incurred_amount,
 CAST(sum(claim_txn_count) AS BIGINT) AS claim_txn_count
 FROM daily WHERE event_date = {_AS_OF} GROUP BY lob ORDER BY incurred_amount DESC""",
    "qa_worst_region": f"""SELECT region, CAST(incurred_amount AS DOUBLE) AS incurred_amount,
 CAST(gross_written_premium AS DOUBLE) AS gross_written_premium,
 {_units_to_double('obs_units', 4)} AS observed_loss_ratio,
 {_units_to_double('tgt_units', 4)} AS target_loss_ratio,
 {_units_to_double('obs_units - tgt_units', 4)} AS gap
FROM ({_WORST_REGION_UNITS}) t ORDER BY obs_units - tgt_units DESC NULLS LAST, region ASC LIMIT 1""",
    "qa_lob_trend_7d": f"""SELECT event_date, lob, claim_txn_count, CAST(incurred_amount AS DOUBLE) AS incurred_amount
 FROM daily WHERE lob = 'Motor' AND event_date BETWEEN {_AS_OF} - INTERVAL 6 DAY AND {_AS_OF}
 ORDER BY event_date""",
    "qa_large_losses_by_lob": """SELECT lob, CAST(sum(large_loss_count) AS BIGINT) AS large_losses
 FROM by_lob_region GROUP BY lob ORDER BY large_losses DESC, lob""",
    "qa_lobs_over_target": f"""SELECT * FROM ({_BY_LOB}) t WHERE observed_loss_ratio > target_loss_ratio""",
    "qa_avg_lag_by_region": """SELECT region, avg(report_lag_days) AS avg_report_lag_days,
 count(report_lag_days) AS claims_with_lag FROM silver GROUP BY region ORDER BY region""",
}


def oracle_sql() -> dict[str, str]:
    """SQL twins of the registered keys (names starting with ``_`` belong to
    unregistered reference queries and are used by the tests only)."""
    return {name: PRELUDE + body for name, body in ORACLE_SQL.items() if not name.startswith("_")}


def reference_oracle_sql() -> dict[str, str]:
    return {name[1:]: PRELUDE + body for name, body in ORACLE_SQL.items() if name.startswith("_")}
