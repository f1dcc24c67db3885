"""Independent SQL for the registered queries, for a second engine to run.

The statements compute the expected values from the sample tables directly. They do
not repeat the parsing and cleaning steps: where the engine parses an amount out of
text, for example, the SQL takes the price column the text was made from.
"""

from __future__ import annotations

_ARRIVAL = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_MERCHANT = "merchant_id, merchant_city, merchant_state, merchant_zip_code, merchant_category_code"

_CLEAN = """
pay AS (
  SELECT l.*, o_custkey, s_nationkey, n_name, n_regionkey, p_size,
    l_linenumber % 4 = 2 AS online,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 7
      THEN -l_extendedprice ELSE l_extendedprice END AS price
  FROM lineitem l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
),
clean AS (
  SELECT *,
    CASE WHEN l_partkey % 97 <> 0 THEN o_custkey END AS user_id,
    CAST(l_linenumber AS BIGINT) AS card_id,
    CASE WHEN l_partkey % 101 <> 0 THEN
      CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)
        + to_hours(CAST(l_orderkey % 24 AS BIGINT))
        + to_minutes(CAST(l_partkey % 60 AS BIGINT)) END AS ts,
    CASE WHEN l_partkey % 103 <> 0 THEN CAST(price AS DECIMAL(18, 4)) END AS amount,
    CASE l_linenumber % 4 WHEN 0 THEN 'SWIPE' WHEN 1 THEN 'CHIP' WHEN 2 THEN 'ONLINE'
      ELSE 'UNKNOWN' END AS transaction_method,
    CAST(8000000000000000000 + l_suppkey AS BIGINT) AS merchant_id,
    n_name AS merchant_city,
    CASE WHEN NOT online THEN 'R' || CAST(n_regionkey AS VARCHAR) END AS merchant_state,
    CASE WHEN NOT online THEN CAST(10000 + s_nationkey AS VARCHAR) END AS merchant_zip_code,
    CAST(5000 + p_size AS BIGINT) AS merchant_category_code,
    CASE WHEN l_partkey % 7 = 0 OR l_returnflag = 'N' THEN 'NO_ERROR'
      WHEN l_returnflag = 'A' THEN 'Bad PIN' ELSE 'Technical Glitch' END AS transaction_error,
    CASE WHEN l_linestatus = 'F' AND l_quantity >= 49 THEN TRUE
      WHEN l_partkey % 107 = 0 THEN NULL ELSE FALSE END AS is_fraud
  FROM pay
),
judged AS (
  SELECT *, concat_ws(';',
    CASE WHEN user_id IS NULL THEN 'MISSING_USER_ID' END,
    CASE WHEN amount IS NULL THEN 'INVALID_AMOUNT' END,
    CASE WHEN ts IS NULL THEN 'INVALID_TRANSACTION_TIMESTAMP' END,
    CASE WHEN is_fraud IS NULL THEN 'INVALID_FRAUD_FLAG' END) AS reason
  FROM clean
),
valid AS (SELECT *, transaction_error <> 'NO_ERROR' AS has_error FROM judged WHERE reason = '')
"""

_DATES = """,
dim_d AS (
  SELECT
    CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key,
    CAST(d AS DATE) AS full_date,
    CAST(year(d) AS BIGINT) AS calendar_year,
    CAST(quarter(d) AS BIGINT) AS calendar_quarter,
    CAST(month(d) AS BIGINT) AS calendar_month_number,
    monthname(d) AS calendar_month_name,
    CAST(day(d) AS BIGINT) AS calendar_day_of_month,
    CAST(isodow(d) AS BIGINT) AS calendar_day_of_week_number,
    dayname(d) AS calendar_day_name,
    isodow(d) >= 6 AS is_weekend,
    strftime(d, '%Y-%m') AS calendar_year_month,
    CAST(year(d) * 100 + month(d) AS BIGINT) AS calendar_year_month_sort
  FROM (
    SELECT unnest(generate_series(
      (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) FROM valid),
      (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) FROM valid),
      INTERVAL 1 DAY)) AS d
  ) AS days
)
"""

_MERCHANTS = f""",
dim_m AS (
  SELECT *, CAST(merchant_id AS VARCHAR) AS merchant_id_text,
    'MRC-' || CASE WHEN merchant_key < 1000000
      THEN lpad(CAST(merchant_key AS VARCHAR), 6, '0')
      ELSE CAST(merchant_key AS VARCHAR) END AS merchant_display_label
  FROM (
    SELECT row_number() OVER (ORDER BY merchant_id NULLS LAST, merchant_city NULLS LAST,
        merchant_state NULLS LAST, merchant_zip_code NULLS LAST,
        merchant_category_code NULLS LAST) AS merchant_key, {_MERCHANT}
    FROM (SELECT DISTINCT {_MERCHANT} FROM valid) AS merchants
  ) AS numbered
)
"""

_FACT = f""",
fact AS (
  SELECT row_number() OVER (ORDER BY {_ARRIVAL}) AS transaction_key,
    CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key,
    merchant_key, user_id, card_id, ts, amount, transaction_method,
    v.merchant_category_code, transaction_error, is_fraud, has_error,
    CAST(year(ts) AS BIGINT) AS calendar_year
  FROM valid v JOIN dim_m m
    ON v.merchant_id IS NOT DISTINCT FROM m.merchant_id
    AND v.merchant_city IS NOT DISTINCT FROM m.merchant_city
    AND v.merchant_state IS NOT DISTINCT FROM m.merchant_state
    AND v.merchant_zip_code IS NOT DISTINCT FROM m.merchant_zip_code
    AND v.merchant_category_code IS NOT DISTINCT FROM m.merchant_category_code
)
"""

# Per calendar year: its own sums and those of its days moved back one year.
_YEARS = """,
sums AS (
  SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key, CAST(ts AS DATE) AS full_date,
    CAST(year(ts) AS BIGINT) AS calendar_year, count(*) AS n, sum(amount) AS amount,
    count(*) FILTER (is_fraud) AS frauds, count(*) FILTER (has_error) AS errors,
    sum(amount) FILTER (is_fraud) AS exposure
  FROM valid GROUP BY ALL
),
moved AS (
  SELECT DISTINCT calendar_year, CAST(full_date - INTERVAL 1 YEAR AS DATE) AS full_date
  FROM dim_d
),
this_year AS (
  SELECT calendar_year, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(amount) AS DOUBLE) AS amount,
    CAST(sum(frauds) AS DOUBLE) AS frauds, CAST(sum(errors) AS DOUBLE) AS errors,
    CAST(sum(exposure) AS DOUBLE) AS exposure, max(full_date) AS covered,
    sum(amount) AS exact_amount
  FROM sums GROUP BY calendar_year
),
last_year AS (
  SELECT moved.calendar_year, CAST(sum(n) AS DOUBLE) AS pn, CAST(sum(amount) AS DOUBLE) AS pamount,
    CAST(sum(frauds) AS DOUBLE) AS pfrauds, CAST(sum(errors) AS DOUBLE) AS perrors,
    sum(amount) AS exact_pamount
  FROM sums JOIN moved USING (full_date) GROUP BY moved.calendar_year
),
both_years AS (
  SELECT *, CAST(exact_amount - exact_pamount AS DOUBLE) AS damount
  FROM this_year LEFT JOIN last_year USING (calendar_year)
)
"""

_BY_MERCHANT = """,
by_merchant AS (
  SELECT merchant_key, count(*) AS n, count(*) FILTER (is_fraud) AS frauds,
    sum(amount) FILTER (is_fraud) AS exposure
  FROM fact GROUP BY merchant_key
)
"""


def _with(*parts: str) -> str:
    return "WITH " + _CLEAN + "".join(parts)


def _r2(amount: str) -> str:
    """An exact decimal, rounded half away from zero."""
    return f"CAST(round({amount}, 2) AS DOUBLE)"


def _cents(numerator: str, denominator: str) -> str:
    """100 times a quotient of whole numbers: quotient and remainder, carried from half."""
    n, d = f"abs(CAST(100 * ({numerator}) AS HUGEINT))", f"abs(CAST(nullif({denominator}, 0) AS HUGEINT))"
    sign = f"(CASE WHEN ({numerator} < 0) <> ({denominator} < 0) THEN -1 ELSE 1 END)"
    return f"({sign} * ({n} // {d} + CASE WHEN {n} % {d} * 2 >= {d} THEN 1 ELSE 0 END))"


def _quotient(numerator: str, denominator: str) -> str:
    return f"(CAST({_cents(numerator, denominator)} AS DOUBLE) / 100)"


def _text(cents: str) -> str:
    return f"CAST(CAST(CAST({cents} AS DOUBLE) / 100 AS DECIMAL(32, 2)) AS VARCHAR)"


def _two(amount: str) -> str:
    return f"CAST(CAST(round(CAST({amount} AS DECIMAL(38, 4)), 2) AS DECIMAL(38, 2)) AS VARCHAR)"


def _units(amount: str) -> str:
    """An amount or a count in ten-thousandths, as a whole number."""
    return f"CAST(CAST({amount} AS DECIMAL(28, 4)) * 10000 AS HUGEINT)"


def _percent(part: str, total: str) -> str:
    return f"({_text(_cents(f'100 * {_units(part)}', _units(total)))} || '%')"


def _bps(part: str) -> str:
    """Text of the change of a share of counts in basis points."""
    whole = "CAST({} AS HUGEINT)".format
    change = f"({whole(part)} * {whole('pn')} - {whole('p' + part)} * {whole('n')}) * 10000"
    return _text(_cents(f"({change})", f"({whole('n')} * {whole('pn')})"))


_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_N = "CAST(count(*) AS BIGINT)"
_TOTAL = f"{_r2('sum(amount)')} AS total_transaction_amount"
_MEAN = _quotient(_units("sum(amount)"), "(10000 * count(*))")
_AVERAGE = f"{_MEAN} AS average_transaction_amount"
_FRAUDS = "CAST(count(*) FILTER (is_fraud) AS BIGINT)"
_RATE = _quotient("100 * count(*) FILTER (is_fraud)", "count(*)")

# The selection used by the filtered dashboard queries.
YEARS = (1997, 1998, 1999)
METHODS = ("CHIP", "ONLINE")
_SELECTED = "year(ts) IN (1997, 1998, 1999) AND transaction_method IN ('CHIP', 'ONLINE')"


def _direction(change: str) -> str:
    return (
        f"CASE WHEN {change} < 0 THEN 'Improving' WHEN {change} > 0 THEN 'Worsening' "
        f"WHEN {change} = 0 THEN 'Stable' END"
    )


_FRAUD_BPS = "(frauds / n - pfrauds / pn) * 10000"
_ERROR_BPS = "(errors / n - perrors / pn) * 10000"


def _deviation(name: str, kind: str) -> str:
    """Sample standard deviation from exact whole numbers; text parses to the nearest double."""
    unit = 1 if kind == "bigint" else 1_000_000
    value = f'CAST(round(CAST("{name}" AS DECIMAL(38, 6)) * {unit}) AS HUGEINT)'
    low, n = f"{value} % 1000000000", f'CAST(count("{name}") AS HUGEINT)'
    high = f"({value} - {low}) // 1000000000"

    def part(a: str, b: str) -> str:
        exact = f"{n} * sum(({a}) * ({b}))::HUGEINT - sum({a})::HUGEINT * sum({b})::HUGEINT"
        return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"

    return (
        f"sqrt(({part(high, high)} * 1e9 * 1e9 + {part(high, low)} * 2.0::DOUBLE * 1e9 + {part(low, low)}) "
        f"/ CAST({n} * ({n} - 1) AS DOUBLE)) / {unit}.0::DOUBLE")


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}

    # ------------------------------------------------------------------ silver
    sql["silver_clean"] = _with() + f"""
SELECT user_id, card_id, {_STAMP} AS transaction_timestamp,
  CAST(amount AS DOUBLE) AS transaction_amount, transaction_method, {_MERCHANT},
  transaction_error, is_fraud
FROM valid"""
    sql["quarantine_rows"] = _with() + f"""
SELECT user_id, card_id, CAST(year(l_shipdate) AS BIGINT) AS transaction_year,
  CAST(month(l_shipdate) AS BIGINT) AS transaction_month,
  CAST(day(l_shipdate) AS BIGINT) AS transaction_day,
  CASE WHEN l_partkey % 101 = 0 THEN '99:99' ELSE CAST(l_orderkey % 24 AS VARCHAR)
    || ':' || CAST(l_partkey % 60 AS VARCHAR) END AS transaction_time,
  {_STAMP} AS transaction_timestamp,
  CASE WHEN l_partkey % 103 = 0 THEN 'UNKNOWN'
    ELSE '$' || format('{{:,.2f}}', price) END AS transaction_amount_raw,
  CAST(amount AS DOUBLE) AS transaction_amount, transaction_method, merchant_id,
  merchant_city, merchant_state,
  CASE WHEN NOT online THEN CAST(10000 + s_nationkey AS DOUBLE) END AS merchant_zip_code_raw,
  merchant_zip_code, merchant_category_code, transaction_error,
  CASE WHEN is_fraud THEN 'Yes' WHEN NOT is_fraud THEN 'No' ELSE 'Maybe' END AS is_fraud_raw,
  is_fraud, reason AS quarantine_reason
FROM judged WHERE reason <> ''"""
    sql["quarantine_reason_counts"] = _with() + f"""
SELECT reason AS quarantine_reason, {_N} AS quarantined_rows
FROM judged WHERE reason <> '' GROUP BY reason"""
    sql["silver_reconciliation"] = _with() + f"""
SELECT (SELECT count(*) FROM lineitem) AS bronze_rows_read,
  CAST(count(*) FILTER (reason = '') AS BIGINT) AS silver_rows_written,
  CAST(count(*) FILTER (reason <> '') AS BIGINT) AS quarantine_rows_written,
  (SELECT count(*) FROM lineitem) = count(*) AS reconciliation_passed
FROM judged"""

    # -------------------------------------------------------------------- gold
    sql["dim_merchant"] = _with(_MERCHANTS) + f"SELECT merchant_key, {_MERCHANT} FROM dim_m"
    date_columns = """date_key, strftime(full_date, '%Y-%m-%d') AS full_date, calendar_year,
  calendar_quarter, calendar_month_number, calendar_month_name, calendar_day_of_month,
  calendar_day_of_week_number, calendar_day_name, is_weekend"""
    sql["dim_date"] = _with(_DATES) + f"SELECT {date_columns} FROM dim_d"
    sql["fact_transaction"] = _with(_MERCHANTS, _FACT) + f"""
SELECT transaction_key, date_key, merchant_key, user_id, card_id,
  {_STAMP} AS transaction_timestamp, CAST(amount AS DOUBLE) AS transaction_amount,
  transaction_method, merchant_category_code, transaction_error, is_fraud
FROM fact"""
    key_checks = """
  (SELECT count(*) FROM dim_m) AS merchant_rows,
  (SELECT count(*) - count(DISTINCT merchant_key) FROM dim_m) AS duplicate_merchant_keys,
  (SELECT count(*) FILTER (merchant_key IS NULL) FROM dim_m) AS missing_merchant_keys,
  (SELECT count(*) FROM dim_d) AS date_rows,
  (SELECT count(*) - count(DISTINCT date_key) FROM dim_d) AS duplicate_date_keys,
  (SELECT count(*) FILTER (date_key IS NULL) FROM dim_d) AS missing_date_keys,
  (SELECT count(*) - count(DISTINCT transaction_key) FROM fact) AS duplicate_transaction_keys,
  (SELECT count(*) FILTER (transaction_key IS NULL) FROM fact) AS missing_transaction_keys,
  (SELECT count(*) FROM fact WHERE merchant_key NOT IN (SELECT merchant_key FROM dim_m))
    AS invalid_merchant_foreign_keys,
  (SELECT count(*) FROM fact WHERE date_key NOT IN (SELECT date_key FROM dim_d))
    AS invalid_date_foreign_keys"""
    everything = _with(_DATES, _MERCHANTS, _FACT)
    sql["gold_validation"] = everything + f"""
SELECT (SELECT count(*) FROM valid) AS expected_fact_rows,
  (SELECT count(*) FROM fact) AS actual_fact_rows, {key_checks}, TRUE AS is_valid"""
    sql["analytics_validation"] = everything + f"""
SELECT (SELECT count(*) FROM fact) AS transaction_rows, {key_checks}, TRUE AS is_valid"""

    # ------------------------------------------------------------------- views
    kpi = f"""{_TOTAL}, {_AVERAGE}, {_FRAUDS} AS fraudulent_transactions,
  {_RATE} AS fraud_transaction_rate_percent"""
    sql["platform_kpis"] = _with() + f"SELECT {_N} AS total_transactions, {kpi} FROM valid"
    sql["method_summary"] = _with() + f"""
SELECT transaction_method, {_N} AS transaction_count, {kpi} FROM valid GROUP BY 1"""
    sql["annual_summary"] = _with() + f"""
SELECT CAST(year(ts) AS BIGINT) AS calendar_year, {_N} AS transaction_count, {kpi}
FROM valid GROUP BY 1"""
    sql["view_reconciliation"] = _with() + f"""
SELECT name AS view, {_N} AS transaction_count, {_TOTAL}, TRUE AS reconciles
FROM valid CROSS JOIN (VALUES ('platform'), ('method'), ('annual')) AS names(name)
GROUP BY name"""

    # -------------------------------------------------------- reporting tables
    sql["bi_dim_date"] = _with(_DATES) + f"""
SELECT {date_columns}, calendar_year_month, calendar_year_month_sort FROM dim_d"""
    sql["bi_dim_merchant"] = _with(_MERCHANTS) + f"""
SELECT merchant_key, {_MERCHANT}, merchant_id_text, merchant_display_label FROM dim_m"""
    sql["bi_fact"] = _with(_MERCHANTS, _FACT) + f"""
SELECT transaction_key, date_key, merchant_key, card_id, {_STAMP} AS transaction_timestamp,
  CAST(amount AS DOUBLE) AS transaction_amount, transaction_method, transaction_error,
  is_fraud, has_error
FROM fact"""
    sql["bi_controls"] = everything + f"""
SELECT {key_checks}, (SELECT count(*) FROM fact) AS transaction_rows,
  (SELECT count(*) FROM dim_d) AS source_date_rows,
  (SELECT count(*) FROM dim_m) AS source_merchant_rows,
  (SELECT count(*) FROM valid) AS source_transaction_rows,
  (SELECT count(*) FILTER (merchant_id_text IS NULL) FROM dim_m) AS missing_merchant_id_text,
  (SELECT count(*) FILTER (CAST(merchant_id_text AS BIGINT) <> merchant_id) FROM dim_m)
    AS merchant_id_text_mismatches,
  (SELECT count(*) - count(DISTINCT merchant_display_label) FROM dim_m)
    AS duplicate_merchant_display_labels,
  (SELECT count(*) FILTER (calendar_year_month IS NULL) FROM dim_d) AS missing_month_labels,
  (SELECT CAST(sum(amount) AS DOUBLE) FROM fact) AS transaction_amount_total,
  (SELECT CAST(sum(amount) AS DOUBLE) FROM valid) AS source_transaction_amount_total,
  (SELECT count(*) FILTER (is_fraud) FROM fact) AS fraud_transaction_count,
  (SELECT count(*) FILTER (is_fraud) FROM valid) AS source_fraud_transaction_count,
  (SELECT count(*) FILTER (has_error) FROM fact) AS error_transaction_count,
  (SELECT count(*) FILTER (transaction_error <> 'NO_ERROR') FROM valid)
    AS source_error_transaction_count,
  TRUE AS is_valid"""

    # --------------------------------------------------------------- dashboard
    sql["years"] = _with(_DATES) + "SELECT DISTINCT calendar_year FROM dim_d"
    sql["methods"] = _with() + "SELECT DISTINCT transaction_method FROM valid"
    zero = "coalesce({0}, 0)".format
    sql["kpis_filtered"] = _with() + f"""
SELECT {_N} AS total_transactions,
  {zero(_r2('sum(amount)'))} AS total_transaction_amount,
  {zero(_MEAN)} AS average_transaction_amount,
  {_FRAUDS} AS fraudulent_transactions, {zero(_RATE)} AS fraud_transaction_rate_percent
FROM valid WHERE {_SELECTED}"""
    sql["kpis_empty_selection"] = sql["kpis_filtered"].replace(
        _SELECTED, "transaction_method = 'NO SUCH METHOD'"
    )
    sql["annual_filtered"] = _with() + f"""
SELECT CAST(year(ts) AS BIGINT) AS calendar_year, {_N} AS transaction_count, {_TOTAL},
  {_FRAUDS} AS fraudulent_transactions
FROM valid WHERE {_SELECTED} GROUP BY 1"""
    sql["method_filtered"] = _with() + f"""
SELECT transaction_method, {_N} AS transaction_count, {_TOTAL}, {_AVERAGE}
FROM valid WHERE {_SELECTED} GROUP BY 1"""
    sql["fraud_by_method"] = _with() + f"""
SELECT transaction_method, {_N} AS transaction_count, {_FRAUDS} AS fraudulent_transactions,
  {_RATE} AS fraud_rate_percent
FROM valid GROUP BY 1"""
    sql["fraud_by_year"] = _with() + f"""
SELECT CAST(year(ts) AS BIGINT) AS calendar_year, {_FRAUDS} AS fraudulent_transactions,
  {_RATE} AS fraud_rate_percent
FROM valid GROUP BY 1"""
    sql["top_states"] = _with() + f"""
SELECT coalesce(nullif(trim(merchant_state), ''), 'UNKNOWN') AS merchant_state,
  {_N} AS transaction_count, {_TOTAL}, {_FRAUDS} AS fraudulent_transactions
FROM valid GROUP BY coalesce(nullif(trim(merchant_state), ''), 'UNKNOWN')
ORDER BY 3 DESC, 1 LIMIT 15"""
    sql["top_categories"] = _with() + f"""
SELECT merchant_category_code, {_N} AS transaction_count, {_TOTAL},
  {_FRAUDS} AS fraudulent_transactions, {_RATE} AS fraud_rate_percent
FROM valid GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
    sql["latest_transactions"] = _with(_MERCHANTS, _FACT) + f"""
SELECT transaction_key, {_STAMP} AS transaction_timestamp,
  CAST(amount AS DOUBLE) AS transaction_amount, transaction_method, is_fraud,
  transaction_error, f.merchant_category_code, merchant_city, merchant_state, calendar_year
FROM fact f JOIN dim_m m USING (merchant_key)
ORDER BY ts DESC, transaction_key DESC LIMIT 500"""

    for name in ("fraud_by_method", "fraud_by_year", "top_states", "top_categories"):
        sql[f"{name}_filtered"] = sql[name].replace("FROM valid GROUP", f"FROM valid WHERE {_SELECTED} GROUP")
    sql["latest_transactions_filtered"] = sql["latest_transactions"].replace(
        "ORDER BY ts", f"WHERE {_SELECTED} ORDER BY ts")
    sql["exported_sample"] = (
        "SELECT transaction_key, transaction_amount, transaction_method, merchant_city FROM ("
        + sql["latest_transactions"] + ") AS latest")

    # ---------------------------------------------------------------- measures
    sql["kpi_controls"] = _with(_DATES, _YEARS) + """,
before AS (
  SELECT sum(amount) AS pamount FROM sums
  WHERE full_date IN (SELECT CAST(full_date - INTERVAL 1 YEAR AS DATE) FROM dim_d)
),
now_ AS (SELECT sum(n) AS n, sum(amount) AS amount, sum(frauds) AS frauds,
  sum(errors) AS errors, sum(exposure) AS exposure FROM sums)
SELECT CAST(n AS BIGINT) AS transaction_count, CAST(amount AS DOUBLE) AS total_transaction_amount,
  CAST(amount AS DOUBLE) / CAST(n AS DOUBLE) AS average_transaction_amount,
  CAST(frauds AS BIGINT) AS fraud_transaction_count,
  CAST(frauds AS DOUBLE) / CAST(n AS DOUBLE) AS fraud_rate,
  CAST(exposure AS DOUBLE) AS fraud_exposure,
  CAST(exposure AS DOUBLE) / CAST(frauds AS DOUBLE) AS average_fraud_transaction_amount,
  CAST(errors AS BIGINT) AS error_transaction_count,
  CAST(errors AS DOUBLE) / CAST(n AS DOUBLE) AS error_rate,
  1 - CAST(errors AS DOUBLE) / CAST(n AS DOUBLE) AS error_free_rate,
  CAST(pamount AS DOUBLE) AS prior_year_transaction_amount,
  CAST(amount - pamount AS DOUBLE) / CAST(pamount AS DOUBLE) AS amount_yoy_growth
FROM now_, before"""
    chosen = f"year(full_date) IN {YEARS}"
    sql["kpi_controls_selected"] = sql["kpi_controls"].replace(
        "CAST(full_date - INTERVAL 1 YEAR AS DATE) FROM dim_d",
        f"CAST(full_date - INTERVAL 1 YEAR AS DATE) FROM dim_d WHERE {chosen}",
    ).replace("sum(exposure) AS exposure FROM sums)", f"sum(exposure) AS exposure FROM sums WHERE {chosen})")
    sql["yoy_by_year"] = _with(_DATES, _YEARS) + """
SELECT calendar_year, CAST(n AS BIGINT) AS transaction_count,
  CAST(pn AS BIGINT) AS prior_year_transaction_count,
  (n - pn) / pn AS transaction_count_yoy_growth, amount AS total_transaction_amount,
  pamount AS prior_year_transaction_amount, damount / pamount AS amount_yoy_growth
FROM both_years"""
    sql["rate_bps_by_year"] = _with(_DATES, _YEARS) + f"""
SELECT calendar_year, frauds / n AS fraud_rate, pfrauds / pn AS prior_year_fraud_rate,
  errors / n AS error_rate, perrors / pn AS prior_year_error_rate,
  exposure / amount AS fraud_exposure_rate, {_FRAUD_BPS} AS fraud_rate_change_bps,
  {_ERROR_BPS} AS error_rate_change_bps, {_direction(_FRAUD_BPS)} AS risk_direction
FROM both_years"""
    na = "coalesce({0}, 'n/a')".format
    risk = f"coalesce({_direction(_FRAUD_BPS)}, 'No prior year')"
    sql["executive_summary"] = _with(_DATES, _YEARS) + f"""
SELECT calendar_year, {risk} AS risk_direction,
  'Risk ' || {risk} || ' | Amount growth ' || {na(_percent('(amount - pamount)', 'pamount'))}
    || ' | Fraud rate ' || {na(_bps('frauds'))} || ' bps | Error rate '
    || {na(_bps('errors'))} || ' bps | Data through '
    || strftime(covered, '%Y-%m-%d') AS executive_decision_summary,
  'Risk ' || {risk} || ' | Fraud rate ' || {_percent('frauds', 'n')} || ' ('
    || {na(_bps('frauds'))} || ' bps) | Exposure $' || {na(_two('exposure'))}
    || ' | Error rate ' || {_percent('errors', 'n')} || ' (' || {na(_bps('errors'))}
    || ' bps)' AS risk_exceptions_brief
FROM both_years"""
    sql["portfolio_selected"] = _with() + f""",
one AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(amount) AS DOUBLE) AS amount,
    CAST(count(*) FILTER (is_fraud) AS DOUBLE) AS frauds,
    CAST(count(*) FILTER (has_error) AS DOUBLE) AS errors,
    CAST(sum(amount) FILTER (is_fraud) AS DOUBLE) AS exposure
  FROM valid WHERE {_SELECTED}
)
SELECT CAST(n AS BIGINT) AS transaction_count, amount AS total_transaction_amount,
  amount / n AS average_transaction_amount, CAST(frauds AS BIGINT) AS fraud_transaction_count,
  frauds / n AS fraud_rate, exposure AS fraud_exposure,
  exposure / frauds AS average_fraud_transaction_amount,
  CAST(errors AS BIGINT) AS error_transaction_count, errors / n AS error_rate,
  1 - errors / n AS error_free_rate, exposure / amount AS fraud_exposure_rate
FROM one"""
    sql["selected_date_range"] = _with() + """
SELECT strftime(min(ts), '%b %-d, %Y') || ' - ' || strftime(max(ts), '%b %-d, %Y')
  AS selected_date_range FROM valid"""
    sql["data_coverage"] = _with() + """
SELECT strftime(max(ts), '%Y-%m-%d') AS data_coverage_date FROM valid"""
    month = """strftime(ts, '%Y-%m') AS calendar_year_month,
  CAST(year(ts) * 100 + month(ts) AS BIGINT) AS calendar_year_month_sort"""
    sql["monthly_trend"] = _with() + f"""
SELECT {month}, {_N} AS transaction_count, CAST(sum(amount) AS DOUBLE)
  AS total_transaction_amount FROM valid GROUP BY 1, 2"""
    sql["fraud_error_trend"] = _with() + f"""
SELECT {month}, {_FRAUDS} AS fraud_transaction_count,
  CAST(count(*) FILTER (has_error) AS BIGINT) AS error_transaction_count
FROM valid GROUP BY 1, 2"""
    sql["method_mix"] = _with() + f"""
SELECT transaction_method, {_N} AS transaction_count,
  CAST(count(*) AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM valid) AS transaction_share
FROM valid GROUP BY 1"""
    sql["error_breakdown"] = _with() + f"""
SELECT transaction_error, {_N} AS error_transaction_count
FROM valid WHERE has_error GROUP BY 1"""
    sql["fraud_by_category"] = _with() + f"""
SELECT merchant_category_code, {_N} AS fraud_transaction_count,
  CAST(sum(amount) AS DOUBLE) AS fraud_exposure
FROM valid WHERE is_fraud GROUP BY 1"""
    merchants = _with(_MERCHANTS, _FACT, _BY_MERCHANT)
    top = "WHERE frauds > 0 ORDER BY exposure DESC, merchant_key LIMIT"
    sql["top_fraud_merchants"] = merchants + f"""
SELECT merchant_display_label, merchant_id_text, CAST(frauds AS BIGINT)
  AS fraud_transaction_count, CAST(exposure AS DOUBLE) AS fraud_exposure
FROM (SELECT * FROM by_merchant {top} 10) AS best JOIN dim_m USING (merchant_key)"""
    share = "CAST((SELECT sum(exposure) FROM ten) AS DOUBLE) / CAST(sum(exposure) AS DOUBLE)"
    rate = "CAST(sum(frauds) AS DOUBLE) / CAST(sum(n) AS DOUBLE)"
    sql["exposure_concentration"] = merchants + f""",
ten AS (SELECT * FROM by_merchant {top} 10)
SELECT CAST(count(*) FILTER (frauds > 0) AS BIGINT) AS fraudulent_merchant_count,
  CAST(sum(exposure) AS DOUBLE) AS fraud_exposure,
  CAST((SELECT sum(exposure) FROM ten) AS DOUBLE) AS top_10_fraud_exposure,
  {share} AS top_10_fraud_exposure_share, {rate} AS portfolio_fraud_rate,
  CAST(count(*) FILTER (frauds > 0) AS VARCHAR) || ' merchants with fraud | Top 10 hold '
    || {_percent('(SELECT sum(exposure) FROM ten)', 'sum(exposure)')} || ' of $' || {_two('sum(exposure)')}
    || ' exposure | Portfolio fraud rate ' || {_percent('sum(frauds)', 'sum(n)')} AS merchant_risk_summary
FROM by_merchant"""
    sql["merchant_risk"] = merchants + f""",
scored AS (
  SELECT merchant_key, n, frauds, CAST(frauds AS DOUBLE) / n AS fraud_rate, exposure,
    CAST(exposure AS DOUBLE) / (SELECT CAST(sum(exposure) AS DOUBLE) FROM by_merchant) AS share,
    CASE WHEN exposure IS NOT NULL
      THEN rank() OVER (ORDER BY exposure DESC NULLS LAST) END AS place
  FROM by_merchant
),
tiered AS (
  SELECT *, CASE least(3, CASE WHEN fraud_rate >= 0.5 THEN 3 WHEN fraud_rate >= 0.1 THEN 2
      WHEN fraud_rate > 0 THEN 1 ELSE 0 END
      + CASE WHEN coalesce(share, 0) >= 0.1 THEN 1 ELSE 0 END)
    WHEN 3 THEN 'Critical' WHEN 2 THEN 'High' WHEN 1 THEN 'Elevated' ELSE 'Low' END AS tier
  FROM scored
)
SELECT merchant_display_label, CAST(n AS BIGINT) AS transaction_count,
  CAST(frauds AS BIGINT) AS fraud_transaction_count, fraud_rate,
  CAST(exposure AS DOUBLE) AS fraud_exposure, share AS exposure_share,
  CAST(place AS BIGINT) AS exposure_rank, tier AS risk_tier,
  CASE WHEN frauds > 0 THEN tier || ' | Rank ' || CAST(place AS VARCHAR) || ' | Fraud rate '
    || {_percent('frauds', 'n')} || ' | Exposure share ' || {na(_percent('exposure', '(SELECT sum(exposure) FROM by_merchant)'))}
    ELSE 'No fraud recorded' END AS risk_insight
FROM tiered JOIN dim_m USING (merchant_key)"""
    sql["merchant_vs_portfolio"] = merchants + """
SELECT merchant_display_label, CAST(frauds AS DOUBLE) / n AS selected_merchant_fraud_rate,
  (SELECT CAST(count(*) FILTER (is_fraud) AS DOUBLE) / count(*) FROM valid)
    AS portfolio_fraud_rate
FROM by_merchant JOIN dim_m USING (merchant_key)"""
    sql["merchant_profile"] = _with(_MERCHANTS) + """
SELECT merchant_display_label, merchant_display_label || '  |  Source ID ' || merchant_id_text
  || '  |  ' || coalesce(merchant_city, 'ONLINE') || coalesce(', ' || merchant_state, '')
  || coalesce(' ' || merchant_zip_code, '') || '  |  Category '
  || CAST(merchant_category_code AS VARCHAR) AS selected_merchant_profile
FROM dim_m"""
    best = f"merchant_key IN (SELECT merchant_key FROM by_merchant {top} 1)"
    sql["one_merchant_vs_portfolio"] = sql["merchant_vs_portfolio"] + f" WHERE {best}"
    profile = sql["merchant_profile"].split("SELECT merchant_display_label, ")[-1]
    sql["one_merchant_profile"] = merchants + "SELECT " + profile + f" WHERE {best}"
    sql["merchant_profile_prompt"] = _with(_MERCHANTS) + """
SELECT CASE WHEN count(*) <> 1 THEN 'Drill through from Merchant Risk to select one merchant'
  END AS selected_merchant_profile FROM dim_m"""
    sql["evidence_ledger"] = merchants + f"""
SELECT merchant_display_label, transaction_key, strftime(ts, '%Y-%m-%d') AS full_date,
  {_STAMP} AS transaction_timestamp, CAST(amount AS DOUBLE) AS transaction_amount,
  transaction_method, transaction_error, is_fraud, has_error,
  CASE WHEN is_fraud THEN '#FDECEC' ELSE '#FFFFFF' END AS fraud_cell_color,
  CASE WHEN has_error THEN '#FFF4E5' ELSE '#FFFFFF' END AS error_cell_color
FROM fact JOIN dim_m USING (merchant_key)
WHERE merchant_key = (SELECT merchant_key FROM by_merchant {top} 1)"""

    # --------------------------------------------------------------- profiling
    landed = _with() + """,
landed AS (
  SELECT user_id AS "User", card_id AS "Card", CAST(year(l_shipdate) AS BIGINT) AS "Year",
    CAST(month(l_shipdate) AS BIGINT) AS "Month", CAST(day(l_shipdate) AS BIGINT) AS "Day",
    CASE WHEN l_partkey % 101 = 0 THEN '99:99' ELSE CAST(l_orderkey % 24 AS VARCHAR)
      || ':' || CAST(l_partkey % 60 AS VARCHAR) END AS "Time",
    CASE WHEN l_partkey % 103 = 0 THEN 'UNKNOWN'
      ELSE '$' || format('{:,.2f}', price) END AS "Amount",
    CASE l_linenumber % 4 WHEN 0 THEN 'Swipe Transaction' WHEN 1 THEN ' Chip Transaction'
      WHEN 2 THEN 'Online Transaction' ELSE 'Contactless' END AS "Use Chip",
    merchant_id AS "Merchant Name", ' ' || n_name || chr(9) AS "Merchant City",
    ' ' || merchant_state || ' ' AS "Merchant State",
    CAST(merchant_zip_code AS DOUBLE) AS "Zip", merchant_category_code AS "MCC",
    CASE WHEN l_partkey % 7 = 0 THEN '' WHEN l_returnflag = 'A' THEN ' Bad PIN '
      WHEN l_returnflag = 'R' THEN 'Technical Glitch' END AS "Errors?",
    CASE WHEN is_fraud THEN 'Yes' WHEN NOT is_fraud THEN 'No' ELSE 'Maybe' END AS "Is Fraud?"
  FROM clean
)
"""
    names = (
        "User", "Card", "Year", "Month", "Day", "Time", "Amount", "Use Chip", "Merchant Name",
        "Merchant City", "Merchant State", "Zip", "MCC", "Errors?", "Is Fraud?",
    )
    bigint = {"User", "Card", "Year", "Month", "Day", "Merchant Name", "MCC"}
    types = {name: "bigint" if name in bigint else "string" for name in names} | {"Zip": "double"}
    sql["source_shape"] = " UNION ALL ".join(
        f"SELECT (SELECT count(*) FROM lineitem) AS rows, CAST({i} AS BIGINT) AS position, "
        f"'{name}' AS column_name, '{types[name]}' AS data_type"
        for i, name in enumerate(names, 1)
    )
    sql["missing_profile"] = landed + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(count(*) - count(\"{name}\") AS BIGINT) "
        f"AS missing_count, "
        + _quotient(f'(100 * (count(*) - count("{name}")))', 'count(*)')
        + " AS missing_percentage FROM landed"
        for name in names
    )
    sql["distinct_profile"] = landed + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST(count(DISTINCT \"{name}\") AS BIGINT) "
        "AS distinct_count FROM landed"
        for name in names
    )
    sql["value_counts"] = landed + " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{name}' AS column_name, "{name}" AS value,
  CAST(count(*) AS BIGINT) AS value_count,
  row_number() OVER (ORDER BY count(*) DESC, "{name}" NULLS LAST) AS position
FROM landed GROUP BY "{name}") AS counted WHERE position <= 20"""
        for name in ("Use Chip", "Merchant State", "Errors?", "Is Fraud?")
    )
    sql["column_summary"] = landed + " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, (SELECT CAST(count("{name}") AS BIGINT) FROM landed)
  AS count, (SELECT CAST(count(DISTINCT "{name}") AS BIGINT) FROM landed) AS "unique",
  top, freq FROM (
    SELECT CAST("{name}" AS VARCHAR) AS top, CAST(count(*) AS BIGINT) AS freq FROM landed
    WHERE "{name}" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1) AS best"""
        for name in names
    )
    every = ", ".join(f'"{name}"' for name in names)
    sql["duplicate_rows"] = landed + f"""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM landed GROUP BY {every}) AS groups"""
    sql["numeric_summary"] = landed + " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CAST(count("{name}") AS BIGINT) AS count,
  CAST(sum(CAST("{name}" AS DECIMAL(38, 6))) AS DOUBLE) / count("{name}") AS mean,
  {_deviation(name, types[name])} AS std,
  CAST(min("{name}") AS DOUBLE) AS min, quantile_cont(CAST("{name}" AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST("{name}" AS DOUBLE), 0.5) AS p50,
  quantile_cont(CAST("{name}" AS DOUBLE), 0.75) AS p75, CAST(max("{name}") AS DOUBLE) AS max
FROM landed"""
        for name in names if types[name] != "string"
    )
    sql["summary"] = (
        f"SELECT o.*, s.mean, s.std, s.min, s.p25, s.p50, s.p75, s.max FROM ({sql['column_summary']}) AS o "
        f"LEFT JOIN ({sql['numeric_summary']}) AS s ON s.column_name = o.column_name")

    # ------------------------------------------------------- files and ingest
    fitting = {"bigint": "int64", "double": "float64", "string": "str"}
    sql["contract_report"] = landed + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{fitting[types[name]]}' AS expected_type, "
        f"TRUE AS in_every_file, CAST(count(nullif(CAST(\"{name}\" AS VARCHAR), '')) AS BIGINT) AS values_present, "
        f"CAST(count(nullif(CAST(\"{name}\" AS VARCHAR), '')) AS BIGINT) AS values_fitting "
        "FROM landed"
        for name in names
    )
    sql["landing_fingerprints"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS month,
  CAST(sum(length(o_orderkey || ',' || o_orderstatus) + 1) AS BIGINT) AS size,
  sha256(string_agg(o_orderkey || ',' || o_orderstatus || chr(10), '' ORDER BY o_orderkey)) AS sha256,
  arg_min(o_orderkey || ',' || o_orderstatus, o_orderkey) AS first_line, TRUE AS is_utf8
FROM orders GROUP BY 1"""
    sql["ingest_outcomes"] = """
WITH card AS (SELECT count(*) AS n FROM lineitem)
SELECT label AS "case", status,
  CAST(CASE WHEN status = 'SUCCESS' THEN n + more ELSE 0 END AS BIGINT) AS rows_written, failed > 0 AS has_failed,
  CAST(failed AS BIGINT) AS files_failed
FROM card CROSS JOIN (VALUES ('good', 'SUCCESS', 0, 0), ('again', 'SKIPPED', 0, 0), ('legacy', 'SKIPPED', 0, 0),
  ('bad_header', 'SUCCESS', 0, 1), ('bad_type', 'SUCCESS', 0, 1), ('surplus_field', 'SUCCESS', 0, 1),
  ('bad_bytes', 'SUCCESS', 0, 1), ('unclosed_quote', 'SUCCESS', 0, 1), ('short_record', 'SUCCESS', 1, 0),
  ('header_only', 'SUCCESS', 0, 1), ('copies', 'SUCCESS', 0, 0)) AS cases(label, status, more, failed)"""
    sql["ledger_upgrade"] = """
SELECT o_orderstatus = 'F' AS succeeded, o_orderkey % 2 = 0 AS same_size,
  o_orderstatus = 'F' AND o_orderkey % 2 = 0 AS already_processed, CAST(count(*) AS BIGINT) AS files,
  CAST(count(*) AS BIGINT) AS files_without_hash
FROM orders GROUP BY ALL"""
    sql["silver_audit"] = _with() + f"""
SELECT '2026-01-02 00:00:00' AS processed_at, {_N} AS rows FROM valid"""
    sql["kpi_scalars"] = _with() + f"""
SELECT unnest(['average_transaction_amount', 'fraud_transaction_rate_percent', 'fraudulent_transactions',
    'total_transaction_amount', 'total_transactions']) AS name,
  unnest([{_AVERAGE.split(' AS average')[0]}, {_RATE.split(' AS fraud')[0]}, CAST({_FRAUDS} AS DOUBLE),
    {_TOTAL.split(' AS total')[0]}, CAST(count(*) AS DOUBLE)]) AS value
FROM valid"""
    sql["layer_builds"] = everything + """,
sizes AS (SELECT (SELECT count(*) FROM dim_m) AS m, (SELECT count(*) FROM dim_d) AS d, (SELECT count(*) FROM fact) AS t)
SELECT layer, 'SUCCESS' AS status, CAST(m AS BIGINT) AS merchant_rows, CAST(d AS BIGINT) AS date_rows,
  CAST(t AS BIGINT) AS transaction_rows, views, TRUE AS is_valid
FROM sizes CROSS JOIN (VALUES ('gold', ''), ('views', 'dim_date,dim_merchant,fact_transaction,'
  || 'vw_annual_transaction_summary,vw_platform_kpis,vw_transaction_method_summary'), ('serving', '')) AS layers(layer, views)"""
    sql["model_faults"] = everything + """,
facts AS (
  SELECT 'orphans' AS fault, transaction_key AS k, CASE WHEN is_fraud THEN -merchant_key ELSE merchant_key END AS m, date_key AS d FROM fact
  UNION ALL SELECT 'repeated', transaction_key, merchant_key, date_key FROM fact
  UNION ALL SELECT 'repeated', transaction_key, merchant_key, date_key FROM fact WHERE has_error
  UNION ALL SELECT 'missing', CASE WHEN NOT has_error THEN transaction_key END, CASE WHEN NOT is_fraud THEN merchant_key END, date_key FROM fact
  UNION ALL SELECT 'lost days', transaction_key, merchant_key, date_key FROM fact
)
SELECT fault, (SELECT CAST(count(*) AS BIGINT) FROM dim_m) AS merchant_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM dim_d WHERE fault <> 'lost days' OR NOT is_weekend) AS date_rows,
  CAST(count(*) AS BIGINT) AS actual_fact_rows,
  CAST(count(*) - count(DISTINCT k) - CAST(count(k) < count(*) AS INTEGER) AS BIGINT) AS duplicate_transaction_keys,
  CAST(count(*) - count(k) AS BIGINT) AS missing_transaction_keys,
  CAST(count(*) FILTER (m IS NULL OR m < 0) AS BIGINT) AS invalid_merchant_foreign_keys,
  CAST(count(*) FILTER (fault = 'lost days' AND d IN (SELECT date_key FROM dim_d WHERE is_weekend)) AS BIGINT) AS invalid_date_foreign_keys,
  FALSE AS is_valid
FROM facts GROUP BY fault"""
    sql["staged_job"] = _with() + """
SELECT run_id, status, recovery_succeeded, published_version, CAST((SELECT count(*) FROM valid) AS BIGINT) AS published_rows
FROM (VALUES ('1 good', 'SUCCESS', NULL, '1 good'), ('2 gate', 'FAILED', TRUE, '1 good'),
  ('3 lost driver', 'FAILED', TRUE, '1 good'), ('4 good', 'SUCCESS', NULL, '4 good'))
  AS runs(run_id, status, recovery_succeeded, published_version)"""
    sql["publication_rollback"] = _with() + """,
sizes AS (SELECT count(*) AS n_all, count(*) FILTER (is_fraud) AS n_fraud FROM valid)
SELECT step, version, CAST(CASE WHEN version = 'third' THEN n_fraud ELSE n_all END AS BIGINT) AS rows, problem
FROM sizes CROSS JOIN (VALUES ('publish', 'first', NULL), ('same name again', 'first', 'ValueError'),
  ('invalid model', 'first', 'ValueError'), ('next', 'third', NULL), ('rollback', 'first', NULL))
  AS steps(step, version, problem)"""
    sql["ingest_idempotency"] = """
SELECT CAST(run AS BIGINT) AS run, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS files_failed,
  CASE WHEN run = 1 THEN n ELSE 0 END AS rows_read,
  CASE WHEN run = 1 THEN n ELSE 0 END AS rows_written, n AS bronze_total_rows,
  run = 1 AS all_processed, run = 2 AS all_skipped
FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem) AS total,
  (VALUES (1), (2)) AS runs(run)"""
    sql["file_route_reasons"] = _with() + f"""
SELECT reason AS quarantine_reason, {_N} AS rows,
  CAST(sum(amount) AS DOUBLE) AS total_transaction_amount, {_N} AS positions
FROM judged GROUP BY reason"""
    sql["domain_ingest"] = """
SELECT 'SUCCESS' AS status, CAST(2 AS BIGINT) AS domains_discovered,
  CAST(2 AS BIGINT) AS domains_succeeded, CAST(0 AS BIGINT) AS domains_failed,
  CAST(0 AS BIGINT) AS files_failed, CAST(2 * count(*) AS BIGINT) AS rows_read,
  CAST(2 * count(*) AS BIGINT) AS rows_written
FROM customer"""
    sql["domain_bronze_open"] = """
SELECT domain, CAST(count(*) AS BIGINT) AS rows, open_columns
FROM customer CROSS JOIN (VALUES
  ('cards', 'User,CARD INDEX,Card Brand,Card Type,Expires,Has Chip,Cards Issued,'
    || 'Credit Limit,Acct Open Date,Year PIN last Changed,Card on Dark Web'),
  ('users', 'Current Age,Retirement Age,Birth Year,Birth Month,Gender,City,State,Zipcode,'
    || 'Per Capita Income - Zipcode,Yearly Income - Person,Total Debt,FICO Score,'
    || 'Num Credit Cards')) AS open_part(domain, open_columns)
GROUP BY domain, open_columns"""

    # -------------------------------------------------- publication and runs
    sql["publication_check"] = everything + """
SELECT table_name, CAST(n AS BIGINT) AS published_rows, CAST(n AS BIGINT) AS rows_in_listed_files, TRUE AS sizes_agree,
  TRUE AS hashes_agree, CAST(changed AS BIGINT) AS changed_files, TRUE AS intact_before, FALSE AS intact_after
FROM (
  SELECT 'date' AS table_name, count(*) AS n, 0 AS changed FROM dim_d
  UNION ALL SELECT 'merchant', count(*), 1 FROM dim_m UNION ALL SELECT 'transaction', count(*), 0 FROM valid) AS sizes"""
    sql["run_freshness"] = """
WITH clock AS (
  SELECT max(ts) AS now_, date_trunc('day', max(ts)) AS today FROM events
),
due AS (
  SELECT now_, CASE WHEN now_ >= today + INTERVAL 6 HOUR THEN today + INTERVAL 5 HOUR
    ELSE today - INTERVAL 19 HOUR END AS due_ FROM clock
),
last_run AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events
),
judged AS (
  SELECT CAST(user_id AS VARCHAR) AS pipeline_name,
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    epoch(date_trunc('second', now_)) - epoch(date_trunc('second', ts)) AS seconds,
    ts >= due_ AS on_time
  FROM last_run CROSS JOIN due WHERE place = 1
)
SELECT pipeline_name, run_id, status,
  """ + _quotient("CAST(seconds AS BIGINT)", "3600") + """ AS age_hours,
  seconds <= 26 * 3600 AS is_fresh, on_time AS meets_schedule, TRUE AS tables_present,
  status = 'SUCCESS' AND seconds <= 26 * 3600 AND on_time AS is_healthy
FROM judged"""
    return sql
