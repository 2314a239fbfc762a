"""The layers again, as plain SQL common table expressions for DuckDB.

Written from the definitions, not from the Spark code, so that a mistake on either side shows
as a difference. ``with_views`` puts the expressions a statement uses in front of it.
"""

from __future__ import annotations

import re


def tot(x: str) -> str:
    """Exact sum as double."""
    return f"CAST(CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS VARCHAR) AS DOUBLE)"


def avg(x: str) -> str:
    return f"({tot(x)} / NULLIF(COUNT({x}), 0))"


def rnd(x: str, n: int = 2) -> str:
    """Round half up on the shortest decimal text of a double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def fl(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def yn(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def pick(index: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def addon(m: int) -> str:
    return f"CASE WHEN c_nationkey % 4 = 2 THEN 'No internet service' ELSE {yn(f'c_custkey % {m} = 0')} END"


METHODS = ["Electronic check", "Mailed check", "Bank transfer", "Credit card"]
CUSTOMER_COLUMNS = (
    "customer_id, gender, senior_citizen, has_partner, has_dependents, tenure_months, phone_service, "
    "multiple_lines, internet_service, online_security, online_backup, device_protection, tech_support, "
    "streaming_tv, streaming_movies, contract_type, paperless_billing, payment_method, monthly_charges, "
    "total_charges, churn, churn_label"
)


def bucket(text: str) -> str:
    """sha2 bucket 0..99 of a text."""
    return f"(CAST('0x' || substr(sha256({text}), 1, 8) AS BIGINT) % 100)"


def health(rate, latency, loss, speed) -> str:
    return (
        f"(0.40 * (100 * (1 - {rate})) + 0.25 * (100 * (1 - LEAST({latency} / 200, 1.0)))"
        f" + 0.20 * (100 * (1 - LEAST({loss} / 10, 1.0))) + 0.15 * (100 * LEAST({speed} / 100, 1.0)))"
    )


PERFORMANCE = f"""
  COUNT(DISTINCT event_id) AS network_events,
  {isum("CASE WHEN event_type <> 'normal' THEN 1 ELSE 0 END")} AS network_incidents,
  COUNT(DISTINCT CASE WHEN event_type <> 'normal' THEN customer_id END) AS affected_customers,
  {rnd(avg("latency_ms"))} AS average_latency_ms,
  {rnd(avg("packet_loss_pct"))} AS average_packet_loss_pct,
  {rnd(avg("download_speed_mbps"))} AS average_download_speed_mbps,
  {isum("outage_minutes")} AS total_outage_minutes"""

FILLED = [
    "invoice_count", "total_billed_amount", "average_invoice_amount", "total_usage_charges", "total_discounts",
    "paid_invoice_count", "late_invoice_count", "unpaid_invoice_count", "payment_reliability_score",
    "complaint_count", "average_resolution_hours", "average_satisfaction_score", "critical_complaint_count",
    "escalated_complaint_count", "unresolved_complaint_count", "network_event_count", "average_latency_ms",
    "average_packet_loss_pct", "average_download_speed_mbps", "total_outage_minutes", "outage_event_count",
    "degraded_event_count", "distinct_tower_count", "network_quality_score",
]

VIEWS: dict[str, str] = {}

VIEWS["customers_raw"] = f"""
SELECT 'C-' || c_custkey || CASE WHEN c_custkey % 10 = 0 THEN ' ' ELSE '' END AS customerID,
  CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  {fl("c_custkey % 7 = 0")} AS SeniorCitizen,
  {yn("c_custkey % 3 = 0")} AS Partner, {yn("c_custkey % 5 = 0")} AS Dependents,
  CAST(c_custkey % 73 AS BIGINT) AS tenure,
  {yn("c_custkey % 9 <> 0")} AS PhoneService, {yn("c_custkey % 4 = 1")} AS MultipleLines,
  CASE c_nationkey % 4 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' WHEN 2 THEN ' No ' END AS InternetService,
  {addon(2)} AS OnlineSecurity, {addon(3)} AS OnlineBackup, {addon(5)} AS DeviceProtection,
  {addon(7)} AS TechSupport, {addon(6)} AS StreamingTV, {addon(8)} AS StreamingMovies,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'One year' WHEN 'HOUSEHOLD' THEN 'Two year' ELSE 'Month-to-month' END AS Contract,
  {yn("c_custkey % 6 < 4")} AS PaperlessBilling,
  {pick("c_custkey % 4", METHODS)} AS PaymentMethod,
  floor(round(c_acctbal * 100) / 80) / 100 AS MonthlyCharges,
  CASE WHEN c_custkey % 11 <> 0 THEN CAST(floor(round(c_acctbal * 100) / 80) AS BIGINT) * (c_custkey % 73) / 100 END AS TotalCharges,
  CASE WHEN c_custkey % 97 <> 0 THEN {yn("round(c_acctbal * 100) % 4 = 0")} END AS Churn
FROM customer"""

VIEWS["billing_raw"] = f"""
SELECT 'INV-' || l_orderkey || '-' || l_linenumber AS invoice_id, 'C-' || o_custkey AS customerID,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS billing_month, l_quantity AS MonthlyCharges,
  (CASE WHEN l_partkey % 100 = 0 THEN -1 ELSE 1 END) * round(l_extendedprice * 100) / 100 AS usage_charges,
  CASE WHEN l_partkey % 101 <> 0 THEN floor(round(l_extendedprice * 100) * round(l_discount * 100) / 100) / 100 END AS discount_amount,
  floor(round(l_extendedprice * 100) * round(l_tax * 100) / 100) / 100 AS tax_amount,
  (round(l_quantity * 100) + (CASE WHEN l_partkey % 100 = 0 THEN -1 ELSE 1 END) * round(l_extendedprice * 100)
   - COALESCE(CASE WHEN l_partkey % 101 <> 0 THEN floor(round(l_extendedprice * 100) * round(l_discount * 100) / 100) END, 0)
   + floor(round(l_extendedprice * 100) * round(l_tax * 100) / 100)) / 100 AS total_amount,
  {pick("l_suppkey % 4", METHODS)} AS PaymentMethod,
  CASE l_returnflag WHEN 'N' THEN 'Paid' WHEN 'A' THEN ' Late ' WHEN 'R' THEN 'Unpaid' END AS payment_status,
  CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 34 + 1 AS INTEGER) END AS payment_date,
  CAST(l_shipdate AS DATE) AS version
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

VIEWS["complaints_raw"] = f"""
SELECT 'CMP-' || o_orderkey AS complaint_id, 'C-' || o_custkey AS customerID, o_orderdate AS opened_at,
  {pick("o_orderkey % 5", ["Network Quality", "Billing", "Internet Speed", "Service Outage", "Customer Service"])} AS category,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' END AS priority,
  CASE o_orderstatus WHEN 'O' THEN 'In Progress' WHEN 'P' THEN 'Escalated'
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Closed' ELSE 'Resolved' END END AS status,
  {pick("o_orderkey % 4", ["Call Center", "Mobile App", "Website", "Branch"])} AS channel,
  CAST(floor(o_totalprice) AS BIGINT) % 97 * 1.0::DOUBLE AS resolution_hours,
  CAST(o_orderkey % 6 AS BIGINT) AS satisfaction_score
FROM orders"""

VIEWS["network_raw"] = """
SELECT 'NET-' || event_id AS event_id, 'C-' || user_id AS customerID, ts AS event_timestamp,
  CASE event_type WHEN 'view' THEN 'Normal' WHEN 'click' THEN 'High Latency' WHEN 'signup' THEN 'Packet Loss'
    WHEN 'purchase' THEN 'Service Degradation' WHEN 'error' THEN 'Outage' END AS event_type,
  CASE r_name WHEN 'AFRICA' THEN 'Cairo' WHEN 'AMERICA' THEN 'Giza' WHEN 'ASIA' THEN 'Alexandria'
    WHEN 'EUROPE' THEN 'Delta' WHEN 'MIDDLE EAST' THEN 'Upper Egypt' END AS region,
  'TOWER-' || k AS tower_id, value AS latency_ms, k % 41 / 10.0::DOUBLE AS packet_loss_pct,
  (12000 - round(value * 100)) / 100 AS download_speed_mbps,
  CAST(CASE WHEN event_type = 'error' THEN k ELSE 0 END AS BIGINT) AS outage_minutes
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
LEFT JOIN customer ON user_id = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""

VIEWS["customers"] = """
SELECT trim(customerID) AS customer_id, lower(trim(gender)) AS gender, SeniorCitizen AS senior_citizen,
  lower(trim(Partner)) AS has_partner, lower(trim(Dependents)) AS has_dependents, tenure AS tenure_months,
  lower(trim(PhoneService)) AS phone_service, trim(MultipleLines) AS multiple_lines,
  trim(InternetService) AS internet_service, OnlineSecurity AS online_security, OnlineBackup AS online_backup,
  DeviceProtection AS device_protection, TechSupport AS tech_support, StreamingTV AS streaming_tv,
  StreamingMovies AS streaming_movies, Contract AS contract_type, lower(PaperlessBilling) AS paperless_billing,
  PaymentMethod AS payment_method, MonthlyCharges AS monthly_charges,
  COALESCE(TotalCharges, MonthlyCharges * tenure) AS total_charges, Churn AS churn,
  CAST(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS BIGINT) AS churn_label
FROM customers_raw"""

VIEWS["billing_latest"] = """
SELECT invoice_id, customerID AS customer_id, billing_month, MonthlyCharges AS monthly_charges, usage_charges,
  discount_amount, tax_amount, total_amount, PaymentMethod AS payment_method,
  lower(trim(payment_status)) AS payment_status, payment_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_id ORDER BY version DESC, customerID ASC NULLS FIRST,
    billing_month ASC NULLS FIRST, MonthlyCharges ASC NULLS FIRST, usage_charges ASC NULLS FIRST,
    discount_amount ASC NULLS FIRST, tax_amount ASC NULLS FIRST, total_amount ASC NULLS FIRST,
    PaymentMethod ASC NULLS FIRST, payment_status ASC NULLS FIRST, payment_date ASC NULLS FIRST) AS rn
  FROM billing_raw) WHERE rn = 1"""

VIEWS["billing"] = f"""
SELECT *, {fl("payment_status = 'paid'")} AS is_paid, {fl("payment_status = 'late'")} AS is_late,
  {fl("payment_status = 'unpaid'")} AS is_unpaid
FROM billing_latest
WHERE monthly_charges >= 0 AND usage_charges >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND total_amount >= 0"""

VIEWS["complaint_rows"] = """
SELECT complaint_id, customerID AS customer_id, opened_at, lower(category) AS complaint_category,
  lower(priority) AS priority, lower(status) AS complaint_status, lower(channel) AS complaint_channel,
  resolution_hours, satisfaction_score FROM complaints_raw"""

VIEWS["complaints"] = f"""
SELECT *, {fl("priority = 'critical'")} AS is_critical, {fl("complaint_status = 'escalated'")} AS is_escalated,
  {fl("complaint_status IN ('in progress', 'escalated')")} AS is_unresolved
FROM complaint_rows WHERE resolution_hours >= 0 AND satisfaction_score BETWEEN 1 AND 5"""

VIEWS["network_rows"] = """
SELECT event_id, customerID AS customer_id, event_timestamp, lower(event_type) AS event_type, region, tower_id,
  latency_ms, packet_loss_pct, download_speed_mbps, outage_minutes FROM network_raw"""

VIEWS["network"] = f"""
SELECT *, {fl("event_type = 'outage'")} AS is_outage,
  {fl("event_type IN ('high latency', 'packet loss', 'service degradation', 'outage')")} AS is_degraded
FROM network_rows
WHERE latency_ms >= 0 AND packet_loss_pct BETWEEN 0 AND 100 AND download_speed_mbps >= 0 AND outage_minutes >= 0"""

VIEWS["billing_summary"] = f"""
SELECT *, {rnd("CAST(paid_invoice_count AS DOUBLE) / invoice_count", 4)} AS payment_reliability_score FROM (
SELECT customer_id, COUNT(DISTINCT invoice_id) AS invoice_count,
  {rnd(tot("total_amount"))} AS total_billed_amount, {rnd(avg("total_amount"))} AS average_invoice_amount,
  {rnd(tot("usage_charges"))} AS total_usage_charges, {rnd(tot("discount_amount"))} AS total_discounts,
  {isum("is_paid")} AS paid_invoice_count, {isum("is_late")} AS late_invoice_count,
  {isum("is_unpaid")} AS unpaid_invoice_count, MAX(billing_month) AS latest_billing_month
FROM billing GROUP BY customer_id)"""

VIEWS["complaints_summary"] = f"""
SELECT customer_id, COUNT(DISTINCT complaint_id) AS complaint_count,
  {rnd(avg("resolution_hours"))} AS average_resolution_hours,
  {rnd(avg("satisfaction_score"))} AS average_satisfaction_score,
  {isum("is_critical")} AS critical_complaint_count, {isum("is_escalated")} AS escalated_complaint_count,
  {isum("is_unresolved")} AS unresolved_complaint_count, MAX(opened_at) AS latest_complaint_at
FROM complaints GROUP BY customer_id"""

VIEWS["network_summary"] = f"""
SELECT *, {rnd("GREATEST(0.0, 100.0 - average_latency_ms * 0.10 - average_packet_loss_pct * 1.50 - outage_event_count * CAST(2.0 AS DOUBLE))")} AS network_quality_score FROM (
SELECT customer_id, COUNT(DISTINCT event_id) AS network_event_count,
  {rnd(avg("latency_ms"))} AS average_latency_ms, {rnd(avg("packet_loss_pct"))} AS average_packet_loss_pct,
  {rnd(avg("download_speed_mbps"))} AS average_download_speed_mbps,
  {isum("outage_minutes")} AS total_outage_minutes, {isum("is_outage")} AS outage_event_count,
  {isum("is_degraded")} AS degraded_event_count, COUNT(DISTINCT tower_id) AS distinct_tower_count,
  MAX(event_timestamp) AS latest_network_event_at
FROM network GROUP BY customer_id)"""

VIEWS["customer_360"] = f"""
SELECT *, late_invoice_count + unpaid_invoice_count AS payment_issue_count,
  complaint_count + critical_complaint_count * 2 + escalated_complaint_count * 2 + unresolved_complaint_count AS complaint_severity_score,
  CASE WHEN network_event_count > 0 THEN {rnd("CAST(degraded_event_count AS DOUBLE) / NULLIF(network_event_count, 0)", 4)} ELSE 0.0 END AS network_issue_rate,
  CASE WHEN churn_label = 1 THEN monthly_charges ELSE 0.0 END AS revenue_at_risk
FROM (SELECT {", ".join("c." + x.strip() for x in CUSTOMER_COLUMNS.split(","))},
  {fl("invoice_count IS NOT NULL")} AS has_billing_history, {fl("complaint_count IS NOT NULL")} AS has_complaints,
  {fl("network_event_count IS NOT NULL")} AS has_network_events, latest_billing_month, latest_complaint_at,
  latest_network_event_at, {", ".join(f"COALESCE({c}, 0) AS {c}" for c in FILLED)}
FROM customers c LEFT JOIN billing_summary b ON c.customer_id = b.customer_id
LEFT JOIN complaints_summary s ON c.customer_id = s.customer_id
LEFT JOIN network_summary n ON c.customer_id = n.customer_id)"""

VIEWS["analytics"] = """
SELECT *, CASE WHEN risk_category IN ('High', 'Critical') THEN monthly_charges ELSE 0.0 END AS business_risk_revenue
FROM (SELECT *, CASE WHEN risk_score >= 70 THEN 'Critical' WHEN risk_score >= 50 THEN 'High' WHEN risk_score >= 30 THEN 'Medium' ELSE 'Low' END AS risk_category,
  CASE WHEN monthly_charges >= 80 THEN 'High Value' WHEN monthly_charges >= 40 THEN 'Medium Value' ELSE 'Low Value' END AS customer_value_segment,
  CASE WHEN churn_label = 1 THEN monthly_charges ELSE 0.0 END AS actual_churn_revenue,
  CASE WHEN unpaid_invoice_count > 0 THEN 'Payment support and retention offer'
    WHEN unresolved_complaint_count > 0 THEN 'Resolve open complaints immediately'
    WHEN network_quality_score < 60 THEN 'Network investigation and service credit'
    WHEN lower(contract_type) = 'month-to-month' THEN 'Offer long-term contract discount'
    ELSE 'Standard engagement' END AS recommended_action
FROM (SELECT *, LEAST(CAST(100.0 AS DOUBLE),
    CAST(CASE WHEN lower(contract_type) = 'month-to-month' THEN 20 ELSE 5 END AS DOUBLE)
    + CAST(CASE WHEN tenure_months <= 12 THEN 15 WHEN tenure_months <= 24 THEN 10 ELSE 3 END AS DOUBLE)
    + LEAST(payment_issue_count * CAST(8 AS DOUBLE), 20) + LEAST(complaint_severity_score * CAST(3 AS DOUBLE), 20)
    + CASE WHEN has_network_events = 1 THEN LEAST((100.0 - network_quality_score) * 0.25, CAST(25 AS DOUBLE)) ELSE 0 END) AS risk_score
  FROM customer_360))"""

VIEWS["dim_customer"] = f"""
SELECT {CUSTOMER_COLUMNS.replace("internet_service", "CASE WHEN lower(trim(internet_service)) IN ('no', 'none', 'no internet service') THEN 'No Internet Service' WHEN internet_service IS NULL THEN 'Unknown' ELSE internet_service END AS internet_service")},
  CASE WHEN tenure_months <= 12 THEN '0-12 Months' WHEN tenure_months <= 24 THEN '13-24 Months' WHEN tenure_months <= 48 THEN '25-48 Months' ELSE '49+ Months' END AS tenure_segment,
  CASE WHEN monthly_charges < 40 THEN 'Low Value' WHEN monthly_charges < 80 THEN 'Medium Value' ELSE 'High Value' END AS monthly_charge_segment,
  CASE WHEN churn_label = 1 THEN 'Churned' ELSE 'Active' END AS customer_status,
  CAST(CASE contract_type WHEN 'Month-to-month' THEN 1 WHEN 'One year' THEN 2 WHEN 'Two year' THEN 3 ELSE 99 END AS BIGINT) AS contract_type_sort
FROM customers"""

VIEWS["predictions"] = f"""
SELECT customer_id, churn_label AS actual_churn_label, {fl("risk_score / 100 >= 0.5")} AS predicted_churn_label,
  {rnd("risk_score / 100", 4)} AS churn_probability,
  CASE WHEN risk_score / 100 <= 0.30 THEN 'Low' WHEN risk_score / 100 <= 0.50 THEN 'Medium' WHEN risk_score / 100 <= 0.70 THEN 'High' ELSE 'Critical' END AS risk_category
FROM analytics"""

VIEWS["outcomes"] = """
SELECT *, CASE WHEN actual_churn_label = 1 AND predicted_churn_label = 1 THEN 'True Positive'
  WHEN actual_churn_label = 0 AND predicted_churn_label = 0 THEN 'True Negative'
  WHEN actual_churn_label = 0 AND predicted_churn_label = 1 THEN 'False Positive'
  WHEN actual_churn_label = 1 AND predicted_churn_label = 0 THEN 'False Negative' ELSE 'Unknown' END AS prediction_outcome
FROM predictions"""

VIEWS["retention"] = """
SELECT a.customer_id, contract_type, internet_service, payment_method, tenure_months, monthly_charges, total_charges,
  payment_issue_count, complaint_count, unresolved_complaint_count, average_satisfaction_score, average_latency_ms,
  average_packet_loss_pct, total_outage_minutes, network_quality_score, predicted_churn_label AS predicted_churn,
  churn_probability, p.risk_category AS ml_risk_category, recommended_action,
  CASE WHEN predicted_churn_label = 1 THEN monthly_charges ELSE 0.0 END AS predicted_revenue_at_risk,
  CASE WHEN churn_probability >= 0.70 AND monthly_charges >= 80 THEN 'P1 - Immediate'
    WHEN churn_probability >= 0.70 THEN 'P2 - Urgent' WHEN churn_probability >= 0.50 THEN 'P3 - Monitor'
    ELSE 'P4 - Standard' END AS retention_priority
FROM analytics a JOIN predictions p ON a.customer_id = p.customer_id"""

VIEWS["cabinets"] = f"""
SELECT n.*, technology AS access_technology,
  'CAB-' || CASE WHEN technology = 'DSL' THEN 'DSL' ELSE 'FBR' END || '-' ||
  CASE region WHEN 'Cairo' THEN 'CAI' WHEN 'Giza' THEN 'GIZ' WHEN 'Alexandria' THEN 'ALX' WHEN 'Delta' THEN 'DLT' WHEN 'Upper Egypt' THEN 'UPR' ELSE 'UNK' END
  || '-' || lpad(CAST({bucket("n.customer_id || '|' || region || '|' || technology")} + 1 AS VARCHAR), 3, '0') AS cabinet_id,
  CASE WHEN technology = 'DSL' THEN 'DSL Cabinet' ELSE 'Fiber Cabinet' END AS cabinet_type
FROM network n JOIN (SELECT customer_id, CASE WHEN lower(trim(internet_service)) = 'dsl' THEN 'DSL'
  WHEN lower(trim(internet_service)) IN ('fiber optic', 'fiber', 'fiber-optic') THEN 'Fiber Optic' END AS technology
  FROM dim_customer) t ON n.customer_id = t.customer_id WHERE technology IS NOT NULL"""

VIEWS["locations"] = """
SELECT *, 'California' AS state, 'United States' AS country, city || ', California, United States' AS location_label
FROM (VALUES
 (101, 'Los Angeles', 'Los Angeles Metro', 34.0522, -118.2437, 1.00, 0, 38),
 (102, 'Long Beach', 'Los Angeles Metro', 33.7701, -118.1937, 1.08, 38, 60),
 (103, 'Anaheim', 'Los Angeles Metro', 33.8366, -117.9143, 0.92, 60, 80),
 (104, 'Riverside', 'Los Angeles Metro', 33.9806, -117.3755, 1.15, 80, 100),
 (201, 'San Francisco', 'Bay Area', 37.7749, -122.4194, 0.88, 0, 35),
 (202, 'San Jose', 'Bay Area', 37.3382, -121.8863, 0.82, 35, 75),
 (203, 'Oakland', 'Bay Area', 37.8044, -122.2712, 1.08, 75, 100),
 (301, 'San Diego', 'San Diego County', 32.7157, -117.1611, 0.90, 0, 75),
 (302, 'Chula Vista', 'San Diego County', 32.6401, -117.0842, 1.05, 75, 100),
 (401, 'Fresno', 'Central Valley', 36.7378, -119.7871, 1.05, 0, 34),
 (402, 'Bakersfield', 'Central Valley', 35.3733, -119.0187, 1.18, 34, 67),
 (403, 'Stockton', 'Central Valley', 37.9577, -121.2908, 1.12, 67, 100),
 (501, 'Sacramento', 'Sacramento / North', 38.5816, -121.4944, 1.00, 0, 75),
 (502, 'Redding', 'Sacramento / North', 40.5865, -122.3917, 1.22, 75, 100))
 AS v(location_key, city, region, latitude, longitude, quality_factor, lo, hi)"""

VIEWS["cities"] = f"""
SELECT event_id, e.customer_id, event_timestamp, event_type, e.region, tower_id,
  {rnd("latency_ms * CAST(quality_factor AS DOUBLE)")} AS latency_ms,
  {rnd("LEAST(100.0, packet_loss_pct * CAST(quality_factor AS DOUBLE))")} AS packet_loss_pct,
  {rnd("GREATEST(0.1, download_speed_mbps / CAST(quality_factor AS DOUBLE))")} AS download_speed_mbps,
  CAST({rnd("outage_minutes * CAST(quality_factor AS DOUBLE)", 0)} AS BIGINT) AS outage_minutes,
  is_outage, is_degraded, CAST(location_key AS BIGINT) AS location_key
FROM (SELECT n.* REPLACE (CASE n.region WHEN 'Cairo' THEN 'Los Angeles Metro' WHEN 'Giza' THEN 'Bay Area'
    WHEN 'Alexandria' THEN 'San Diego County' WHEN 'Delta' THEN 'Central Valley'
    WHEN 'Upper Egypt' THEN 'Sacramento / North' ELSE n.region END AS region),
    {bucket("n.customer_id || '|california_city_v1'")} AS b
  FROM network n JOIN dim_customer d ON n.customer_id = d.customer_id
  WHERE lower(trim(internet_service)) IN ('dsl', 'fiber optic', 'fiber', 'fiber-optic')) e
LEFT JOIN locations l ON e.region = l.region AND b >= lo AND b < hi"""

VIEWS["days"] = """
SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT MIN(x) AS lo, MAX(y) AS hi FROM (
  SELECT MIN(billing_month) AS x, GREATEST(MAX(billing_month), MAX(payment_date)) AS y FROM billing
  UNION ALL SELECT CAST(MIN(opened_at) AS DATE), CAST(MAX(opened_at) AS DATE) FROM complaints
  UNION ALL SELECT CAST(MIN(event_timestamp) AS DATE), CAST(MAX(event_timestamp) AS DATE) FROM network))"""

VIEWS["segments"] = f"""
SELECT contract_type, internet_service, customer_value_segment, COUNT(DISTINCT customer_id) AS customer_count,
  {isum("churn_label")} AS churned_customers, {rnd(avg("churn_label") + " * 100")} AS churn_rate_pct,
  {rnd(tot("monthly_charges"))} AS monthly_revenue, {rnd(tot("actual_churn_revenue"))} AS actual_churn_revenue,
  {rnd(tot("business_risk_revenue"))} AS business_risk_revenue, {rnd(avg("risk_score"))} AS average_risk_score
FROM analytics GROUP BY ALL"""

VIEWS["cabinet_performance"] = f"""
SELECT *, {rnd("CAST(network_incidents AS DOUBLE) / network_events * 100")} AS incident_rate_pct FROM (
SELECT cabinet_id, cabinet_type, access_technology, region, {PERFORMANCE} FROM cabinets GROUP BY ALL)"""

VIEWS["city_performance"] = f"""
SELECT * EXCLUDE (average_download_speed_mbps), average_download_speed_mbps AS average_speed_mbps,
  {rnd("CAST(network_incidents AS DOUBLE) / network_events * 100")} AS incident_rate_pct FROM (
SELECT city, l.region AS region, state, country, {PERFORMANCE}
FROM cities c JOIN locations l ON c.location_key = l.location_key GROUP BY ALL)"""


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the views it uses, in dependency order."""
    views = {**VIEWS, **(extra or {})}
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str):
        for name, body in views.items():
            if name not in seen and re.search(rf"(\bFROM|\bJOIN|,)\s+{name}\b", text, re.IGNORECASE):
                seen.add(name)
                visit(body)
                order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({views[n].strip()})" for n in order)
    return f"WITH {ctes}\n{sql.strip()}"
