"""Registered queries of the measure layer, the time intelligence and the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import add, day
from checks.views import avg, div, fl, isum, tot
from subscope.plans import dashboards, measures
from subscope.plans.context import FilterContext, StarModel
from subscope.sources import lookups



def when(condition: str, value: str = "1") -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def cnt(condition: str) -> str:
    """Count that is NULL when nothing matches."""
    return isum(when(condition))


INCIDENT = "event_type <> 'normal'"

CUSTOMER_ATOMS = {
    "customers": isum("1"),
    "active": cnt("churn_label = 0"),
    "churned": cnt("churn_label = 1"),
    "active_mrr": tot(when("churn_label = 0", "monthly_charges")),
    "tenure": avg("tenure_months"),
    "exposure": tot(
        when("churn_label = 0", "COALESCE(churn_probability, 0) * COALESCE(monthly_charges, 0) * 12")
    ),
    "high_risk_mrr": tot(when("churn_label = 0 AND churn_probability >= 0.70", "monthly_charges")),
    "scored": cnt("churn_probability IS NOT NULL"),
    "high_risk": cnt("actual_churn_label = 0 AND predicted_churn_label = 1"),
    "critical": cnt("actual_churn_label = 0 AND churn_probability >= 0.85"),
    "mean_p": avg(when("actual_churn_label = 0", "churn_probability")),
    "expected": tot(when("actual_churn_label = 0", "churn_probability")),
    "fn": cnt("actual_churn_label = 1 AND predicted_churn_label = 0"),
    "churners": cnt("actual_churn_label = 1"),
}
BILLING_ATOMS = {
    "invoices": isum("1"),
    "unpaid": isum("is_unpaid"),
    "paid": isum("is_paid"),
    "late": isum("is_late"),
    "billed": tot("total_amount"),
    "mean_invoice": avg("total_amount"),
    "collected": tot(when("is_unpaid = 0", "total_amount")),
    "outstanding": tot(when("is_unpaid = 1", "total_amount")),
    "discounts": tot("discount_amount"),
    "gross_monthly": tot("monthly_charges"),
    "gross_usage": tot("usage_charges"),
}
COMPLAINT_ATOMS = {
    "complaints": isum("1"),
    "complaining": "COUNT(DISTINCT customer_id)",
    "resolved": cnt("is_unresolved = 0"),
    "unresolved": isum("is_unresolved"),
    "critical": isum("is_critical"),
    "escalated": isum("is_escalated"),
    "in_sla": cnt("is_unresolved = 0 AND resolution_hours <= 48"),
    "hours": avg(when("is_unresolved = 0", "resolution_hours")),
    "satisfaction": avg("satisfaction_score"),
}
NETWORK_ATOMS = {
    "events": isum("1"),
    "incidents": cnt(INCIDENT),
    "affected": f"COUNT(DISTINCT {when(INCIDENT, 'customer_id')})",
    "outages": isum("is_outage"),
    "degraded": isum("is_degraded"),
    "minutes": isum("outage_minutes"),
    "latency": avg("latency_ms"),
    "loss": avg("packet_loss_pct"),
    "speed": avg("download_speed_mbps"),
}


def atoms(which: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in which.items())


SCORED = "dim_customer d LEFT JOIN (SELECT customer_id AS pid, * EXCLUDE (customer_id) FROM predictions) p ON d.customer_id = p.pid"
WINDOWS = {
    "latest": ("date_trunc('month', a)", "last_day(a)"),
    "previous": ("date_trunc('month', a) - INTERVAL 1 MONTH", "date_trunc('month', a) - INTERVAL 1 DAY"),
    "rolling3": ("date_trunc('month', a) - INTERVAL 2 MONTH", "last_day(a)"),
    "ytd": ("date_trunc('year', a)", "a"),
}


def windowed(view: str, date: str, which: dict[str, str], anchor: str | None = None) -> str:
    """Atoms per time window, as columns <atom>_<window>."""
    out = []
    for w, (lo, hi) in WINDOWS.items():
        inside = f"d BETWEEN {lo} AND {hi}"
        for name, sql in which.items():
            out.append(sql.format(inside) + f" AS {name}_{w}")
    anchor = anchor or f"SELECT MAX(CAST({date} AS DATE)) FROM {view}"
    return f"SELECT {', '.join(out)} FROM (SELECT *, CAST({date} AS DATE) AS d, ({anchor}) AS a FROM {view})"


def _mean(c):
    return avg("CASE WHEN {} THEN " + c + " END")


BILLING_WINDOW = {
    "billed": tot("CASE WHEN {} THEN total_amount END"),
    "collected": tot("CASE WHEN {} AND is_unpaid = 0 THEN total_amount END"),
    "outstanding": tot("CASE WHEN {} AND is_unpaid = 1 THEN total_amount END"),
}
COMPLAINT_WINDOW = {
    "complaints": isum("CASE WHEN {} THEN 1 END"),
    "unresolved": isum("CASE WHEN {} THEN is_unresolved END"),
}
NETWORK_WINDOW = {
    "events": isum("CASE WHEN {} THEN 1 END"),
    "incidents": isum("CASE WHEN {} AND event_type <> 'normal' THEN 1 END"),
    "minutes": isum("CASE WHEN {} THEN outage_minutes END"),
    "latency": "(" + tot("CASE WHEN {0} THEN latency_ms END") + " / NULLIF(COUNT(CASE WHEN {0} THEN latency_ms END), 0))",
    "loss": "(" + tot("CASE WHEN {0} THEN packet_loss_pct END") + " / NULLIF(COUNT(CASE WHEN {0} THEN 1 END), 0))",
    "speed": "(" + tot("CASE WHEN {0} THEN download_speed_mbps END") + " / NULLIF(COUNT(CASE WHEN {0} THEN 1 END), 0))",
}
# One-row views the scalar measures read.
ROWS = {
    "mc": f"SELECT {atoms(CUSTOMER_ATOMS)} FROM {SCORED}",
    "mb": f"SELECT {atoms(BILLING_ATOMS)} FROM billing",
    "mm": f"SELECT {atoms(COMPLAINT_ATOMS)} FROM complaints",
    "mn": f"SELECT {atoms(NETWORK_ATOMS)} FROM cities",
    "wb": windowed("billing", "billing_month", BILLING_WINDOW),
    "wm": windowed("complaints", "opened_at", COMPLAINT_WINDOW),
    "wn": windowed("cities", "event_timestamp", NETWORK_WINDOW, "SELECT MAX(CAST(event_timestamp AS DATE)) FROM network"),
    "md": "SELECT MIN(d) AS first_day, MAX(d) AS last_day FROM days",
    "mr": f"SELECT {div('COUNT(*) FILTER (n > 1)', 'COUNT(*)')} AS repeat_rate FROM (SELECT customer_id, COUNT(DISTINCT complaint_id) AS n FROM complaints GROUP BY 1)",
    "mh": f"""SELECT {cnt("monthly_charges >= arpu")} AS n FROM (SELECT monthly_charges FROM {SCORED} WHERE churn_label = 0 AND churn_probability >= 0.70),
        (SELECT {div(tot(when("churn_label = 0", "monthly_charges")), cnt("churn_label = 0"))} AS arpu FROM dim_customer)""",
}


def mom(row, atom):
    return div(f"{row}.{atom}_latest - {row}.{atom}_previous", f"{row}.{atom}_previous")


def nhealth(row, w=""):
    rate = div(f"COALESCE({row}.incidents{w}, 0)", f"{row}.events{w}")
    body = V.health(rate, f"{row}.latency{w}", f"{row}.loss{w}", f"{row}.speed{w}")
    return f"CASE WHEN {row}.events{w} > 0 THEN {body} END"


def collection(w):
    return div(f"wb.collected_{w}", f"wb.billed_{w}")


def signed(x):
    return f"CASE WHEN {x} > 0 THEN '+' WHEN {x} < 0 THEN '-' ELSE '' END || printf('%.1f%%', abs({x}) * 100)"


PERIOD = "strftime(md.first_day, '%d %b %Y') || ' — ' || strftime(md.last_day, '%d %b %Y')"
RATE = div("mc.high_risk", "mc.active")


def steps(x, *pairs, otherwise):
    cases = " ".join(f"WHEN COALESCE({x}, 0) {test} THEN '{label}'" for test, label in pairs)
    return f"CASE {cases} ELSE '{otherwise}' END"


G, A, R = measures.GOOD, measures.WARN, measures.BAD
# number -> SQL over the one-row views
SCALARS = {
    1: "mc.customers",
    2: "mc.active",
    3: div("mc.churned", "mc.customers"),
    4: "mc.high_risk",
    5: "mc.active_mrr",
    6: "mc.exposure",
    7: div("mb.collected", "mb.billed"),
    8: nhealth("mn"),
    9: "mc.churned",
    10: div("mc.active", "mc.customers"),
    11: "mc.tenure",
    12: div("mc.active_mrr", "mc.active"),
    13: "mc.active_mrr * 12",
    14: "mc.scored",
    15: div("mc.scored", "mc.customers"),
    16: "mc.critical",
    17: RATE,
    18: "mc.mean_p",
    19: "mc.expected",
    20: "mc.high_risk_mrr",
    21: div("mc.high_risk_mrr", "mc.active_mrr"),
    22: div("mc.exposure", "mc.active_mrr * 12"),
    23: div("mc.exposure", "mc.high_risk"),
    24: "mh.n",
    25: "mb.invoices",
    26: "mb.unpaid",
    27: "mb.billed",
    28: "mb.collected",
    29: "mb.outstanding",
    30: div("mb.outstanding", "mb.billed"),
    31: div("mb.paid", "mb.invoices"),
    32: div("mb.late", "mb.invoices"),
    33: "mb.mean_invoice",
    34: div("mb.discounts", "mb.gross_monthly + mb.gross_usage"),
    35: "wb.billed_latest",
    36: "wb.billed_previous",
    37: mom("wb", "billed"),
    38: "wb.billed_rolling3 / 3",
    39: "wb.billed_ytd",
    40: "wb.outstanding_latest",
    41: "wb.outstanding_previous",
    42: mom("wb", "outstanding"),
    43: collection("latest"),
    44: collection("previous"),
    45: f"100 * ({collection('latest')} - {collection('previous')})",
    46: "mm.complaints",
    47: "mm.complaining",
    48: "1000 * " + div("mm.complaints", "mc.customers"),
    49: "mm.resolved",
    50: "mm.unresolved",
    51: div("mm.unresolved", "mm.complaints"),
    52: div("mm.critical", "mm.complaints"),
    53: div("mm.escalated", "mm.complaints"),
    54: div("mm.in_sla", "mm.resolved"),
    55: "mm.hours",
    56: "mm.satisfaction",
    57: "mr.repeat_rate",
    58: "wm.complaints_latest",
    59: "wm.complaints_previous",
    60: mom("wm", "complaints"),
    61: "CAST(wm.complaints_rolling3 AS DOUBLE) / 3",
    62: "wm.unresolved_latest",
    63: "wm.unresolved_previous",
    64: mom("wm", "unresolved"),
    65: "mn.events",
    66: "mn.incidents",
    67: div("mn.incidents", "mn.events"),
    68: "mn.affected",
    69: "mn.outages",
    70: "mn.degraded",
    71: "mn.minutes",
    72: div("mn.minutes", "mn.outages"),
    73: "mn.latency",
    74: "mn.loss",
    75: "mn.speed",
    76: nhealth("wn", "_latest"),
    77: nhealth("wn", "_previous"),
    78: f"{nhealth('wn', '_latest')} - {nhealth('wn', '_previous')}",
    79: "wn.minutes_latest",
    80: "wn.minutes_previous",
    81: mom("wn", "minutes"),
    88: "mc.fn",
    89: div("mc.fn", "mc.churners"),
    92: PERIOD,
    93: "strftime(md.last_day, '%b %Y')",
    94: f"{PERIOD} || '  |  ' || format('{{:,}}', mc.customers) || ' customers'",
    95: f"COALESCE({signed(mom('wb', 'billed'))} || ' vs prior month', 'No prior month')",
    96: steps(RATE, (">= 0.20", "Critical"), (">= 0.10", "Watch"), otherwise="Stable"),
    97: steps(nhealth("wn", "_latest"), (">= 80", "Healthy"), (">= 65", "Watch"), otherwise="Critical"),
    98: steps(mom("wb", "billed"), (">= 0", G), otherwise=R),
    99: steps(RATE, (">= 0.20", R), (">= 0.10", A), otherwise=G),
    100: steps(collection("latest"), (">= 0.90", G), (">= 0.80", A), otherwise=R),
    101: steps(mom("wm", "complaints"), ("<= 0", G), ("<= 0.10", A), otherwise=R),
    102: steps(nhealth("wn", "_latest"), (">= 80", G), (">= 65", A), otherwise=R),
    103: "'Average Tenure: ' || printf('%.1f', mc.tenure) || ' Months'",
    105: "mb.invoices - mb.unpaid",
    106: "mb.paid",
}


def scalar_sql(columns: dict[str, str]) -> str:
    text = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    used = [row for row in ROWS if f"{row}." in text]
    return f"SELECT {text} FROM {', '.join(used)}"


def measure(w, names, by=(), ctx=FilterContext()):
    return measures.query(StarModel.of(w), names, by, ctx)


for _number, _sql in SCALARS.items():
    _name = measures.MEASURES[_number][0]
    add(
        f"m{_number}_{_name}",
        lambda w, n=_name: measure(w, [n]),
        scalar_sql({_name: _sql}),
        ROWS,
    )

# Constants come with the measure they frame, so that their query reads data too.
add(
    "m108_m109_m110_sla_gauge",
    lambda w: measure(
        w, ["sla_gauge_minimum", "sla_gauge_maximum", "sla_target_pct", "sla_compliance_48h_pct"], ["complaints.priority"]
    ),
    f"""SELECT priority, CAST(0 AS DOUBLE) AS sla_gauge_minimum, CAST(1 AS DOUBLE) AS sla_gauge_maximum, CAST(0.9 AS DOUBLE) AS sla_target_pct,
    {div(COMPLAINT_ATOMS['in_sla'], COMPLAINT_ATOMS['resolved'])} AS sla_compliance_48h_pct FROM complaints GROUP BY 1""",
)
add(
    "m104_a20_internet_service_mix",
    lambda w: measure(w, ["internet_service_mix_pct"], ["dim_customer.internet_service"]),
    f"SELECT internet_service, {div('COUNT(*)', '(SELECT COUNT(*) FROM dim_customer)')} AS internet_service_mix_pct FROM dim_customer GROUP BY 1",
)
add(
    "m107_j13_invoice_funnel",
    lambda w: measures.funnel(StarModel.of(w), lookups.funnel_stages(w.spark)),
    f"""SELECT 'Total Invoices' AS stage, COUNT(*) AS invoice_funnel_value, CAST(1 AS BIGINT) AS stage_order FROM billing
    UNION ALL SELECT 'Collected Invoices', COUNT(*) - {isum('is_unpaid')}, 2 FROM billing
    UNION ALL SELECT 'On-Time Invoices', {isum('is_paid')}, 3 FROM billing""",
)


def _models(w):
    """Two rule scorers in the shape of the model tables, so that SQL can recompute them."""
    from subscope.operators import scoring, stats

    analytics = w.gold("customer_churn_analytics")
    scorers = {
        "Risk score baseline": F.col("risk_score") / 100,
        "Charge baseline": F.greatest(F.least(F.col("monthly_charges") / 125, F.lit(1.0)), F.lit(0.0)),
    }
    rows, stamp = None, F.lit("2024-01-01").cast("timestamp")
    for name, probability in scorers.items():
        p = scoring.predictions(analytics, probability, name, "rules")
        auc = stats.roc_auc(p, "actual_churn_label", "churn_probability").scalar()
        row = stats.binary_metrics(p, "actual_churn_label", "predicted_churn_label").select(
            F.lit(name).alias("model_name"), "*", auc.alias("roc_auc"), stamp.alias("evaluation_timestamp")
        )
        rows = row if rows is None else rows.unionByName(row)
    drivers = ["tenure_months", "monthly_charges", "complaint_count", "payment_issue_count"]
    gaps = [
        F.abs(
            measures.C.mean(F.when(F.col("churn_label") == 1, F.col(c)))
            - measures.C.mean(F.when(F.col("churn_label") == 0, F.col(c)))
        ).alias(c)
        for c in drivers
    ]
    importance = analytics.agg(*gaps).unpivot([], drivers, "feature_name", "importance")
    return rows, importance


_SCORER = """SELECT '{name}' AS model_name, {accuracy} AS accuracy, COALESCE({precision}, 0) AS "precision", COALESCE({recall}, 0) AS recall,
COALESCE({f1}, 0) AS f1_score, {auc} AS roc_auc FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (y = 1 AND z = 1) AS tp, COUNT(*) FILTER (y = 0 AND z = 1) AS fp,
COUNT(*) FILTER (y = 1 AND z = 0) AS fn, COUNT(*) FILTER (y = 0 AND z = 0) AS tn FROM {t}),
(SELECT SUM(pos * (2 * below + neg)) AS wins, SUM(pos) AS p, SUM(neg) AS q FROM (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
FROM (SELECT s, COUNT(*) FILTER (y = 1) AS pos, COUNT(*) FILTER (y = 0) AS neg FROM {t} GROUP BY 1)))"""


def _scorer(name, t):
    return _SCORER.format(
        name=name,
        t=t,
        accuracy=div("tp + tn", "n"),
        precision=div("tp", "tp + fp"),
        recall=div("tp", "tp + fn"),
        f1=div("2 * tp", "2 * tp + fp + fn"),
        auc="CAST(wins AS DOUBLE) / (2.0 * p * q)",
    )


def _gap(c):
    one, zero = (avg(when(f"churn_label = {k}", c)) for k in (1, 0))
    return f"SELECT '{c}' AS feature_name, abs({one} - {zero}) AS importance FROM analytics"


_DRIVERS = ["tenure_months", "monthly_charges", "complaint_count", "payment_issue_count"]
add(
    "m82_m87_m90_m91_t7_latest_best_model",
    lambda w: measures.model_measures(*_models(w)),
    """SELECT model_name AS latest_best_model, accuracy AS latest_model_accuracy_pct, "precision" AS latest_model_precision_pct,
    recall AS latest_model_recall_pct, f1_score AS latest_model_f1_pct, roc_auc AS latest_model_roc_auc_pct,
    feature_name AS top_churn_driver, importance AS top_driver_importance_pct
    FROM (SELECT * FROM scorers ORDER BY roc_auc DESC LIMIT 1), (SELECT * FROM drivers ORDER BY importance DESC, feature_name LIMIT 1)""",
    {
        "scored_risk": f"SELECT churn_label AS y, CASE WHEN risk_score / 100 >= 0.5 THEN 1 ELSE 0 END AS z, {V.rnd('risk_score / 100', 4)} AS s FROM analytics",
        "scored_charge": f"""SELECT y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS z, {V.rnd('p', 4)} AS s FROM
            (SELECT churn_label AS y, GREATEST(LEAST(monthly_charges / 125, 1.0), 0.0) AS p FROM analytics)""",
        "scorers": _scorer("Risk score baseline", "scored_risk") + " UNION ALL " + _scorer("Charge baseline", "scored_charge"),
        "drivers": " UNION ALL ".join(_gap(c) for c in _DRIVERS),
    },
)

# ------------------------------------------------------------------ grouped measure queries

_CUSTOMER_NAMES = [measures.MEASURES[n][0] for n in (1, 2, 3, 5, 6, 9, 10, 11, 12, 13, 14, 15, 17, 18, 19, 20, 21, 22)]
_CUSTOMER_SQL = ", ".join(
    f"{SCALARS[measures.NUMBER[n]].replace('mc.', 'r.')} AS {n}" for n in _CUSTOMER_NAMES
)
add(
    "a22_f6_customer_measures_by_contract_tenure",
    lambda w: measure(w, _CUSTOMER_NAMES, ["dim_customer.contract_type", "dim_customer.tenure_segment"]),
    f"SELECT contract_type, tenure_segment, {_CUSTOMER_SQL} FROM (SELECT contract_type, tenure_segment, {atoms(CUSTOMER_ATOMS)} FROM {SCORED} GROUP BY 1, 2) r",
)
_BILLING_NAMES = [measures.MEASURES[n][0] for n in (25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 7, 105, 106)]
_BILLING_SQL = ", ".join(f"{SCALARS[measures.NUMBER[n]].replace('mb.', 'r.')} AS {n}" for n in _BILLING_NAMES)
_CLIENT = "JOIN (SELECT customer_id AS cid, contract_type, tenure_segment, churn_label FROM dim_customer) d ON f.customer_id = cid"
add(
    "j8_billing_measures_by_contract_status",
    lambda w: measure(w, _BILLING_NAMES, ["dim_customer.contract_type", "billing.payment_method"]),
    f"SELECT contract_type, payment_method, {_BILLING_SQL} FROM (SELECT contract_type, payment_method, {atoms(BILLING_ATOMS)} FROM billing f {_CLIENT} GROUP BY 1, 2) r",
)
_COMPLAINT_NAMES = [measures.MEASURES[n][0] for n in (46, 47, 49, 50, 51, 52, 53, 54, 55, 56)]
_COMPLAINT_SQL = ", ".join(f"{SCALARS[measures.NUMBER[n]].replace('mm.', 'r.')} AS {n}" for n in _COMPLAINT_NAMES)
add(
    "j8_complaint_measures_by_tenure_year",
    lambda w: measure(w, _COMPLAINT_NAMES, ["dim_customer.tenure_segment", "dim_date.year"]),
    f"SELECT tenure_segment, year, {_COMPLAINT_SQL} FROM (SELECT tenure_segment, year(opened_at) AS year, {atoms(COMPLAINT_ATOMS)} FROM complaints f {_CLIENT} GROUP BY 1, 2) r",
)
_NETWORK_NAMES = [measures.MEASURES[n][0] for n in (65, 66, 67, 68, 69, 70, 71, 72, 73, 74, 75, 8)]
_NETWORK_SQL = ", ".join(f"{SCALARS[measures.NUMBER[n]].replace('mn.', 'r.')} AS {n}" for n in _NETWORK_NAMES)
add(
    "j4_network_measures_by_city",
    lambda w: measure(w, _NETWORK_NAMES, ["dim_network_location.city"]),
    f"SELECT city, {_NETWORK_SQL} FROM (SELECT city, {atoms(NETWORK_ATOMS)} FROM cities f JOIN (SELECT location_key AS lk, city FROM locations) l ON f.location_key = lk GROUP BY 1) r",
)
add(
    "a23_repeat_complainers_by_contract",
    lambda w: measure(w, ["repeat_complainer_rate_pct", "customers_with_complaints"], ["dim_customer.contract_type"]),
    f"""SELECT contract_type, {div('COUNT(*) FILTER (n > 1)', 'COUNT(*)')} AS repeat_complainer_rate_pct, COUNT(*) AS customers_with_complaints
    FROM (SELECT contract_type, f.customer_id, COUNT(*) AS n FROM complaints f {_CLIENT} GROUP BY 1, 2) GROUP BY 1""",
)
add(
    "m24_high_value_high_risk_by_contract",
    lambda w: measure(w, ["total_customers", "high_value_high_risk_customers"], ["dim_customer.contract_type"]),
    f"""SELECT s.contract_type AS contract_type, isum_total AS total_customers, n AS high_value_high_risk_customers FROM
    (SELECT contract_type, COUNT(*) AS isum_total, {div(tot(when("churn_label = 0", "monthly_charges")), cnt("churn_label = 0"))} AS arpu FROM dim_customer GROUP BY 1) s
    LEFT JOIN (SELECT q.contract_type AS ct, {cnt("q.monthly_charges >= g.arpu")} AS n FROM {SCORED.replace("dim_customer d", "dim_customer q").replace("d.customer_id", "q.customer_id")}
      JOIN (SELECT contract_type, {div(tot(when("churn_label = 0", "monthly_charges")), cnt("churn_label = 0"))} AS arpu FROM dim_customer GROUP BY 1) g ON q.contract_type = g.contract_type
      WHERE churn_label = 0 AND churn_probability >= 0.70 GROUP BY 1) t ON s.contract_type = ct""",
)
# Measures of several tables side by side, on a shared dimension and on a fact's own column.
add(
    "f1_drill_across_by_contract",
    lambda w: measure(
        w,
        ["total_customers", "total_invoices", "complaints_per_1k_customers", "incident_affected_customers"],
        ["dim_customer.contract_type"],
    ),
    f"""SELECT c.contract_type AS contract_type, total_customers, total_invoices, 1000 * {div('n', 'total_customers')} AS complaints_per_1k_customers, incident_affected_customers
    FROM (SELECT contract_type, COUNT(*) AS total_customers FROM dim_customer GROUP BY 1) c
    LEFT JOIN (SELECT contract_type, COUNT(*) AS total_invoices FROM billing f {_CLIENT} GROUP BY 1) b ON c.contract_type = b.contract_type
    LEFT JOIN (SELECT contract_type, COUNT(*) AS n FROM complaints f {_CLIENT} GROUP BY 1) m ON c.contract_type = m.contract_type
    LEFT JOIN (SELECT contract_type, COUNT(DISTINCT f.customer_id) AS incident_affected_customers FROM cities f {_CLIENT} WHERE {INCIDENT} GROUP BY 1) e ON c.contract_type = e.contract_type""",
)
add(
    "f1_dimension_measure_on_fact_column",
    lambda w: measure(w, ["total_complaints", "total_customers", "complaints_per_1k_customers"], ["complaints.priority"]),
    f"""SELECT priority, COUNT(*) AS total_complaints, (SELECT COUNT(*) FROM dim_customer) AS total_customers,
    1000 * {div('COUNT(*)', '(SELECT COUNT(*) FROM dim_customer)')} AS complaints_per_1k_customers FROM complaints GROUP BY 1""",
)
add(
    "f2_condition_replaces_group_selection",
    lambda w: measure(w, ["total_customers", "active_customers", "active_mrr"], ["dim_customer.churn_label", "dim_customer.contract_type"]),
    f"""SELECT churn_label, g.contract_type AS contract_type, n AS total_customers, active_customers, active_mrr FROM
    (SELECT churn_label, contract_type, COUNT(*) AS n FROM dim_customer GROUP BY 1, 2) g JOIN
    (SELECT contract_type, {cnt('churn_label = 0')} AS active_customers, {tot(when('churn_label = 0', 'monthly_charges'))} AS active_mrr FROM dim_customer GROUP BY 1) a
    ON g.contract_type = a.contract_type""",
)
add(
    "f3_share_ignores_own_selection",
    lambda w: measure(
        w,
        ["internet_service_mix_pct"],
        ["dim_customer.contract_type"],
        FilterContext(filters={"dim_customer.internet_service": ["DSL", "Fiber optic"]}),
    ),
    f"""SELECT contract_type, {div("COUNT(*) FILTER (internet_service IN ('DSL', 'Fiber optic'))", 'COUNT(*)')} AS internet_service_mix_pct
    FROM dim_customer GROUP BY 1""",
)
add(
    "f4_share_of_selected_total",
    lambda w: measures.share_of_parent(
        measure(
            w,
            ["total_complaints"],
            ["complaints.complaint_status"],
            FilterContext(filters={"dim_customer.contract_type": ["One year", "Two year"]}),
        ),
        "total_complaints",
        [],
    ),
    f"""SELECT complaint_status, COUNT(*) AS total_complaints, {div('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share
    FROM complaints f {_CLIENT} WHERE contract_type IN ('One year', 'Two year') GROUP BY 1""",
)
add(
    "f8_date_range_and_selection",
    lambda w: measure(
        w,
        ["total_billed_revenue", "collection_rate_pct", "total_complaints"],
        ["dim_customer.tenure_segment"],
        FilterContext("1997-01-01", "1998-06-30", {"dim_customer.contract_type": ["Month-to-month"]}),
    ),
    f"""SELECT b.tenure_segment AS tenure_segment, total_billed_revenue, {div('collected', 'total_billed_revenue')} AS collection_rate_pct, total_complaints
    FROM (SELECT tenure_segment, {tot('total_amount')} AS total_billed_revenue, {tot(when('is_unpaid = 0', 'total_amount'))} AS collected FROM billing f {_CLIENT}
      WHERE contract_type = 'Month-to-month' AND billing_month BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' GROUP BY 1) b
    JOIN (SELECT tenure_segment, COUNT(*) AS total_complaints FROM complaints f {_CLIENT}
      WHERE contract_type = 'Month-to-month' AND CAST(opened_at AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' GROUP BY 1) m ON b.tenure_segment = m.tenure_segment""",
)
add(
    "f8_j9_prediction_selection_filters_billing",
    lambda w: measure(
        w,
        ["outstanding_revenue", "total_invoices"],
        ["dim_customer.contract_type"],
        FilterContext(filters={"predictions.risk_category": ["Critical"]}),
    ),
    f"""SELECT contract_type, {tot(when('is_unpaid = 1', 'total_amount'))} AS outstanding_revenue, COUNT(*) AS total_invoices
    FROM billing f {_CLIENT} JOIN (SELECT customer_id AS pid FROM predictions WHERE risk_category = 'Critical') p ON f.customer_id = pid GROUP BY 1""",
)
add(
    "f10_calendar_anchor",
    lambda w: measure(
        w,
        ["billed_revenue_latest_month", "billed_revenue_previous_month", "billed_revenue_ytd", "complaints_rolling_3m_average"],
        (),
        FilterContext(date_to="1999-08-15", anchor="calendar"),
    ),
    f"""SELECT {tot(when("billing_month = DATE '1999-08-01'", 'total_amount'))} AS billed_revenue_latest_month,
    {tot(when("billing_month = DATE '1999-07-01'", 'total_amount'))} AS billed_revenue_previous_month,
    {tot(when("billing_month BETWEEN DATE '1999-01-01' AND DATE '1999-08-15'", 'total_amount'))} AS billed_revenue_ytd,
    (SELECT CAST(COUNT(*) AS DOUBLE) / 3 FROM complaints WHERE CAST(opened_at AS DATE) BETWEEN DATE '1999-06-01' AND DATE '1999-08-31') AS complaints_rolling_3m_average
    FROM billing""",
)
add(
    "f10_windows_by_contract",
    lambda w: measure(
        w, ["billed_revenue_latest_month", "billed_revenue_mom_pct", "total_billed_revenue"], ["dim_customer.contract_type"]
    ),
    f"""SELECT contract_type, {tot(when('billing_month = a', 'total_amount'))} AS billed_revenue_latest_month,
    {div(tot(when('billing_month = a', 'total_amount')) + ' - ' + tot(when('billing_month = a - INTERVAL 1 MONTH', 'total_amount')), tot(when('billing_month = a - INTERVAL 1 MONTH', 'total_amount')))} AS billed_revenue_mom_pct,
    {tot('total_amount')} AS total_billed_revenue FROM (SELECT *, (SELECT MAX(billing_month) FROM billing) AS a FROM billing f {_CLIENT}) GROUP BY 1""",
)
add(
    "f5_f9_blank_health_reads_as_zero",
    lambda w: measure(w, ["network_health_score", "network_health_blank_as_zero"], ["network.region"]),
    f"""SELECT region, {nhealth('r')} AS network_health_score, {nhealth('r')} AS network_health_blank_as_zero
    FROM (SELECT region, {atoms(NETWORK_ATOMS)} FROM cities GROUP BY 1) r""",
)

# -------------------------------------------------------------------------- time series


def line_sql(value: str, source: str, date: str, lo: str = "SELECT MIN(d) FROM days", hi: str = "SELECT MAX(d) FROM days", key: str = "") -> str:
    k, part = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    keys = f", (SELECT DISTINCT {key} FROM {source})" if key else ""
    same = f" AND l.{key} = v.{key}" if key else ""
    both = f"PARTITION BY {key}, year(m)" if key else "PARTITION BY year(m)"
    return f"""SELECT {k}strftime(m, '%Y-%m') AS year_month, value, previous_month,
    {div('value - previous_month', 'previous_month')} AS mom_pct, rolling_3m_average, year_to_date FROM
    (SELECT {('l.' + key + ', ') if key else ''}m, value, LAG(value) OVER ({part.replace('BY ', 'BY l.')}ORDER BY m) AS previous_month,
     SUM(value) OVER ({part.replace('BY ', 'BY l.')}ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) / 3 AS rolling_3m_average,
     SUM(value) OVER ({both.replace('BY ', 'BY l.', 1) if key else both} ORDER BY m ROWS UNBOUNDED PRECEDING) AS year_to_date
     FROM (SELECT * FROM (SELECT unnest(generate_series(date_trunc('month', ({lo}))::TIMESTAMP, date_trunc('month', ({hi}))::TIMESTAMP, INTERVAL 1 MONTH)) AS m){keys}) l
     LEFT JOIN (SELECT {k}date_trunc('month', {date})::TIMESTAMP AS mm, CAST({value} AS DOUBLE) AS value FROM {source} GROUP BY ALL) v ON m = mm{same})"""


_SERIES = {
    "ti1_ti5_complaints_by_month": ("total_complaints", "COUNT(*)", "complaints", "opened_at"),
    "ti1_ti5_unresolved_by_month": ("unresolved_complaints", "SUM(is_unresolved)", "complaints", "opened_at"),
    "ti1_ti5_outage_minutes_by_month": ("total_outage_minutes", "SUM(outage_minutes)", "cities", "event_timestamp"),
    "ti1_ti5_invoices_by_month": ("total_invoices", "COUNT(*)", "billing", "billing_month"),
    "ti1_ti5_unpaid_by_month": ("unpaid_invoices", "SUM(is_unpaid)", "billing", "billing_month"),
}
for _key, (_name, _value, _source, _date) in _SERIES.items():
    add(
        f"w2_{_key}",
        lambda w, n=_name: measures.series(StarModel.of(w), n),
        line_sql(_value, _source, _date),
    )


def window_sql(value: str, source: str, date: str) -> str:
    """A measure over each month's windows, from its definition: the rows between two dates."""
    of = lambda since: f"(SELECT CASE WHEN COUNT(*) > 0 THEN CAST({value} AS DOUBLE) END FROM {source} WHERE {date} >= {since} AND {date} < m + INTERVAL 1 MONTH)"
    return f"""SELECT strftime(m, '%Y-%m') AS year_month, value, previous_month, {div('value - previous_month', 'previous_month')} AS mom_pct,
    rolling_3m_average, year_to_date FROM (SELECT *, LAG(value) OVER (ORDER BY m) AS previous_month FROM
    (SELECT m, {of('m')} AS value, {of('m - INTERVAL 2 MONTH')} AS rolling_3m_average, {of("date_trunc('year', m)")} AS year_to_date FROM
    (SELECT unnest(generate_series(date_trunc('month', (SELECT MIN(d) FROM days))::TIMESTAMP, date_trunc('month', (SELECT MAX(d) FROM days))::TIMESTAMP, INTERVAL 1 MONTH)) AS m)))"""


_RATIO = div(tot(when("is_unpaid = 0", "total_amount")), tot("total_amount"))
add(
    "w2_ti2_ti3_collection_rate_by_month",
    lambda w: measures.series(StarModel.of(w), "collection_rate_pct"),
    window_sql(_RATIO, "billing", "billing_month"),
)
add(
    "w2_ti2_ti3_billed_revenue_by_month",
    lambda w: measures.series(StarModel.of(w), "total_billed_revenue"),
    line_sql(tot("total_amount"), "billing", "billing_month"),
)
add(
    "w2_ti4_ti5_customers_with_complaints_by_month",
    lambda w: measures.series(StarModel.of(w), "customers_with_complaints"),
    window_sql("COUNT(DISTINCT customer_id)", "complaints", "opened_at"),
)
add(
    "w2_ti1_ti5_complaints_by_contract",
    lambda w: measures.series(StarModel.of(w), "total_complaints", ["dim_customer.contract_type"]),
    line_sql("COUNT(*)", f"(SELECT contract_type, opened_at FROM complaints f {_CLIENT})", "opened_at", key="contract_type"),
)

# ------------------------------------------------------------------------------ dashboard

_Q = {
    "q1_a21_outstanding_tree": f"""SELECT payment_method, tenure_segment, contract_type,
        CAST(3 - (GROUPING(payment_method) + GROUPING(tenure_segment) + GROUPING(contract_type)) AS BIGINT) AS depth, {tot('total_amount')} AS outstanding_revenue
        FROM (SELECT d.payment_method AS payment_method, tenure_segment, contract_type, total_amount FROM billing f JOIN dim_customer d ON f.customer_id = d.customer_id WHERE is_unpaid = 1)
        GROUP BY ROLLUP (payment_method, tenure_segment, contract_type)""",
    "q2_status_by_contract": f"SELECT contract_type, {cnt('churn_label = 0')} AS active_customers, {cnt('churn_label = 1')} AS churned_customers FROM dim_customer GROUP BY 1",
    "q3_prediction_outcomes": "SELECT prediction_outcome, COUNT(*) AS scored_customers FROM outcomes GROUP BY 1",
    "q4_incident_map": f"""SELECT l.region AS region, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, location_label, {cnt(INCIDENT)} AS network_incidents
        FROM cities c JOIN locations l ON c.location_key = l.location_key GROUP BY 1, 2, 3, 4""",
    "q5_speed_latency_by_region": f"SELECT region, {avg('download_speed_mbps')} AS average_download_speed_mbps, {avg('latency_ms')} AS average_latency_ms FROM cities GROUP BY 1",
    "q6_event_types": "SELECT event_type, COUNT(DISTINCT event_id) AS total_network_events FROM cities GROUP BY 1",
    "q7_service_mix": f"""SELECT contract_type, internet_service, {div('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY contract_type)')} AS internet_service_mix_pct FROM dim_customer GROUP BY 1, 2""",
    "q8_priority_status": f"""SELECT c.priority AS priority, complaint_status, total_complaints, share, CAST(priority_sort AS BIGINT) AS priority_sort FROM
        (SELECT priority, complaint_status, COUNT(*) AS total_complaints, {div('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY priority)')} AS share FROM complaints GROUP BY 1, 2) c
        JOIN (VALUES ('critical', 1), ('high', 2), ('medium', 3), ('low', 4)) p(priority, priority_sort) ON c.priority = p.priority""",
    "q9_customer_status": "SELECT customer_status, COUNT(*) AS total_customers FROM dim_customer GROUP BY 1",
    "q10_affected_by_region": f"SELECT region, COUNT(DISTINCT {when(INCIDENT, 'customer_id')}) AS incident_affected_customers, {avg('packet_loss_pct')} AS average_packet_loss_pct FROM cities GROUP BY 1",
    "q11_risk_by_action": f"SELECT recommended_action, retention_priority, {tot('predicted_revenue_at_risk')} AS predicted_revenue_at_risk FROM retention GROUP BY 1, 2",
    "q12_network_health": scalar_sql({"network_health_score": SCALARS[8]}),
    "q13_risk_distribution": "SELECT risk_category, COUNT(*) AS scored_customers FROM predictions GROUP BY 1",
    "q14_high_risk_active": scalar_sql({"high_risk_active_customers": SCALARS[4]}),
    "q15_total_customers": "SELECT COUNT(*) AS total_customers FROM dim_customer",
    "q16_complaints_by_category": f"SELECT complaint_category, COUNT(*) AS total_complaints, {avg(when('is_unresolved = 0', 'resolution_hours'))} AS average_resolution_hours FROM complaints GROUP BY 1",
    "q17_monthly_collection": f"""SELECT strftime(billing_month, '%Y-%m') AS year_month, CAST(strftime(billing_month, '%Y%m') AS BIGINT) AS year_month_sort,
        {BILLING_ATOMS['collected']} AS collected_revenue, {BILLING_ATOMS['outstanding']} AS outstanding_revenue, {_RATIO} AS collection_rate_pct FROM billing GROUP BY 1, 2""",
    "q18_date_range": f"SELECT {day('MIN(d)')} AS first_date, {day('MAX(d)')} AS last_date, COUNT(*) AS days FROM days",
    "q19_complaint_status": "SELECT complaint_status, COUNT(*) AS total_complaints FROM complaints GROUP BY 1",
    "q20_invoice_funnel": f"""SELECT 'Total Invoices' AS stage, COUNT(*) AS invoice_funnel_value, CAST(1 AS BIGINT) AS stage_order FROM billing
        UNION ALL SELECT 'Collected Invoices', COUNT(*) - {isum('is_unpaid')}, 2 FROM billing
        UNION ALL SELECT 'On-Time Invoices', {isum('is_paid')}, 3 FROM billing""",
    "q21_retention_by_tenure": f"SELECT tenure_segment, {div(cnt('churn_label = 0'), 'COUNT(*)')} AS active_customer_rate_pct, {div(cnt('churn_label = 1'), 'COUNT(*)')} AS actual_churn_rate_pct FROM dim_customer GROUP BY 1",
    "q22_sla_gauge": scalar_sql({"sla_compliance_48h_pct": SCALARS[54], "sla_target_pct": "CAST(0.9 AS DOUBLE)", "sla_gauge_minimum": "CAST(0 AS DOUBLE)", "sla_gauge_maximum": "CAST(1 AS DOUBLE)"}),
    "q23_billed_by_status": f"SELECT payment_status, {tot('total_amount')} AS total_billed_revenue FROM billing GROUP BY 1",
    "q24_active_mrr": scalar_sql({"active_mrr": SCALARS[5]}),
}
for _key, _query in dashboards.QUERIES.items():
    add(_key, lambda w, q=_query: q(StarModel.of(w)), _Q[_key], ROWS)

# ------------------------------------------------------------------ a second date role

PAYMENT = {"billing": "payment"}
add(
    "f1_d18_revenue_by_payment_month",
    lambda w: measures.query(
        StarModel.of(w), ["total_billed_revenue", "collected_revenue", "total_invoices"], ["dim_date.year_month_sort"], FilterContext(date_roles=PAYMENT)
    ).filter("year_month_sort IS NOT NULL"),
    f"""SELECT CAST(strftime(payment_date, '%Y%m') AS BIGINT) AS year_month_sort, {tot("total_amount")} AS total_billed_revenue,
    {tot(when("is_unpaid = 0", "total_amount"))} AS collected_revenue, COUNT(*) AS total_invoices FROM billing WHERE payment_date IS NOT NULL GROUP BY 1""",
)
add(
    "f8_d18_payments_in_a_range_by_contract",
    lambda w: measures.query(
        StarModel.of(w), ["collected_revenue", "total_invoices"], ["dim_customer.contract_type"], FilterContext("1996-02-10", "1997-05-20", date_roles=PAYMENT)
    ),
    f"""SELECT contract_type, {tot(when("is_unpaid = 0", "total_amount"))} AS collected_revenue, COUNT(*) AS total_invoices
    FROM billing b LEFT JOIN dim_customer d ON b.customer_id = d.customer_id
    WHERE payment_date BETWEEN DATE '1996-02-10' AND DATE '1997-05-20' GROUP BY 1""",
)
add(
    "f10_d18_latest_payment_month",
    lambda w: measures.query(StarModel.of(w), ["billed_revenue_latest_month", "billed_revenue_previous_month"], (), FilterContext(date_roles=PAYMENT)),
    f"""SELECT {tot(when("date_trunc('month', payment_date) = m", "total_amount"))} AS billed_revenue_latest_month,
    {tot(when("date_trunc('month', payment_date) = m - INTERVAL 1 MONTH", "total_amount"))} AS billed_revenue_previous_month
    FROM billing, (SELECT date_trunc('month', MAX(payment_date)) AS m FROM billing)""",
)
