"""The measure layer: 110 named metrics over the star, evaluated in a filter context.

A measure is an expression over *atoms*. An atom is one conditional aggregate of one table.
A query collects the atoms its measures need and computes them with one scan per table: rows
are first combined per customer (map side, so a hot customer costs one row per task), then
joined to customer attributes if any are asked for, then combined per group. Tables meet by
a union of their groups followed by one aggregate, never by joining facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import kpi
from subscope.plans.context import (
    CUSTOMER_TABLES,
    FACT_DATES,
    REACH,
    FilterContext,
    StarModel,
    allowed,
    column_of,
    date_attribute,
    date_column,
    flat,
    month_windows,
    table_of,
)

Ref = Callable[[str], Column]


@dataclass(frozen=True)
class Atom:
    """``kind`` is count (rows), sum (double), isum (long), n (non-null values), max, min, or
    customers (customers with more than ``above`` matching rows).

    Fact rows have unique, non-null ids, so counting rows counts ids without reading them.
    """

    table: str
    kind: str
    value: Callable[[Ref], Column] | None = None
    where: Callable[[Ref], Column] | None = None
    above: int = 0

    def refs(self) -> tuple[set[str], set[str]]:
        """Columns read, and columns whose outside selection the condition replaces."""
        read: set[str] = set()
        replaced: set[str] = set()
        if self.value:
            self.value(lambda r: (read.add(r), F.lit(1))[1])
        if self.where:
            self.where(lambda r: (replaced.add(r), F.lit(1))[1])
        return read | replaced, replaced

    def first(self, ref: Ref, within: Column) -> Column:
        """Aggregate over rows."""
        condition = within & self.where(ref) if self.where else within
        value = self.value(ref) if self.value else F.lit(1)
        picked = F.when(condition, value)
        if self.kind in ("count", "customers"):
            return F.sum(F.when(condition, F.lit(1)))
        if self.kind == "n":
            return F.sum(F.when(condition & value.isNotNull(), F.lit(1)))
        return {"sum": C.total, "isum": F.sum, "max": F.max, "min": F.min}[self.kind](picked)

    def merge(self, partial: str) -> Column:
        """Aggregate over partial results, one row per customer and group."""
        if self.kind == "customers":
            return F.sum(F.when(F.col(partial) > self.above, F.lit(1)))
        return {"sum": C.total, "max": F.max, "min": F.min}.get(self.kind, F.sum)(F.col(partial))


    def gather(self, partial: str) -> Column:
        """One partial result from several of the same customer and group."""
        return F.sum(F.col(partial)) if self.kind == "customers" else self.merge(partial)


OWNERS = {"dim_date": "dates"}


def _in(table: str):
    """Shorthand for atoms of one table: plain column names inside expressions."""

    def make(kind, value=None, where=None, above=0):
        at = lambda f: (lambda r: f(lambda name: r(f"{table}.{name}"))) if f else None
        owner = "customers" if table in CUSTOMER_TABLES else OWNERS.get(table, table)
        named = (lambda c: c(value)) if isinstance(value, str) else value
        return Atom(owner, kind, at(named), at(where), above)

    return make


_cust, _pred, _bill = _in("dim_customer"), _in("predictions"), _in("billing")
_comp, _net, _date = _in("complaints"), _in("network"), _in("dim_date")
_active = lambda c: c("churn_label") == 0
_p, _mrr = "predictions.churn_probability", "dim_customer.monthly_charges"
_label = "dim_customer.churn_label"
HIGH_RISK = 0.70
CRITICAL_RISK = 0.85
SLA_HOURS = 48
SLA_TARGET = 0.90

ATOMS: dict[str, Atom] = {
    # customers
    "customers": _cust("n", "customer_id"),
    "active_customers": _cust("count", where=_active),
    "churned_customers": _cust("count", where=lambda c: c("churn_label") == 1),
    "active_mrr": _cust("sum", "monthly_charges", _active),
    "tenure_sum": _cust("isum", "tenure_months"),
    "tenure_n": _cust("n", "tenure_months"),
    "exposure": Atom(
        "customers",
        "sum",
        lambda r: F.when(
            r(_label) == 0, F.coalesce(r(_p), F.lit(0)) * F.coalesce(r(_mrr), F.lit(0)) * 12
        ),
    ),
    "high_risk_mrr": Atom(
        "customers", "sum", lambda r: F.when((r(_label) == 0) & (r(_p) >= HIGH_RISK), r(_mrr))
    ),
    # predictions
    "scored": _pred("n", "customer_id"),
    "high_risk_active": _pred(
        "count",
        where=lambda c: (c("actual_churn_label") == 0) & (c("predicted_churn_label") == 1),
    ),
    "critical_active": _pred(
        "count",
        where=lambda c: (c("actual_churn_label") == 0) & (c("churn_probability") >= CRITICAL_RISK),
    ),
    "active_probability": _pred(
        "sum", "churn_probability", lambda c: c("actual_churn_label") == 0
    ),
    "active_probability_n": _pred(
        "n", "churn_probability", lambda c: c("actual_churn_label") == 0
    ),
    "expected_churners": Atom(
        "customers",
        "sum",
        lambda r: F.when(r("predictions.actual_churn_label") == 0, r(_p)),
    ),
    "false_negatives": _pred(
        "count",
        where=lambda c: (c("actual_churn_label") == 1) & (c("predicted_churn_label") == 0),
    ),
    "actual_churners_scored": _pred("count", where=lambda c: c("actual_churn_label") == 1),
    # retention
    "predicted_risk_revenue": _in("retention")("sum", "predicted_revenue_at_risk"),
    # billing
    "invoices": _bill("count"),
    "unpaid": _bill("isum", "is_unpaid"),
    "paid": _bill("isum", "is_paid"),
    "late": _bill("isum", "is_late"),
    "billed": _bill("sum", "total_amount"),
    "billed_n": _bill("n", "total_amount"),
    "collected": _bill("sum", "total_amount", lambda c: c("is_unpaid") == 0),
    "outstanding": _bill("sum", "total_amount", lambda c: c("is_unpaid") == 1),
    "discounts": _bill("sum", "discount_amount"),
    "gross_monthly": _bill("sum", "monthly_charges"),
    "gross_usage": _bill("sum", "usage_charges"),
    # complaints
    "complaints": _comp("count"),
    "complaining_customers": _comp("customers"),
    "repeat_customers": _comp("customers", above=1),
    "resolved": _comp("count", where=lambda c: c("is_unresolved") == 0),
    "unresolved": _comp("isum", "is_unresolved"),
    "critical": _comp("isum", "is_critical"),
    "escalated": _comp("isum", "is_escalated"),
    "within_sla": _comp(
        "count",
        where=lambda c: (c("is_unresolved") == 0) & (c("resolution_hours") <= SLA_HOURS),
    ),
    "resolution_sum": _comp("sum", "resolution_hours", lambda c: c("is_unresolved") == 0),
    "resolution_n": _comp("n", "resolution_hours", lambda c: c("is_unresolved") == 0),
    "satisfaction_sum": _comp("isum", "satisfaction_score"),
    "satisfaction_n": _comp("n", "satisfaction_score"),
    # network
    "events": _net("count"),
    "incidents": _net("count", where=lambda c: F.lower(c("event_type")) != "normal"),
    "affected": _net("customers", where=lambda c: F.lower(c("event_type")) != "normal"),
    "outages": _net("isum", "is_outage"),
    "degraded": _net("isum", "is_degraded"),
    "outage_minutes": _net("isum", "outage_minutes"),
    "latency_sum": _net("sum", "latency_ms"),
    "latency_n": _net("n", "latency_ms"),
    "loss_sum": _net("sum", "packet_loss_pct"),
    "loss_n": _net("n", "packet_loss_pct"),
    "speed_sum": _net("sum", "download_speed_mbps"),
    "speed_n": _net("n", "download_speed_mbps"),
    # dates
    "first_day": _date("min", "full_date"),
    "last_day": _date("max", "full_date"),
    # computed by its own two-step query, see _high_value_high_risk
    "high_value_high_risk": Atom("special", "count"),
}

# ------------------------------------------------------------------------------ expressions

_r = C.ratio


def _mom(atom):
    return lambda g: _r(g(atom, "latest") - g(atom, "previous"), g(atom, "previous"))


def _high_risk_rate(g):
    return _r(g("high_risk_active"), g("active_customers"))


def _collection(g, w=None):
    return _r(g("collected", w), g("billed", w))


def _health_inputs(g, w):
    return (
        _r(F.coalesce(g("incidents", w), F.lit(0)), g("events", w)),
        _r(g("latency_sum", w), g("latency_n", w)),
        _r(g("loss_sum", w), g("loss_n", w)),
        _r(g("speed_sum", w), g("speed_n", w)),
    )


def network_health(g, w=None):
    """Health 0..100 of the current events; NULL when there are none."""
    inputs = _health_inputs(g, w)
    return F.when(C.all_of([i.isNotNull() for i in inputs]), kpi.health(*inputs))


def network_health_blank_as_zero(g, w=None):
    """The same with missing inputs read as 0, which scores an empty selection 85."""
    return kpi.health(*[F.coalesce(i, F.lit(0.0)) for i in _health_inputs(g, w)])


def _steps(value: Column, steps, otherwise: str) -> Column:
    """Threshold label; a blank value compares as 0."""
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    return C.first_match([(test(v), label) for test, label in steps], otherwise)


def _decimal(value: Column, pattern: str) -> Column:
    """Formatted number; NULL stays NULL, which plain formatting would print as text."""
    return F.when(value.isNotNull(), F.format_string(pattern, value))


def _signed_pct(value: Column) -> Column:
    sign = F.when(value > 0, "+").when(value < 0, "-").otherwise("")
    return F.concat(sign, _decimal(F.abs(value) * 100, "%.1f%%"))


def _period(g):
    return F.concat(
        F.date_format(g("first_day"), "dd MMM yyyy"),
        F.lit(" — "),
        F.date_format(g("last_day"), "dd MMM yyyy"),
    )


GOOD, WARN, BAD = "#23C483", "#FFB020", "#FF3B3B"
_at_least = lambda x: (lambda v: v >= x)
_at_most = lambda x: (lambda v: v <= x)

# number -> (column name, expression over g(atom, window))
MEASURES: dict[int, tuple[str, Callable]] = {
    1: ("total_customers", lambda g: g("customers")),
    2: ("active_customers", lambda g: g("active_customers")),
    3: ("actual_churn_rate_pct", lambda g: _r(g("churned_customers"), g("customers"))),
    4: ("high_risk_active_customers", lambda g: g("high_risk_active")),
    5: ("active_mrr", lambda g: g("active_mrr")),
    6: ("risk_adjusted_arr_exposure", lambda g: g("exposure")),
    7: ("collection_rate_pct", _collection),
    8: ("network_health_score", network_health),
    9: ("churned_customers", lambda g: g("churned_customers")),
    10: ("active_customer_rate_pct", lambda g: _r(g("active_customers"), g("customers"))),
    11: ("average_customer_tenure_months", lambda g: _r(g("tenure_sum"), g("tenure_n"))),
    12: ("active_arpu", lambda g: _r(g("active_mrr"), g("active_customers"))),
    13: ("active_arr", lambda g: g("active_mrr") * 12),
    14: ("scored_customers", lambda g: g("scored")),
    15: ("prediction_coverage_pct", lambda g: _r(g("scored"), g("customers"))),
    16: ("critical_risk_active_customers", lambda g: g("critical_active")),
    17: ("high_risk_active_rate_pct", _high_risk_rate),
    18: (
        "average_active_churn_probability_pct",
        lambda g: _r(g("active_probability"), g("active_probability_n")),
    ),
    19: ("expected_active_churners", lambda g: g("expected_churners")),
    20: ("high_risk_active_mrr", lambda g: g("high_risk_mrr")),
    21: ("high_risk_mrr_share_pct", lambda g: _r(g("high_risk_mrr"), g("active_mrr"))),
    22: ("revenue_exposure_pct", lambda g: _r(g("exposure"), g("active_mrr") * 12)),
    23: ("exposure_per_high_risk_customer", lambda g: _r(g("exposure"), g("high_risk_active"))),
    24: ("high_value_high_risk_customers", lambda g: g("high_value_high_risk")),
    25: ("total_invoices", lambda g: g("invoices")),
    26: ("unpaid_invoices", lambda g: g("unpaid")),
    27: ("total_billed_revenue", lambda g: g("billed")),
    28: ("collected_revenue", lambda g: g("collected")),
    29: ("outstanding_revenue", lambda g: g("outstanding")),
    30: ("outstanding_revenue_pct", lambda g: _r(g("outstanding"), g("billed"))),
    31: ("on_time_payment_rate_pct", lambda g: _r(g("paid"), g("invoices"))),
    32: ("late_invoice_rate_pct", lambda g: _r(g("late"), g("invoices"))),
    33: ("average_invoice_value", lambda g: _r(g("billed"), g("billed_n"))),
    34: ("discount_rate_pct", lambda g: _r(g("discounts"), g("gross_monthly") + g("gross_usage"))),
    35: ("billed_revenue_latest_month", lambda g: g("billed", "latest")),
    36: ("billed_revenue_previous_month", lambda g: g("billed", "previous")),
    37: ("billed_revenue_mom_pct", _mom("billed")),
    38: ("billed_revenue_rolling_3m_average", lambda g: _r(g("billed", "rolling3"), 3)),
    39: ("billed_revenue_ytd", lambda g: g("billed", "ytd")),
    40: ("outstanding_revenue_latest_month", lambda g: g("outstanding", "latest")),
    41: ("outstanding_revenue_previous_month", lambda g: g("outstanding", "previous")),
    42: ("outstanding_revenue_mom_pct", _mom("outstanding")),
    43: ("collection_rate_latest_month_pct", lambda g: _collection(g, "latest")),
    44: ("collection_rate_previous_month_pct", lambda g: _collection(g, "previous")),
    45: (
        "collection_rate_change_pp",
        lambda g: 100 * (_collection(g, "latest") - _collection(g, "previous")),
    ),
    46: ("total_complaints", lambda g: g("complaints")),
    47: ("customers_with_complaints", lambda g: g("complaining_customers")),
    48: ("complaints_per_1k_customers", lambda g: 1000 * _r(g("complaints"), g("customers"))),
    49: ("resolved_complaints", lambda g: g("resolved")),
    50: ("unresolved_complaints", lambda g: g("unresolved")),
    51: ("unresolved_complaint_rate_pct", lambda g: _r(g("unresolved"), g("complaints"))),
    52: ("critical_complaint_rate_pct", lambda g: _r(g("critical"), g("complaints"))),
    53: ("escalation_rate_pct", lambda g: _r(g("escalated"), g("complaints"))),
    54: ("sla_compliance_48h_pct", lambda g: _r(g("within_sla"), g("resolved"))),
    55: ("average_resolution_hours", lambda g: _r(g("resolution_sum"), g("resolution_n"))),
    56: ("average_satisfaction_score", lambda g: _r(g("satisfaction_sum"), g("satisfaction_n"))),
    57: (
        "repeat_complainer_rate_pct",
        lambda g: _r(g("repeat_customers"), g("complaining_customers")),
    ),
    58: ("complaints_latest_month", lambda g: g("complaints", "latest")),
    59: ("complaints_previous_month", lambda g: g("complaints", "previous")),
    60: ("complaints_mom_pct", _mom("complaints")),
    61: ("complaints_rolling_3m_average", lambda g: _r(g("complaints", "rolling3"), 3)),
    62: ("unresolved_complaints_latest_month", lambda g: g("unresolved", "latest")),
    63: ("unresolved_complaints_previous_month", lambda g: g("unresolved", "previous")),
    64: ("unresolved_complaints_mom_pct", _mom("unresolved")),
    65: ("total_network_events", lambda g: g("events")),
    66: ("network_incidents", lambda g: g("incidents")),
    67: ("network_incident_rate_pct", lambda g: _r(g("incidents"), g("events"))),
    68: ("incident_affected_customers", lambda g: g("affected")),
    69: ("outage_events", lambda g: g("outages")),
    70: ("degraded_events", lambda g: g("degraded")),
    71: ("total_outage_minutes", lambda g: g("outage_minutes")),
    72: ("average_outage_duration_minutes", lambda g: _r(g("outage_minutes"), g("outages"))),
    73: ("average_latency_ms", lambda g: _r(g("latency_sum"), g("latency_n"))),
    74: ("average_packet_loss_pct", lambda g: _r(g("loss_sum"), g("loss_n"))),
    75: ("average_download_speed_mbps", lambda g: _r(g("speed_sum"), g("speed_n"))),
    76: ("network_health_latest_month", lambda g: network_health(g, "latest")),
    77: ("network_health_previous_month", lambda g: network_health(g, "previous")),
    78: (
        "network_health_change_points",
        lambda g: network_health(g, "latest") - network_health(g, "previous"),
    ),
    79: ("outage_minutes_latest_month", lambda g: g("outage_minutes", "latest")),
    80: ("outage_minutes_previous_month", lambda g: g("outage_minutes", "previous")),
    81: ("outage_minutes_mom_pct", _mom("outage_minutes")),
    # 82-87, 90 and 91 read the model tables, see model_measures
    88: ("false_negative_customers", lambda g: g("false_negatives")),
    89: ("false_negative_rate_pct", lambda g: _r(g("false_negatives"), g("actual_churners_scored"))),
    92: ("selected_period_label", _period),
    93: ("latest_visible_month_label", lambda g: F.date_format(g("last_day"), "MMM yyyy")),
    94: (
        "executive_subtitle",
        lambda g: F.concat(
            _period(g),
            F.lit("  |  "),
            F.format_number(F.coalesce(g("customers"), F.lit(0)), 0),
            F.lit(" customers"),
        ),
    ),
    95: (
        "revenue_trend_label",
        lambda g: F.coalesce(
            F.concat(_signed_pct(_mom("billed")(g)), F.lit(" vs prior month")),
            F.lit("No prior month"),
        ),
    ),
    96: (
        "churn_risk_status",
        lambda g: _steps(
            _high_risk_rate(g), [(_at_least(0.20), "Critical"), (_at_least(0.10), "Watch")], "Stable"
        ),
    ),
    97: (
        "network_health_status",
        lambda g: _steps(
            network_health(g, "latest"), [(_at_least(80), "Healthy"), (_at_least(65), "Watch")], "Critical"
        ),
    ),
    98: ("revenue_trend_color", lambda g: _steps(_mom("billed")(g), [(_at_least(0), GOOD)], BAD)),
    99: (
        "churn_risk_color",
        lambda g: _steps(_high_risk_rate(g), [(_at_least(0.20), BAD), (_at_least(0.10), WARN)], GOOD),
    ),
    100: (
        "collection_rate_color",
        lambda g: _steps(
            _collection(g, "latest"), [(_at_least(0.90), GOOD), (_at_least(0.80), WARN)], BAD
        ),
    ),
    101: (
        "complaint_trend_color",
        lambda g: _steps(_mom("complaints")(g), [(_at_most(0), GOOD), (_at_most(0.10), WARN)], BAD),
    ),
    102: (
        "network_health_color",
        lambda g: _steps(
            network_health(g, "latest"), [(_at_least(80), GOOD), (_at_least(65), WARN)], BAD
        ),
    ),
    103: (
        "customer_overview_subtitle",
        lambda g: F.concat(
            F.lit("Average Tenure: "),
            _decimal(_r(g("tenure_sum"), g("tenure_n")), "%.1f"),
            F.lit(" Months"),
        ),
    ),
    104: (
        "internet_service_mix_pct",
        lambda g: _r(
            g("customers"), g("customers", remove=("dim_customer.internet_service",))
        ),
    ),
    105: ("collected_invoices", lambda g: g("invoices") - g("unpaid")),
    106: ("on_time_invoices", lambda g: g("paid")),
    # 107 is the funnel, see funnel
    108: ("sla_gauge_minimum", lambda g: F.lit(0.0)),
    109: ("sla_gauge_maximum", lambda g: F.lit(1.0)),
    110: ("sla_target_pct", lambda g: F.lit(SLA_TARGET)),
}
NUMBER = {name: n for n, (name, _) in MEASURES.items()}

# Beyond the numbered list: the retention visual's plain sum, and the blank-as-zero health.
EXTRA = {
    "predicted_revenue_at_risk": lambda g: g("predicted_risk_revenue"),
    "network_health_blank_as_zero": network_health_blank_as_zero,
}


def expression(name: str) -> Callable:
    return EXTRA[name] if name in EXTRA else MEASURES[NUMBER[name]][1]


# --------------------------------------------------------------------------------- queries


def _names(by: Sequence[str]) -> list[str]:
    plain = [column_of(r) for r in by]
    return [n if plain.count(n) == 1 else flat(r) for n, r in zip(plain, by)]


def query(
    model: StarModel,
    names: Sequence[str],
    by: Sequence[str] = (),
    ctx: FilterContext = FilterContext(),
    windows: bool = False,
) -> DataFrame:
    """The named measures per group of ``by`` columns (``table.column``) within a context.

    With ``windows``, ``MONTH`` must be among ``by``; every month then also stands for its windows,
    as keys of ``window_keys``.
    """
    wanted: dict[tuple, str] = {}

    def g(atom, window=None, remove=()):
        key = (atom, window, frozenset(remove))
        return F.col(wanted.setdefault(key, f"_a{len(wanted)}"))

    results = [expression(n)(g).alias(n) for n in names]
    if any(w for _, w, _ in wanted) and any(table_of(r) == "dim_date" for r in by):
        raise ValueError("month windows have their own date axis: use series() for a time line")
    out_names = _names(by)

    # atoms that share table, group columns and selections are computed together
    plans: dict[tuple, dict[str, tuple[Atom, str | None]]] = {}
    for (name, window, removed), alias in wanted.items():
        atom = ATOMS[name]
        replaced = atom.refs()[1] | removed
        reach = REACH["customers" if atom.table == "special" else atom.table]
        keys = tuple(r for r in by if table_of(r) in reach and r not in replaced)
        picks = tuple(r for r in ctx.filters if table_of(r) in reach and r not in replaced)
        plans.setdefault((atom.table, keys, picks), {})[alias] = (atom, window)

    if not plans:
        # constants only: one row per context, read from the calendar
        return model.dates(ctx).limit(1).select(*results)

    whole, partial = [], []
    for (table, keys, picks), atoms in plans.items():
        frame = (
            _high_value_high_risk(model, keys, ctx, next(iter(atoms)))
            if table == "special"
            else _aggregate(model, table, atoms, keys, picks, ctx, windows and MONTH in keys)
        )
        (whole if keys == tuple(by) else partial).append((keys, frame, list(atoms)))
    if not whole:
        table = next((t for t, _, _ in plans if set(map(table_of, by)) <= set(REACH.get(t, ()))), None)
        if table is None:
            raise ValueError(f"no table of {list(names)} can be grouped by {list(by)}")
        groups = {"_rows": (Atom(table, "count"), None)}
        picks = tuple(r for r in ctx.filters if table_of(r) in REACH[table])
        whole.append((tuple(by), _aggregate(model, table, groups, tuple(by), picks, ctx), []))

    merged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [f for _, f, _ in whole]
    )
    if len(whole) > 1:
        columns = [c for c in merged.columns if c not in [flat(r) for r in by]]
        merged = merged.groupBy(*[flat(r) for r in by]).agg(*[F.max(c).alias(c) for c in columns])
    for keys, frame, aliases in partial:
        merged = _spread(merged, frame, [flat(r) for r in keys], aliases)
    renamed = merged.withColumnsRenamed({flat(r): n for r, n in zip(by, out_names)})
    return renamed.select(*out_names, *results)


def _spread(groups: DataFrame, totals: DataFrame, keys: Sequence[str], aliases: Sequence[str]) -> DataFrame:
    """Repeat totals of coarser groups on every finer group; NULL keys match NULL."""
    if not keys:
        return groups.withColumns({a: totals.select(a).scalar() for a in aliases})
    right = totals.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = C.all_of([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return groups.join(right, condition, "left").drop(*[f"_k_{k}" for k in keys])


def _selected(refs: Sequence[str], ctx: FilterContext, at: Ref) -> Column:
    return C.all_of([allowed(at(r), ctx.filters[r]) for r in refs])


def _aggregate(
    model: StarModel,
    table: str,
    atoms: dict[str, tuple[Atom, str | None]],
    keys: Sequence[str],
    picks: Sequence[str],
    ctx: FilterContext,
    windows: bool = False,
) -> DataFrame:
    """Atoms of one table per group; columns are the flattened keys and the atom aliases."""
    key_names = [flat(r) for r in keys]
    if windows and table in ("dates", "customers"):
        raise ValueError(f"no month windows over {table}")
    if table == "dates":
        at = lambda r: F.col(column_of(r))
        rows = model.dates(ctx).filter(_selected(picks, ctx, at))
        return rows.groupBy(*[at(r).alias(flat(r)) for r in keys]).agg(
            *[a.first(at, F.lit(True)).alias(n) for n, (a, _) in atoms.items()]
        )
    if table == "customers":
        at = lambda r: F.col(flat(r))
        refs = set(keys) | set(picks)
        for atom, _ in atoms.values():
            refs |= atom.refs()[0]
        rows = model.customers(sorted(refs) or ["dim_customer.customer_id"])
        rows = rows.filter(_selected(picks, ctx, at))
        return rows.groupBy(*key_names).agg(
            *[a.first(at, F.lit(True)).alias(n) for n, (a, _) in atoms.items()]
        )
    return _aggregate_fact(model, table, atoms, keys, picks, ctx, windows)


def _aggregate_fact(model, table, atoms, keys, picks, ctx, windows=False) -> DataFrame:
    own = lambda r: F.col(column_of(r))
    dated = lambda r: date_attribute(column_of(r)) if table_of(r) == "dim_date" else own(r)
    near = [r for r in (*keys, *picks) if table_of(r) in (table, "dim_date")]
    place = [r for r in (*keys, *picks) if table_of(r) == "dim_network_location"]
    person = [r for r in (*keys, *picks) if table_of(r) in CUSTOMER_TABLES]

    rows, within = _windowed(model.fact(table, ctx), model, table, {w for _, w in atoms.values()}, ctx)
    rows = rows.filter(_selected([r for r in picks if r in near], ctx, dated))
    key_columns = {flat(r): dated(r) for r in keys if r in near}
    partials = [a.first(own, within[w]).alias(n) for n, (a, w) in atoms.items()]

    per_customer = bool(person) or any(a.kind == "customers" for a, _ in atoms.values())
    extra = (["customer_id"] if per_customer else []) + (["location_key"] if place else [])
    grouped = rows.groupBy(*extra, *[c.alias(n) for n, c in key_columns.items()]).agg(*partials)
    if windows:
        # partial results per month (and customer) go to every window that holds the month
        month = flat(MONTH)
        spread = grouped.withColumn(month, F.explode(window_keys(F.col(month))))
        grouped = spread.groupBy(*extra, *key_columns).agg(*[a.gather(n).alias(n) for n, (a, _) in atoms.items()])
    if not extra:
        return grouped

    far = lambda r: F.col(flat(r))
    if place:
        columns = sorted({column_of(r) for r in place})
        names = [F.col(c).alias(flat(f"dim_network_location.{c}")) for c in columns]
        # 14 fixed rows
        locations = model.table("dim_network_location").select(F.col("location_key").alias("_loc"), *names)
        grouped = grouped.join(
            F.broadcast(locations), F.col("location_key") == F.col("_loc"), "left"
        )
    if person:
        grouped = grouped.join(model.customers(person), "customer_id", "left")
    grouped = grouped.filter(_selected([r for r in picks if r not in near], ctx, far))
    return grouped.groupBy(*[flat(r) for r in keys]).agg(
        *[a.merge(n).alias(n) for n, (a, _) in atoms.items()]
    )


def _windowed(rows: DataFrame, model, table, windows, ctx) -> tuple[DataFrame, dict]:
    """Rows cut to the days that any window needs, and the condition of each window.

    The cut is repeated on the month key, so that only the months' partitions are read; they follow
    the first date role only.
    """
    day = F.col("_day")
    to_date = lambda text: dt.date.fromisoformat(text) if text else None
    spans = {None: (to_date(ctx.date_from), to_date(ctx.date_to))} if None in windows else {}
    if windows - {None}:
        anchor = model.anchor_day(ctx, table)
        if anchor is None:
            # no day selected: every window is empty
            spans.update({w: (dt.date.max, dt.date.min) for w in windows if w})
        else:
            spans.update({w: s for w, s in month_windows(anchor).items() if w in windows})
    within = {
        w: C.all_of([day >= F.lit(lo)] * bool(lo) + [day <= F.lit(hi)] * bool(hi))
        for w, (lo, hi) in spans.items()
    }
    month = lambda d: F.lit(d.year * 100 + d.month)
    lows, highs = [lo for lo, _ in spans.values()], [hi for _, hi in spans.values()]
    partitioned = date_column(table, ctx) == FACT_DATES[table]
    if all(lows):
        rows = rows.filter(day >= F.lit(min(lows)))
        rows = rows.filter(F.col("month_key") >= month(min(lows))) if partitioned else rows
    if all(highs):
        rows = rows.filter(day <= F.lit(max(highs)))
        rows = rows.filter(F.col("month_key") <= month(max(highs))) if partitioned else rows
    return rows, within


def _high_value_high_risk(model, keys, ctx, alias) -> DataFrame:
    """Active customers at high risk who pay at least the ARPU of their own group.

    Customers collapse to one row per group and charge before the ARPU is joined on.
    """
    names = [flat(r) for r in keys]
    picks = [r for r in ctx.filters if table_of(r) in REACH["customers"]]
    rows = model.customers([_label, _mrr, _p, *keys, *picks])
    at = lambda r: F.col(flat(r))
    candidates = (
        rows.filter(_selected(picks, ctx, at))
        .filter((at(_label) == 0) & (at(_p) >= HIGH_RISK))
        .groupBy(*names, at(_mrr).alias("_charge"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    arpu = query(model, ["active_arpu"], keys, ctx)
    if not keys:
        return candidates.filter(F.col("_charge") >= arpu.scalar()).agg(F.sum("_n").alias(alias))
    arpu = arpu.withColumnsRenamed(dict(zip(_names(keys), names)))
    joined = _spread(candidates, arpu, names, ["active_arpu"])
    return (
        joined.filter(F.col("_charge") >= F.col("active_arpu"))
        .groupBy(*names)
        .agg(F.sum("_n").alias(alias))
    )


MONTH = "dim_date.year_month_sort"
# What a month's key plus so many millions stands for: the month, three months up to it, its year so far.
_KINDS = {"value": 0, "rolling": 1_000_000, "year_to_date": 2_000_000}
ROLLING_MONTHS = 3


def window_keys(month: Column) -> Column:
    """The months whose windows hold a month, as coded keys; ``month`` is yyyymm."""
    index = F.floor(month / 100) * 12 + month % 100 - 1
    key = lambda i: (F.floor(i / 12) * 100 + i % 12 + 1).cast("long")
    last = F.floor(index / 12) * 12 + 11
    spans = {"value": index, "rolling": index + (ROLLING_MONTHS - 1), "year_to_date": last}
    coded = lambda until, code: F.transform(F.sequence(index, until), lambda i: key(i) + code)
    return F.concat(*(coded(spans[kind], code) for kind, code in _KINDS.items()))


def additive(name: str) -> bool:
    """Whether months of a measure add up: it is one sum or count of rows."""
    atoms: list[str] = []
    expression(name)(lambda atom, window=None, remove=(): (atoms.append(atom), F.lit(1))[1])
    return len(atoms) == 1 and ATOMS[atoms[0]].kind in ("sum", "isum", "count", "n")


def series(
    model: StarModel,
    name: str,
    by: Sequence[str] = (),
    ctx: FilterContext = FilterContext(),
) -> DataFrame:
    """A measure per calendar month with its time intelligence (TI-1 to TI-5).

    Months without rows are part of the line: they count as a month for previous, rolling and
    year-to-date values. The line covers the months of the selected calendar days. Rates, averages
    and distinct counts are evaluated over all rows of a window, in one pass over the facts; sums
    and counts add up their months, and their rolling value is the average month.
    """
    names = _names(by)
    adds = additive(name)
    found = query(model, [name], [*by, MONTH], ctx, windows=not adds)
    found = found.withColumnsRenamed({n: f"_b_{n}" for n in names})
    month_of = F.col("year_month_sort")
    months = model.dates(ctx).agg(
        F.trunc(F.min("full_date"), "MM").alias("lo"), F.trunc(F.max("full_date"), "MM").alias("hi")
    )
    if by:
        # one row: the line's ends are aggregates of the calendar
        groups = found.select(*[F.col(f"_b_{n}").alias(n) for n in names]).distinct()
        low, high = months.select("lo").scalar(), months.select("hi").scalar()
        line = groups.withColumns({"lo": low, "hi": high})
    else:
        line = months
    line = line.select(*names, F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("_month"))
    line = line.withColumn("_key", C.month_key("_month").cast("long"))

    # coded keys of one month and group meet in one row
    kind = {k: F.max(F.when(F.floor(month_of / 1_000_000) * 1_000_000 == code, F.col(name).cast("double"))).alias(f"_{k}") for k, code in _KINDS.items()}
    own = found.groupBy(*[f"_b_{n}" for n in names], (month_of % 1_000_000).cast("long").alias("_of")).agg(*kind.values())
    match = C.all_of([F.col("_key") == F.col("_of")] + [F.col(n).eqNullSafe(F.col(f"_b_{n}")) for n in names])
    # windows run over months of one group: a calendar bounds their length
    ordered = W.partitionBy(*names).orderBy("_key")
    in_year = W.partitionBy(*names, F.year("_month")).orderBy("_key")
    value = F.col("_value")
    rolling, to_date = F.col("_rolling"), F.col("_year_to_date")
    if adds:
        rolling = F.sum(value).over(ordered.rowsBetween(1 - ROLLING_MONTHS, 0)) / ROLLING_MONTHS
        to_date = F.sum(value).over(in_year.rowsBetween(W.unboundedPreceding, 0))
    return (
        line.join(own, match, "left")
        .withColumns(
            {
                "value": value,
                "previous_month": F.lag(value).over(ordered),
                "rolling_3m_average": rolling,
                "year_to_date": to_date,
            }
        )
        .select(
            *names,
            F.date_format("_month", "yyyy-MM").alias("year_month"),
            "value",
            "previous_month",
            C.ratio(F.col("value") - F.col("previous_month"), F.col("previous_month")).alias("mom_pct"),
            "rolling_3m_average",
            "year_to_date",
        )
    )


def funnel(model: StarModel, stages: DataFrame, ctx: FilterContext = FilterContext()) -> DataFrame:
    """Invoice funnel (M107, J13): one aggregate row turned into one row per stage."""
    columns = {
        "total_invoices": "Total Invoices",
        "collected_invoices": "Collected Invoices",
        "on_time_invoices": "On-Time Invoices",
    }
    values = query(model, list(columns), ctx=ctx).withColumnsRenamed(columns)
    long = values.unpivot([], list(columns.values()), "stage", "invoice_funnel_value")
    return long.join(stages, "stage")


def share_of_parent(df: DataFrame, value: str, parent: Sequence[str], name: str = "share") -> DataFrame:
    """Each row's part of the total over its parent keys (A20). ``df`` is evaluated once: its rows
    are groups, and the parent's total is a window over those that share it."""
    if not parent:
        return df.withColumn(name, C.ratio(F.col(value), df.agg(F.sum(value).alias("t")).scalar()))
    return df.withColumn(name, C.ratio(F.col(value), F.sum(value).over(W.partitionBy(*parent))))


def drill_down(
    model: StarModel, name: str, levels: Sequence[str], ctx: FilterContext = FilterContext()
) -> DataFrame:
    """An additive measure at every level of a drill path, from grand total to leaf."""
    leaf = query(model, [name], levels, ctx)
    names = _names(levels)
    depth = F.lit(len(names)) - F.bit_count(F.grouping_id())
    return leaf.rollup(*names).agg(depth.cast("int").alias("depth"), C.total(name).alias(name))


def model_measures(performance: DataFrame, importance: DataFrame) -> DataFrame:
    """Values of the latest best model and of its strongest feature."""
    newest = F.struct("evaluation_timestamp", "roc_auc")
    metrics = {
        "latest_best_model": "model_name",
        "latest_model_accuracy_pct": "accuracy",
        "latest_model_precision_pct": "precision",
        "latest_model_recall_pct": "recall",
        "latest_model_f1_pct": "f1_score",
        "latest_model_roc_auc_pct": "roc_auc",
    }
    best = performance.agg(*[F.max_by(c, newest).alias(n) for n, c in metrics.items()])
    driver = importance.orderBy(F.col("importance").desc(), F.col("feature_name")).limit(1)
    return best.withColumns(
        {
            "top_churn_driver": driver.select("feature_name").scalar(),
            "top_driver_importance_pct": importance.agg(F.max("importance").alias("m")).scalar(),
        }
    )
