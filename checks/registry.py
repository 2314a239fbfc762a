"""One registered query per operator: a Spark callable over a warehouse, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from checks.views import avg, div, fl, isum, rnd, tot
from subscope.functions import columns as C
from subscope.operators import conform, enrich, ingest, invoices, kpi, quality, rollup, scoring, star, stats
from subscope.plans import warehouse
from subscope.plans.landing import BATCH_FEEDS, Landing
from subscope.session import work_dir
from subscope.sources import calendars, files, lookups, schemas
from subscope.store import LayerStore, preview
from subscope.streaming import ingest as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that compare alike in any engine; processing stamps are left out."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if name.startswith("_") or name == "prediction_timestamp":
            continue
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)


def add(name: str, build: Callable[[warehouse.Warehouse], DataFrame], sql: str | None = None, extra=None):
    """Register a query over the warehouse of a folder, and its SQL if there is one."""
    assert name not in QUERIES, name
    QUERIES[name] = lambda spark, folder: portable(build(warehouse.of(spark, folder)))
    if sql is not None:
        ORACLE[name] = V.with_views(sql, extra)


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def second(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def table(w: warehouse.Warehouse, name: str) -> DataFrame:
    return w.silver(name) if name.endswith(("_clean", "_summary", "_360")) else w.gold(name)


def _counts_sql(pairs) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS record_count FROM {v}" for n, v in pairs)


# ------------------------------------------------------------------------ sources and sinks


def _written(w, name, write) -> str:
    path = f"{work_dir(w.spark, 'files')}/{name}"
    write(path)
    return path


def _csv(w, raw: str, name: str) -> str:
    df = w.raw(raw)
    columns = [c for c in df.columns if not c.startswith("_")]
    return _written(
        w,
        name,
        lambda p: df.select(*columns)
        .write.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(p),
    )


def _json(w, raw: str, name: str) -> str:
    df = w.raw(raw)
    return _written(w, name, lambda p: df.drop(ingest.VERSION).write.json(p, compression="gzip"))


add(
    "s1_csv_customers",
    lambda w: files.customers(w.spark, _csv(w, "customers_raw", "customers")).withColumn(
        "customerID", F.trim("customerID")
    ),
    "SELECT * REPLACE (trim(customerID) AS customerID) FROM customers_raw",
)
add(
    "s2_json_billing",
    lambda w: files.billing(w.spark, _json(w, "billing_raw", "billing")),
    f"SELECT * EXCLUDE (version) REPLACE ({second('billing_month')} AS billing_month, {second('payment_date')} AS payment_date) FROM billing_raw",
)
add(
    "s3_csv_complaints",
    lambda w: files.complaints(w.spark, _csv(w, "complaints_raw", "complaints")),
    f"SELECT * REPLACE ({second('opened_at')} AS opened_at) FROM complaints_raw",
)
NETWORK_COLUMNS = [f.name for f in schemas.NETWORK_EVENTS.fields]


def _streamed(w) -> DataFrame:
    """Two file drops, one run of the feed after each; the second run must add only new rows."""
    base = work_dir(w.spark, "stream")
    raw = w.raw("network_events_raw").select(*NETWORK_COLUMNS)
    outage = F.col("event_type") == "Outage"
    for part in (raw.filter(~outage), raw.filter(outage)):
        part.write.mode("append").json(f"{base}/landing")
        out = streams.ingest_network_events(
            w.spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", schemas.NETWORK_EVENTS
        )
    return out


add(
    "x1_x2_stream_ingest_two_drops",
    lambda w: _streamed(w).select(
        *NETWORK_COLUMNS,
        F.length("_record_hash").alias("hash_length"),
        F.col("_rescued_data").alias("rescued"),
    ),
    f"""SELECT * REPLACE ({second('event_timestamp')} AS event_timestamp), CAST(64 AS BIGINT) AS hash_length,
    CAST(NULL AS VARCHAR) AS rescued FROM network_raw""",
)
add(
    "s4_stream_latest_micro_batches",
    lambda w: _streamed(w)
    .groupBy("event_type", "_source_system")
    .agg(F.count(F.lit(1)).alias("events"), F.count_distinct("_record_hash").alias("records"))
    .withColumnRenamed("_source_system", "source_system"),
    "SELECT event_type, 'Network Monitoring System' AS source_system, COUNT(*) AS events, COUNT(*) AS records FROM network_raw GROUP BY 1",
)


def _odd_lines(w) -> str:
    raw = w.raw("network_events_raw").select(*NETWORK_COLUMNS)
    odd = F.struct(
        *[c for c in NETWORK_COLUMNS if c != "outage_minutes"],
        F.lit("n/a").alias("outage_minutes"),
        F.lit("v7").alias("firmware"),
    )
    line = F.when(F.col("tower_id") == "TOWER-7", F.to_json(odd)).otherwise(F.to_json(F.struct(*NETWORK_COLUMNS)))
    return _written(w, "odd", lambda p: raw.select(line.alias("value")).write.text(p))


def _rescue(w) -> DataFrame:
    base, landing = work_dir(w.spark, "rescue"), _odd_lines(w)
    stream = streams.json_stream(w.spark, landing, schemas.NETWORK_EVENTS)
    streams.drain(stream, f"{base}/table", f"{base}/checkpoint")
    return w.spark.read.parquet(f"{base}/table").select(
        "event_id", "latency_ms", "outage_minutes", F.col("_rescued_data").alias("rescued")
    )


add(
    "s5_x3_rescued_data",
    _rescue,
    """SELECT event_id, latency_ms, CASE WHEN tower_id <> 'TOWER-7' THEN outage_minutes END AS outage_minutes,
    CASE WHEN tower_id = 'TOWER-7' THEN '{"outage_minutes":"n/a","firmware":"v7"}' END AS rescued FROM network_raw""",
)
add(
    "s6_file_lineage",
    lambda w: ingest.add_metadata(
        files.customers(w.spark, _csv(w, "customers_raw", "crm_export")), "CRM", ingest.new_batch_id()
    )
    .groupBy(F.regexp_extract("_source_file", "(crm_export)", 1).alias("folder"))
    .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("_batch_id").alias("batches")),
    "SELECT 'crm_export' AS folder, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS batches FROM customers_raw",
)
add(
    "s7_table_scan",
    lambda w: w.gold("dim_customer").select("customer_id", "churn_label"),
    "SELECT customer_id, churn_label FROM dim_customer",
)
add(
    "s8_locations",
    lambda w: w.gold("dim_network_location").join(
        w.gold("fact_network_cities").groupBy("location_key").agg(F.count(F.lit(1)).alias("events")),
        "location_key",
        "left",
    ),
    """SELECT CAST(l.location_key AS BIGINT) AS location_key, city, region, CAST(latitude AS DOUBLE) AS latitude,
    CAST(longitude AS DOUBLE) AS longitude, CAST(quality_factor AS DOUBLE) AS quality_factor, state, country,
    location_label, events FROM locations l LEFT JOIN (SELECT location_key, COUNT(*) AS events FROM cities GROUP BY 1) e
    ON l.location_key = e.location_key""",
)
add(
    "s9_priority_lookup",
    lambda w: lookups.priorities(w.spark).join(
        stats.value_counts(table(w, "complaints_clean"), "priority"), "priority", "left"
    ),
    """SELECT p.priority, CAST(priority_sort AS BIGINT) AS priority_sort, count FROM
    (VALUES ('critical', 1), ('high', 2), ('medium', 3), ('low', 4)) p(priority, priority_sort)
    LEFT JOIN (SELECT priority, COUNT(*) AS count FROM complaints GROUP BY 1) c ON p.priority = c.priority""",
)
add(
    "s10_date_spine",
    lambda w: calendars.spine_over([(table(w, "complaints_clean"), "opened_at")]),
    f"""SELECT {day('d')} AS full_date FROM (SELECT unnest(generate_series(MIN(date_trunc('day', opened_at)),
    MAX(date_trunc('day', opened_at)), INTERVAL 1 DAY)) AS d FROM complaints)""",
)
add(
    "s11_p32_calendar",
    lambda w: calendars.calendar_for(table(w, "complaints_clean"), "opened_at"),
    f"""SELECT {day('d')} AS date, year(d) AS year, month(d) AS month_no, monthname(d) AS month,
    quarter(d) AS quarter_no, 'Qtr ' || quarter(d) AS quarter, day(d) AS day FROM
    (SELECT unnest(generate_series(make_timestamp(lo, 1, 1, 0, 0, 0), make_timestamp(hi, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS d
    FROM (SELECT MIN(year(opened_at)) AS lo, MAX(year(opened_at)) AS hi FROM complaints))""",
)


def _adhoc(w) -> DataFrame:
    w.gold("fact_billing").createOrReplaceTempView("adhoc_billing")
    w.gold("dim_customer").createOrReplaceTempView("adhoc_customer")
    return w.spark.sql(
        "SELECT c.contract_type, COUNT(*) AS invoices, SUM(b.is_unpaid) AS unpaid "
        "FROM adhoc_billing b JOIN adhoc_customer c ON b.customer_key = c.customer_key GROUP BY c.contract_type"
    )


add(
    "s12_adhoc_sql",
    _adhoc,
    f"""SELECT contract_type, COUNT(*) AS invoices, {isum('is_unpaid')} AS unpaid FROM billing b
    JOIN dim_customer c ON b.customer_id = c.customer_id GROUP BY 1""",
)
add(
    "s13_prepare_crm",
    lambda w: files.prepare_crm(
        w.raw("customers_raw").withColumn(
            "MonthlyCharges",
            F.when(F.col("tenure") == 0, "n/a").otherwise(F.col("MonthlyCharges").cast("string")),
        )
    ).select(F.trim("customerID").alias("customer_id"), "MonthlyCharges", "churn_flag"),
    f"""SELECT trim(customerID) AS customer_id, CASE WHEN tenure = 0 THEN
    (SELECT median(MonthlyCharges) FROM customers_raw WHERE tenure <> 0) ELSE MonthlyCharges END AS "MonthlyCharges",
    {fl("Churn = 'Yes'")} AS churn_flag FROM customers_raw""",
)


def _scratch(w) -> LayerStore:
    root = work_dir(w.spark, "store")
    return LayerStore(w.spark, root, f"scratch_{root.rsplit('-', 1)[1]}").create_layers()


def _k1(w) -> DataFrame:
    store, dim = _scratch(w), w.gold("dim_customer")
    store.write(dim.select("customer_id"), "gold", "t")
    return store.write(dim.select("customer_id", "contract_type", "monthly_charges"), "gold", "t")


def _k3(w) -> DataFrame:
    store, dim = _scratch(w), w.gold("dim_customer").select("customer_id", "churn_label")
    store.write(dim, "gold", "t")
    store.backup_if_absent("gold", "t", "backup")
    store.write(dim.filter("churn_label = 1"), "gold", "t")
    store.backup_if_absent("gold", "t", "backup")
    return store.first_existing("gold", ["t_backup", "t"])


def _k4(w) -> DataFrame:
    store, dim = _scratch(w), w.gold("dim_customer").select("customer_id", "monthly_charges")
    store.write(dim, "gold", "t")
    return store.write(store.read("gold", "t").filter("monthly_charges >= 0"), "gold", "t")


def _k2(w) -> DataFrame:
    store, dim = _scratch(w), w.gold("dim_customer").select("customer_id", "churn_label")
    store.append(dim.filter("churn_label = 0"), "gold", "t")
    return store.append(dim.filter("churn_label = 1"), "gold", "t")


def _k8(w) -> DataFrame:
    names = [n for n, _ in COUNTS]
    for n in names:
        w.silver(n)
    rows = [(n, w.store.written[w.store.name("silver", n)]) for n in names]
    return w.spark.createDataFrame(rows, "table_name string, record_count long")


add("k1_overwrite_schema", _k1, "SELECT customer_id, contract_type, monthly_charges FROM dim_customer")
add("k2_append", _k2, "SELECT customer_id, churn_label FROM dim_customer")
add("k3_k5_backup_and_restore", _k3, "SELECT customer_id, churn_label FROM dim_customer")
add("k4_replace_from_itself", _k4, "SELECT customer_id, monthly_charges FROM dim_customer WHERE monthly_charges >= 0")


def _k6(w) -> DataFrame:
    store = _scratch(w)
    store.write(w.gold("dim_customer").groupBy("contract_type").count(), "gold", "contracts")
    store.write(w.gold("dim_customer").select("customer_id"), "silver", "ids")
    return store.listing()


add("k6_k7_layer_listing", _k6)


def _landed(w) -> Landing:
    """The given tables as raw files, ingested to bronze."""
    folder = work_dir(w.spark, "landing")
    for table, name, kind in [
        ("customers_raw", "customers", "csv"),
        ("billing_raw", "billing", "json"),
        ("complaints_raw", "complaints", "csv"),
        ("network_events_raw", "network_events", "json"),
    ]:
        df = w.raw(table).drop(ingest.VERSION)
        if kind == "csv":
            options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "ignoreTrailingWhiteSpace": False, "compression": "gzip"}
            df.write.options(**options).csv(f"{folder}/{name}")
        else:
            df.write.json(f"{folder}/{name}", compression="gzip")
    return Landing(w.spark, folder, _scratch(w)).ingest()


# Rows of one batch share their arrival time, so the record hash decides between versions.
_HASHED = "||'||'||".join(
    f"COALESCE(CAST({c} AS VARCHAR), '')"
    for c in [
        "invoice_id", "customerID", "CAST(billing_month AS TIMESTAMP)", "MonthlyCharges", "usage_charges", "discount_amount",
        "tax_amount", "total_amount", "PaymentMethod", "payment_status", "CAST(payment_date AS TIMESTAMP)",
    ]
)
add(
    "k1_s2_p1_w1_files_to_clean_billing",
    lambda w: _landed(w).warehouse().silver("billing_clean").select(
        "invoice_id", "customer_id", "billing_month", "total_amount", "payment_status", "is_unpaid"
    ),
    f"""SELECT invoice_id, customerID AS customer_id, {day('billing_month')} AS billing_month, total_amount,
    lower(trim(payment_status)) AS payment_status, {fl("lower(trim(payment_status)) = 'unpaid'")} AS is_unpaid
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_id ORDER BY sha256({_HASHED})) AS rn FROM billing_raw)
    WHERE rn = 1 AND MonthlyCharges >= 0 AND usage_charges >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND total_amount >= 0""",
)
add(
    "a18_bronze_counts",
    lambda w: (lambda l: quality.layer_counts({n: l.bronze(n) for n in (*BATCH_FEEDS, "network_events_raw")}))(_landed(w)),
    _counts_sql([("customers_raw", "customers_raw"), ("billing_raw", "billing_raw"), ("complaints_raw", "complaints_raw"), ("network_events_raw", "network_raw")]),
)
COUNTS = [
    ("customers_clean", "customers"),
    ("billing_clean", "billing"),
    ("complaints_clean", "complaints"),
    ("network_events_clean", "network"),
    ("customer_billing_summary", "billing_summary"),
    ("customer_complaints_summary", "complaints_summary"),
    ("customer_network_summary", "network_summary"),
]


add("k8_write_audit", _k8, _counts_sql(COUNTS))
add("k9_preview", lambda w: preview(w.gold("fact_billing").select("invoice_id", "total_amount"), 10))
add(
    "k9_ordered_preview",
    lambda w: preview(w.gold("fact_billing").select("invoice_id", "total_amount"), 10, ["invoice_id"]),
    "SELECT invoice_id, total_amount FROM billing ORDER BY invoice_id LIMIT 10",
)

# ------------------------------------------------------------------- conforming and quality

add(
    "p1_record_hash",
    lambda w: w.raw("network_events_raw").select(
        "event_id",
        C.record_hash(["event_id", "customerID", "event_type", "region", "tower_id", "outage_minutes"]).alias("record_hash"),
    ),
    """SELECT event_id, sha256(event_id || '||' || customerID || '||' || event_type || '||' || COALESCE(region, '')
    || '||' || tower_id || '||' || outage_minutes) AS record_hash FROM network_raw""",
)
add(
    "p2_p5_p6_customers_clean",
    lambda w: table(w, "customers_clean"),
    f"SELECT {V.CUSTOMER_COLUMNS} FROM customers",
)
add(
    "p2_p4_p6_w1_billing_clean",
    lambda w: table(w, "billing_clean"),
    f"SELECT * REPLACE ({day('billing_month')} AS billing_month, {day('payment_date')} AS payment_date) FROM billing",
)
add(
    "p2_p4_p6_complaints_clean",
    lambda w: table(w, "complaints_clean"),
    f"SELECT * REPLACE ({second('opened_at')} AS opened_at) FROM complaints",
)
add(
    "p2_p4_p6_network_clean",
    lambda w: table(w, "network_events_clean"),
    f"SELECT * REPLACE ({second('event_timestamp')} AS event_timestamp) FROM network",
)
add(
    "p3_valid_keys",
    lambda w: conform.valid_keys(
        w.raw("customers_raw").withColumn(
            "customerID",
            F.when(F.col("tenure") == 1, F.lit(None)).when(F.col("tenure") == 2, "  ").otherwise(F.col("customerID")),
        ),
        ["customerID"],
    ).select(F.trim("customerID").alias("customer_id")),
    "SELECT trim(customerID) AS customer_id FROM customers_raw WHERE tenure NOT IN (1, 2)",
)
def _outcome_tables(w) -> list[str]:
    names = [f"{s}_{kind}" for s in conform.JUDGED for kind in ("clean", "quarantine")]
    for n in names:
        w.silver(n)
    return names


add(
    "p4_quarantine",
    lambda w: w.silver("billing_quarantine").select("invoice_id", F.array_join("broken_rules", ",").alias("broken_rules")),
    """SELECT invoice_id, concat_ws(',',
    CASE WHEN NOT COALESCE(monthly_charges >= 0, false) THEN 'monthly_charges_not_negative' END,
    CASE WHEN NOT COALESCE(usage_charges >= 0, false) THEN 'usage_charges_not_negative' END,
    CASE WHEN NOT COALESCE(discount_amount >= 0, false) THEN 'discount_amount_not_negative' END,
    CASE WHEN NOT COALESCE(tax_amount >= 0, false) THEN 'tax_amount_not_negative' END,
    CASE WHEN NOT COALESCE(total_amount >= 0, false) THEN 'total_amount_not_negative' END) AS broken_rules
    FROM billing_latest WHERE NOT COALESCE(monthly_charges >= 0 AND usage_charges >= 0 AND discount_amount >= 0
    AND tax_amount >= 0 AND total_amount >= 0, false)""",
)
add(
    "p4_complaints_quarantine",
    lambda w: w.silver("complaints_quarantine").select("complaint_id", F.array_join("broken_rules", ",").alias("broken_rules")),
    """SELECT complaint_id, concat_ws(',',
    CASE WHEN NOT COALESCE(resolution_hours >= 0, false) THEN 'resolution_hours_not_negative' END,
    CASE WHEN NOT COALESCE(satisfaction_score BETWEEN 1 AND 5, false) THEN 'satisfaction_score_in_1_5' END) AS broken_rules
    FROM complaint_rows WHERE NOT COALESCE(resolution_hours >= 0 AND satisfaction_score BETWEEN 1 AND 5, false)""",
)
add(
    "p4_network_quarantine",
    lambda w: w.silver("network_events_quarantine").select("event_id", F.array_join("broken_rules", ",").alias("broken_rules")),
    """SELECT event_id, concat_ws(',',
    CASE WHEN NOT COALESCE(latency_ms >= 0, false) THEN 'latency_not_negative' END,
    CASE WHEN NOT COALESCE(packet_loss_pct BETWEEN 0 AND 100, false) THEN 'packet_loss_in_0_100' END,
    CASE WHEN NOT COALESCE(download_speed_mbps >= 0, false) THEN 'speed_not_negative' END,
    CASE WHEN NOT COALESCE(outage_minutes >= 0, false) THEN 'outage_minutes_not_negative' END) AS broken_rules
    FROM network_rows WHERE NOT COALESCE(latency_ms >= 0 AND packet_loss_pct BETWEEN 0 AND 100 AND download_speed_mbps >= 0
    AND outage_minutes >= 0, false)""",
)
add(
    "p4_outcome_counts",
    lambda w: w.spark.createDataFrame(
        [(n, w.store.written[w.store.name("silver", n)]) for n in _outcome_tables(w)], "table_name string, record_count long"
    ),
    " UNION ALL ".join(
        f"SELECT '{s}_clean' AS table_name, COUNT(*) FILTER ({ok}) AS record_count FROM {v} UNION ALL SELECT '{s}_quarantine', COUNT(*) FILTER (NOT COALESCE({ok}, false)) FROM {v}"
        for s, v, ok in [
            ("billing", "billing_latest", "monthly_charges >= 0 AND usage_charges >= 0 AND discount_amount >= 0 AND tax_amount >= 0 AND total_amount >= 0"),
            ("complaints", "complaint_rows", "resolution_hours >= 0 AND satisfaction_score BETWEEN 1 AND 5"),
            ("network_events", "network_rows", "latency_ms >= 0 AND packet_loss_pct BETWEEN 0 AND 100 AND download_speed_mbps >= 0 AND outage_minutes >= 0"),
        ]
    ),
)
add(
    "p4_rule_counts",
    lambda w: quality.rule_counts(conform.complaint_candidates(w.raw("complaints_raw")), conform.complaint_rules()),
    """SELECT 'resolution_hours_not_negative' AS rule, COUNT(*) FILTER (resolution_hours < 0 OR resolution_hours IS NULL) AS rejected_rows FROM complaint_rows
    UNION ALL SELECT 'satisfaction_score_in_1_5', COUNT(*) FILTER (satisfaction_score NOT BETWEEN 1 AND 5 OR satisfaction_score IS NULL) FROM complaint_rows""",
)
add(
    "p7_processing_stamps",
    lambda w: w.silver("customers_clean").agg(
        F.count("_silver_processed_at").alias("stamped_rows"),
        F.count_distinct("_silver_processed_at").alias("stamps"),
    ),
    "SELECT COUNT(*) AS stamped_rows, CAST(1 AS BIGINT) AS stamps FROM customers",
)
add("p8_surrogate_key", lambda w: w.gold("dim_customer").select("customer_id", "customer_key"))
add(
    "p8_key_uniqueness",
    lambda w: w.gold("dim_customer").agg(
        F.count_distinct("customer_key").alias("keys"), F.count("customer_id").alias("customers")
    ),
    "SELECT COUNT(*) AS keys, COUNT(*) AS customers FROM dim_customer",
)
add(
    "p9_p20_p31_dim_customer",
    lambda w: w.gold("dim_customer").drop("customer_key"),
    "SELECT * FROM dim_customer",
)
DAYS_SQL = f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, {day('d')} AS full_date, year(d) AS year,
quarter(d) AS quarter, month(d) AS month_number, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
week(d) AS week_number, day(d) AS day_of_month, dayname(d) AS day_name,
{fl('dayofweek(d) IN (0, 6)')} AS is_weekend, year(d) * 100 + month(d) AS year_month_sort,
isodow(d) AS day_of_week_number FROM days"""
add("s10_p11_dim_date", lambda w: w.gold("dim_date"), DAYS_SQL)


def _keyed(w, fact: str) -> DataFrame:
    """A fact whose key is shown as whether it is the key that the dimension has for the customer."""
    dim = w.gold("dim_customer").select(F.col("customer_key").alias("_key"), F.col("customer_id").alias("_id"))
    rows = w.gold(fact).join(dim, F.col("customer_key") == F.col("_key"), "left")
    return rows.withColumn("has_customer", C.flag(F.col("_id") == F.col("customer_id"))).drop("customer_key", "_key", "_id")


_HAS = "CAST(CASE WHEN f.customer_id IN (SELECT customer_id FROM dim_customer) THEN 1 ELSE 0 END AS BIGINT)"
add(
    "p10_j2_fact_billing",
    lambda w: _keyed(w, "fact_billing"),
    f"""SELECT invoice_id, customer_id, CAST(strftime(billing_month, '%Y%m%d') AS BIGINT) AS billing_date_key,
    CAST(strftime(payment_date, '%Y%m%d') AS BIGINT) AS payment_date_key, {day('billing_month')} AS billing_month,
    {day('payment_date')} AS payment_date, monthly_charges, usage_charges, discount_amount, tax_amount, total_amount,
    payment_method, payment_status, is_paid, is_late, is_unpaid, CAST(strftime(billing_month, '%Y%m') AS BIGINT) AS month_key,
    {_HAS} AS has_customer FROM billing f""",
)
add(
    "p10_j2_fact_complaints",
    lambda w: _keyed(w, "fact_complaints"),
    f"""SELECT complaint_id, customer_id, CAST(strftime(opened_at, '%Y%m%d') AS BIGINT) AS opened_date_key,
    {second('opened_at')} AS opened_at, complaint_category, priority, complaint_status, complaint_channel,
    resolution_hours, satisfaction_score, is_critical, is_escalated, is_unresolved,
    CAST(strftime(opened_at, '%Y%m') AS BIGINT) AS month_key, {_HAS} AS has_customer FROM complaints f""",
)
add(
    "p10_j2_fact_network",
    lambda w: _keyed(w, "fact_network_events"),
    f"""SELECT event_id, customer_id, CAST(strftime(event_timestamp, '%Y%m%d') AS BIGINT) AS event_date_key,
    {second('event_timestamp')} AS event_timestamp, event_type, region, tower_id, latency_ms, packet_loss_pct,
    download_speed_mbps, outage_minutes, is_outage, is_degraded,
    CAST(strftime(event_timestamp, '%Y%m') AS BIGINT) AS month_key, {_HAS} AS has_customer FROM network f""",
)
add(
    "w1_latest_version",
    lambda w: conform.latest(w.raw("billing_raw"), ["invoice_id"]).select("invoice_id", "customerID", "total_amount"),
    'SELECT invoice_id, customer_id AS "customerID", total_amount FROM billing_latest',
)
add(
    "u2_any_per_key",
    lambda w: conform.any_per_key(
        w.gold("fact_billing").join(w.gold("dim_customer").select("customer_key", "internet_service").hint("merge"), "customer_key"),
        ["customer_key"],
    ).select("customer_id", "internet_service"),
    "SELECT DISTINCT b.customer_id, internet_service FROM billing b JOIN dim_customer d ON b.customer_id = d.customer_id",
)
add(
    "u3_distinct_values",
    lambda w: w.gold("fact_network_events").select("tower_id").distinct(),
    "SELECT DISTINCT tower_id FROM network",
)
add(
    "a1_raw_customer_quality",
    lambda w: quality.raw_customers(w.raw("customers_raw")),
    f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT customerID) AS unique_customers,
    {isum(fl('customerID IS NULL'))} AS null_customer_ids, {isum(fl('MonthlyCharges IS NULL'))} AS null_monthly_charges,
    {isum(fl("Churn NOT IN ('Yes', 'No') OR Churn IS NULL"))} AS invalid_churn_values FROM customers_raw""",
)
add(
    "a2_raw_billing_quality",
    lambda w: quality.raw_billing(w.raw("billing_raw")),
    f"""SELECT COUNT(*) AS total_transactions, COUNT(DISTINCT invoice_id) AS unique_invoices,
    {isum(fl('invoice_id IS NULL'))} AS null_invoice_ids, {isum(fl('customerID IS NULL'))} AS null_customer_ids,
    {isum(fl('total_amount < 0'))} AS negative_amounts,
    {isum(fl("payment_status NOT IN ('Paid', 'Late', 'Unpaid')"))} AS invalid_payment_status,
    {rnd(tot('total_amount'))} AS total_billed_revenue, {rnd(avg('total_amount'))} AS average_invoice_value FROM billing_raw""",
)
add(
    "a3_raw_complaint_quality",
    lambda w: quality.raw_complaints(w.raw("complaints_raw")),
    f"""SELECT COUNT(*) AS total_complaints, COUNT(DISTINCT complaint_id) AS unique_complaints,
    {isum(fl('complaint_id IS NULL'))} AS null_complaint_ids, {isum(fl('customerID IS NULL'))} AS null_customer_ids,
    {isum(fl('resolution_hours < 0'))} AS invalid_resolution_hours,
    {isum(fl('satisfaction_score NOT BETWEEN 1 AND 5'))} AS invalid_satisfaction_scores,
    {isum(fl("priority NOT IN ('Low', 'Medium', 'High', 'Critical')"))} AS invalid_priorities,
    {rnd(avg('resolution_hours'))} AS average_resolution_hours,
    {rnd(avg('satisfaction_score'))} AS average_satisfaction_score FROM complaints_raw""",
)
add(
    "a4_raw_network_quality",
    lambda w: quality.raw_network(w.raw("network_events_raw")),
    f"""SELECT COUNT(*) AS total_events, COUNT(DISTINCT event_id) AS unique_events,
    {isum(fl('event_id IS NULL'))} AS null_event_ids, {isum(fl('customerID IS NULL'))} AS null_customer_ids,
    {isum(fl('latency_ms < 0'))} AS invalid_latency,
    {isum(fl('packet_loss_pct < 0 OR packet_loss_pct > 100'))} AS invalid_packet_loss,
    {isum(fl('download_speed_mbps < 0'))} AS invalid_download_speed,
    {isum(fl('outage_minutes < 0'))} AS invalid_outage_duration,
    {isum(fl("event_type = 'Outage'"))} AS total_outage_events,
    {rnd(avg('latency_ms'))} AS average_latency_ms, {rnd(avg('packet_loss_pct'))} AS average_packet_loss,
    {rnd(avg('download_speed_mbps'))} AS average_download_speed FROM network_raw""",
)
add(
    "a5_clean_customer_quality",
    lambda w: quality.clean_customers(table(w, "customers_clean")),
    f"""SELECT COUNT(*) AS total_customers, COUNT(DISTINCT customer_id) AS unique_customers,
    {isum(fl('customer_id IS NULL'))} AS null_customer_ids, {isum(fl('monthly_charges < 0'))} AS invalid_monthly_charges,
    {isum(fl('churn_label NOT IN (0, 1)'))} AS invalid_churn_labels,
    {rnd(avg('monthly_charges'))} AS average_monthly_charges, {rnd(avg('tenure_months'))} AS average_tenure FROM customers""",
)
add(
    "a6_customer_360_quality",
    lambda w: quality.customer_360(table(w, "customer_360")),
    f"""SELECT COUNT(*) AS total_rows, COUNT(DISTINCT customer_id) AS unique_customers,
    {isum(fl('customer_id IS NULL'))} AS null_customer_ids, {isum('has_billing_history')} AS customers_with_billing,
    {isum('has_complaints')} AS customers_with_complaints, {isum('has_network_events')} AS customers_with_network_events,
    {rnd(avg('complaint_count'))} AS average_complaints, {rnd(avg('network_quality_score'))} AS average_network_quality,
    {rnd(tot('revenue_at_risk'))} AS known_revenue_at_risk FROM customer_360""",
)
add(
    "a7_billing_summary",
    lambda w: table(w, "customer_billing_summary"),
    f"SELECT * REPLACE ({day('latest_billing_month')} AS latest_billing_month) FROM billing_summary",
)
add(
    "a8_complaints_summary",
    lambda w: table(w, "customer_complaints_summary"),
    f"SELECT * REPLACE ({second('latest_complaint_at')} AS latest_complaint_at) FROM complaints_summary",
)
add(
    "a9_network_summary",
    lambda w: table(w, "customer_network_summary"),
    f"SELECT * REPLACE ({second('latest_network_event_at')} AS latest_network_event_at) FROM network_summary",
)
_DATES_360 = f"""{day('latest_billing_month')} AS latest_billing_month, {second('latest_complaint_at')} AS latest_complaint_at,
{second('latest_network_event_at')} AS latest_network_event_at"""
add(
    "j1_p12_p13_p14_customer_360",
    lambda w: table(w, "customer_360"),
    f"SELECT * REPLACE ({_DATES_360}) FROM customer_360",
)
add(
    "p15_p16_p17_p18_churn_analytics",
    lambda w: w.gold("customer_churn_analytics"),
    f"SELECT * REPLACE ({_DATES_360}) FROM analytics",
)
add(
    "p18_action_guard_missing",
    lambda w: stats.value_counts(
        scoring.churn_analytics(
            table(w, "customer_360").withColumn("unpaid_invoice_count", F.lit(0)).withColumn("unresolved_complaint_count", F.lit(0)),
            guard_missing=True,
        ),
        "recommended_action",
    ),
    """SELECT CASE WHEN network_quality_score < 60 AND has_network_events = 1 THEN 'Network investigation and service credit'
    WHEN lower(contract_type) = 'month-to-month' THEN 'Offer long-term contract discount' ELSE 'Standard engagement' END AS recommended_action,
    COUNT(*) AS count FROM customer_360 GROUP BY 1""",
)
add(
    "p19_ml_features",
    lambda w: w.gold("customer_ml_features"),
    f"SELECT customer_id, {', '.join(rollup.FEATURES)}, churn_label FROM analytics",
)
add(
    "p21_access_technology",
    lambda w: w.gold("dim_customer").select("customer_id", enrich.access_technology("internet_service").alias("technology")),
    """SELECT customer_id, CASE WHEN lower(internet_service) = 'dsl' THEN 'DSL'
    WHEN lower(internet_service) = 'fiber optic' THEN 'Fiber Optic' END AS technology FROM dim_customer""",
)
add(
    "p22_p27_region_lookups",
    lambda w: w.gold("fact_network_events")
    .groupBy("region", enrich.region_code("region").alias("code"), enrich.new_region("region").alias("new_region"))
    .agg(F.count(F.lit(1)).alias("events")),
    """SELECT region, CASE region WHEN 'Cairo' THEN 'CAI' WHEN 'Giza' THEN 'GIZ' WHEN 'Alexandria' THEN 'ALX'
    WHEN 'Delta' THEN 'DLT' WHEN 'Upper Egypt' THEN 'UPR' ELSE 'UNK' END AS code,
    CASE region WHEN 'Cairo' THEN 'Los Angeles Metro' WHEN 'Giza' THEN 'Bay Area' WHEN 'Alexandria' THEN 'San Diego County'
    WHEN 'Delta' THEN 'Central Valley' WHEN 'Upper Egypt' THEN 'Sacramento / North' ELSE region END AS new_region,
    COUNT(*) AS events FROM network GROUP BY 1, 2, 3""",
)
add(
    "p23_hash_bucket_sha2",
    lambda w: w.gold("dim_customer").select("customer_id", C.hash_bucket(["customer_id"], 100, "sha2").alias("bucket")),
    f"SELECT customer_id, {V.bucket('customer_id')} AS bucket FROM dim_customer",
)
add(
    "p23_hash_bucket_xxhash64",
    lambda w: w.gold("dim_customer").select("customer_id", C.hash_bucket(["customer_id"], 100).alias("bucket")),
)
add(
    "p24_j3_cabinet_events",
    lambda w: w.gold("fact_network_cabinets").select("event_id", "access_technology", "cabinet_id", "cabinet_type"),
    "SELECT event_id, access_technology, cabinet_id, cabinet_type FROM cabinets",
)
add(
    "p25_cabinets_twice",
    lambda w: stats.value_counts(
        enrich.with_cabinets(w.gold("fact_network_cabinets"), w.gold("dim_customer"), "sha2"), "cabinet_id"
    ),
    "SELECT cabinet_id, COUNT(*) AS count FROM cabinets GROUP BY 1",
)
add(
    "p26_reconciliation",
    lambda w: quality.reconcile(
        enrich.with_service(w.gold("fact_network_events"), w.gold("dim_customer")),
        enrich.has_fixed_access("internet_service"),
    ),
    f"""SELECT COUNT(*) AS source_rows, {isum(fl("lower(internet_service) IN ('dsl', 'fiber optic')"))} AS eligible_rows,
    COUNT(*) - {isum(fl("lower(internet_service) IN ('dsl', 'fiber optic')"))} AS excluded_rows
    FROM network n LEFT JOIN dim_customer d ON n.customer_id = d.customer_id""",
)
add(
    "p28_p29_city_events",
    lambda w: w.gold("fact_network_cities").select(
        "event_id", "region", "location_key", "latency_ms", "packet_loss_pct", "download_speed_mbps", "outage_minutes"
    ),
    "SELECT event_id, region, location_key, latency_ms, packet_loss_pct, download_speed_mbps, outage_minutes FROM cities",
)
add(
    "p30_outcomes",
    lambda w: scoring.with_outcome(w.gold("customer_churn_predictions")).select("customer_id", "prediction_outcome"),
    "SELECT customer_id, prediction_outcome FROM outcomes",
)
add(
    "p32_date_drill_down",
    lambda w: (
        lambda h: w.gold("fact_complaints")
        .rollup(h["year"].alias("year"), h["quarter"].alias("quarter"), h["month_no"].alias("month_no"))
        .agg(F.count(F.lit(1)).alias("complaints"))
    )(calendars.hierarchy("opened_at")),
    """SELECT year(opened_at) AS year, 'Qtr ' || quarter(opened_at) AS quarter, month(opened_at) AS month_no,
    COUNT(*) AS complaints FROM complaints GROUP BY ROLLUP (1, 2, 3)""",
)
add(
    "p33_sort_keys",
    lambda w: w.gold("dim_date").select("month_name", "month_number", "day_name", "day_of_week_number").distinct(),
    "SELECT DISTINCT monthname(d) AS month_name, month(d) AS month_number, dayname(d) AS day_name, isodow(d) AS day_of_week_number FROM days",
)
add(
    "p34_l13_predictions",
    lambda w: w.gold("customer_churn_predictions").drop("model_name", "run_id"),
    "SELECT * FROM predictions",
)
add(
    "p35_p36_j6_l14_retention_list",
    lambda w: w.gold("high_risk_customers"),
    "SELECT * FROM retention",
)


def _invoices(w) -> DataFrame:
    base = w.gold("dim_customer").select(
        "customer_id",
        F.greatest("monthly_charges", F.lit(0.0)).alias("monthly_charges"),
        (F.col("tenure_months") * 0.25).alias("usage_charges"),
        ((F.col("tenure_months") % 4) * 5.0).alias("discount_amount"),
    )
    return invoices.with_amounts(invoices.monthly(base, F.lit("2025-09-01").cast("date"), 12))


def _half_even(x: str) -> str:
    d = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(24,17))"
    return (
        f"CAST(CASE WHEN ({d} * 100) % 1 = 0.5 AND floor({d} * 100) % 2 = 0 THEN CAST(floor({d} * 100) AS DOUBLE) / 100 "
        f"ELSE CAST(round({d}, 2) AS DOUBLE) END AS DOUBLE)"
    )


add(
    "j7_p37_monthly_invoices",
    lambda w: _invoices(w).select("customer_id", "billing_month", "tax_amount", "total_amount"),
    f"""SELECT customer_id, {day('billing_month')} AS billing_month, tax_amount, {_half_even('taxable + tax_amount')} AS total_amount
    FROM (SELECT *, {_half_even('taxable * CAST(0.14 AS DOUBLE)')} AS tax_amount FROM (SELECT customer_id,
    unnest(generate_series(TIMESTAMP '2025-09-01', TIMESTAMP '2026-08-01', INTERVAL 1 MONTH)) AS billing_month,
    GREATEST(GREATEST(monthly_charges, CAST(0 AS DOUBLE)) + tenure_months * CAST(0.25 AS DOUBLE) - (tenure_months % 4) * CAST(5 AS DOUBLE), CAST(0 AS DOUBLE)) AS taxable
    FROM dim_customer))""",
)
add(
    "p38_sequential_ids",
    lambda w: invoices.sequential_ids(
        w.gold("dim_customer").select("customer_id"), ["customer_id"], "INV-%07d", "invoice_id", bucket_method="sha2"
    ),
    """SELECT customer_id, 'INV-' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY
    CAST('0x' || substr(sha256(customer_id), 1, 8) AS BIGINT) % (SELECT GREATEST(1, (COUNT(*) + 199999) // 200000) FROM dim_customer), customer_id) AS VARCHAR), 7, '0') AS invoice_id FROM dim_customer""",
)

# ----------------------------------------------------------------------------------- joins

add(
    "j4_events_with_quality_profile",
    lambda w: w.gold("fact_network_cities")
    .join(F.broadcast(w.gold("dim_network_location").select("location_key", "quality_factor")), "location_key", "left")
    .select("event_id", "quality_factor"),
    "SELECT event_id, CAST(quality_factor AS DOUBLE) AS quality_factor FROM cities c LEFT JOIN locations l ON c.location_key = l.location_key",
)
add(
    "j10_city_with_region_score",
    lambda w: w.gold("dim_network_location")
    .select("city", "region")
    .join(w.gold("network_performance_by_region").select("region", "regional_quality_score"), "region"),
    f"""SELECT city, l.region AS region, regional_quality_score FROM locations l JOIN (SELECT region, {rnd(V.health("rate", "lat", "loss", "speed"))} AS regional_quality_score
    FROM (SELECT region, CAST({isum(fl("event_type <> 'normal'"))} AS DOUBLE) / COUNT(*) AS rate, {rnd(avg('latency_ms'))} AS lat,
    {rnd(avg('packet_loss_pct'))} AS loss, {rnd(avg('download_speed_mbps'))} AS speed FROM cities GROUP BY region)) r ON l.region = r.region""",
)
add(
    "j11_timestamp_to_calendar",
    lambda w: star.on_calendar(
        w.gold("fact_complaints"), "opened_at", calendars.calendar_for(w.gold("fact_complaints"), "opened_at"), "date"
    )
    .groupBy("year", "quarter")
    .agg(F.count(F.lit(1)).alias("complaints")),
    "SELECT year(opened_at) AS year, 'Qtr ' || quarter(opened_at) AS quarter, COUNT(*) AS complaints FROM complaints GROUP BY 1, 2",
)
_LOYAL = "contract_type <> 'Two year'"
add(
    "j12_orphan_counts",
    lambda w: (
        lambda dim: quality.orphan_counts(
            {
                "fact_billing": star.fact_billing(table(w, "billing_clean"), dim),
                "fact_complaints": star.fact_complaints(table(w, "complaints_clean"), dim),
                "fact_network_events": star.fact_network_events(table(w, "network_events_clean"), dim),
            },
            "customer_key",
        )
    )(w.gold("dim_customer").filter(_LOYAL)),
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, COUNT(*) AS total_rows, COUNT(*) FILTER (d.customer_id IS NULL) AS orphan_records
        FROM {v} f LEFT JOIN (SELECT customer_id FROM dim_customer WHERE {_LOYAL}) d ON f.customer_id = d.customer_id"""
        for n, v in [("fact_billing", "billing"), ("fact_complaints", "complaints"), ("fact_network_events", "network")]
    ),
)
add(
    "j12_orphan_rows",
    lambda w: quality.orphans(table(w, "billing_clean"), w.gold("dim_customer").filter(_LOYAL), "customer_id").select("invoice_id"),
    f"SELECT invoice_id FROM billing WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer WHERE {_LOYAL})",
)

# ------------------------------------------------------------------- KPIs, counts, top lists

add(
    "a10_executive_kpis",
    lambda w: w.gold("executive_kpis").drop("snapshot_date"),
    f"""SELECT COUNT(DISTINCT customer_id) AS total_customers, {isum('churn_label')} AS churned_customers,
    {rnd(avg('churn_label') + ' * 100')} AS churn_rate_pct, {rnd(tot('monthly_charges'))} AS monthly_recurring_revenue,
    {rnd(tot('actual_churn_revenue'))} AS actual_churn_revenue, {rnd(tot('business_risk_revenue'))} AS business_risk_revenue,
    {rnd(avg('monthly_charges'))} AS average_revenue_per_user, {isum('complaint_count')} AS total_complaints,
    {isum('unresolved_complaint_count')} AS unresolved_complaints, {isum('outage_event_count')} AS total_outage_events,
    {rnd(avg('CASE WHEN has_network_events = 1 THEN network_quality_score END'))} AS average_network_quality_score,
    {isum(fl("risk_category IN ('High', 'Critical')"))} AS high_risk_customers FROM analytics""",
)
add("a11_revenue_risk_by_segment", lambda w: w.gold("revenue_risk_by_segment"), "SELECT * FROM segments")
add(
    "a12_network_by_region",
    lambda w: kpi.by_region(w.gold("fact_network_events")),
    f"""SELECT *, {rnd("GREATEST(0.0, 100.0 - average_latency_ms * 0.10 - average_packet_loss_pct * 1.50 - outage_event_count * CAST(0.01 AS DOUBLE))")} AS regional_quality_score
    FROM (SELECT region, COUNT(DISTINCT event_id) AS network_event_count, COUNT(DISTINCT customer_id) AS affected_customers,
    {isum('is_outage')} AS outage_event_count, {isum('is_degraded')} AS degraded_event_count,
    {rnd(avg('latency_ms'))} AS average_latency_ms, {rnd(avg('packet_loss_pct'))} AS average_packet_loss_pct,
    {rnd(avg('download_speed_mbps'))} AS average_download_speed_mbps, {isum('outage_minutes')} AS total_outage_minutes
    FROM network GROUP BY region)""",
)
add(
    "a13_network_by_region_weighted",
    lambda w: w.gold("network_performance_by_region"),
    f"""SELECT * EXCLUDE (rate), {rnd(V.health("rate", "average_latency_ms", "average_packet_loss_pct", "average_download_speed_mbps"))} AS regional_quality_score
    FROM (SELECT region, COUNT(DISTINCT event_id) AS network_event_count,
    COUNT(DISTINCT CASE WHEN event_type <> 'normal' THEN customer_id END) AS affected_customers,
    {isum('is_outage')} AS outage_event_count, {isum('is_degraded')} AS degraded_event_count,
    {rnd(avg('latency_ms'))} AS average_latency_ms, {rnd(avg('packet_loss_pct'))} AS average_packet_loss_pct,
    {rnd(avg('download_speed_mbps'))} AS average_download_speed_mbps, {isum('outage_minutes')} AS total_outage_minutes,
    CAST({isum(fl("event_type <> 'normal'"))} AS DOUBLE) / COUNT(*) AS rate FROM cities GROUP BY region)""",
)
add("a14_cabinet_performance", lambda w: w.gold("network_performance_by_cabinet"), "SELECT * FROM cabinet_performance")
add(
    "a15_j5_city_performance",
    lambda w: kpi.by_city(w.gold("fact_network_cities"), w.gold("dim_network_location")),
    "SELECT * FROM city_performance",
)
add(
    "a16_value_shares",
    lambda w: stats.value_shares(w.gold("customer_ml_features"), "churn_label"),
    f"SELECT churn_label, COUNT(*) AS count, {div('COUNT(*)', '(SELECT COUNT(*) FROM customers)')} AS share FROM customers GROUP BY 1",
)
add(
    "a16_service_counts",
    lambda w: stats.value_counts(w.gold("dim_customer"), "internet_service"),
    "SELECT internet_service, COUNT(*) AS count FROM dim_customer GROUP BY 1",
)
add(
    "a17_confusion_counts",
    lambda w: stats.confusion_counts(w.gold("customer_churn_predictions"), "actual_churn_label", "predicted_churn_label"),
    "SELECT actual_churn_label, predicted_churn_label, COUNT(DISTINCT customer_id) AS customers FROM predictions GROUP BY 1, 2",
)
add(
    "a18_u1_layer_counts",
    lambda w: quality.layer_counts({n: table(w, n) for n, _ in COUNTS}),
    _counts_sql(COUNTS),
)
add(
    "a19_f7_conditional_distinct",
    lambda w: w.gold("fact_network_events").groupBy("region").agg(
        F.count_distinct(F.when(kpi.is_incident(), F.col("customer_id"))).alias("affected_customers")
    ),
    "SELECT region, COUNT(DISTINCT CASE WHEN event_type <> 'normal' THEN customer_id END) AS affected_customers FROM network GROUP BY 1",
)
add(
    "t1_latest_events",
    lambda w: kpi.latest_events(w.gold("fact_network_events").select("event_id", "event_timestamp")),
    f"SELECT event_id, {second('event_timestamp')} AS event_timestamp FROM network ORDER BY network.event_timestamp DESC, event_id LIMIT 10",
)
add(
    "t2_segments_by_churn",
    lambda w: kpi.segments_by_churn(w.gold("revenue_risk_by_segment")),
    "SELECT * FROM segments",
)
add(
    "t3_worst_cabinets",
    lambda w: kpi.worst_cabinets(w.gold("network_performance_by_cabinet")),
    """SELECT * FROM cabinet_performance WHERE network_events >= 20
    ORDER BY incident_rate_pct DESC, network_incidents DESC, cabinet_id LIMIT 20""",
)
add(
    "t4_cities_by_incidents",
    lambda w: kpi.cities_by_incidents(kpi.by_city(w.gold("fact_network_cities"), w.gold("dim_network_location"))),
    "SELECT * FROM city_performance",
)
add(
    "t5_top_retention",
    lambda w: scoring.top_retention(w.gold("high_risk_customers")),
    "SELECT * FROM retention ORDER BY churn_probability DESC, monthly_charges DESC, customer_id LIMIT 20",
)

# --------------------------------------------------------- models: statistics with SQL twins

add(
    "l2_stratified_split",
    lambda w: stats.stratified_split(
        w.gold("customer_ml_features").select("customer_id", "churn_label"), "churn_label", "customer_id"
    ),
    """SELECT customer_id, churn_label, CAST(CASE WHEN rn <= quota THEN 1 ELSE 0 END AS BIGINT) AS is_test FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn_label ORDER BY sha256(customer_id || '|42')) AS rn,
    floor((2 * COUNT(*) OVER (PARTITION BY churn_label) + 5) / 10) AS quota FROM customers)""",
)
add(
    "l6_balanced_weights",
    lambda w: stats.balanced_weight(w.gold("customer_ml_features").select("customer_id", "churn_label"), "churn_label"),
    f"""SELECT customer_id, churn_label, {div('COUNT(*) OVER ()', '2 * COUNT(*) OVER (PARTITION BY churn_label)')} AS weight FROM customers""",
)
add(
    "l8_binary_metrics",
    lambda w: stats.binary_metrics(w.gold("customer_churn_predictions"), "actual_churn_label", "predicted_churn_label"),
    f"""SELECT {div('tp + tn', 'n')} AS accuracy, {div('tp', 'tp + fp')} AS precision, {div('tp', 'tp + fn')} AS recall,
    {div('2 * tp', '2 * tp + fp + fn')} AS f1_score FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (actual_churn_label = 1 AND predicted_churn_label = 1) AS tp,
    COUNT(*) FILTER (actual_churn_label = 0 AND predicted_churn_label = 1) AS fp, COUNT(*) FILTER (actual_churn_label = 1 AND predicted_churn_label = 0) AS fn,
    COUNT(*) FILTER (actual_churn_label = 0 AND predicted_churn_label = 0) AS tn FROM predictions)""",
)
add(
    "l8_exact_auc",
    lambda w: stats.roc_auc(w.gold("customer_churn_predictions"), "actual_churn_label", "churn_probability"),
    """SELECT CAST(SUM(pos * (2 * below + neg)) AS DOUBLE) / (2.0 * SUM(pos) * SUM(neg)) AS roc_auc FROM
    (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
    (SELECT churn_probability AS s, COUNT(*) FILTER (actual_churn_label = 1) AS pos, COUNT(*) FILTER (actual_churn_label = 0) AS neg FROM predictions GROUP BY 1))""",
)
add(
    "l9_class_report",
    lambda w: stats.class_report(w.gold("customer_churn_predictions"), "actual_churn_label", "predicted_churn_label"),
    f"""SELECT c AS class, COALESCE({div('hits', 'predicted')}, 0) AS precision, COALESCE({div('hits', 'support')}, 0) AS recall,
    COALESCE({div('2 * hits', 'support + predicted')}, 0) AS f1_score, support FROM (SELECT c,
    COUNT(*) FILTER (actual_churn_label = c AND predicted_churn_label = c) AS hits, COUNT(*) FILTER (actual_churn_label = c) AS support,
    COUNT(*) FILTER (predicted_churn_label = c) AS predicted FROM predictions, (VALUES (0::BIGINT), (1::BIGINT)) v(c) GROUP BY c)""",
)
add(
    "l9_report_averages",
    lambda w: stats.report_averages(w.gold("customer_churn_predictions"), "actual_churn_label", "predicted_churn_label"),
    f"""SELECT row, CASE row WHEN 'accuracy' THEN a WHEN 'macro avg' THEN mp ELSE wp END AS precision,
    CASE row WHEN 'accuracy' THEN a WHEN 'macro avg' THEN mr ELSE wr END AS recall,
    CASE row WHEN 'accuracy' THEN a WHEN 'macro avg' THEN mf ELSE wf END AS f1_score, n AS support
    FROM (SELECT CAST(SUM(support) AS BIGINT) AS n, {div('SUM(hits)', 'SUM(support)')} AS a, SUM(p) / COUNT(*) AS mp, SUM(r) / COUNT(*) AS mr,
    SUM(f) / COUNT(*) AS mf, SUM(p * support) / SUM(support) AS wp, SUM(r * support) / SUM(support) AS wr, SUM(f * support) / SUM(support) AS wf
    FROM (SELECT hits, support, COALESCE({div('hits', 'predicted')}, 0) AS p, COALESCE({div('hits', 'support')}, 0) AS r,
    COALESCE({div('2 * hits', 'support + predicted')}, 0) AS f FROM (SELECT c,
    COUNT(*) FILTER (actual_churn_label = c AND predicted_churn_label = c) AS hits, COUNT(*) FILTER (actual_churn_label = c) AS support,
    COUNT(*) FILTER (predicted_churn_label = c) AS predicted FROM predictions, (VALUES (0::BIGINT), (1::BIGINT)) v(c) GROUP BY c))),
    (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) w(row)""",
)
add(
    "l3_exact_median",
    lambda w: stats.median(w.gold("customer_ml_features"), "average_invoice_amount"),
    "SELECT median(average_invoice_amount) AS median FROM analytics",
)
add("l1_l4_l5_l10_model_runs", lambda w: w.models()["ml_runs"].select("model_name", F.size("metrics").alias("metrics"), F.size("params").alias("params"), F.size("input_example").alias("examples")))
add("l12_l13_model_predictions", lambda w: w.models()["ml_predictions"])
add(
    "l12_l13_scored_customers",
    lambda w: w.models()["ml_predictions"].groupBy("actual_churn_label").agg(F.count("churn_probability").alias("customers")),
    "SELECT churn_label AS actual_churn_label, COUNT(*) AS customers FROM customers GROUP BY 1",
)
add("l6_l7_l11_l15_t6_model_performance", lambda w: w.models()["ml_model_performance"].drop("evaluation_timestamp"))
add("l16_t8_feature_importance", lambda w: w.models()["ml_feature_importance"].orderBy(F.col("importance").desc(), "feature_name").limit(20))
