import json
import os
import pathlib
import uuid

import pytest
from pyspark.sql import functions as F

from checks import registry
from subscope.operators import ingest, quality, stats
from subscope.session import work_dir
from subscope.sources import files, schemas
from subscope.store import LayerStore
from subscope.streaming import ingest as streams


@pytest.fixture()
def store(spark):
    return LayerStore(spark, work_dir(spark, "store"), f"t_{uuid.uuid4().hex[:8]}").create_layers()


def test_work_dir_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_overwrite_replaces_the_schema(spark, store):
    store.write(spark.range(5), "gold", "t")
    out = store.write(spark.range(3).withColumn("x", F.lit("a")), "gold", "t")
    assert out.columns == ["id", "x"] and out.count() == 3
    assert store.written[store.name("gold", "t")] == 3


def test_table_can_be_rebuilt_from_itself(spark, store):
    before = store.write(spark.range(10), "silver", "t")
    store.write(store.read("silver", "t").filter("id < 4"), "silver", "t")
    assert store.read("silver", "t").count() == 4
    assert before.count() == 10, "a reader of the old version keeps it"
    assert store.read_version("silver", "t", 1).count() == 10


def test_backup_is_kept_and_preferred(spark, store):
    store.write(spark.range(5), "gold", "t")
    store.backup_if_absent("gold", "t", "clean")
    store.write(spark.range(1), "gold", "t")
    store.backup_if_absent("gold", "t", "clean")
    assert store.first_existing("gold", ["t_clean", "t"]).count() == 5
    assert store.first_existing("gold", ["missing", "t"]).count() == 1
    with pytest.raises(LookupError):
        store.first_existing("gold", ["missing"])


def test_old_versions_are_dropped_but_the_newest_stay(spark, store):
    for n in (1, 2, 3):
        store.write(spark.range(n), "gold", "t")
    assert store.drop_old_versions("gold", "t", keep=2) == [1]
    assert store.versions("gold", "t") == [2, 3] and store.read("gold", "t").count() == 3


def test_append_and_listing(spark, store):
    store.append(spark.range(2), "bronze", "t")
    assert store.append(spark.range(3), "bronze", "t").count() == 5
    store.write(spark.range(1), "gold", "t__x")
    assert sorted(tuple(r) for r in store.listing().collect()) == [("bronze", "t"), ("gold", "t__x")]


def test_partitioned_write_prunes(spark, store, plan):
    out = store.write(spark.range(100).withColumn("month_key", (F.col("id") % 4).cast("int")), "gold", "t", ["month_key"])
    text = plan(out.filter("month_key = 2"))
    assert "PartitionFilters: [isnotnull(month_key" in text and out.filter("month_key = 2").count() == 25


def test_csv_reader_keeps_broken_rows(spark, tmp_path):
    path = tmp_path / "c.csv"
    names = [f.name for f in schemas.CUSTOMERS.fields]
    def line(**kw):
        return ",".join(str(kw.get(n, "")) for n in names)
    path.write_text("\n".join([",".join(names), line(customerID="A", MonthlyCharges="12.5", TotalCharges=" ", tenure="3"), line(customerID="B", MonthlyCharges="abc")]) + "\n")
    rows = {r.customerID: r for r in files.customers(spark, str(path)).collect()}
    assert (rows["A"].MonthlyCharges, rows["A"].TotalCharges, rows["A"].tenure) == (12.5, None, 3)
    assert rows["B"].MonthlyCharges is None


def test_json_reader_turns_a_broken_line_into_nulls(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"invoice_id":"I1","customerID":"C1","total_amount":5.5}\n{broken\n')
    rows = files.billing(spark, str(path)).collect()
    assert sorted((r.invoice_id or "", r.total_amount or 0.0) for r in rows) == [("", 0.0), ("I1", 5.5)]


def test_timestamp_pattern_rejects_a_bare_date(spark, tmp_path):
    path = tmp_path / "k.csv"
    path.write_text("complaint_id,customerID,opened_at,category,priority,status,channel,resolution_hours,satisfaction_score\n"
                    "1,C,2026-01-02 03:04:05,a,b,c,d,1.5,3\n2,C,2026-01-02,a,b,c,d,1.5,3\n")
    rows = {r.complaint_id: r.opened_at for r in files.complaints(spark, str(path)).collect()}
    assert str(rows["1"]) == "2026-01-02 03:04:05" and rows["2"] is None


def test_crm_preparation(spark):
    df = spark.createDataFrame([("A", "10", "m", " YES "), ("B", "x", "m", "no"), ("C", "30", "m", None), ("D", "50", "m", "maybe")], "customerID string, MonthlyCharges string, PaymentMethod string, Churn string")
    rows = {r.customerID: (r.MonthlyCharges, r.churn_flag) for r in files.prepare_crm(df).collect()}
    assert rows == {"A": (10.0, 1), "B": (30.0, 0), "C": (30.0, 0), "D": (50.0, 0)}
    with pytest.raises(ValueError, match="PaymentMethod"):
        files.prepare_crm(df.drop("PaymentMethod"))


def event(i, **extra):
    base = {"event_id": f"E{i}", "customerID": "C", "event_timestamp": "2026-01-01T00:00:00", "event_type": "Normal", "region": "Giza",
            "tower_id": "T", "latency_ms": 1.5, "packet_loss_pct": 0.0, "download_speed_mbps": 9.0, "outage_minutes": 0}
    return json.dumps({**base, **extra})


def test_stream_restart_reads_only_new_files(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    os.mkdir(landing)
    run = lambda: streams.ingest_network_events(spark, landing, table, checkpoint, schemas.NETWORK_EVENTS)
    (tmp_path / "landing" / "a.json").write_text("\n".join(event(i) for i in range(3)))
    assert run().count() == 3
    assert run().count() == 3, "nothing new, nothing added"
    (tmp_path / "landing" / "b.json").write_text(event(3) + "\n" + event(4))
    out = run()
    assert sorted(r.event_id for r in out.collect()) == [f"E{i}" for i in range(5)]
    assert out.select("_batch_id").distinct().count() == 2
    assert out.select("_source_file").distinct().count() == 2
    newest = out.groupBy("_batch_id").agg(F.count_distinct("_ingestion_timestamp").alias("n")).collect()
    assert all(r.n == 1 for r in newest)


def test_rescued_data(spark, tmp_path):
    lines = [event(0), event(1, firmware="v2"), event(2, outage_minutes="n/a"), event(3, region=None), "{not json", event(4, latency_ms="fast", extra={"a": 1})]
    path = tmp_path / "e.json"
    path.write_text("\n".join(lines))
    rows = {r.event_id: r for r in streams.json_batch(spark, str(path), schemas.NETWORK_EVENTS).collect()}
    assert rows["E0"]._rescued_data is None and rows["E3"]._rescued_data is None
    assert json.loads(rows["E1"]._rescued_data) == {"firmware": "v2"}
    assert json.loads(rows["E2"]._rescued_data) == {"outage_minutes": "n/a"} and rows["E2"].latency_ms == 1.5
    assert json.loads(rows["E4"]._rescued_data) == {"latency_ms": "fast", "extra": '{"a":1}'}
    assert json.loads(rows[None]._rescued_data) == {"_corrupt_record": "{not json"}


def test_metadata_columns(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"invoice_id":"I1","customerID":"C1"}\n')
    out = ingest.add_metadata(files.billing(spark, str(tmp_path / "b.json")), "Billing System", "batch-1").first()
    assert out._source_file.endswith("b.json") and (out._source_system, out._batch_id) == ("Billing System", "batch-1")
    assert len(out._record_hash) == 64


def test_audit_counts_rows_of_the_write(spark, tmp_path):
    df, seen = quality.audited(spark.range(7), "a")
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get["record_count"] == 7


def test_models_train_score_and_explain(spark, wh):
    from subscope.plans import churn

    features = wh.gold("customer_ml_features")
    runs, split = churn.train_all(features, trees=4, depth=3, max_iter=20)
    assert [r["model_name"] for r in runs] == ["Logistic Regression", "Random Forest"]
    table = churn.performance(spark, runs).collect()
    assert all(0 <= r[m] <= 1 for r in table for m in churn.METRICS)
    best = churn.best(runs)
    assert best["metrics"]["roc_auc"] == max(r["metrics"]["roc_auc"] for r in runs)
    published = churn.publish(best, features)
    assert published.count() == features.count() == published.select("customer_id").distinct().count()
    scored = churn.score(best["model"], churn.filled(split.filter("is_test = 1"), best["fill"]))
    exact = stats.roc_auc(scored, "churn_label", "probability").first().roc_auc
    assert exact == pytest.approx(best["metrics"]["roc_auc"])
    for run in runs:
        names = [r.feature_name for r in churn.importance(spark, run, features).collect()]
        assert len(names) == len(set(names)) and "numeric__tenure_months" in names
        assert any(n.startswith("categorical__contract_type_") for n in names)
    unseen = features.limit(3).withColumn("contract_type", F.lit("never seen")).withColumn("tenure_months", F.lit(None).cast("int"))
    assert churn.publish(best, unseen).count() == 3
    assert churn.run_table(spark, runs).first().input_example


def test_files_flow_to_executive_kpis(spark, wh, tmp_path, store):
    from subscope.plans.landing import Landing

    options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "ignoreTrailingWhiteSpace": False}
    raw = lambda n: wh.raw(n).drop(ingest.VERSION)
    raw("customers_raw").write.options(**options).csv(str(tmp_path / "customers"))
    raw("complaints_raw").write.options(**options).csv(str(tmp_path / "complaints"))
    raw("billing_raw").dropDuplicates(["invoice_id"]).write.json(str(tmp_path / "billing"))
    raw("network_events_raw").write.json(str(tmp_path / "network_events"))
    landing = Landing(spark, str(tmp_path), store).ingest()
    reports = {n: r.first().asDict() for n, r in landing.quality_reports().items()}
    assert reports["customers_raw"]["total_records"] == 150 and reports["customers_raw"]["null_customer_ids"] == 0
    first = landing.bronze("billing_raw").select("_batch_id").distinct().count()
    assert first == 1
    got = landing.warehouse("sha2").gold("executive_kpis").first()
    want = wh.gold("executive_kpis").first()
    same = ["total_customers", "churned_customers", "monthly_recurring_revenue", "total_complaints", "total_outage_events", "average_network_quality_score"]
    assert [got[c] for c in same] == [want[c] for c in same]
    events = landing.bronze("network_events_raw").count()
    landing.ingest()
    assert landing.bronze("network_events_raw").count() == events, "a second run reads no file twice"
    assert store.versions("bronze", "customers_raw") == [1, 2]


def test_tables_and_landing_files_are_compressed(spark, wh, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"), "compressed").create_layers()
    store.write(spark.range(10), "gold", "t")
    store.append(spark.range(3), "gold", "t")
    written = [p.name for p in (tmp_path / "store").rglob("part-*")]
    assert written and all(".zstd." in name for name in written) and store.read("gold", "t").count() == 13
    path = registry._json(wh, "billing_raw", "billing")
    assert all(p.name.endswith(".json.gz") for p in pathlib.Path(path).glob("part-*"))
    assert files.billing(spark, path).count() == wh.raw("billing_raw").count()
