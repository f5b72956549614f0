import json

import pytest

from lakestrata.operators import quality
from lakestrata.plans import orders, stages, trips
from lakestrata.sinks.serving import Database
from lakestrata.sources.raw import read_csv_permissive
from lakestrata.sources.tables import Lake, read_table

HEADER = ",".join(orders.RAW_COLUMNS)


def order(key, status="DELIVERED", bought="2026-05-01 10:00:00", arrived="2026-05-04 09:00:00"):
    return f"{key},CUST-{key},{status},{bought},,,{arrived},"


def write(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_orders_to_gold(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    first = write(tmp_path / "in" / "a.csv", HEADER, [order("A"), order("A", bought="2026-05-01 08:00:00"), order("B", "Shipped", arrived=""), "C,cut", order(" ")])
    assert stages.bronze_to_silver(spark, lake, source_path=first) == {"quarantined": 2, "silver": 2}
    silver = read_table(spark, lake.path("silver", "orders"))
    assert {r.order_id: r.order_status for r in silver.collect()} == {"A": "delivered", "B": "shipped"}
    raw = read_csv_permissive(spark, first, orders.RAW_SCHEMA)
    assert tuple(quality.row_balance(raw, silver, "order_id").first()) == (5, 2, 1, 2, True)

    second = write(tmp_path / "in" / "b.csv", HEADER, [order("B", "canceled", "2026-06-01 00:00:00", ""), order("D")])
    for _ in range(2):
        stages.bronze_to_silver(spark, lake, source_path=second)
    silver = read_table(spark, lake.path("silver", "orders"))
    assert sorted((r.order_id, r.order_status, r.order_month) for r in silver.collect()) == [
        ("A", "delivered", 5), ("B", "canceled", 6), ("D", "delivered", 5),
    ]
    assert stages.silver_to_gold(spark, lake) == {"gold_daily_orders_summary": 2}
    mart = read_table(spark, lake.path("gold", "gold_daily_orders_summary"))
    assert quality.reconcile(silver, mart, "total_orders", "order_purchase_timestamp").first().passed
    assert mart.where("order_status = 'delivered'").first().avg_delivery_days == 3.0


def test_run_all_reports_every_stage(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    write(tmp_path / "lake/bronze/raw/ecommerce/olist_orders_dataset.csv", HEADER, [order("A")])
    ride = ["1", "2026-06-01 09:00:00", "2026-06-01 09:10:00", *["1"] * 15]
    write(tmp_path / "lake/bronze/raw/nyctaxi/nyc_yellow_taxi_trips.csv", ",".join(trips.RAW_COLUMNS), [",".join(ride)])
    summary = stages.run_all(spark, lake, "all", database=Database("jdbc:none", driver="no.such.Driver"))
    status = {(r.stage, r.item): (r.row_count, r.status[:6]) for r in summary.collect()}
    assert status["silver", "ecommerce silver"] == (1, "ok") and status["gold", "gold_daily_zone_metrics"] == (1, "ok")
    assert status["serving", "gold_daily_orders_summary"] == (None, "failed")
    assert read_table(spark, lake.path("gold", "gold_daily_zone_metrics")).count() == 1
    skipped = stages.run_all(spark, lake, "ecommerce")
    assert {r.status for r in skipped.where("stage = 'serving'").collect()} == {"skipped"}


def test_sales_stages(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    batch = [
        {"order_id": 1, "customer_id": "A", "amount": 100.0, "status": " COMPLETED", "order_date": "2026-09-25 10:00:00"},
        {"order_id": None, "customer_id": "B", "amount": 5.0, "status": "completed", "order_date": "2026-09-25"},
    ]
    (tmp_path / "one.json").write_text(json.dumps(batch, indent=1))
    (tmp_path / "two.json").write_text(json.dumps([batch[0] | {"amount": 70.0, "channel": "web"}, batch[0] | {"order_id": 2, "status": "cancelled"}]))
    done = stages.run_sales(spark, lake, source_path=str(tmp_path / "one.json"))
    assert done == {"bronze": 2, "silver": 1, "gold_daily_sales": 1, "gold_customer_metrics": 1}
    with pytest.raises(ValueError, match="unknown stage"):
        stages.run_sales(spark, lake, "platinum")


def test_sales_bronze_evolves(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    (tmp_path / "one.json").write_text(json.dumps([{"order_id": 1, "customer_id": "A", "amount": 100.0, "status": "completed", "order_date": "2026-09-25"}]))
    (tmp_path / "two.json").write_text(json.dumps([{"order_id": 1, "customer_id": "A", "amount": 70.0, "status": "completed", "order_date": "2026-09-25", "channel": "web"}]))
    for name in ("one.json", "two.json"):
        stages.ingest_json(spark, lake, str(tmp_path / name))
        stages.sales_to_silver(spark, lake)
        seen = read_table(spark, lake.path("silver", "cleaned_orders"))
        assert seen.first().amount == (100.0 if name == "one.json" else 70.0)
    assert seen.select("amount", "channel").collect() == [(70.0, "web")]
    stages.ingest_json(spark, lake, str(tmp_path / "one.json"), mode="overwrite")
    assert read_table(spark, lake.path("bronze", "raw_orders")).count() == 1


def test_stage_errors(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="unsupported"):
        stages.bronze_to_silver(spark, lake, "weather")
    with pytest.raises(ValueError, match="unknown dataset"):
        stages.silver_to_gold(spark, lake, "weather")
    with pytest.raises(FileNotFoundError):
        stages.silver_to_gold(spark, lake)


def test_check_landing(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", HEADER, [order("A")])
    write(tmp_path / "out" / "a.csv", HEADER, [order("A")])
    write(tmp_path / "out" / "b.csv", HEADER, [order("B")])
    rows = {r.file_name: r.status for r in stages.check_landing(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert rows == {"a.csv": "ok", "b.csv": "unexpected"}
