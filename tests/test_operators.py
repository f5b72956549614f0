import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import layout, marts, quality, views
from lakestrata.operators.contracts import DAILY_ORDERS, DAILY_ZONES, SILVER_ORDERS, conform
from lakestrata.operators.dedup import distinct_by, keep_first, latest_by
from lakestrata.operators.merge import key_faults, merge_rows
from lakestrata.operators.split import keep_in_range, rejects_by_reason, require_key, split_invalid
from lakestrata.plans import orders, sales, trips

QUARANTINE = [
    ("p17", "ann", None, "f"),
    (None, "bob", None, "f"),
    ("p18", None, "p18;cut", "f"),
    ("  ", "cyd", None, "f"),
    ("p19", "dan", None, "f"),
    ("", "eve", None, "f"),
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_covers_the_input(spark):
    df = spark.createDataFrame(QUARANTINE, "order_id string, customer_id string, _corrupt_record string, _source_file string")
    valid, bad = split_invalid(df, "order_id")
    assert sorted(r.order_id for r in valid.collect()) == ["p17", "p19"]
    assert bad.count() == 4 and "_quarantined_at" in bad.columns and "_corrupt_record" not in valid.columns
    again = valid.select("order_id", "customer_id").unionAll(bad.select("order_id", "customer_id"))
    assert again.exceptAll(df.select("order_id", "customer_id")).count() == 0 and again.count() == df.count()


def test_split_with_required_columns(spark):
    df = spark.createDataFrame([("A", None, None), ("B", "c", None)], "order_id string, customer_id string, _corrupt_record string")
    valid, bad = split_invalid(df, "order_id", ["customer_id"])
    assert [r.order_id for r in valid.collect()] == ["B"] and [r.order_id for r in bad.collect()] == ["A"]


def test_range_filter_and_reasons(spark):
    df = spark.createDataFrame([(1.0, 1), (-1.0, 2), (None, 3), (2.0, None), (-5.0, None)], "fare double, t int")
    assert keep_in_range(df, {"fare": 0.0}, ["t"]).collect() == [(1.0, 1)]
    reasons = {r.reason: r.row_count for r in rejects_by_reason(df, {"fare": 0.0}, ["t"]).collect()}
    assert reasons == {"fare below 0": 2, "fare missing": 1, "t missing": 2}


def test_orders_clean(spark):
    rows = [
        ("x7", "ann", " Delivered", "2023-12-31 23:59:58"),
        (" y1 ", "bob", "INVOICED", "2024-02-29 07:15:00"),
        ("x7", "ann", "delivered  ", "2024-01-01 00:00:02"),
        ("z4", "cyd", "lost", "31.12.2023"),
    ]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, order_purchase_timestamp string")
    for c in orders.TIMES[1:]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    out = {r.order_id: r for r in orders.clean(df.withColumn("_source_file", F.lit("f"))).collect()}
    assert set(out) == {"x7", "y1", "z4"}
    assert out["x7"].order_purchase_timestamp.second == 2 and out["x7"].order_status == "delivered"
    assert (out["x7"].order_year, out["x7"].order_month) == (2024, 1)
    assert (out["y1"].order_year, out["y1"].order_month) == (2024, 2)
    assert (out["z4"].order_year, out["z4"].order_month) == (1970, 1)
    assert all(r._ingested_at for r in out.values())


def test_trips_clean(spark):
    base = {c: "1" for c in trips.RAW_COLUMNS} | {
        "tpep_pickup_datetime": "2026-06-01 09:00:00", "tpep_dropoff_datetime": "2026-06-01 09:10:00", "store_and_fwd_flag": " N ",
    }
    changes = [{}, {"passenger_count": "3"}, {"VendorID": "2.0", "tip_amount": "x"}, {"fare_amount": "-1"}, {"tpep_pickup_datetime": "no"}]
    df = spark.createDataFrame([base | c for c in changes], trips.RAW_SCHEMA).withColumn("_source_file", F.lit("f"))
    out = sorted(trips.clean(df).collect(), key=lambda r: r.VendorID)
    assert [(r.VendorID, r.passenger_count, r.tip_amount, r.store_and_fwd_flag) for r in out] == [(1, 3, 1.0, "N"), (2, 1, None, "N")]
    assert (out[0].pickup_year, out[0].pickup_month, out[0].tpep_pickup_datetime) == (2026, 6, "2026-06-01 09:00:00")


def test_sales_clean(spark):
    at = lambda h, m=0: dt.datetime(2022, 3, 4, h, m)
    rows = [
        ("s2", "bob", "2022-03-03 22:10:00", 8.25, " Returned", at(6)),
        (None, "cyd", "2022-03-04 01:00:00", 3.5, "completed", at(7)),
        ("s1", "ann", "2022-03-04 02:00:00", 19.0, "completed ", at(9, 30)),
        ("s1", "ann", "2022-03-04 02:00:00", 21.0, "COMPLETED", at(8)),
    ]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, order_date string, amount double, status string, _ingested_at timestamp")
    out = {r.order_id: r for r in sales.clean(df).collect()}
    assert {k: r.status for k, r in out.items()} == {"s1": "completed", "s2": "returned"}
    assert (out["s1"]._ingested_at, out["s1"].amount) == (at(9, 30), 19.0)
    assert require_key(df, "order_id").count() == 3


def test_keep_first_is_repeatable_and_cuts_rows_before_the_shuffle(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    first = {tuple(r) for r in keep_first(df.repartition(7), ["k"], [F.desc("a")]).collect()}
    assert first == {tuple(r) for r in keep_first(df.repartition(3), ["k"], [F.desc("a")]).collect()}
    text = plan(latest_by(df, ["k"], "a"))
    assert "Partial" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert latest_by(df, ["k"], "a").count() == 3


def test_distinct_by_takes_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 5)], "k int, v int")
    assert sorted((tuple(r) for r in distinct_by(df, ["k"]).collect()), key=str) == [(1, 5), (None, 2)]


def test_merge_rows(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "k int, v string, t int")
    wide = spark.createDataFrame([("B", 2, 4, "x"), ("C", 3, 1, "x")], "v string, k int, t int, spare string")
    with pytest.raises(ValueError, match="spare"):
        merge_rows(target, wide, ["k"])
    assert {tuple(r) for r in merge_rows(target, wide, ["k"], evolve=True).collect()} == {(1, "a", 5, None), (2, "B", 4, "x"), (3, "C", 1, "x")}
    source = wide.drop("spare")
    assert {tuple(r) for r in merge_rows(target, source, ["k"]).collect()} == {(1, "a", 5), (2, "B", 4), (3, "C", 1)}
    guarded = merge_rows(target, source, ["k"], newer_than="t")
    assert {tuple(r) for r in guarded.collect()} == {(1, "a", 5), (2, "b", 5), (3, "C", 1)}
    odd = spark.createDataFrame([(None, "n", 1), (None, "m", 2), (4, "x", 1), (4, "y", 2), (5, "z", None)], "k int, v string, t int")
    late = spark.createDataFrame([(4, "late", 1), (5, "new", None)], "k int, v string, t int")
    kept = merge_rows(odd, late, ["k"], newer_than="t")
    assert sorted(r.v for r in kept.collect()) == ["m", "n", "new", "x", "y"]
    faults = key_faults(spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int"), ["k"]).first()
    assert (faults.null_keys, faults.repeated_keys) == (1, 1)


ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_delivered_customer_date timestamp"


def silver(spark):
    t = dt.datetime
    rows = [
        ("a", "ann", "delivered", t(2021, 11, 30, 1), t(2021, 12, 2, 4)),
        ("b", "bob", "delivered", t(2021, 11, 30, 23), t(2021, 12, 7, 1)),
        ("c", "ann", "delivered", t(2021, 11, 30, 6), None),
        ("d", "cyd", "canceled", t(2021, 12, 1, 6), None),
    ]
    return spark.createDataFrame(rows, ORDERS)


def test_daily_orders(spark):
    mart = marts.daily_orders(silver(spark))
    assert dict(mart.dtypes) == DAILY_ORDERS
    rows = {(str(r.order_date), r.order_status): r for r in mart.collect()}
    assert len(rows) == 2
    r = rows["2021-11-30", "delivered"]
    # 2 and 7 days by date
    assert (r.total_orders, r.unique_customers, r.avg_delivery_days, r.delivered_orders, r.cancelled_orders) == (3, 2, 4.5, 3, 0)
    assert (r.report_year, r.report_month) == (2021, 11)
    assert rows["2021-12-01", "canceled"].avg_delivery_days is None


def test_daily_zones(spark):
    t = dt.datetime
    rows = [
        (t(2020, 8, 9, 23), 77, 1, 12.4, 2.2, 9.0, 1.5),
        (t(2020, 8, 9, 0), 77, 1, 17.7, 4.4, 14.0, 2.5),
        (t(2020, 8, 9, 5), 77, 1, 9.9, 0.9, 7.0, 0.5),
        (t(2020, 8, 9, 5), 77, 3, 6.0, 1.0, 5.0, 0.0),
        (t(2020, 8, 9, 5), None, 3, 6.0, 1.0, 5.0, 0.0),
    ]
    df = spark.createDataFrame(
        rows,
        "pickup_datetime timestamp, PULocationID int, payment_type int, total_amount double, trip_distance double, fare_amount double, tip_amount double",
    )
    mart = marts.daily_zones(df)
    assert dict(mart.dtypes) == DAILY_ZONES and mart.count() == 2
    r = mart.where("payment_type = 1").first()
    assert (r.total_trips, r.total_revenue, r.avg_trip_distance, r.avg_fare_per_trip, r.avg_tip_amount) == (3, 40.0, 2.5, 10.0, 1.5)


def test_sales_marts(spark):
    day = dt.datetime(2019, 4, 2)
    rows = [("s1", "ann", 12.5, "completed", day), ("s2", "bob", 40.0, "cancelled", day), ("s3", "ann", 8.5, "completed", day), ("s4", "ann", 3.0, "completed", day)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, amount double, status string, order_timestamp timestamp")
    r = marts.daily_sales(df).first()
    assert (r.total_orders, r.unique_customers, r.total_completed_revenue, r.completed_orders, r.cancelled_orders) == (4, 2, 24.0, 3, 1)
    customers = {r.customer_id: tuple(r)[1:4] for r in marts.customer_value(df).collect()}
    assert customers == {"ann": (3, 24.0, 8.0), "bob": (1, 0.0, None)}
    assert views.high_value_customers(marts.customer_value(df)).count() == 0
    assert views.high_value_customers(marts.customer_value(df), 23.99).first().customer_id == "ann"


def test_one_hot_day_is_spread_by_customer(spark):
    text = plan(marts.daily_orders(silver(spark)))
    assert "Expand" not in text and "_customer" in text.split("Exchange hashpartitioning")[2]


def test_views(spark):
    mart = marts.daily_orders(silver(spark))
    months = [(r.monthly_orders, r.monthly_delivered, r.monthly_cancelled, r.avg_delivery_time_days) for r in views.monthly_trends(mart).collect()]
    assert months == [(1, 0, 1, None), (3, 3, 0, 4.5)]
    report = views.delivery_report(mart, dt.date(2021, 12, 1))
    assert [r.order_status for r in report.collect()] == ["canceled"]
    assert {r.label: r.total for r in views.label_totals(mart, "order_status", "total_orders").collect()} == {"delivered": 3, "canceled": 1}
    found = views.search(mart.select("order_status", "total_orders", F.lit(None).alias("n")), "CANCEL")
    assert [r.order_status for r in found.collect()] == ["canceled"]
    assert views.search(mart, "").count() == 2
    ordered = views.sort_by(mart, "total_orders", True, ["order_date", "order_status"]).collect()
    assert [r.total_orders for r in ordered] == [3, 1] and ordered[1].order_status == "canceled"


def test_quality_checks(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), (" ", None)], "k string, n int")
    got = {
        (r.check, r.column): (r.violations, r.passed)
        for check in (
            quality.schema_check(df, "t", {"k": "string", "n": "bigint", "gone": "int"}),
            quality.null_check(df, "t", ["k", "n"]),
            quality.unique_check(df, "t", ["k"]),
            quality.range_check(df, "t", {"n > 0": F.col("n") > 0}),
            quality.not_empty_check(df.where("false"), "t"),
        )
        for r in check.collect()
    }
    assert got == {
        ("schema", "k"): (0, True),
        ("schema", "n"): (1, False),
        ("schema", "gone"): (1, False),
        ("not_null", "k"): (1, False),
        ("not_null", "n"): (1, False),
        ("unique", "k"): (1, False),
        ("range", "n > 0"): (1, False),
        ("not_empty", "*"): (1, False),
    }
    clean = silver(spark)
    r = quality.reconcile(clean, marts.daily_orders(clean), "total_orders", "order_purchase_timestamp").first()
    assert tuple(r) == (4, 4, 0, 0, True)
    empty = clean.where("false")
    assert tuple(quality.reconcile(empty, marts.daily_orders(empty), "total_orders", "order_purchase_timestamp").first())[:3] == (0, 0, 0)


def test_row_balance_finds_lost_rows(spark):
    df = spark.createDataFrame(QUARANTINE, "order_id string, customer_id string, _corrupt_record string, _source_file string")
    df = df.where("_corrupt_record IS NULL")
    raw = df.unionAll(df.where("order_id = 'p17'"))
    kept = spark.createDataFrame([("p17",), ("p19",)], "order_id string")
    assert tuple(quality.row_balance(raw, kept, "order_id").first()) == (6, 3, 1, 2, True)
    assert not quality.row_balance(raw, kept.limit(1), "order_id").first().passed


def test_conform(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    assert conform(df, {"b": "bigint", "a": "int"}).dtypes == [("b", "bigint"), ("a", "int")]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        conform(df, {"c": "int"})
    assert SILVER_ORDERS["order_year"] == "int"


def test_clustering_depth_counts_the_ranges_a_value_meets(spark, tmp_path):
    path = str(tmp_path / "t")
    for low, high in ((0, 9), (9, 20), (5, 6), (30, 30)):
        spark.createDataFrame([(low, None), (high, None)], "x int, y int").coalesce(1).write.mode("append").parquet(path)
    rows = {r.column: (r.files, r.mean_depth, r.max_depth) for r in layout.clustering_depth(spark.read.parquet(path), ["x", "y"]).collect()}
    # depths where files begin: 1 at 0, 2 at 5, 2 at 9, 1 at 30
    assert rows == {"x": (4, 1.5, 2), "y": (0, None, None)}


def test_unequal_rows_name_lost_and_added_rows(spark):
    schema = "k int, v string, x double"
    before = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, None), (3, "c", 3.0), (None, "d", 4.0)] + [(i, "z", 0.0) for i in range(10, 300)], schema)
    after = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, "c", 3.5), (None, "d", 4.0)] + [(i, "z", 0.0) for i in range(299, 9, -1)], schema)
    found = {tuple(r) for r in quality.unequal_rows(before, after, ["k"], buckets=16).collect()}
    assert found == {(1, "a", 1.0, "lost"), (3, "c", 3.0, "lost"), (3, "c", 3.5, "added")}
    assert quality.unequal_rows(before, before.repartition(3).select("x", "v", "k"), ["k"]).count() == 0
    assert quality.unequal_rows(before.limit(0), after.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        quality.unequal_rows(before, after.drop("x"), ["k"])
