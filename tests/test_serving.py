import datetime as dt

import duckdb
import pytest

from lakestrata.operators.contracts import SERVING_TABLES
from lakestrata.sinks import serving
from lakestrata.sinks.serving import (
    Database,
    constraint_faults,
    create_table_sql,
    dry_run,
    lower_names,
    publish,
    publish_statements,
    serving_rows,
    upsert_sql,
)

DAILY = "gold_daily_orders_summary"
SCHEMA = (
    "order_date date, order_status string, total_orders long, unique_customers long, avg_delivery_days double, "
    "delivered_orders long, cancelled_orders long, report_year int, report_month int, _gold_calculated_at timestamp"
)


def mart(spark, *days, total=10):
    now = dt.datetime(2026, 5, 3)
    rows = [(dt.date(2026, 5, d), "delivered", total, 5, 2.345, 10, 0, 2026, 5, now) for d in days]
    return spark.createDataFrame(rows, SCHEMA)


def test_upsert_statement():
    sql = upsert_sql("public.t", ["a", "b", "c"], ["a", "b"], "s")
    assert sql == (
        "INSERT INTO public.t (a, b, c) SELECT DISTINCT a, b, c FROM s ON CONFLICT (a, b) "
        "DO UPDATE SET c = EXCLUDED.c, _postgres_loaded_at = CURRENT_TIMESTAMP"
    )
    assert upsert_sql("public.t", ["a"], ["a"], "s").endswith("ON CONFLICT (a) DO NOTHING")


def test_keys_and_unknown_names():
    keys = {name: t.key for name, t in SERVING_TABLES.items()}
    assert keys[DAILY] == ("order_date", "order_status")
    assert keys["gold_daily_zone_metrics"] == ("pickup_date", "pulocationid", "payment_type")
    assert keys["gold_customer_metrics"] == ("customer_id",)
    with pytest.raises(ValueError, match="unknown table"):
        publish_statements("nope", ["a"], "s", "upsert")
    with pytest.raises(ValueError, match="unknown mode"):
        publish_statements(DAILY, ["a"], "s", "replace")


def test_serving_rows_take_names_and_types(spark):
    rows = serving_rows(mart(spark, 1), DAILY)
    assert dict(rows.dtypes)["avg_delivery_days"] == "decimal(8,2)" and str(rows.first().avg_delivery_days) == "2.35"
    assert lower_names(spark.createDataFrame([(1,)], "PULocationID int")).columns == ["pulocationid"]


def test_constraint_faults(spark):
    rows = serving_rows(mart(spark, 1).unionAll(mart(spark, 1)), DAILY)
    found = {r.constraint: r.violations for r in constraint_faults(rows, DAILY).collect()}
    assert found["primary key (order_date, order_status)"] == 1 and found["order_status not null"] == 0
    wide = serving_rows(mart(spark, 1).selectExpr("* EXCEPT (order_status)", "repeat('x', 33) AS order_status"), DAILY)
    assert {r.constraint: r.violations for r in constraint_faults(wide, DAILY).collect()}["order_status at most 32"] == 1


def test_tables_fill_required_columns_by_default():
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE SCHEMA IF NOT EXISTS public")
    con.execute(create_table_sql(DAILY))
    con.execute(f"INSERT INTO public.{DAILY} (order_date, order_status, report_year, report_month) VALUES (DATE '2024-03-05', 'shipped', 2024, 3)")
    row = con.execute(f"SELECT total_orders, cancelled_orders, avg_delivery_days, _gold_calculated_at IS NOT NULL FROM public.{DAILY}").fetchone()
    assert row == (0, 0, None, True)
    with pytest.raises(duckdb.ConstraintException):
        con.execute(f"INSERT INTO public.{DAILY} (order_date, order_status, report_year) VALUES (DATE '2024-03-06', 'shipped', 2024)")


class Shelf:
    """The statements run in DuckDB, which reads them like PostgreSQL; the JDBC copy is replaced by a hand-over."""

    def __init__(self, monkeypatch, twice=False):
        self.con = duckdb.connect()
        self.con.execute("CREATE SCHEMA IF NOT EXISTS public")
        for name in SERVING_TABLES:
            self.con.execute(create_table_sql(name))
        self.twice = twice
        self.staged = []
        monkeypatch.setattr(serving, "write_jdbc", self.write)

    def write(self, df, database, table, mode="overwrite", truncate=True, **options):
        rows = df.toArrow()
        self.con.register("incoming", rows)
        self.con.execute(f"CREATE TABLE {table} AS SELECT * FROM incoming")
        if self.twice:  # a lost task ran again and wrote its rows a second time
            self.con.execute(f"INSERT INTO {table} SELECT * FROM incoming")
        self.staged.append(table)
        return rows.num_rows

    def run(self, spark, statements):
        self.con.execute("BEGIN")
        try:
            for text in statements:
                # DuckDB takes CURRENT_TIMESTAMP after SET for a column name
                self.con.execute(text.replace("= CURRENT_TIMESTAMP", "= now()"))
            self.con.execute("COMMIT")
        except Exception:
            self.con.execute("ROLLBACK")
            raise

    def rows(self, columns="order_date, total_orders"):
        return self.con.execute(f"SELECT {columns} FROM public.{DAILY} ORDER BY ALL").fetchall()


@pytest.mark.parametrize("twice", [False, True])
def test_publish_twice_is_publish_once(spark, monkeypatch, twice):
    shelf = Shelf(monkeypatch, twice)
    db = Database("jdbc:unused")
    for _ in range(2):
        assert publish(mart(spark, 1, 2), DAILY, db, run=shelf.run) == 2
        assert shelf.rows() == [(dt.date(2026, 5, 1), 10), (dt.date(2026, 5, 2), 10)]
    assert publish(mart(spark, 2, 3, total=15), DAILY, db, run=shelf.run) == 2
    assert [n for _, n in shelf.rows()] == [10, 15, 15]
    assert publish(mart(spark, 9), DAILY, db, "overwrite", run=shelf.run) == 1
    assert shelf.rows() == [(dt.date(2026, 5, 9), 10)]
    assert publish(mart(spark), DAILY, db, "overwrite", run=shelf.run) == 0
    assert len(shelf.rows()) == 1
    left = shelf.con.execute("SELECT count(*) FROM information_schema.tables WHERE table_name LIKE '%staging%'").fetchone()
    assert left == (0,) and len(shelf.staged) == 5


def test_failed_publish_changes_nothing(spark, monkeypatch):
    shelf = Shelf(monkeypatch)
    db = Database("jdbc:unused")
    publish(mart(spark, 1), DAILY, db, run=shelf.run)

    def fail_late(session, statements):
        shelf.run(session, statements if "DROP" in statements[0] else [*statements, "SELECT * FROM no_such_table"])

    with pytest.raises(duckdb.Error):
        publish(mart(spark, 5), DAILY, db, "overwrite", run=fail_late)
    assert shelf.rows() == [(dt.date(2026, 5, 1), 10)]
    with pytest.raises(ValueError, match="primary key"):
        publish(mart(spark, 1).unionAll(mart(spark, 1, total=2)), DAILY, db, run=shelf.run)


def test_database_runs_one_transaction(spark, monkeypatch):
    calls = []

    class Connection:
        def __getattr__(self, name):
            def call(*args):
                calls.append((name, *args))
                if args == ("bad",):
                    raise RuntimeError("refused")
                return self

            return call

    db = Database("jdbc:unused")
    monkeypatch.setattr(Database, "connect", lambda self, session: Connection())
    db.run(spark, ["one", "two"])
    names = [c[0] for c in calls]
    assert names == ["setAutoCommit", "createStatement", "execute", "execute", "commit", "close"]
    calls.clear()
    with pytest.raises(RuntimeError):
        db.run(spark, ["bad", "two"])
    assert [c[0] for c in calls][-2:] == ["rollback", "close"]
    assert db.options("t")["numPartitions"] == 16


def test_driver_class_is_loaded_and_asked(spark):
    with pytest.raises(ValueError, match="does not accept"):
        Database("jdbc:none:x", driver="org.apache.hive.jdbc.HiveDriver", properties={"user": "u"}).connect(spark)
    with pytest.raises(Exception, match="ClassNotFoundException"):
        Database("jdbc:none:x", driver="no.such.Driver").connect(spark)


def test_dry_run(spark):
    r = dry_run(mart(spark, 1, 2), DAILY).first()
    assert r.row_count == 2 and "ON CONFLICT (order_date, order_status)" in r.statement and "order_date date" in r.columns
