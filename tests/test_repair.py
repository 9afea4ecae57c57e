from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.operators.drift import AUDIT_FIELDS
from pactloom.plans import repair
from pactloom.sinks import tables as sinks
from pactloom.sources.tables import create_table
from pactloom.streaming import seen

REQUEST = "trace_id string, table_ref string, added array<string>, removed array<string>, is_deletion boolean, published_at timestamp"


def requests(spark, *items):
    data = [(t, table, added, removed, gone, datetime(2024, 1, 1, at)) for t, table, added, removed, gone, at in items]
    return spark.createDataFrame(data, REQUEST)


@pytest.fixture
def targets(spark, db):
    fields = [{"name": c, "type": "STRING", "defaultValueExpression": "NULL"} for c in ("k", "v")] + list(AUDIT_FIELDS)
    for name in ("things_raw", "things_raw_hist"):
        create_table(spark, f"{db}.{name}", fields, partition_by="batch_date")
        sinks.append_raw(spark.createDataFrame([("1", "a")], "k string, v string"), f"{db}.{name}")
    return repair.RepairTargets(f"{db}.requests", f"{db}.versions", [db], staging=db, marts=db)


def test_tables_change_once(spark, db, targets):
    raw, history = f"{db}.things_raw", f"{db}.things_raw_hist"
    batch = requests(
        spark,
        ("a", raw, ["new", "V", "odd `name`"], ["v"], False, 1),
        ("a", raw, ["twice"], [], False, 1),  # the same message again, told apart by nothing
        ("b", raw, ["late"], [], False, 2),
        ("c", raw, [], ["late"], False, 3),
        ("d", f"{db}.fresh_raw", ["p", "P", "batch_date"], [], False, 1),
        ("e", "elsewhere.things_raw", ["x"], [], False, 1),
        ("f", f"{db}.bad name", ["x"], [], False, 1),
    )
    assert repair.apply_requests(batch, targets, "1") == 2
    assert spark.table(raw).columns[0] == "k" and {"new", "odd `name`"} <= set(spark.table(raw).columns)
    assert "late" not in spark.table(raw).columns and "v" in spark.table(history).columns
    assert rows(spark.table(raw).select("k", "new")) == [("1", None)] and spark.table(history).where("v = 'a'").count() == 1
    assert [c.lower() for c in spark.table(f"{db}.fresh_raw").columns] == ["p", "processed_dttm", "batch_date"]
    assert not spark.catalog.tableExists("elsewhere.things_raw")
    before = [rows(spark.table(t)) for t in (targets.versions, raw)]
    assert repair.apply_requests(batch, targets, "1") == 0
    assert [rows(spark.table(t)) for t in (targets.versions, raw)] == before
    sinks.append_raw(spark.createDataFrame([("2", "n")], "k string, new string"), raw)
    assert spark.table(raw).where("new = 'n'").count() == 1


def test_a_stop_before_the_log_changes_nothing_twice(spark, db, targets, monkeypatch):
    raw = f"{db}.things_raw"
    batch = requests(spark, ("a", raw, ["new"], ["v"], False, 1))
    with monkeypatch.context() as patch:
        patch.setattr(repair.sinks, "append_table", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            repair.apply_requests(batch, targets, "1")
    columns = spark.table(raw).columns
    repair.apply_requests(batch, targets, "1")
    assert spark.table(raw).columns == columns and "new" in columns and "v" not in columns
    assert spark.table(targets.requests).count() == 1 and spark.table(raw).count() == 1


def test_dropped_entities(spark, db, targets):
    for name in ("stg_things", "fct_things"):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
    repair.apply_requests(requests(spark, ("a", f"{db}.things_raw", [], [], True, 1)), targets, "1")
    names = {t.name for t in spark.catalog.listTables(db)}
    assert not names & {"stg_things", "fct_things"} and "things_raw" in names
    assert rows(spark.table(targets.versions).select("action", "version")) == [("drop_entity", 1)]


def test_seen_keys(spark, db):
    keys = seen.SeenKeys(f"{db}.seen", f"{db}.out", days=3, buckets=4)

    def send(number, day, *items):
        batch = spark.createDataFrame([(k, datetime(2024, 1, 1, h), v) for k, h, v in items], "trace_id string, published_at timestamp, v string")
        seen.take_batch(batch, number, keys, day)
        return rows(seen.given(spark, keys).select("trace_id", "v"))

    assert send(0, "2024-01-01", ("a", 2, "later"), ("a", 1, "z"), ("a", 1, "y"), (None, 1, "n"), (None, 1, "n")) == [("a", "y"), (None, "n"), (None, "n")]
    first = send(1, "2024-01-02", ("a", 1, "again"), ("b", 1, "b"))
    assert first == [("a", "y"), ("b", "b"), (None, "n"), (None, "n")]
    assert send(1, "2024-01-02", ("a", 1, "again"), ("b", 1, "b")) == first  # delivered once more
    # The day of ``a`` is past its time, that of ``b`` isn't.
    assert send(2, "2024-01-04", ("a", 1, "anew"), ("b", 1, "no")) == [("a", "anew"), ("a", "y"), ("b", "b"), (None, "n"), (None, "n")]
    days = {r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.seen").collect()}
    assert days == {"seen_on=2024-01-02", "seen_on=2024-01-04"}


def test_a_message_sent_often_meets_once_for_each_task(spark):
    keys = seen.SeenKeys("x", "y")
    sent = spark.range(0, 40_000, 1, 8).select(F.lit("one").alias("trace_id"), F.timestamp_seconds("id").alias("published_at"), F.lit("v").alias("v"))
    first = seen.first_of_each(sent, keys)
    assert first.count() == 1
    metrics = first._jdf.queryExecution().executedPlan().toString()
    assert metrics.index("partial_min") > metrics.index("Exchange")  # reduced below the shuffle


def test_variants(spark):
    from pactloom.functions import variant

    df = spark.createDataFrame([('{"a": {"b": 1}}',), ('{"a": 2, "c": "x"}',), ("{bad",), (None,), ("",)], "t string")
    got = df.select("t", variant.as_variant("t").alias("v"), variant.is_bad_json("t").alias("bad"))
    fields = variant.variant_fields(got, "v", {"b": ("$.a.b", "int"), "c": ("$.c", "string")})
    assert [(r["bad"], r["b"], r["c"]) for r in fields.collect()] == [(False, 1, None), (False, None, "x"), (True, None, None), (False, None, None), (True, None, None)]
    assert "c: STRING" in variant.variant_schema(got, "v").first()["schema"]
