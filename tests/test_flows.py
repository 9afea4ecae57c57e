import json
import os
import threading
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.contract import orders_contract
from pactloom.operators.drift import AUDIT_FIELDS
from pactloom.plans import entity, ingest as flow
from pactloom.sinks import ledger, moves, tables as sinks
from pactloom.sources import files, tables
from pactloom.streaming import arrivals, events

AS_OF = "2024-01-07 12:00:00"
COLUMNS = ["order_id", "customer_name", "amount", "status", "order_date", "warehouse_id"]


def text_fields(names):
    return [{"name": n, "type": "STRING", "defaultValueExpression": "NULL"} for n in names] + list(AUDIT_FIELDS)


@pytest.fixture
def landing(spark, db, tmp_path):
    """Raw tables, rules, and a folder with one file for every outcome."""
    tables.create_table(spark, f"{db}.pairs_raw", text_fields(["a", "b"]), partition_by="batch_date")
    tables.create_table(spark, f"{db}.snap_raw", text_fields(["a", "b"]), partition_by="batch_date")
    rules = f"""SELECT * FROM VALUES
      ('pairs_.*[.](csv|txt)$', '{db}', 'pairs_raw', 'sales', ' pairs.yaml ', 'csv', '|', NULL, true),
      ('pairs_.*', '{db}', 'pairs_raw', 'sales', 'nan', NULL, NULL, NULL, true),
      ('snap_', '{db}', 'snap_raw', 'sales', NULL, NULL, NULL, NULL, true),
      ('lost_', '{db}', 'nowhere', 'sales', NULL, NULL, NULL, NULL, true),
      ('bare_', '{db}', 'pairs_raw', 'sales', NULL, NULL, NULL, 0, true)
      AS t(file_pattern, target_dataset, target_table, domain, data_contracts, file_format, delimiter, skip_header_rows, is_active)"""
    disposition = F.when(F.col("file_pattern") == "snap_", "write_truncate").alias("write_disposition")
    created = F.when(F.col("file_format") == "csv", F.lit("2024-01-01").cast("timestamp")).alias("created_at")
    spark.sql(rules).select("*", disposition, created).write.saveAsTable(f"{db}.rules")
    root = tmp_path / "landing"
    contents = {
        "pairs_1.csv": "a|b\n1|x\n2|\n",
        "pairs_2.txt": "b|a\ny|3\n",
        "pairs_3.json": "".join(json.dumps({"a": i, "b": "j"}) + "\n" for i in range(4, 6)),
        "pairs_late.json": "".join(json.dumps({"a": 1, "b": 2}) + "\n" for i in range(60)) + '{"a": 1, "c": 3}\n',
        "pairs_drift.csv": "a|c\n7|new\n",
        "pairs_ragged.csv": "a|b\n8|x\n9\n",
        "pairs_broken.json": '{"a": 1, "b": 2}\n{"a": 1,\n',
        "pairs_4.avro": "zz",
        "lost_1.csv": "p,q\n1,2\n",
        "bare_1.csv": "10,z\n",
        "odd.csv": "a,b\n1,2\n",
        "processed/pairs_0.csv": "a|b\n1|x\n",
        "with space/pairs_[5]+%20.csv": "a|b\n11|sp\n",
    }
    for name, content in contents.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    spark.createDataFrame([(20, "p")], "a bigint, b string").coalesce(1).write.parquet(str(tmp_path / "p"))
    os.replace(next((tmp_path / "p").glob("*.parquet")), root / "pairs_6.parquet")
    return root


EXPECTED = {
    "pairs_1.csv": ("SUCCESS", 2, 1),
    "pairs_2.txt": ("SUCCESS", 1, 0),
    "pairs_3.json": ("SUCCESS", 2, 0),
    "pairs_late.json": ("DRIFT_DETECTED", 0, 0),
    "pairs_drift.csv": ("DRIFT_DETECTED", 0, 0),
    "pairs_ragged.csv": ("FAILED", 0, 0),
    "pairs_broken.json": ("FAILED", 0, 0),
    "pairs_4.avro": ("FAILED", 0, 0),
    "lost_1.csv": ("TABLE_MISSING", 0, 0),
    "bare_1.csv": ("SUCCESS", 1, 0),
    "odd.csv": ("SKIPPED", 0, 0),
    "with space/pairs_[5]+%20.csv": ("SUCCESS", 1, 0),
    "pairs_6.parquet": ("SUCCESS", 1, 0),
}
LOADED = sorted(
    [("1", "x"), ("2", None), ("3", "y"), ("4", "j"), ("5", "j"), ("10", "z"), ("11", "sp"), ("20", "p")], key=repr
)


def check_ledger(spark, db):
    ledger = spark.table(f"{db}.ingestion_log")
    got = {r["file_name"]: (r["status"], r["total_records"], r["bad_records"]) for r in ledger.collect()}
    assert got == EXPECTED
    assert ledger.count() == len(EXPECTED)
    by_name = {r["file_name"]: r for r in ledger.collect()}
    assert by_name["pairs_drift.csv"]["error_message"] == "Drift Detected: Added=['c'], Deleted=['b']"
    assert by_name["pairs_drift.csv"]["file_uri"] == "landing/schema_pending/pairs_drift.csv_20240107120000"
    assert by_name["pairs_1.csv"]["file_uri"] == "landing/processed/pairs_1.csv_20240107120000"
    assert by_name["odd.csv"]["file_uri"].startswith("landing/exempted/")
    assert by_name["odd.csv"]["target_table"] is None
    assert by_name["pairs_1.csv"]["data_contracts"] == "pairs.yaml"
    assert by_name["pairs_3.json"]["data_contracts"] is None
    assert "avro" in by_name["pairs_4.avro"]["error_message"]
    assert rows(spark.table(f"{db}.pairs_raw").select("a", "b")) == LOADED
    assert rows(spark.table(f"{db}.pairs_raw").select("batch_date", "processed_dttm").distinct()) == [
        (date(9999, 12, 31), datetime(2024, 1, 7, 12))
    ]
    assert not [t.name for t in spark.catalog.listTables(db) if t.name.startswith("staging_")]


def check_events(spark, folder):
    found = {e["file_name"]: e for e in (json.loads(r[0]) for r in spark.read.text(folder).collect())}
    assert set(found) == {"pairs_late.json", "pairs_drift.csv", "lost_1.csv"}
    assert found["pairs_drift.csv"]["sample_data_rows"] == [{"c": "new"}]
    assert found["pairs_late.json"]["new_column_headers"] == ["c"]
    assert found["lost_1.csv"]["new_column_headers"] == ["p", "q"]
    assert found["lost_1.csv"]["deleted_column_headers"] == []
    assert found["lost_1.csv"]["sample_data_rows"] == [{"p": "1", "q": "2"}]


def test_ingest_batch(spark, db, landing, tmp_path):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log", events_folder=str(tmp_path / "events"))
    for _ in range(2):
        listed = files.list_files(spark, str(landing))
        flow.ingest(spark, listed, spark.table(f"{db}.rules"), targets, as_of=AS_OF, batch_id="b1")
        check_ledger(spark, db)
        check_events(spark, str(tmp_path / "events"))


def test_ingest_in_small_loads(spark, db, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(flow, "FILES_PER_LOAD", 1)
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    flow.ingest(spark, files.list_files(spark, str(landing)), spark.table(f"{db}.rules"), targets, as_of=AS_OF)
    check_ledger(spark, db)


def test_ingest_stream(spark, db, landing, tmp_path):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log", events_folder=str(tmp_path / "events"))
    for _ in range(2):
        stream = arrivals.file_arrivals(spark, str(landing), files_per_batch=5)
        query = arrivals.ingest_arrivals(stream, f"{db}.rules", targets, str(tmp_path / "checkpoint"), as_of=AS_OF)
        query.awaitTermination()
        check_ledger(spark, db)
    check_events(spark, str(tmp_path / "events"))


def test_replacing_loads_keep_the_newest_file(spark, db, landing):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    for i, name in enumerate(["snap_2.csv", "snap_1.csv", "snap_3.csv"]):
        path = landing / name
        path.write_text("a,b\n9\n" if name == "snap_3.csv" else f"a,b\n{name},{i}\n")
        os.utime(path, (1700000000 + i, 1700000000 + i))
    flow.ingest(spark, files.list_files(spark, str(landing)), spark.table(f"{db}.rules"), targets, as_of=AS_OF)
    assert rows(spark.table(f"{db}.snap_raw").select("a", "b")) == [("snap_1.csv", "1")]
    statuses = spark.table(f"{db}.ingestion_log").where("file_name LIKE 'snap%'").select("file_name", "status")
    assert rows(statuses) == [("snap_1.csv", "SUCCESS"), ("snap_2.csv", "SUCCESS"), ("snap_3.csv", "FAILED")]


def test_appends_after_a_replacing_file_stay(spark, db, landing):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    rules = spark.table(f"{db}.rules").withColumn(
        "target_table", F.when(F.col("file_pattern") == "bare_", "snap_raw").otherwise(F.col("target_table"))
    )
    for i, (name, content) in enumerate([("bare_2.csv", "old,1\n"), ("snap_1.csv", "a,b\nsnap,1\n"), ("bare_3.csv", "new,1\n")]):
        (landing / name).write_text(content)
        os.utime(landing / name, (1900000000 + i, 1900000000 + i))
    flow.ingest(spark, files.list_files(spark, str(landing)), rules, targets, as_of=AS_OF)
    assert rows(spark.table(f"{db}.snap_raw").select("a", "b")) == [("new", "1"), ("snap", "1")]


def test_ingest_goes_on_after_a_crash(spark, db, landing, tmp_path, monkeypatch):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    load, done = flow._load_group, []

    def crash_on_third(*args):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(args[1]["paths"])
        return load(*args)

    def run():
        listed = files.list_files(spark, str(landing))
        flow.ingest(spark, listed, spark.table(f"{db}.rules"), targets, as_of=AS_OF, batch_id="b1")

    monkeypatch.setattr(flow, "_load_group", crash_on_third)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(flow, "_load_group", load)
    run()
    check_ledger(spark, db)


def test_the_ledger_is_pruned_by_batch(spark, db, landing):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    for b in ("b1", "b2"):
        flow.ingest(spark, files.list_files(spark, str(landing)).where("file_name LIKE 'pairs_1%'"), spark.table(f"{db}.rules"), targets, as_of=AS_OF, batch_id=b)
    found = ledger.batch_records(spark, targets.ledger, "b1")
    assert found.count() == 1 and spark.table(targets.ledger).count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"(batch_key#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert len(found.inputFiles()) < len(spark.table(targets.ledger).inputFiles())
    assert spark.table(targets.ledger).select("started_on").distinct().first()[0] == date(2024, 1, 7)


def test_loads_of_different_tables_run_side_by_side(spark, db, landing, monkeypatch):
    (landing / "snap_1.csv").write_text("a,b\ns,1\n")
    both, load = threading.Barrier(2, timeout=60), flow._load_group

    def meet(spark_, group, *rest):
        if group["table_ref"].endswith("snap_raw") or group["file_format"] == "parquet":
            both.wait()
        return load(spark_, group, *rest)

    monkeypatch.setattr(flow, "_load_group", meet)
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    wanted = files.list_files(spark, str(landing)).where("file_name IN ('snap_1.csv', 'pairs_6.parquet')")
    flow.ingest(spark, wanted, spark.table(f"{db}.rules"), targets, as_of=AS_OF)
    assert spark.table(f"{db}.snap_raw").count() == 1 and spark.table(f"{db}.pairs_raw").count() == 1


def moved_to(spark, db):
    return {r["file_name"]: r["file_uri"] for r in spark.table(f"{db}.ingestion_log").collect()}


@pytest.mark.parametrize("step", ["none", "intend", "_copy", "_delete", "append_ledger", "ledger"])
def test_files_are_moved_whatever_stops(spark, db, landing, tmp_path, monkeypatch, step):
    """A run stops before or at a step; delivered again, the batch is loaded, moved and listed once."""
    (landing / "more").mkdir()
    (landing / "more" / "pairs_1.csv").write_text("a|b\n30|again\n")
    before = {str(p.relative_to(landing)): p.read_bytes() for p in landing.rglob("*") if p.is_file()}
    targets = flow.IngestTargets(f"{db}.ingestion_log", archive_root=str(tmp_path / "archive"), moves=f"{db}.moves")
    listed = spark.createDataFrame(files.list_files(spark, str(landing)).collect())

    def run():
        flow.ingest(spark, listed, spark.table(f"{db}.rules"), targets, as_of=AS_OF, batch_id="b1")

    if step in ("intend", "append_ledger", "_copy", "_delete"):
        original, calls = getattr(moves, step), []

        def stop(*args):
            # In tasks of another process each attempt counts for itself: there the step fails for one file.
            if step in ("_copy", "_delete"):
                if "pairs_2" in args[0]:
                    raise RuntimeError("lost")
            elif len(calls) == (0 if step == "append_ledger" else 1):
                raise RuntimeError("lost")
            calls.append(1)
            return original(*args)

        with monkeypatch.context() as patch:
            patch.setattr(moves, step, stop)
            if step in ("_copy", "_delete"):
                with pytest.warns(UserWarning, match="lost"):
                    run()
                assert "pairs_2.txt" not in moved_to(spark, db)
            else:
                with pytest.raises(RuntimeError):
                    run()
    elif step == "ledger":
        run()
    run()
    addresses = moved_to(spark, db)
    assert set(addresses) == {*EXPECTED, "more/pairs_1.csv"} and spark.table(f"{db}.ingestion_log").count() == len(addresses)
    for name, address in addresses.items():
        with open(address, "rb") as moved:
            assert moved.read() == before[name]
    assert len(set(addresses.values())) == len(addresses)
    left = {str(p.relative_to(landing)) for p in landing.rglob("*") if p.is_file()}
    assert left == {"processed/pairs_0.csv"} and not list((tmp_path / "archive").rglob("*.part"))
    if step != "intend":  # what a load inserted before its intents were written is inserted again
        assert rows(spark.table(f"{db}.pairs_raw").select("a", "b")) == sorted([*LOADED, ("30", "again")], key=repr)


def test_a_taken_address_is_left_alone(spark, db, landing, tmp_path):
    targets = flow.IngestTargets(f"{db}.ingestion_log", archive_root=str(tmp_path / "archive"), moves=f"{db}.moves")
    taken = tmp_path / "archive" / "processed" / "pairs_1.csv_20240107120000"
    taken.parent.mkdir(parents=True)
    taken.write_text("another")
    wanted = files.list_files(spark, str(landing)).where("file_name = 'pairs_1.csv'")
    with pytest.warns(UserWarning, match="another file"):
        flow.ingest(spark, wanted, spark.table(f"{db}.rules"), targets, as_of=AS_OF, batch_id="b1")
    assert taken.read_text() == "another" and (landing / "pairs_1.csv").exists()
    with pytest.raises(ValueError, match="archive_root"):
        flow.IngestTargets("x", moves="y")


def test_ingest_nothing(spark, db, landing):
    targets = flow.IngestTargets(ledger=f"{db}.ingestion_log")
    none = files.list_files(spark, str(landing)).where("false")
    assert flow.ingest(spark, none, spark.table(f"{db}.rules"), targets, as_of=AS_OF).count() == 0


@pytest.fixture
def orders(spark, db):
    names = entity.EntityTables(f"{db}.orders_raw", f"{db}.orders_raw_hist", f"{db}.stg_orders", f"{db}.fct_orders", f"{db}.checks")
    for table in (names.raw, names.history):
        tables.create_table(spark, table, text_fields(COLUMNS), partition_by="batch_date")
    return names


def load(spark, table, as_of, *items):
    sinks.append_raw(spark.createDataFrame(list(items), ", ".join(f"{c} string" for c in COLUMNS)), table, as_of)


@pytest.mark.parametrize("merge", [True, False])
def test_entity_runs(spark, orders, merge):
    contract = orders_contract()
    load(spark, orders.raw, "2024-01-01 08:00:00",
         ("1", "Ann", "10.5", "PENDING", "2024-01-01", "3"), ("2", "Bo", "x", "SHIPPED", "2024-01-01", "3"))
    entity.run_entity(spark, orders, contract, "2024-01-01 12:00:00", merge=merge)
    load(spark, orders.raw, "2024-01-02 08:00:00", ("1", "Ann", "10.5", "SHIPPED", "2024-01-01", "3"))
    entity.run_entity(spark, orders, contract, "2024-01-02 12:00:00", merge=merge)
    entity.run_entity(spark, orders, contract, "2024-01-02 13:00:00", merge=merge)
    expected = [(1, "SHIPPED"), (2, "SHIPPED")] if merge else [(1, "PENDING"), (1, "SHIPPED"), (2, "SHIPPED")]
    assert rows(spark.table(orders.mart).select("order_id", "status")) == expected
    assert spark.table(orders.raw).count() == 0
    assert rows(spark.table(orders.history).groupBy("batch_date").count()) == [(date(2024, 1, 1), 2), (date(2024, 1, 2), 1)]
    first = spark.table(orders.checks).where(
        (F.col("checked_at") == "2024-01-01 12:00:00") & (F.col("table_name") == orders.mart) & (F.col("failing_rows") > 0)
    )
    assert rows(first.select("rule_type", "rule_name")) == [("nonNull", "amount"), ("sla", "completeness")]
    doubled = spark.table(orders.checks).where(
        (F.col("checked_at") == "2024-01-02 12:00:00") & (F.col("table_name") == orders.mart) & (F.col("rule_type") == "uniqueKey")
    )
    assert doubled.first()["failing_rows"] == (0 if merge else 1)


@pytest.mark.parametrize("calls", range(7))
def test_an_entity_run_is_finished_by_the_next(spark, orders, monkeypatch, calls):
    """Rows of one stamp land between all steps, some without a key; the run stops after any of its steps."""
    contract, stamp = orders_contract(), "2024-01-01 08:00:00"
    order = lambda i, status="SHIPPED": (i, "Ann", "10.5", status, "2024-01-01", "3")
    load(spark, orders.raw, stamp, order("1", "PENDING"), order("2"), order("x"))
    steps = ["begin", "refresh_staging", "take_staging", "run_checks", "archive"]
    done = []

    def stepwise(name, function):
        def run(*args, **kwargs):
            if len(done) == calls:
                raise RuntimeError("lost")
            out = function(*args, **kwargs)
            done.append(name)
            load(spark, orders.raw, stamp, order(str(10 + len(done))))
            return out

        return run

    with monkeypatch.context() as patch:
        for name in steps:
            patch.setattr(entity, name, stepwise(name, getattr(entity, name)))
        patch.setattr(sinks, "drop_snapshot", stepwise("drop_snapshot", sinks.drop_snapshot))
        try:
            entity.run_entity(spark, orders, contract, "2024-01-01 12:00:00")
        except RuntimeError:
            pass
    load(spark, orders.raw, "2024-01-01 07:00:00", order("1", "CANCELLED"))  # late, and older than what the mart has
    for hour in (13, 14):
        entity.run_entity(spark, orders, contract, f"2024-01-01 {hour}:00:00")
    landed = ["1", "1", "2", "x", *(str(10 + i) for i in range(1, len(done) + 1))]
    assert sorted(r[0] for r in spark.table(orders.history).select("order_id").collect()) == sorted(landed)
    mart = rows(spark.table(orders.mart).select("order_id", "status"))
    assert sorted(mart, key=repr) == sorted([(1, "PENDING"), (2, "SHIPPED"), (None, "SHIPPED"), *((10 + i, "SHIPPED") for i in range(1, len(done) + 1))], key=repr)
    assert spark.table(orders.raw).count() == 0
    assert not [t.name for t in spark.catalog.listTables(orders.raw.split(".")[0]) if "__" in t.name]


def test_drift_stream_restarts(spark, tmp_path):
    def send(name, *messages):
        from base64 import b64encode

        (tmp_path / "in").mkdir(exist_ok=True)
        lines = [
            {"message": {"data": b64encode(json.dumps(m).encode()).decode(), "publishTime": at}} for m, at in messages
        ]
        lines.append({"message": {"publishTime": "2024-01-01T00:00:00Z"}})
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(x) for x in lines))

    def run():
        stream = events.drift_requests(events.drift_messages(spark, str(tmp_path / "in"))).select("trace_id", "is_deletion")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return rows(spark.read.schema("trace_id string, is_deletion boolean").parquet(str(tmp_path / "out")))

    drop = {"trace_id": "a", "error_message": "Dropped"}
    send("1.json", (drop, "2024-01-01T00:00:00Z"), ({"trace_id": "void"}, "2024-01-01T00:00:00Z"), (drop, "2024-01-01T00:00:10Z"))
    assert run() == [("a", True)]
    send("2.json", (drop, "2024-01-01T00:00:20Z"), ({"trace_id": "b", "added_columns": ["x"]}, "2024-01-01T00:00:30Z"))
    assert run() == [("a", True), ("b", False)]


def test_a_batch_that_comes_again_leaves_nothing_to_merge(spark, db, monkeypatch):
    from pactloom.operators.staging import with_audit_columns

    contract, table = orders_contract(), f"{db}.fct"
    row = "CAST({} AS BIGINT) AS order_id, '{}' AS customer_name, 1.5BD AS amount, 'PENDING' AS status, DATE '2024-01-01' AS order_date, 1L AS warehouse_id, CAST({} AS TIMESTAMP) AS processed_dttm"

    def batch(*cells):
        return with_audit_columns(spark.sql(" UNION ALL ".join("SELECT " + row.format(*c) for c in cells)), "2024-01-07 12:00:00")

    old, new = "'2024-01-01 00:00:00'", "'2024-01-02 00:00:00'"
    first = batch((1, "a", new), (2, "b", "NULL"), (3, "c", old), (4, "d", old), ("NULL", "x", old))
    entity.take_rows(first, table, contract)
    merged, real = [], sinks._merge_stored
    monkeypatch.setattr(sinks, "_merge_stored", lambda spark, pending, *rest: (merged.append(spark.table(pending).count()), real(spark, pending, *rest)))
    entity.take_rows(first, table, contract)
    entity.take_rows(batch((1, "late", old), (1, "undated", "NULL")), table, contract)
    assert merged == [] and spark.table(table).count() == 5
    entity.take_rows(batch((2, "now", old), (3, "same time", old), (4, "d", old), (5, "new", "NULL")), table, contract)
    assert merged == [3]
    assert rows(spark.table(table).select("order_id", "customer_name")) == sorted([(1, "a"), (2, "now"), (3, "same time"), (4, "d"), (5, "new"), (None, "x")], key=repr)
    # A key that an appended table holds twice becomes one row, as before.
    entity.take_rows(batch((4, "d2", old)), table, contract, merge=False)
    entity.take_rows(batch((4, "d", old)), table, contract)
    assert rows(spark.table(table).where("order_id = 4").select("customer_name")) == [("d",)]
    assert not spark.catalog.tableExists(f"{table}__batch")
