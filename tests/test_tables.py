from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.operators.drift import AUDIT_FIELDS
from pactloom.sinks import ledger, sketch, tables as sinks
from pactloom.sources import tables

FIELDS = [{"name": c, "type": "STRING", "description": f"It's {c}", "defaultValueExpression": "NULL"} for c in ("k", "v")]
FIELDS += list(AUDIT_FIELDS)
AS_OF = "2024-01-07 12:00:00"


@pytest.fixture
def raw(spark, db):
    tables.create_table(spark, f"{db}.things_raw", FIELDS, partition_by="batch_date")
    tables.create_table(spark, f"{db}.things_raw_hist", FIELDS, partition_by="batch_date")
    return f"{db}.things_raw"


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v string")


def test_create_table_defaults(spark, raw):
    spark.sql(f"INSERT INTO {raw} (k) VALUES ('a')")
    row = spark.table(raw).first()
    assert (row["k"], row["v"], row["batch_date"]) == ("a", None, date(9999, 12, 31))
    assert row["processed_dttm"] is not None
    assert tables.struct_from_fields([{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}])["a"].nullable is False


def test_append_and_replace(spark, raw):
    sinks.append_raw(batch(spark, ("a", "1")), raw, AS_OF)
    sinks.append_raw(spark.createDataFrame([(5,)], "k int"), raw, AS_OF)
    assert rows(spark.table(raw).select("k", "v")) == [("5", None), ("a", "1")]
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "DYNAMIC")
    try:
        sinks.replace_raw(batch(spark), raw, AS_OF)
        assert spark.table(raw).count() == 0
        sinks.replace_raw(batch(spark, ("b", "2")), raw, AS_OF)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "DYNAMIC"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark.table(raw).select("k", "v", "processed_dttm")) == [("b", "2", datetime(2024, 1, 7, 12))]


def test_staged_load_always_drops(spark, db, raw):
    def fail(staged):
        assert spark.catalog.listTables(db, "staging_*")
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        sinks.staged_load(batch(spark, ("a", "1")), raw, fail)
    assert not spark.catalog.listTables(db, "staging_*")


def mart_rows(spark, *items):
    schema = "k int, v string, batch_date date, processed_dttm timestamp"
    return spark.createDataFrame([(k, v, date(2024, 1, d), datetime(2024, 1, d, h)) for k, v, d, h in items], schema)


@pytest.mark.parametrize("partition_by", ["batch_date", None])
def test_merge(spark, db, partition_by):
    table = f"{db}.fct"
    first = mart_rows(spark, (1, "a", 1, 1), (2, "a", 2, 1), (3, "a", 3, 1))
    sinks.incremental_merge(first, table, ["k"], partition_by=partition_by)
    second = mart_rows(spark, (1, "b", 4, 1), (4, "b", 4, 1), (2, "late", 4, 0), (3, "a", 3, 1)).where("k <> 2")
    sinks.incremental_merge(second, table, ["k"], partition_by=partition_by)
    expected = [(1, "b"), (2, "a"), (3, "a"), (4, "b")]
    assert rows(spark.table(table).select("k", "v")) == expected
    sinks.incremental_merge(second, table, ["k"], partition_by=partition_by)
    assert rows(spark.table(table).select("k", "v")) == expected
    leftovers = [t.name for t in spark.catalog.listTables(db) if "__" in t.name]
    assert leftovers == []
    if partition_by:
        kept = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        assert kept == {"batch_date=2024-01-02", "batch_date=2024-01-03", "batch_date=2024-01-04"}


class Lost(RuntimeError):
    pass


def broken(function, before):
    """The function, failing before it starts or right after it is done."""

    def run(*args, **kwargs):
        if not before:
            function(*args, **kwargs)
        raise Lost

    return run


@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("step", ["_merge_stored", "_overwrite_partitions", "drop_tables"])
def test_merge_finishes_an_interrupted_run(spark, db, monkeypatch, step, before):
    table = f"{db}.fct"
    sinks.append_table(mart_rows(spark, (1, "a", 1, 1), (2, "a", 2, 1), (3, "a", 2, 1)), table)
    with monkeypatch.context() as patch:
        patch.setattr(sinks, step, broken(getattr(sinks, step), before))
        with pytest.raises(Lost):
            sinks.incremental_merge(mart_rows(spark, (1, "b", 4, 1), (3, "b", 4, 1)), table, ["k"])
    sinks.incremental_merge(mart_rows(spark, (4, "c", 5, 1)), table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(1, "b"), (2, "a"), (3, "b"), (4, "c")]
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["fct"]


def stopped_after(function, calls):
    """The function, failing once it was called so often."""
    done = []

    def run(*args, **kwargs):
        if len(done) == calls:
            raise Lost
        done.append(1)
        return function(*args, **kwargs)

    return run


@pytest.mark.parametrize("partition_by", ["batch_date", None])
@pytest.mark.parametrize("calls", range(9))
def test_rows_without_a_key_are_merged_once(spark, db, monkeypatch, partition_by, calls):
    table = f"{db}.fct"
    sinks.append_table(mart_rows(spark, (1, "a", 1, 1), (None, "old", 1, 1)), table, partition_by=partition_by)
    pieces = (mart_rows(spark, (1, "b", 4, 1), (None, "new", 4, 1)), mart_rows(spark, (2, "c", 5, 1)))
    with monkeypatch.context() as patch:
        # Each statement on tables is a step; stops fall between any two of them.
        original = type(spark).sql
        counter = stopped_after(original, calls)
        patch.setattr(type(spark), "sql", lambda self, query, *a, **k: counter(self, query, *a, **k) if "DROP TABLE" in query or "RENAME" in query else original(self, query, *a, **k))
        try:
            sinks.merge_rows(pieces[0], table, ["k"], partition_by=partition_by)
        except Lost:
            pass
    sinks.resume_merge(spark, table, ["k"], partition_by=partition_by)
    if not spark.table(table).where("v = 'b'").count():  # it stopped before the batch was stored
        sinks.merge_rows(pieces[0], table, ["k"], partition_by=partition_by)
    sinks.merge_rows(pieces[1], table, ["k"], partition_by=partition_by)
    assert rows(spark.table(table).select("k", "v")) == [(1, "b"), (2, "c"), (None, "new"), (None, "old")]
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["fct"]


def test_merge_recovers_a_half_replaced_partition(spark, db, monkeypatch):
    """The old partition is gone and the new one has not arrived when the run stops."""
    table = f"{db}.fct"
    sinks.append_table(mart_rows(spark, (1, "a", 1, 1), (2, "a", 1, 1)), table)

    def lose(df, name):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (batch_date = '2024-01-01')")
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_overwrite_partitions", lose)
        with pytest.raises(Lost):
            sinks.incremental_merge(mart_rows(spark, (1, "b", 4, 1)), table, ["k"])
    sinks.resume_merge(spark, table, ["k"])
    assert rows(spark.table(table).select("k", "v")) == [(1, "b"), (2, "a")]


@pytest.mark.parametrize("renames", [0, 1])
def test_swap_recovers(spark, db, renames):
    table = f"{db}.fct"
    first, second = mart_rows(spark, (1, "a", 1, 1), (2, "a", 1, 1)), mart_rows(spark, (1, "b", 4, 1))
    sinks.append_table(first, table, partition_by=None)
    second.write.saveAsTable(f"{table}__batch")
    spark.table(table).write.saveAsTable(f"{table}__next")
    if renames:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    sinks.incremental_merge(second, table, ["k"], partition_by=None)
    assert rows(spark.table(table).select("k", "v")) == [(1, "b"), (2, "a")]


def test_merge_touches_only_partitions_with_matches(spark, db):
    table = f"{db}.fct"
    sinks.append_table(mart_rows(spark, (1, "a", 1, 1), (2, "a", 2, 1)), table)
    untouched = set(spark.table(table).where("batch_date = '2024-01-02'").inputFiles())
    sinks.incremental_merge(mart_rows(spark, (1, "b", 4, 1)), table, ["k"])
    assert untouched <= set(spark.table(table).inputFiles())


def test_incremental_append_repeats_keys(spark, db):
    table = f"{db}.fct"
    sinks.incremental_append(mart_rows(spark, (1, "a", 1, 1)), table)
    sinks.incremental_append(mart_rows(spark, (1, "b", 4, 1), (2, "b", 1, 1)), table)
    assert rows(spark.table(table).select("k", "v")) == [(1, "a"), (1, "b")]


def test_archive_is_bounded_and_idempotent(spark, raw):
    history = raw + "_hist"
    sinks.append_raw(batch(spark, ("a", "1"), ("a", "1"), ("b", None)), raw, AS_OF)
    sinks.append_raw(batch(spark, ("late", "9")), raw, "2024-01-07 13:00:00")
    keep = spark.table(raw).where("k <> 'late'").collect()
    sinks.archive_history(spark, raw, history, "2024-01-07", business_columns=["k", "v"], up_to=AS_OF)
    assert rows(spark.table(raw).select("k")) == [("late",)]
    assert spark.table(history).count() == 3
    spark.createDataFrame(keep, spark.table(raw).schema).write.insertInto(raw)
    sinks.archive_history(spark, raw, history, "2024-01-08", business_columns=["k", "v"], up_to=AS_OF)
    assert spark.table(history).count() == 3
    assert rows(spark.table(history).select("batch_date").distinct()) == [(date(2024, 1, 7),)]
    sinks.archive_history(spark, raw, history, "2024-01-08")
    assert (spark.table(raw).count(), spark.table(history).count()) == (0, 4)


@pytest.mark.parametrize("emptied", [True, False])
def test_archive_finishes_an_interrupted_run(spark, raw, monkeypatch, emptied):
    history = raw + "_hist"
    sinks.append_raw(batch(spark, ("a", "1")), raw, AS_OF)
    sinks.append_raw(batch(spark, ("late", "9"), ("late", "9")), raw, "2024-01-07 13:00:00")

    def lose(df, table):
        if emptied:
            spark.sql(f"TRUNCATE TABLE {table}")
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_overwrite_all", lose)
        with pytest.raises(Lost):
            sinks.archive_history(spark, raw, history, "2024-01-07", business_columns=["k", "v"], up_to=AS_OF)
    sinks.append_raw(batch(spark, ("new", None)), raw, "2024-01-07 14:00:00")
    sinks.archive_history(spark, raw, history, "2024-01-08", business_columns=["k", "v"], up_to=AS_OF)
    assert rows(spark.table(raw).select("k")) == [("late",), ("late",), ("new",)]
    assert rows(spark.table(history).select("k")) == [("a",)]


def test_retention_drops_whole_partitions(spark, db):
    table = f"{db}.hist"
    sinks.append_table(mart_rows(spark, (1, "a", 1, 1), (2, "a", 2, 1)), table)
    assert sinks.expire_partitions(spark, table, "2024-01-31") == ["2024-01-01"]
    assert rows(spark.table(table).select("k")) == [(2,)]
    assert sinks.expire_partitions(spark, table, "2024-01-31") == []


def test_materialized_layout(spark, db):
    table = f"{db}.stg"
    sinks.materialize_table(mart_rows(spark, (2, "a", 1, 1), (1, "b", 1, 1)), table, cluster_by=["k"])
    sinks.materialize_table(mart_rows(spark, (3, "a", 2, 1)), table, cluster_by=["k"])
    assert rows(spark.table(table).select("k")) == [(3,)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["batch_date=2024-01-02"]


def test_drop_entity(spark, db):
    for name in ("stg_things", "fct_things"):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
    sinks.drop_entity(spark, f"{db}.things_raw", db, db)
    sinks.drop_entity(spark, f"{db}.things_raw", db, db)
    assert not spark.catalog.tableExists(f"{db}.stg_things")


def test_catalog_columns(spark, db):
    spark.range(1).select(*[F.lit(i).alias(f"c{i:02}") for i in range(25)]).write.saveAsTable(f"{db}.wide")
    spark.range(1).write.saveAsTable(f"{db}.narrow")
    found = {r["table_name"]: r["columns"] for r in tables.catalog_columns(spark, db).collect()}
    assert found == {"narrow": ["id"], "wide": [f"c{i:02}" for i in range(20)]}


def test_table_columns_leave_out_missing(spark, raw):
    found = tables.table_columns(spark, [raw, raw + "x"]).collect()
    assert [(r["table_ref"], r["columns"]) for r in found] == [(raw, ["k", "v", "processed_dttm", "batch_date"])]


def test_operations_ledger(spark, db):
    operations = spark.createDataFrame(
        [("g", "t", "r1", "CREATE", "SUCCESS", None, 1), ("g", "t", "r2", "CREATE", "SUCCESS", "own", 2)],
        "resource_group string, resource_type string, resource_id string, action_type string, outcome_status string, reference_link string, n int",
    )
    buffered = ledger.operation_rows(operations, "repairer", F.lit(AS_OF).cast("timestamp"), ["n"])
    ledger.flush_operations(buffered, "link", f"{db}.ops")
    ledger.flush_operations(buffered, None, f"{db}.ops")
    got = spark.table(f"{db}.ops")
    assert rows(got.select("resource_id", "change_payload", "reference_link")) == sorted(
        [("r1", '{"n":1}', "link"), ("r2", '{"n":2}', "own"), ("r1", '{"n":1}', None), ("r2", '{"n":2}', "own")], key=repr
    )
    assert got.schema.simpleString() == spark.createDataFrame([], ledger.OPERATIONS_LEDGER).schema.simpleString()


def archived(spark, history, day, *items):
    schema = "k string, v string, batch_date date, processed_dttm timestamp"
    rows_ = [(k, v, date(9999, 12, 31), None if d is None else datetime(2024, 1, d)) for k, v, d in items]
    sinks.add_to_history(spark.createDataFrame(rows_, schema), history, day, ["k", "v"])
    return rows(spark.table(history).select("k", "v", F.dayofmonth("processed_dttm"), F.dayofmonth("batch_date")))


@pytest.mark.parametrize("bits", [22, 6])
def test_history_is_read_where_its_sketch_says_so(spark, raw, monkeypatch, bits):
    """With 6 bits every bitmap is full: partitions are read in vain, and the result is the same."""
    monkeypatch.setattr(sketch, "BITS", bits)
    history, read = f"{raw}_hist", []
    touched = sketch.touched_partitions
    monkeypatch.setattr(sketch, "touched_partitions", lambda *a: read.append(touched(*a)) or read[-1])
    many = [(f"k{i}", "x", 1) for i in range(300)]
    first = [("a", "1", 1), ("a", "1", 1), (None, "1", 1), ("b", None, None), *many]
    archived(spark, history, "2024-01-02", *first)
    archived(spark, history, "2024-01-03", ("c", "1", 2), ("a", "2", 2), *[(f"m{i}", "x", 2) for i in range(300)])
    got = archived(spark, history, "2024-01-04", ("a", "1", 1), (None, "1", 1), ("b", None, None), (None, "2", 1), ("new", "1", 3))
    fresh = [r for r in got if r[3] == 4]
    assert sorted(fresh, key=repr) == sorted([(None, "2", 1, 4), ("new", "1", 3, 4)], key=repr)
    # Times alone rule the second day out, and the first for rows of the second.
    assert read == [[], [], ["2024-01-02"]] and len(got) == len(first) + 302 + 2
    assert archived(spark, history, "2024-01-05", ("late", "1", 9)) and read[-1] == []
    in_range = archived(spark, history, "2024-01-06", ("other", "1", 2), ("c", "1", 2))
    assert read[-1] == ["2024-01-03"] and [r for r in in_range if r[3] == 6] == [("other", "1", 2, 6)]
    assert sinks.expire_partitions(spark, history, "2024-02-02") == ["2024-01-02", "2024-01-03"]
    assert "2024-01-02" not in {str(r[0]) for r in spark.table(sketch.table_of(history)).select("batch_date").collect()}


def test_a_history_without_a_sketch_is_read_whole(spark, raw):
    history = f"{raw}_hist"
    old = spark.createDataFrame([("a", "1", datetime(2024, 1, 1), date(2024, 1, 2))], "k string, v string, processed_dttm timestamp, batch_date date")
    old.select(*spark.table(history).columns).write.insertInto(history)
    got = archived(spark, history, "2024-01-03", ("a", "1", 1), ("b", "1", 1))
    assert [(r[0], r[3]) for r in got] == [("a", 2), ("b", 3)]


def test_rows_are_asked_only_where_words_leave_it_open(spark, raw, monkeypatch):
    history, asked = f"{raw}_hist", []
    words = sketch._words
    monkeypatch.setattr(sketch, "_words", lambda *a: asked.append(len(a)) or words(*a))
    old = [("a", "1", 1), ("b", "1", 5), ("c", None, None)]
    archived(spark, history, "2024-01-02", *old)
    assert len(archived(spark, history, "2024-01-03", *old)) == 3  # held for certain
    assert len(archived(spark, history, "2024-01-04", ("a", "1", 7))) == 4  # not held for certain
    assert asked == [3, 3, 3]
    # Two rows of one word, and the word's span holds the time of one: they are asked themselves.
    monkeypatch.setattr(sketch, "BITS", 6)
    archived(spark, history, "2024-01-05", *[(f"k{i}", "x", 10) for i in range(600)])
    assert len(archived(spark, history, "2024-01-06", ("k1", "x", 10), ("k1", "x", 20))) == 605
    assert asked[3:] == [3, 3, 2]


def test_a_sketch_under_its_old_name_is_taken_over(spark, raw):
    history = f"{raw}_hist"
    archived(spark, history, "2024-01-02", ("a", "1", 1))
    spark.sql(f"ALTER TABLE {history}_sketch RENAME TO {history}__sketch")
    assert len(archived(spark, history, "2024-01-02", ("b", "1", 1))) == 2
    assert len(archived(spark, history, "2024-01-02", ("a", "1", 1), ("b", "1", 1))) == 2
    assert not spark.catalog.tableExists(f"{history}__sketch")


def test_merging_looks_for_keys_outside_the_partitions_it_rewrites(spark, db, monkeypatch):
    table, seen = f"{db}.fct_parted", []
    days = lambda *r: spark.createDataFrame(
        [(k, v, datetime(2024, 1, t), date(2024, 1, d)) for k, v, t, d in r], "k long, v string, processed_dttm timestamp, batch_date date"
    )
    sinks.append_table(days((1, "a", 1, 1), (2, "a", 1, 1), (3, "a", 1, 2), (4, "a", 1, 4), (5, "a", 1, 5)), table)
    real = sinks._partitions_with_keys
    monkeypatch.setattr(sinks, "_partitions_with_keys", lambda target, *rest: seen.append({r[0].day for r in target.select("batch_date").collect()}) or real(target, *rest))
    sinks.merge_rows(days((1, "b", 2, 1), (3, "old", 2, 2), (3, "new", 3, 3), (5, "b", 2, 3)), table, ["k"])
    assert seen == [{4, 5}]
    got = rows(spark.table(table).select("k", "v", F.dayofmonth("batch_date")))
    assert got == [(1, "b", 1), (2, "a", 1), (3, "new", 3), (4, "a", 4), (5, "b", 3)]
    # What the batch added to and replaced whole is gone, as is what only lost its rows.
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) == [f"batch_date=2024-01-0{d}" for d in (1, 3, 4)]
