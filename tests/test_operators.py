from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.contract import orders_contract, contract_rules
from pactloom.operators import drift, gate, mart, profile, quality, routing, staging

RAW = "order_id string, customer_name string, amount string, status string, order_date string, warehouse_id string, batch_date date, processed_dttm timestamp"


def raw(spark, *versions):
    far = date(9999, 12, 31)
    return spark.createDataFrame(
        [(k, "n", "1", "PENDING", "2024-01-01", "1", far, at) for k, at in versions], RAW
    )


def at(hour):
    return datetime(2024, 1, 1, hour)


def test_stage_keeps_newest_and_null_times_last(spark):
    df = raw(spark, ("1", at(1)), ("1", at(3)), ("1", None), ("2", None))
    staged = staging.stage(df, orders_contract(), "2024-01-02 00:00:00")
    assert rows(staged.select("order_id", "processed_dttm")) == [(1, at(3)), (2, None)]
    assert {r[0] for r in staged.select("batch_date").collect()} == {date(2024, 1, 2)}


def test_stage_by_raw_or_typed_key(spark):
    df = raw(spark, ("7", at(1)), ("007", at(2)), ("x", at(1)), ("y", at(2)))
    assert staging.stage(df, orders_contract()).count() == 4
    assert rows(staging.stage(df, orders_contract(), typed_key=True).select("order_id", "processed_dttm")) == [
        (7, at(2)),
        (None, at(2)),
    ]


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = staging.latest_per_key(raw(spark, ("1", at(1))), ["order_id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan.split("== Physical Plan ==")[1]
    assert plan.split("== Physical Plan ==")[1].count("Partial") >= 1


def test_one_hot_key(spark):
    """A third of all rows under one key, another third without a key."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    newest = staging.latest_per_key(df, ["k"], ["t"])
    assert newest.count() == 10002
    assert newest.where("k = 'hot'").first()["t"] == 29997
    assert newest.where("k IS NULL").first()["t"] == 29999


def test_quality_counts_add_up(spark):
    df = spark.createDataFrame([("a", ""), ("b", "x"), (None, "y"), (" ", "z")], "x string, y string")
    assert tuple(quality.quality_counts(df, ["x", "y"]).first()) == (4, 2, 2)
    assert tuple(quality.quality_counts(df.where("false"), ["x"]).first()) == (0, 0, 0)


def test_conditions_pass_on_null(spark):
    contract = orders_contract()
    df = staging.cast_project(raw(spark, ("1", at(1))).withColumn("amount", F.lit("N/A")), contract)
    assert quality.failing_conditions(df, contract_rules(contract)).count() == 0


def test_freshness(spark):
    df = spark.createDataFrame([(at(1),)], "processed_dttm timestamp")
    assert quality.freshness_breach(df, 24, "2024-01-02 01:00:00").count() == 0
    breach = quality.freshness_breach(df, 24, "2024-01-02 01:00:01").first()
    assert breach["failure_reason"] == "Freshness Breach: Max processed_dttm is older than 24 hours"
    assert quality.freshness_breach(df, 0.5, "2024-01-01 01:31:00").first()["failure_reason"].endswith("0.5 hours")
    empty = df.where("false")
    assert quality.freshness_breach(empty, 24, "2024-01-02 01:00:00").count() == 0
    assert quality.freshness_breach(empty, 24, "2024-01-02 01:00:00", fail_on_empty=True).count() == 1


def test_completeness(spark):
    df = spark.range(100).withColumn("ok", F.col("id") >= 2)
    assert quality.completeness_breach(df, F.col("ok"), 98.0).count() == 0
    assert quality.completeness_breach(df, F.col("ok"), 98.5).first()["good_percent"] == 98.0
    assert quality.completeness_breach(df.where("false"), F.col("ok")).count() == 0


def test_quarantine_is_a_partition(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    good, bad = quality.quarantine_split(df, ["x"])
    assert (good.count(), bad.count()) == (1, 2)
    assert quality.tag_bad(df, ["x"]).where("is_bad").count() == 2


def test_incremental_filter_edges(spark):
    source = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, at(3)), (4, None)], "k int, processed_dttm timestamp")
    target = source.where("k = 2")
    assert rows(mart.incremental_filter(source, target).select("k")) == [(3,)]
    assert mart.incremental_filter(source, target.where("false")).count() == 3
    assert mart.incremental_filter(source, None).count() == 4
    behind = mart.incremental_filter(source, target, lookback=timedelta(hours=2))
    assert rows(behind.select("k")) == [(1,), (2,), (3,)]


def test_upsert_with_null_keys(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    source = spark.createDataFrame([(2, "new"), (None, "new"), (3, "new")], "k int, v string")
    assert rows(mart.upsert_by_key(target, source, ["k"])) == sorted(
        [(1, "old"), (2, "new"), (3, "new"), (None, "old"), (None, "new")], key=repr
    )


def test_not_yet_archived_is_null_safe(spark):
    raw_rows = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, v string")
    history = spark.createDataFrame([("a", None)] * 5, "k string, v string")
    assert rows(mart.not_yet_archived(raw_rows, history, ["k", "v"])) == [("b", "x")]


FILES = [("in/click_1.csv",), ("in/click_x.json",), ("in/view_2.csv",), ("other.csv",), ("in/signup_1.csv",), ("it's.csv",)]


def registry(spark):
    return spark.sql(r"""SELECT * FROM VALUES
      ('click_[0-9]+[.]csv$', 'raw', 'clicks', 'web', true, TIMESTAMP '2024-01-02 00:00:00'),
      ('click_', 'raw', 'clicks_any', 'web', true, TIMESTAMP '2024-01-01 00:00:00'),
      ('^in/view_\\d', 'raw', 'views', 'web', true, NULL),
      ('view', 'raw', 'views_any', 'web', true, NULL),
      ('it\'s', 'raw', 'quoted', 'web', true, NULL),
      ('signup_', 'raw', 'signups', 'crm', false, NULL)
      AS t(file_pattern, target_dataset, target_table, domain, is_active, created_at)""")


def test_routing_precedence(spark):
    files = spark.createDataFrame(FILES, "file_name string")
    routed = routing.route_files(files, registry(spark)).select("file_name", "target_table")
    assert rows(routed) == sorted(
        [
            ("in/click_1.csv", "clicks_any"),
            ("in/click_x.json", "clicks_any"),
            ("in/view_2.csv", "views"),
            ("other.csv", None),
            ("in/signup_1.csv", None),
            ("it's.csv", "quoted"),
        ],
        key=repr,
    )


def test_routing_by_blocks_agrees(spark, monkeypatch):
    files = spark.createDataFrame(FILES, "file_name string")
    direct = rows(routing.route_files(files, registry(spark)))
    monkeypatch.setattr(routing, "RULES_PER_CASE", 1)
    assert rows(routing.route_files(files, registry(spark))) == direct


def test_routing_by_typed_order_and_unsound_patterns(spark):
    files = spark.createDataFrame([("a.csv",)], "file_name string")
    rule = "file_pattern string, target_table string, skip_header_rows int, is_active boolean"
    ties = spark.createDataFrame([("a", "t", 10, True), ("a", "t", 2, True), (None, "n", 1, True), ("(", "b", 1, True)], rule)
    with pytest.warns(UserWarning, match="is no pattern"):
        found = routing.route_files(files, ties).first()
    assert (found["target_table"], found["skip_header_rows"]) == ("t", 2)


def test_routing_without_rules(spark):
    files = spark.createDataFrame(FILES, "file_name string")
    assert routing.route_files(files, registry(spark).where("false")).where("target_table IS NULL").count() == len(FILES)


def test_schema_diff_is_case_sensitive_and_order_free(spark):
    files = spark.createDataFrame([("raw.t", ["b", "A", "c"]), ("raw.none", ["x"])], "table_ref string, headers array<string>")
    tables = spark.createDataFrame([("raw.t", ["a", "b", "batch_date", "processed_dttm"])], "table_ref string, columns array<string>")
    got = {r["table_ref"]: (r["new_columns"], r["deleted_columns"]) for r in drift.schema_diff(files, tables).collect()}
    assert got == {"raw.t": (["A", "c"], ["a"]), "raw.none": (None, None)}


def test_evolve_then_diff_is_empty(spark):
    columns = ["a", "b", "batch_date", "processed_dttm"]
    evolved = drift.evolved_columns(columns, ["c", "a", "c"], ["b"])
    assert evolved == ["a", "c", "batch_date", "processed_dttm"]
    got = spark.createDataFrame([(["a", "c"], evolved)], "h array<string>, t array<string>").select(
        drift.unknown_columns(F.col("h"), F.col("t")), drift.missing_columns(F.col("h"), F.col("t"))
    )
    assert tuple(got.first()) == ([], [])


def test_evolve_schema_fields():
    fields = [{"name": "a", "type": "STRING", "description": "kept"}, {"name": "b", "type": "STRING"}, {"name": "batch_date", "type": "DATE"}]
    evolved = drift.evolve_schema_fields(fields, ["c"], ["b"])
    assert [f["name"] for f in evolved] == ["a", "c", "batch_date", "processed_dttm"]
    assert evolved[0] == {"name": "a", "type": "STRING", "description": "kept", "defaultValueExpression": "NULL"}
    assert evolved[1]["mode"] == "NULLABLE"


def test_a_dropped_column_that_comes_back_is_new(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    evolved = drift.evolve_schema(df, ["b"], ["b"])
    assert evolved.columns == ["a", "b", "batch_date", "processed_dttm"]
    assert evolved.first()["b"] is None


def test_profile_contract(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("ref"),
        F.col("id").cast("string").alias("n"),
        F.when(F.col("id") % 3 == 0, "red").otherwise("blue").alias("colour"),
        F.when(F.col("id") == 5, "nan").otherwise("1.50").alias("price"),
        F.lit(None).cast("string").alias("nothing"),
        F.lit("true").alias("flag"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).cast("string").alias("day"),
    )
    contract = profile.profile_contract(df, "things")
    by_name = {c.name: c for c in contract.columns}
    assert {n: c.type for n, c in by_name.items()} == {
        "ref": "STRING", "n": "INT64", "colour": "STRING", "price": "NUMERIC", "nothing": "STRING", "flag": "BOOL", "day": "DATE",
    }
    assert contract.key == ["ref"]
    assert by_name["ref"].tests[0].pattern == "^ORD-[0-9]{5,5}$"
    assert by_name["colour"].tests[0].values == ("blue", "red")
    assert by_name["n"].unique and by_name["n"].not_null
    assert not by_name["price"].not_null
    assert contract.partition_by == "day"
    assert profile.relax(contract).columns[0].tests == ()
    typed = staging.cast_project(df.withColumn("processed_dttm", F.current_timestamp()), contract)
    report = quality.assertion_report(typed, contract_rules(contract))
    assert report.agg(F.sum("failing_rows")).first()[0] == 0


def test_profile_counts_every_candidate_exactly(spark):
    unique = [F.xxhash64("id", F.lit(i)).cast("string").alias(f"u{i}") for i in range(12)]
    numbered = F.concat(F.lit("K-"), (F.col("id") % 300).cast("string")).alias("numbered")
    colour = F.concat(F.lit("c"), F.chr(F.col("id") % 3 + 97)).alias("colour")
    df = spark.range(1000).select(numbered, colour, *unique)
    contract = profile.profile_contract(df, "things", max_listed=2)
    by_name = {c.name: c for c in contract.columns}
    assert by_name["numbered"].tests[0].pattern == "^K-[0-9]{1,3}$" and not by_name["numbered"].unique
    assert by_name["colour"].tests == ()
    assert all(by_name[f"u{i}"].unique for i in range(12)) and contract.key == ["u0"]


def test_profile_of_empty_table(spark):
    contract = profile.profile_contract(spark.createDataFrame([], "a string, b string"), "none")
    assert [(c.type, c.not_null, c.primary_key) for c in contract.columns] == [("STRING", False, False)] * 2


def test_dry_run(spark):
    spark.range(10).withColumn("x", F.lit("a")).createOrReplaceTempView("t_numbers")
    good = gate.dry_run(spark, "SELECT id, count(*) AS n FROM t_numbers GROUP BY id")
    assert good.valid and [c["name"] for c in good.schema] == ["id", "n"]
    wrong = gate.dry_run(spark, "SELECT nothing FROM t_numbers")
    assert not wrong.valid and "nothing" in wrong.message
    assert not gate.dry_run(spark, "SELEC 1").valid


def test_cost_estimate(spark, tmp_path):
    spark.range(100000).write.parquet(str(tmp_path / "n"))
    spark.read.parquet(str(tmp_path / "n")).createOrReplaceTempView("t_stored")
    size = sum(f.stat().st_size for f in (tmp_path / "n").glob("*.parquet"))
    assert gate.estimated_bytes(spark, "SELECT count(*) FROM t_stored") == pytest.approx(size, rel=0.05)
    assert gate.scan_price(2**40) == 6.25


def test_size_gate(spark):
    spark.range(2001).createOrReplaceTempView("t_many")
    assert gate.size_gate(spark, "SELECT * FROM t_many").needs_confirmation
    assert not gate.size_gate(spark, "SELECT * FROM t_many WHERE id > 0").needs_confirmation
    spark.range(5000).createOrReplaceTempView("t_many")
    assert gate.size_gate(spark, "SELECT * FROM t_many").row_count == 5000
    assert gate.preview(spark, "SELECT * FROM t_many").count() == 2000


def test_last_turns_of_a_long_conversation(spark):
    df = spark.range(20000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    assert gate.last_turns(df).first()["context"] == "\n".join(f"USER: {i}" for i in range(19995, 20000))


def test_type_changes(spark):
    df = spark.sql("SELECT map('a', 'int', 'b', 'string', 'c', 'date') AS f, map('a', 'string', 'b', 'string') AS t")
    assert df.select(drift.type_changes(F.col("f"), F.col("t"))).first()[0] == {"a": "int"}


def test_upsert_with_a_third_of_rows_without_key(spark):
    n = 30000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))).alias("k"), F.col("id").alias("v")
    )
    source = spark.createDataFrame([(7, -1), (8, -2), (None, -3)], "k bigint, v bigint")
    merged = mart.upsert_by_key(target, source, ["k"])
    by_key = {r["k"]: r["n"] for r in merged.groupBy("k").agg(F.count("*").alias("n")).where("k IS NULL OR k < 10").collect()}
    assert by_key == {None: n // 3 + 1, 7: 1, 8: 1, 2: 1, 5: 1}
    assert merged.count() == n // 3 + (n // 3 - 1) + 3


def test_schema_diff_rows_of_one_wide_file(spark):
    """One file brings a third of all names."""
    names = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("file"),
        F.lit("raw.t").alias("table_ref"),
        F.concat(F.lit("c"), F.col("id")).alias("column_name"),
    )
    table = spark.createDataFrame([("raw.t", "c0"), ("raw.t", "c1"), ("raw.t", "batch_date")], "table_ref string, column_name string")
    changes = drift.schema_diff_rows(names, table, ["file"])
    assert changes.where("file = 0 AND change = 'unknown'").count() == 999
    assert rows(changes.where("file = 0 AND change = 'missing'").select("column_name")) == [("c1",)]
    assert changes.where("change = 'missing'").count() == 1 + 1 + 2 * 1999


@pytest.mark.parametrize("name", ["schema_diff", "schema_diff_rows", "upsert_by_key", "drift_outcome", "incremental_filter", "last_n_turns"])
def test_no_pairwise_joins_without_broadcasts(spark, name):
    from pactloom.parity import CASES

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        plan = CASES[name].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def scanned_rows(plan):
    """Rows that file scans of an executed plan put out."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return scanned_rows(plan.executedPlan())
    if plan.nodeName().startswith("Scan parquet"):
        return plan.metrics().apply("numOutputRows").value()
    if "QueryStage" in plan.nodeName():
        return scanned_rows(plan.plan())
    children = plan.children()
    return sum(scanned_rows(children.apply(i)) for i in range(children.size()))


def test_incremental_mark_skips_row_groups(spark, tmp_path):
    spark.range(0, 1000000, 1, 4).selectExpr("id", "timestamp_seconds(id) AS processed_dttm").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    newer = mart.incremental_filter(stored, stored.where("id < 900000")).groupBy().count()
    assert newer.first()[0] == 100000
    assert scanned_rows(newer._jdf.queryExecution().executedPlan()) < 300000


def test_no_key_loses_no_row(spark):
    from pactloom.contract import default_contract
    from pactloom.operators.staging import stage

    raw = spark.range(100).selectExpr("CAST(id AS STRING) AS a", "'2024-01-01 00:00:00' AS processed_dttm")
    assert stage(raw, default_contract("x", ["a"])).count() == 100
    target, batch = spark.range(10).toDF("a"), spark.range(2).toDF("a")
    assert mart.upsert_by_key(target, batch, []).count() == 12


def test_upsert_takes_the_newest_of_a_batch(spark):
    schema = "k int, v string, processed_dttm string"
    target = spark.createDataFrame([(1, "old", "1"), (2, "kept", "1")], schema)
    batch = spark.createDataFrame([(1, "b", "2"), (1, "c", "3"), (None, "x", "2"), (None, "y", "2")], schema)
    got = rows(mart.upsert_by_key(target, batch, ["k"]).select("k", "v"))
    assert got == sorted([(1, "c"), (2, "kept"), (None, "x"), (None, "y")], key=repr)


def test_each_unique_column_is_a_key(spark):
    from pactloom.contract import contract_rules, parse_contract
    from pactloom.operators.quality import assertion_report

    column = "{column: %s, type: STRING, constraints: {unique: true}}"
    contract = parse_contract("name: x\nschema: [%s, %s]" % (column % "a", column % "b"))
    df = spark.createDataFrame([("1", "x", None), ("1", "y", None)], "a string, b string, processed_dttm timestamp")
    report = rows(assertion_report(df, contract_rules(contract)))
    assert report == [("uniqueKey", "a", 1), ("uniqueKey", "b", 0)]
    empty = parse_contract("name: x\nschema: [{column: a, type: STRING}]")
    assert assertion_report(df, contract_rules(empty)).count() == 0


def test_norm_blank_trims_all_white_space(spark):
    from pactloom.functions.text import norm_blank

    df = spark.createDataFrame([("\tnan\n",), ("\t",), ("\u00a0 x\n",), (None,)], "a string")
    assert [r[0] for r in df.select(norm_blank(df.a)).collect()] == [None, None, "x", None]


def test_routing_by_needed_texts(spark, monkeypatch):
    """Patterns whose needed text is hard to tell: a join by texts finds what trying all patterns finds."""
    patterns = [
        "^in/ab", "^in/ab*", "^in/ab?c", "^in/a+", "^in/x{0}y", "^zzzz|ab_1", "^in/(zz|ab)_", r"^in/\(zz|ab_1", r"^in/[(]z|ab_1", "(?i)^IN/AB",
        r"^in/\Qab\E", r"^in/ab\.c", "^in/ab[.]c", ".*ab_1", "^.*_1[.]", ".*?ab_12", "ab_12345678|q", "ab_12345678.*csv$", "ab_1234567(8|9)",
        "größe_", "b_1$", "^", "", "csv$|json$", "in/ab_1234567890123456789012345678901234567890", "(^in/ab_1)", "[.]c", "^in/ab'",
    ]
    names = ["in/ab", "in/a", "in/ac", "in/y", "in/ab_1", "in/ab.csv", "IN/AB", "in/(zz", "in/größe_1.csv", "ab_1", "in/ab_12345678.csv", "x/ab_12345679.csv", "", None]
    names += ["in/ab_1234567890123456789012345678901234567890.csv", "in/ab\nab_1234", "in/ab'", "q", "other.json", "in/ab_1"]
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    registry = spark.createDataFrame([(p, f"t{i}", f"{2000 + i}", True) for i, p in enumerate(patterns)], "file_pattern string, target_table string, created_at string, is_active boolean")
    monkeypatch.setattr(routing, "RULES_PER_CASE", 12)
    names = files.select(F.col("file_name").alias("_name"))
    every = names.crossJoin(registry).where("_name RLIKE file_pattern").select("_name", "file_pattern", "created_at")
    first = every.groupBy("_name").agg(F.min_by("file_pattern", "created_at"))
    got = routing.route_files(files, registry).where("file_pattern IS NOT NULL").select("file_name", "file_pattern")
    assert rows(got.distinct()) == rows(first)
    monkeypatch.setattr(routing, "RULES_PER_CASE", 1)
    found = routing._candidates(names, routing.sound_rules(registry)[0])
    assert rows(found.select("_name", "file_pattern")) == rows(every.select("_name", "file_pattern"))


def test_routing_by_many_rules_stays_a_table(spark):
    """Rules beyond one CASE expression never come to the driver, and the plan doesn't grow with them."""
    rule = ["concat('^in/customer_', id, '_') AS file_pattern", "concat('t', id) AS target_table", "id % 3 > 0 AS is_active"]
    files = spark.range(3000).selectExpr("concat('in/customer_', id, '_7.csv') AS file_name")
    plans = []
    for n in (2000, 20000):
        routed = routing.route_files(files, spark.range(n).selectExpr(*rule))
        plans.append(len(routed._jdf.queryExecution().analyzed().toString()))
        assert routed.where("target_table IS NOT NULL").count() == sum(1 for i in range(min(n, 3000)) if i % 3)
        assert routed.where("target_table != replace(replace(file_name, 'in/customer_', 't'), '_7.csv', '')").count() == 0
    assert plans[1] < 2 * plans[0]
