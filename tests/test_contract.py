import pytest

from pactloom.contract import contract_rules, contract_schema, default_contract, orders_contract, parse_contract


def test_orders_contract():
    contract = orders_contract()
    assert contract.key == ["order_id"]
    assert contract.partition_by == "batch_date"
    assert contract.cluster_by == ("order_id", "status")
    assert contract.freshness_hours == 24
    assert contract.completeness_percent == 98.0
    assert contract_schema(contract)["customer_name"].metadata["classification"] == "PII"
    assert not contract_schema(contract)["amount"].nullable


def test_orders_rules(spark):
    rules = contract_rules(orders_contract())
    assert rules.unique_keys == (("order_id",),)
    assert rules.non_null == (
        "order_id", "customer_name", "amount", "order_date", "warehouse_id", "batch_date", "processed_dttm",
    )
    assert [r.name for r in rules.row_conditions] == [
        "amount >= 0 AND amount <= 1000000",
        "status IN ('COMPLETED', 'PENDING', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')",
    ]


def test_compact_layout(spark):
    contract = parse_contract(
        """
version: "1.0"
table: contacts
domain: crm
owner: team
freshness_slo_hours: 6
completeness_threshold: 0.95
columns:
  - {name: contact_id, bq_type: STRING, nullable: false, assertions: [not_null, unique]}
  - {name: age, bq_type: INT64, nullable: true, assertions: ["age < 150"]}
"""
    )
    assert contract.key == ["contact_id"]
    assert contract.freshness_hours == 6
    assert contract.completeness_percent == 95.0
    rules = contract_rules(contract)
    assert rules.non_null == ("contact_id",)
    df = spark.createDataFrame([("a", 200), ("b", 20), ("c", None)], "contact_id string, age bigint")
    assert df.where(~rules.row_conditions[0].condition).count() == 1


def test_regex_test_is_unanchored(spark):
    contract = parse_contract(
        "name: x\nschema:\n  - column: a\n    type: STRING\n    tests:\n      - {type: regex, pattern: 'ORD-[0-9]{2}'}\n"
    )
    rule = contract_rules(contract).row_conditions[0]
    df = spark.createDataFrame([("xxORD-123",), ("ORD-1",)], "a string")
    assert [r[0] for r in df.select(rule.condition).collect()] == [True, False]


def test_bad_contracts():
    with pytest.raises(ValueError):
        parse_contract("name: x\nschema: []\nservice_level_agreement: {freshness: {period: soon}}")
    with pytest.raises(ValueError):
        parse_contract("name: x\nschema: [{column: a, tests: [{type: magic}]}]")


def test_default_contract():
    contract = default_contract("things", ["a", "b"])
    assert [(c.name, c.type) for c in contract.columns] == [("a", "STRING"), ("b", "STRING")]
    assert contract.partition_by == "batch_date"
    assert [c.name for c in default_contract("things", []).columns] == ["id"]
