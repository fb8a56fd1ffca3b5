import json

import pytest
from pyspark.sql import functions as F

from gristmill.operators.validate import (
    compile_variant_fields,
    error_list,
    field_coverage,
    first_records,
    generated_records,
    harvest,
    harvest_valid,
    invalid_records,
    valid_records,
    validation_counts,
)
from gristmill.plans.evaluate import evaluate
from gristmill.streaming.records import harvest_stream


def test_split_and_index(spark, tickets, ticket_spec):
    bad = spark.createDataFrame([(3, "x", "y")], "_pos bigint, subject string, body string")
    mixed = tickets.unionByName(bad, allowMissingColumns=True)
    valid = valid_records(mixed, ticket_spec["fields"], ["_pos"])
    errors = invalid_records(mixed, ticket_spec["fields"], "_pos").collect()
    assert valid.count() == 3 and valid.columns == ["_pos", *ticket_spec["fields"]]
    assert [e["_pos"] for e in errors] == [3]
    assert "subject: shorter than 3" in errors[0]["errors"]
    assert "category: required" in errors[0]["errors"]
    assert json.loads(errors[0]["record_json"])["subject"] == "x"
    assert validation_counts(mixed, ticket_spec["fields"]).first() == (3, 1)


def accepted(spark, rule, values):
    rows = [(i, json.dumps({"f": v})) for i, v in enumerate(values)] + [(len(values), "{}")]
    items = spark.createDataFrame(rows, "n bigint, raw string").select("n", F.parse_json("raw").alias("_item"))
    checks = compile_variant_fields({"f": rule})
    out = items.select("n", error_list(checks).alias("e"), *[c.value for c in checks]).orderBy("n").collect()
    return [len(r["e"]) == 0 for r in out], [r["f"] for r in out]


def test_json_coercion(spark):
    fine, values = accepted(
        spark, {"type": "int", "ge": 0}, [4, "4", " 4 ", "4.0", 4.0, True, 4.5, None, "x", -1, [4]]
    )
    assert fine == [True] * 6 + [False] * 6
    assert values[:6] == [4, 4, 4, 4, 4, 1]
    fine, _ = accepted(spark, {"type": "str"}, ["a", "", " ", 12, 4.5, None, {}])
    assert fine == [True, True, True, False, False, False, False, False]
    fine, _ = accepted(spark, {"type": "str", "optional": True}, ["a", None, 5])
    assert fine == [True, True, False, True]
    fine, _ = accepted(spark, {"type": "enum", "values": ["1", "yes"]}, ["1", 1, "Yes", "yes"])
    assert fine == [True, False, False, True, False]
    fine, _ = accepted(spark, {"type": "enum", "values": [True, False]}, ["True", "Yes", True])
    assert fine == [True, False, False, False]
    fine, _ = accepted(spark, {"type": "date"}, ["2026-01-01", "soon", ""])
    assert fine == [True, True, False, False]


def test_typed_columns(spark):
    df = spark.createDataFrame(
        [(0, 4.0, "4.0", True, 7), (1, 4.5, " 12 ", False, 8), (2, None, "x", None, None)],
        "_pos bigint, d double, s string, b boolean, i int",
    )
    rule = {"type": "int", "ge": 0}
    got = {name: valid_records(df, {name: rule}, ["_pos"]).orderBy("_pos").collect() for name in "dsbi"}
    assert [tuple(r) for r in got["d"]] == [(0, 4)]
    assert [tuple(r) for r in got["s"]] == [(0, 4), (1, 12)]
    assert [tuple(r) for r in got["b"]] == [(0, 1), (1, 0)]
    assert [tuple(r) for r in got["i"]] == [(0, 7), (1, 8)]
    assert valid_records(df, {"i": {"type": "str"}}, ["_pos"]).count() == 0


def test_strict_dates_are_opt_in(spark):
    df = spark.createDataFrame([(0, "2026-02-30"), (1, "2026-02-28")], "_pos bigint, d string")
    assert valid_records(df, {"d": {"type": "date"}}, ["_pos"]).count() == 2
    assert valid_records(df, {"d": {"type": "date"}}, ["_pos"], strict_dates=True).count() == 1


def test_rules_reach_the_scan(spark, tmp_path, tickets, ticket_spec):
    tickets.write.parquet(f"{tmp_path}/t")
    plan = valid_records(spark.read.parquet(f"{tmp_path}/t"), ticket_spec["fields"], ["_pos"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "In(category" in text


def test_coverage(spark):
    df = spark.createDataFrame([("a", None, 0), ("", "x", 1), (" ", "y", None)], "a string, b string, c int")
    got = {r["field"]: r["coverage"] for r in field_coverage(df, ["a", "b", "c", "gone"]).collect()}
    assert got == {"a": 0.6667, "b": 0.6667, "c": 0.6667, "gone": 0.0}
    assert {r["coverage"] for r in field_coverage(df.limit(0), ["a", "b"]).collect()} == {0.0}


RESPONSES = [
    (0, '{"records": [{"a": "x"}, {"a": 5}]}'),
    (1, '{"tickets": [{"a": "y"}]}'),
    (2, '{"data": [], "items": [{"a": "n"}]}'),
    (3, '{"a": "alone"}'),
    (4, '[{"a": "p"}, 3, {"a": "q"}]'),
    (5, '{"records": [{"a": "cut"'),
    (6, "17"),
    (7, None),
    (8, '{"records": {"a": "z"}, "items": [{"a": "i"}]}'),
]


def test_harvest(spark):
    raw = spark.createDataFrame(RESPONSES, "batch_no bigint, raw string")
    per_batch = {r["batch_no"]: r["count"] for r in harvest(raw, "batch_no", "raw").groupBy("batch_no").count().collect()}
    assert per_batch == {0: 2, 1: 1, 3: 1, 4: 3, 8: 1}
    valid = harvest_valid(raw, "batch_no", "raw", {"a": {"type": "str"}})
    assert [r["a"] for r in valid.orderBy("batch_no", "item_no").collect()] == ["x", "y", "alone", "p", "q", "i"]
    assert [r["a"] for r in first_records(valid, ["batch_no", "item_no"], 4).orderBy("batch_no", "item_no").collect()] == [
        "x", "y", "alone", "p",
    ]
    assert first_records(valid, ["batch_no", "item_no"], 99).count() == 6
    assert generated_records(raw, "batch_no", "raw", {"a": {"type": "str"}}, 5).count() == 5
    optional = harvest_valid(raw, "batch_no", "raw", {"zz": {"type": "str", "optional": True}})
    assert optional.count() == 7


def test_harvest_on_a_stream(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.createDataFrame(RESPONSES, "batch_no bigint, raw string").write.parquet(source)
    stream = spark.readStream.schema("batch_no bigint, raw string").parquet(source)
    for _ in range(2):
        query = harvest_stream(
            stream, "batch_no", "raw", {"a": {"type": "str"}}, f"{tmp_path}/out", f"{tmp_path}/state"
        )
        query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6


def test_whole_number_text(spark):
    texts = {"4": 4, " 4 ": 4, "4.0": 4, "4.00": 4, "+7": 7, "-3": -3, "1_000": 1000, " 5 ": 5}
    refused = ["4.", "4.5", "_1", "1_", "1__0", "x", "", "0x1"]
    df = spark.createDataFrame([(t,) for t in [*texts, *refused]], "n string")
    fields = {"n": {"type": "int"}}
    kept = valid_records(df, fields, []).collect()
    assert sorted(r["n"] for r in kept) == sorted(texts.values())
    rejected = invalid_records(df.withColumn("empty", F.lit(None).cast("string")), fields, "n").collect()
    assert sorted(r["n"] for r in rejected) == sorted(refused)
    assert all('"empty":null' in r["record_json"] for r in rejected)


@pytest.mark.parametrize("place", ["0", "CASE WHEN _pos > 0 THEN _pos END"])
def test_positions_that_are_not_unique_are_refused(spark, tickets, ticket_spec, place):
    with pytest.raises(ValueError, match="unique"):
        evaluate(tickets.withColumn("_pos", F.expr(place).cast("bigint")), ticket_spec, "_pos")
