import copy

import pytest
from pyspark.sql import functions as F

from gristmill.operators.fill import overlay_scenarios, recombine, synthetic_columns
from gristmill.operators.links import assign_matching, first_by_key, fk_violations
from gristmill.plans.evaluate import EvaluationOptions
from gristmill.plans.linked import (
    GenerationOptions,
    all_violations,
    authoring_prompts,
    evaluate_entities,
    generate_linked,
    generate_with_fallbacks,
    linked_fallbacks,
    linked_report,
    validate_entities,
)
from gristmill.queries.linked import CATEGORIES, MARKETPLACE
from gristmill.spec import PoolDefaults, SpecError, load_spec, needed_entities, scale_counts


def offers(spark, n):
    rows = [(i, f"Product {i} of kind {i % 5}", CATEGORIES[i % 9], 10 + i) for i in range(n)]
    return spark.createDataFrame(rows, "_pos bigint, name string, category string, price bigint")


@pytest.fixture(scope="module")
def market(spark):
    spec = scale_counts(load_spec(MARKETPLACE), 10)
    return spec, generate_linked(spark, spec, {"offers": offers(spark, 200)}, GenerationOptions(seed=1))


def test_tables_are_complete_and_linked(spark, market):
    spec, tables = market
    sizes = {name: t.count() for name, t in tables.items()}
    assert sizes["sellers"] == 40 and sizes["buyers"] == 60 and sizes["offers"] == 80 and sizes["orders"] == 100
    assert 100 <= sizes["order_items"] <= 300
    assert all_violations(tables, spec).count() == 0
    assert all(r["errors"] == 0 for r in validate_entities(tables, spec).collect())
    first = tables["sellers"].filter("_idx = 0").first()
    assert first["id"] == "SEL-0001" and tables["sellers"].columns[:2] == ["_idx", "id"]
    assert tables["offers"].select("name").distinct().count() <= 20


def test_items_follow_their_order_and_offer(market):
    _, tables = market
    items, orders, offer = (tables[n] for n in ("order_items", "orders", "offers"))
    joined = items.join(orders.select(F.col("id").alias("order_id"), F.col("seller_id").alias("os")), "order_id")
    joined = joined.join(
        offer.select(F.col("id").alias("offer_id"), F.col("seller_id").alias("fs"), "price"), "offer_id"
    )
    having = {r[0] for r in offer.select("seller_id").collect()}
    rows = joined.collect()
    assert len(rows) == items.count()
    for r in rows:
        assert r["unit_price"] == r["price"]
        assert r["os"] == r["fs"] or r["os"] not in having
    assert [r["_idx"] for r in items.orderBy("_idx").collect()] == list(range(len(rows)))


def test_scenarios_show(market):
    _, tables = market
    orders = tables["orders"]
    recent = orders.filter(F.col("placed_at").between("2026-06-04", "2026-06-17")).count()
    assert recent >= 15 and orders.filter("status = 'CANCELLED'").count() >= 1
    assert orders.filter(~F.col("placed_at").between("2026-02-17", "2026-06-17")).count() == 0


def test_same_seed_same_tables(spark, market):
    spec, tables = market
    again = generate_linked(spark, spec, {"offers": offers(spark, 200).repartition(9)}, GenerationOptions(seed=1))
    other = generate_linked(spark, spec, {"offers": offers(spark, 200)}, GenerationOptions(seed=2))
    for name in ("offers", "orders", "order_items"):
        assert sorted(map(tuple, tables[name].collect())) == sorted(map(tuple, again[name].collect()))
    assert sorted(map(tuple, tables["orders"].collect())) != sorted(map(tuple, other["orders"].collect()))


def test_authored_shortfall_and_errors(spark):
    spec = {
        "name": "d",
        "entities": {
            "a": {"count": 3, "fields": {}},
            "b": {
                "generate": "llm",
                "pool": False,
                "per_parent": {"parent": "a", "min": 2, "max": 2},
                "relationships": {"a_id": {"ref": "a"}},
                "fields": {"t": {"type": "str", "min_length": 2}},
            },
        },
    }
    rows = spark.createDataFrame([(5, "first"), (7, "x"), (9, "second"), (12, "third")], "_pos bigint, t string")
    made = generate_linked(spark, load_spec(spec), {"b": rows})["b"].orderBy("_idx").collect()
    assert [(r["id"], r["a_id"], r["t"]) for r in made] == [
        ("B-0001", "A-0001", "first"), ("B-0002", "A-0001", "second"), ("B-0003", "A-0002", "third"),
    ]
    with pytest.raises(ValueError):
        generate_linked(spark, load_spec(spec))


def test_self_reference_and_no_parents(spark):
    spec = load_spec(
        {
            "name": "d",
            "entities": {
                "none": {"count": 0, "fields": {"v": {"type": "int"}}},
                "staff": {
                    "count": 4,
                    "fields": {"n": {"type": "str"}},
                    "relationships": {"boss": {"ref": "staff"}, "no": {"ref": "none"}},
                    "copy": {"cv": {"from": "no", "field": "v"}},
                },
            },
        }
    )
    tables = generate_linked(spark, spec)
    assert {(r["boss"], r["no"], r["cv"]) for r in tables["staff"].collect()} == {(None, None, None)}
    assert all_violations(tables, spec).count() == 8
    report = {(r["metric"], r["item"]): (r["value"], r["detail"]) for r in linked_report(tables, spec).collect()}
    assert report[("violations", None)] == (8.0, "REVIEW")


def test_drawn_fields(spark):
    fields = {
        "size": {"type": "int", "ge": 1, "le": 4},
        "free": {"type": "int"},
        "color": {"type": "enum", "values": ["r", "g", "b"]},
        "smart": {"type": "enum", "values": ["yes", "no", "never"], "weights": {"yes": 3, "no": 7}},
        "qty": {"type": "int", "choices": [1, 1, 2, 3]},
        "day": {"type": "date", "anchor": "2026-06-17", "min_offset_days": -10, "max_offset_days": 0},
        "label": {"type": "str", "optional": True},
    }
    df = spark.range(2000).toDF("_idx")
    rows = df.select("_idx", *synthetic_columns(7, "w", fields, F.col("_idx"))).collect()
    assert {r["size"] for r in rows} == {1, 2, 3, 4} and {r["color"] for r in rows} == {"r", "g", "b"}
    assert 0.25 < sum(r["smart"] == "yes" for r in rows) / 2000 < 0.35
    assert {r["smart"] for r in rows} == {"yes", "no"} and {r["qty"] for r in rows} == {1, 2, 3}
    assert min(r["day"] for r in rows) == "2026-06-07" and max(r["day"] for r in rows) == "2026-06-17"
    assert min(r["free"] for r in rows) == 0 and max(r["free"] for r in rows) == 100
    assert rows[4]["label"] == f"label_{rows[4]['_idx'] + 1}"


def test_recombine(spark):
    pool = spark.createDataFrame([(i, f"a{i}", f"b{i}") for i in range(5)], "_idx bigint, a string, b string")
    rows = spark.range(300).toDF("_idx")
    whole = recombine(rows, pool, 5, 1, "e").collect()
    assert len(whole) == 300 and all(r["a"][1:] == r["b"][1:] for r in whole)
    mixed = recombine(rows, pool, 5, 1, "e", "shuffle").select("a", "b").distinct().count()
    assert mixed > 5
    part = recombine(rows, pool, 5, 1, "e", "shuffle", ["b"])
    assert part.columns == ["_idx", "a", "b"] and part.count() == 300


def test_scenarios_hit_exactly(spark):
    def table(n):
        return spark.range(n).select(F.col("id").alias("_idx"), F.lit("DELIVERED").alias("status"))

    def hits(n, *scenarios):
        made = overlay_scenarios(table(n), n, scenarios, 3, "o")
        return made.filter("status <> 'DELIVERED'").count()

    assert hits(100, {"fraction": 0.2, "set": {"status": "CANCELLED"}}) == 20
    assert hits(5, {"at_least": 1, "set": {"status": "CANCELLED"}}) == 1
    assert hits(5, {"count": 50, "set": {"status": "CANCELLED"}}) == 5
    assert hits(9000, {"count": 4321, "set": {"status": "CANCELLED"}}) == 4321
    day = {"type": "date", "anchor": "2026-06-17", "min_offset_days": -13, "max_offset_days": 0}
    made = overlay_scenarios(table(50), 50, [{"fraction": 1.0, "set": {"day": day}}], 3, "o")
    assert made.filter(F.col("day").between("2026-06-04", "2026-06-17")).count() == 50


def test_matching_draws(spark):
    parents = spark.createDataFrame(
        [("OFR-1", "SEL-A", 0), ("OFR-2", "SEL-B", 1), ("OFR-3", "SEL-B", 2), ("OFR-4", None, 3)],
        "id string, value string, _idx bigint",
    )
    via = spark.createDataFrame(
        [("O1", "SEL-A"), ("O2", "SEL-B"), ("O3", "SEL-C"), ("O4", None)], "id string, value string"
    )
    kids = spark.createDataFrame(
        [(i, [f"O{i % 5 + 1}", None][i % 5 == 4]) for i in range(500)], "_idx bigint, order_id string"
    )
    made = assign_matching(kids, "order_id", via, parents, 4, 1, "items", "offer_id").collect()
    got = {}
    for r in made:
        got.setdefault(r["order_id"], set()).add((r["offer_id"], r["offer_id_fallback"]))
    every = {"OFR-1", "OFR-2", "OFR-3", "OFR-4"}
    assert len(made) == 500
    assert got["O1"] == {("OFR-1", False)}
    assert got["O2"] == {("OFR-2", False), ("OFR-3", False)}
    assert got["O3"] == {(o, True) for o in every}
    assert got["O4"] == {("OFR-4", False)}
    assert got[None] == {(o, False) for o in every}


def test_violations_and_first_parent(spark):
    parent = spark.createDataFrame([("A", 1, 0), ("A", 2, 1), (None, 3, 2)], "id string, v int, p bigint")
    child = spark.createDataFrame([(0, "A"), (1, "B"), (2, None), (3, "B")], "row_no bigint, fk string")
    bad = fk_violations(child, "c", "row_no", "fk", parent, "id", "p").orderBy("row").collect()
    assert [(r["row"], r["value"]) for r in bad] == [(1, "B"), (2, None), (3, "B")]
    assert [tuple(r) for r in first_by_key(parent, "id", "p", ["v"]).collect()] == [("A", 1)]


def test_quality_flags_only(spark, market):
    spec, tables = market
    got = evaluate_entities(tables, spec, EvaluationOptions())
    rows = {(r["section"], r["metric"], r["item"]): r["value"] for r in got.collect()}
    assert rows[("offers", "near_duplicate_pairs", None)] > 0
    assert ("buyers", "label:smart", "no") in rows and ("sellers", "n_records", None) not in rows
    assert tables["offers"].count() == 80
    judged = copy.deepcopy(spec)
    judged["entities"]["offers"]["judge"] = {"dimensions": ["realism"]}
    raw = tables["offers"].select("_idx", F.lit('{"realism": 4}').alias("raw"))
    rows = {r["metric"]: r["value"] for r in evaluate_entities(tables, judged, responses={"offers": raw}).collect()}
    assert rows["judged"] == 80 and rows["judge_overall_mean"] == 4.0


def test_authoring_prompts_cover_the_pool(spark):
    spec = load_spec(MARKETPLACE)
    needs = lambda rows: authoring_prompts(spark, spec, "offers", rows).agg(F.sum("need")).first()[0]
    assert needs(8) == 8 and needs(1000) == 250


def test_pool_can_be_tuned(spark):
    spec = scale_counts(load_spec(MARKETPLACE), counts={"offers": 60})
    spec["entities"]["offers"].pop("pool")
    options = GenerationOptions(pool=PoolDefaults(min_size=5, recombine="shuffle"))
    made = generate_linked(spark, spec, {"offers": offers(spark, 100)}, options)["offers"]
    assert made.count() == 60 and made.select("name").distinct().count() <= 6


def test_only_what_is_needed_is_made(spark, market):
    spec, tables = market
    assert needed_entities(spec, ["offers"]) == ["sellers", "offers"]
    assert needed_entities(spec, ["order_items"]) == list(spec["entities"])
    with pytest.raises(SpecError, match="unknown entity: shops"):
        needed_entities(spec, ["shops"])
    # No authored rows are asked for, as no offers are made.
    part = generate_linked(spark, spec, options=GenerationOptions(seed=1), only=["orders", "buyers"])
    assert list(part) == ["buyers", "orders"]
    for name, table in part.items():
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, tables[name].collect()))


def test_generation_returns_its_fallbacks(spark):
    spec = scale_counts(load_spec(MARKETPLACE), 10)
    spec["entities"]["offers"]["count"] = 15  # fewer than sellers
    given = {"offers": offers(spark, 200)}
    tables, lost = generate_with_fallbacks(spark, spec, given, GenerationOptions(seed=1))
    assert "_fallback:offer_id" not in tables["order_items"].columns
    counted = linked_fallbacks(tables, spec).collect()
    assert lost.collect() == counted and counted[0]["fallbacks"] > 0
    assert generate_with_fallbacks(spark, spec, given, only=["orders"])[1] is None
