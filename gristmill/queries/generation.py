"""Generation operators with the given tables as parents, pools and row sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.fill import overlay_scenarios, recombine, record_id, synthetic_columns
from gristmill.operators.indexing import dense_index
from gristmill.operators.links import (
    assign_matching,
    children_of,
    copy_fields,
    draw_parent,
    duplicate_keys,
    fallback_count,
    first_by_key,
    fk_violations,
)
from gristmill.queries import sql
from gristmill.queries.tables import row_count, table
from gristmill.sources.writers import bundle, typed_table

SEED = 42
# Order fields of the marketplace domain, and more fields of every kind.
STATUS = {"NEW": 1, "PAID": 2, "PROCESSING": 2, "SHIPPED": 2, "DELIVERED": 6, "CANCELLED": 1}
ORDER_FIELDS = {
    "status": {"type": "enum", "values": list(STATUS), "weights": STATUS},
    "delivery_method": {"type": "enum", "values": ["COURIER", "PARCEL_LOCKER", "PICKUP_POINT"]},
    "placed_at": {"type": "date", "anchor": "2026-06-17", "min_offset_days": 0, "max_offset_days": -120},
    "quantity": {"type": "int", "ge": 1, "le": 5, "choices": [1, 1, 1, 2, 2, 3]},
    "rating": {"type": "int", "ge": 1, "le": 5},
    "points": {"type": "int"},
    "note": {"type": "str", "optional": True},
}
SCENARIOS = [
    {
        "name": "recent",
        "fraction": 0.15,
        "set": {"placed": {"type": "date", "anchor": "2026-06-17", "min_offset_days": -13, "max_offset_days": 0}},
    },
    {"name": "cancelled", "at_least": 1, "set": {"status": "CANCELLED"}},
    {"name": "urgent", "count": 10, "set": {"priority": "1-URGENT", "status": "F"}},
]


def order_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The orders at their dense positions."""
    orders = table(spark, folder, "orders").select("o_orderkey", *columns)
    return dense_index(orders, "o_orderkey")


def synth_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_rows(spark, folder)
    drawn = synthetic_columns(SEED, "orders", ORDER_FIELDS, F.col("_idx"))
    return rows.select(record_id("ORD", F.col("_idx")).alias("id"), *drawn)


def _recombined(spark: SparkSession, folder: str, strategy: str, fields: list[str] | None) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    pool = dense_index(parts, "p_partkey").drop("p_partkey")
    rows = order_rows(spark, folder)
    return recombine(rows, pool, row_count(parts), SEED, "offers", strategy, fields).drop("_idx")


def recombine_sample(spark: SparkSession, folder: str) -> DataFrame:
    return _recombined(spark, folder, "sample", None)


def recombine_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return _recombined(spark, folder, "shuffle", ["p_brand", "p_size"])


def per_parent_children(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_rows(spark, folder)
    made = children_of(rows, "_idx", row_count(rows), 0, 3, SEED, "order_items", ["o_orderkey"])
    return made.select("o_orderkey", F.col("_child").alias("child"), F.col("_idx").alias("row"))


def scenario_overlay(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_rows(spark, folder, "o_orderstatus", "o_orderpriority", "o_orderdate").select(
        "_idx",
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed"),
    )
    return overlay_scenarios(rows, row_count(rows), SCENARIOS, SEED, "orders").drop("_idx")


def fk_uniform(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = dense_index(table(spark, folder, "supplier").select("s_suppkey"), "s_suppkey", "_pick")
    rows = order_rows(spark, folder)
    at = draw_parent(SEED, "orders", "supplier_id", F.col("_idx"), row_count(suppliers))
    return rows.withColumn("_pick", at).join(suppliers, "_pick", "left").select("o_orderkey", "s_suppkey")


def _matched(spark: SparkSession, folder: str, supplier_value: str, customer_value: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.expr(supplier_value).alias("value")
    )
    parents = dense_index(suppliers, "id")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.expr(customer_value).alias("value")
    )
    rows = order_rows(spark, folder, "o_custkey")
    return assign_matching(
        rows, "o_custkey", customers, parents, row_count(suppliers), SEED, "orders", "supplier_id"
    )


def fk_match(spark: SparkSession, folder: str) -> DataFrame:
    matched = _matched(spark, folder, "s_nationkey", "c_nationkey")
    return matched.select("o_orderkey", "supplier_id", "supplier_id_fallback")


def fk_match_fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    band = "floor({0} / 50)"
    matched = _matched(spark, folder, band.format("s_acctbal"), band.format("c_acctbal"))
    return fallback_count(matched, "supplier_id")


def copy_field(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_brand")
    first = first_by_key(parts, "p_partkey", "p_partkey", ["p_retailprice", "p_brand"])
    return copy_fields(
        lines, "l_partkey", first, "p_partkey", {"unit_price": "p_retailprice", "brand": "p_brand"}
    )


def violations(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    solvent = table(spark, folder, "customer").filter(F.col("c_acctbal") >= 0)
    return fk_violations(orders, "orders", "o_orderkey", "o_custkey", solvent, "c_custkey", "customer")


def pk_check(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


def linked_join_count(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey")
    parts = table(spark, folder, "part").select("p_partkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    joined = joined.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.agg(F.count(F.lit(1)).alias("rows"))


def typed(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").select(
        F.format_string("ORD-%04d", F.col("o_orderkey") + 1).alias("id"),
        F.col("o_custkey").cast("string").alias("buyer"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("placed_at"),
    )
    fields = {
        "buyer": {"type": "int"},
        "placed_at": {"type": "date"},
        "id": {"type": "str"},
        "remark": {"type": "str", "optional": True},
    }
    return typed_table(raw, fields)


def bundle_rows(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "supplier", "nation", "region", "part")
    rows = bundle({name: table(spark, folder, name) for name in names})
    return rows.groupBy("entity").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("record").startswith("{")).alias("objects")
    )


QUERIES = {
    "synth_orders": synth_orders,
    "recombine_sample": recombine_sample,
    "recombine_shuffle": recombine_shuffle,
    "per_parent_children": per_parent_children,
    "scenario_overlay": scenario_overlay,
    "fk_uniform": fk_uniform,
    "fk_match": fk_match,
    "fk_match_fallbacks": fk_match_fallbacks,
    "copy_field": copy_field,
    "fk_violations": violations,
    "pk_check": pk_check,
    "linked_join_count": linked_join_count,
    "typed_table": typed,
    "bundle_rows": bundle_rows,
}

_ROWS = "rows AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)"
_POOL = """pool AS (
  SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pick, p_name, p_brand, p_size FROM part),
  size AS (SELECT count(*) AS n FROM part)"""
_MET = "supplier_id"


def _match_sql(supplier_value: str, customer_value: str, select: str) -> str:
    bound = sql.below(SEED, "orders", f"fk:{_MET}", "idx", "s.n")
    free = sql.below(SEED, "orders", f"fk:{_MET}:any", "idx", "(SELECT count(*) FROM supplier)")
    return f"""
    WITH {_ROWS},
    ranked AS (
      SELECT s_suppkey, {supplier_value} AS value,
        row_number() OVER (PARTITION BY {supplier_value} ORDER BY s_suppkey) - 1 AS r,
        row_number() OVER (ORDER BY s_suppkey) - 1 AS g
      FROM supplier),
    sizes AS (SELECT value, count(*) AS n FROM ranked GROUP BY value),
    drawn AS (
      SELECT o_orderkey, c.c_custkey, s.n, s.value, CASE WHEN s.n IS NULL THEN {free} ELSE {bound} END AS at
      FROM rows LEFT JOIN customer c ON c.c_custkey = o_custkey LEFT JOIN sizes s ON s.value = {customer_value}),
    picked AS (
      SELECT o_orderkey, s_suppkey AS supplier_id, c_custkey IS NOT NULL AND n IS NULL AS supplier_id_fallback
      FROM drawn d JOIN ranked k
      ON CASE WHEN d.n IS NULL THEN k.g = d.at ELSE k.value = d.value AND k.r = d.at END)
    {select}"""


def _scenario_sql() -> str:
    picked = []
    for number, size in enumerate(["round_even(0.15 * n, 0)", "1", "10"]):
        order = sql.bits(SEED, "orders", f"scenario:{number}", "idx")
        picked.append(f"row_number() OVER (ORDER BY {order}, idx) <= least({size}, n) AS s{number}")
    recent = sql.days_from("2026-06-17", sql.between(SEED, "orders", "scenario:0:placed", "idx", -13, 0))
    return f"""
    WITH {_ROWS}, marked AS (
      SELECT *, {', '.join(picked)} FROM rows, (SELECT count(*) AS n FROM orders))
    SELECT o_orderkey,
      CASE WHEN s2 THEN 'F' WHEN s1 THEN 'CANCELLED' ELSE o_orderstatus END AS status,
      CASE WHEN s2 THEN '1-URGENT' ELSE o_orderpriority END AS priority,
      CASE WHEN s0 THEN {recent} ELSE strftime(o_orderdate, '%Y-%m-%d') END AS placed
    FROM marked"""


def _draw(field: str, maker, *args) -> str:
    return f"{maker(SEED, 'orders', field, 'idx', *args)}"


SQL = {
    "synth_orders": f"""
      WITH {_ROWS} SELECT {sql.record_id('ORD', 'idx')} AS id,
        {_draw('status', sql.weighted, list(STATUS), list(STATUS.values()))} AS status,
        {_draw('delivery_method', sql.choice, ORDER_FIELDS['delivery_method']['values'])} AS delivery_method,
        {sql.days_from('2026-06-17', _draw('placed_at', sql.between, -120, 0))} AS placed_at,
        CAST({_draw('quantity', sql.choice, [1, 1, 1, 2, 2, 3])} AS BIGINT) AS quantity,
        {_draw('rating', sql.between, 1, 5)} AS rating,
        {_draw('points', sql.between, 0, 100)} AS points,
        'note_' || (idx + 1) AS note
      FROM rows""",
    "recombine_sample": f"""
      WITH {_ROWS}, {_POOL}
      SELECT o_orderkey, p_name, p_brand, p_size
      FROM rows, size JOIN pool ON pick = {sql.below(SEED, 'offers', 'pool', 'idx', 'n')}""",
    "recombine_shuffle": f"""
      WITH {_ROWS}, {_POOL}
      SELECT o_orderkey, a.p_name, b.p_brand, c.p_size
      FROM rows, size
      JOIN pool a ON a.pick = {sql.below(SEED, 'offers', 'pool', 'idx', 'n')}
      JOIN pool b ON b.pick = {sql.below(SEED, 'offers', 'pool:p_brand', 'idx', 'n')}
      JOIN pool c ON c.pick = {sql.below(SEED, 'offers', 'pool:p_size', 'idx', 'n')}""",
    "per_parent_children": f"""
      WITH {_ROWS}, counted AS (
        SELECT o_orderkey, idx, {sql.between(SEED, 'order_items', 'children', 'idx', 0, 3)} AS k FROM rows),
      placed AS (SELECT *, sum(k) OVER (ORDER BY idx) - k AS start FROM counted),
      born AS (SELECT o_orderkey, start, unnest(range(k)) AS child FROM placed)
      SELECT o_orderkey, child, CAST(start + child AS BIGINT) AS row FROM born""",
    "scenario_overlay": _scenario_sql(),
    "fk_uniform": f"""
      WITH {_ROWS}, parents AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS pick FROM supplier)
      SELECT o_orderkey, s_suppkey FROM rows JOIN parents
      ON pick = {sql.below(SEED, 'orders', 'fk:supplier_id', 'idx', '(SELECT count(*) FROM supplier)')}""",
    "fk_match": _match_sql("s_nationkey", "c_nationkey", "SELECT * FROM picked"),
    "fk_match_fallbacks": _match_sql(
        "floor(s_acctbal / 50)",
        "floor(c_acctbal / 50)",
        "SELECT 'supplier_id' AS fk, count(*) FILTER (WHERE supplier_id_fallback) AS fallbacks FROM picked",
    ),
    "copy_field": """
      SELECT l_orderkey, l_linenumber, l_partkey, p_retailprice AS unit_price, p_brand AS brand
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "fk_violations": """
      SELECT 'orders' AS entity, o_orderkey AS row, 'o_custkey' AS fk, CAST(o_custkey AS VARCHAR) AS value, 'customer' AS ref
      FROM orders WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "pk_check": """
      SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
      GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "linked_join_count": """
      SELECT count(*) AS rows FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "typed_table": """
      SELECT o_custkey AS buyer, CAST(o_orderdate AS DATE) AS placed_at, printf('ORD-%04d', o_orderkey + 1) AS id,
        CAST(NULL AS VARCHAR) AS remark FROM orders""",
    "bundle_rows": " UNION ALL ".join(
        f"SELECT '{n}' AS entity, count(*) AS rows, count(*) AS objects FROM {n}"
        for n in ("customer", "supplier", "nation", "region", "part")
    ),
}
