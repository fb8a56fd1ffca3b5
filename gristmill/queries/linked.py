"""Linked marketplace tables whose sizes and authored content come from the given tables.

One seller per supplier, one buyer per customer, one offer per part, one order per order; offers are
authored from ``part`` and recombined.
"""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.plans.linked import (
    all_violations,
    evaluate_entities,
    generate_linked,
    linked_fallbacks,
    linked_report,
    validate_entities,
)
from gristmill.queries import sql
from gristmill.queries.generation import STATUS
from gristmill.queries.tables import row_count, table
from gristmill.spec import load_spec, needed_entities, scale_counts

SEED = 42
# The marketplace domain.
CATEGORIES = [
    "electronics",
    "fashion",
    "home",
    "sports",
    "beauty",
    "toys",
    "perishable",
    "personalized",
    "digital_unsealed",
]
DELIVERY = ["COURIER", "PARCEL_LOCKER", "PICKUP_POINT"]
MARKETPLACE = {
    "name": "marketplace",
    "entities": {
        "sellers": {
            "id_prefix": "SEL",
            "count": 4,
            "fields": {
                "name": {"type": "str", "min_length": 2, "max_length": 60},
                "rating": {"type": "int", "ge": 1, "le": 5},
            },
        },
        "buyers": {
            "id_prefix": "BUY",
            "count": 6,
            "label_fields": ["smart", "locale"],
            "fields": {
                "login": {"type": "str", "min_length": 3, "max_length": 30},
                "smart": {"type": "enum", "values": ["yes", "no"], "weights": {"yes": 3, "no": 7}},
                "locale": {"type": "enum", "values": ["pl", "en"]},
            },
        },
        "offers": {
            "id_prefix": "OFR",
            "count": 8,
            "generate": "llm",
            "pool": {"fraction": 0.25, "min_size": 20, "recombine": "sample"},
            "text_field": "name",
            "label_fields": ["category"],
            "relationships": {"seller_id": {"ref": "sellers"}},
            "fields": {
                "name": {"type": "str", "min_length": 3, "max_length": 100},
                "category": {"type": "enum", "values": CATEGORIES},
                "price": {"type": "int", "ge": 10, "le": 9999},
            },
        },
        "orders": {
            "id_prefix": "ORD",
            "count": 10,
            "label_fields": ["status", "delivery_method"],
            "relationships": {"buyer_id": {"ref": "buyers"}, "seller_id": {"ref": "sellers"}},
            "fields": {
                "status": {"type": "enum", "values": list(STATUS), "weights": STATUS},
                "delivery_method": {"type": "enum", "values": DELIVERY},
                "placed_at": {
                    "type": "date",
                    "anchor": "2026-06-17",
                    "min_offset_days": -120,
                    "max_offset_days": 0,
                },
            },
            "scenarios": [
                {
                    "name": "in_returns_window",
                    "fraction": 0.15,
                    "set": {
                        "placed_at": {
                            "type": "date",
                            "anchor": "2026-06-17",
                            "min_offset_days": -13,
                            "max_offset_days": 0,
                        }
                    },
                },
                {"name": "guarantee_cancelled", "at_least": 1, "set": {"status": "CANCELLED"}},
            ],
        },
        "order_items": {
            "id_prefix": "ITM",
            "per_parent": {"parent": "orders", "min": 1, "max": 3, "fk": "order_id"},
            "relationships": {
                "order_id": {"ref": "orders"},
                "offer_id": {"ref": "offers", "match": {"field": "seller_id", "via": "order_id"}},
            },
            "copy": {"unit_price": {"from": "offer_id", "field": "price"}},
            "fields": {"quantity": {"type": "int", "ge": 1, "le": 5, "choices": [1, 1, 1, 2, 2, 3]}},
        },
    },
}
SIZED_BY = {"sellers": "supplier", "buyers": "customer", "offers": "part", "orders": "orders"}


def authored_offers(spark: SparkSession, folder: str) -> DataFrame:
    categories = F.array(*[F.lit(c) for c in CATEGORIES])
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("_pos"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.get(categories, F.col("p_size") % len(CATEGORIES)).alias("category"),
        F.floor("p_retailprice").alias("price"),
    )


def marketplace(spark: SparkSession, folder: str, *only: str) -> tuple[dict, dict[str, DataFrame]]:
    """The spec at the size of the given tables, and all its tables or the ones named."""
    spec = load_spec(MARKETPLACE)
    needed = needed_entities(spec, only or spec["entities"])
    counts = {entity: row_count(table(spark, folder, name)) for entity, name in SIZED_BY.items() if entity in needed}
    spec = scale_counts(spec, counts=counts)
    return spec, generate_linked(spark, spec, {"offers": authored_offers(spark, folder)}, only=only or None)


def marketplace_offers(spark: SparkSession, folder: str) -> DataFrame:
    return marketplace(spark, folder, "offers")[1]["offers"].drop("_idx")


def marketplace_orders(spark: SparkSession, folder: str) -> DataFrame:
    return marketplace(spark, folder, "orders")[1]["orders"].drop("_idx")


def marketplace_items(spark: SparkSession, folder: str) -> DataFrame:
    return marketplace(spark, folder, "order_items")[1]["order_items"].drop("_idx")


def marketplace_join(spark: SparkSession, folder: str) -> DataFrame:
    _, tables = marketplace(spark, folder, "order_items", "offers", "sellers")
    items = tables["order_items"].select("offer_id")
    offers = tables["offers"].select(F.col("id").alias("offer_id"), "seller_id")
    sellers = tables["sellers"].select(F.col("id").alias("seller_id"))
    joined = items.join(offers, "offer_id").join(sellers, "seller_id")
    return joined.agg(F.count(F.lit(1)).alias("rows"))


# Rules stricter than those the tables were made by, so that validation has something to reject.
def stricter(spec: dict) -> dict:
    spec = copy.deepcopy(spec)
    spec["entities"]["sellers"]["fields"]["rating"]["le"] = 4
    spec["entities"]["offers"]["fields"]["price"]["le"] = 950
    spec["entities"]["orders"]["fields"]["status"]["values"] = [s for s in STATUS if s != "CANCELLED"]
    return spec


def without_poor_sellers(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Offers and orders of sellers rated below 3 refer to nothing then."""
    return tables | {"sellers": tables["sellers"].filter(F.col("rating") >= 3)}


def validated(spark: SparkSession, folder: str) -> DataFrame:
    spec, tables = marketplace(spark, folder)
    return validate_entities(tables, stricter(spec))


def integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of generated tables after the poorly rated sellers were taken out."""
    spec, tables = marketplace(spark, folder)
    return all_violations(without_poor_sellers(tables), spec)


def fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    """Items whose order's seller has no offer of some category left."""
    spec, tables = marketplace(spark, folder)
    tables["offers"] = tables["offers"].filter(F.col("category") == CATEGORIES[0])
    return linked_fallbacks(tables, spec)


def entity_quality(spark: SparkSession, folder: str) -> DataFrame:
    measured = [name for name, entity in MARKETPLACE["entities"].items() if "text_field" in entity or "label_fields" in entity]
    spec, tables = marketplace(spark, folder, *measured)
    return evaluate_entities(tables, spec)


def report(spark: SparkSession, folder: str) -> DataFrame:
    spec, tables = marketplace(spark, folder)
    return linked_report(without_poor_sellers(tables), stricter(spec))


QUERIES = {
    "marketplace_offers": marketplace_offers,
    "marketplace_orders": marketplace_orders,
    "marketplace_items": marketplace_items,
    "marketplace_join": marketplace_join,
    "marketplace_violations": integrity,
    "linked_fallbacks": fallbacks,
    "validate_entities": validated,
    "entity_quality": entity_quality,
    "relational_report": report,
}


def _count(name: str) -> str:
    return f"(SELECT count(*) FROM {name})"


def _fk(entity: str, fk: str, ref: str, prefix: str) -> str:
    return sql.record_id(prefix, sql.below(SEED, entity, f"fk:{fk}", "x", _count(ref)))


_CATEGORY = f"([{', '.join(sql.text(c) for c in CATEGORIES)}])[p_size % {len(CATEGORIES)} + 1]"
_POOL_SIZE = "greatest(20, ceil(0.25 * n))"
_ORDERED = "row_number() OVER (ORDER BY {0}, x)"
_WINDOW = sql.days_from("2026-06-17", sql.between(SEED, "orders", "scenario:0:placed_at", "x", -13, 0))
_SPREAD = sql.days_from("2026-06-17", sql.between(SEED, "orders", "placed_at", "x", -120, 0))
_TABLES = f"""
  sellers AS (
    SELECT x, {sql.record_id('SEL', 'x')} AS id, 'name_' || (x + 1) AS name,
      {sql.between(SEED, 'sellers', 'rating', 'x', 1, 5)} AS rating
    FROM (SELECT unnest(range({_count('supplier')})) AS x)),
  buyers AS (
    SELECT x, {sql.record_id('BUY', 'x')} AS id, 'login_' || (x + 1) AS login,
      {sql.weighted(SEED, 'buyers', 'smart', 'x', ['yes', 'no'], [3, 7])} AS smart,
      {sql.choice(SEED, 'buyers', 'locale', 'x', ['pl', 'en'])} AS locale
    FROM (SELECT unnest(range({_count('customer')})) AS x)),
  pool AS (
    SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pick, p_name || ' ' || p_brand AS name,
      {_CATEGORY} AS category, CAST(floor(p_retailprice) AS BIGINT) AS price
    FROM part, (SELECT count(*) AS n FROM part)
    WHERE length(p_name || ' ' || p_brand) BETWEEN 3 AND 100 AND floor(p_retailprice) BETWEEN 10 AND 9999
    QUALIFY row_number() OVER (ORDER BY p_partkey) <= CASE WHEN {_POOL_SIZE} >= n THEN n ELSE {_POOL_SIZE} END),
  offers AS (
    SELECT x, {sql.record_id('OFR', 'x')} AS id, name, category, price,
      {_fk('offers', 'seller_id', 'supplier', 'SEL')} AS seller_id
    FROM (SELECT unnest(range({_count('part')})) AS x) JOIN pool
    ON pick = {sql.below(SEED, 'offers', 'pool', 'x', _count('pool'))}),
  drawn_orders AS (
    SELECT x,
      {_ORDERED.format(sql.bits(SEED, 'orders', 'scenario:0', 'x'))} <= round_even(0.15 * {_count('orders')}, 0) AS s0,
      {_ORDERED.format(sql.bits(SEED, 'orders', 'scenario:1', 'x'))} <= 1 AS s1
    FROM (SELECT unnest(range({_count('main.orders')})) AS x)),
  orders_made AS (
    SELECT x, {sql.record_id('ORD', 'x')} AS id,
      CASE WHEN s1 THEN 'CANCELLED'
        ELSE {sql.weighted(SEED, 'orders', 'status', 'x', list(STATUS), list(STATUS.values()))} END AS status,
      {sql.choice(SEED, 'orders', 'delivery_method', 'x', DELIVERY)} AS delivery_method,
      CASE WHEN s0 THEN {_WINDOW} ELSE {_SPREAD} END AS placed_at,
      {_fk('orders', 'buyer_id', 'customer', 'BUY')} AS buyer_id,
      {_fk('orders', 'seller_id', 'supplier', 'SEL')} AS seller_id
    FROM drawn_orders),
  counted AS (SELECT *, {sql.between(SEED, 'order_items', 'children', 'x', 1, 3)} AS k FROM orders_made),
  placed AS (SELECT *, CAST(sum(k) OVER (ORDER BY x) - k AS BIGINT) AS start FROM counted),
  born AS (SELECT id AS order_id, seller_id AS want, start + unnest(range(k)) AS x FROM placed),
  ranked AS (
    SELECT id, seller_id, price, x AS g, row_number() OVER (PARTITION BY seller_id ORDER BY x) - 1 AS r FROM offers),
  sizes AS (SELECT seller_id, count(*) AS n FROM offers GROUP BY seller_id),
  aimed AS (
    SELECT b.x, order_id, want, n, CASE WHEN n IS NULL
      THEN {sql.below(SEED, 'order_items', 'fk:offer_id:any', 'b.x', _count('part'))}
      ELSE {sql.below(SEED, 'order_items', 'fk:offer_id', 'b.x', 'n')} END AS at
    FROM born b LEFT JOIN sizes s ON s.seller_id = b.want),
  items AS (
    SELECT x, {sql.record_id('ITM', 'x')} AS id,
      CAST({sql.choice(SEED, 'order_items', 'quantity', 'x', [1, 1, 1, 2, 2, 3])} AS BIGINT) AS quantity,
      order_id, k.id AS offer_id, k.price AS unit_price
    FROM aimed a JOIN ranked k
    ON CASE WHEN a.n IS NULL THEN k.g = a.at ELSE k.seller_id = a.want AND k.r = a.at END)"""

_SIZES = [
    ("sellers", "sellers"),
    ("buyers", "buyers"),
    ("offers", "offers"),
    ("orders", "orders_made"),
    ("order_items", "items"),
]


def _long(entity: str, select: str) -> str:
    return f"SELECT '{entity}' AS section, metric, item, value, CAST(NULL AS VARCHAR) AS detail FROM ({select})"


_QUALITY = " UNION ALL ".join(
    [
        _long("buyers", " UNION ALL ".join(sql.label_parts("buyers", ["smart", "locale"]))),
        """SELECT 'offers', 'near_duplicate_pairs', NULL, CAST(count(*) AS DOUBLE), NULL FROM sims""",
        _long("offers", sql.diversity("named", "vec", ["category"])),
        _long("orders", " UNION ALL ".join(sql.label_parts("orders_made", ["status", "delivery_method"]))),
    ]
)
_BROKEN = {"sellers": "rating > 4", "offers": "price > 950", "orders": "status = 'CANCELLED'", "order_items": "unit_price > 950"}
_RATED = "(SELECT * FROM sellers WHERE rating >= 3)"
_ORPHANS = " UNION ALL ".join(
    f"SELECT '{entity}' AS entity, x AS row, 'seller_id' AS fk, seller_id AS value, 'sellers' AS ref "
    f"FROM {made} WHERE seller_id NOT IN (SELECT id FROM {_RATED})"
    for entity, made in (("offers", "offers"), ("orders", "orders_made"))
)


def _checked(sellers: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, count(*) FILTER (NOT {bad}) AS valid, count(*) FILTER ({bad}) AS errors "
        f"FROM {sellers if entity == 'sellers' else made}"
        for entity, made in _SIZES
        for bad in [f"({_BROKEN.get(entity, 'false')})"]
    )


_REPORT = f"""
  SELECT 'entities' AS section, metric, entity AS item, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail
  FROM (SELECT entity, unnest(['rows', 'valid', 'errors']) AS metric, unnest([valid + errors, valid, errors]) AS value FROM checked)
  UNION ALL SELECT 'integrity', 'violations', NULL, CAST(count(*) AS DOUBLE), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'REVIEW' END FROM orphans
  UNION ALL SELECT 'integrity', 'violation', entity || '.' || fk, CAST(row AS DOUBLE), value || ' -> ' || ref FROM orphans"""

SQL = {
    "marketplace_offers": f"WITH {_TABLES} SELECT * EXCLUDE (x) FROM offers",
    "marketplace_orders": f"WITH {_TABLES} SELECT * EXCLUDE (x) FROM orders_made",
    "marketplace_items": f"WITH {_TABLES} SELECT * EXCLUDE (x) FROM items",
    "marketplace_join": f"""
      WITH {_TABLES} SELECT count(*) AS rows FROM items i
      JOIN offers o ON o.id = i.offer_id JOIN sellers s ON s.id = o.seller_id""",
    "marketplace_violations": f"WITH {_TABLES} {_ORPHANS}",
    "linked_fallbacks": f"""
      WITH {_TABLES} SELECT 'order_items' AS entity, 'offer_id' AS fk, count(*) AS fallbacks FROM born
      WHERE want NOT IN (SELECT seller_id FROM offers WHERE category = {sql.text(CATEGORIES[0])})""",
    "validate_entities": f"WITH {_TABLES} {_checked('sellers')}",
    "entity_quality": f"""
      WITH {_TABLES}, named AS (SELECT x AS id, name AS text, category FROM offers),
      {sql.vectors('named')}, {sql.all_pairs()} {_QUALITY}""",
    "relational_report": f"WITH {_TABLES}, checked AS ({_checked(_RATED)}), orphans AS ({_ORPHANS}) {_REPORT}",
}
