from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TICKET_SPEC = {
    "name": "support_tickets",
    "fields": {
        "subject": {"type": "str", "min_length": 3, "max_length": 120},
        "body": {"type": "str", "min_length": 20, "max_length": 1500},
        "category": {"type": "enum", "values": ["billing", "technical", "account", "shipping", "product", "other"]},
        "priority": {"type": "enum", "values": ["low", "medium", "high", "urgent"]},
        "sentiment": {"type": "enum", "values": ["positive", "neutral", "negative"]},
        "customer_name": {"type": "str", "min_length": 2, "max_length": 60},
        "product": {"type": "str", "optional": True},
    },
    "text_field": "body",
    "label_fields": ["category", "priority", "sentiment"],
    "judge": {"dimensions": ["realism", "coherence", "label_fit"], "system": "Rate it."},
    "chat_export": {
        "system": "Classify the ticket.",
        "user_template": "{subject}\n\n{body}",
        "assistant_template": "category: {category}, product: {product}",
    },
}
TICKETS = [
    ("Charged twice", "I was charged twice for my subscription this month.", "billing", "high", "negative", "Ada", "Pro plan"),
    ("Thanks", "The new dashboard is a delight to work with every day.", "account", "low", "positive", "Ben", None),
    ("Crash", "The app crashes whenever a large report is opened.", "technical", "urgent", "negative", "Cyd", "Desktop"),
]
TICKET_COLUMNS = "_pos bigint, subject string, body string, category string, priority string, sentiment string, customer_name string, product string"


@pytest.fixture(scope="session")
def tickets(spark):
    return spark.createDataFrame([(i, *t) for i, t in enumerate(TICKETS)], TICKET_COLUMNS)


@pytest.fixture(scope="session")
def ticket_spec():
    return TICKET_SPEC
