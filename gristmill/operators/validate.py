"""Schema validation, field coverage and harvesting of model responses.

Rules compile to column predicates, so a whole table is checked by one projection and the
simple ones (enum membership, ranges, not null) reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import is_filled
from gristmill.operators.indexing import first_k
from gristmill.session import stage
from gristmill.spec import enum_values

# Keys under which a response may wrap its records, in order of preference.
WRAPPER_KEYS = ("records", "tickets", "data", "items")
# Fixed pattern: text that reads as a whole number. Blanks of any kind may stand around it, single
# underscores between its digits, and zeros behind a decimal point.
WHOLE_NUMBER = r"^[\s\p{Z}]*[+-]?[0-9]+((_[0-9]+)*|\.0+)[\s\p{Z}]*$"
WHOLE_PART = r"([+-]?[0-9_]+)"

log = logging.getLogger(__name__)

ITEM = "_item"


@dataclass(frozen=True)
class CheckedField:
    """One field of the result: its coerced value, when it is fine, and what a row can do wrong.

    ``fine`` is made of plain comparisons, which the scan understands; it may be null for a bad row,
    which a filter treats like false.
    """

    name: str
    value: Column
    fine: Column
    broken: list[tuple[Column, str]]


def spark_type(rule: dict) -> T.DataType:
    return T.LongType() if rule.get("type", "str") == "int" else T.StringType()


def compile_fields(fields: dict, source: DataFrame, strict_dates: bool = False) -> list[CheckedField]:
    """Checks of ``fields`` against the typed columns of ``source``."""
    types = {f.name: f.dataType for f in source.schema.fields}
    checks = []
    for name, rule in fields.items():
        if name in types:
            reader = _typed_reader(F.col(f"`{name}`"), types[name])
        else:
            reader = _Reader(F.lit(True), F.lit(None).cast("string"), F.lit(None).cast("bigint"))
        checks.append(_check(name, rule, reader, strict_dates))
    return checks


def compile_variant_fields(fields: dict, item: str = ITEM, strict_dates: bool = False) -> list[CheckedField]:
    """Checks of ``fields`` against a VARIANT column, by the JSON type of every raw value."""
    return [
        _check(name, rule, _variant_reader(F.col(item), name), strict_dates)
        for name, rule in fields.items()
    ]


@dataclass(frozen=True)
class _Reader:
    missing: Column
    text: Column  # null unless the value is a string
    whole: Column  # null unless the value reads as a whole number


def _typed_reader(column: Column, data_type: T.DataType) -> _Reader:
    none_text, none_whole = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    missing = column.isNull()
    if isinstance(data_type, T.StringType):
        return _Reader(missing, column, _whole_from_text(column))
    if isinstance(data_type, T.BooleanType):
        return _Reader(missing, none_text, column.cast("bigint"))
    if isinstance(data_type, T.IntegralType):
        return _Reader(missing, none_text, column.cast("bigint"))
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return _Reader(missing, none_text, _whole_from_number(column))
    return _Reader(missing, none_text, none_whole)


def _whole_from_text(text: Column) -> Column:
    digits = F.replace(F.regexp_extract(text, WHOLE_PART, 1), F.lit("_"), F.lit(""))
    return F.when(text.rlike(WHOLE_NUMBER), digits.try_cast("bigint"))


def _whole_from_number(number: Column) -> Column:
    return F.when(F.floor(number.cast("double")) == number.cast("double"), number.try_cast("bigint"))


def _variant_reader(item: Column, name: str) -> _Reader:
    path = '$["' + name.replace('"', '\\"') + '"]'
    found = F.try_variant_get(item, path, "variant")
    kind = F.coalesce(F.schema_of_variant(found), F.lit("VOID"))
    text = F.when(kind == "STRING", F.try_variant_get(item, path, "string"))
    number = F.when(
        kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.try_variant_get(item, path, "double")
    )
    whole = (
        F.when(kind == "BIGINT", F.try_variant_get(item, path, "bigint"))
        .when(kind == "BOOLEAN", F.try_variant_get(item, path, "boolean").cast("bigint"))
        .when(kind == "STRING", _whole_from_text(text))
        .otherwise(_whole_from_number(number))
    )
    return _Reader(kind == "VOID", text, whole)


def _check(name: str, rule: dict, reader: _Reader, strict_dates: bool) -> CheckedField:
    kind = rule.get("type", "str")
    value = reader.whole if kind == "int" else reader.text
    given = ~reader.missing
    limits: list[tuple[Column, str]] = []
    if kind == "int":
        wrong_type = "not an integer"
        if "ge" in rule:
            limits.append((value >= rule["ge"], f"below {rule['ge']}"))
        if "le" in rule:
            limits.append((value <= rule["le"], f"above {rule['le']}"))
    elif kind == "enum":
        wrong_type = "not one of the listed values"
        limits.append((value.isin(enum_values(rule)), wrong_type))
    else:
        wrong_type = "not a string"
        lengths = {"min_length": 1} if kind == "date" else rule
        if "min_length" in lengths:
            fits = F.char_length(value) >= lengths["min_length"]
            limits.append((fits, f"shorter than {lengths['min_length']}"))
        if "max_length" in lengths:
            fits = F.char_length(value) <= lengths["max_length"]
            limits.append((fits, f"longer than {lengths['max_length']}"))
        if kind == "date" and strict_dates:
            limits.append((value.try_cast("date").isNotNull(), "not a date"))

    fine = value.isNotNull()
    for within, _ in limits:
        fine = fine & within
    broken = [(given & value.isNull(), f"{name}: {wrong_type}")]
    broken += [(F.coalesce(~within, F.lit(False)), f"{name}: {message}") for within, message in limits]
    if rule.get("optional"):
        fine = reader.missing | fine
    else:
        broken.insert(0, (reader.missing, f"{name}: required"))
    return CheckedField(name, value.alias(name), fine, broken)


def _all_fine(checks: list[CheckedField]) -> Column:
    return reduce(lambda both, check: both & check.fine, checks, F.lit(True))


def error_list(checks: list[CheckedField]) -> Column:
    """Messages of the broken rules in field order; empty for a valid row."""
    messages = [F.when(condition, F.lit(text)) for check in checks for condition, text in check.broken]
    if not messages:
        return F.array().cast("array<string>")
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def valid_records(source: DataFrame, fields: dict, keep: list[str], **options) -> DataFrame:
    """Rows that pass, coerced and cut down to ``keep`` and the spec's fields."""
    checks = compile_fields(fields, source, **options)
    kept = [F.col(f"`{name}`") for name in keep if name not in fields]
    return source.filter(_all_fine(checks)).select(*kept, *[check.value for check in checks])


def invalid_records(source: DataFrame, fields: dict, position: str, **options) -> DataFrame:
    """``(position, record_json, errors)`` of the rows that fail."""
    checks = compile_fields(fields, source, **options)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in source.columns]), {"ignoreNullFields": "false"})
    return source.filter(~F.coalesce(_all_fine(checks), F.lit(False))).select(
        F.col(f"`{position}`"), record.alias("record_json"), error_list(checks).alias("errors")
    )


def validation_counts(source: DataFrame, fields: dict, **options) -> DataFrame:
    """One row ``(valid, errors)``."""
    fine = _all_fine(compile_fields(fields, source, **options))
    passed = F.count_if(fine)
    return source.agg(passed.alias("valid"), (F.count(F.lit(1)) - passed).alias("errors"))


def field_coverage(source: DataFrame, fields: list[str]) -> DataFrame:
    """Share of rows with a filled value, long form ``(field, coverage)``; one scan for all fields."""
    types = dict(source.dtypes)
    shares = [
        F.round(F.coalesce(F.avg(_filled(name, types).cast("double")), F.lit(0.0)), 4).alias(f"c{i}")
        for i, name in enumerate(fields)
    ]
    named = [F.struct(F.lit(name).alias("field"), F.col(f"c{i}").alias("coverage")) for i, name in enumerate(fields)]
    return source.agg(*shares).select(F.inline(F.array(*named)))


def _filled(name: str, types: dict[str, str]) -> Column:
    return is_filled(F.col(f"`{name}`"), types[name]) if name in types else F.lit(False)


def harvest(responses: DataFrame, batch: str, raw: str) -> DataFrame:
    """Records inside raw response texts: ``(batch, item_no, _item)``.

    An object yields the first wrapper key that holds an array, else itself; an array yields
    its items; anything else, and text that is not JSON, yields nothing.
    """
    body = F.try_parse_json(raw)
    parsed = responses.select(F.col(batch), body.alias("_body"))

    def array_at(path: str) -> Column:
        return F.try_variant_get("_body", path, "array<variant>")

    wrapped = [array_at(f"$.{key}") for key in WRAPPER_KEYS]
    alone = F.when(F.schema_of_variant("_body").startswith("OBJECT"), F.array("_body"))
    found = F.coalesce(array_at("$"), *wrapped, alone)
    return parsed.select(F.col(batch), F.posexplode(found).alias("item_no", ITEM))


def harvest_valid(responses: DataFrame, batch: str, raw: str, fields: dict, **options) -> DataFrame:
    """Valid harvested records, coerced: ``(batch, item_no, fields...)``."""
    items = harvest(responses, batch, raw)
    checks = compile_variant_fields(fields, **options)
    is_record = F.schema_of_variant(ITEM).startswith("OBJECT")
    return items.filter(is_record & _all_fine(checks)).select(
        F.col(batch), "item_no", *[check.value for check in checks]
    )


def first_records(records: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` records in arrival order, which is what was asked of the model.

    The cut is found from histograms of the order columns, so no sort and no single task sees them all.
    """
    written = stage(records, "records")
    return written.filter(first_k(written, order, n))


def generated_records(responses: DataFrame, batch: str, raw: str, fields: dict, n: int) -> DataFrame:
    """The first ``n`` valid records of a generation run; a shortfall is logged, not hidden."""
    records = first_records(harvest_valid(responses, batch, raw, fields), [batch, "item_no"], n)
    got = records.count()
    if got < n:
        log.warning("only %d of %d records were generated", got, n)
    return records
