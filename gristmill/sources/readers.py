"""Readers: record files and tables."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATORS = {".csv": ",", ".tsv": "\t"}


def read_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Records of a ``.json``, ``.csv`` or ``.tsv`` file or folder.

    JSON is an array of records, or an object whose ``records`` key holds the array. A blank CSV cell
    is null. Without a schema CSV columns are strings, which validation then coerces.
    """
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix in SEPARATORS:
        reader = spark.read.option("header", True).option("sep", SEPARATORS[suffix])
        reader = reader.option("multiLine", True).option("escape", '"')
        return (reader.schema(schema) if schema else reader).csv(path)
    if suffix == ".json":
        return _read_json(spark, path, schema)
    raise ValueError(f"cannot read records from a {suffix or 'suffixless'} file")


def read_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """Each file of ``path`` as one raw text ``(_file, raw)``, for checks by JSON type."""
    files = spark.read.option("wholetext", True).text(path)
    return files.select(F.input_file_name().alias("_file"), F.col("value").alias("raw"))


def _read_json(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    found = spark.read.option("multiLine", True).json(path)
    wrapped = isinstance(found.schema["records"].dataType, T.ArrayType) if "records" in found.columns else False
    if wrapped:
        if schema:
            outer = T.StructType([T.StructField("records", T.ArrayType(schema))])
            found = spark.read.option("multiLine", True).schema(outer).json(path)
        return found.select(F.inline("records"))
    if schema:
        return spark.read.option("multiLine", True).schema(schema).json(path)
    return found


def read_table(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """A Parquet table.

    ``spread_by`` names a key to spread the rows by when the files give fewer pieces than there are
    cores (one small file), so that text work uses all of them. A table of many files is left as it is.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores, spread_by)
    return table


def seed_examples(records: DataFrame, position: str, n: int = 2) -> DataFrame:
    """The first examples, which go into prompts as models of style."""
    return records.orderBy(position).limit(n)
