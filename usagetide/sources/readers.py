"""Readers: explicit schema, no inference pass over the data."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path
from .schemas import SOURCES


def read_source(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "csv"
) -> DataFrame:
    """Read ``path`` as a typed relation. CSV has a header and needs a schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        raise ValueError("a CSV source needs an explicit schema")
    if fmt == "csv":
        # A bad field is an error, not a silent NULL.
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def read_dated(spark: SparkSession, path: str, like: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read a persisted model back with its date, timestamp and number types."""
    return read_source(spark, path, like, fmt)


def require_sources(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Open every named source, failing on the first that is missing."""
    opened = {}
    for name, path in paths.items():
        try:
            opened[name] = read_source(spark, path, SOURCES.get(name), fmt)
        except Exception as error:
            raise FileNotFoundError(f"source {name!r} cannot be read from {path}") from error
    return opened


class Sifted(NamedTuple):
    """Rows that fit a schema, and the others as text with a reason and their file."""

    good: DataFrame
    bad: DataFrame


RAW = "raw_record"


def _reason(schema: T.StructType) -> tuple[Column, Column]:
    """The fields of a raw record as text, and what is wrong with it: its number of fields, or the first field that is not of its type."""
    fields = schema.fields
    # One name more than there are fields shows a record that is too long.
    names = [f"c{k}" for k in range(len(fields) + 1)]
    as_text = F.from_csv(F.col(RAW), F.lit(", ".join(f"{n} string" for n in names)))
    reason = F.when(F.col("text.c0").isNull() & (F.length(F.trim(RAW)) == 0), F.lit("empty record"))
    reason = reason.when(F.col(f"text.{names[-1]}").isNotNull(), F.lit("too many fields"))
    for name, field in zip(names, fields):
        value = F.col(f"text.{name}")
        wrong = value.isNotNull() & (value != "") & value.try_cast(field.dataType).isNull()
        reason = reason.when(wrong, F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), value))
    return as_text, reason.otherwise(F.lit("too few fields"))


def sift_source(spark: SparkSession, path: str, schema: T.StructType) -> Sifted:
    """Read a CSV source and set rows aside that do not fit, instead of failing on the first.

    The header must name the columns of the schema in order; a file whose header differs is an error, as its
    rows would all be taken for something else. A row with a field of the wrong type, or with too many or too few
    fields, goes to ``bad`` as text with a reason and the file's name. The parsed rows are stored once, so counts of good and bad
    rows add up to the rows read, also if a file changes meanwhile.
    """
    wide = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    read = (
        spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RAW).csv(path)
    )
    stored = scratch_path(spark, "sifted")
    read.withColumn("source_file", F.input_file_name()).write.parquet(stored)
    rows = spark.read.parquet(stored)
    good = rows.where(F.col(RAW).isNull()).select(*[f.name for f in schema.fields])
    as_text, reason = _reason(schema)
    bad = rows.where(F.col(RAW).isNotNull()).withColumn("text", as_text)
    return Sifted(good, bad.select(F.col(RAW), reason.alias("reason"), "source_file"))


def sift_sources(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, Sifted]:
    """``sift_source`` for every named source, failing on the first that is missing or has another header."""
    opened = {}
    for name, path in paths.items():
        try:
            opened[name] = sift_source(spark, path, SOURCES[name])
        except Exception as error:
            raise FileNotFoundError(f"source {name!r} cannot be read from {path}") from error
    return opened
