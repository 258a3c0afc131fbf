"""Sinks: named views, persisted models and cached tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

PERSISTED_MODELS = ("stg_daily_usage", "int_cohort_health", "fct_cohort_churn", "fct_account_features")


def register_model(model: DataFrame, name: str) -> DataFrame:
    """Give ``model`` a name that later SQL can use."""
    model.createOrReplaceTempView(name)
    return model.sparkSession.table(name)


def write_results(
    results: Mapping[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
) -> dict[str, str]:
    """Write each frame to ``folder/name``; returns the paths."""
    paths = {}
    for name, frame in results.items():
        writer = frame.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        keys = list(partition_by)
        if keys:
            writer = writer.partitionBy(*keys)
        paths[name] = f"{folder}/{name}"
        writer.save(paths[name])
    return paths


def store(model: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a model as Parquet and go on from the stored rows."""
    write_results({name: model}, folder)
    return load_model_table(model.sparkSession, folder, name)


def store_bucketed(
    model: DataFrame, folder: str, name: str, key: str, order: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Write a model as Parquet in buckets of ``key``, one sorted file each, and go on from the stored rows.

    Joins, aggregates and windows on ``key`` read such a table without an exchange. The bucket layout is known
    to this session's catalog; other sessions read the same files as plain Parquet. ``buckets`` defaults to the
    number of shuffle partitions: choose it so that a bucket is some hundred megabytes.
    """
    spark = model.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"usagetide_{name}_{uuid.uuid4().hex}"
    placed = model.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(key, *order)
    # A fresh folder: rows of an earlier run are never half replaced.
    writer.option("path", f"{folder}/{name}-{uuid.uuid4().hex}").saveAsTable(table)
    return spark.table(table)


def observed(model: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``model`` with metrics that are computed while it is written, in the same pass."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return model.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


# ---------------------------------------------------------- publication

_MANIFEST = "version long, run string, published timestamp, name string, path string, format string"


def _manifest(spark: SparkSession, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest") if there else None


def publish_results(results: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write all results to a folder of their own, then commit them together by one row each in a manifest.

    The manifest rows are one file, which appears at once or not at all. A reader sees the last committed version;
    a failure on the way leaves the one before as it was. Old versions stay until they are removed by hand.
    """
    spark = next(iter(results.values())).sparkSession
    run = uuid.uuid4().hex
    paths = write_results(results, f"{folder}/versions/{run}", fmt)
    known = _manifest(spark, folder)
    last = None if known is None else known.agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    rows = spark.createDataFrame([(version, run, n, p, fmt) for n, p in paths.items()], "version long, run string, name string, path string, format string")
    stamped = rows.withColumn("published", F.current_timestamp()).select("version", "run", "published", "name", "path", "format")
    stamped.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return paths


def published_paths(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, tuple[str, str]]:
    """Path and format of every result of a committed version, the last by default.

    Of two runs that committed the same version number at once, the one with the smaller run name counts.
    """
    known = _manifest(spark, folder)
    rows = [] if known is None else known.collect()
    wanted = max((r.version for r in rows), default=None) if version is None else version
    mine = [r for r in rows if r.version == wanted]
    if not mine:
        raise FileNotFoundError(f"no committed version {'' if version is None else version} in {folder}")
    run = min(r.run for r in mine)
    return {r.name: (r.path, r.format) for r in mine if r.run == run}


def published(spark: SparkSession, folder: str, name: str, version: int | None = None, schema=None) -> DataFrame:
    """One result of a committed version. CSV needs the schema."""
    path, fmt = published_paths(spark, folder, version)[name]
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.load(path)


def row_counts(models: Mapping[str, DataFrame], persisted: Iterable[str] = PERSISTED_MODELS) -> DataFrame:
    """One row per model: name, whether it is stored, and its row count."""
    persisted = set(persisted)
    report = None
    for name, model in models.items():
        row = model.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), F.lit(name in persisted).alias("persisted"), "row_count"
        )
        report = row if report is None else report.unionByName(row)
    return report


def cache_model(model: DataFrame) -> DataFrame:
    """Keep a model for repeated reads; blocks spill to disk when memory is short."""
    return model.persist(StorageLevel.MEMORY_AND_DISK)


def load_model_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")
