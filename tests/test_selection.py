import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from usagetide.functions import selection


def values_of(seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: 10 ** rng.uniform(-300, 300), lambda: float(rng.randrange(3)), lambda: -(10 ** rng.uniform(-12, 12))]
    kind = kinds[seed % 4]
    return [None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else kind() for _ in range(rng.randrange(1, 300))]


@pytest.mark.parametrize("seed", range(8))
def test_quantiles_equal_duckdb(spark, seed):
    rows = [(k % 3 != 0, v) for k, v in enumerate(values_of(seed))]
    df = spark.createDataFrame(rows, "g boolean, x double").repartition(3)
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r[0]: list(r)[1:] for r in selection.exact_quantiles(df, "x", ps, ["g"]).collect()}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (g BOOLEAN, x DOUBLE)")
    connection.executemany("INSERT INTO t VALUES (?, ?)", [(g, x) for g, x in rows if x is not None and not math.isnan(x)] or [(None, None)])
    want = dict(connection.execute(f"SELECT g, quantile_cont(x, {ps}) FROM t WHERE g IS NOT NULL GROUP BY g").fetchall())
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)


def test_most_rows_share_a_value(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 != 0, 7.0).otherwise(F.col("id") / 1e6).alias("x"))
    x = np.where(np.arange(20000) % 3 != 0, 7.0, np.arange(20000) / 1e6)
    ps = [0.01, 0.2, 0.3333, 0.5, 0.99]
    assert list(selection.exact_quantiles(df, "x", ps).first()) == pytest.approx(np.quantile(x, ps))


def test_infinite_and_empty(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (float("-inf"),)], "x double")
    assert selection.exact_quantiles(df, "x", [0.5]).first()[0] == 1.0
    assert selection.exact_quantiles(df.limit(0), "x", [0.5]).first()[0] is None
    assert selection.exact_quantiles(df.withColumn("g", F.lit(1)).limit(0), "x", [0.5], ["g"]).count() == 0


def test_no_sort_and_no_window(spark, monkeypatch):
    plans = []
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("x"))
    collect = type(df).collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(df), "collect", seen)
    row = selection.exact_quantiles(df, "x", [0.25, 0.5]).first()
    monkeypatch.undo()
    assert list(row) == [1249.75, 2499.5]
    assert 2 <= len(plans) <= 4 and not any("Sort" in p or "Window" in p for p in plans[:-1])
