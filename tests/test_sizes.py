"""The ways for large inputs give what the ways for small ones give."""

import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadstream.operators import metrics, missing, splits
from roadstream.operators.missing import exact_medians
from roadstream.operators.sizes import dimension_join, prefix_sum


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_with_a_large_dimension(spark, how):
    """Half of the rows on one key, and some without one."""
    key = F.when(F.col("id") % 2 == 0, 3).when(F.col("id") % 7 != 0, F.col("id") % 97)
    fact = spark.range(300).select(key.cast("bigint").alias("key"), "id")
    dimension = spark.range(60).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
    expected = rows(dimension_join(fact, dimension, "key", how))
    large = dimension_join(fact, dimension, "key", how, limit=20)
    assert rows(large) == expected
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        dimension_join(spark.range(1), spark.range(1), "id", "full")


def test_prefix_sum(spark):
    df = spark.range(500).select(
        (F.col("id") * 389 % 500).alias("at"),
        F.when(F.col("id") < 400, "hot").otherwise("other").alias("g"),
        (F.col("id") % 11).alias("v"),
    )
    expected = rows(prefix_sum(df, ["g"], ["at"], "v", "before"))
    assert rows(prefix_sum(df, ["g"], ["at"], "v", "before", limit=40)) == expected
    total = prefix_sum(df, [], ["at"], "v", "before", limit=40).agg(F.max("before"))
    whole = prefix_sum(df, [], ["at"], "v", "before").agg(F.max("before"))
    assert rows(total) == rows(whole)


@pytest.mark.parametrize("n", [1, 2, 999, 1000])
def test_medians_by_refinement(spark, n):
    df = spark.range(n).select(
        (F.col("id") * 7919 % 1009 / 7).alias("spread"),
        F.when(F.col("id") % 3 == 0, F.pow(F.lit(1.01), F.col("id"))).alias("gaps"),
        F.when(F.col("id") < n * 0.7, 5.0).otherwise(F.col("id").cast("double")).alias("ties"),
        F.lit(None).cast("double").alias("empty"),
    )
    names = ["spread", "gaps", "ties", "empty"]
    small, large = exact_medians(df, names), exact_medians(df, names, limit=0)
    local = df.toPandas()
    for c in names[:3]:
        expected = statistics.median(local[c].dropna())
        assert small[c] == pytest.approx(expected)
        assert large[c] == pytest.approx(expected)
    assert small["empty"] is None and large["empty"] is None


def test_medians_do_not_need_a_good_first_range(spark, monkeypatch):
    monkeypatch.setattr(missing, "ACCURACY", 8)
    monkeypatch.setattr(missing, "BINS", 3)
    df = spark.range(2000).select(F.exp(F.col("id") % 701 / 10).alias("v"))
    expected = exact_medians(df, ["v"])
    assert exact_medians(df, ["v"], limit=0)["v"] == pytest.approx(expected["v"], rel=1e-15)


def test_positional_split_of_many_segments(traffic):
    expected = rows(splits.positional_split(traffic.readings, plan=traffic.plan))
    plan = traffic.plan
    large = splits.positional_split(traffic.readings, plan=type(plan)(plan.rows, 15, 10**6), limit=4)
    assert rows(large) == expected


def test_auc_of_many_scores(spark):
    df = spark.range(400).select(
        (F.col("id") % 4).cast("int").alias("label"),
        F.array(*[((F.col("id") * (k + 3) * 31 % 53) / 53.0) for k in range(4)]).alias("scores"),
    )
    assert rows(metrics.auc_ovr_weighted(df, limit=20)) == rows(metrics.auc_ovr_weighted(df))
