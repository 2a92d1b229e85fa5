"""Shared plan helpers: exact quantiles, total orders, lookups, staging."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Row
from pyspark.sql import functions as F

from tablewright.operators.sampling import exact_sample, head
from tablewright.plans import lookup, ordering, quantiles, staging
from tests.conftest import values

PROBABILITIES = [0.0, 0.005, 0.01, 0.25, 0.5, 0.75, 0.95, 0.995, 1.0]


def by_sorting(data, probabilities):
    clean = sorted(v for v in data if v is not None and v == v)
    return [clean[quantiles.target_rank(p, len(clean)) - 1] for p in probabilities]


@pytest.mark.parametrize("budget", [800_000, 300])
def test_exact_quantiles_on_skewed_values(spark, monkeypatch, budget):
    """Also with sketches far too small to be right at once."""
    rng = random.Random(4)
    data = [(rng.choice([7.0, rng.expovariate(0.01), rng.gauss(0, 1e6)]), float(rng.randrange(5)))
            for _ in range(20_000)] + [(None, float("nan"))] * 50
    if budget < 1000:
        monkeypatch.setattr(quantiles, "sketch_accuracy", lambda columns: 60)
    df = spark.createDataFrame(data, "a double, b double").repartition(7)
    got = quantiles.exact_quantiles(df, ["a", "b"], PROBABILITIES)
    assert got["a"] == by_sorting([d[0] for d in data], PROBABILITIES)
    assert got["b"] == by_sorting([d[1] for d in data], PROBABILITIES)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert quantiles.exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}


@pytest.mark.parametrize("kind", ["long", "string", "double"])
@pytest.mark.parametrize("one_range", [8, 4096])
def test_dense_positions(spark, monkeypatch, kind, one_range):
    monkeypatch.setattr(ordering, "ONE_RANGE_ROWS", one_range)
    monkeypatch.setattr(ordering, "SAMPLE_PER_RANGE", 1)
    df = spark.range(3000).select(((F.col("id") * 7919) % 3000).cast(kind).alias("v")).distinct()
    got = {r["v"]: r["p"] for r in ordering.dense_positions(df, "v", "p").collect()}
    want = {v: i for i, v in enumerate(sorted(got))}
    assert len(got) == 3000 and got == want


def test_running_totals_descending_with_null(spark):
    df = spark.createDataFrame([(3, 1), (None, 10), (1, 100), (2, 1000)], "v long, n long")
    out = ordering.running_totals(df, "v", {"n": "t"}, descending=True)
    assert {r["v"]: r["t"] for r in out.collect()} == {3: 1, 2: 1001, 1: 1101, None: 1111}


@pytest.mark.parametrize("small", [None, True, False])
def test_lookup_join_with_a_hot_key(spark, small):
    """One key holds a third of the rows; every way of joining gives the same."""
    big = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0)
                                     .otherwise(F.col("id")).alias("k"))
    table = big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("w", F.col("k") * 2)
    out = lookup.lookup_join(big, table, ["k"], "inner", count_col="n", small=small)
    assert out.columns == ["k", "id", "w"]
    row = out.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"),
                  F.count_if(F.col("w") != F.col("k") * 2).alias("wrong")).first()
    assert tuple(row) == (30_000, 30_000, 0)


def test_lookup_left_join_keeps_rows_without_a_key(spark):
    big = spark.range(9000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 40).alias("k"))
    table = big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k is null or k < 30").withColumn("w", F.lit(1))
    want = values(big.join(table.drop("n"), "k", "left"))
    for small in (True, False):
        assert values(lookup.lookup_join(big, table, ["k"], "left", count_col="n", small=small)) == want


def test_hot_keys_are_broadcast_and_the_rest_is_shuffled(spark):
    big = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0)
                                     .otherwise(F.col("id")).alias("k"))
    table = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup.lookup_join(big, table, ["k"], count_col="n", small=False)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_staged_table_keeps_schema_and_metadata(spark):
    df = spark.range(3).withMetadata("id", {"note": 1})
    staged = staging.stage_table(df, "t")
    assert staged.schema["id"].metadata == {"note": 1}
    assert values(staged) == [(0,), (1,), (2,)]
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_head_beyond_one_task(spark, monkeypatch):
    from tablewright.operators import sampling
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 10)
    df = spark.range(0, 1000, 1, 7)
    assert values(head(df, 500)) == sorted([(i,) for i in range(500)], key=repr)
    assert head(df, 5000).count() == 1000
    plan = head(df, 500)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Limit" not in plan
    with pytest.raises(ValueError):
        head(df, 3_000_000_000)


def test_exact_sample_beyond_one_task(spark, monkeypatch):
    from tablewright.operators import sampling
    df = spark.range(0, 3000, 1, 5).withColumn("v", F.lit("x"))
    want = values(exact_sample(df, ["id"], 700, seed=2))
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 10)
    assert values(exact_sample(df.repartition(3), ["id"], 700, seed=2)) == want and len(want) == 700
    assert exact_sample(df, ["id"], 5000).count() == 3000
    copies = spark.createDataFrame([(1,)] * 500 + [(2,)] * 20, "k int")
    assert exact_sample(copies, ["k"], 300).count() == 300


def test_quantiles_take_three_scans(spark):
    """A sketch, a count at the proposed values, a count between them: jobs, whatever the columns."""
    from tablewright.plans import quantiles
    rows = [(i, (i * 7919) % 10007 / 7.0, float(i % 13), None if i % 5 else float(i)) for i in range(60000)]
    df = spark.createDataFrame(rows, "a long, b double, c double, d double").repartition(4).cache()
    df.count()
    probabilities = [0.0, 0.005, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.995, 1.0]
    spark.sparkContext.setJobGroup("quantiles", "exact quantiles")
    found = quantiles.exact_quantiles(df, df.columns, probabilities)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    assert len(jobs) <= 6    # adaptive plans make a job of every shuffle
    for j, c in enumerate(df.columns):
        own = sorted(r[j] for r in rows if r[j] is not None)
        assert found[c] == [own[max(1, -(-int(round(p * 1000)) * len(own) // 1000)) - 1] for p in probabilities]


def test_quantiles_sketch_again_when_much_is_left(spark, monkeypatch):
    from tablewright.plans import quantiles
    monkeypatch.setattr(quantiles, "PROPOSAL_ACCURACY", 50)
    monkeypatch.setattr(quantiles, "GATHER", 100)
    values = [float((i * 7919) % 30011) for i in range(30011)]
    df = spark.createDataFrame([(v,) for v in values], "a double").repartition(3)
    assert quantiles.exact_quantiles(df, ["a"], [0.1, 0.5, 0.995]) == {"a": [3001.0, 15005.0, 29860.0]}


def test_lookup_is_bounded_by_bytes(spark, monkeypatch):
    """Few rows with wide values are not broadcast, and the join gives the same rows."""
    rows = [(f"k{i}", [float(i)] * 50, Vectors.dense([1.0] * 30), {"a": "bc"}, (i, "x"), 1000 if i else 5000) for i in range(20)]
    table = spark.createDataFrame([Row(k=r[0], v=r[1], w=r[2], m=r[3], s=Row(i=r[4][0], t=r[4][1]), n=r[5]) for r in rows])
    assert 20 * (50 + 30) * 8 < lookup.table_bytes(table) < 20 * (50 + 30) * 8 + 20 * 50 * 8
    big = spark.range(600).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 25)).alias("k"), "id")
    small = {how: sorted(map(str, lookup.lookup_join(big, table, ["k"], how, count_col="n").collect()))
             for how in ("inner", "left")}
    assert lookup.is_small(table)
    for bound in (10_000, 100):
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", bound)
        assert not lookup.is_small(table)
        for how, expected in small.items():
            joined = lookup.lookup_join(big, table, ["k"], how, count_col="n")
            assert sorted(map(str, joined.select("k", "id", "v", "w", "m", "s").collect())) == expected
    assert lookup.table_bytes(table.limit(0)) == 0
