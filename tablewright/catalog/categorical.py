"""Queries D and E1-E4: categoricals, class weights, ensembling."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablewright.catalog.common import joined, query, table
from tablewright.operators.balance import ClassBalancer
from tablewright.operators.categorical import IndexToValue, ValueIndexer, one_hot
from tablewright.operators.ensemble import EnsembleByKey
from tablewright.plans.ordering import dense_positions
from tablewright.plans.staging import stage_table


@query("d1_value_levels", """
SELECT level, row_number() OVER (ORDER BY level) - 1 AS position
FROM (SELECT DISTINCT p_brand AS level FROM part)""")
def d1_value_levels(spark, sf):
    return ValueIndexer(inputCol="p_brand", outputCol="i").fit(
        table(spark, sf, "part")).level_table(spark)


@query("d1_many_levels", """
SELECT level, row_number() OVER (ORDER BY level) - 1 AS position
FROM (SELECT DISTINCT o_totalprice AS level FROM orders)""")
def d1_many_levels(spark, sf):
    distinct = table(spark, sf, "orders").select(F.col("o_totalprice").alias("level")).distinct()
    return dense_positions(stage_table(distinct, "levels"), "level", "position")


@query("d2_value_index", """
WITH levels AS (
  SELECT level, row_number() OVER (ORDER BY level) - 1 AS position
  FROM (SELECT DISTINCT event_type AS level FROM events WHERE event_type NOT IN ('error', 'click')))
SELECT event_id, CAST(CASE WHEN e.event_type = 'error' THEN (SELECT count(*) FROM levels)
       ELSE coalesce(position, (SELECT count(*) FROM levels) + 1) END AS INTEGER) AS coded
FROM events e LEFT JOIN levels ON level = e.event_type""")
def d2_value_index(spark, sf):
    """Errors are null, and clicks are not seen when the levels are learned."""
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"))
    model = ValueIndexer(inputCol="kind", outputCol="coded").fit(
        e.filter(F.col("kind").isNull() | (F.col("kind") != "click")))
    return model.transform(e).select("event_id", "coded")


@query("d2_value_index_by_join", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS coded FROM orders""")
def d2_value_index_by_join(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ValueIndexer(inputCol="o_custkey", outputCol="coded").fit(df).transform(df).select(
        "o_orderkey", "coded")


@query("d2_many_levels", """
SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_orderkey * 8 + l_linenumber) - 1 AS INTEGER) AS coded
FROM lineitem""")
def d2_many_levels(spark, sf):
    """A level per line: beyond what column metadata keeps, the levels are a table."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (
        F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("line"))
    return ValueIndexer(inputCol="line", outputCol="coded").fit(df).transform(df).select(
        "l_orderkey", "l_linenumber", "coded")


@query("d3_index_to_value", """
SELECT c_custkey, c_mktsegment AS segment,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS coded FROM customer""")
def d3_index_to_value(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    coded = ValueIndexer(inputCol="c_mktsegment", outputCol="coded").fit(df).transform(df)
    return IndexToValue(inputCol="coded", outputCol="segment").transform(coded).select(
        "c_custkey", "segment", "coded")


@query("d5_one_hot", """
WITH coded AS (SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS i FROM orders)
SELECT o_orderkey, array_to_string([CASE WHEN i = k THEN 1 ELSE 0 END for k in range(4)], ',') AS slots
FROM coded""")
def d5_one_hot(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    coded = ValueIndexer(inputCol="o_orderpriority", outputCol="coded").fit(df).transform(df)
    hot = one_hot(coded, {"coded": "hot"}, {"coded": 5})
    return hot.select("o_orderkey", joined(vector_to_array("hot")).alias("slots"))


@query("d6_class_weights", """
WITH counts AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
SELECT o_orderkey, o_orderstatus,
       round((SELECT max(n) FROM counts) / CAST(n AS DOUBLE), 9) AS weight
FROM orders JOIN counts USING (o_orderstatus)""")
def d6_class_weights(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return ClassBalancer(inputCol="o_orderstatus").fit(df).transform(df).withColumn(
        "weight", F.round("weight", 9))


@query("e4_shuffled_lookup", """
WITH counts AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT event_id, user_id, round((SELECT max(n) FROM counts) / CAST(n AS DOUBLE), 9) AS weight
FROM events JOIN counts USING (user_id)""")
def e4_shuffled_lookup(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id")
    return ClassBalancer(inputCol="user_id", broadcastJoin=False).fit(df).transform(df).withColumn(
        "weight", F.round("weight", 9))


@query("e1_ensemble_scalar", """
SELECT user_id, event_type, round(avg(value), 6) AS "mean(value)"
FROM events GROUP BY user_id, event_type""")
def e1_ensemble_scalar(spark, sf):
    return EnsembleByKey(keys=["user_id", "event_type"], cols=["value"]).transform(
        table(spark, sf, "events")).withColumn("mean(value)", F.round("mean(value)", 6))


@query("e2_ensemble_vector", """
SELECT label, CAST(i AS INTEGER) AS i, round(avg(CAST(embedding[i + 1] AS DOUBLE)), 9) AS mean
FROM embeddings, range(64) t(i) GROUP BY label, i""")
def e2_ensemble_vector(spark, sf):
    e = table(spark, sf, "embeddings").select("label", array_to_vector("embedding").alias("v"))
    means = EnsembleByKey(keys=["label"], cols=["v"], colNames=["mean"],
                          vectorDims={"v": 64}).transform(e)
    return means.select("label", F.posexplode(vector_to_array("mean")).alias("i", "mean")
                        ).withColumn("mean", F.round("mean", 9))


@query("e3_ensemble_back", """
SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id), 6) AS value FROM events""")
def e3_ensemble_back(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "value")
    return EnsembleByKey(keys=["user_id"], cols=["value"], colNames=["value"],
                         collapseGroup=False).transform(df).withColumn("value", F.round("value", 6))
