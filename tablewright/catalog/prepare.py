"""Queries B and C: projection, sampling, cleaning, conversion."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tablewright.catalog.common import query, table
from tablewright.operators.apply import (
    MultiColumnAdapter, UDFTransformer, get_value_at, to_vector,
)
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.cleaning import CleanMissingData, drop_missing
from tablewright.operators.columns import (
    DropColumns, RenameColumn, Repartition, SelectColumns, union_copies,
)
from tablewright.operators.convert import DataConversion
from tablewright.operators.sampling import (
    PartitionSample, assign_partition, exact_sample, hash_sample, hash_split, head, k_fold,
)
from tablewright.operators.text_replace import TextPreprocessor


@query("b1_select_columns", "SELECT l_extendedprice, l_orderkey, l_returnflag FROM lineitem")
def b1_select_columns(spark, sf):
    return SelectColumns(cols=["l_extendedprice", "l_orderkey", "l_returnflag"]).transform(
        table(spark, sf, "lineitem"))


@query("b2_drop_columns", "SELECT * EXCLUDE (o_orderdate, o_custkey) FROM orders")
def b2_drop_columns(spark, sf):
    return DropColumns(cols=["o_orderdate", "o_custkey"]).transform(table(spark, sf, "orders"))


@query("b3_rename_column", "SELECT * EXCLUDE (c_acctbal), c_acctbal AS balance FROM customer")
def b3_rename_column(spark, sf):
    return RenameColumn(inputCol="c_acctbal", outputCol="balance").transform(
        table(spark, sf, "customer"))


@query("b4_repartition", "SELECT p_partkey, p_name, p_retailprice FROM part")
def b4_repartition(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return Repartition(n=2).transform(Repartition(n=6).transform(df))


@query("b5_head", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 500")
def b5_head(spark, sf):
    return head(table(spark, sf, "events").select("event_id", "event_type", "value")
                .orderBy("event_id"), 500)


@query("b6_percentage_sample")
def b6_percentage_sample(spark, sf):
    return PartitionSample(mode="RandomSample", rsMode="Percentage", percent=0.1, seed=42).transform(
        table(spark, sf, "lineitem"))


@query("b6_keyed_sample", """
SELECT CAST(0 AS BIGINT) AS rows_outside_the_table, CAST(0 AS BIGINT) AS repeated_rows,
       count(*) > 0 AS share_in_bounds FROM events""")
def b6_keyed_sample(spark, sf):
    events = table(spark, sf, "events")
    picked = hash_sample(events, ["event_id"], 0.25, seed=3).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"))
    both = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("total")).join(
        picked, "event_id", "full")
    share = F.sum("n") / F.sum("total")
    return both.agg(
        F.count_if(F.col("total").isNull()).alias("rows_outside_the_table"),
        F.count_if(F.col("n") != F.col("total")).alias("repeated_rows"),
        ((share > 0.2) & (share < 0.3)).alias("share_in_bounds"))


@query("b7_absolute_sample")
def b7_absolute_sample(spark, sf):
    return PartitionSample(mode="RandomSample", rsMode="Absolute", count=1000, seed=42).transform(
        table(spark, sf, "lineitem"))


@query("b7_exact_sample", "SELECT CAST(least(1000, count(*)) AS BIGINT) AS picked FROM lineitem")
def b7_exact_sample(spark, sf):
    picked = exact_sample(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
                          ["l_orderkey", "l_linenumber"], 1000, seed=1)
    return picked.agg(F.count(F.lit(1)).alias("picked"))


@query("b8_assign_to_partition", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS outside,
       CAST(10 AS BIGINT) AS parts FROM orders GROUP BY o_orderstatus""")
def b8_assign_to_partition(spark, sf):
    out = assign_partition(table(spark, sf, "orders"), ["o_orderkey"], 10)
    return out.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("Partition").between(0, 9)).alias("outside"),
        F.count_distinct("Partition").alias("parts"))


@query("b8_assign_at_random")
def b8_assign_at_random(spark, sf):
    return PartitionSample(mode="AssignToPartition", numParts=10, seed=5).transform(
        table(spark, sf, "orders"))


@query("b9_train_test_split", """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders,
       CAST(0 AS BIGINT) AS in_both FROM orders""")
def b9_train_test_split(spark, sf):
    train, test = hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"],
                             [0.75, 0.25], seed=9)
    marked = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(2)))
    per_key = marked.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("part").alias("a"), F.max("part").alias("b"))
    return per_key.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("orders"),
                       F.count_if(F.col("a") != F.col("b")).alias("in_both"))


@query("b10_k_fold", """
SELECT CAST(f AS INTEGER) AS fold, CAST(count(*) AS BIGINT) AS total,
       CAST(count(DISTINCT c_custkey) AS BIGINT) AS customers
FROM customer, range(4) t(f) GROUP BY f""")
def b10_k_fold(spark, sf):
    out = None
    for i, (training, validation) in enumerate(
            k_fold(table(spark, sf, "customer").select("c_custkey"), 4, seed=2, keys=["c_custkey"])):
        part = training.unionByName(validation).withColumn("fold", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("fold").agg(F.count(F.lit(1)).alias("total"),
                                   F.count_distinct("c_custkey").alias("customers"))


@query("b11_union_of_copies", """
SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, lower(n_name) FROM nation""")
def b11_union_of_copies(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return union_copies(nation, nation.select(F.lower("n_name").alias("n_name"), "n_nationkey"))


# ---- C ----

GAPS_SQL = "gaps AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"


def _with_gaps(spark, sf):
    """Event values with the ones of errors missing, half of those as null, half as NaN."""
    e = table(spark, sf, "events")
    gone = F.when(F.col("user_id") % 2 == 0, F.lit(float("nan")))
    return e.select("event_id", F.when(F.col("event_type") != "error", F.col("value"))
                    .otherwise(gone).alias("v"))


@query("c1_impute_mean", f"""WITH {GAPS_SQL}
SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM gaps)), 6) AS v FROM gaps""")
def c1_impute_mean(spark, sf):
    df = _with_gaps(spark, sf)
    model = CleanMissingData(inputCols=["v"], outputCols=["v"]).fit(df)
    return model.transform(df).withColumn("v", F.round("v", 6))


@query("c1_impute_median", f"""WITH {GAPS_SQL}
SELECT event_id, coalesce(v, (SELECT quantile_disc(v, 0.5) FROM gaps)) AS filled FROM gaps""")
def c1_impute_median(spark, sf):
    df = _with_gaps(spark, sf)
    model = CleanMissingData(inputCols=["v"], outputCols=["filled"], cleaningMode="Median").fit(df)
    return model.transform(df).select("event_id", "filled")


@query("c1_impute_custom", f"""WITH {GAPS_SQL}
SELECT event_id, coalesce(v, -1.5) AS v FROM gaps""")
def c1_impute_custom(spark, sf):
    df = _with_gaps(spark, sf)
    return CleanMissingData(inputCols=["v"], outputCols=["v"], cleaningMode="Custom",
                            customValue="-1.5").fit(df).transform(df)


@query("c2_cast_numbers", """
SELECT l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
       CAST(((l_partkey + 128) % 256) - 128 AS TINYINT) AS l_partkey,
       CAST(((l_orderkey * 7 + 32768) % 65536) - 32768 AS SMALLINT) AS l_orderkey,
       CAST(l_quantity AS FLOAT) AS l_quantity, l_discount <> 0 AS l_discount FROM lineitem""")
def c2_cast_numbers(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_linenumber", "l_extendedprice", "l_partkey", (F.col("l_orderkey") * 7).alias("l_orderkey"),
        "l_quantity", "l_discount")
    for column, target in (("l_extendedprice", "integer"), ("l_partkey", "byte"),
                           ("l_orderkey", "short"), ("l_quantity", "float"),
                           ("l_discount", "boolean")):
        df = DataConversion(col=column, convertTo=target).transform(df)
    return df


@query("c2_cast_text", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS price, CAST(NULL AS DOUBLE) AS o_orderpriority,
       CAST(((CAST(trunc(o_totalprice) AS BIGINT) + 128) % 256) - 128 AS TINYINT) AS small FROM orders""")
def c2_cast_text(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                           "o_orderpriority", F.col("o_totalprice").alias("small"))
    df = DataConversion(col="price, small", convertTo="string").transform(df)
    df = DataConversion(col="price", convertTo="integer").transform(df)
    df = DataConversion(col="o_orderpriority", convertTo="double").transform(df)
    return DataConversion(col="small", convertTo="byte").transform(df)


@query("c3_timestamp_to_long", "SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events")
def c3_timestamp_to_long(spark, sf):
    return DataConversion(col="ts", convertTo="long").transform(
        table(spark, sf, "events").select("event_id", "ts"))


@query("c3_timestamp_to_text",
       "SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d %H:%M') AS o_orderdate FROM orders")
def c3_timestamp_to_text(spark, sf):
    return DataConversion(col="o_orderdate", convertTo="string",
                          dateTimeFormat="yyyy/MM/dd HH:mm").transform(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"))


@query("c4_text_and_long_to_timestamp", """
SELECT event_id, epoch_ms(date_trunc('second', ts)) AS from_text, epoch_us(ts) // 1000 AS from_long FROM events""")
def c4_text_and_long_to_timestamp(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("from_text"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("from_long"))
    moments = DataConversion(col="from_text, from_long", convertTo="date").transform(df)
    return DataConversion(col="from_text, from_long", convertTo="long").transform(moments)


@query("c5_to_and_from_categorical", """
SELECT o_orderkey, o_orderpriority AS before,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS coded,
       o_orderpriority AS after FROM orders""")
def c5_to_and_from_categorical(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("before"),
                                           F.col("o_orderpriority").alias("after"))
    coded = DataConversion(col="after", convertTo="toCategorical").transform(df)
    kept = coded.withColumn("coded", F.col("after"))
    return DataConversion(col="after", convertTo="clearCategorical").transform(kept)


@query("c6_drop_missing", f"WITH {GAPS_SQL} SELECT event_id, v FROM gaps WHERE v IS NOT NULL")
def c6_drop_missing(spark, sf):
    return drop_missing(_with_gaps(spark, sf), ["v"])


# replacements for words of the documents; some keys start others
WORDS = {"the": "THE", "ther": "<other>", "eau": "water", "le": "<article>", "an": "a",
         "on the": "<on>", "ente": "?"}
_KEYS = sorted(WORDS, key=lambda k: (-len(k), k))
_PIECES = "(?s)(" + "|".join(_KEYS) + r")[\p{L}\p{Nd}_]*|[^" + "".join(sorted({k[0] for k in WORDS})) + "]+|."
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in WORDS.items()) + "}"
_START = "^(?:" + "|".join(_KEYS) + ")"


@query("c7_replace_words", f"""
SELECT doc_id, array_to_string([coalesce({_MAP}[regexp_extract(p, '{_START}')], p)
       for p in regexp_extract_all(text, '{_PIECES}')], '') AS replaced FROM documents""")
def c7_replace_words(spark, sf):
    return TextPreprocessor(inputCol="text", outputCol="replaced", map=WORDS).transform(
        table(spark, sf, "documents")).select("doc_id", "replaced")


@query("c7_replace_words_any_case", f"""
SELECT conv_id, turn, array_to_string([coalesce({_MAP}[lower(regexp_extract(p, '(?i){_START}'))], p)
       for p in regexp_extract_all(text, '(?i){_PIECES}')], '') AS replaced FROM conversations""")
def c7_replace_words_any_case(spark, sf):
    return TextPreprocessor(inputCol="text", outputCol="replaced", map=WORDS,
                            normFunc="lowerCase").transform(
        table(spark, sf, "conversations")).select("conv_id", "turn", "replaced")


@query("c8_expression_function", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue FROM lineitem""")
def c8_expression_function(spark, sf):
    return UDFTransformer(inputCols=["l_extendedprice", "l_discount"], outputCol="revenue",
                          udf=lambda p, d: F.round(p * (1 - d), 4)).transform(
        table(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", "revenue")


@query("c8_pandas_function", """
SELECT p_partkey, CAST(length(p_name) + length(p_brand) AS BIGINT) AS size FROM part""")
def c8_pandas_function(spark, sf):
    @F.pandas_udf("long")
    def lengths(a: pd.Series, b: pd.Series) -> pd.Series:
        return a.str.len() + b.str.len()
    return UDFTransformer(inputCols=["p_name", "p_brand"], outputCol="size", udf=lengths).transform(
        table(spark, sf, "part")).select("p_partkey", "size")


@query("c9_many_columns", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS type FROM part""")
def c9_many_columns(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    adapter = MultiColumnAdapter(baseStage=ValueIndexer(), inputCols=["p_brand", "p_type"],
                                 outputCols=["brand", "type"])
    return adapter.fit(df).transform(df).select("p_partkey", "brand", "type")


@query("c10_vector_access", """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last
FROM embeddings""")
def c10_vector_access(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", to_vector("embedding").alias("v"))
    return v.select("vec_id", get_value_at("v", 0).alias("first"), get_value_at("v", 63).alias("last"))
