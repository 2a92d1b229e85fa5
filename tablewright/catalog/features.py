"""Queries F: assembly, text features."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.catalog.common import embedding_images, query, table
from tablewright.functions.images import to_image_struct
from tablewright.operators.apply import get_value_at
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.featurize import (
    AssembleFeatures, Featurize, fast_vector_assemble, text_tokens,
)
from tablewright.operators.text import (
    TextFeaturizer, document_frequencies, ngrams, remove_stop_words, term_counts, tf_idf, tokenize,
    word_vectors,
)


def _slots(df, keys, vector, count, names=None):
    return df.select(*keys, *[get_value_at(vector, i).alias(names[i] if names else f"s{i}")
                              for i in range(count)])


@query("f1_featurize", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS s0, p_retailprice AS s1, p_retailprice AS t0 FROM part""")
def f1_featurize(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = Featurize(featureColumns={"both": ["p_size", "p_retailprice"], "one": ["p_retailprice"]}
                    ).fit(df).transform(df)
    return out.select("p_partkey", get_value_at("both", 0).alias("s0"),
                      get_value_at("both", 1).alias("s1"), get_value_at("one", 0).alias("t0"))


@query("f2_assemble_numbers", """
SELECT l_orderkey, l_linenumber, l_quantity AS s0, l_discount AS s1, CAST(l_suppkey AS DOUBLE) AS s2
FROM (SELECT *, row_number() OVER () FROM lineitem) WHERE l_returnflag <> 'R'""")
def f2_assemble_numbers(spark, sf):
    """Rows with a missing input drop out: the quantity of returned items is missing here."""
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("q"), "l_discount", "l_suppkey")
    model = AssembleFeatures(columnsToFeaturize=["q", "l_discount", "l_suppkey"]).fit(df)
    return _slots(model.transform(df), ["l_orderkey", "l_linenumber"], "features", 3)


@query("f3_timestamp_features", """
SELECT event_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS ms, CAST(year(ts) AS DOUBLE) AS year,
       CAST(isodow(ts) AS DOUBLE) AS weekday, CAST(month(ts) AS DOUBLE) AS month,
       CAST(day(ts) AS DOUBLE) AS day, CAST(hour(ts) AS DOUBLE) AS hour,
       CAST(minute(ts) AS DOUBLE) AS minute, CAST(floor(second(ts)) AS DOUBLE) AS second FROM events""")
def f3_timestamp_features(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts")
    out = AssembleFeatures(columnsToFeaturize=["ts"]).fit(df).transform(df)
    return _slots(out, ["event_id"], "features", 8,
                  ["ms", "year", "weekday", "month", "day", "hour", "minute", "second"])


@query("f3_date_features", """
SELECT o_orderkey, CAST(epoch_ms(o_orderdate) AS DOUBLE) AS ms, CAST(year(o_orderdate) AS DOUBLE) AS year,
       CAST(isodow(o_orderdate) AS DOUBLE) AS weekday, CAST(month(o_orderdate) AS DOUBLE) AS month,
       CAST(day(o_orderdate) AS DOUBLE) AS day FROM orders""")
def f3_date_features(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    out = AssembleFeatures(columnsToFeaturize=["d"]).fit(df).transform(df)
    return _slots(out, ["o_orderkey"], "features", 5, ["ms", "year", "weekday", "month", "day"])


WORDS_SQL = r"""words AS (SELECT doc_id, unnest(string_split_regex(
    regexp_replace(lower(text), '\s+$', ''), '\s')) AS term FROM documents)"""


@query("f4_word_counts", f"""WITH {WORDS_SQL}
SELECT term, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS documents
FROM words GROUP BY term""")
def f4_word_counts(spark, sf):
    counts = term_counts(table(spark, sf, "documents"), "doc_id", text_tokens([F.col("text")]))
    return counts.groupBy("term").agg(F.sum("tf").cast("long").alias("n"),
                                      F.count(F.lit(1)).alias("documents"))


@query("f4_hashed_words", f"""WITH {WORDS_SQL}
SELECT doc_id, CAST(count(*) AS DOUBLE) AS words FROM words GROUP BY doc_id""")
def f4_hashed_words(spark, sf):
    """No word is lost by keeping only the used slots."""
    df = table(spark, sf, "documents").select("doc_id", "text")
    out = AssembleFeatures(columnsToFeaturize=["text"], numberOfFeatures=4096).fit(df).transform(df)
    return out.select("doc_id", F.aggregate(vector_to_array("features"), F.lit(0.0),
                                            lambda a, v: a + v).alias("words"))


_CODED = """WITH coded AS (SELECT c_custkey, c_acctbal,
    dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS i FROM customer)"""


def _coded(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return ValueIndexer(inputCol="c_mktsegment", outputCol="segment").fit(df).transform(df)


@query("f5_indicator_slots", _CODED + """
SELECT c_custkey, CAST(i = 0 AS DOUBLE) AS s0, CAST(i = 1 AS DOUBLE) AS s1,
       CAST(i = 2 AS DOUBLE) AS s2, CAST(i = 3 AS DOUBLE) AS s3, c_acctbal AS s4 FROM coded""")
def f5_indicator_slots(spark, sf):
    df = _coded(spark, sf)
    model = AssembleFeatures(columnsToFeaturize=["c_acctbal", "segment"]).fit(df)
    return _slots(model.transform(df), ["c_custkey"], "features", 5)


@query("f5_index_slots", _CODED + """
SELECT c_custkey, CAST(i AS DOUBLE) AS s0, c_acctbal AS s1 FROM coded""")
def f5_index_slots(spark, sf):
    df = _coded(spark, sf)
    model = AssembleFeatures(columnsToFeaturize=["c_acctbal", "segment"],
                             oneHotEncodeCategoricals=False).fit(df)
    return _slots(model.transform(df), ["c_custkey"], "features", 2)


@query("f6_fast_assemble", """
SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS s0, s_acctbal AS s1 FROM supplier""")
def f6_fast_assemble(spark, sf):
    df = table(spark, sf, "supplier")
    return _slots(fast_vector_assemble(df, ["s_nationkey", "s_acctbal"], "v"), ["s_suppkey"], "v", 2)


@query("f7_image_features", """
WITH img AS (SELECT vec_id, flatten([[v, 255 - v, (v * 7) % 256] for v in
       [((CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) % 256) + 256) % 256 for x in embedding]]) AS px
     FROM embeddings)
SELECT vec_id, CAST(8 AS DOUBLE) AS height, CAST(8 AS DOUBLE) AS width,
       CAST(list_sum([CASE WHEN p > 127 THEN p - 256 ELSE p END for p in px]) AS DOUBLE) AS bytes FROM img""")
def f7_image_features(spark, sf):
    df = embedding_images(spark, sf).select("vec_id", to_image_struct(
        F.col("vec_id").cast("string"), F.col("image")).alias("image"))
    out = AssembleFeatures(columnsToFeaturize=["image"], allowImages=True).fit(df).transform(df)
    values = vector_to_array("features")
    return out.select("vec_id", values[0].alias("height"), values[1].alias("width"),
                      F.aggregate(F.slice(values, 3, 192), F.lit(0.0), lambda a, v: a + v).alias("bytes"))


STOP = ["the", "le", "la", "un", "der", "die", "de", "du", "el", "y", "and", "on"]


@query("f8_text_featurizer")
def f8_text_featurizer(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    model = TextFeaturizer(inputCol="text", outputCol="v", useStopWordsRemover=True,
                           defaultStopWordLanguage="custom", stopWords=",".join(STOP),
                           useNGram=True, nGramLength=2).fit(df)
    values = F.unwrap_udt("v")["values"]
    return model.transform(df).select(
        "doc_id", F.size(values).alias("slots"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6).alias("weight"))


TOKENS_SQL = r"""tokens AS (SELECT doc_id, [t for t in string_split_regex(
    regexp_replace(lower(text), '\s+$', ''), '\s+') if length(t) >= 2] AS t FROM documents)"""
_LIST = ", ".join(f"'{w}'" for w in STOP)


def _tokens(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tokenize(F.col("text"), min_length=2).alias("t"))


def _fingerprint(df, tokens):
    return df.select("doc_id", F.size(tokens).cast("long").alias("n"),
                     F.md5(F.array_join(tokens, "|")).alias("digest"))


@query("f9_tokenize", f"""WITH {TOKENS_SQL}
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest FROM tokens""")
def f9_tokenize(spark, sf):
    return _fingerprint(_tokens(spark, sf), F.col("t"))


@query("f9_tokenize_matches", r"""
WITH tokens AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest FROM tokens""")
def f9_tokenize_matches(spark, sf):
    df = table(spark, sf, "documents").select(
        "doc_id", tokenize(F.col("text"), pattern="[a-z]+", gaps=False).alias("t"))
    return _fingerprint(df, F.col("t"))


@query("f10_stop_words", f"""WITH {TOKENS_SQL},
kept AS (SELECT doc_id, [w for w in t if w NOT IN ({_LIST})] AS t FROM tokens)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest FROM kept""")
def f10_stop_words(spark, sf):
    return _fingerprint(_tokens(spark, sf), remove_stop_words(F.col("t"), STOP))


@query("f11_ngrams", f"""WITH {TOKENS_SQL},
grams AS (SELECT doc_id, [array_to_string(t[i:i + 2], ' ') for i in range(1, len(t) - 1)] AS t FROM tokens)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest FROM grams""")
def f11_ngrams(spark, sf):
    return _fingerprint(_tokens(spark, sf), ngrams(F.col("t"), 3))


@query("f12_hashing_tf", f"""WITH {TOKENS_SQL}
SELECT doc_id, CAST(len(t) AS DOUBLE) AS total FROM tokens""")
def f12_hashing_tf(spark, sf):
    out = HashingTF(inputCol="t", outputCol="v", numFeatures=1 << 18).transform(_tokens(spark, sf))
    return out.select("doc_id", F.aggregate(F.unwrap_udt("v")["values"], F.lit(0.0),
                                            lambda a, v: a + v).alias("total"))


@query("f12_term_frequency", f"""WITH {TOKENS_SQL},
words AS (SELECT doc_id, unnest(t) AS term FROM tokens),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term)
SELECT doc_id, CAST(count(*) AS BIGINT) AS terms, CAST(max(tf) AS DOUBLE) AS top,
       CAST(sum(tf) AS DOUBLE) AS total FROM counts GROUP BY doc_id""")
def f12_term_frequency(spark, sf):
    counts = term_counts(_tokens(spark, sf), "doc_id", F.col("t"))
    return counts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.max("tf").alias("top"),
                                        F.sum("tf").alias("total"))


IDF_SQL = f"""{TOKENS_SQL},
words AS (SELECT doc_id, unnest(t) AS term FROM tokens),
counts AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS tf FROM words GROUP BY doc_id, term),
idf AS (SELECT term, count(*) AS df,
        CASE WHEN count(*) >= 2 THEN ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0))
             ELSE 0.0 END AS idf FROM counts GROUP BY term)"""


@query("f13_inverse_document_frequency", f"""WITH {IDF_SQL}
SELECT term, CAST(df AS BIGINT) AS df, round(idf, 9) AS idf FROM idf""")
def f13_inverse_document_frequency(spark, sf):
    counts = term_counts(_tokens(spark, sf), "doc_id", F.col("t"))
    documents = table(spark, sf, "documents").count()
    return document_frequencies(counts, documents, min_doc_freq=2).withColumn(
        "idf", F.round("idf", 9))


@query("f13_tf_idf", f"""WITH {IDF_SQL}
SELECT doc_id, CAST(count(*) AS BIGINT) AS terms, round(sum(tf * idf), 6) AS weight
FROM counts JOIN idf USING (term) GROUP BY doc_id""")
def f13_tf_idf(spark, sf):
    weights = tf_idf(_tokens(spark, sf), "doc_id", F.col("t"), min_doc_freq=2)
    return weights.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"),
                                         F.round(F.sum("tfidf"), 6).alias("weight"))


@query("f14_word_vectors")
def f14_word_vectors(spark, sf):
    docs = _tokens(spark, sf)
    model = word_vectors(docs, "t", "v", vectorSize=8, minCount=5, seed=1, maxIter=1)
    return model.transform(docs).select("doc_id", vector_to_array("v").alias("v"))


