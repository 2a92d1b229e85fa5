"""Feature vectors, text features, images, batched scoring."""

import datetime
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.functions import images as K
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.featurize import (
    AssembleFeatures, AssembleFeaturesModel, Featurize, fast_vector_assemble, text_tokens,
)
from tablewright.operators.images import ImageSetAugmenter, ImageTransformer, UnrollImage
from tablewright.operators.scoring import BatchScorer, ImageFeaturizer, arg_max, dense_model
from tablewright.operators.text import (
    TextFeaturizer, TextFeaturizerModel, ngrams, remove_stop_words, tf_idf, tokenize, word_vectors,
)


def features(df, name="f"):
    return [r[name].toArray().tolist() for r in df.collect()]


def test_basic_types(spark):
    rows = [(5, 11, 0.125, False, 3, 7, -1.5), (6, 12, 2.5, True, 9, -6, 0.25), (7, -3, 1e3, True, 4, 127, 8.0)]
    df = spark.createDataFrame(rows, "key int, wide bigint, part double, flag boolean, whole int, "
                                     "tiny tinyint, single float")
    out = Featurize(featureColumns={"f": df.columns[1:]}).fit(df).transform(df)
    assert out.columns == df.columns + ["f"]
    assert features(out) == [[float(v) for v in r[1:]] for r in rows]


def test_vectors_keep_nan_inside(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(Vectors.sparse(4, {1: 3.0}), 2.5, 7, Vectors.dense(0.5, -4.0)),
         (Vectors.dense(6.0, nan, 0.0, 1.5), -1.0, 8, Vectors.dense(9.0, 2.0)), (None, 0.0, 3, None)],
        ["left", "part", "whole", "right"])
    got = features(AssembleFeatures(columnsToFeaturize=df.columns, featuresCol="f").fit(df).transform(df))
    assert got[0] == [0.0, 3.0, 0.0, 0.0, 2.5, 7.0, 0.5, -4.0]
    assert len(got) == 2 and math.isnan(got[1][1]) and len(got[1]) == 8


TEXTS = [(4, 9, 1.25, -0.5, "rain fell on the hills"), (7, 8, 0.0, 2.5, "snow fell in april"),
         (1, 6, 3.5, 0.75, "the hills stay dry in april")]


def test_text_slots(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, "id int, n int, x double, y double, note string")
    model = AssembleFeatures(columnsToFeaturize=["n", "x", "y", "note"], featuresCol="f").fit(df)
    got = features(model.transform(df))
    words = {w for r in TEXTS for w in r[4].split()}
    # words may share a hash slot, never more slots than words
    assert len(got[0]) == 3 + len(model.slots) and len(model.slots) <= len(words)
    for row, text in zip(got, TEXTS):
        assert row[:3] == [float(text[1]), text[2], text[3]] and sum(row[3:]) == len(text[4].split())
    assert model.slots == sorted(model.slots)
    model.save(str(tmp_path / "m"))
    assert features(AssembleFeaturesModel.load(str(tmp_path / "m")).transform(df)) == got
    # words that were not seen when fitting have no slot; a missing text counts as no words
    new = spark.createDataFrame([(0, 1, 1.0, 1.0, "zebra zebra fell"), (0, 1, 1.0, 1.0, None)], df.schema)
    assert [sum(r[3:]) for r in features(model.transform(new))] == [1.0, 0.0]
    # fitting again gives the same slots at any layout
    assert AssembleFeatures(columnsToFeaturize=["note"]).fit(df.repartition(5)).slots == model.slots


def test_text_tokens_follow_the_white_space(spark):
    df = spark.createDataFrame([(" A  b\t\nc \n", "x"), ("   ", "Y z"), (None, "")], "a string, b string")
    got = [r[0] for r in df.select(text_tokens([F.col("a"), F.col("b")])).collect()]
    assert got == [["", "a", "", "b", "", "c", "x"], ["y", "z"], []]


def test_dates_and_timestamps(spark):
    d, t = datetime.date(2017, 7, 7), datetime.datetime(1970, 1, 1, 0, 0, 1)
    df = spark.createDataFrame([(2, d, t)], "col1 int, date date, ts timestamp").withColumn(
        "ts", F.timestamp_seconds(F.lit(1)))
    out = AssembleFeatures(columnsToFeaturize=df.columns, featuresCol="f").fit(df).transform(df)
    assert features(out) == [[2.0, 1499385600000.0, 2017.0, 5.0, 7.0, 7.0,
                              1000.0, 1970.0, 4.0, 1.0, 1.0, 0.0, 0.0, 1.0]]


def test_categoricals(spark):
    rows = [(2, "dog", "cat"), (3, "cat", "dog"), (4, "dog", "bird"), (0, "bird", "cat")]
    df = spark.createDataFrame(rows, "col1 int, col4 string, col5 string")
    for name in ("col4", "col5"):
        df = ValueIndexer(inputCol=name, outputCol=name).fit(df).transform(df)
    hot = AssembleFeatures(columnsToFeaturize=df.columns, featuresCol="f").fit(df).transform(df)
    # bird 0, cat 1, dog 2; the last category is all zeros
    assert features(hot) == [[0, 0, 0, 1, 2], [0, 1, 0, 0, 3], [0, 0, 1, 0, 4], [1, 0, 0, 1, 0]]
    plain = AssembleFeatures(columnsToFeaturize=df.columns, featuresCol="f",
                             oneHotEncodeCategoricals=False).fit(df).transform(df)
    assert features(plain) == [[2, 1, 2], [1, 2, 3], [2, 0, 4], [0, 1, 0]]
    kept = plain.schema["f"].metadata["ml_attr"]
    assert kept["num_attrs"] == 3 and [a["idx"] for a in kept["attrs"]["nominal"]] == [0, 1]
    with pytest.raises(ValueError, match="must precede"):
        fast_vector_assemble(df, ["col1", "col4"], "v")


def test_unsupported_types(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    with pytest.raises(TypeError):
        AssembleFeatures(columnsToFeaturize=["a"]).fit(df)
    image = spark.range(1).select(K.to_image_struct(F.lit("p"), picture()).alias("image"))
    with pytest.raises(TypeError):
        AssembleFeatures(columnsToFeaturize=["image"]).fit(image)


SENTENCES = [(10, "Boats drift"), (11, "drift slowly past the harbor lights"),
             (12, "No wind, so boats stay inside the HARBOR!"), (13, "")]


def test_text_featurizer(spark, tmp_path):
    df = spark.createDataFrame(SENTENCES, "label int, sentence string")
    model = TextFeaturizer(inputCol="sentence", outputCol="features", numFeatures=20).fit(df)
    out = model.transform(df)
    assert out.columns == ["label", "sentence", "features"]
    weights = {round(w, 9) for r in out.collect() for w in r["features"].toArray() if w}
    assert any(math.isclose(w, math.log(5 / 2), abs_tol=1e-8) for w in weights)
    model.save(str(tmp_path / "m"))
    again = TextFeaturizerModel.load(str(tmp_path / "m")).transform(df)
    assert features(again, "features") == features(out, "features")
    full = TextFeaturizer(inputCol="sentence", outputCol="features", useStopWordsRemover=True, useNGram=True,
                          useIDF=False, binary=True, minTokenLength=1).fit(df).transform(df)
    assert full.columns == ["label", "sentence", "features"]
    with pytest.raises(TypeError, match="useTokenizer"):
        TextFeaturizer(inputCol="sentence", outputCol="f", useTokenizer=False).fit(df)
    tokens = df.select(F.split("sentence", " ").alias("t"))
    with pytest.raises(TypeError):
        TextFeaturizer(inputCol="t", outputCol="f").fit(tokens)
    assert TextFeaturizer(inputCol="t", outputCol="f", useTokenizer=False).fit(tokens).transform(
        tokens).count() == 4
    with pytest.raises(ValueError, match="taken"):
        TextFeaturizer(inputCol="sentence", outputCol="label").fit(df)


def test_exact_terms_follow_the_stages(spark):
    from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover
    df = spark.createDataFrame([(i, s) for i, s in SENTENCES] + [(14, "  two  leading"), (15, "tail  ")],
                               "label int, sentence string")
    for length in (0, 2):
        stage = RegexTokenizer(inputCol="sentence", outputCol="t", minTokenLength=length).transform(df)
        both = stage.select("t", tokenize(F.col("sentence"), min_length=length).alias("mine"))
        assert all(r["t"] == r["mine"] for r in both.collect()), length
    words = ["no", "the", "so"]
    clean = StopWordsRemover(inputCol="t", outputCol="c", stopWords=words).transform(stage)
    grams = NGram(inputCol="c", outputCol="g", n=2).transform(clean)
    both = grams.select("c", "g", remove_stop_words(F.col("t"), words).alias("mc"),
                        ngrams(F.col("c"), 2).alias("mg"))
    assert all(r["c"] == r["mc"] and r["g"] == r["mg"] for r in both.collect())


def test_tf_idf_with_a_term_in_most_rows(spark, monkeypatch):
    from tablewright.plans import lookup
    docs = [(i, ["common", f"w{i % 7}", "common"]) for i in range(300)]
    df = spark.createDataFrame(docs, "id int, t array<string>")

    def run():
        return sorted((r["id"], r["term"], round(r["tfidf"], 9)) for r in tf_idf(df, "id", F.col("t")).collect())
    want = sorted((i, t, round(t_count * math.log(301 / (n + 1)), 9)) for i, toks in docs for t, t_count, n in (
        ("common", 2, 300), (toks[1], 1, sum(d[1][1] == toks[1] for d in docs))))
    assert run() == want
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    assert run() == want


def test_word_vectors(spark):
    df = spark.createDataFrame([("a b c a b c".split(),)] * 20, "t array<string>")
    model = word_vectors(df, "t", "v", vectorSize=3, minCount=0, seed=42)
    assert model.findSynonyms("a", 2).count() == 2 and len(model.transform(df).first()["v"]) == 3


def test_word_vectors_of_a_large_table_train_in_partitions(spark, monkeypatch):
    """One partition trained on all words, whatever their number."""
    from tablewright.operators import text
    df = spark.createDataFrame([("a b c a b c".split(),)] + [("d e f".split(),)] * 20, "t array<string>")
    asked = []
    fit = text.Word2Vec.fit
    monkeypatch.setattr(text.Word2Vec, "fit", lambda self, rows: asked.append(self.getNumPartitions()) or fit(self, rows))
    monkeypatch.setattr(text, "PARTITION_WORDS", 20)
    model = word_vectors(df, "t", "v", vectorSize=3, minCount=0, seed=42)
    word_vectors(df, "t", "v", vectorSize=3, minCount=0, seed=42, numPartitions=2)
    assert asked == [4, 2] and model.getVectors().count() == 6


# ---- images ----

def picture(height=3, width=4, channels=3, start=0):
    pixels = [(start + i * 37) % 256 for i in range(height * width * channels)]
    return K.pixel_image(F.lit(height), F.lit(width), F.lit(channels), F.array(*[F.lit(p) for p in pixels]))


def as_array(row):
    return np.array(row["pixels"]).reshape(row["height"], row["width"], row["channels"])


def both(spark, stage, **shape):
    df = spark.range(1).select(picture(**shape).alias("image"))
    row = stage.setParams(inputCol="image", outputCol="out").transform(df).first()
    return as_array(row["image"]), as_array(row["out"])


def test_crop_flip_threshold_against_numpy(spark):
    a, b = both(spark, ImageTransformer().crop(1, 0, 2, 3))
    assert (b == a[0:2, 1:4]).all()
    for code, want in ((0, lambda a: a[::-1]), (1, lambda a: a[:, ::-1]), (-1, lambda a: a[::-1, ::-1])):
        a, b = both(spark, ImageTransformer().flip(code))
        assert (b == want(a)).all()
    a, b = both(spark, ImageTransformer().threshold(100.0, 255.0, K.BINARY))
    assert (b == np.where(a > 100, 255, 0)).all()
    a, b = both(spark, ImageTransformer().colorFormat(K.BGR_TO_RGB))
    assert (b == a[:, :, ::-1]).all()


def test_filters_against_numpy(spark):
    def mirrored(a, dy, dx):
        return np.pad(a, ((dy, dy), (dx, dx), (0, 0)), mode="reflect")
    a, b = both(spark, ImageTransformer().blur(3, 3), height=4, width=5)
    p = mirrored(a, 1, 1)
    want = sum(p[y:y + 4, x:x + 5] for y in range(3) for x in range(3)) / 9
    assert (b == np.rint(want)).all()
    a, b = both(spark, ImageTransformer().gaussianKernel(3, 1.0), height=4, width=5)
    w, p = K.gaussian_weights(3, 1.0), mirrored(a, 1, 0)
    assert (b == np.rint(sum(p[i:i + 4] * w[i] for i in range(3)))).all()
    assert sum(K.gaussian_weights(5, 0)) == 1.0


def test_resize_against_numpy(spark):
    for h, w in ((2, 2), (5, 9), (3, 4)):
        a, b = both(spark, ImageTransformer().resize(h, w))
        ys = np.clip((np.arange(h) + 0.5) * 3 / h - 0.5, 0, 2)
        xs = np.clip((np.arange(w) + 0.5) * 4 / w - 0.5, 0, 3)
        y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
        y1, x1 = np.minimum(y0 + 1, 2), np.minimum(x0 + 1, 3)
        fy, fx = (ys - y0)[:, None, None], (xs - x0)[None, :, None]
        want = ((1 - fy) * ((1 - fx) * a[y0][:, x0] + fx * a[y0][:, x1])
                + fy * ((1 - fx) * a[y1][:, x0] + fx * a[y1][:, x1]))
        assert np.abs(b - want).max() <= 0.5 + 1e-9


def test_image_rows_as_bytes(spark, tmp_path):
    image = K.to_image_struct(F.lit("p"), picture())
    df = spark.range(2).select(F.when(F.col("id") == 0, image).alias("image"))
    stage = ImageTransformer(inputCol="image", outputCol="out").flip(0).flip(0)
    rows = stage.transform(df).collect()
    assert rows[0]["out"] == rows[0]["image"] and rows[0]["out"]["type"] == 16
    assert rows[1]["out"] is None
    stage.save(str(tmp_path / "s"))
    assert ImageTransformer.load(str(tmp_path / "s")).getStages() == stage.getStages()
    every = spark.range(1).select(K.unsigned_bytes(K.to_bytes(F.sequence(F.lit(0), F.lit(255)))).alias("b"))
    assert every.first()["b"] == list(range(256))


def test_image_stage_errors(spark):
    for make in (lambda: ImageTransformer().resize(-1, 2), lambda: ImageTransformer().crop(-1, 0, 1, 1),
                 lambda: ImageTransformer(stages=[{"action": "melt"}])):
        with pytest.raises(ValueError):
            make()
    with pytest.raises(TypeError):
        ImageTransformer(inputCol="id").transform(spark.range(1))
    with pytest.raises(Exception, match="leaves the image"):
        both(spark, ImageTransformer().crop(3, 3, 3, 3))


def test_unroll_and_augment(spark):
    df = spark.range(2).select(F.when(F.col("id") == 0, picture()).alias("image"))
    rows = UnrollImage(inputCol="image", outputCol="v").transform(df).collect()
    assert rows[0]["v"].toArray().tolist() == as_array(rows[0]["image"]).transpose(2, 0, 1).ravel().tolist()
    assert rows[1]["v"] is None
    out = ImageSetAugmenter(inputCol="image", outputCol="a", flipUpDown=True).transform(df)
    assert out.count() == 6 and out.columns == ["image", "a"]
    same = ImageSetAugmenter(inputCol="image", outputCol="image").transform(df)
    assert same.count() == 4 and same.columns == ["image"]


MODEL = dense_model([
    {"name": "hidden", "weights": [[1, 0], [0, -1], [1, 1]], "bias": [0, 0, 1], "activation": "relu"},
    {"name": "out", "weights": [[1, 1, 1], [0, 0, 1]], "activation": "softmax"}], imageSize=[2, 2])


def test_batch_scorer(spark, tmp_path):
    df = spark.createDataFrame([([1.0, 2.0],), ([-1.0, -3.0],), (None,)], "x array<double>")
    scorer = BatchScorer(inputCol="x", outputCol="y", model=MODEL, outputNodeName="hidden", miniBatchSize=2)
    got = [r["y"].toArray().tolist() if r["y"] else None for r in scorer.transform(df).collect()]
    assert got == [[1.0, 0.0, 4.0], [0.0, 3.0, 0.0], None]
    vectors = df.filter("x is not null").select(array_to_vector("x").alias("x"))
    soft = BatchScorer(inputCol="x", outputCol="y", model=MODEL, outputNodeIndex=1).transform(vectors)
    assert all(math.isclose(r["y"].toArray().sum(), 1.0) for r in soft.collect())
    assert scorer.transform(df.limit(0)).count() == 0
    scorer.save(str(tmp_path / "s"))
    assert BatchScorer.load(str(tmp_path / "s")).getModel() == MODEL
    for bad in ({}, {"outputNodeName": "hidden", "outputNodeIndex": 1}, {"outputNodeName": "nope"},
                {"outputNodeIndex": 9}):
        with pytest.raises(ValueError):
            BatchScorer(inputCol="x", outputCol="y", model=MODEL, **bad).transform(df)
    with pytest.raises(TypeError):
        BatchScorer(inputCol="x", outputCol="y", model=MODEL, outputNodeIndex=1).transform(
            spark.createDataFrame([("a",)], "x string"))
    classes = vectors.sparkSession.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert classes.select(arg_max(F.col("s"))).first()[0] == 1


def test_image_featurizer(spark):
    model = dense_model([{"name": "h", "weights": np.eye(12).tolist()},
                         {"name": "out", "weights": [[1] * 12]}], imageSize=[2, 2])
    df = spark.range(1).select(picture(2, 2).alias("image"))
    stage = ImageFeaturizer(inputCol="image", outputCol="f", model=model)
    row = stage.transform(df).first()
    assert row["f"].toArray().tolist() == as_array(row["image"]).transpose(2, 0, 1).ravel().tolist()
    whole = stage.setCutOutputLayers(0).transform(df)
    assert whole.columns == ["image", "f"] and whole.first()["f"].toArray().tolist() == [float(sum(row["f"]))]
    with pytest.raises(ValueError):
        stage.setCutOutputLayers(-1)
