"""Columns, sampling, cleaning, conversion, text replacement, functions."""

import datetime

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tablewright.operators.apply import ColumnFunction, MultiColumnAdapter, UDFTransformer
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.cleaning import CleanMissingData, CleanMissingDataModel, drop_missing
from tablewright.operators.columns import DropColumns, RenameColumn, Repartition, SelectColumns
from tablewright.operators.convert import DataConversion
from tablewright.operators.sampling import PartitionSample, exact_sample, hash_split, k_fold
from tablewright.operators.text_replace import TextPreprocessor, replace_words
from tests.conftest import values

NAN = float("nan")


@pytest.fixture(scope="module")
def basic(spark):
    return spark.createDataFrame(
        [(7, 0.25, "oak", "moss", 40, False), (8, 1.5, "elm", "fern", 50, True),
         (12, 3.25, "ash", "ivy", 61, False)],
        "plot int, width double, tree string, below string, height bigint, felled boolean")


def test_select_drop_rename(basic):
    assert SelectColumns(cols=["tree", "plot"]).transform(basic).columns == ["tree", "plot"]
    assert DropColumns(cols=["tree", "below"]).transform(basic).columns == [
        "plot", "width", "height", "felled"]
    assert RenameColumn(inputCol="tree", outputCol="w").transform(basic).columns[2] == "w"
    for stage in (SelectColumns(cols=["nope"]), DropColumns(cols=["nope", "tree"])):
        with pytest.raises(ValueError, match="nope"):
            stage.transform(basic)


def test_repartition(spark):
    df = spark.range(0, 100, 1, 4)
    assert Repartition(n=2).transform(df).rdd.getNumPartitions() == 2
    assert Repartition(n=9).transform(df).rdd.getNumPartitions() == 9
    assert Repartition(n=2, disable=True).transform(df).rdd.getNumPartitions() == 4
    assert "Exchange" not in Repartition(n=2).transform(df)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        Repartition(n=0)


def test_random_samples(spark):
    df = spark.range(160)
    assert 61 < PartitionSample(percent=0.5, seed=1).transform(df).count() < 99
    assert 1 <= PartitionSample(rsMode="Absolute", count=10, seed=5).transform(df).count() <= 25
    assert PartitionSample(mode="Head", count=7).transform(df).count() == 7
    with pytest.raises(ValueError):
        PartitionSample(mode="Nothing").transform(df)
    first = values(exact_sample(df, ["id"], 20, seed=1))
    assert len(first) == 20 and first == values(exact_sample(df.repartition(5), ["id"], 20, seed=1))


def test_splits_cover_the_table(spark):
    df = spark.range(1000)
    parts = hash_split(df, ["id"], [3, 1], seed=4)
    assert sorted(r[0] for p in parts for r in p.collect()) == list(range(1000))
    assert 180 < parts[1].count() < 320


def test_folds_split_copies_of_one_row(spark):
    """Most rows are the same; without keys they still spread over the folds."""
    df = spark.createDataFrame([(1,)] * 600 + [(i,) for i in range(300)], "v int")
    pairs = k_fold(df, 3, seed=3)
    sizes = [v.count() for _, v in pairs]
    assert sum(sizes) == 900 and all(200 < s < 400 for s in sizes)
    for training, validation in pairs:
        assert training.count() + validation.count() == 900


# visits to a clinic; of one only the row is known
CLEAN = [(3, 41, 61.5, None, 2), (None, 35, 70.25, 1.75, 1), (5, None, 82.0, 1.8, None),
         (8, 29, None, 1.62, 4), (None, None, None, None, None), (2, 57, 59.75, 1.7, 4),
         (11, 33, 90.5, None, 3)]
CLEAN_SCHEMA = "visits int, age int, weight double, height double, grade int"


@pytest.mark.parametrize("mode", ["Mean", "Median"])
def test_impute_learned(spark, mode):
    df = spark.createDataFrame(CLEAN, CLEAN_SCHEMA)
    names = df.columns
    model = CleanMissingData(inputCols=names, outputCols=names, cleaningMode=mode).fit(df)
    for i, name in enumerate(names):
        known = sorted(r[i] for r in CLEAN if r[i] is not None)
        want = sum(known) / len(known) if mode == "Mean" else known[(len(known) - 1) // 2]
        assert model.replacements[i] == pytest.approx(want)
    out = model.transform(df)
    assert out.dtypes == df.dtypes
    for got, row in zip(out.collect(), CLEAN):
        for i, v in enumerate(row):
            if v is None:
                want = model.replacements[i]
                assert got[i] == (int(want) if i in (0, 1, 4) else pytest.approx(want))
            else:
                assert got[i] == v


def test_impute_to_new_columns_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (3.0,), (None,)], "a double")
    model = CleanMissingData(inputCols=["a"], outputCols=["b"]).fit(df)
    assert [r["b"] for r in model.transform(df).collect()] == [1.0, 2.0, 3.0, 2.0]


def test_impute_custom_by_type(spark):
    for kind, value, filled in (("int", "7", 7), ("string", "x", "x"), ("boolean", "true", True),
                                ("double", "1.5", 1.5)):
        df = spark.createDataFrame([(None,)], f"a {kind}")
        model = CleanMissingData(inputCols=["a"], outputCols=["a"], cleaningMode="Custom",
                                 customValue=value).fit(df)
        assert model.transform(df).first()[0] == filled
    with pytest.raises(TypeError):
        CleanMissingData(inputCols=["a"], outputCols=["a"]).fit(
            spark.createDataFrame([("x",)], "a string"))


def test_imputer_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    est = CleanMissingData(inputCols=["a"], outputCols=["a"], cleaningMode="Median")
    est.write().overwrite().save(str(tmp_path / "e"))
    assert CleanMissingData.load(str(tmp_path / "e")).getCleaningMode() == "Median"
    model = est.fit(df)
    model.save(str(tmp_path / "m"))
    again = CleanMissingDataModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid and values(again.transform(df)) == values(model.transform(df))


def test_drop_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert values(drop_missing(df, ["x"])) == [(1.0, "a"), (2.0, None)]
    assert values(drop_missing(df, ["x", "s"])) == [(1.0, "a")]


# two rows that fit every type, one that wraps around in the narrow ones
NUMBERS = [(False, 6, 20, 31, 45, 2.25, 3.75, "52", "61.5"), (True, -40, 77, -88, 90, -1.5, 0.75, "-13", "-99.9"),
           (True, -100, 1000, 70000, 2 ** 33 + 5, 130.5, -7.25, "300", "-129.5")]
NUMBER_SCHEMA = ("flag boolean, tiny tinyint, small smallint, whole int, wide bigint, single float, "
                 "precise double, wholetext string, parttext string")


@pytest.mark.parametrize("target,third", [
    ("byte", (1, -100, -24, 112, 5, -126, -7, 44, 127)),
    ("short", (1, -100, 1000, 4464, 5, 130, -7, 300, -129)),
    ("integer", (1, -100, 1000, 70000, 5, 130, -7, 300, -129)),
    ("long", (1, -100, 1000, 70000, 2 ** 33 + 5, 130, -7, 300, -129)),
])
def test_convert_numbers(spark, target, third):
    df = spark.createDataFrame(NUMBERS, NUMBER_SCHEMA)
    out = DataConversion(col=",".join(df.columns), convertTo=target).transform(df)
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (0, 6, 20, 31, 45, 2, 3, 52, 61)
    assert rows[1] == (1, -40, 77, -88, 90, -1, 0, -13, -99)
    assert rows[2] == third


def test_convert_edges(spark):
    df = spark.createDataFrame([(1e20, "x", NAN), (-1e20, "", None)], "a double, s string, n double")
    out = DataConversion(col="a, s, n", convertTo="integer").transform(df).collect()
    assert [tuple(r) for r in out] == [(2 ** 31 - 1, None, 0), (-2 ** 31, None, None)]
    assert DataConversion(col="a", convertTo="long").transform(df).first()[0] == 2 ** 63 - 1
    with pytest.raises(TypeError):
        DataConversion(col="s", convertTo="boolean").transform(df)
    with pytest.raises(ValueError):
        DataConversion(col="nope", convertTo="long").transform(df)


def test_convert_times(spark):
    texts = ["2003-02-28 23:59:59.250", "1999-12-31 00:00:00.001", "2020-02-29 06:07:08.900"]
    form = "yyyy-MM-dd HH:mm:ss.SSS"
    df = spark.createDataFrame([(t,) for t in texts], "moment string")
    moments = DataConversion(col="moment", convertTo="date", dateTimeFormat=form).transform(df)
    back = DataConversion(col="moment", convertTo="string", dateTimeFormat=form).transform(moments)
    assert [r[0] for r in back.collect()] == texts
    longs = DataConversion(col="moment", convertTo="long").transform(moments)
    want = [int(datetime.datetime.fromisoformat(t + "000+00:00").timestamp() * 1000 + 0.5) for t in texts]
    assert [r[0] for r in longs.collect()] == want
    assert values(DataConversion(col="moment", convertTo="date").transform(longs)) == values(moments)
    with pytest.raises(TypeError):
        DataConversion(col="moment", convertTo="double").transform(moments)


MAP = {"river": "stream", "bridge": "ford", "stream": "creek", "stream bed": "valley"}


def test_replace_words(spark):
    df = spark.createDataFrame([("A river by the stream met a ford",), ("Old bridge over stream bed here",),
                                ("none",), ("my bridge",), ("",), ("streamer\nriverside_9 stream",), (None,)],
                               "place string")
    out = TextPreprocessor(inputCol="place", outputCol="w", map=MAP).transform(df)
    assert [r["w"] for r in out.collect()] == [
        "A stream by the creek met a ford", "Old ford over valley here", "none", "my ford", "",
        "creek\nstream creek", None]


def test_replace_words_normalized(spark):
    df = spark.createDataFrame([("RIVER Stream bridge É",)], "t string")
    got = df.select(replace_words(F.col("t"), MAP, "lowerCase"), replace_words(F.col("t"), MAP, "upperCase"),
                    replace_words(F.col("t"), MAP), replace_words(F.col("t"), {"é": "e"}, "lowerCase"),
                    replace_words(F.col("t"), {})).first()
    assert tuple(got) == ("stream creek ford É", "stream creek ford É", "RIVER Stream ford É",
                          "RIVER Stream bridge e", "RIVER Stream bridge É")


def test_replace_words_special_characters_and_long_text(spark):
    text = "a.b*c " * 50_000 + "[x]"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(replace_words(F.col("t"), {"[x]": "!", "q": "r"})).first()[0]
    assert got == "a.b*c " * 50_000 + "!"
    assert df.select(replace_words(F.col("t"), {".b*": "_"})).first()[0] == "a_c " * 0 + (
        "a_ " * 50_000 + "[x]")


def test_user_functions(basic, tmp_path):
    stage = UDFTransformer(inputCols=["plot", "width"], outputCol="out", udf=lambda a, b: a + b)
    assert [r["out"] for r in stage.transform(basic).collect()] == [7.25, 9.5, 15.25]
    stage.save(str(tmp_path / "u"))
    assert values(UDFTransformer.load(str(tmp_path / "u")).transform(basic)) == values(stage.transform(basic))
    with pytest.raises(ValueError):
        UDFTransformer(inputCol="plot", inputCols=["plot"], outputCol="o", udf=lambda a: a)
    row_function = F.udf(lambda v: v + 1, "int")
    assert UDFTransformer(inputCol="plot", outputCol="o", udf=row_function).transform(
        basic).agg(F.sum("o")).first()[0] == 30
    assert ColumnFunction(function=lambda d: d.limit(1)).transform(basic).count() == 1


def test_many_columns(basic, tmp_path):
    adapter = MultiColumnAdapter(baseStage=ValueIndexer(), inputCols=["tree", "below"],
                                 outputCols=["w", "m"])
    out = adapter.fit(basic).transform(basic)
    assert values(out, "tree", "w", "m") == [("ash", 0, 1), ("elm", 1, 0), ("oak", 2, 2)]
    fused = MultiColumnAdapter(baseStage=StringIndexer(), inputCols=["tree", "below"],
                               outputCols=["w", "m"])
    assert len(fused.stages()) == 1 and fused.fit(basic).transform(basic).columns[-2:] == ["w", "m"]
    adapter.save(str(tmp_path / "a"))
    again = MultiColumnAdapter.load(str(tmp_path / "a"))
    assert values(again.fit(basic).transform(basic)) == values(out)
    with pytest.raises(ValueError):
        adapter.setParams(outputCols=["tree", "m"]).fit(basic)
    with pytest.raises(ValueError):
        MultiColumnAdapter(baseStage=SelectColumns(cols=["a"]))


