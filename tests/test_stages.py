"""Every stage: construction by keyword, accessors, save and load, copies."""

import inspect

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

import tablewright.api as api
from tablewright.base import StageBase, unused_name
from tests.conftest import values

STAGES = sorted((c for _, c in inspect.getmembers(api, inspect.isclass) if issubclass(c, StageBase)),
                key=lambda c: c.__name__)


@pytest.mark.parametrize("kind", STAGES, ids=lambda c: c.__name__)
def test_save_and_load(spark, tmp_path, kind):
    stage = kind()
    for p in stage.params:
        cap = p.name[0].upper() + p.name[1:]
        assert hasattr(stage, "set" + cap) and hasattr(stage, "get" + cap), p.name
    path = str(tmp_path / "s")
    stage.save(path)
    stage.write().overwrite().save(path)
    again = kind.load(path)
    assert again.uid == stage.uid and type(again) is kind
    assert {p.name: again.getOrDefault(p) for p in again.params if again.isDefined(p)} == {
        p.name: stage.getOrDefault(p) for p in stage.params if stage.isDefined(p)}
    assert stage.copy().uid == stage.uid
    with pytest.raises(TypeError):
        kind(nothing=1)


def test_a_pipeline_of_own_and_spark_stages(spark, tmp_path):
    from pyspark.ml.feature import Binarizer
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "x double, s string")
    pipeline = Pipeline(stages=[
        api.CleanMissingData(inputCols=["x"], outputCols=["x"]), Binarizer(threshold=1.5, inputCol="x", outputCol="b"),
        api.ValueIndexer(inputCol="s", outputCol="i"), api.ClassBalancer(inputCol="s"),
        api.AssembleFeatures(columnsToFeaturize=["x", "i"], featuresCol="f")])
    model = pipeline.fit(df)
    out = model.transform(df)
    assert out.columns == ["x", "s", "b", "i", "weight", "f"]
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert values(again.transform(df)) == values(out)
    extra = api.RenameColumn(inputCol="x", outputCol="y").transform(df, {})
    assert extra.columns == ["y", "s"]


def test_fitted_stages_run_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(float(i) if i % 3 else None, "ab"[i % 2], f"word{i % 4} the") for i in range(40)],
                               "x double, s string, t string")
    df.write.parquet(str(tmp_path / "in"))
    image = api.to_vector(F.array(F.col("x"), F.col("x") * 2))
    model = Pipeline(stages=[
        api.CleanMissingData(inputCols=["x"], outputCols=["x"]), api.ValueIndexer(inputCol="s", outputCol="i"),
        api.TextPreprocessor(inputCol="t", outputCol="t2", map={"word1": "one"}),
        api.DataConversion(col="i", convertTo="double"),
        api.AssembleFeatures(columnsToFeaturize=["x", "s", "t2"], featuresCol="f", numberOfFeatures=64),
        api.UDFTransformer(inputCols=["x"], outputCol="v", udf=lambda x: image),
        api.BatchScorer(inputCol="v", outputCol="y", outputNodeIndex=0, model=api.dense_model(
            [{"name": "d", "weights": [[1.0, 1.0]]}]))]).fit(df)
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = api.run_to_table(model.transform(stream), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert values(out.select("x", "i", "t2", "f", "y")) == values(model.transform(df).select("x", "i", "t2", "f", "y"))


def test_unused_names():
    assert unused_name("a", {"b"}) == "a" and unused_name("a", {"a", "a_2"}) == "a_3"
