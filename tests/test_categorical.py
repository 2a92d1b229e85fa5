"""Value indexing, class weights, ensembling, summaries, timing."""

import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablewright.functions import roles
from tablewright.operators import categorical as C
from tablewright.operators.balance import ClassBalancer, ClassBalancerModel
from tablewright.operators.categorical import IndexToValue, ValueIndexer, ValueIndexerModel
from tablewright.operators.columns import SelectColumns
from tablewright.operators.ensemble import EnsembleByKey
from tablewright.operators.profile import SummarizeData
from tablewright.operators.timing import Timer
from tests.conftest import values

NAN = float("nan")


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(
        [(17, 900, -2.5, False, "west"), (4, 31, 6.125, True, "east"), (4, 900, 6.125, True, "west")],
        "int int, long bigint, double double, bool boolean, string string")


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [("pine", 8, NAN), ("fir", None, 1.5), (None, 3, None), ("pine", 12, -6.0), ("yew", 3, 40.25)],
        "string string, int int, double double")


def index(df, name):
    return ValueIndexer(inputCol=name, outputCol=name + "_cat").fit(df).transform(df)


@pytest.mark.parametrize("name", ["int", "long", "double", "bool", "string"])
def test_there_and_back(plain, name):
    out = index(plain, name)
    info = roles.categorical_info(out.schema, name + "_cat")
    assert info["type"] == dict(plain.dtypes)[name] and info["count"] == 2 and not info["null_exists"]
    assert not roles.is_categorical(out.schema, name)
    back = IndexToValue(inputCol=name + "_cat", outputCol="b").transform(out)
    assert all(r[name] == r["b"] for r in back.collect())


def test_missing_slots(gaps):
    # levels: null, fir, pine, yew
    assert [r["string_cat"] for r in index(gaps, "string").collect()] == [1, 0, 3, 1, 2]
    assert [r["int_cat"] for r in index(gaps, "int").collect()] == [1, 3, 0, 2, 0]
    # NaN is a level of its own, but null and NaN both go to the null slot
    assert [r["double_cat"] for r in index(gaps, "double").collect()] == [4, 1, 4, 0, 2]
    back = IndexToValue(inputCol="double_cat", outputCol="b").transform(index(gaps, "double"))
    assert [r["b"] for r in back.collect()] == [None, 1.5, None, -6.0, 40.25]


def test_unseen_values(spark, plain, gaps):
    model = ValueIndexer(inputCol="string", outputCol="c").fit(plain)
    new = spark.createDataFrame([("north",), (None,), ("west",)], "string string")
    assert [r["c"] for r in model.transform(new).collect()] == [2, 2, 1]
    with_null = ValueIndexer(inputCol="string", outputCol="c").fit(gaps)
    assert [r["c"] for r in with_null.transform(new).collect()] == [4, 3, 4]
    with pytest.raises(Exception, match="levels"):
        IndexToValue(inputCol="c", outputCol="b").transform(model.transform(new)).collect()


def test_expression_join_and_table_agree(spark, monkeypatch, tmp_path):
    df = spark.range(500).select((F.col("id") % 97).alias("v")).union(
        spark.createDataFrame([(None,)], "v long"))
    by_join = ValueIndexer(inputCol="v", outputCol="i").fit(df)
    want = values(by_join.transform(df))
    monkeypatch.setattr(C, "EXPRESSION_LEVELS", 1000)
    assert values(by_join.transform(df)) == want
    monkeypatch.setattr(C, "KEPT_LEVELS", 10)
    in_table = ValueIndexer(inputCol="v", outputCol="i").fit(df)
    assert in_table.levels is None and in_table.tableCount == 97 and in_table.nullExists
    out = in_table.transform(df)
    assert values(out) == want and out.columns == ["v", "i"]
    back = IndexToValue(inputCol="i", outputCol="b").transform(out)
    assert all(r["v"] == r["b"] for r in back.collect())
    in_table.save(str(tmp_path / "m"))
    again = ValueIndexerModel.load(str(tmp_path / "m"))
    # the levels come from the saved model, also for the way back
    assert again.table_folder().endswith("/m/nested/levelTable")
    out = again.transform(df)
    assert values(out) == want
    assert roles.categorical_info(out.schema, "i")["table"] == again.table_folder()
    back = IndexToValue(inputCol="i", outputCol="b").transform(out)
    assert all(r["v"] == r["b"] for r in back.collect())


def test_unsupported_level_type(spark):
    with pytest.raises(TypeError):
        ValueIndexer(inputCol="v", outputCol="i").fit(spark.createDataFrame([([1],)], "v array<int>"))


def test_class_weights(spark, tmp_path):
    labels = [0.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0, 1.0, 0.0, 2.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)] + [(10, None)], "index int, label double")
    model = ClassBalancer(inputCol="label").fit(df)
    out = model.transform(df)
    assert out.columns == ["index", "label", "weight"] and out.count() == 10
    assert out.filter("index = 8").first()["weight"] == 2.5
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    shuffled = ClassBalancer(inputCol="label", broadcastJoin=False).fit(df)
    assert values(shuffled.transform(df)) == values(out)
    model.save(str(tmp_path / "m"))
    assert values(ClassBalancerModel.load(str(tmp_path / "m")).transform(df)) == values(out)


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [(5, "north", 2.0, 0.5, Vectors.dense(2.0, 0.5, 1.0)), (9, "south", -1.0, 3.0, Vectors.dense(-1.0, 3.0, 0.0)),
         (9, "south", 7.0, 1.0, Vectors.sparse(3, {0: 7.0, 2: 4.0}))],
        ["team", "place", "points", "fouls", "v1"])


def test_ensemble_scalars(scores):
    out = EnsembleByKey(keys=["team"], cols=["points"]).transform(scores)
    assert values(out) == [(5, 2.0), (9, 3.0)] and out.columns[1] == "mean(points)"


def test_ensemble_vectors(spark, scores, monkeypatch):
    from tablewright.operators import ensemble
    stage = EnsembleByKey(keys=["team", "place"], cols=["points", "v1"], colNames=["s", "v"])
    want = [(5, "north", 2.0, [2.0, 0.5, 1.0]), (9, "south", 3.0, [3.0, 1.5, 2.0])]

    def rows(df):
        return sorted((r[0], r[1], r["s"], r["v"].toArray().tolist()) for r in df.collect())
    assert rows(stage.transform(scores)) == want
    monkeypatch.setattr(ensemble, "WIDE_DIMS", 1)
    assert rows(stage.transform(scores)) == want
    with_null = scores.withColumn("v1", F.when(F.col("points") != -1.0, F.col("v1")))
    got = EnsembleByKey(keys=["team"], cols=["v1"]).transform(with_null)
    assert {r[0]: r[1].toArray().tolist() for r in got.collect()} == {5: [2.0, 0.5, 1.0], 9: [7.0, 0.0, 4.0]}


def test_ensemble_back(scores):
    out = EnsembleByKey(keys=["team"], cols=["points"], colNames=["points"],
                        collapseGroup=False).transform(scores)
    assert values(out, "team", "points", "fouls") == [(5, 2.0, 0.5), (9, 3.0, 1.0), (9, 3.0, 3.0)]
    with pytest.raises(TypeError):
        EnsembleByKey(keys=["team"], cols=["place"]).transform(scores)
    with pytest.raises(ValueError):
        EnsembleByKey(strategy="max")


def test_summary_of_mixed_columns(spark):
    df = spark.createDataFrame(
        [(40, NAN, "reed", None, False), (41, 6.0, "flute", 9, None), (42, 8.5, None, 3, False)],
        "numbers int, doubles double, words string, longs bigint, booleans boolean")
    rows = {r["Feature"]: r.asDict() for r in SummarizeData().transform(df).collect()}
    assert list(rows) and set(rows) == set(df.columns)
    assert (rows["doubles"]["Count"], rows["doubles"]["Missing Value Count"]) == (2.0, 1.0)
    assert rows["words"]["Count"] == 2.0 and math.isnan(rows["words"]["Median"])
    assert (rows["numbers"]["Min"], rows["numbers"]["Median"], rows["numbers"]["Max"]) == (40.0, 41.0, 42.0)
    assert rows["numbers"]["Sample Variance"] == 1.0 and rows["doubles"]["Max"] == 8.5
    assert rows["booleans"]["Unique Value Count"] == 1.0
    for groups in ({"counts": True}, {"basic": True}, {"sample": True}, {"percentiles": True}, {}):
        stage = SummarizeData(**{g: groups.get(g, False) for g in ("counts", "basic", "sample", "percentiles")})
        assert stage.transform(df).columns == ["Feature"] + stage.output_fields()


def test_summary_is_the_same_for_any_layout(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").drop("o_orderdate")
    one = values(SummarizeData(sample=False).transform(df.coalesce(1)))
    many = values(SummarizeData(sample=False).transform(df.repartition(8)))
    assert [[str(c) for c in r] for r in one] == [[str(c) for c in r] for r in many]


def test_summary_of_a_wide_table(spark):
    df = spark.range(20).select(*[(F.col("id") + i).cast("double").alias(f"c.{i}") for i in range(130)])
    out = SummarizeData().transform(df)
    got = {r["Feature"]: (r["Min"], r["Max"], r["Count"]) for r in out.collect()}
    assert got == {f"c.{i}": (float(i), 19.0 + i, 20.0) for i in range(130)}


def test_timer_reports_counts(spark, scores):
    timer = Timer(stage=SelectColumns(cols=["points"]), disableMaterialization=False)
    assert timer.transform(scores).count() == 3
    assert (timer.lastReport["rows_in"], timer.lastReport["rows_out"]) == (3, 3)
    fitted = Timer(stage=ClassBalancer(inputCol="team")).fit(scores)
    assert fitted.transform(scores).columns[-1] == "weight"


@pytest.mark.parametrize("dims", [2, 600])
def test_vectors_of_other_lengths_are_an_error(spark, dims):
    from pyspark.ml.linalg import Vectors
    rows = [("a", Vectors.dense([1.0] * dims)), ("a", Vectors.dense([3.0] * dims)), ("b", None)]
    df = spark.createDataFrame(rows, ["k", "v"])
    stage = EnsembleByKey(keys=["k"], cols=["v"])
    means = {r["k"]: r["mean(v)"] for r in stage.transform(df).collect()}
    assert means["a"].toArray().tolist() == [2.0] * dims and means["b"] is None
    mixed = df.union(spark.createDataFrame([("a", Vectors.dense([1.0] * (dims + 1)))], df.schema))
    with pytest.raises(Exception, match="need"):
        EnsembleByKey(keys=["k"], cols=["v"], vectorDims={"v": dims}).transform(mixed).collect()
