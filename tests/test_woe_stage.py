"""The WoE stage alone, in pipelines, in cross-validation, and saved."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from riskframe.operators.woe import WoETransformer
from riskframe.operators.woe_stage import WoEEncoder, WoEEncoderModel
from riskframe.session import scratch_path
from test_training import people

FEATURES = ["age", "income", "kind"]


@pytest.fixture(scope="module")
def table(spark):
    return people(spark, 600, 3).cache()


def rows(df, *names):
    return sorted(map(tuple, df.select("key", *[F.round(n, 9) for n in names]).collect()))


def test_equals_the_transformer(table):
    model = WoEEncoder(inputCols=FEATURES, labelCol="y", ivThreshold=0.0).fit(table)
    plain = WoETransformer("y", iv_threshold=0.0, exclude_cols=("key",)).fit(table)
    assert model.selectedFeatures == plain.get_selected_features() and set(model.selectedFeatures) == set(FEATURES)
    names = [f"{f}_woe" for f in model.selectedFeatures]
    assert rows(model.transform(table), *names) == rows(plain.encode(table), *names)
    assert sorted(map(tuple, model.ivSummary.collect())) == sorted(map(tuple, plain.get_iv_summary().collect()))
    assert model.transform(table.drop("y")).columns == [*table.drop("y").columns, *names]


def test_parameters_select(table):
    encoder = WoEEncoder(inputCols=FEATURES, labelCol="y", topK=1, ivThreshold=0.0)
    first = encoder.fit(table).selectedFeatures
    assert len(first) == 1 and encoder.copy({encoder.topK: 2}).fit(table).selectedFeatures[:1] == first
    assert encoder.setIvThreshold(1e9).fit(table).selectedFeatures == []
    with pytest.raises(ValueError):
        encoder.copy({encoder.outputCol: "v"}).fit(table).transform(table)
    assert WoEEncoder(labelCol="y").fit(table.drop("key")).selectedFeatures


def test_saved_and_loaded(spark, table):
    path = scratch_path(spark, "stage")
    encoder = WoEEncoder(inputCols=FEATURES, labelCol="y", suffix="_w", bins=5)
    encoder.write().overwrite().save(f"{path}/encoder")
    again = WoEEncoder.load(f"{path}/encoder")
    assert again.uid == encoder.uid and again.getBins() == 5 and again.getInputCols() == FEATURES and again.getLabelCol() == "y"
    model = encoder.fit(table)
    model.write().overwrite().save(f"{path}/model")
    back = WoEEncoderModel.load(f"{path}/model")
    names = [f"{f}_w" for f in model.selectedFeatures]
    assert back.uid == model.uid and back.getSuffix() == "_w" and rows(back.transform(table), *names) == rows(model.transform(table), *names)


def test_in_a_pipeline(spark, table):
    stages = [WoEEncoder(inputCols=FEATURES, labelCol="y", outputCol="features"), LogisticRegression(labelCol="y")]
    fitted = Pipeline(stages=stages).fit(table)
    path = scratch_path(spark, "pipeline")
    fitted.write().overwrite().save(path)
    back = PipelineModel.load(path)
    assert isinstance(back.stages[0], WoEEncoderModel)
    one, two = (sorted((r.key, round(float(r.probability[1]), 9)) for r in m.transform(table).collect()) for m in (fitted, back))
    assert one == two
    Pipeline(stages=stages).write().overwrite().save(f"{path}/unfitted")
    assert Pipeline.load(f"{path}/unfitted").getStages()[0].getInputCols() == FEATURES


def test_in_cross_validation(spark, table):
    """Folds are encoded by what their own training rows show; bins are a parameter of the search."""
    encoder = WoEEncoder(inputCols=FEATURES, labelCol="y", outputCol="features", ivThreshold=0.0)
    pipeline = Pipeline(stages=[encoder, LogisticRegression(labelCol="y")])
    grid = ParamGridBuilder().addGrid(encoder.bins, [2, 8]).build()
    search = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="y"), numFolds=2, seed=3)
    found = search.fit(table)
    assert len(found.avgMetrics) == 2 and all(0.5 < m < 1 for m in found.avgMetrics)
    best = found.bestModel.stages[0]
    assert best.getBins() == [2, 8][found.avgMetrics.index(max(found.avgMetrics))]
    path = scratch_path(spark, "search")
    found.write().overwrite().save(path)
    back = CrossValidatorModel.load(path)
    assert back.bestModel.stages[0].getBins() == best.getBins() and back.avgMetrics == pytest.approx(found.avgMetrics)
