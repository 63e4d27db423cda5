from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cohortloom import CohortSchema
from cohortloom.operators import model
from cohortloom.streaming import scoring

S = CohortSchema(
    id="id",
    label="level",
    labels=("Low", "Medium", "High"),
    number="age",
    category="sex",
    codes={1: "one", 2: "two"},
    ordinals=("a", "b"),
)
NOW = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def cohort(spark):
    base = spark.range(600).select(
        F.col("id").cast("string").alias("id"),
        (F.col("id") % 90).cast("int").alias("age"),
        (1 + F.col("id") % 2).cast("int").alias("sex"),
        (1 + F.col("id") % 9).cast("int").alias("a"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(9))).cast("int").alias("b"),
    )
    noisy = F.col("a") + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3))
    return base.withColumn("level", F.when(noisy <= 4, "Low").when(noisy <= 7, "Medium").otherwise("High"))


@pytest.fixture(scope="module")
def fitted(cohort):
    return model.fit(model.logistic(S.label, S.labels, S.features, max_iter=40), cohort, S.features)


def test_three_classes_in_alphabetical_order(fitted):
    assert model.fitted_labels(fitted) == ["High", "Low", "Medium"]
    assert model.fitted_features(fitted) == list(S.features)
    assert fitted.stages[-1].numClasses == 3


def test_undeclared_label_fails_the_fit(cohort):
    with pytest.raises(Exception):
        model.fit(model.logistic(S.label, ("Low", "High"), S.features, max_iter=2), cohort, S.features)


def test_every_row_is_scored_or_marked(cohort, fitted):
    holed = cohort.withColumn("a", F.when(F.col("id") != "7", F.col("a"))).drop("level")
    scored = model.score(holed, fitted, S.id, S.labels, "run", "v1", NOW)
    assert scored.count() == 600
    empty = scored.where("subject_id = '7'").first()
    assert (empty.predicted_label, empty.predicted_index, empty.probabilities) == (None, None, None)
    row = scored.where("subject_id = '8'").withColumn("keys", F.map_keys("probabilities")).first()
    assert row["keys"] == list(S.labels)
    assert sum(row.probabilities.values()) == pytest.approx(1, abs=2e-4)
    assert model.fitted_labels(fitted)[row.predicted_index] == row.predicted_label
    assert scored.select("prediction_id").distinct().count() == 600


def test_metrics_agree_with_the_evaluator(cohort, fitted):
    ours = model.evaluate(model.predict(fitted, cohort), S.label, "predicted_label", S.labels, digits=10).first()
    raw = fitted.transform(cohort)
    for name, theirs in (
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
        ("f1", "f1"),
    ):
        evaluator = MulticlassClassificationEvaluator(labelCol="label_index", metricName=theirs)
        assert ours[name] == pytest.approx(evaluator.evaluate(raw))
    assert ours.n == 600 and 0.5 < ours.accuracy < 1


def test_confusion_lists_empty_cells(spark):
    pred = spark.createDataFrame([("Low", "Low"), ("Low", "High"), ("Low", "Low")], "level string, p string")
    cells = {(row.actual, row.predicted): row.n for row in model.confusion(pred, "level", "p", S.labels).collect()}
    assert len(cells) == 9 and cells[("Low", "Low")] == 2 and cells[("Medium", "High")] == 0
    classes = {row.label: row for row in model.per_class(model.confusion(pred, "level", "p", S.labels)).collect()}
    assert classes["Low"].precision == 1.0 and classes["Low"].recall == pytest.approx(2 / 3)
    assert classes["Medium"].f1 == 0.0 and classes["High"].support == 0


def test_model_survives_a_roundtrip(cohort, fitted, tmp_path):
    model.save_model(fitted, str(tmp_path / "m"))
    loaded = model.load_model(str(tmp_path / "m"), S.labels)
    before = model.predict(fitted, cohort).select("id", "predicted_label")
    assert before.exceptAll(model.predict(loaded, cohort).select("id", "predicted_label")).count() == 0
    with pytest.raises(model.LabelError):
        model.load_model(str(tmp_path / "m"), ("Low", "High"))


def test_comparison_and_card(cohort, fitted):
    split = cohort.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    pipelines = {
        "logistic": model.logistic(S.label, S.labels, S.features, max_iter=20),
        "forest": model.forest(S.label, S.labels, S.features, trees=5, depth=4),
    }
    compared = {row.model: row for row in model.compare(pipelines, split, S.label, S.labels, S.features).collect()}
    assert set(compared) == {"logistic", "forest"} and compared["forest"].n == 150
    metrics = model.evaluate(model.predict(fitted, cohort), S.label, "predicted_label", S.labels)
    card = model.model_card(fitted, metrics, "run", "v1", NOW).first()
    assert card.index_to_label == {"0": "High", "1": "Low", "2": "Medium"}
    assert card.features == list(S.features) and card.metrics["accuracy"] > 0.5


def test_requests_are_scored_as_they_arrive(spark, cohort, fitted, tmp_path):
    requests = cohort.drop("level").withColumn("age", F.when(F.col("id") == "3", 500).otherwise(F.col("age")))
    requests.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(requests.schema).parquet(f"{tmp_path}/in")
    scored, refused = scoring.score_stream(stream, S, fitted, "run", "v1")
    for rows, name in ((scored, "log"), (refused, "refused")):
        for _ in range(2):  # the second run finds nothing new
            scoring.append_stream(rows, f"{tmp_path}/{name}", f"{tmp_path}/{name}_state", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/log").count() == 599
    assert spark.read.parquet(f"{tmp_path}/refused").first().errors == ["invalid:age"]


def test_unscored_pairs_are_counted(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", None), ("z", "a")], "actual string, predicted string")
    row = model.evaluate(pred, "actual", "predicted", ["a", "b"]).first()
    assert (row.n, row.n_unscored, row.accuracy) == (1, 2, 1.0)


def test_moments_certify_the_optimum_and_nothing_else(cohort):
    converged = model.fit(model.logistic(S.label, S.labels, S.features), cohort, S.features)
    moments = model.moments(converged, cohort, S.label, S.features)
    assert model.certify(moments).first().optimal
    by_term = {(row.label, row.term): row for row in moments.collect()}
    assert len(by_term) == 3 * 5
    assert by_term["Low", "(rows)"].observed == cohort.where("level = 'Low'").count()
    assert by_term["High", "a"].observed == cohort.where("level = 'High'").agg(F.sum("a")).first()[0]
    assert by_term["High", "a"].expected == pytest.approx(by_term["High", "a"].observed, rel=1e-3)
    # Not yet converged, regularised, or applied to other rows: no optimum.
    early = model.fit(model.logistic(S.label, S.labels, S.features, max_iter=2), cohort, S.features)
    assert not model.certify(model.moments(early, cohort, S.label, S.features)).first().optimal
    shrunk = model.logistic(S.label, S.labels, S.features)
    shrunk.getStages()[-1].setRegParam(0.1)
    assert not model.certify(model.moments(model.fit(shrunk, cohort, S.features), cohort, S.label, S.features)).first().optimal
    shifted = cohort.withColumn("a", F.col("a") + 1)
    assert not model.certify(model.moments(converged, shifted, S.label, S.features)).first().optimal


def test_gradients_are_those_of_the_log_loss(cohort):
    """Against differences of the loss, on a model far from its optimum."""
    import numpy as np

    early = model.fit(model.logistic(S.label, S.labels, S.features, max_iter=1), cohort, S.features)
    last = early.stages[-1]
    rows = cohort.toPandas()
    x = (rows[list(S.features)].to_numpy(float) - early.stages[2].mean.toArray()) / early.stages[2].std.toArray()
    y = np.array([model.fitted_labels(early).index(v) for v in rows["level"]])

    def loss(weights, constants):
        z = x @ weights.T + constants
        z -= z.max(axis=1, keepdims=True)
        return np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y])

    weights, constants = last.coefficientMatrix.toArray(), last.interceptVector.toArray()
    found = {(r.label, r.term): r.gradient for r in model.moments(early, cohort, S.label, S.features).collect()}
    for k, label in enumerate(model.fitted_labels(early)):
        for j, term in enumerate(("(rows)", *S.features)):
            up, down = (weights.copy(), constants.copy()), (weights.copy(), constants.copy())
            for (w, c), step in ((up, 1e-5), (down, -1e-5)):
                if j:
                    w[k, j - 1] += step
                else:
                    c[k] += step
            assert found[label, term] == pytest.approx((loss(*up) - loss(*down)) / 2e-5, abs=1e-6)


def test_trees_as_a_table_predict_as_the_model(spark, cohort, tmp_path, monkeypatch):
    fitted = model.fit(model.forest(S.label, S.labels, S.features, trees=12, depth=6), cohort, S.features)
    model.save_model(fitted, f"{tmp_path}/saved")
    loaded = model.load_model(f"{tmp_path}/saved", S.labels)
    holed = cohort.withColumn("a", F.when(F.col("id") % 50 != 0, F.col("a"))).unionByName(cohort.limit(5))
    expected = model.predict(fitted, holed)
    wanted = sorted((r.id, r.predicted_label or "") for r in expected.collect())
    for at, source in enumerate((fitted, loaded)):
        nodes = model.node_table(source, f"{tmp_path}/forest{at}", spark)
        assert nodes.select("tree").distinct().count() == 12 and nodes.count() == fitted.stages[-1].totalNumNodes
        assert nodes.where("(votes IS NULL) = (feature IS NULL)").count() == 0
        got = model.predict_by_joins(source, nodes, holed, f"{tmp_path}/rows{at}")
        assert sorted((r.id, r.joined_label or "") for r in got.collect()) == wanted
    monkeypatch.setattr(model, "BROADCAST_NODES", 0)  # joined by shuffles
    got = model.predict_by_joins(loaded, nodes, holed, f"{tmp_path}/rows9")
    assert sorted((r.id, r.joined_label or "") for r in got.collect()) == wanted


def test_evaluation_of_nothing(spark):
    empty = spark.createDataFrame([], "y string, p string")
    row = model.evaluate(empty, "y", "p", ("x", "z")).first()
    assert (row.n, row.n_unscored, row.accuracy, row.macro_f1) == (0, 0, None, 0.0)
