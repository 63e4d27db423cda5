from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F
from test_model import S, cohort  # noqa: F401 - a fixture

from cohortloom.operators import forest, model


def grown(cohort, trees=6, depth=5, **params):  # noqa: F811
    pipeline = model.forest(S.label, S.labels, S.features, trees=trees, depth=depth)
    pipeline.getStages()[-1]._set(**params)
    return model.fit(pipeline, cohort, S.features)


def told(fitted):
    """The trees without the names of their nodes' objects."""
    return [tree.toDebugString.split("\n", 1)[1] for tree in fitted.stages[-1].trees]


def test_every_node_counts_the_drawn_rows_that_reach_it(spark, cohort, tmp_path, monkeypatch):  # noqa: F811
    """Stored rows are a byte a feature, and walking them by hand gives every node's counts and a best split."""
    monkeypatch.setattr(forest, "scratch_dir", lambda _: str(tmp_path / "grown"))
    monkeypatch.setattr(forest, "remove", lambda *_: None)
    fitted = grown(cohort, maxMemoryInMB=256)
    stored = spark.read.parquet(f"{tmp_path}/grown/cells").orderBy("at").collect()
    assert len(stored) == 600 and {len(row.cells) for row in stored} == {len(S.features) + 1}
    at = np.array([row.at for row in stored])
    cells = np.array([list(row.cells) for row in stored])
    nodes = {}
    for row in spark.read.parquet(f"{tmp_path}/grown/model/data").select("treeID", "nodeData.*").collect():
        nodes[row.treeID, row.id] = row
    values = np.array(cohort.select(*S.features).collect(), float)
    points = [forest.split_points(values[:, j], 32) for j in range(len(S.features))]
    for tree in range(6):
        times = forest.draws(at, 42, tree // 4)[:, tree % 4]
        reach = {0: np.arange(600)}
        while reach:
            number, rows = reach.popitem()
            node = nodes[tree, number]
            counts = np.bincount(cells[rows, -1], times[rows], 3)
            assert node.impurityStats == counts.tolist() and node.rawCount == counts.sum()
            assert node.impurity == pytest.approx(1 - ((counts / counts.sum()) ** 2).sum())
            if node.leftChild >= 0:
                at_feature = node.split.featureIndex
                cut = points[at_feature].tolist().index(node.split.leftCategoriesOrThreshold[0])
                left = cells[rows, at_feature] <= cut
                reach[node.leftChild], reach[node.rightChild] = rows[left], rows[~left]
    # Every tree has draws of its own, with mean 1 and variance 1.
    drawn = np.concatenate([forest.draws(np.arange(20_000), 42, four) for four in range(3)], axis=1).astype(float)
    assert drawn.mean(axis=0) == pytest.approx(1, abs=0.03) and drawn.var(axis=0) == pytest.approx(1, abs=0.06)
    assert np.abs(np.corrcoef(drawn.T) - np.eye(12)).max() < 0.04


def test_a_fit_can_be_repeated_and_is_like_spark_mls(cohort):  # noqa: F811
    ours = grown(cohort, trees=30)
    assert told(ours) == told(grown(cohort, trees=30))
    pipeline = model.forest(S.label, S.labels, S.features)
    stages = pipeline.getStages()
    stages[-1] = RandomForestClassifier(labelCol="label_index", numTrees=30, maxDepth=5, seed=42)
    theirs = model.fit(pipeline.setStages(stages), cohort, S.features)
    rates = [model.evaluate(model.predict(m, cohort), S.label, "predicted_label", S.labels).first().accuracy for m in (ours, theirs)]
    assert rates[0] == pytest.approx(rates[1], abs=0.03)
    assert ours.stages[-1].totalNumNodes == pytest.approx(theirs.stages[-1].totalNumNodes, rel=0.15)
    both = [m.stages[-1].featureImportances.toArray() for m in (ours, theirs)]
    assert both[0] == pytest.approx(both[1], abs=0.06)


def test_split_points():
    assert forest.split_points(np.array([3.0, 1.0, 1.0, 2.0, np.nan]), 32).tolist() == [1.5, 2.5]
    assert forest.split_points(np.array([4.0, 4.0]), 32).tolist() == []
    many = forest.split_points(np.arange(1000.0), 10)
    assert len(many) == 9 and np.abs(many - np.arange(100, 1000, 100)).max() < 1


def test_odd_rows(spark, cohort):  # noqa: F811
    """One class, features without spread, few nodes a pass, no rows."""
    one = grown(cohort.where("level = 'Low'"))
    assert [tree.numNodes for tree in one.stages[-1].trees] == [1] * 6
    flat = cohort.withColumns({name: F.lit(1) for name in S.features})
    assert [tree.numNodes for tree in grown(flat).stages[-1].trees] == [1] * 6
    narrow = model.forest(S.label, S.labels, S.features, trees=2, depth=2)
    stage = narrow.getStages()[-1]
    assert told(grown(cohort, trees=1, depth=0))
    stage._set(featureSubsetStrategy="all")
    whole = model.fit(narrow, cohort, S.features)
    stage._set(maxMemoryInMB=0)  # a node a pass
    assert told(model.fit(narrow, cohort, S.features)) == told(whole)
    with pytest.raises(Exception):
        grown(cohort.where("id = 'none'"))


def test_a_comparison_grows_its_forest_by_counting(cohort, monkeypatch):  # noqa: F811
    grow, seen = forest.grow, []
    monkeypatch.setattr(forest, "grow", lambda cells, *more: seen.append(cells.count()) or grow(cells, *more))
    split = cohort.withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    pipelines = {
        "logistic": model.logistic(S.label, S.labels, S.features, max_iter=5),
        "forest": model.forest(S.label, S.labels, S.features, trees=3, depth=3),
    }
    compared = model.compare(pipelines, split, S.label, S.labels, S.features).collect()
    assert {(row.model, row.n, row.n_unscored) for row in compared} == {("logistic", 150, 0), ("forest", 150, 0)}
    assert seen == [450]
