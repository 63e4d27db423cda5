"""Fit, evaluate, compare and apply classifiers with Spark ML.

Scoring stays one `transform`; evaluation is one grouped count of (label,
prediction) pairs and formulas over that small frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.hashing import length_prefixed
from cohortloom.operators.cleaning import timestamp
from cohortloom.operators.forest import CountedForest

PROBABILITY_DIGITS = 4


class LabelError(ValueError):
    """A model does not know exactly the declared labels."""


def _prepare(label: str, labels: Sequence[str], features: Sequence[str], vector: str) -> list:
    """Label index in alphabetical order, then the assembled vector.

    The labels are declared, so no pass over the data looks for them, and an
    undeclared one fails the fit instead of becoming an extra class.
    """
    indexer = StringIndexerModel.from_labels(
        sorted(labels), inputCol=label, outputCol="label_index", handleInvalid="error"
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol=vector, handleInvalid="keep")
    return [indexer, assembler]


def logistic(label: str, labels: Sequence[str], features: Sequence[str], max_iter: int = 300) -> Pipeline:
    """Standardised features into an unregularised multinomial regression."""
    return Pipeline(
        stages=[
            *_prepare(label, labels, features, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(
                labelCol="label_index", family="multinomial", maxIter=max_iter, regParam=0.0, elasticNetParam=0.0
            ),
        ]
    )


def forest(
    label: str, labels: Sequence[str], features: Sequence[str], trees: int = 100, depth: int = 10, seed: int = 42
) -> Pipeline:
    """The control model: a seeded random forest on unscaled features."""
    return Pipeline(
        stages=[
            *_prepare(label, labels, features, "features"),
            CountedForest(labelCol="label_index", numTrees=trees, maxDepth=depth, seed=seed),
        ]
    )


def fit(pipeline: Pipeline, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit on the rows whose features are all present.

    Give it a stored manifest (`read_manifest`), not a split still to be computed:
    every stage of the pipeline reads its input again.
    """
    return pipeline.fit(train.dropna(subset=list(features)))


def fitted_labels(model: PipelineModel) -> list[str]:
    """Labels by index, from the fitted model and nowhere else."""
    return list(model.stages[0].labels)


def fitted_features(model: PipelineModel) -> list[str]:
    return list(model.stages[1].getInputCols())


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `predicted_index`, `predicted_label` and `probability` (array by index).

    Every row stays; one with a missing feature has nulls in the three columns.
    """
    labels = fitted_labels(model)
    complete = F.lit(True)
    for name in fitted_features(model):
        complete = complete & F.col(name).isNotNull()
    index = F.when(complete, F.col("prediction").cast("int"))
    names = F.array(*[F.lit(label) for label in labels])
    return model.transform(df).select(
        *df.columns,
        index.alias("predicted_index"),
        F.get(names, index).alias("predicted_label"),
        F.when(complete, vector_to_array("probability")).alias("probability"),
    )


def score(
    df: DataFrame,
    model: PipelineModel,
    id_column: str,
    labels: Sequence[str],
    run_id: str,
    version: str,
    now: datetime | Column,
) -> DataFrame:
    """Prediction log rows: label, index, probability map, model and dataset version.

    Probabilities are listed in declared label order. The prediction id is a hash
    of model run and row, so a repeated task writes the same id.
    """
    features = fitted_features(model)
    by_index = {label: position for position, label in enumerate(fitted_labels(model))}
    probabilities = F.map_from_arrays(
        F.array(*[F.lit(label) for label in labels]),
        F.array(
            *[F.round(F.get("probability", F.lit(by_index[label])), PROBABILITY_DIGITS) for label in labels]
        ),
    )
    # The label plays no part in scoring and may be absent.
    scored = predict(model, df.select(id_column, *features))
    return scored.select(
        F.sha2(F.concat(F.lit(f"{len(run_id)}:{run_id}"), length_prefixed([id_column, *features])), 256).alias("prediction_id"),
        F.col(id_column).alias("subject_id"),
        "predicted_label",
        "predicted_index",
        F.when(F.col("probability").isNotNull(), probabilities).alias("probabilities"),
        F.lit(run_id).alias("model_run_id"),
        F.lit(version).alias("dataset_version"),
        timestamp(now).alias("created_at"),
        F.struct(*features).alias("features"),
    )


def _pair_counts(pred: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """One row: a count for every pair of declared labels, and `n_unscored` for all other rows.

    One grouped count over the rows, then counters over that small frame.
    """
    counted = pred.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    declared = F.lit(False)
    counters = []
    for at, (a, p) in enumerate(_pairs(labels)):
        this = F.coalesce((F.col("actual") == a) & (F.col("predicted") == p), F.lit(False))
        declared = declared | this
        counters.append(F.coalesce(F.sum(F.when(this, F.col("n"))), F.lit(0)).alias(f"n{at}"))
    left_out = F.coalesce(F.sum(F.when(~declared, F.col("n"))), F.lit(0)).alias("n_unscored")
    return counted.agg(*counters, left_out)


def _pairs(labels: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, p) for a in labels for p in labels]


def confusion(pred: DataFrame, actual: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """(actual, predicted, n) for every pair of declared labels, zeros included."""
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{at}").alias("n"))
        for at, (a, p) in enumerate(_pairs(labels))
    ]
    return _pair_counts(pred, actual, predicted, labels).select(F.inline(F.array(*rows)))


def per_class(matrix: DataFrame) -> DataFrame:
    """(label, support, precision, recall, f1) from a confusion frame.

    A rate whose denominator is 0 is 0.
    """
    sides = matrix.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called")),
            )
        ),
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    )
    # Each hit shows up on both sides.
    summed = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), (F.sum("hit") / 2).alias("hits")
    )

    def rate(part, whole):
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return summed.select(
        "label",
        "support",
        rate(F.col("hits"), F.col("called")).alias("precision"),
        rate(F.col("hits"), F.col("support")).alias("recall"),
        rate(2 * F.col("hits"), F.col("called") + F.col("support")).alias("f1"),
    )


def evaluate(pred: DataFrame, actual: str, predicted: str, labels: Sequence[str], digits: int = 4) -> DataFrame:
    """One row: n, n_unscored and the rates over the n rows whose pair is declared.

    Rows without a prediction or with an undeclared label on either side are unscored.
    The rows are read once: all rates are expressions over one row of pair counts.
    """
    size = len(labels)
    count = [[F.col(f"n{a * size + p}") for p in range(size)] for a in range(size)]
    support = [sum(count[k][1:], count[k][0]) for k in range(size)]
    called = [sum((count[a][k] for a in range(1, size)), count[0][k]) for k in range(size)]
    total = sum(support[1:], support[0])

    def rate(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.try_divide(part, whole)).otherwise(0.0)

    precision = [rate(count[k][k], called[k]) for k in range(size)]
    recall = [rate(count[k][k], support[k]) for k in range(size)]
    f1 = [rate(2 * count[k][k], called[k] + support[k]) for k in range(size)]

    def weighted(values: list[Column]) -> Column:
        return F.try_divide(sum((v * s for v, s in zip(values[1:], support[1:])), values[0] * support[0]), total)

    rates = {
        "accuracy": weighted(recall),
        "weighted_precision": weighted(precision),
        "weighted_recall": weighted(recall),
        "f1": weighted(f1),
        "macro_f1": sum(f1[1:], f1[0]) / size,
    }
    rounded = [F.round(value, digits).alias(name) for name, value in rates.items()]
    return _pair_counts(pred, actual, predicted, labels).select(total.alias("n"), *rounded, "n_unscored")


def moments(
    model: PipelineModel, train: DataFrame, label: str, features: Sequence[str]
) -> DataFrame:
    """(label, term, n, observed, expected, gradient) of a fitted multinomial regression.

    Where the likelihood is at its maximum, the rows that a class is given in expectation
    hold as much of every feature as the rows that have the label: `expected` equals
    `observed`, for the constant term and each feature. `gradient` is the derivative of
    the mean log loss by the class's standardised coefficient, the quantity that the fit
    brings to 0. As the loss is convex, gradients near 0 certify the fit, whoever made it.
    One aggregate over the training rows.
    """
    names = fitted_labels(model)
    scaler = model.stages[2]
    middle, spread = scaler.mean.toArray(), scaler.std.toArray()
    terms = ["(rows)", *features]
    scored = predict(model, train.dropna(subset=list(features)).select(label, *features))

    def value(term: str) -> Column:
        return F.lit(1) if term == "(rows)" else F.col(term)

    # A row a class, so that the sums are those of one class and their code stays small.
    classes = F.array(
        *[
            F.struct(F.lit(name).alias("_class"), F.get("probability", F.lit(k)).alias("_p"), F.col(label).eqNullSafe(name).alias("_own"))
            for k, name in enumerate(names)
        ]
    )
    sums = [F.count(F.lit(1)).alias("n")]
    for j, term in enumerate(terms):
        sums.append(F.coalesce(F.sum(F.when(F.col("_own"), value(term))), F.lit(0)).alias(f"o{j}"))
        sums.append(F.sum(F.col("_p") * value(term)).alias(f"e{j}"))
    summed = scored.select(*features, F.inline(classes)).groupBy("_class").agg(*sums)
    rows = []
    for j, term in enumerate(terms):
        excess = F.col(f"e{j}") - F.col(f"o{j}")
        if j:
            # A feature without spread has no coefficient.
            centred = excess - F.lit(float(middle[j - 1])) * (F.col("e0") - F.col("o0"))
            excess = centred / F.lit(float(spread[j - 1])) if spread[j - 1] > 0 else F.lit(0.0)
        rows.append(
            F.struct(
                F.lit(term).alias("term"),
                F.col("n"),
                F.col(f"o{j}").alias("observed"),
                F.col(f"e{j}").alias("expected"),
                F.try_divide(excess, F.col("n")).alias("gradient"),
            )
        )
    return summed.select(F.col("_class").alias("label"), F.inline(F.array(*rows)))


def certify(moments_of: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """One row: the largest gradient in size, and whether it is within the tolerance."""
    largest = F.max(F.abs("gradient"))
    return moments_of.agg(largest.alias("largest_gradient"), (largest <= tolerance).alias("optimal"))


def node_table(model: PipelineModel, path: str, spark: SparkSession) -> DataFrame:
    """(tree, node, left, right, feature, threshold, votes) of a fitted forest, saved at `path`.

    Leaves have no feature; their votes are the shares of the classes among their
    training rows. The table is the model's own stored form, read as rows.
    """
    model.stages[-1].write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data")
    data = "nodeData" if "nodeData" in stored.columns else None
    field = (lambda name: F.col(f"{data}.{name}")) if data else F.col
    inner = field("leftChild") >= 0
    stats = field("impurityStats")
    whole = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return stored.select(
        F.col("treeID").cast("int").alias("tree"),
        field("id").alias("node"),
        field("leftChild").alias("left"),
        field("rightChild").alias("right"),
        F.when(inner, field("split.featureIndex")).alias("feature"),
        F.when(inner, F.get(field("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(~inner, F.transform(stats, lambda x: F.try_divide(x, whole))).alias("votes"),
    )


BROADCAST_NODES = 1_000_000  # about 80 bytes each


def predict_by_joins(model: PipelineModel, nodes: DataFrame, df: DataFrame, path: str) -> DataFrame:
    """`predict` of a forest without the model: rows go down the node table level by level.

    A row starts at the root of each tree; every level is a join on (tree, node) that
    moves it to a child, and the votes of the leaves are added up. The table is broadcast
    as long as its size is known to be small, so the rows stay where they are; beyond it
    the joins shuffle. Adds `joined_label`; rows with a missing feature have none. Rows are
    numbered and written to `path` first, so that their numbers stay.
    """
    features, forest = fitted_features(model), model.stages[-1]
    small = forest.totalNumNodes <= BROADCAST_NODES
    hint = F.broadcast if small else (lambda frame: frame)
    moves = hint(nodes.where("feature IS NOT NULL").select("tree", "node", "left", "right", "feature", "threshold"))
    leaves = hint(nodes.where("votes IS NOT NULL").select("tree", "node", "votes"))
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    marked = df.sparkSession.read.parquet(path)
    values = F.array(*[F.col(name).cast("double") for name in features])
    trees = F.sequence(F.lit(0), F.lit(forest.getNumTrees - 1))
    at = marked.dropna(subset=features).select("_row", values.alias("_x"), F.explode(trees).alias("tree"), F.lit(0).alias("node"))
    for _ in range(max(tree.depth for tree in forest.trees)):
        child = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(child)
        at = at.join(moves, ["tree", "node"], "left").select("_row", "_x", "tree", step.alias("node"))
    names = fitted_labels(model)
    votes = at.join(leaves, ["tree", "node"]).groupBy("_row").agg(
        *[F.sum(F.get("votes", F.lit(k))).alias(f"v{k}") for k in range(len(names))]
    )
    # The first of equal classes wins, as in the model.
    most = F.greatest(*[F.col(f"v{k}") for k in range(len(names))])
    winner = F.coalesce(*[F.when(F.col(f"v{k}") == most, F.lit(name)) for k, name in enumerate(names)])
    return marked.join(votes.select("_row", winner.alias("joined_label")), "_row", "left").drop("_row")


def compare(
    pipelines: Mapping[str, Pipeline],
    split: DataFrame,
    label: str,
    labels: Sequence[str],
    features: Sequence[str],
) -> DataFrame:
    """(model, n, accuracy, ...): each model fitted on train, judged once on test.

    Both read the same stored manifest, so both see the same split.
    """
    columns = [label, *features]
    train = split.where(F.col("split") == "train").select(*columns)
    test = split.where(F.col("split") == "test").select(*columns)
    results = []
    for name, pipeline in pipelines.items():
        scored = predict(fit(pipeline, train, features), test)
        metrics = evaluate(scored, label, "predicted_label", labels)
        results.append(metrics.select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, results)


def model_card(
    model: PipelineModel, metrics: DataFrame, run_id: str, version: str, trained_at: datetime
) -> DataFrame:
    """One row describing a fitted model; the label map is the fitted one."""
    labels = fitted_labels(model)
    mapping = F.create_map(*[part for at, label in enumerate(labels) for part in (F.lit(str(at)), F.lit(label))])
    values = F.create_map(
        *[part for name in metrics.columns if name not in ("n", "n_unscored") for part in (F.lit(name), F.col(name))]
    )
    return metrics.select(
        F.lit(run_id).alias("model_run_id"),
        F.lit(type(model.stages[-1]).__name__).alias("algorithm"),
        F.array(*[F.lit(name) for name in fitted_features(model)]).alias("features"),
        mapping.alias("index_to_label"),
        values.alias("metrics"),
        F.lit(version).alias("dataset_version"),
        timestamp(trained_at).alias("trained_at"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, labels: Sequence[str]) -> PipelineModel:
    """Load and check that the fitted labels are exactly the declared ones."""
    model = PipelineModel.load(path)
    found = fitted_labels(model)
    if sorted(found) != sorted(labels):
        raise LabelError(f"the model was fitted on {found}, not on {list(labels)}")
    return model


def write_metrics(metrics: DataFrame, matrix: DataFrame, path: str) -> None:
    """Metrics as JSON, the confusion matrix as JSON and CSV."""
    metrics.coalesce(1).write.json(f"{path}/metrics_json")
    small = matrix.coalesce(1)
    small.write.json(f"{path}/confusion_json")
    small.write.option("header", True).csv(f"{path}/confusion_csv")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    fields = "n bigint, n_unscored bigint, accuracy double, weighted_precision double, weighted_recall double, f1 double, macro_f1 double"
    return spark.read.schema(fields).json(f"{path}/metrics_json")
