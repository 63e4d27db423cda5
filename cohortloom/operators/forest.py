"""A random forest grown by counting, over rows kept as one byte a feature.

Spark ML's trainer holds every row as objects with a bag count for each tree, some 500
bytes for 100 trees, and walks each tree of objects from its root for each row and level.
This one is the same method with the same parameters: the split points are those that
Spark ML chooses from a sample of rows, a row counts in a tree as often as a Poisson draw
says, every node looks at its own random features, and the split of the largest gain is
taken, level by level. Only the counting differs. Rows are stored once with a byte a
feature and their number; a level is one pass over them, in which a task walks all its
rows down a tree at once and counts them by node, feature, bin and class. The counts are
added up by tree and nodes, and the driver gets one row a block of split nodes.

A task holds the counts of the nodes of a pass, at most `maxMemoryInMB` of them, and the
driver the trees; neither grows with the rows. Draws depend on the seed, the tree and the
row's number alone, so a repeated task counts the same. The result is Spark ML's own
model, pruned as there.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.files import remove, scratch_dir, shuffles_dropped

CHUNK = 1 << 16  # rows walked at once
BLOCK = 64  # nodes whose counts are added up in one group
EPSILON = 2.0**-52
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])
#: 65 536 equally likely draws of a Poisson number with mean 1.
DRAWS = np.searchsorted(_POISSON, (np.arange(65536) + 0.5) / 65536).astype(np.uint8)
_PREFIX = "org.apache.spark.ml.classification."


class CountedForest(RandomForestClassifier):
    """`RandomForestClassifier` for unweighted rows with numbers as features."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        per_node = {"auto", "sqrt", "all"}
        plain = (
            not self.isSet("weightCol")
            and self.getBootstrap()
            and self.getSubsamplingRate() == 1.0
            and self.getImpurity() == "gini"
            and self.getFeatureSubsetStrategy() in per_node
            and self.getMinWeightFractionPerNode() == 0.0
            and self.getMaxBins() <= 256
            and self.getMaxDepth() <= 14
        )
        vector = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        if not plain or "nominal" in vector or "binary" in vector:
            return super()._fit(dataset)
        spark = dataset.sparkSession
        place = scratch_dir(spark)
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        total, width, top = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max("y")).first()
        if not total:
            raise ValueError("a forest needs rows to be fitted on")
        named = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {}).get("vals")
        classes = len(named) if named else int(top) + 1
        if classes > 256:
            return super()._fit(dataset)
        needed = max(self.getMaxBins() ** 2, 10_000)
        drawn = rows.select("x") if total <= needed else rows.select("x").sample(fraction=needed / total, seed=self.getSeed())
        values = np.array([row.x for row in drawn.collect()]).reshape(-1, width)
        splits = [split_points(values[:, at], min(self.getMaxBins(), total)) for at in range(width)]
        rows.mapInArrow(_binned(splits), "at bigint, cells binary").write.parquet(f"{place}/cells")
        with shuffles_dropped(spark):
            grown = grow(spark.read.parquet(f"{place}/cells"), self, splits, classes)
        model = as_model(spark, self, grown, splits, classes, f"{place}/model")
        remove(spark, place)
        return model


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Middles between successive values: of all of them, or where a `bins`-th of the rows is passed."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) < bins:
        return middles
    stride = counts.sum() / bins
    chosen, passed, target = [], np.cumsum(counts), stride
    for at in range(1, len(found)):
        if abs(passed[at - 1] - target) < abs(passed[at] - target):
            chosen.append(middles[at - 1])
            target += stride
    return np.array(chosen)


def _binned(splits: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at, width = TaskContext.get().partitionId() << 33, len(splits)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            cells = np.empty((n, width + 1), np.uint8)
            for j, points in enumerate(splits):
                cells[:, j] = np.searchsorted(points, x[:, j], side="left")
            cells[:, width] = batch.column(1).to_numpy(zero_copy_only=False)
            offsets = pa.py_buffer(np.arange(0, (n + 1) * (width + 1), width + 1, dtype=np.int32))
            packed = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(cells.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + n)), packed], names=["at", "cells"])
            at += n

    return run


def draws(at: np.ndarray, seed: int, four: int) -> np.ndarray:
    """How often each row counts in trees 4 * four to 4 * four + 3, one column a tree."""
    z = at.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + four * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    z ^= z >> np.uint64(31)
    return DRAWS[z.view(np.uint16).reshape(-1, 4)]


def _counted(passing: list[tuple], level: int, seed: int, width: int, bins: int, classes: int):
    """Task that counts its rows by node, feature of the node, bin and class.

    `passing` holds for each tree its number, feature and cut by node (numbered as a heap;
    a leaf sends everything left), the place of each node of the level among those that
    are to be split (the others share a last one), and the features of those.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(chosen.shape[1] * len(chosen) * bins * classes, np.int32) for *_, chosen in passing]

        def add(at: np.ndarray, cells: np.ndarray) -> None:
            flat, four = cells.ravel(), None
            labels = cells[:, width].astype(np.int32)
            for (tree, feature, cut, slot, chosen), counts in zip(passing, sums):
                if four != tree // 4:
                    four, drawn = tree // 4, draws(at, seed, tree // 4)
                times = drawn[:, tree % 4]
                rows = np.flatnonzero(times)
                first, times = (rows * (width + 1)).astype(np.int32), times.take(rows).astype(np.float64)
                node = np.ones(len(rows), np.int32)
                for _ in range(level):
                    cell = feature.take(node)
                    cell += first
                    right = flat.take(cell) > cut.take(node)
                    node += node
                    node += right
                place, label = slot.take(node), labels.take(rows)
                per = len(chosen)
                keys = np.empty((per, len(rows)), np.int64)
                for k in range(per):
                    cell = chosen[k].take(place)
                    cell += first
                    keys[k] = ((place * per + k) * bins + flat.take(cell)) * classes + label
                counts += np.bincount(keys.ravel(), np.tile(times, per), len(counts)).astype(np.int32)

        held, waiting = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = batch.column(1)
            offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            cells = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, width + 1)
            held.append((batch.column(0).to_numpy(), cells))
            waiting += len(cells)
            if waiting >= CHUNK:
                add(*(np.concatenate(parts) for parts in zip(*held)))
                held, waiting = [], 0
        if held:
            add(*(np.concatenate(parts) for parts in zip(*held)))
        for (tree, *_, chosen), counts in zip(passing, sums):
            nodes = counts.reshape(chosen.shape[1], -1)[:-1]
            starts = range(0, len(nodes), BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * len(starts), pa.int32()),
                    pa.array([start // BLOCK for start in starts], pa.int32()),
                    pa.array([nodes[start : start + BLOCK].tobytes() for start in starts], pa.binary()),
                ],
                names=["tree", "block", "counts"],
            )

    return run


def gini(counts: np.ndarray) -> np.ndarray:
    whole = counts.sum(axis=-1, keepdims=True)
    shares = np.divide(counts, whole, out=np.zeros(counts.shape), where=whole > 0)
    return np.where(whole[..., 0] > 0, 1 - (shares**2).sum(axis=-1), 0.0)


def best_splits(counts: np.ndarray, least_rows: int, least_gain: float) -> np.ndarray:
    """For counts by node, feature, bin and class: a row a node of (which of its features, last bin
    on the left, gain, rows by class, those on the left). Without a split that may be, the gain is 0."""
    counts = counts.astype(np.float64)
    nodes, per, bins, classes = counts.shape
    left = np.cumsum(counts, axis=2)
    whole = left[:, :1, -1:, :]
    left, right = left[:, :, :-1, :], whole - left[:, :, :-1, :]
    n, n_left, n_right = whole.sum(axis=-1), left.sum(axis=-1), right.sum(axis=-1)
    n = np.maximum(n, 1)
    gain = gini(whole) - n_left / n * gini(left) - n_right / n * gini(right)
    allowed = (n_left >= max(least_rows, 1)) & (n_right >= max(least_rows, 1)) & (gain >= least_gain) & (gain > 0)
    gain = np.where(allowed, gain, 0.0).reshape(nodes, -1)
    stats = whole[:, 0, 0, :]
    if not gain.shape[1]:  # no feature has two bins
        return np.concatenate([np.zeros((nodes, 3)), stats, stats], axis=1)
    best = gain.argmax(axis=1)
    at = np.arange(nodes)
    head = np.stack([best // (bins - 1), best % (bins - 1), gain[at, best]], axis=1)
    return np.concatenate([head, stats, left.reshape(nodes, -1, classes)[at, best]], axis=1)


def _chosen_splits(per: int, bins: int, classes: int, least_rows: int, least_gain: float):
    def run(key, pieces):
        import pandas as pd

        total = np.sum([np.frombuffer(x, np.int32) for x in pieces["counts"]], axis=0, dtype=np.int64)
        found = best_splits(total.reshape(-1, per, bins, classes), least_rows, least_gain)
        return pd.DataFrame({"tree": [key[0]], "block": [key[1]], "found": [found.tobytes()]})

    return run


def grow(cells: DataFrame, forest: RandomForestClassifier, splits: list[np.ndarray], classes: int) -> list[dict]:
    """The trees: for each, by heap number, feature, cut, gain and rows by class of its nodes."""
    width, bins = len(splits), max(len(points) for points in splits) + 1
    trees, depth, seed = forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()
    subset = forest.getFeatureSubsetStrategy()
    per = width if subset == "all" or subset == "auto" and trees == 1 else int(np.ceil(np.sqrt(width)))
    size = 2 ** (depth + 1)
    grown = [
        {
            "feature": np.zeros(size, np.int32), "cut": np.full(size, 255, np.uint8), "gain": np.zeros(size),
            "stats": np.zeros((size, classes)), "known": np.zeros(size, bool),
        }
        for _ in range(trees)
    ]
    most = max(1, forest.getMaxMemoryInMB() * 2**20 // (4 * per * bins * classes))  # nodes of a pass
    chance = np.random.default_rng(seed % 2**63)
    open_nodes = [np.array([1])] * trees
    # A forest of depth 0 has nothing to split, but its roots' counts come from a pass too.
    for level in range(max(depth, 1)):
        waiting = [(tree, part) for tree, nodes in enumerate(open_nodes) for part in np.split(nodes, range(most, len(nodes), most)) if len(part)]
        after: list[list] = [[] for _ in range(trees)]
        while waiting:
            passing, taken, held = [], {}, 0
            while waiting and (not passing or held + len(waiting[0][1]) <= most) and waiting[0][0] not in taken:
                tree, nodes = waiting.pop(0)
                chosen = np.zeros((per, len(nodes) + 1), np.int32)
                chosen[:, :-1] = chance.random((len(nodes), width)).argsort(axis=1)[:, :per].T
                slot = np.full(2 ** (level + 1), len(nodes), np.int32)
                slot[nodes] = np.arange(len(nodes))
                passing.append((tree, grown[tree]["feature"][: 2**level], grown[tree]["cut"][: 2**level], slot, chosen))
                taken[tree], held = (nodes, chosen), held + len(nodes)
            pieces = cells.mapInArrow(_counted(passing, level, seed, width, bins, classes), "tree int, block int, counts binary")
            finding = _chosen_splits(per, bins, classes, forest.getMinInstancesPerNode(), forest.getMinInfoGain())
            for row in pieces.groupBy("tree", "block").applyInPandas(finding, "tree int, block int, found binary").collect():
                nodes, chosen = taken[row.tree]
                nodes, chosen = nodes[row.block * BLOCK :][:BLOCK], chosen[:, row.block * BLOCK :][:, :BLOCK]
                after[row.tree].append(_take(grown[row.tree], nodes, chosen, np.frombuffer(row.found).reshape(len(nodes), -1), level, depth))
        open_nodes = [np.sort(np.concatenate(parts)) if parts else np.array([], int) for parts in after]
    return grown


def _take(tree: dict, nodes: np.ndarray, chosen: np.ndarray, found: np.ndarray, level: int, depth: int) -> np.ndarray:
    """Enter the splits of some nodes; their children that can be split further."""
    classes = (found.shape[1] - 3) // 2
    stats, left = found[:, 3 : 3 + classes], found[:, 3 + classes :]
    tree["stats"][nodes], tree["known"][nodes] = stats, True
    inner = (found[:, 2] > 0) & (level < depth)
    at = np.flatnonzero(inner)
    split = nodes[at]
    tree["feature"][split] = chosen[found[at, 0].astype(int), at]
    tree["cut"][split], tree["gain"][split] = found[at, 1], found[at, 2]
    children = np.concatenate([2 * split, 2 * split + 1])
    tree["stats"][children] = np.concatenate([left[at], stats[at] - left[at]])
    tree["known"][children] = True
    return children[gini(tree["stats"][children]) > EPSILON] if level + 1 < depth else np.array([], int)


def _listed(tree: dict) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(nodes in the order of a walk, whether a node is inner, its class); leaves of one parent and class are merged into it."""
    best = tree["stats"].argmax(axis=1)
    inner = tree["gain"] > 0
    for node in np.flatnonzero(inner)[::-1]:
        a, b = 2 * node, 2 * node + 1
        if not inner[a] and not inner[b] and best[a] == best[b]:
            inner[node] = False
    out, stack = [], [1]
    while stack:
        node = stack.pop()
        out.append(node)
        if inner[node]:
            stack += [2 * node + 1, 2 * node]
    return out, inner, best


def as_model(spark: SparkSession, forest: RandomForestClassifier, grown: list[dict], splits: list, classes: int, path: str) -> RandomForestClassificationModel:
    """The trees as Spark ML's model: written in its stored form and loaded."""
    rows = []
    for number, tree in enumerate(grown):
        order, inner, best = _listed(tree)
        place = {node: at for at, node in enumerate(order)}
        impurity = gini(tree["stats"])
        for at, node in enumerate(order):
            stats, feature = tree["stats"][node], int(tree["feature"][node])
            split = (feature, [float(splits[feature][tree["cut"][node]])], -1) if inner[node] else (-1, [], -1)
            sides = (place[2 * node], place[2 * node + 1]) if inner[node] else (-1, -1)
            gain = float(tree["gain"][node]) if inner[node] else -1.0
            rows.append((number, (at, float(best[node]), float(impurity[node]), stats.tolist(), int(stats.sum()), gain, *sides, split)))
    split_type = "struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    node_type = (
        "id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
        f"gain: double, leftChild: int, rightChild: int, split: {split_type}"
    )

    def described(kind: str, uid: str, params: dict, defaults: dict, **more) -> str:
        head = {"class": f"{_PREFIX}{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps(head | {"paramMap": params, "defaultParamMap": defaults} | more)

    own = {param.name: value for param, value in forest._paramMap.items()}
    defaults = {param.name: value for param, value in forest._defaultParamMap.items()}
    of_tree = {"numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate"}
    few, fewer = ({name: value for name, value in given.items() if name not in of_tree} for given in (own, defaults))
    each = [
        (number, described("DecisionTreeClassificationModel", f"{forest.uid}_{number}", few, fewer), 1.0) for number in range(len(grown))
    ]
    whole = described("RandomForestClassificationModel", forest.uid, own, defaults, numFeatures=len(splits), numClasses=classes, numTrees=len(grown))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(rows, f"treeID int, nodeData struct<{node_type}>").write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)

