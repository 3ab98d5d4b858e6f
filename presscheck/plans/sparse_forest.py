"""A random forest of two classes grown from sparse rows.

Spark's own forest keeps each row as an array over all features, which takes memory and time
in rows times vocabulary. Here a row keeps the features it holds. Trees grow level by level,
all together: a pass sends, for each open node, sums over the bins of the features that its
rows hold and that the node has drawn; Spark adds them up and finds the best split of each
node, where the rows without a feature are the rest of the node. Splits, bins and Gini gains
are those of Spark's forest, and so is the model that comes out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presscheck.session import materialise, scratch_path

# Bins of a feature; the first is that of rows without it.
BINS = 32
# Rows of a batch that go down the trees together.
ROWS = 512
_SUMS = "node int, feature int, bin int, n0 long, n1 long, w0 double, w1 double"
_PARTS = ("n0", "n1", "w0", "w1")
# Gains that differ by less are even, so that the order of sums decides nothing.
_DIGITS = 12


@dataclass
class _Forest:
    """Nodes of all trees; those of the first places are the roots. A right child follows its left one."""

    trees: int
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    totals: list[tuple[int, int, float, float]] = field(default_factory=list)

    def add(self, totals: tuple[int, int, float, float]) -> int:
        for column, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.gain, 0.0), (self.totals, totals)):
            column.append(value)
        return len(self.feature) - 1


def bin_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(row, label, weight, features, bins)`` and the ends of the bins, ``(feature, bin, low, high)``.

    A feature with few values has a bin for each; otherwise its distinct values above zero are
    dealt evenly to the bins, in order. Both tables are stored.
    """
    stored = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    held = F.inline(F.arrays_zip(F.col("indices").alias("feature"), F.col("values").alias("value")))
    entries = stored.select("row", held).where("value > 0")
    of_feature = W.partitionBy("feature")
    ranked = entries.withColumn("rank", F.dense_rank().over(of_feature.orderBy("value")))
    ranked = ranked.withColumn("of", F.max("rank").over(of_feature))
    shared = F.floor((F.col("rank") - 1) * (BINS - 1) / F.col("of")) + 1
    place = F.when(F.col("of") < BINS, F.col("rank")).otherwise(shared).cast("int")
    entries = materialise(ranked.select("row", "feature", "value", place.alias("bin")), "entries")
    ends = entries.groupBy("feature", "bin").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    packed = entries.groupBy("row").agg(F.collect_list(F.struct("feature", "bin")).alias("e"))
    # Rows without a known feature stay.
    binned = stored.select("row", "label", "weight").join(packed, "row", "left").select(
        "row",
        F.col("label").cast("int").alias("label"),
        F.col("weight").cast("double").alias("weight"),
        F.coalesce("e.feature", F.array().cast("array<int>")).alias("features"),
        F.coalesce("e.bin", F.array().cast("array<int>")).alias("bins"),
    )
    return materialise(binned, "binned"), materialise(ends, "ends")


def _sums(shared, level: int):
    """Per batch of rows: sums of the open nodes (feature -1) and of the bins of their drawn features.

    Nested, so that it travels to the workers by value.
    """

    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def key(x: np.ndarray, seed: int) -> np.ndarray:
        return mix(x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = shared.value
        split_on, cut, left, is_open, seed = (grown[c] for c in ("feature", "cut", "left", "open", "seed"))
        used = np.unique(split_on[split_on >= 0])
        # The place of each feature that splits a node; one place more for all others.
        place = np.full(grown["features"], len(used), np.int32)
        place[used] = np.arange(len(used))
        node_key = key(np.arange(len(split_on)), seed)
        # How often a bootstrap sample has a row: Poisson with mean 1, from a hash of row and tree.
        chances = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
        trees = np.arange(grown["trees"], dtype=np.uint64)

        def sums(batch: pa.RecordBatch) -> list[np.ndarray]:
            features = batch["features"].flatten().to_numpy(zero_copy_only=False)
            bins = batch["bins"].flatten().to_numpy(zero_copy_only=False)
            row = batch["features"].value_parent_indices().to_numpy(zero_copy_only=False)
            label, weight, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("label", "weight", "row"))
            size = len(label)
            copies = np.ones((size, len(trees)), np.int64)
            if grown["bootstrap"]:
                drawn = mix(key(ids, seed + 1)[:, None] + key(trees, seed + 2)[None, :])
                copies = np.searchsorted(chances, (drawn >> np.uint64(11)) * 2.0**-53, "right")
            held = np.zeros((size, len(used) + 1), np.uint8)
            held[row, place[features]] = bins
            at = np.broadcast_to(np.arange(len(trees)), (size, len(trees)))
            every = np.arange(size)[:, None]
            for _ in range(level):
                on = split_on[at]
                right = held[every, place[on]] >= cut[at]
                at = np.where(on >= 0, left[at] + right, at)
            feature_key = key(features, seed + 3)
            found = []
            for tree in range(len(trees)):
                node, times = at[:, tree], copies[:, tree]
                here = is_open[node] & (times > 0)
                if not here.any():
                    continue
                rows = np.flatnonzero(here)
                some = here[row]
                if grown["cutoff"] is not None:
                    some &= mix(node_key[node][row] ^ feature_key) < grown["cutoff"]
                some = np.flatnonzero(some)
                of = np.concatenate([rows, row[some]])
                found.append(
                    (
                        node[of],
                        np.concatenate([np.full(len(rows), -1), features[some]]),
                        np.concatenate([np.zeros(len(rows), np.int64), bins[some]]),
                        label[of],
                        times[of],
                        times[of] * weight[of],
                    )
                )
            return [np.concatenate(c) for c in zip(*found)]

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                columns = sums(batch.slice(start, ROWS))
                if not columns:
                    continue
                node, feature, bin_, label, times, share = columns
                of_class = [np.where(label == c, of, 0) for of in (times, share) for c in (0, 1)]
                values = [node.astype(np.int32), feature.astype(np.int32), bin_.astype(np.int32), *of_class]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in values], ["node", "feature", "bin", "n0", "n1", "w0", "w1"]
                )

    return run


def _impurity(zero, one):
    return 1.0 - (zero * zero + one * one) / ((zero + one) * (zero + one))


def _best_splits(sums: DataFrame) -> DataFrame:
    """``(node, n0, n1, w0, w1, best)``: what a node holds, and its best split if it has one.

    A split sends bins from ``cut`` on to the right. Of splits with the same gain the one of the
    first feature and lowest cut is taken.
    """
    added = sums.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in _PARTS])
    is_node = F.col("feature") == -1
    of_node, upwards = W.partitionBy("node"), W.partitionBy("node", "feature").orderBy(F.desc("bin"))
    kept = added.select(
        "*",
        *[F.max(F.when(is_node, F.col(c))).over(of_node).alias(f"all_{c}") for c in _PARTS],
        *[F.sum(c).over(upwards.rowsBetween(W.unboundedPreceding, 0)).alias(f"right_{c}") for c in _PARTS],
        (F.coalesce(F.lead("bin").over(upwards), F.lit(0)) + 1).alias("cut"),
    )

    def right(c: str) -> Column:
        return F.col(f"right_{c}")

    def rest(c: str) -> Column:
        # Exactly zero if no row of the class is left.
        return F.when(F.col(f"all_n{c}") > right(f"n{c}"), F.col(f"all_w{c}") - right(f"w{c}")).otherwise(0.0)

    some_left = F.col("all_n0") + F.col("all_n1") > right("n0") + right("n1")
    total, on_right = F.col("all_w0") + F.col("all_w1"), right("w0") + right("w1")
    gain = (
        _impurity(F.col("all_w0"), F.col("all_w1"))
        - (total - on_right) / total * _impurity(rest("0"), rest("1"))
        - on_right / total * _impurity(right("w0"), right("w1"))
    )
    kept = kept.withColumn("gain", F.when(~is_node & some_left, F.round(gain, _DIGITS)))
    split = F.struct("feature", "cut", "gain", *[right(c).alias(c) for c in _PARTS], rest("0").alias("l0"), rest("1").alias("l1"))
    order = F.when(F.col("gain") > 0, F.struct("gain", -F.col("feature"), -F.col("cut")))
    return kept.groupBy("node").agg(
        *[F.first(f"all_{c}").alias(c) for c in _PARTS], F.max_by(split, order).alias("best")
    )


def _grow(binned: DataFrame, features: int, trees: int, depth: int, seed: int, bootstrap: bool, drawn: float) -> _Forest:
    context = binned.sparkSession.sparkContext
    forest = _Forest(trees)
    for _ in range(trees):
        forest.add((0, 0, 0.0, 0.0))
    open_nodes = list(range(trees))
    # A node draws each feature by itself, with a chance of ``drawn``.
    cutoff = None if drawn >= 1 else np.uint64(int(drawn * 2**64))
    for level in range(depth + 1):
        is_open = np.zeros(len(forest.feature), bool)
        is_open[open_nodes] = True
        grown = {c: np.array(getattr(forest, c)) for c in ("feature", "cut", "left")}
        fixed = {"features": features, "trees": trees, "seed": seed, "bootstrap": bootstrap, "cutoff": cutoff}
        shared = context.broadcast({**grown, **fixed, "open": is_open})
        try:
            found = _best_splits(binned.mapInArrow(_sums(shared, level), _SUMS)).collect()
        finally:
            shared.destroy()
        open_nodes = []
        for row in sorted(found, key=lambda r: r.node):
            forest.totals[row.node] = tuple(row[c] for c in _PARTS)
            best = row.best
            if best is None or level == depth:
                continue
            first = forest.add((row.n0 - best.n0, row.n1 - best.n1, best.l0, best.l1))
            second = forest.add(tuple(best[c] for c in _PARTS))
            forest.feature[row.node], forest.cut[row.node] = best.feature, best.cut
            forest.left[row.node], forest.gain[row.node] = first, best.gain
            if level + 1 < depth:
                open_nodes += [node for node in (first, second) if forest.totals[node][0] and forest.totals[node][1]]
        if not open_nodes:
            break
    return forest


def _thresholds(ends: DataFrame, forest: _Forest) -> dict[tuple[int, int], float]:
    """The value between the bins on both sides of each cut that a node uses."""
    chosen = sorted({(f, c) for f, c in zip(forest.feature, forest.cut) if f >= 0})
    if not chosen:
        return {}
    cuts = F.broadcast(ends.sparkSession.createDataFrame(chosen, "feature int, cut int"))
    above = ends.join(cuts, (ends.feature == cuts.feature) & (ends.bin == cuts.cut)).select(cuts.feature, "cut", "low")
    below = ends.join(cuts, (ends.feature == cuts.feature) & (ends.bin == cuts.cut - 1)).select(cuts.feature, "cut", "high")
    middle = (F.col("low") + F.coalesce("high", F.lit(0.0))) / 2
    found = above.join(below, ["feature", "cut"], "left").select("feature", "cut", middle.alias("at"))
    return {(r.feature, r.cut): r.at for r in found.collect()}


def _node_rows(forest: _Forest, thresholds: dict[tuple[int, int], float]) -> list[tuple]:
    """Nodes as Spark saves them, numbered from the root down, left before right.

    Like Spark, children that are leaves of the same class become one leaf.
    """

    def class_of(node: int) -> float:
        return 1.0 if forest.totals[node][3] > forest.totals[node][2] else 0.0

    # Children come after their parents.
    for node in reversed(range(len(forest.left))):
        left = forest.left[node]
        if left >= 0 and forest.left[left] < 0 and forest.left[left + 1] < 0 and class_of(left) == class_of(left + 1):
            forest.left[node] = forest.feature[node] = -1

    saved = []

    def add(tree: int, node: int, number: int) -> int:
        """Adds a node and those below it; the number after the last."""
        n0, n1, w0, w1 = forest.totals[node]
        left, at = forest.left[node], len(saved)
        saved.append(None)
        impurity = _impurity(w0, w1) if w0 + w1 > 0 else 0.0
        right_number = after = number + 1
        gain, split = -1.0, (-1, [], -1)
        if left >= 0:
            right_number = add(tree, left, number + 1)
            after = add(tree, left + 1, right_number)
            on = forest.feature[node]
            gain, split = forest.gain[node], (on, [thresholds[on, forest.cut[node]]], -1)
        children = (number + 1, right_number) if left >= 0 else (-1, -1)
        saved[at] = (tree, (number, class_of(node), impurity, [w0, w1], n0 + n1, gain, *children, split))
        return after

    for tree in range(forest.trees):
        add(tree, tree, 0)
    return saved


def fit_sparse_forest(
    rows: DataFrame, features: int, classifier: RandomForestClassifier, bootstrap: bool = True, drawn: float | None = None
) -> RandomForestClassificationModel:
    """The forest of ``classifier``'s trees, depth, seed and columns, on two classes.

    ``rows`` is ``(label, weight, indices, values)``, of which values above zero count. A node
    draws the square root of all ``features`` on average, or a share of ``drawn``.
    """
    spark = rows.sparkSession
    trees, depth = classifier.getNumTrees(), classifier.getMaxDepth()
    binned, ends = bin_rows(rows)
    chance = 1 / math.sqrt(features) if drawn is None else drawn
    seed = classifier.getSeed() % 2**32
    forest = _grow(binned, features, trees, depth, seed, bootstrap, chance)
    nodes = _node_rows(forest, _thresholds(ends, forest))
    # Two rows give a model of the right kind and size, whose nodes are then replaced.
    two = [(float(label), 1.0, Vectors.sparse(features, [0], [float(label)])) for label in (0, 1)]
    names = [classifier.getLabelCol(), classifier.getWeightCol(), classifier.getFeaturesCol()]
    model = classifier.copy({classifier.maxDepth: 0}).fit(spark.createDataFrame(two, names))
    model.set(model.maxDepth, depth)
    path = scratch_path(spark, "forest")
    model.save(path)
    kind = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(nodes, kind).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
