"""A random forest as a table of nodes, and a walk down its trees by joins.

Scores the rows ``(keys, index, weight)`` of :mod:`presscheck.operators.tfidf` without
vectors, and says what a forest does apart from the library that fitted it. All articles go
down one level of all trees at a time. A level moves one small row per article and tree, so
this is for checks and for forests over more features than a vector should have; the scorer
in the main path stays in one narrow pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.session import scratch_path

# Most nodes to send to every task, of about 100 bytes each.
BROADCAST_NODES = 1_000_000


@dataclass(frozen=True)
class ForestTable:
    """``nodes`` is ``(tree, node, feature, threshold, left, right, fake, real)``.

    An inner node sends weights up to its threshold to the left. A leaf has no children; its
    class shares are ``fake`` and ``real``.
    """

    nodes: DataFrame
    trees: int
    depth: int


def forest_table(spark: SparkSession, model: PipelineModel) -> ForestTable:
    """The forest that is the last stage of a pipeline."""
    forest = model.stages[-1]
    if not isinstance(forest, RandomForestClassificationModel):
        raise ValueError("the last stage of the pipeline is no forest")
    path = scratch_path(spark, "forest")
    PipelineModel([forest]).save(path)
    node = F.col("nodeData")
    total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda sum_, part: sum_ + part)
    share = lambda label: F.when(total > 0, node["impurityStats"][label] / total).otherwise(0.0)
    nodes = spark.read.parquet(f"{path}/stages/0_*/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].cast("long").alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        share(K.FAKE).alias("fake"),
        share(K.REAL).alias("real"),
    )
    return ForestTable(nodes, forest.getNumTrees, max(tree.depth for tree in forest.trees))


def walk(articles: DataFrame, keys: list[str], weights: DataFrame, forest: ForestTable) -> DataFrame:
    """``(keys, label, fake_probability, real_probability)`` for each of the ``articles``.

    ``weights`` is ``(keys, index, weight)``; a feature that an article lacks weighs 0. An even
    vote is Fake.
    """
    small = forest.nodes.count() <= BROADCAST_NODES
    sent = F.broadcast if small else (lambda frame: frame)
    inner = sent(forest.nodes.where("left >= 0").drop("fake", "real"))
    split_on = sent(forest.nodes.where("left >= 0").select(F.col("feature").alias("index")).distinct())
    known = weights.select(*keys, "index", "weight").join(split_on, "index", "left_semi")
    known = known.withColumnRenamed("index", "feature")
    each = F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")
    at = articles.select(*keys, each, F.lit(0).alias("node"))
    for _ in range(forest.depth):
        here = at.join(inner, ["tree", "node"], "left").join(known, [*keys, "feature"], "left")
        left = F.coalesce("weight", F.lit(0.0)) <= F.col("threshold")
        # Rows that have come to a leaf stay there.
        below = F.when(F.col("left").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        at = here.select(*keys, "tree", below.alias("node"))
    leaves = sent(forest.nodes.where("left < 0").select("tree", "node", "fake", "real"))
    votes = at.join(leaves, ["tree", "node"]).groupBy(*keys).agg(F.sum("fake").alias("fake"), F.sum("real").alias("real"))
    total = F.col("fake") + F.col("real")
    return votes.select(
        *keys,
        F.when(F.col("real") > F.col("fake"), K.REAL).otherwise(K.FAKE).alias("label"),
        (F.col("fake") / total).alias("fake_probability"),
        (F.col("real") / total).alias("real_probability"),
    )
