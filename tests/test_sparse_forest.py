"""The forest grown from sparse rows, against Spark's own."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from presscheck.plans import training
from presscheck.plans.sparse_forest import fit_sparse_forest

KINDS = "label int, weight double, indices array<int>, values array<double>"


def table(spark, generator, rows, features, values):
    """Rows whose class follows from a few features, and some empty ones."""
    x = generator.choice(values, (rows, features)) * (generator.random((rows, features)) < 0.3)
    y = ((x[:, 0] > x[:, 1]) ^ (x[:, 2] > 0) ^ (generator.random(rows) < 0.1)).astype(int)
    kept = [(int(c), 1.0 + 0.5 * int(c), np.flatnonzero(r).tolist(), r[r > 0].tolist()) for r, c in zip(x, y)]
    return spark.createDataFrame(kept, KINDS).repartition(3), features


def vectors(frame, features):
    """With vectors beside the arrays, for the library."""
    entry = F.udf(lambda i, v: Vectors.sparse(features, i, v), Vectors.sparse(1, [], []).__UDT__)
    return frame.withColumn("features", entry("indices", "values"))


@pytest.mark.parametrize("depth", [1, 4])
def test_one_tree_on_all_features_is_the_librarys(spark, depth):
    """Without chance both fits are the same tree, node by node."""
    frame, features = table(spark, np.random.default_rng(5), 300, 12, [0.25, 0.5, 1.0, 2.5])
    classifier = RandomForestClassifier(
        weightCol="weight", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False, seed=1
    )
    got = fit_sparse_forest(frame, features, classifier, bootstrap=False, drawn=1.0)
    want = classifier.fit(vectors(frame, features))
    assert got.numFeatures == features and got.getMaxDepth() == depth and want.totalNumNodes > 2
    assert got.toDebugString.split("\n", 1)[1] == want.toDebugString.split("\n", 1)[1]
    shares = [m.transform(vectors(frame, features)).select("indices", "values", vector_to_array("probability").alias("p")).collect() for m in (got, want)]
    one, two = ({str(r[:2]): r.p for r in rows} for rows in shares)
    assert one.keys() == two.keys()
    assert all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)


def test_a_forest_learns_and_is_repeatable(spark):
    """Many values for a feature, chance in rows and features, and the same forest each time."""
    frame, features = table(spark, np.random.default_rng(6), 800, 30, np.random.default_rng(7).random(500) + 0.1)
    frame = frame.coalesce(1).cache()
    classifier = RandomForestClassifier(weightCol="weight", numTrees=20, maxDepth=6, seed=3)
    first, second = (fit_sparse_forest(frame, features, classifier) for _ in range(2))
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]
    assert first.getNumTrees == 20 and max(t.depth for t in first.trees) == 6
    rights = [
        m.transform(vectors(frame, features)).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).head()[0]
        for m in (first, classifier.fit(vectors(frame, features)))
    ]
    assert rights[0] > 0.7 and rights[0] > rights[1] - 0.08


def test_many_features_need_no_array_for_each_row(spark):
    """Rows times features here are 8 GB of places; the fit holds what the rows hold."""
    rows = [(i % 2, 1.0, [i % 2 * 3 + 5, 900_000 + i], [0.5, 0.5]) for i in range(2000)]
    classifier = RandomForestClassifier(weightCol="weight", numTrees=2, maxDepth=2, seed=3)
    model = fit_sparse_forest(spark.createDataFrame(rows, KINDS), 1_000_000, classifier, drawn=1.0)
    assert all(t.depth == 1 and t.numNodes == 3 for t in model.trees)
    assert model.predict(Vectors.sparse(1_000_000, [8], [0.5])) == 1.0
    assert model.predict(Vectors.sparse(1_000_000, [5], [0.5])) == 0.0


def test_rows_and_features_choose_the_fit(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(training, "fit_sparse_forest", lambda rows, size, c: seen.append(size) or fit_sparse_forest(rows, size, c))
    texts = [(i % 2, 1.0, f"common {'good' if i % 2 else 'bad'} word{i % 9}") for i in range(60)]
    labelled = spark.createDataFrame(texts, "label int, weight double, clean_text string")
    for cells, fits in ((1 << 27, 0), (10, 1)):
        scorer = training.fit_forest(labelled, "clean_text", training.TrainingOptions(trees=9, depth=3, dense_cells=cells))
        assert len(seen) == fits
        found = scorer.score(labelled, "clean_text", "v").select(F.avg((F.col("v.label") == F.col("label")).cast("int")))
        assert found.head()[0] > 0.9
