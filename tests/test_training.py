"""The second scorer's fit, against a plain one, and in a session of default memory."""

import subprocess
import sys
import textwrap
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from presscheck.operators.vectorizer import saved_terms, vectorizer_of
from presscheck.plans import training
from presscheck.plans.logistic import fit_weights

from conftest import SMALL


def plain_weights(x, y, share, penalty, steps=20000, rate=0.5):
    weights = np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ weights[:-1] + weights[-1])))
        residual = share * (p - y) / share.sum()
        gradient = np.append(x.T @ residual + penalty * weights[:-1], residual.sum())
        weights -= rate * gradient
    return weights


def test_weights_are_those_of_a_plain_fit(spark):
    generator = np.random.default_rng(3)
    x = generator.poisson(0.4, (120, 7)).astype(float)
    y = (x @ generator.normal(size=7) + generator.normal(size=120) > 0).astype(int)
    share = generator.uniform(0.5, 2.0, 120)
    rows = [
        (int(y[i]), float(share[i]), [int(j) for j in np.flatnonzero(row)], [float(v) for v in row[row > 0]])
        for i, row in enumerate(x)
    ]
    frame = spark.createDataFrame(rows, "label int, weight double, indices array<int>, values array<double>")
    got = fit_weights(frame.repartition(3), 7, penalty=0.05, passes=100, tolerance=1e-12)
    assert got == pytest.approx(plain_weights(x, y, share, 0.05), abs=2e-4)
    assert not fit_weights(frame.limit(0), 7).any()


def test_gradients_hold_only_features_of_their_rows(spark):
    """A pass sends as many sums as there are features in use, however many there could be."""
    rows = [(1, 1.0, [5], [1.0]), (0, 1.0, [999_999], [2.0]), (1, 1.0, [], [])]
    frame = spark.createDataFrame(rows, "label int, weight double, indices array<int>, values array<double>")
    weights = fit_weights(frame, 1_000_000)
    assert np.flatnonzero(weights[:-1]).tolist() == [5, 999_999] and weights[5] > 0 > weights[999_999]


def test_terms_go_into_a_vectorizer_and_come_out(spark, tmp_path):
    terms = [(2, "é 日"), (0, "a"), (1, '"b,\\')]
    frame = spark.createDataFrame(terms, "index long, term string").repartition(3)
    model = vectorizer_of(frame, "words", "counts", (" ",))
    assert model.vocabulary == ["a", '"b,\\', "é 日", " "]
    from pyspark.ml import PipelineModel

    PipelineModel([model]).save(str(tmp_path / "m"))
    found = saved_terms(spark, str(tmp_path / "m")).orderBy("index").collect()
    assert [tuple(r) for r in found] == [(0, "a"), (1, '"b,\\'), (2, "é 日"), (3, " ")]
    counts = model.transform(spark.createDataFrame([(["a", "x", "a", " "],)], "words array<string>")).head().counts
    assert dict(zip(counts.indices.tolist(), counts.values.tolist())) == {0: 2.0, 3: 1.0}


def test_vocabularies_beyond_the_bounds_are_refused(spark):
    table = spark.createDataFrame([(0, 1.0, "aa bb cc"), (1, 1.0, "aa bb dd")], "label int, weight double, t string")
    for limits in ({"max_terms": 1}, {"max_vocabulary_bytes": 100}, {"min_df": 3}):
        with pytest.raises(ValueError, match="terms of"):
            training.fit_linear(table, "t", training.TrainingOptions(**limits))


def test_linear_scorer_is_the_sum_of_its_words(spark):
    texts = ["good news here"] * 4 + ["bad story there"] * 4
    table = spark.createDataFrame([(int(i < 4), 1.0, t) for i, t in enumerate(texts)], "label int, weight double, t string")
    scorer = training.fit_linear(table, "t")
    rows = scorer.score(table.select("t").distinct().union(spark.createDataFrame([("",)], "t string")), "t", "v")
    found = {r.t: r.v for r in rows.collect()}
    assert found["good news here"].label == 1 and found["bad story there"].label == 0
    words = scorer.model.stages[0].vocabulary
    weights = scorer.model.stages[1].getScalingVec().toArray()
    value = dict(zip(words, weights))
    margin = sum(value[w] for w in ("good", "news", "here", " "))
    assert found["good news here"].real_probability == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-12)
    assert found[""].real_probability == pytest.approx(1 / (1 + np.exp(-value[" "])), abs=1e-12)


def test_held_out_quality_beats_chance(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    from presscheck.sources.articles import labelled_articles

    fitted, held_out = training.split(labelled_articles(documents, labels), ["doc_id"])
    scorer = training.fit_linear(training.prepared(fitted), "clean_text")
    scored = scorer.score(training.prepared(held_out), "clean_text", "v")
    rates = scored.groupBy("label").agg(F.avg((F.col("v.label") == F.col("label")).cast("double")).alias("r"))
    found = {r.label: r.r for r in rates.collect()}
    assert sum(found.values()) / 2 > 0.6


def test_entry_runs_in_default_memory():
    """The flagship query on eight cores and a heap of 1 GB, in a process of its own."""
    script = f"""
        import sys
        sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from pyspark.sql import SparkSession
        spark = (
            SparkSession.builder.master("local[8]").config("spark.driver.memory", "1g")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
        )
        import __spark_entry__
        from presscheck import session
        print("ROWS", __spark_entry__.entry(spark).count())
        __spark_entry__.queries()["training_quality"](spark, {SMALL!r}).collect()
        session.remove_scratch(spark)
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "ROWS 200" in done.stdout, done.stderr[-2000:]
