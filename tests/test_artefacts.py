"""Forests as tables, digests of their features, and saves that stop in between."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from presscheck.functions.text import tokens
from presscheck.operators import scorers as S
from presscheck.operators import tfidf
from presscheck.operators.forest_table import forest_table, walk
from presscheck.plans import training
from presscheck.sources import artefacts

from conftest import SMALL


@pytest.fixture(scope="module")
def labelled(spark):
    return training.training_table(*(spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels")))


@pytest.fixture(scope="module")
def forest(labelled):
    return training.fit_forest(labelled, "clean_text", training.TrainingOptions(trees=20, depth=8))


@pytest.fixture(scope="module")
def other(labelled):
    return training.fit_forest(labelled, "clean_text", training.TrainingOptions(trees=3, depth=2, min_df=3))


def same_scores(labelled, one, two):
    rows = [sorted(map(repr, f.score(labelled, "clean_text", "v").select("doc_id", "v").collect())) for f in (one, two)]
    return rows[0] == rows[1]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_walking_a_forest_gives_what_its_library_gives(spark, labelled, forest, monkeypatch, limit):
    """On all documents, labelled or not, one without any known term among them."""
    from presscheck.operators import forest_table as module
    from presscheck.sources.articles import document_articles
    from presscheck.operators.validation import check_articles

    monkeypatch.setattr(module, "BROADCAST_NODES", limit)
    documents = check_articles(document_articles(spark.read.parquet(f"{SMALL}/documents.parquet"))).select("doc_id", "clean_text")
    texts = documents.union(spark.createDataFrame([(-1, "")], "doc_id long, clean_text string"))
    vectors = PipelineModel(forest.model.stages[:-1]).transform(texts.select("doc_id", tokens(F.col("clean_text")).alias(S.TERMS)))
    entry = F.unwrap_udt(S.FEATURES)
    weights = vectors.select("doc_id", F.explode(F.arrays_zip(entry["indices"].alias("i"), entry["values"].alias("w"))).alias("e"))
    weights = weights.select("doc_id", F.col("e.i").cast("long").alias("index"), F.col("e.w").alias("weight"))
    table = forest_table(spark, forest.model)
    assert table.trees == 20 and table.depth > 3
    walked = {r.doc_id: r for r in walk(texts, ["doc_id"], weights, table).collect()}
    scored = forest.score(texts, "clean_text", "v").select("doc_id", "v.*").collect()
    assert len(walked) == len(scored) == 201
    for row in scored:
        found = walked[row.doc_id]
        assert found.label == row.label
        assert found.fake_probability == pytest.approx(row.fake_probability, abs=1e-12)
        assert found.real_probability == pytest.approx(row.real_probability, abs=1e-12)


def test_a_pipeline_without_a_forest_has_no_table(spark, forest):
    with pytest.raises(ValueError, match="no forest"):
        forest_table(spark, PipelineModel(forest.model.stages[:-1]))


def test_digest_tells_lists_apart(spark):
    rows = [(i, f"t{i}") for i in range(50)]
    frame = lambda r: spark.createDataFrame(r, "index long, term string")
    whole = tfidf.feature_digest(frame(rows))
    assert whole == tfidf.feature_digest(frame(rows[::-1]).repartition(7)) == tfidf.feature_digest(frame(rows).withColumn("index", F.col("index").cast("int")))
    swapped = [(rows[1][0], rows[0][1]), (rows[0][0], rows[1][1]), *rows[2:]]
    for different in (swapped, rows[:-1], rows + rows[-1:], [(0, "x"), *rows[1:]], []):
        assert tfidf.feature_digest(frame(different)) != whole


def test_swapped_terms_are_found_and_named(spark, forest):
    names = artefacts.vocabulary(spark, forest.model)
    artefacts.check_forest(spark, forest.model, names)
    first, second = (r.term for r in names.where("index < 2").orderBy("index").collect())
    swapped = names.withColumn("index", F.when(F.col("index") < 2, 1 - F.col("index")).otherwise(F.col("index")))
    with pytest.raises(artefacts.ArtefactError) as refused:
        artefacts.check_forest(spark, forest.model, swapped)
    assert f"0: {second!r}, {first!r}" in str(refused.value)


@pytest.mark.parametrize("stop_in", ["saved_terms", "feature_digest", "_publish"])
def test_a_save_that_stops_leaves_the_pair_before_it(spark, labelled, forest, other, tmp_path, monkeypatch, stop_in):
    path = str(tmp_path / "forest")
    first = str(tmp_path / "first")

    def stop(*_):
        raise KeyboardInterrupt

    artefacts.save_forest(spark, forest, path)
    with monkeypatch.context() as patched:
        patched.setattr(artefacts, stop_in, stop)
        for place in (path, first):
            with pytest.raises(KeyboardInterrupt):
                artefacts.save_forest(spark, other, place)
    assert same_scores(labelled, artefacts.load_forest(spark, path), forest)
    # A first save that stopped is no model, and least of all one without checks.
    with pytest.raises(artefacts.ArtefactError, match="not found"):
        artefacts.load_forest(spark, first)
    artefacts.save_forest(spark, other, path)
    assert same_scores(labelled, artefacts.load_forest(spark, path), other)


def test_a_changed_vectorizer_is_refused_on_load(spark, forest, tmp_path):
    """The vectorizer's saved terms are swapped behind the manifest's back."""
    path = str(tmp_path / "forest")
    artefacts.save_forest(spark, forest, path)
    (data,) = tmp_path.glob("forest/versions/*/model/stages/0_*/data")
    row = spark.read.parquet(str(data)).head()
    changed = [row.vocabulary[1], row.vocabulary[0], *row.vocabulary[2:]]
    spark.createDataFrame([(changed,)], "vocabulary array<string>").write.mode("overwrite").parquet(str(data))
    with pytest.raises(artefacts.ArtefactError, match="names differ"):
        artefacts.load_forest(spark, path)


def test_a_bare_pipeline_is_taken_only_on_demand(spark, labelled, forest, tmp_path):
    path = str(tmp_path / "bare")
    forest.model.save(path)
    with pytest.raises(artefacts.ArtefactError, match="not found"):
        artefacts.load_forest(spark, path)
    with pytest.warns(UserWarning, match="not checked"):
        assert same_scores(labelled, artefacts.load_forest(spark, path, bare=True), forest)
