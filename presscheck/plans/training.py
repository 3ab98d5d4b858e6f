"""Fitting and checking the two scorers on labelled articles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.functions.text import first_words, tokens
from presscheck.operators import scorers as S
from presscheck.operators.scorers import ForestScorer, LinearScorer
from presscheck.operators.tfidf import TERM_BYTES, count_terms, index_terms
from presscheck.operators.validation import accepted, check_articles
from presscheck.operators.vectorizer import vectorizer_of
from presscheck.plans.logistic import fit_weights
from presscheck.plans.sparse_forest import fit_sparse_forest
from presscheck.session import materialise, scratch_path
from presscheck.sources.articles import labelled_articles


@dataclass(frozen=True)
class TrainingOptions:
    min_df: int = 2
    # The vocabulary lives on the driver and in every task. A larger one, by terms or by the
    # memory it takes, is refused, never cut.
    max_terms: int = 5_000_000
    max_vocabulary_bytes: int = 1 << 30
    trees: int = 50
    depth: int = 10
    # Rows times features up to which Spark's own forest is fitted, which holds an array over all
    # features for each row; beyond that the forest is grown from sparse rows.
    dense_cells: int = 1 << 27
    linear_penalty: float = 0.01
    linear_passes: int = 20
    seed: int = 42


def training_table(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, label, weight, clean_text)`` of the accepted labelled documents."""
    return prepared(labelled_articles(documents, labels))


def prepared(articles: DataFrame) -> DataFrame:
    """Labelled articles cleaned, accepted and weighted.

    Stored once in the shared folder, as fitting reads it many times.
    """
    checked = accepted(check_articles(articles))
    return class_weights(materialise(checked.select("doc_id", "label", "clean_text"), "labelled"))


def class_weights(labelled: DataFrame) -> DataFrame:
    """Adds ``weight`` so that both classes weigh the same in total."""
    totals = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("_of_class"))
    rows = labelled.select(F.count(F.lit(1)).alias("n")).scalar()
    weight = rows / (2.0 * F.col("_of_class"))
    # At most two rows, one per class.
    shares = F.broadcast(totals.select("label", weight.alias("weight")))
    return labelled.join(shares, "label")


def _stored(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as saved and loaded.

    A fitted model keeps a training summary with the session inside, which cannot
    travel to the tasks once a run of this session has been observed.
    """
    path = scratch_path(spark, "model")
    model.save(path)
    return PipelineModel.load(path)


def _vectorizer(labelled: DataFrame, terms: Column, options: TrainingOptions, extra: tuple[str, ...] = ()) -> tuple[CountVectorizerModel, int]:
    """Counts of all terms that enough texts have, in their order, and then of ``extra``; and how many those are.

    The only limit is ``min_df``. A vocabulary beyond the bounds of the options is an error.
    """
    counted = count_terms(labelled.select(terms.alias(S.TERMS)), F.col(S.TERMS), options.min_df)
    index = index_terms(counted.where(F.col("term") != ""))
    size = index.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + TERM_BYTES), F.lit(0))).head()
    if not 0 < size[0] <= options.max_terms or size[1] > options.max_vocabulary_bytes:
        raise ValueError(
            f"{size[0]} terms of {size[1]} bytes are in {options.min_df} or more texts; 1 to {options.max_terms} of "
            f"{options.max_vocabulary_bytes} bytes can be fitted. Change min_df."
        )
    return vectorizer_of(index.select("index", "term"), S.TERMS, S.COUNTS, extra), size[0]


def fit_vectorizer(labelled: DataFrame, text: str, options: TrainingOptions) -> CountVectorizerModel:
    return _vectorizer(labelled, tokens(F.col(text)), options)[0]


def fit_features(labelled: DataFrame, text: str, options: TrainingOptions = TrainingOptions()) -> PipelineModel:
    """From terms to TF-IDF vectors of length one.

    Spark's IDF stage omits the ``+ 1`` of the smoothed weight, so the fitted
    values plus one are applied as an element-wise product.
    """
    vectorizer = fit_vectorizer(labelled, text, options)
    counts = vectorizer.transform(labelled.select(tokens(F.col(text)).alias(S.TERMS))).select(S.COUNTS)
    idf = IDF(inputCol=S.COUNTS).fit(counts).idf.toArray() + 1.0
    scaler = ElementwiseProduct(inputCol=S.COUNTS, outputCol=S.SCALED, scalingVec=Vectors.dense(idf))
    normalizer = Normalizer(inputCol=S.SCALED, outputCol=S.FEATURES, p=2.0)
    return PipelineModel([vectorizer, scaler, normalizer])


def fit_forest(labelled: DataFrame, text: str, options: TrainingOptions = TrainingOptions()) -> ForestScorer:
    """TF-IDF and forest on ``(label, weight, text)``."""
    features = fit_features(labelled, text, options)
    terms = labelled.select("label", "weight", tokens(F.col(text)).alias(S.TERMS))
    vectors = features.transform(terms).select("label", "weight", S.FEATURES)
    classifier = RandomForestClassifier(
        labelCol="label",
        weightCol="weight",
        featuresCol=S.FEATURES,
        rawPredictionCol=S.RAW,
        probabilityCol=S.PROBABILITY,
        predictionCol=S.PREDICTED,
        numTrees=options.trees,
        maxDepth=options.depth,
        seed=options.seed,
    )
    size = len(features.stages[1].getScalingVec())
    if labelled.count() * size > options.dense_cells:
        entry = F.unwrap_udt(S.FEATURES)
        rows = vectors.select("label", "weight", entry["indices"].alias("indices"), entry["values"].alias("values"))
        forest = fit_sparse_forest(rows, size, classifier)
    else:
        # Kept while fitting, which passes over the vectors several times.
        vectors.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            forest = classifier.fit(vectors)
        finally:
            vectors.unpersist()
    return ForestScorer(_stored(PipelineModel([*features.stages, forest]), labelled.sparkSession))


def fit_linear(labelled: DataFrame, text: str, options: TrainingOptions = TrainingOptions()) -> LinearScorer:
    """Logistic regression on counts of the first words, with one weight per word.

    The size of the model is that of the vocabulary, and gradients are sums over the words
    that rows hold (:mod:`presscheck.plans.logistic`). Words in fewer than ``min_df`` texts
    have no weight. The intercept is the weight of a term that every text is given.
    """
    words = first_words(F.col(text), K.MAX_TOKENS)
    vectorizer, features = _vectorizer(labelled, words, options, (S.INTERCEPT,))
    counts = F.unwrap_udt(S.COUNTS)
    rows = (
        vectorizer.transform(labelled.select("label", "weight", words.alias(S.TERMS)))
        .select("label", "weight", counts["indices"].alias("indices"), counts["values"].alias("values"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        weights = fit_weights(rows, features, options.linear_penalty, options.linear_passes)
    finally:
        rows.unpersist()
    product = ElementwiseProduct(inputCol=S.COUNTS, outputCol=S.SCALED, scalingVec=Vectors.dense(weights))
    return LinearScorer(_stored(PipelineModel([vectorizer, product]), labelled.sparkSession))


def split(labelled: DataFrame, keys: list[str], held_out: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows, by a hash of the key: stable under retries and reruns."""
    spot = F.pmod(F.xxhash64(*keys), F.lit(1000)) < int(held_out * 1000)
    return labelled.where(~spot), labelled.where(spot)


def confusion(scored: DataFrame) -> DataFrame:
    """``(model, label, predicted, n)`` for both scorers and the decision.

    ``scored`` has ``label``, ``models`` and ``final``.
    """
    verdicts = F.concat(
        F.transform(
            "models",
            lambda m: F.struct(m["model"].alias("model"), m["label"].alias("predicted")),
        ),
        F.array(F.struct(F.lit("final").alias("model"), F.col("final.label").alias("predicted"))),
    )
    return (
        scored.select("label", F.inline(verdicts))
        .groupBy("model", "label", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quality(counts: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the class Fake, per model."""

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    said, was = F.col("predicted") == K.FAKE, F.col("label") == K.FAKE
    ratio = lambda a, b: F.when(b > 0, a / b)
    sums = counts.groupBy("model").agg(
        F.sum("n").alias("n"),
        rows(F.col("predicted") == F.col("label")).alias("right"),
        rows(said & was).alias("hit"),
        rows(said).alias("said"),
        rows(was).alias("was"),
    )
    return sums.select(
        "model",
        "n",
        ratio(F.col("right"), F.col("n")).alias("accuracy"),
        ratio(F.col("hit"), F.col("said")).alias("fake_precision"),
        ratio(F.col("hit"), F.col("was")).alias("fake_recall"),
        ratio(2 * F.col("hit"), F.col("said") + F.col("was")).alias("fake_f1"),
    )
