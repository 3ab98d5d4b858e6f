"""Saved scorers, and the checks a forest must pass before it is used.

A save writes a new version beside the older ones and, last of all, one line under
``published`` that names it. Readers take the last line, so a save that stops in between, or
runs while others read, leaves them with the whole version before it. Versions that no line
names, or that are no longer wanted, may be deleted at any time.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.operators.scorers import FallbackScorer, ForestScorer, LinearScorer, Scorer
from presscheck.operators.tfidf import feature_digest, feature_mismatches
from presscheck.operators.vectorizer import saved_terms
from presscheck.session import scratch_path

MANIFEST = "number long, version string, digest string"


class ArtefactError(ValueError):
    """A saved scorer that does not fit together."""


def _stage(model: PipelineModel, kind: type):
    found = [stage for stage in model.stages if isinstance(stage, kind)]
    if not found:
        raise ArtefactError(f"the saved forest does not contain a {kind.__name__}")
    return found[0]


def vocabulary(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(index, term)`` of a pipeline's vectorizer."""
    path = scratch_path(spark, "vocabulary")
    PipelineModel([_stage(model, CountVectorizerModel)]).save(path)
    return saved_terms(spark, path)


def check_forest(spark: SparkSession, model: PipelineModel, features: DataFrame | None = None) -> None:
    """Raises unless vectorizer and forest belong together.

    ``features`` is the ``(index, term)`` list that the forest was fitted with, if it is known.
    """
    _check_stages(model)
    if features is not None:
        current = vocabulary(spark, model)
        _check_names(feature_digest(features), features, current)


def _check_stages(model: PipelineModel) -> None:
    forest = _stage(model, RandomForestClassificationModel)
    size = len(_stage(model, CountVectorizerModel).vocabulary)
    if forest.numFeatures != size:
        raise ArtefactError(
            f"forest and vectorizer do not match: {forest.numFeatures} features against {size} terms"
        )
    if forest.numClasses != 2:
        raise ArtefactError("the forest must know the classes 0 = Fake and 1 = Real")
    if not forest.getOrDefault("probabilityCol"):
        raise ArtefactError("the forest does not give probabilities")


def _check_names(digest: str, saved: DataFrame, current: DataFrame) -> None:
    """One digest comes to the driver; the lists are compared only to say where they differ."""
    if feature_digest(current) != digest:
        rows = feature_mismatches(saved, current).orderBy("index").limit(3).collect()
        places = "; ".join(f"{r['index']}: {r.saved_term!r}, {r.current_term!r}" for r in rows)
        raise ArtefactError(f"the forest's feature names differ from the vectorizer's ({places or 'the list itself'})")


# Versions.


def _published(spark: SparkSession, path: str) -> Row | None:
    """The last line under ``published``; None if there is none."""
    try:
        lines = spark.read.schema(MANIFEST).json(f"{path}/published/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines.where(F.col("version").isNotNull()).orderBy(F.desc("number"), F.desc("version")).head()


def _publish(spark: SparkSession, path: str, version: str, digest: str) -> None:
    last = _published(spark, path)
    number = last.number + 1 if last else 1
    line = spark.createDataFrame([(number, version, digest)], MANIFEST).coalesce(1)
    line.write.json(f"{path}/published/{number:08d}-{version}")


def _new_version(path: str) -> tuple[str, str]:
    version = uuid.uuid4().hex
    return version, f"{path}/versions/{version}"


def save_forest(spark: SparkSession, scorer: ForestScorer, path: str) -> None:
    version, folder = _new_version(path)
    scorer.model.save(f"{folder}/model")
    saved_terms(spark, f"{folder}/model").write.parquet(f"{folder}/features")
    features = spark.read.parquet(f"{folder}/features")
    _publish(spark, path, version, feature_digest(features))


def load_forest(spark: SparkSession, path: str, name: str = K.FOREST_NAME, bare: bool = False) -> ForestScorer:
    """The forest is mandatory: a missing or unfit one is an error.

    ``bare`` takes a pipeline saved by itself in ``path``, without its feature list; it is
    checked by size alone, with a warning.
    """
    if bare:
        warnings.warn(f"{name}: feature names are not checked", stacklevel=2)
        scorer = ForestScorer(_loaded(path, path, name), name)
        _check_stages(scorer.model)
        return scorer
    last = _published(spark, path)
    if last is None:
        raise ArtefactError(f"{name} model not found: {path}")
    folder = f"{path}/versions/{last.version}"
    model = _loaded(f"{folder}/model", path, name)
    _check_stages(model)
    features = spark.read.schema("index int, term string").parquet(f"{folder}/features")
    _check_names(last.digest, features, saved_terms(spark, f"{folder}/model"))
    return ForestScorer(model, name)


def _loaded(folder: str, path: str, name: str) -> PipelineModel:
    try:
        return PipelineModel.load(folder)
    except Exception as error:
        raise ArtefactError(f"{name} model not found: {path}") from error


def save_linear(scorer: LinearScorer, path: str) -> None:
    version, folder = _new_version(path)
    scorer.model.save(f"{folder}/model")
    _publish(SparkSession.active(), path, version, "")


def load_linear(path: str, name: str = K.LINEAR_NAME) -> Scorer:
    """The second scorer is optional: if there is none, every row gets the fallback answer.

    One that is there but cannot be read is an error.
    """
    last = _published(SparkSession.active(), path)
    if last is None:
        warnings.warn(f"no {name} model in {path}; its answers fall back", stacklevel=2)
        return FallbackScorer(name)
    return LinearScorer(PipelineModel.load(f"{path}/versions/{last.version}/model"), name)
