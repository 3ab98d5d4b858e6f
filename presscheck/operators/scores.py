"""Verdicts of single scorers: probabilities or logits to a prediction struct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.functions.text import bind

PREDICTION_TYPE = (
    "struct<model:string,label:int,prediction:string,confidence:double,"
    "fake_probability:double,real_probability:double>"
)


def label_name(label: Column) -> Column:
    return F.when(label == K.FAKE, K.FAKE_NAME).otherwise(K.REAL_NAME)


def prediction(model: str, label: Column, fake: Column, real: Column) -> Column:
    """One scorer's answer as a struct; confidence is the larger probability."""
    return F.struct(
        F.lit(model).alias("model"),
        label.cast("int").alias("label"),
        label_name(label).alias("prediction"),
        F.greatest(fake, real).alias("confidence"),
        fake.alias("fake_probability"),
        real.alias("real_probability"),
    ).cast(PREDICTION_TYPE)


def forest_prediction(label: Column, probability: Column, model: str = K.FOREST_NAME) -> Column:
    """From the class and the probability array ``[fake, real]`` of a forest."""
    return prediction(model, label, probability[K.FAKE], probability[K.REAL])


def softmax(logits: Column) -> Column:
    """``struct<fake, real>`` of two raw scores; null or NaN scores stay null or NaN.

    The raw scores are bound, as each is used three times and may be costly.
    """

    def exps(raw: Column) -> Column:
        fake, real = F.get(raw, F.lit(K.FAKE)), F.get(raw, F.lit(K.REAL))
        top = F.greatest(fake, real)
        return F.struct(F.exp(fake - top).alias("fake"), F.exp(real - top).alias("real"))

    return bind(bind(logits, exps), _over_sum)


def _over_sum(p: Column) -> Column:
    total = p["fake"] + p["real"]
    return F.struct((p["fake"] / total).alias("fake"), (p["real"] / total).alias("real"))


def clamp(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def rescale(probabilities: Column) -> Column:
    """Both clamped to [0, 1] and divided by their sum, if that is positive."""

    def divide(p: Column) -> Column:
        total = p["fake"] + p["real"]
        return F.struct(
            *[clamp(F.when(total > 0, p[c] / total).otherwise(p[c])).alias(c) for c in ("fake", "real")]
        )

    return bind(
        bind(
            probabilities,
            lambda p: F.struct(*[clamp(p[c]).alias(c) for c in ("fake", "real")]),
        ),
        divide,
    )


def logits_prediction(logits: Column, model: str = K.SEQUENCE_NAME) -> Column:
    """From the raw scores ``[fake, real]`` of a sequence classifier.

    A tie is Real. Missing or non-finite scores fall back to Fake with every value
    at one half; they are tested before clamping, as ``least(NaN, 1)`` is 1.
    """

    def usable(p: Column) -> Column:
        present = p["fake"].isNotNull() & p["real"].isNotNull()
        return present & ~F.isnan(p["fake"]) & ~F.isnan(p["real"])

    def verdict(p: Column) -> Column:
        label = F.when(p["fake"] > p["real"], K.FAKE).otherwise(K.REAL)
        return prediction(model, label, p["fake"], p["real"])

    return bind(
        softmax(logits),
        lambda p: F.when(usable(p), bind(rescale(p), verdict)).otherwise(fallback_prediction(model)),
    )


def fallback_prediction(model: str = K.SEQUENCE_NAME) -> Column:
    """The answer of a scorer that is not available."""
    half = F.lit(K.FALLBACK_PROBABILITY)
    return prediction(model, F.lit(K.FAKE), half, half)
