"""The contract a result must meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presscheck import constants as K


def _named(verdict: Column) -> Column:
    return verdict["label"].isin(K.FAKE, K.REAL) & verdict["prediction"].isin(
        K.FAKE_NAME, K.REAL_NAME
    )


def _unit(value: Column) -> Column:
    # NaN is larger than any number in Spark, so it fails here.
    return value.between(0.0, 1.0)


def prediction_ok(verdict: Column) -> Column:
    ok = _named(verdict) & verdict["model"].isNotNull()
    for field in ("confidence", "fake_probability", "real_probability"):
        ok = ok & _unit(verdict[field])
    return F.coalesce(ok, F.lit(False))


def decision_ok(verdict: Column) -> Column:
    ok = _named(verdict) & _unit(verdict["confidence"])
    for field in ("agreement", "selected_model", "decision_method"):
        ok = ok & verdict[field].isNotNull()
    return F.coalesce(ok, F.lit(False))


def result_ok(word_count: Column, models: Column, final: Column) -> Column:
    """True if every value of a result is of the allowed kind and range."""
    return (
        F.coalesce(word_count >= 0, F.lit(False))
        & F.coalesce(F.forall(models, prediction_ok), F.lit(False))
        & decision_ok(final)
    )
