"""Nested results and the columns shown for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.functions.display import bar_width, percent_text, time_text

RESULT_COLUMNS = ("input", "models", "final")


def result_columns(word_count: Column, first: Column, second: Column, final: Column) -> list[Column]:
    """The nested result; the models keep the order first, second."""
    return [
        F.struct(word_count.alias("word_count")).alias("input"),
        F.array(first, second).alias("models"),
        final.alias("final"),
    ]


def result_json() -> Column:
    return F.to_json(F.struct(*RESULT_COLUMNS))


def model_rows(results: DataFrame, *keys: str) -> DataFrame:
    """One row per article and model, with the model's place in the list."""
    return results.select(*keys, F.posexplode("models").alias("position", "m")).select(
        *keys, "position", "m.*"
    )


def model_cards(rows: DataFrame, seconds: Column | None = None) -> DataFrame:
    """Display columns for :func:`model_rows`; ``seconds`` is the scoring time, if kept."""
    shown = {
        "badge": F.lower("prediction"),
        "confidence_text": percent_text(F.col("confidence")),
        "fake_text": percent_text(F.col("fake_probability")),
        "real_text": percent_text(F.col("real_probability")),
        "confidence_width": bar_width(F.col("confidence")),
        "fake_width": bar_width(F.col("fake_probability")),
        "real_width": bar_width(F.col("real_probability")),
    }
    if seconds is not None:
        shown["time_text"] = time_text(seconds)
    return rows.withColumns(shown)


def final_columns(seconds: Column | None = None) -> list[Column]:
    """Display columns of the nested result; ``seconds`` is the total time, if kept."""
    final = F.col("final")
    shown = [
        F.upper(final["prediction"]).alias("verdict"),
        F.when(F.lower(final["prediction"]) == K.REAL_NAME.lower(), "real-result")
        .otherwise("fake-result")
        .alias("card_class"),
        percent_text(final["confidence"]).alias("confidence_text"),
        final["selected_model"].alias("selected_model"),
        F.when(final["agreement"], "Yes").otherwise("No").alias("agreement_text"),
        final["decision_method"].alias("decision_method"),
        F.coalesce(F.col("input")["word_count"], F.lit(0)).alias("word_count"),
    ]
    if seconds is not None:
        shown.append(time_text(seconds).alias("time_text"))
    return shown
