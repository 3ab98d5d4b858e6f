"""Merging the two scorers' predictions into one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presscheck import constants as K

DECISION_TYPE = (
    "struct<label:int,prediction:string,confidence:double,agreement:boolean,"
    "selected_model:string,decision_method:string>"
)


def final_prediction(first: Column, second: Column) -> Column:
    """The shared verdict at mean confidence, else the more confident one.

    Equal confidence goes to the second scorer.
    """
    agree = first["label"] == second["label"]
    second_wins = second["confidence"] >= first["confidence"]

    def chosen(field: str) -> Column:
        return F.when(second_wins, second[field]).otherwise(first[field])

    return F.struct(
        chosen("label").alias("label"),
        chosen("prediction").alias("prediction"),
        F.when(agree, (first["confidence"] + second["confidence"]) / 2.0)
        .otherwise(chosen("confidence"))
        .alias("confidence"),
        agree.alias("agreement"),
        F.when(agree, F.concat(first["model"], F.lit(K.NAME_JOINER), second["model"]))
        .otherwise(chosen("model"))
        .alias("selected_model"),
        F.when(agree, K.METHOD_AGREE)
        .otherwise(K.METHOD_DISAGREE)
        .alias("decision_method"),
    ).cast(DECISION_TYPE)
