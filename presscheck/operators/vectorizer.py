"""Vocabularies between tables and Spark ML's vectorizer, without a list in Python.

A vectorizer keeps its terms in one array, which Spark ML saves as a Parquet row. Terms
are put in and taken out there, so they pass from Spark to the vectorizer and back in the
JVM. The array is one row; whoever fits bounds its bytes.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck.session import scratch_path


def vectorizer_of(terms: DataFrame, counted: str, out: str, extra: tuple[str, ...] = ()) -> CountVectorizerModel:
    """A vectorizer from ``counted`` to ``out`` whose feature i is the term with ``index`` i.

    ``terms`` is ``(index, term)`` with places from 0 on; the terms of ``extra`` come last.
    """
    path = scratch_path(terms.sparkSession, "vectorizer")
    CountVectorizerModel.from_vocabulary([""], inputCol=counted, outputCol=out).save(path)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("index", "term"))), lambda e: e["term"])
    vocabulary = F.concat(ordered, F.array(*map(F.lit, extra)).cast("array<string>"))
    terms.agg(vocabulary.alias("vocabulary")).write.mode("overwrite").parquet(f"{path}/data")
    return CountVectorizerModel.load(path)


def saved_terms(spark: SparkSession, path: str) -> DataFrame:
    """``(index, term)`` of the vectorizer that is the first stage of the pipeline saved in ``path``."""
    place: Column = F.posexplode("vocabulary").alias("index", "term")
    stage = spark.read.schema("vocabulary array<string>").parquet(f"{path}/stages/0_*/data")
    return stage.select(place)
