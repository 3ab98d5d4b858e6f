"""Scorers: objects that add a prediction struct for a text column.

``score(df, text, out)`` keeps the columns of ``df`` and adds ``out``. Rows whose
text is null pass through as empty texts, so rejected and accepted articles can
share one pass; the caller drops what it does not want.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from presscheck import constants as K
from presscheck.functions.text import first_words, text_or_empty, tokens
from presscheck.operators.once import compute_once
from presscheck.operators.scores import (
    fallback_prediction,
    forest_prediction,
    logits_prediction,
)

# Columns inside the saved models.
TERMS, COUNTS, SCALED, FEATURES = "terms_", "counts_", "scaled_", "features_"
RAW, PROBABILITY, PREDICTED = "raw_", "probability_", "predicted_"
# The term whose weight is the intercept; it holds a blank, so no text has it.
INTERCEPT = " "
_INNER = (TERMS, COUNTS, SCALED, FEATURES, RAW, PROBABILITY, PREDICTED)
# Texts that are put in order of length together.
WINDOW = 2048


class Scorer(Protocol):
    name: str

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame: ...


class ForestScorer:
    """TF-IDF of the tokens and a random forest, in one pipeline so their indices agree."""

    def __init__(self, model: PipelineModel, name: str = K.FOREST_NAME):
        self.model, self.name = model, name

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        scored = self.model.transform(df.withColumn(TERMS, tokens(text_or_empty(F.col(text)))))
        scored = scored.withColumn(RAW, vector_to_array(PROBABILITY))
        verdict = forest_prediction(F.col(PREDICTED), F.col(RAW), self.name)
        return compute_once(scored, {out: verdict}).drop(*_INNER)


class LinearScorer:
    """Logistic regression on the first words, with the same cut as the transformer.

    The model counts known words and multiplies each count by its weight; the sum is the
    logit of Real, and that of Fake is 0.
    """

    def __init__(self, model: PipelineModel, name: str = K.LINEAR_NAME, max_tokens: int = K.MAX_TOKENS):
        self.model, self.name, self.max_tokens = model, name, max_tokens

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        words = first_words(text_or_empty(F.col(text)), self.max_tokens)
        scored = self.model.transform(df.withColumn(TERMS, F.array_append(words, F.lit(INTERCEPT))))
        total = F.aggregate(F.unwrap_udt(SCALED)["values"], F.lit(0.0), lambda sum_, part: sum_ + part)
        scored = scored.withColumn(RAW, F.array(F.lit(0.0), total))
        return compute_once(scored, {out: logits_prediction(F.col(RAW), self.name)}).drop(*_INNER)


def tolerant(
    load: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int,
    padded_tokens: int,
    max_tokens: int = K.MAX_TOKENS,
):
    """A loader whose model answers NaN where there is no text or it fails.

    The model sees texts of about one length together, as it pads each batch to its longest
    text: at most ``batch_size`` of them, and at most ``padded_tokens`` with the padding, of
    which a text has no more than ``max_tokens``. Answers come back in the order of the texts.
    A batch that fails is tried text by text, so one bad text does not take its
    neighbours down. The functions are nested so that they travel by value.
    """

    def batches(sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and end - start < batch_size and (end + 1 - start) * sizes[order[end]] <= padded_tokens:
                end += 1
            yield order[start:end]
            start = end

    def run(predict, texts: list[str]) -> np.ndarray:
        try:
            logits = np.asarray(predict(texts), dtype=np.float64)
            if logits.shape == (len(texts), 2):
                return logits
        except Exception:  # noqa: BLE001 - any failure of the model means no score
            pass
        if len(texts) == 1:
            return np.full((1, 2), np.nan)
        return np.concatenate([run(predict, [text]) for text in texts])

    def make_predict():
        try:
            predict = load()
        except Exception:  # noqa: BLE001 - a model that does not load is no scorer
            predict = None

        def run_batch(batch: np.ndarray) -> np.ndarray:
            logits = np.full((len(batch), 2), np.nan)
            filled = np.array([i for i, text in enumerate(batch) if text], dtype=np.int64)
            if len(filled) and predict is not None:
                sizes = np.array([min(len(batch[i].split()), max_tokens) for i in filled])
                for some in batches(sizes):
                    logits[filled[some]] = run(predict, [batch[i] for i in filled[some]])
            return logits

        return run_batch

    return make_predict


class BatchScorer:
    """Any two-class text model, run on Arrow batches.

    ``load`` is called once per Python worker and returns a function from a list
    of texts to an array of logits ``[fake, real]``. If it fails, the rows get the
    fallback answer. The texts of a window, which lies within an Arrow batch, go to the
    model by length; a batch that it sees has ``batch_size`` texts and ``padded_tokens``
    tokens at most, unless one text alone has more.
    """

    def __init__(
        self,
        load: Callable[[], Callable[[list[str]], np.ndarray]],
        name: str = K.SEQUENCE_NAME,
        batch_size: int = 64,
        padded_tokens: int = 64 * K.MAX_TOKENS,
    ):
        self.load, self.name, self.batch_size, self.padded_tokens = load, name, batch_size, padded_tokens

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        logits = predict_batch_udf(
            tolerant(self.load, self.batch_size, self.padded_tokens),
            return_type=ArrayType(DoubleType()),
            batch_size=max(WINDOW, self.batch_size),
        )
        scored = df.withColumn(RAW, logits(text_or_empty(F.col(text))))
        return compute_once(scored, {out: logits_prediction(F.col(RAW), self.name)}).drop(RAW)


class FallbackScorer:
    """Stands in for a scorer that has no model."""

    def __init__(self, name: str = K.SEQUENCE_NAME):
        self.name = name

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        return df.withColumn(out, fallback_prediction(self.name))


def transformer_scorer(
    directory: str, max_tokens: int = K.MAX_TOKENS, name: str = K.SEQUENCE_NAME, batch_size: int = 64
) -> BatchScorer:
    """A sequence classifier with local weights, through torch and transformers.

    The folder must be readable on every worker. Without the weights or the
    packages every row gets the fallback answer.
    """

    def load():
        import torch
        from transformers import AutoModelForSequenceClassification, AutoTokenizer

        tokenizer = AutoTokenizer.from_pretrained(directory, local_files_only=True)
        model = AutoModelForSequenceClassification.from_pretrained(
            directory, local_files_only=True
        )
        if model.config.num_labels != 2:
            raise ValueError("the classifier must have two classes")
        device = "cuda" if torch.cuda.is_available() else "cpu"
        model.to(device).eval()

        def predict(texts):
            batch = tokenizer(
                texts, return_tensors="pt", truncation=True, max_length=max_tokens, padding=True
            ).to(device)
            with torch.inference_mode():
                return model(**batch).logits.float().cpu().numpy()

        return predict

    return BatchScorer(load, name, batch_size)
