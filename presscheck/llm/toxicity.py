"""Severity of toxic language by cumulative-link ordinal regression.

Features are words and the first few bytes of words, which catch inflected and compound
forms. The score of a text is a weighted sum over its features; all grades share the
weights and differ in their thresholds only: P(grade >= k) = sigmoid(score - threshold k).
The expected severity is the sum of these probabilities.

Labels say toxic or not. Grade 0 is not toxic; toxic texts get grade 1 or 2, by whether
their features that point to toxicity add up to less or more than in the median of all
labelled toxic texts.

The model is fitted on at most about ``SAMPLE`` labelled documents, chosen by a hash of
their key. Scoring covers all documents in place, without a shuffle.

Null and empty texts have no features and severity by the thresholds alone. Repeated
rows score alike. Labels that are null or other than 0 and 1 are ignored, and of
contradicting labels of a document the higher counts. Without labelled documents of
both kinds every severity is 0. Columns of the result's names are replaced; other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presscheck.llm.tables import free_name, materialise, share, shared, slices, text_bytes
from presscheck.llm.words import Spans, Words, alphanumeric, lower_table

# Bound of the labelled documents that the model is fitted on.
SAMPLE = 20_000
PREFIXES = (4, 5, 6, 7)
# A feature counts if, with three standard errors to spare, it makes toxicity twice as likely.
ERRORS, ODDS = 3.0, 2.0
GRADES = 3
PENALTY = 1e-6
OUT = {"severity": "double", "toxic_probability": "double", "grade": "integer"}


def _features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes, the text of each, and the number of words of each text."""
    words = Words(lower_table()[data], bounds, alphanumeric())
    spans = Spans(words.data)
    found, owner = [spans.hashes(words.start, words.end)], [words.doc]
    for n in PREFIXES:
        long = np.flatnonzero(words.end - words.start > n)
        found.append(spans.hashes(words.start[long], words.start[long] + n) ^ np.uint64(n))
        owner.append(words.doc[long])
    return np.concatenate(found), np.concatenate(owner), words.counts


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(feature, toxic, clean)``: in how many texts of each kind, summed by slice."""
    for batch in batches:
        for part in slices(batch, "text"):
            found, owner, _ = _features(*text_bytes(part["text"]))
            order = np.lexsort((found, owner))
            found, owner = found[order], owner[order]
            once = np.ones(len(found), bool)
            once[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
            toxic = part["toxic"].to_numpy()[owner[once]]
            kinds, place = np.unique(found[once], return_inverse=True)
            hits = np.bincount(place, toxic, len(kinds)).astype(np.int64)
            total = np.bincount(place, minlength=len(kinds))
            arrays = [pa.array(kinds.view(np.int64)), pa.array(hits), pa.array(total - hits)]
            yield pa.RecordBatch.from_arrays(arrays, ["feature", "toxic", "clean"])


@dataclass
class Model:
    """Sorted feature hashes, a weight for each, and the thresholds of the grades above 0."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def inputs(self, data: np.ndarray, bounds: np.ndarray):
        """Texts, features and values of a sparse matrix: how often a text has the feature, on a log scale."""
        found, owner, counts = _features(data, bounds)
        if not len(self.features):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), counts
        bits = np.uint64(64 - max(10, int(8 * len(self.features)).bit_length()))
        seen = np.zeros(1 << (64 - int(bits)), bool)
        seen[self.features >> bits] = True
        likely = np.flatnonzero(seen[found >> bits])
        at = np.searchsorted(self.features, found[likely])
        at[at == len(self.features)] = 0
        hit = self.features[at] == found[likely]
        cells, times = np.unique(owner[likely[hit]] * len(self.features) + at[hit], return_counts=True)
        rows, columns = cells // len(self.features), cells % len(self.features)
        return rows, columns, np.log2(1 + times), counts

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for the grades above 0, by row."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def _inputs(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared(model)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, columns, values, counts = m.inputs(*text_bytes(part["text"]))
                ends = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (columns, values)]
                yield pa.RecordBatch.from_arrays([part["toxic"], *lists], ["toxic", "columns", "values"])

    return run


def _fit_weights(model: Model, toxic: np.ndarray, rows, columns, values, steps: int = 1000) -> Model:
    """Gradient descent with momentum and scaling on the negative log likelihood."""
    n = len(toxic)
    amount = np.bincount(rows, values, n)
    grade = np.where(toxic == 0, 0, np.where(amount > np.median(amount[toxic == 1]), 2, 1))
    w, low, gap = np.zeros(len(model.features)), 1.0, 0.0
    moments = [np.zeros(len(w) + 2), np.zeros(len(w) + 2)]
    for step in range(1, steps + 1):
        model.weights, model.thresholds = w, np.array([low, low + np.exp(gap)])
        above = model.probabilities(np.bincount(rows, w[columns] * values, n))
        edges = np.column_stack([np.ones(n), above, np.zeros(n)])
        p = np.maximum(edges[np.arange(n), grade] - edges[np.arange(n), grade + 1], 1e-12)
        slope = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        upper, lower = slope[np.arange(n), grade] / p, slope[np.arange(n), grade + 1] / p
        of_score = -(upper - lower) / n
        of_first = np.sum(np.where(grade == 1, upper, 0) - np.where(grade == 0, lower, 0)) / n
        of_second = np.sum(np.where(grade == 2, upper, 0) - np.where(grade == 1, lower, 0)) / n
        gradient = np.concatenate(
            [
                np.bincount(columns, of_score[rows] * values, len(w)) + PENALTY * w,
                [of_first + of_second, of_second * np.exp(gap)],
            ]
        )
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        change = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, low, gap = w - change[:-2], low - change[-2], gap - change[-1]
    return Model(model.features, w, np.array([low, low + np.exp(gap)]))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, np.inf))
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("toxic"))
    )
    fraction = sample / max(known.count(), 1)
    spot = F.pmod(F.xxhash64(F.lit("toxicity"), "_key"), F.lit(1 << 30))
    # Bounded by the sample, so it can go to every task.
    chosen = F.broadcast(known.where(spot < min(int(fraction * (1 << 30)), 1 << 30)))
    texts = documents.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    labelled = materialise(texts.join(chosen, "_key").select("toxic", "text").distinct(), "labelled")
    total, toxic = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).head()
    if not 0 < toxic < total:
        return nothing
    counted = labelled.mapInArrow(_count_features, "feature long, toxic long, clean long")
    counted = counted.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    cells = [F.col("a") + 0.5, toxic - F.col("a") + 0.5, F.col("b") + 0.5, total - toxic - F.col("b") + 0.5]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    error = F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))
    # Each needs several texts of the bounded sample, so there are few.
    telling = counted.where(odds - ERRORS * error > np.log(ODDS)).select("feature").toPandas()["feature"]
    features = np.sort(telling.to_numpy(np.int64).view(np.uint64))
    model = Model(features, np.zeros(len(features)), np.zeros(GRADES - 1))
    if not len(features):
        return nothing
    schema = "toxic int, columns array<long>, values array<double>"
    rows = labelled.mapInArrow(_inputs(share(documents.sparkSession, model)), schema).toPandas()
    owner = np.repeat(np.arange(len(rows)), rows["columns"].map(len))
    return _fit_weights(
        model,
        rows["toxic"].to_numpy(),
        owner,
        np.concatenate([*rows["columns"], []]).astype(np.int64),
        np.concatenate([*rows["values"], []]).astype(float),
    )


def _scorer(model, text: str, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared(model)
        for batch in batches:
            for part in slices(batch, text):
                rows, columns, values, counts = m.inputs(*text_bytes(part[text]))
                above = m.probabilities(np.bincount(rows, m.weights[columns] * values, len(part)))
                if not np.isfinite(m.thresholds).all():
                    above[:] = 0.0
                edges = np.column_stack([np.ones(len(part)), above, np.zeros(len(part))])
                grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)
                out = [pa.array(above.sum(axis=1)), pa.array(above[:, 0].copy()), pa.array(grade)]
                yield pa.RecordBatch.from_arrays([part[c] for c in carried] + out, [*carried, *OUT])

    return run


def score(documents: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all, unless given), ``severity`` (expected grade),
    ``toxic_probability`` (of any grade above 0) and ``grade`` (the most probable)."""
    carry = [c for c in (documents.columns if carry is None else carry) if c not in OUT]
    schema = StructType(documents.select(*carry).schema.fields)
    for name, kind in OUT.items():
        schema = schema.add(name, kind)
    columns = [*[c for c in carry if c != text], text]
    return documents.select(*columns).mapInArrow(_scorer(share(documents.sparkSession, model), text, carry), schema)


def remove_toxic(documents: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose probability of being toxic is below ``limit``."""
    plain = [c for c in documents.columns if c not in OUT]
    if len(plain) == len(documents.columns):
        return score(documents, model, text).where(F.col("toxic_probability") < limit).select(*plain)
    # Columns of the result's names are kept aside.
    name = free_name("_aside", documents)
    aside = documents.select(*plain, F.struct(*[c for c in documents.columns if c in OUT]).alias(name))
    kept = score(aside, model, text).where(F.col("toxic_probability") < limit)
    return kept.select(*[F.col(name)[c].alias(c) if c in OUT else F.col(c) for c in documents.columns])
