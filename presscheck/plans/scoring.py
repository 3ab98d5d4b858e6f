"""From article tables to result tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.operators.contract import result_ok
from presscheck.operators.decision import final_prediction
from presscheck.operators.distinct_texts import HOT_COPIES, score_distinct
from presscheck.operators.verdict_store import VerdictStore
from presscheck.operators.once import compute_once
from presscheck.operators.report import RESULT_COLUMNS, result_columns
from presscheck.operators.scorers import FallbackScorer, Scorer
from presscheck.operators.validation import check_articles
from presscheck.session import materialise
from presscheck.sources.results import REJECTED, SCORED, write_results

METRICS_SCHEMA = (
    "run_id string, rows_in long, rows_rejected long, rows_scored long, "
    "contract_violations long, rows_fallback long, seconds double"
)


class ForestMissing(RuntimeError):
    """The mandatory first scorer is not available (503)."""

    code = K.CODE_UNAVAILABLE


def require_forest(first: Scorer) -> None:
    """Refuses a run, before any work, whose first scorer is a mere stand-in."""
    if type(first) is FallbackScorer:
        raise ForestMissing(f"{first.name} is not available")


def scorable(checked: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`check_articles` output with the text of rejected rows blanked to null."""
    return checked.select(
        *keys,
        "code",
        "reason",
        "word_count",
        F.when(F.col("code").isNull(), F.col("clean_text")).alias("clean_text"),
    )


def add_verdicts(texts: DataFrame, first: Scorer, second: Scorer) -> DataFrame:
    return second.score(first.score(texts, "clean_text", "_first"), "clean_text", "_second")


def assemble(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Decision, nested result and outcome from both verdicts.

    A row whose result breaks the contract is rejected as well.
    """
    first, second = F.col("_first"), F.col("_second")
    results = compute_once(judged, {"_final": final_prediction(first, second)}).select(
        *keys,
        "code",
        "reason",
        *result_columns(F.col("word_count"), first, second, F.col("_final")),
    )
    accepted = F.col("code").isNull()
    ok = result_ok(F.col("input.word_count"), F.col("models"), F.col("final"))
    results = compute_once(results, {"_broken": accepted & ~ok})
    broken = F.col("_broken")
    kept = accepted & ~broken
    return results.select(
        *keys,
        F.when(kept, SCORED).otherwise(REJECTED).alias("outcome"),
        F.when(broken, K.CODE_SCORER).otherwise(F.col("code")).alias("code"),
        F.when(broken, K.SCORER_FAILED).otherwise(F.col("reason")).alias("reason"),
        *[F.when(kept, F.col(c)).alias(c) for c in RESULT_COLUMNS],
    )


def score_articles(articles: DataFrame, keys: list[str], first: Scorer, second: Scorer) -> DataFrame:
    """``(keys, outcome, code, reason, input, models, final)`` for every article.

    Scored and rejected rows come out of one pass. Rejected rows go through the
    scorers as empty texts, which costs little, so that the input is read and
    cleaned once for both.
    """
    require_forest(first)
    texts = scorable(check_articles(articles), keys)
    return assemble(add_verdicts(texts, first, second), keys)


def score_articles_once(
    articles: DataFrame,
    keys: list[str],
    first: Scorer,
    second: Scorer,
    hot_copies: int = HOT_COPIES,
    store: VerdictStore | None = None,
) -> DataFrame:
    """:func:`score_articles`, but with each distinct cleaned text scored once.

    Worth its shuffles where scoring is costly or copies are many. The cleaned
    texts are stored first, as they are read several times. With ``store``, neither are
    texts scored that an earlier batch has scored.
    """
    require_forest(first)
    texts = materialise(scorable(check_articles(articles), keys), "checked")
    judged = score_distinct(
        texts, "clean_text", lambda distinct: add_verdicts(distinct, first, second), hot_copies, keep_text=False, store=store
    )
    return assemble(judged, keys)


def scored(results: DataFrame, keys: list[str]) -> DataFrame:
    return results.where(F.col("outcome") == SCORED).select(*keys, *RESULT_COLUMNS)


def rejected(results: DataFrame, keys: list[str]) -> DataFrame:
    return results.where(F.col("outcome") == REJECTED).select(*keys, "code", "reason")


def run_counts() -> list[Column]:
    """Counters of one run, for ``DataFrame.observe``."""
    outcome, second = F.col("outcome"), F.get("models", F.lit(1))
    # Only the fallback is Fake at one half; a tie is Real.
    fell_back = (second["label"] == K.FAKE) & (second["confidence"] == K.FALLBACK_PROBABILITY)
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(outcome == REJECTED).alias("rows_rejected"),
        F.count_if(outcome == SCORED).alias("rows_scored"),
        F.count_if(F.coalesce(F.col("code") == K.CODE_SCORER, F.lit(False))).alias(
            "contract_violations"
        ),
        F.count_if((outcome == SCORED) & F.coalesce(fell_back, F.lit(False))).alias("rows_fallback"),
    ]


def run_batch(
    articles: DataFrame,
    keys: list[str],
    path: str,
    first: Scorer,
    second: Scorer,
    mode: str = "errorifexists",
) -> DataFrame:
    """Scores a table into ``path`` and returns one row of run metrics.

    One job: the counters are observed in the stage that writes the rows.
    """
    observation = Observation()
    results = score_articles(articles, keys, first, second)
    started = time.monotonic()
    write_results(results, path, mode, watch=lambda rows: rows.observe(observation, *run_counts()))
    counts = observation.get
    row = (
        uuid.uuid4().hex,
        counts["rows_in"],
        counts["rows_rejected"],
        counts["rows_scored"],
        counts["contract_violations"],
        counts["rows_fallback"],
        time.monotonic() - started,
    )
    return articles.sparkSession.createDataFrame([row], METRICS_SCHEMA)
