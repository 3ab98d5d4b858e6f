"""Accepting and rejecting articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.functions import text as X
from presscheck.operators.once import compute_once


def length_error(headline: Column, article: Column) -> Column:
    """Messages for raw fields over their limit, joined as both may fail; else null."""

    def too_long(c: Column, limit: int) -> Column:
        # The byte length is stored, so short texts need no character count.
        over = (F.octet_length(c) > limit) & (F.length(c) > limit)
        return F.when(over, F.lit(K.TOO_LONG % limit))

    messages = (
        too_long(headline, K.MAX_HEADLINE_CHARS),
        too_long(article, K.MAX_ARTICLE_CHARS),
    )
    return F.when(
        F.coalesce(*messages).isNotNull(), F.concat_ws(", ", *messages)
    )


def text_error(cleaned: Column, words: Column) -> Column:
    """The message for a cleaned text that is empty or too short, else null."""
    return F.when(cleaned == "", F.lit(K.EMPTY_TEXT)).when(
        words < K.MIN_WORDS, F.format_string(K.SHORT_TEXT, words, F.lit(K.MIN_WORDS))
    )


def join_messages(messages: Column) -> Column:
    """One message out of a list; blank items read as an invalid request."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.coalesce(F.nullif(m, F.lit("")), F.lit(K.INVALID_REQUEST)),
        ),
        ", ",
    )


def error_message(detail: Column, items: Column, fallback: Column) -> Column:
    """The message to show: the text as it is, else the joined list, else the fallback."""
    return F.coalesce(detail, join_messages(items), fallback)


def check_articles(articles: DataFrame) -> DataFrame:
    """Adds ``clean_text``, ``word_count``, ``code`` and ``reason``.

    ``code`` and ``reason`` are null for accepted rows. Articles over the length
    limits are rejected on the raw columns and never cleaned, which also bounds
    the cleaning work of a single row. So are rows that a column ``malformed`` marks.

    """
    headline, article = X.text_or_empty(F.col("headline")), X.text_or_empty(F.col("article"))
    unfit, cleaned, words = F.col("_unfit"), F.col("clean_text"), F.col("word_count")
    schema_error = length_error(headline, article)
    if "malformed" in articles.columns:
        schema_error = F.when(F.col("malformed"), K.INVALID_REQUEST).otherwise(schema_error)
    joined = articles.withColumn("_unfit", schema_error).withColumn(
        "_joined", F.when(unfit.isNull(), X.join_headline(headline, article))
    )
    return (
        compute_once(joined, {"clean_text": X.clean_news_text(F.col("_joined"))})
        .withColumn("word_count", X.word_count(cleaned))
        .withColumn(
            "code",
            F.when(unfit.isNotNull(), K.CODE_SCHEMA).when(
                (cleaned == "") | (words < K.MIN_WORDS), K.CODE_TEXT
            ),
        )
        .withColumn("reason", F.coalesce(unfit, text_error(cleaned, words)))
        .drop("_unfit", "_joined")
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("code").isNull()).drop("code", "reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("code").isNotNull()).drop(
        "headline", "article", "malformed", "clean_text", "word_count"
    )


def page_precheck(headline: Column, article: Column) -> Column:
    """The page's own test of the raw input: message or null.

    It may pass where :func:`check_articles` rejects, as cleaning drops words.
    """
    words = X.raw_word_count(F.concat_ws(" ", X.text_or_empty(headline), X.text_or_empty(article)))
    return F.when(words == 0, F.lit(K.PAGE_EMPTY)).when(
        words < K.MIN_WORDS, F.format_string(K.PAGE_SHORT, F.lit(K.MIN_WORDS), words)
    )


def word_count_label(headline: Column, article: Column) -> Column:
    total = X.raw_word_count(X.text_or_empty(headline)) + X.raw_word_count(
        X.text_or_empty(article)
    )
    return F.concat_ws(" ", total, F.when(total == 1, "word").otherwise("words"))
