"""Scoring each distinct text once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presscheck.operators.verdict_store import VerdictStore
from presscheck.session import materialise

HOT_COPIES = 100_000
# Most hot texts to broadcast; one takes about 100 bytes.
MAX_HOT_TEXTS = 1_000_000


def score_distinct(
    articles: DataFrame,
    text: str,
    score: Callable[[DataFrame], DataFrame],
    hot_copies: int = HOT_COPIES,
    keep_text: bool = True,
    store: VerdictStore | None = None,
) -> DataFrame:
    """``articles`` with the columns that ``score`` adds to a one-column text frame.

    ``score`` must depend on the text alone. Texts are known by 256 bits of hash, and null
    texts stay unscored. A text moves once, to be scored, and the results are joined back by
    hash. Without ``keep_text`` the column is dropped, and no copy of it moves in that join.

    A text with many copies would send all of them to one task of the join. Hashes with more
    than ``hot_copies`` rows are therefore spread over several salts, with as many copies of
    their score. The limit rises with the number of rows, so that at most ``MAX_HOT_TEXTS``
    hashes can exceed it and the list is safe to broadcast. ``articles`` is read several
    times; pass a stored table.

    With ``store``, texts that it knows from earlier batches are not scored again, and the
    others are added to it.
    """
    present = F.col(text).isNotNull()
    one = F.coalesce(F.col("_salts"), F.lit(1))
    digest = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    kept = [c for c in articles.columns if keep_text or c != text]
    hashed = articles.withColumn("_digest", digest).select(*kept, "_digest")
    rows = articles.select(F.count(F.lit(1)).alias("n")).scalar()
    limit = F.greatest(F.lit(hot_copies), F.ceil(rows / MAX_HOT_TEXTS))
    hot = (
        hashed.where(F.col("_digest").isNotNull())
        .groupBy("_digest")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > limit)
        .select("_digest", F.ceil(F.col("_copies") / limit).cast("int").alias("_salts"))
    )
    # Stored as both sides of the join use it.
    hot = F.broadcast(materialise(hot, "hot"))

    distinct = articles.where(present).groupBy(digest.alias("_digest")).agg(F.first(text).alias(text))
    known = None
    if store is not None:
        known = store.recall(hashed.select("_digest").where(F.col("_digest").isNotNull()).distinct())
        if known is not None:
            distinct = distinct.join(known.select("_digest"), "_digest", "left_anti")
    scored = score(distinct.select(text))
    added = [c for c in scored.columns if c != text]
    results = scored.select(digest.alias("_digest"), *added)
    if store is not None:
        results = store.add(results)
        results = results if known is None else results.unionByName(known)
    copies = (
        results.join(hot, "_digest", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
    )
    # The same for a row whenever its task is repeated. Null texts match nothing
    # and are spread out.
    spot = F.xxhash64(*kept, F.spark_partition_id())
    salted = hashed.join(hot, "_digest", "left").withColumn(
        "_salt", F.pmod(spot, F.when(F.col("_digest").isNotNull(), one).otherwise(1 << 20)).cast("int")
    )
    return salted.join(copies.drop("_salts"), ["_digest", "_salt"], "left").select(*kept, *added)
