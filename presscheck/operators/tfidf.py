"""TF-IDF in relational form: one row per article and term.

Weights are the raw count times ``ln((1 + n) / (1 + df)) + 1``, divided by the
article's L2 norm over the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presscheck.functions.text import tokens
from presscheck.session import materialise

# Most terms to send to every task, and their most bytes: terms can be long where a
# script has no spaces. A row takes about 150 bytes besides its term.
BROADCAST_TERMS = 1_000_000
BROADCAST_BYTES = 200 << 20
TERM_BYTES = 150
# Terms with more than one in so many rows are joined where the rows are, and how many the
# sketch follows that finds them.
HEAVY_TERMS = 1_000
SKETCH_TERMS = 20_000
# Bytes of text of a task that counts terms; its counts take about 25 times as much memory.
PART_BYTES = 8 << 20


def smoothed_idf(documents: Column, document_frequency: Column) -> Column:
    return F.log((1.0 + documents) / (1.0 + document_frequency)) + 1.0


def count_terms(articles: DataFrame, terms: Column, min_df: int = 1) -> DataFrame:
    """``(term, df)`` of an array column, for terms in at least ``min_df`` articles.

    Each article gives a term once and counts are added up before the shuffle, so
    a frequent term sends one row per task. The empty term, which no article can
    contain, is added to each to count the articles in the same pass. The counts
    are stored in the shared folder.
    """
    each = F.array_append(F.array_distinct(F.filter(terms, lambda t: t != "")), F.lit(""))
    return materialise(
        articles.select(F.explode(each).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where((F.col("df") >= min_df) | (F.col("term") == "")),
        "terms",
    )


def fit_vocabulary(articles: DataFrame, text: str, min_df: int = 1) -> DataFrame:
    """``(term, df, idf)`` for terms in at least ``min_df`` articles."""
    counted = count_terms(articles, tokens(F.col(text)), min_df)
    documents = counted.where(F.col("term") == "").select("df").scalar()
    return counted.where(F.col("term") != "").withColumn(
        "idf", smoothed_idf(documents, F.col("df"))
    )


def _by_key(articles: DataFrame, keys: list[str], text: str) -> tuple[int, list[str]]:
    """For ``repartition``: as many parts as keep each within ``PART_BYTES`` of text, and the keys.

    A number that is given is kept, where Spark would else gather parts by their compressed size.
    """
    size = articles.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).head()[0]
    cores = articles.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-size // PART_BYTES)), keys


def term_counts(articles: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys, term, tf)``.

    Moves the texts once, partitioned by key. The grouping here and the norm in
    :func:`tfidf` find their rows in place, within the same memory for any number of texts.
    """
    parts, by = _by_key(articles, keys, text)
    return (
        articles.select(*keys, text)
        .repartition(parts, *by)
        .select(*keys, F.explode(tokens(F.col(text))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _most_frequent(vocabulary: DataFrame) -> Column:
    """True for the terms to broadcast: all, or the most frequent within both bounds.

    Frequencies are told apart by their power of two, of which there are few.
    """
    power = F.floor(F.log2(F.greatest(F.col("df"), F.lit(1)))).cast("int")
    sizes = vocabulary.groupBy(power.alias("power")).agg(
        F.count(F.lit(1)).alias("terms"), F.sum(F.octet_length("term") + TERM_BYTES).alias("bytes")
    )
    lowest, terms, size = 64, 0, 0
    for row in sorted(sizes.collect(), key=lambda r: -r.power):
        terms, size = terms + row.terms, size + row.bytes
        if terms > BROADCAST_TERMS or size > BROADCAST_BYTES:
            break
        lowest = row.power
    return power >= lowest


def _heavy_terms(rows: DataFrame) -> DataFrame:
    """``(term)`` for the terms that hold more than a small share of the rows.

    From a sketch of frequent items that tasks fill and Spark merges; it may name a term too
    many, but misses none with more than ``1 / HEAVY_TERMS`` of the rows. At most ``HEAVY_TERMS`` come back.
    """
    sketch = F.expr(f"approx_top_k(term, {HEAVY_TERMS}, {SKETCH_TERMS})")
    found = rows.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top"))
    often = found.select("n", F.inline("top")).where(F.col("count") * HEAVY_TERMS > F.col("n"))
    return often.select(F.col("item").alias("term"))


def _attach(rows: DataFrame, vocabulary: DataFrame, wanted: list[str]) -> DataFrame:
    """``rows`` whose ``term`` is known, with the ``wanted`` columns of the vocabulary.

    The most frequent terms, which nearly all rows hold, are joined where the rows are.
    Only rows of rarer terms move, and none of these is hot.
    """
    terms = vocabulary.select("term", *wanted)
    if "df" not in vocabulary.columns:
        bounded = vocabulary.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + TERM_BYTES), F.lit(0))).head()
        if bounded[0] <= BROADCAST_TERMS and bounded[1] <= BROADCAST_BYTES:
            return rows.join(F.broadcast(terms), "term")
        # Without frequencies the rows themselves say which terms would fill one task.
        rows = materialise(rows, "rows")
        heavy = F.broadcast(materialise(_heavy_terms(rows), "heavy"))
        common, rare = terms.join(heavy, "term", "left_semi"), terms.join(heavy, "term", "left_anti")
        return rows.join(F.broadcast(common), "term").unionByName(
            rows.join(heavy, "term", "left_anti").join(rare, "term")
        )
    frequent = _most_frequent(vocabulary)
    rare = vocabulary.where(~frequent).select("term", *wanted)
    common = vocabulary.where(frequent).select("term", *wanted)
    if rare.isEmpty():
        return rows.join(F.broadcast(common), "term")
    here = F.broadcast(common.select("term"))
    return rows.join(F.broadcast(common), "term").unionByName(
        rows.join(here, "term", "left_anti").join(rare, "term")
    )


def _counts_with_rare(
    articles: DataFrame, keys: list[str], text: str, common: DataFrame, rare: DataFrame, wanted: list[str]
) -> DataFrame:
    """``(keys, term, tf)`` with the ``wanted`` columns of the vocabulary; terms it lacks are dropped.

    Terms that are not common go to the rare ones, and what these know goes along with the
    texts, which so move once here too. The counts of common terms do not move at all.
    """
    parts, by = _by_key(articles, keys, text)
    words = articles.select(*keys, F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))
    found = words.join(F.broadcast(common.select("term")), "term", "left_anti").join(rare.select("term", *wanted), "term")
    told = found.select(*keys, F.lit(None).cast("string").alias("_text"), F.struct("term", *wanted).alias("_rare"))
    kind = dict(told.dtypes)["_rare"]
    moved = articles.select(*keys, F.col(text).alias("_text"), F.lit(None).cast(kind).alias("_rare"))
    moved = moved.unionByName(told).repartition(parts, *by)
    types = dict(rare.dtypes)

    def counted(term: Column) -> Column:
        unknown = [F.lit(None).cast(types[c]).alias(c) for c in wanted]
        return F.struct(term.alias("term"), *unknown, F.lit(1).alias("n"))

    of_rare = F.array(F.struct(*[F.col("_rare")[c].alias(c) for c in ("term", *wanted)], F.lit(0).alias("n")))
    entries = F.when(F.col("_rare").isNull(), F.transform(tokens(F.col("_text")), counted)).otherwise(of_rare)
    counts = moved.select(*keys, F.inline(entries)).groupBy(*keys, "term").agg(
        F.sum("n").alias("tf"), *[F.max(c).alias(f"_{c}") for c in wanted]
    )
    known = counts.join(F.broadcast(common), "term", "left")
    values = [F.coalesce(c, f"_{c}").alias(c) for c in wanted]
    return known.select(*keys, "term", "tf", *values).where(F.col(wanted[0]).isNotNull())


def _weighed(known: DataFrame, keys: list[str], index: list[str]) -> DataFrame:
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(W.partitionBy(*keys)))
    return known.select(*keys, "term", (raw / norm).alias("weight"), *index)


def weigh(counts: DataFrame, keys: list[str], vocabulary: DataFrame) -> DataFrame:
    """:func:`tfidf` of terms that are counted."""
    index = [c for c in ("index",) if c in vocabulary.columns]
    return _weighed(_attach(counts, vocabulary, ["idf", *index]), keys, index)


def tfidf(articles: DataFrame, keys: list[str], text: str, vocabulary: DataFrame) -> DataFrame:
    """``(keys, term, weight)`` for the terms of the vocabulary, and ``index`` if it has one.

    ``articles`` is read more than once; pass a stored table. Its texts move once. Counts of terms
    stay where they are, but for those of rarer terms than can be sent to every task.
    """
    index = [c for c in ("index",) if c in vocabulary.columns]
    wanted = ["idf", *index]
    if "df" not in vocabulary.columns:
        return weigh(term_counts(articles, keys, text), keys, vocabulary)
    frequent = _most_frequent(vocabulary)
    rare = vocabulary.where(~frequent).select("term", *wanted)
    common = vocabulary.where(frequent).select("term", *wanted)
    if rare.isEmpty():
        known = term_counts(articles, keys, text).join(F.broadcast(common), "term")
    else:
        known = _counts_with_rare(articles, keys, text, common, rare, wanted)
    return _weighed(known, keys, index)


def index_terms(vocabulary: DataFrame) -> DataFrame:
    """``index`` and the columns of the vocabulary: the terms in order, counted from 0.

    Terms are cut into ranges, numbered within their range and shifted by the size
    of the ranges before it, so no task sees them all. The ranges are stored first;
    their bounds come from a sample and could differ between two evaluations.
    """
    ranged = materialise(
        vocabulary.repartitionByRange("term")
        .withColumn("_range", F.spark_partition_id()),
        "terms",
    )
    # One row per range, at most spark.sql.shuffle.partitions of them.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(W.partitionBy("_range").orderBy("term")) - 1
    return ranged.join(F.broadcast(starts), "_range").select(
        (F.col("_start") + place).alias("index"), *vocabulary.columns
    )


def align(weights: DataFrame, keys: list[str], features: DataFrame | None = None) -> DataFrame:
    """Weights in the order a model was trained with.

    ``features`` is ``(index, term)``; weights from an indexed vocabulary have their index
    already. Terms unknown to the model are dropped; the result is ``(keys, indices,
    weights)``, sorted by index, one row per article.
    """
    if features is not None:
        weights = _attach(weights.drop("index"), features, ["index"])
    entries = F.array_sort(F.collect_list(F.struct("index", "weight")))
    return (
        weights.groupBy(*keys)
        .agg(entries.alias("entries"))
        .select(
            *keys,
            F.col("entries.index").alias("indices"),
            F.col("entries.weight").alias("weights"),
        )
    )


def feature_mismatches(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Positions at which two ``(index, term)`` lists differ; empty if they are equal."""
    left = saved.select("index", F.col("term").alias("saved_term"))
    right = current.select("index", F.col("term").alias("current_term"))
    return left.join(right, "index", "full_outer").where(
        ~F.col("saved_term").eqNullSafe(F.col("current_term"))
    )


def feature_digest(features: DataFrame) -> str:
    """One short text for an ``(index, term)`` list, the same for equal lists only.

    Each row hashes its index with its term, so two terms that change places change the
    digest. The hashes are added up, in any order and part by part.
    """
    def total(seed: int):
        mark = F.xxhash64(F.lit(seed), F.col("index").cast("long"), "term").cast("decimal(38,0)")
        return F.coalesce(F.sum(mark), F.lit(0)).cast("string")

    row = features.agg(F.count(F.lit(1)).cast("string"), total(1), total(2)).head()
    return ":".join(row)
