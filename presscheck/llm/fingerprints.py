"""Document fingerprints: the smallest hashes of a text's word shingles.

A fingerprint is the sorted array of the ``SIZE`` smallest of the distinct 64-bit
shingle hashes, or of all if there are fewer. That of two parts together is made from
their fingerprints alone. Two fingerprints tell how alike two sets are, how much of one
is in the other, and one tells how many shingles there are; all three are exact for sets
that fit whole.

Words end at white space. A text of fewer words than a shingle, but not none, has its
whole sequence as its only shingle. Null and empty texts have the empty fingerprint; two
empty ones are alike to 1, an empty and another to 0. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presscheck.operators.once import compute_once

WIDTH = 5
SIZE = 128
# Bytes of text per range of keys in :func:`with_next`.
RANGE_BYTES = 16 << 20
MAX_RANGES = 1 << 16


def fingerprint(text: Column, width: int = WIDTH, size: int = SIZE) -> Column:
    """The fingerprint of a text, as an array of longs."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+", -1), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        count = F.size(h)
        several = F.transform(
            F.sequence(F.lit(0), F.greatest(count - width, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]),
        )
        # Fewer words: those that are missing count as null, and the count tells lengths apart.
        short = F.array(F.xxhash64(F.lit(-1), count, *[F.get(h, F.lit(k)) for k in range(width)]))
        return F.when(count >= width, several).when(count > 0, short).otherwise(F.slice(short, 1, 0))

    distinct = F.array_distinct(F.get(F.transform(F.array(hashes), shingles), F.lit(0)))
    return F.slice(F.sort_array(distinct), 1, size)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The fingerprint of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge(parts: DataFrame, key: str, sketch: str, size: int = SIZE) -> DataFrame:
    """``(key, sketch)``: the fingerprint of all parts of each key.

    Hashes are made distinct and cut to the smallest before the shuffle, so a key with
    very many parts sends little. Keys whose parts are all empty are left out.
    """
    hashes = parts.select(key, F.explode(sketch).alias("_hash")).distinct()
    rank = F.row_number().over(W.partitionBy(key).orderBy("_hash"))
    kept = hashes.withColumn("_rank", rank).where(F.col("_rank") <= size)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def shingle_count(sketch: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    # How far into the range of hashes the last one lies, from 0 to 1.
    share = (F.get(sketch, F.lit(size - 1)).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) / share)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the union that both sets have, from 0 to 1."""

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
        return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))

    return F.get(F.transform(F.array(merged(a, b, size)), share), F.lit(0))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of the first set that the second has too, from 0 to 1."""
    union = shingle_count(merged(a, b, size), size)
    both = resemblance(a, b, size) * union
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / shingle_count(a, size)))


def as_text(sketch: Column) -> Column:
    """A fingerprint as hexadecimal digits, 16 for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _range_of(key: Column, ends: Column, count: int) -> Column:
    """How many of the ``count`` sorted ends lie below the key, by binary search; null is 0."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(count, 1).bit_length()))])
    below = lambda at: F.coalesce(F.get(ends, at) < key, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at + step - 1), at + step).otherwise(at))


def with_next(documents: DataFrame, key: str, text: str, size: int = SIZE, width: int = WIDTH) -> DataFrame:
    """``_key``, ``text`` and ``sketch`` of every row, and ``next_text`` and ``next_sketch``
    of the row with the next smaller key.

    The row with the smallest key is followed by the one with the largest, and a single
    row by itself. Rows with a null key come last, in the order of a hash, as do rows with
    equal keys. Keys are cut into ranges that end at a key; each range gets a copy of the
    row that follows its last one, so the texts move once.
    """
    keyed = documents.select(
        F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    total, top = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.max("_key")).head()
    ranges = min(max(1, -(-total // RANGE_BYTES)), MAX_RANGES)
    cuts = [i / ranges for i in range(1, ranges)]
    found = keyed.agg(F.percentile_approx("_key", cuts, max(10_000, 10 * ranges))).head()[0] if cuts else None
    bounds = sorted(set(found or []) - {top})
    ends = F.lit(bounds) if bounds else F.array().cast("array<long>")
    # Range 0 holds the smallest keys, and nulls.
    place = _range_of(F.col("_key"), ends.cast("array<long>"), len(bounds))
    follows = F.when(F.array_contains(ends, F.col("_key")), place + 1).when(F.col("_key") == F.lit(top), F.lit(0))
    places = F.array(F.struct(place.alias("range"), F.lit(False).alias("copy")), F.struct(follows.alias("range"), F.lit(True).alias("copy")))
    sent = keyed.select("_key", "text", F.inline(F.filter(places, lambda p: p["range"].isNotNull())))
    ranged = compute_once(sent.repartition("range"), {"sketch": fingerprint(F.col("text"), width, size)})
    order = W.partitionBy("range").orderBy("copy", F.desc_nulls_last("_key"), F.xxhash64("text"))
    return ranged.select(
        "_key",
        "text",
        "sketch",
        "copy",
        F.lead("text").over(order).alias("next_text"),
        F.lead("sketch").over(order).alias("next_sketch"),
    ).where("not copy").drop("copy")
