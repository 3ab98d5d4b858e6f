"""Near duplicates by sketches, banding and exact verification.

1. Every document's set of word shingles is sketched by rounds of hashed bin placement.
   Documents with equal sets form a class, which its smallest key stands for.
2. Bands of the sketch coordinates put classes into buckets. Two sets at the threshold
   of 80 % share one of the 40 bands of 6 with a probability of all but 5 in a million.
   Lower thresholds take more or shorter bands with the same probability; higher ones
   take those of 80 %.
3. In each bucket the member that meets most others is the centre. Every member is
   compared, on the full sets, with the best of its centres. This links almost all of
   a group at a cost in proportion to its size.
4. Members of a bucket that are still apart are compared in blocks, each pair once;
   only links leave a block.
5. Components of the links give the result.

Words end at white space, with A-Z lower-cased. Null texts and texts without words have
an empty set and are linked with nothing. A text of fewer words than a shingle is one
shingle. Rows with the same key are one document. A row with a null key belongs to the
component of its class and is not kept, or, if no row with a key has its set, has none
and is kept. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presscheck.llm.components import components
from presscheck.llm.shingles import band_hashes, fast_sketches, set_keys, shingle_sets
from presscheck.llm.tables import free_name, materialise, slices, text_bytes

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 40, 6
# The most that two sets at the threshold may miss each other with, and the coordinates for it.
MISS = 5.3e-6
COORDINATES = 300
# Members of about that number are held at once while the others stream past them.
BLOCK = 512


def banding(percent: int) -> tuple[int, int]:
    """Bands and their rows for a threshold: the longest bands that fit the coordinates."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be above 0 and at most 100: {percent}")
    if percent >= PERCENT:
        return BANDS, ROWS
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))
        if rows == 1 or bands * rows <= COORDINATES:
            return bands, rows


def _sketcher(width: int, count: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = text_bytes(part["text"])
                values, first = shingle_sets(data, bounds, width)
                sizes = np.diff(first)
                bands = band_hashes(fast_sketches(values, first, count * rows), rows)
                keys, empty = set_keys(values, first), sizes == 0
                packed = [None if e else row.tobytes() for e, row in zip(empty.tolist(), bands)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(sizes, pa.int64()),
                        *[pa.array(k.view(np.int64), mask=empty) for k in keys],
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "key1", "key2", "bands"],
                )

    return run


def sketches(texts: DataFrame, width: int, percent: int = PERCENT) -> DataFrame:
    schema = "doc_id long, n_shingles long, key1 long, key2 long, bands binary"
    return texts.mapInArrow(_sketcher(width, *banding(percent)), schema)


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        rows = np.frombuffer(b"".join(batch["bands"].to_pylist()), np.int64)
        node = np.repeat(batch["node"].to_numpy(), len(rows) // max(1, len(batch)))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(node)], ["bucket", "node"])


def _set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, first = shingle_sets(*text_bytes(part["text"]), width)
                packed = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part["node"], pa.array(packed, pa.binary())], ["node", "shingles"])

    return run


def _linked(a, b, percent: int) -> bool:
    """True if two sorted sets have at least ``percent`` of their union in common."""
    import numpy as np

    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _star_checker(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            pairs = zip(batch["shingles"].to_pylist(), batch["of_centre"].to_pylist())
            good = [_linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _block_checker(percent: int):
    """Rows come by block, those of the block's own members first.

    A pair is compared in the block of its smaller node, if the two share a band and are
    not connected yet, be it by a link found here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        block, parent = None, {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            found = []
            for row in batch.to_pylist():
                own = np.frombuffer(row["bands"], np.int64)
                if row["block"] != block:
                    block, parent = row["block"], {}
                    held, sets, bands = [], [], np.zeros((BLOCK, len(own)), np.int64)
                node, part = row["node"], row["component"]
                shingles = np.frombuffer(row["shingles"], np.uint64)
                if row["own"]:
                    if len(held) == len(bands):
                        bands = np.concatenate([bands, np.zeros_like(bands)])
                    bands[len(held)] = own
                    held.append((node, part))
                    sets.append(shingles)
                for i in np.flatnonzero((bands[: len(held)] == own).any(axis=1)).tolist():
                    other, of = held[i]
                    if other < node and root(of) != root(part) and _linked(sets[i], shingles, percent):
                        parent[root(of)] = root(part)
                        found.append((other, node))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return run


def links(texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``(a, b)`` between classes: enough links to connect all that are connected."""
    rows = classes.select("node", "bands").mapInArrow(_bucket_rows, "bucket long, node long")
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = materialise(rows.join(shared, "bucket"), "buckets")
    met = buckets.groupBy("node").agg(F.sum("members").alias("met"))
    met = materialise(met, "met")
    sets = materialise(
        texts.select(F.col("doc_id").alias("node"), "text")
        .join(met.select("node"), "node", "left_semi")
        .mapInArrow(_set_maker(width), "node long, shingles binary"),
        "sets",
    )

    # The best centre of each member, and the comparison with it.
    ranked = buckets.join(met, "node").select("bucket", "node", F.struct("met", "node").alias("rank"))
    centre = ranked.groupBy("bucket").agg(F.max("rank").alias("centre"))
    best = materialise(
        ranked.join(centre, "bucket")
        .where(F.col("node") != F.col("centre.node"))
        .groupBy("node")
        .agg(F.max("centre").alias("centre"))
        .select(F.col("node").alias("a"), F.col("centre.node").alias("b")),
        "centres",
    )
    of_centre = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_centre"))
    compared = best.join(of_centre, "b").join(sets.withColumnRenamed("node", "a"), "a")
    star = materialise(
        compared.select("a", "b", "shingles", "of_centre").mapInArrow(_star_checker(percent), "a long, b long"), "links"
    )

    # What is still apart within a bucket.
    joined = components(star)
    placed = buckets.join(joined, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    open_buckets = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("bucket")
    )
    open_rows = materialise(placed.join(open_buckets, "bucket"), "open")
    # Members with the same centre share a block, or several if they are many, so that
    # few members have partners in many blocks.
    centred = open_rows.select("node").distinct().join(best, F.col("node") == F.col("a"), "left")
    centred = centred.select("node", F.coalesce("b", "node").alias("centre"))
    parts = centred.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    homes = centred.join(parts, "centre").select(
        "node", F.xxhash64("centre", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("home")
    )
    open_rows = materialise(open_rows.join(homes, "node"), "open")
    of_bucket = open_rows.groupBy("bucket").agg(F.collect_set("home").alias("blocks"))
    sent = (
        open_rows.join(of_bucket, "bucket")
        .groupBy("node", "component", "home")
        .agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
        .select("node", "component", "home", F.explode("blocks").alias("block"))
    )
    bands = classes.select("node", "bands")
    streamed = (
        sent.select("node", "component", "block", (F.col("block") == F.col("home")).alias("own"))
        .join(bands, "node")
        .join(sets, "node")
        .repartition("block")
        .sortWithinPartitions("block", F.desc("own"), "node")
        .select("block", "own", "node", "component", "bands", "shingles")
    )
    return star.unionByName(streamed.mapInArrow(_block_checker(percent), "a long, b long"))


def find(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every document."""
    texts = documents.selectExpr(f"cast(`{key}` as long) as doc_id", f"cast(`{text}` as string) as text")
    sketched = materialise(sketches(texts, width, percent), "sketches")
    classes = materialise(
        sketched.where("key1 is not null")
        .groupBy("key1", "key2")
        .agg(F.min("doc_id").alias("node"), F.min("bands").alias("bands"))
        .where("node is not null"),
        "classes",
    )
    found = components(links(texts, classes, width, percent))
    of_class = (
        classes.join(found, "node", "left")
        .select("key1", "key2", F.coalesce("component", "node").alias("component_id"))
    )
    of_row = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        sketched.join(of_class, ["key1", "key2"], "left")
        .select("doc_id", "n_shingles", of_row.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without all but the smallest key of each group of near duplicates."""
    name = free_name("_gone", documents)
    gone = find(documents, key, text, **options).where("not kept and doc_id is not null").select(F.col("doc_id").alias(name))
    return documents.join(gone, documents[key].cast("long") == F.col(name), "left_anti")
