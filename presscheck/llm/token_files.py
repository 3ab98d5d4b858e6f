"""Token ids in Parquet, in key order, for whole or selective reads.

A table is a folder of files, each one range of keys in ascending order. Columns:
the key, ``part`` (number of the range), ``offset`` (ids of the part before this
document), ``n_tokens`` and ``tokens``. Ids are dictionary-encoded in two bytes or
less, or delta-encoded; row groups and pages are kept small, and each page's key range
is in the page index, so a reader of some documents, or of the counts alone, skips the
other pages and columns.

Null and empty texts are stored with the end id only. Null keys come first. Repeated
rows are stored each. Columns of the documents besides key and text are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck.llm.tables import slices
from presscheck.llm.tokens import encoder

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 512
SCHEMA = "doc_id long, part int, offset long, n_tokens long, tokens array<int>"


def _tokenizer(path: str, blanks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode, part, offset = encoder(path, blanks).encode_flat, TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text", 2 << 20):
                values, ends = encode(rows["text"].to_pylist())
                ends = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"],
                        pa.array(np.full(len(ends) - 1, part, np.int32)),
                        pa.array(ends[:-1] + offset),
                        pa.array(np.diff(ends)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32))),
                    ],
                    ["doc_id", "part", "offset", "n_tokens", "tokens"],
                )
                offset += int(ends[-1])

    return run


def write(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    blanks: bool = False,
    key: str = "doc_id",
    text: str = "text",
    delta: bool = False,
) -> None:
    """Tokenises ``documents`` and stores the ids under ``path``.

    ``blanks`` tells that tokens of the vocabulary may begin with a blank. The texts
    move once, to their range of keys, and are tokenised there.
    """
    texts = documents.selectExpr(f"cast(`{key}` as long) as doc_id", f"cast(`{text}` as string) as text")
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    element = "tokens.list.element"
    (
        ordered.mapInArrow(_tokenizer(vocabulary, blanks), SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option(f"parquet.enable.dictionary#{element}", str(not delta).lower())
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def starts(tokens: DataFrame) -> DataFrame:
    """``(part, base)``: the ids before each part, from the counts alone.

    One row per part, of which there are as many as the writing job had tasks.
    """
    from pyspark.sql import Window

    sizes = tokens.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        ids = batch["tokens"].flatten().to_numpy(zero_copy_only=False).astype("<u4")
        crc, start = [], 0
        for n in batch["tokens"].value_lengths().to_pylist():
            crc.append(zlib.crc32(ids[start : start + n]))
            start += n
        columns = ["doc_id", "part", "offset", "n_tokens"]
        yield pa.RecordBatch.from_arrays(
            [*[batch[c] for c in columns], pa.array(crc, pa.int64())], [*columns, "ids_crc32"]
        )


def digests(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every stored document."""
    schema = "doc_id long, part int, offset long, n_tokens long, ids_crc32 long"
    return (
        tokens.mapInArrow(_digests, schema)
        .join(F.broadcast(starts(tokens)), "part")
        .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
    )
