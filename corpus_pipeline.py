"""Turns a document table into training sequences in five stages.

Each stage works on all rows that the one before kept. All stages but the last return
the columns of ``documents``, and other columns that a table has beside them; between stages
the rows are stored as Parquet in the shared folder and read again. An empty table stays
empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presscheck.llm import decontamination, line_dedup, near_duplicates, packing, toxicity
from presscheck.llm.queries import vocabulary
from presscheck.llm.tables import materialise, table

# Words in a shingle. With five, a few changed words part most near copies.
SHINGLE_WORDS = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go. The model is fitted on ``docs``.

    A probability of one half is not toxic. Null and empty texts are judged by the thresholds alone; rows with one key and
    repeated rows are judged each by their text. Labels without a document, or null, count for nothing.
    """
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that an earlier document or place has are cut out; emptied documents go.

    Earlier is by key, then by line. Null and empty texts stay. Rows with one key are one document, of which none is
    the later; rows without a key come first and stay whole.
    """
    return line_dedup.remove_repeats(docs, drop_emptied=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: two-word shingles as in the operator's query, a similarity of 0.8 or more.

    The one of the smallest key stays. Null and wordless texts are like no other and stay; so do rows without a key.
    """
    return near_duplicates.keep_one(docs, width=SHINGLE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark text, or all words of a shorter one, go.

    Null and wordless texts stay. Benchmark rows without a key or words match nothing.
    """
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, with the pieces of documents in them.

    Null and empty texts are the end id alone; rows of one key, repeated ones too, are packed each. Other columns go.
    """
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

# Fitted models, sketches and token ids take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
