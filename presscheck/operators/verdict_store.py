"""Verdicts on texts of earlier batches, kept by the hash of the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck.session import materialise

DIGEST = "_digest"
# Most hashes of a batch to broadcast, of 32 bytes each.
MAX_BROADCAST = 500_000


class VerdictStore:
    """A folder of verdicts, one part for each batch of a feed.

    A batch reads the parts before its own and overwrites its own, so a batch that is run
    again after a restart finds what it found before. A folder belongs to one feed and one
    pair of scorers. Parts are sorted by hash within files, which keeps their statistics
    narrow. Parts are not merged, so a feed of very many small batches should have a long trigger.
    """

    def __init__(self, spark: SparkSession, path: str, batch: int, max_broadcast: int = MAX_BROADCAST):
        self.spark, self.path, self.batch, self.max_broadcast = spark, path, batch, max_broadcast

    def recall(self, digests: DataFrame) -> DataFrame | None:
        """The stored verdicts for the hashes of this batch; None if nothing is stored.

        Hashes of a small batch are broadcast, so that the store is read in place and does
        not move. For larger ones Spark may filter the store by a Bloom filter of the hashes
        before it moves.
        """
        before = self._parts().where(F.col("batch") < self.batch) if self._exists() else None
        if before is None:
            return None
        wanted = materialise(digests, "digests")
        few = wanted.select(F.count(F.lit(1)).alias("n")).head().n <= self.max_broadcast
        found = before.drop("batch").join(F.broadcast(wanted) if few else wanted, DIGEST, "left_semi")
        return materialise(found, "recalled")

    def add(self, verdicts: DataFrame) -> DataFrame:
        """Stores this batch's new verdicts and reads them back."""
        part = f"{self.path}/batch={self.batch}"
        verdicts.sortWithinPartitions(DIGEST).write.mode("overwrite").parquet(part)
        return self.spark.read.schema(verdicts.schema).parquet(part)

    def _parts(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _exists(self) -> bool:
        """Whether an earlier batch has stored its part."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        batches = {int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(folder) or ()}
        return any(b < self.batch for b in batches)
