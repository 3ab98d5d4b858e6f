"""Benchmark passages in training documents, found by shared word windows.

The windows of the benchmark texts go to the workers as sorted arrays of hashes.
Each worker hashes every window of its documents, looks the hashes up, compares
each hit word by word, and marks the words under a confirmed window.

Words are runs of digits, letters and characters beyond ASCII; A-Z is lower-cased.
A text of fewer words than a window, but not none, is a window by itself.

Null and empty texts have no words and are not contaminated. Repeated rows are
marked alike. Other columns of the documents pass through; one that has the name of
the result is replaced. An empty benchmark marks nothing. Items with a null key or
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from presscheck.llm.tables import free_name, share, shared, slices, text_bytes
from presscheck.llm.words import Words, alphanumeric, lower_table, ngram_hashes, whole_ngrams

WIDTH = 10
# Benchmark text per block. A block goes to the driver and to every worker, and the
# documents pass once through each block.
BLOCK_BYTES = 4 << 20
FOUND = "contamination"
FOUND_TYPE = "struct<n_words:long,n_hit:long,spans:array<struct<start:long,end:long>>,items:array<long>>"


class Windows:
    """The windows of some benchmark texts, by length and sorted by hash."""

    def __init__(self, items: list[tuple[int, str]], width: int):
        column = pa.array([text for _, text in items], pa.string())
        data, bounds = text_bytes(column)
        self.words = Words(lower_table()[data], bounds, alphanumeric())
        self.items = np.array([item for item, _ in items], np.int64)[self.words.doc] if items else np.zeros(0, np.int64)
        hashes = self.words.hashes()
        counts, first = self.words.counts, self.words.first[:-1]
        self.by_length = {}
        for n in {width, *map(int, counts[(counts > 0) & (counts < width)])}:
            if n == width:
                at = whole_ngrams(self.words.first, n, len(self.words))
            else:
                at = first[counts == n]
            value = ngram_hashes(hashes, n)[at]
            order = np.argsort(value, kind="stable")
            if len(order):
                bits = max(10, int(len(order) * 8).bit_length())
                seen = np.zeros(1 << bits, bool)
                seen[value >> np.uint64(64 - bits)] = True
                self.by_length[n] = (value[order], at[order], seen, np.uint64(64 - bits))

    def mark(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """The words under a window, and the items found in each text."""
        hit = np.zeros(len(words) + 1, np.int64)
        found: dict[int, set[int]] = {}
        for n, (values, at, seen, shift) in self.by_length.items():
            own = ngram_hashes(hashes, n)
            likely = np.flatnonzero(seen[own >> shift]) if len(own) else np.zeros(0, np.int64)
            likely = likely[words.doc[likely] == words.doc[likely + n - 1]]
            low = np.searchsorted(values, own[likely])
            high = np.searchsorted(values, own[likely], "right")
            for i, a, b in zip(likely[low < high], low[low < high], high[low < high]):
                text = words.text(i, i + n)
                same = [j for j in at[a:b] if self.words.text(j, j + n) == text]
                if same:
                    hit[i] += 1
                    hit[i + n] -= 1
                    found.setdefault(int(words.doc[i]), set()).update(self.items[same].tolist())
        return np.cumsum(hit[:-1]) > 0, found


def _marker(windows, text: str, carried: list[str], out: str):
    """Adds one block's hits to the hits of the blocks before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, lower, is_word = shared(windows), lower_table(), alphanumeric()
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        fields = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.int64()))]
        for batch in batches:
            for part in slices(batch, text):
                data, bounds = text_bytes(part[text])
                words = Words(lower[data], bounds, is_word)
                hit, found = index.mark(words, words.hashes())
                earlier = part[out].to_pylist() if out in part.schema.names else None
                rows = []
                for d, n in enumerate(words.counts.tolist()):
                    own, items, spans = hit[words.first[d] : words.first[d + 1]], found.get(d, set()), []
                    if earlier:
                        for before in earlier[d]["spans"]:
                            own[before["start"] : before["end"]] = True
                        items = items | set(earlier[d]["items"])
                    if items:
                        edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).reshape(-1, 2)
                        spans = [{"start": a, "end": b} for a, b in edges.tolist()]
                    rows.append({"n_words": n, "n_hit": int(own.sum()), "spans": spans, "items": sorted(items)})
                arrays = [part[c] for c in carried] + [pa.array(rows, pa.struct(fields))]
                yield pa.RecordBatch.from_arrays(arrays, [*carried, out])

    return run


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about ``BLOCK_BYTES``, each fetched by itself."""
    known = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("item"), F.col(text).alias("text")
    )
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    count = -(-size // BLOCK_BYTES)
    for block in range(count):
        part = known.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        yield [(row.item, row.text) for row in part.toLocalIterator()]


def find(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    out: str = FOUND,
    carry: list[str] | None = None,
) -> DataFrame:
    """The ``carry`` columns of ``documents`` (all, unless given) and the struct ``out``.

    It holds ``n_words``, ``n_hit`` (words under a window), ``spans`` (their runs, as
    word numbers from ``start`` to before ``end``) and ``items`` (keys of the benchmark
    texts with a window in the document). No shuffle: the documents stay where they
    were read.
    """
    carry = [c for c in (documents.columns if carry is None else carry) if c != out]
    columns = [*[c for c in carry if c != text], text]
    frame = documents.select(*columns)
    indexes = [Windows(b, width) for b in _blocks(benchmark, item_key, item_text)] or [Windows([], width)]
    for i, index in enumerate(indexes):
        kept = columns if i + 1 < len(indexes) else carry
        schema = StructType(documents.select(*kept).schema.fields).add(out, DataType.fromDDL(FOUND_TYPE))
        frame = frame.mapInArrow(_marker(share(documents.sparkSession, index), text, kept, out), schema)
    return frame


def _cutter(text: str, columns: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, is_word = lower_table(), alphanumeric()
        for batch in batches:
            for part in slices(batch, text):
                data, bounds = text_bytes(part[text])
                words = Words(lower[data], bounds, is_word)
                texts = part[text].to_pylist()
                for d, spans in enumerate(part[out].field("spans").to_pylist()):
                    if spans:
                        place, kept = bounds[d], []
                        for span in spans:
                            a, b = words.first[d] + span["start"], words.first[d] + span["end"] - 1
                            kept.append(data[place : words.start[a]].tobytes())
                            place = words.end[b]
                        kept.append(data[place : bounds[d + 1]].tobytes())
                        texts[d] = b"".join(kept).decode()
                arrays = [pa.array(texts, part[text].type) if c == text else part[c] for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return run


def remove_spans(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with the text of each span of hit words cut out."""
    out = free_name(FOUND, documents)
    found = find(documents, benchmark, text, out=out, **options)
    return found.mapInArrow(_cutter(text, documents.columns, out), documents.schema)


def remove_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that share no window with the benchmark."""
    out = free_name(FOUND, documents)
    found = find(documents, benchmark, text, out=out, **options)
    return found.where(F.col(out)["n_hit"] == 0).select(*documents.columns)
