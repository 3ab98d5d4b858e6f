"""Harmonic packing of documents into training sequences.

Lengths fall into reciprocal classes: class k has those above ``capacity / (k + 1)`` and up to
``capacity / k``, so that any k documents of it fit into one sequence. Every worker fills its
own bins; a bin of class k takes exactly k whole documents, whichever come next, and nothing
is shuffled. What a bin has left over is filled with pieces of documents that are longer than
a sequence and must be cut anyway. Only where a worker sees too few of these is a shorter document
cut up, that of the bin with the most room; bins wait for a while before that.

At its end a worker puts the documents of unfinished bins together, first fit by falling
length, and fills these likewise. What is left then is less than one sequence and is cut at
the binary digits of its length, as a sequence of a power of two needs no padding. So there is
none at all.

A worker holds less than one bin for each class, a bounded number of waiting bins and pieces
for a bounded number of sequences, and one document. Null and empty texts have the end id as
their only token. Texts of any length are cut as above. Repeated rows are packed each. An empty table gives no
sequences. Columns besides key and text play no part.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from presscheck.llm.tables import slices
from presscheck.llm.tokens import encoder

CAPACITY = 2048
SEQUENCES = (
    "sequence_id long, tokens array<int>, "
    "pieces array<struct<doc_id:long,start:long,length:long,offset:long,doc_tokens:long>>"
)
# Tokens per Arrow batch of sequences.
_BATCH = 1 << 19


# A document or a part of it: key, start in the document, length, length of the document, ids.
Piece = tuple[int | None, int, int, int, bytes]
# Bins that wait for pieces, and sequences for which pieces are kept ready.
WAITING, READY = 256, 32


class Bins:
    """The open bins of one worker. Its methods give sequences as lists of pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, list[Piece]] = {}
        self.waiting: list[tuple[int, list[Piece]]] = []
        self.pieces: deque[Piece] = deque()
        self.ready = 0

    def add(self, document: Piece) -> Iterator[list[Piece]]:
        length = document[2]
        if length > self.capacity:
            self._cut_up([document])
        else:
            count = self.capacity // length
            bin_ = self.open.setdefault(count, [])
            bin_.append(document)
            if len(bin_) < count:
                return
            self.waiting.append((self._room(bin_), self.open.pop(count)))
        if len(self.waiting) > WAITING and self.ready < min(b[0] for b in self.waiting):
            self._cut_up(self.waiting.pop(max(range(len(self.waiting)), key=lambda i: self.waiting[i][0]))[1])
        yield from self._fill()
        while self.ready > READY * self.capacity:
            yield self._take(self.capacity)

    def finish(self) -> Iterator[list[Piece]]:
        rest = sorted((d for bin_ in self.open.values() for d in bin_), key=lambda d: -d[2])
        self.open.clear()
        fitted: list[list] = []
        for document in rest:
            place = next((b for b in fitted if b[0] >= document[2]), None)
            if place is None:
                fitted.append(place := [self.capacity, []])
            place[0] -= document[2]
            place[1].append(document)
        self.waiting += [(room, bin_) for room, bin_ in fitted]
        self.waiting.sort(key=lambda b: -b[0])
        while self.waiting:
            yield from self._fill()
            if self.waiting:
                # The bin with the most room becomes pieces for the others.
                self._cut_up(self.waiting.pop(0)[1])
        while self.ready >= self.capacity:
            yield self._take(self.capacity)
        while self.ready:
            yield self._take(1 << (self.ready.bit_length() - 1))

    def _room(self, bin_: list[Piece]) -> int:
        return self.capacity - sum(d[2] for d in bin_)

    def _cut_up(self, documents: list[Piece]) -> None:
        self.pieces.extend(documents)
        self.ready += sum(d[2] for d in documents)

    def _fill(self) -> Iterator[list[Piece]]:
        """The waiting bins for which there are pieces enough, those with least room first."""
        if not self.waiting or self.ready < min(self.waiting, key=lambda b: b[0])[0]:
            return
        still = []
        for room, bin_ in sorted(self.waiting, key=lambda b: b[0]):
            if room <= self.ready:
                yield bin_ + self._take(room)
            else:
                still.append((room, bin_))
        self.waiting = still[::-1]

    def _take(self, length: int) -> list[Piece]:
        """Pieces of ``length`` ids in all, the first ones."""
        taken = []
        self.ready -= length
        while length:
            key, start, size, total, ids = self.pieces.popleft()
            own = min(size, length)
            taken.append((key, start, own, total, ids[: 4 * own]))
            if own < size:
                self.pieces.appendleft((key, start + own, size - own, total, ids[4 * own :]))
            length -= own
        return taken


class _Output:
    """Sequences on their way to an Arrow batch."""

    def __init__(self, first_id: int):
        self.next_id = first_id
        self.clear()

    def clear(self) -> None:
        self.ids, self.tokens, self.ends, self.pieces, self.piece_ends, self.size = [], [], [0], [], [0], 0

    def add(self, parts: list[tuple]) -> None:
        offset = 0
        for doc, start, length, total, ids in parts:
            self.pieces.append((doc, start, length, offset, total))
            self.tokens.append(ids)
            offset += length
        self.ids.append(self.next_id)
        self.next_id += 1
        self.size += offset
        self.ends.append(self.size)
        self.piece_ends.append(len(self.pieces))

    def batch(self) -> pa.RecordBatch:
        import numpy as np

        values = np.frombuffer(b"".join(self.tokens), "<u4").astype(np.int32)
        fields = zip(*self.pieces) if self.pieces else [[]] * 5
        names = ["doc_id", "start", "length", "offset", "doc_tokens"]
        pieces = pa.StructArray.from_arrays([pa.array(list(f), pa.int64()) for f in fields], names)
        arrays = [
            pa.array(self.ids, pa.int64()),
            pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(values)),
            pa.ListArray.from_arrays(pa.array(self.piece_ends, pa.int32()), pieces),
        ]
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, ["sequence_id", "tokens", "pieces"])


def _packer(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, True).encode
        out = _Output(TaskContext.get().partitionId() << 33)
        bins = Bins(capacity)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                keys = part["doc_id"].to_pylist()
                for key, ids in zip(keys, encode(part["text"].to_pylist())):
                    for sequence in bins.add((key, 0, len(ids) // 4, len(ids) // 4, ids)):
                        out.add(sequence)
                    if out.size >= _BATCH:
                        yield out.batch()
        for sequence in bins.finish():
            out.add(sequence)
            if out.size >= _BATCH:
                yield out.batch()
        if out.ids:
            yield out.batch()

    return run


def pack(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Sequences with their tokens and the pieces in them; ``path`` is a byte-level vocabulary."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    texts = documents.selectExpr(f"cast(`{key}` as long) as doc_id", f"cast(`{text}` as string) as text")
    return texts.mapInArrow(_packer(path, capacity), SEQUENCES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    import numpy as np

    for batch in batches:
        tokens, pieces = batch["tokens"], batch["pieces"]
        ids = tokens.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        starts = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))])
        owner = pieces.value_parent_indices().to_numpy(zero_copy_only=False)
        flat = pieces.flatten()
        begin = starts[owner] + flat.field("offset").to_numpy()
        end = begin + flat.field("length").to_numpy()
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
        arrays = [flat.field(c) for c in ("doc_id", "start", "length")]
        arrays += [pa.array(crc, pa.int64()), flat.field("doc_tokens"), batch["sequence_id"].take(pa.array(owner)), flat.field("offset")]
        yield pa.RecordBatch.from_arrays(
            arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        )


def piece_digests(sequences: DataFrame) -> DataFrame:
    """One row per piece, with the checksum of its ids as found in its sequence."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return sequences.mapInArrow(_digests, schema)
