"""Interpolated modified Kneser-Ney models of orders two and three of a corpus, and scores by them.

Words: they are numbered first. Each task counts the words of its texts and deals them out
by their hash; a bucket stores the sorted hashes with the words' ranks by frequency, and rank
and bucket make the number. Frequent words so have small numbers, which take few bits on the
way and in the model, in a corpus of any size.

Counting: each task counts the pairs of neighbouring tokens in its texts and deals them
out by a hash of the pair, so a frequent word is spread over all buckets. What goes to a
bucket is sorted and compressed. A bucket adds up its pairs, stores them as two arrays, the
sorted hashes and their counts, and passes on what it knows of each word: how often it occurs,
after how many different words, how often and before how many different words it stands. These
are added up and stored by the word's number. Only a row of totals for each bucket goes to the
driver.

At order three each task counts triples and deals them out by a hash of their first two
tokens. These two are a pair of the same bucket, unless the second is an end, which nothing
follows. So a bucket stores of its triples, in the order of the pairs, the number of the last
word, the count, and a bit where another pair begins; and for pairs of which that does not tell
it, how many triples of each count follow them. It passes on each pair of last tokens with its
count and the number of different tokens before it. The former give the model of order two, the
latter the middle level of the model of order three. Pairs after the start, which nothing stands
before, keep their counts at that level.

Scoring: workers map the arrays into memory and look the pairs and words of their texts
up in sorted batches; the operating system keeps what is in use. The folder of the model
must therefore be one that all workers can open as files, as for counting.

A text is its words, which end at white space, with A-Z lower-cased, and one end token.
The first word stands after a start that is no token. A pair's probability is the
discounted share of the pair among those with the same first word, plus the rest times
the probability of the second word: its discounted share of all different pairs, plus the
rest spread evenly over the known tokens and one unknown. At order three, it is the
discounted share of the triple, plus the rest times the probability of the pair from the
middle level; a first word has no triple and that probability alone. All texts count, whatever their
length; null and empty texts are an end token. Repeated rows count and score each. From an
empty corpus every token is unknown, with probability 1.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from presscheck.llm.tables import SLICE_BYTES, scratch_path, share, shared, slices, text_bytes
from presscheck.llm.words import Words, lower_table, mix, not_space

# Bytes of text per bucket. Buckets grow in number only, so a task holds as much at any size.
BUCKET_BYTES = 16 << 20
# Tokens that a task counts before it deals out pairs.
_FLUSH = 4_000_000
_FLUSH_TRIPLES = 2_500_000
ORDER = 3
# Words are known by 48 bits of hash, and then by a number. The end and the start have values of their
# own, the same as numbers; unknown words have the number 0.
END, START = np.uint64(1), np.uint64(2)
_FIRST = 3
# Stored keys of which the first is kept whole, and the others as what they are above it.
_BLOCK = 16
_BITS = np.uint64(48)
WORD_FIELDS = ("occurs", "after", "stands", "before1", "before2", "before3", "middle", "middle1", "middle2", "middle3")
OUT = "struct<n_tokens:long,n_known:long,base_score:double,score:double,bigram_score:double>"


def _tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, their predecessors, and where each text's tokens begin."""
    words = Words(lower_table()[data], bounds, not_space())
    first = words.first + np.arange(len(bounds))
    tokens = np.full(first[-1], END, np.uint64)
    tokens[np.arange(len(words)) + words.doc] = np.maximum(words.hashes() >> np.uint64(16), np.uint64(3))
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = START
    return tokens, before, first


def _pair_hash(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(mix(before, 11) + tokens, 12)


def _bucket_of_pair(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal ranges of the hash."""
    return ((pairs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _bucket_of_word(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """A row of the ``width`` lowest bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _from_low_bytes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, : rows.shape[1]] = rows
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


def _six_bytes(words: np.ndarray) -> bytes:
    return _low_bytes(words, 6).tobytes()


def _from_six_bytes(packed: bytes) -> np.ndarray:
    return _from_low_bytes(np.frombuffer(packed, np.uint8).reshape(-1, 6))


def _pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each count, and then eight for each that is 255 or more."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u8").tobytes()


def _pack(words: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """Columns of words and of counts, made small.

    Rising columns go as differences, and bytes of equal weight lie together. Words beyond 32 bits
    are numbered by how often they come, so that a frequent word takes few bits.
    """
    listed, sizes, raw = np.zeros(0, np.uint64), [], []
    if any(int(x.max(initial=0)) >> 32 for x in words):
        distinct, number, times = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order))
        listed, words = distinct[order], np.split(rank[number], np.cumsum([*map(len, words)])[:-1])
    for x in words:
        rising = bool((x[1:] >= x[:-1]).all())
        x = np.diff(x, prepend=np.uint64(0)) if rising else x
        width = -(-int(x.max(initial=0)).bit_length() // 8)
        raw.append(np.ascontiguousarray(_low_bytes(x, width).T).tobytes())
        sizes += [len(x), rising, width]
    raw = b"".join([_six_bytes(listed), *raw, *map(_pack_counts, counts)])
    sizes = [len(raw), len(words), len(counts), len(listed), *sizes, *map(len, counts)]
    return np.array(sizes, "<i8").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(packed: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The columns of words and of counts."""
    size, n_words, n_counts, n_listed = np.frombuffer(packed, "<i8", 4).tolist()
    sizes = np.frombuffer(packed, "<i8", 3 * n_words + n_counts, 32).tolist()
    raw = pa.decompress(packed[32 + 8 * len(sizes) :], size, "zstd", asbytes=True)
    listed, at = _from_six_bytes(raw[: 6 * n_listed]), 6 * n_listed
    words, counts = [], []
    for n, rising, width in zip(*(iter(sizes[: 3 * n_words]),) * 3):
        x = _from_low_bytes(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T)
        x = np.cumsum(x, dtype=np.uint64) if rising else x
        words.append(listed[x] if n_listed else x)
        at += n * width
    for n in sizes[3 * n_words :]:
        counts += [_unpack_counts([raw[at:]], [n])]
        at += n + 8 * raw.count(b"\xff", at, at + n)
    return words, counts


def _columns(rows: list[dict]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The columns of words and of counts of all rows, which are taken off."""
    parts = []
    while rows:
        parts.append(_unpack(rows.pop()["packed"]))
    words, counts = zip(*parts)
    return [np.concatenate(x) for x in zip(*words)], [np.concatenate(x) for x in zip(*counts)]


def _unpack_counts(packed: list[bytes], sizes: list[int]) -> np.ndarray:
    out = []
    for data, n in zip(packed, sizes):
        counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
        large = counts == 255
        counts[large] = np.frombuffer(data, "<u8", int(large.sum()), n)
        out.append(counts)
    return np.concatenate(out)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of each value."""
    order = np.argsort(keys)
    keys = keys[order]
    start = _starts(keys)
    return keys[start], *[np.add.reduceat(v[order], start) if len(start) else v for v in values]


def _message(bucket: int, words: list[np.ndarray], counts: list[np.ndarray], **more) -> pa.RecordBatch:
    arrays = [pa.array([bucket], pa.int32()), pa.array([_pack(words, counts)], pa.binary())]
    arrays += [pa.array([x], pa.list_(pa.int64())) for x in more.values()]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "packed", *more])


def _parts(sorted_buckets: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Each bucket that has rows, and where they begin and end."""
    edges = np.searchsorted(sorted_buckets, np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        yield bucket, int(edges[bucket]), int(edges[bucket + 1])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before; the first does."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of about ``most`` at once, and which of them begin a text."""
    kept, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            tokens, before, _ = _tokens(*text_bytes(part["text"]))
            kept.append((tokens, before == START))
            size += len(tokens)
            if size >= most:
                lot, size = [np.concatenate(x) for x in zip(*kept)], 0
                kept.clear()
                yield tuple(lot)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*kept))


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of numbers, sorted, and how often each occurs. The columns are taken off."""
    bits, size, width = max(int(x.max(initial=0)).bit_length() for x in columns), len(columns[0]), len(columns)
    if bits * width < 64:
        key = np.zeros(size, np.uint64)
        while columns:
            key <<= np.uint64(bits)
            key |= columns.pop(0)
        key.sort()
        start = _starts(key)
        key, low = key[start], np.uint64((1 << bits) - 1)
        rows = [key >> np.uint64(bits * k) & low for k in reversed(range(width))]
    else:
        order = np.lexsort(columns[::-1])
        rows = [columns.pop(0)[order] for _ in range(width)]
        start = _starts(*rows)
        rows = [x[start] for x in rows]
    return rows, np.diff(np.append(start, size))


def _order(*columns: np.ndarray) -> np.ndarray:
    """The order of rows of numbers."""
    bits = [int(x.max(initial=0)).bit_length() for x in columns]
    if sum(bits) >= 64:
        return np.lexsort(columns[::-1])
    key = np.zeros(len(columns[0]), np.uint64)
    for x, n in zip(columns, bits):
        key = key << np.uint64(n) | x
    return np.argsort(key)


def _grams(folder: str, buckets: int, tokens: np.ndarray, begins: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of ``order`` neighbouring words, as sorted numbers, and how often each occurs."""
    words, place = np.unique(tokens, return_inverse=True)
    numbers = np.append(_numbers(folder, buckets, words), START)
    if not numbers.all():
        raise ValueError("the texts changed while they were counted: a word has no number")
    # Fewer bits are sorted by their ranks among those of the lot.
    by_number = np.argsort(numbers)
    rank = np.empty(len(numbers), np.uint64)
    rank[by_number] = np.arange(len(numbers))
    columns = [rank[place]]
    del words, place
    for _ in range(order - 1):
        before = np.empty_like(columns[0])
        before[1:] = columns[0][:-1]
        before[begins] = rank[-1]
        columns.insert(0, before)
    rows, counts = _distinct(columns)
    numbers = numbers[by_number]
    return [numbers[rows.pop(0)] for _ in range(order)], counts


def _numbers(folder: str, buckets: int, words: np.ndarray) -> np.ndarray:
    """The number of each of the sorted words."""
    out = np.zeros(len(words), np.uint64)
    for bucket, a, b in _parts(_bucket_of_word(words, buckets), buckets):
        at, known = _find(folder, "words", bucket, words[a:b])
        if known.any():
            rank = _mapped(f"{folder}/ranks-{bucket}", np.uint32)[at[known]]
            out[a:b][known] = rank.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket + _FIRST)
    for word in (END, START):
        out[words == word] = word
    return out


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _lots(batches, _FLUSH):
            words, counts = np.unique(tokens[tokens != END], return_counts=True)
            for to, a, b in _parts(_bucket_of_word(words, buckets), buckets):
                half = np.uint64(24)
                yield _message(to, [words[a:b] >> half, words[a:b] & np.uint64((1 << 24) - 1)], [counts[a:b]])

    return run


def _rank_words(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            (high, low), (counts,) = _columns(rows)
            words, counts = _summed((high << np.uint64(24)) | low, counts)
            rank = np.empty(len(words), np.uint32)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))
            _store(folder, f"words-{bucket}", words)
            _store(folder, f"ranks-{bucket}", rank)
            yield pa.RecordBatch.from_arrays([pa.array([len(words)], pa.int64())], ["words"])

    return run


def _count_pairs(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, begins in _lots(batches, _FLUSH):
            (u, w), counts = _grams(folder, buckets, tokens, begins, 2)
            yield from _deal_pairs(u, w, [counts], buckets)

    return run


def _by_place(buckets: np.ndarray) -> np.ndarray:
    """The order by bucket, which keeps that of rows of one bucket. Short numbers are sorted faster."""
    return np.argsort(buckets.astype(np.uint16) if buckets.max(initial=0) >> 16 == 0 else buckets, kind="stable")


def _deal_pairs(u: np.ndarray, w: np.ndarray, counts: list[np.ndarray], buckets: int, **first) -> Iterator[pa.RecordBatch]:
    """Sorted pairs to their buckets; what is ``first`` goes with the first of them, and then zeros."""
    bucket = _bucket_of_pair(_pair_hash(u, w), buckets)
    order = _by_place(bucket)
    u, w, counts = u[order], w[order], [x[order] for x in counts]
    for to, a, b in _parts(bucket[order], buckets):
        yield _message(to, [u[a:b], w[a:b]], [x[a:b] for x in counts], **first)
        first = {k: [0] * len(x) for k, x in first.items()}


def _count_triples(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, begins in _lots(batches, _FLUSH_TRIPLES):
            (v, u, w), counts = _grams(folder, buckets, tokens, begins, 3)
            # First words have no triple; they are spread, apart from those that begin with the start and such a word.
            place, alone = _pair_hash(v, u), u == START
            place[alone] = mix(_pair_hash(u[alone], w[alone]), 15)
            bucket = _bucket_of_pair(place, buckets)
            del place, alone
            order = _by_place(bucket)
            # One after the other, so that fewer are held at once.
            bucket = bucket[order]
            w = w[order]
            u = u[order]
            v = v[order]
            counts = counts[order]
            del order
            for to, a, b in _parts(bucket, buckets):
                # The first two tokens are sent once.
                head = _starts(u[a:b], v[a:b])
                follow = np.diff(np.append(head, b - a))
                yield _message(to, [v[a:b][head], u[a:b][head], w[a:b]], [follow, counts[a:b]])

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each bucket; they come together."""
    bucket, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if rows:
                    yield bucket, rows
                bucket, rows = row["bucket"], []
            rows.append(row)
    if rows:
        yield bucket, rows


def _store(folder: str, name: str, values: np.ndarray) -> None:
    """Writes an array under its final name in one step, so that a repeated task does no harm."""
    import uuid

    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    values.tofile(temporary)
    os.replace(temporary, f"{folder}/{name}")


def _mapped(path: str, kind: type) -> np.ndarray:
    """The file's values in memory; none if there is no such file."""
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, kind)
    return np.asarray(np.memmap(path, kind, "r"))


def _store_numbers(folder: str, name: str, values: np.ndarray, width: int) -> None:
    """The ``width`` lowest bytes of each, and eight more, so that each can be read as eight bytes."""
    _store(folder, name, np.append(_low_bytes(values, width).ravel(), np.zeros(8, np.uint8)))


class Numbers:
    """Values of :func:`_store_numbers`, by their places."""

    def __init__(self, path: str, width: int):
        data = _mapped(path, np.uint8)
        size = max(len(data) - 8, 0) // width
        self.values = np.ndarray(size, "<u8", data, strides=(width,)) if size else np.zeros(0, np.uint64)
        self.low = np.uint64((1 << 8 * width) - 1)

    def __len__(self) -> int:
        return len(self.values)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.values[at] & self.low


def _store_keys(folder: str, name: str, bucket: int, keys: np.ndarray) -> None:
    """Sorted keys of 64 bits: the first of each block, after the width of what the others are above it."""
    first = keys[::_BLOCK]
    above = keys - np.repeat(first, _BLOCK)[: len(keys)]
    width = max(1, -(-int(above.max(initial=0)).bit_length() // 8))
    _store_numbers(folder, f"{name}-above-{bucket}", above, width)
    _store(folder, f"{name}-first-{bucket}", np.concatenate([[np.uint64(width)], first]))


def _search(stored, keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in its own stretch of the stored values, which is sorted, and whether it does."""
    at, found = low.copy(), np.zeros(len(low), bool)
    left = np.flatnonzero(low < high)
    low, high, keys = low[left], high[left], keys[left]
    while len(left):
        middle = (low + high) >> 1
        value = stored[middle]
        less = value < keys
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        same = value == keys
        at[left[same]] = middle[same]
        found[left[same]] = True
        go = np.flatnonzero((low < high) & ~same)
        left, low, high, keys = left[go], low[go], high[go], keys[go]
    return at, found


def _find(folder: str, kind: str, bucket: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys stand among those that the bucket has stored, and whether they do."""
    first = _mapped(f"{folder}/{kind}-first-{bucket}", np.uint64)
    if len(first) > 1:
        stored = Numbers(f"{folder}/{kind}-above-{bucket}", int(first[0]))
        block = np.searchsorted(first[1:], keys, side="right") - 1
        # Below the first key there is none.
        low = np.maximum(block, 0) * _BLOCK
        high = np.where(block < 0, low, np.minimum(low + _BLOCK, len(stored)))
        return _search(stored, keys - first[1:][np.maximum(block, 0)], low, high)
    stored = _mapped(f"{folder}/{kind}-{bucket}", np.uint64)
    if not len(stored):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(stored, keys)
    at[at == len(stored)] = 0
    return at, stored[at] == keys


def _store_counts(folder: str, name: str, bucket: int, counts: np.ndarray) -> None:
    """A byte for each count, row by row; those above 254 are in a list of their own."""
    counts = counts.ravel()
    large = np.flatnonzero(counts >= 255)
    _store(folder, f"{name}-{bucket}", np.minimum(counts, 255).astype(np.uint8))
    _store(folder, f"{name}-large-{bucket}", np.column_stack([large, counts[large]]).astype(np.int64))


def _stored_counts(folder: str, name: str, bucket: int, width: int, at: np.ndarray) -> np.ndarray:
    """Rows of ``width`` counts each, by their places."""
    counts = _mapped(f"{folder}/{name}-{bucket}", np.uint8).reshape(-1, width)[at].astype(np.int64)
    row, column = np.nonzero(counts == 255)
    if len(row):
        large = np.fromfile(f"{folder}/{name}-large-{bucket}", np.int64).reshape(-1, 2)
        counts[row, column] = large[np.searchsorted(large[:, 0], at[row] * width + column), 1]
    return counts


def _store_heads(folder: str, bucket: int, start: np.ndarray, size: int) -> None:
    """A bit for each of ``size`` triples, set where another pair begins, and how many do before each 64."""
    heads = np.zeros(-(-size // 64) * 64, np.uint8)
    heads[start] = 1
    before = np.concatenate([[0], np.cumsum(heads.reshape(-1, 64).sum(axis=1))])
    _store(folder, f"heads-{bucket}", np.packbits(heads, bitorder="little"))
    _store(folder, f"heads-before-{bucket}", before.astype(np.uint32))


def _heads(folder: str, bucket: int, numbers: np.ndarray, size: int) -> np.ndarray:
    """Where the triples of the pairs of these numbers begin; of the number after the last, the end."""
    before = _mapped(f"{folder}/heads-before-{bucket}", np.uint32)
    out = np.full(len(numbers), size, np.int64)
    inside = np.flatnonzero(numbers < before[-1])
    block = np.searchsorted(before, numbers[inside].astype(np.uint32), side="right") - 1
    bits = _mapped(f"{folder}/heads-{bucket}", "<u8")[block]
    # By halves: are there so many in the lower one, or is it among the upper ones?
    rest, place = numbers[inside] - before[block], block * 64
    for half in (32, 16, 8, 4, 2, 1):
        lower = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
        upper = rest >= lower
        rest, place = rest - upper * lower, place + upper * half
        bits = np.where(upper, bits >> np.uint64(half), bits)
    out[inside] = place
    return out


def _kinds(counts: np.ndarray) -> list[np.ndarray]:
    """Which counts are 1, 2, and more."""
    return [(counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64)]


def _seen(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _sum_triples(folder: str, buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            (v, u, w), (follow, times) = _columns(rows)
            contexts, number = np.unique(_pair_hash(v, u), return_inverse=True)
            # First words come last.
            number = np.where(u == START, len(contexts), number).astype(np.uint64)
            contexts, u = np.repeat(number, follow), np.repeat(u, follow)
            order = _order(contexts, w)
            contexts, u, w = contexts[order], u[order], w[order]
            start = _starts(contexts, w)
            count = np.add.reduceat(times[order], start)
            contexts, u, w = contexts[start], u[start], w[start]
            del order, times, start, v, follow, number
            whole = int((u != START).sum())
            _store_numbers(folder, f"triples-{bucket}", w[:whole], width)
            _store_counts(folder, "triple-times", bucket, count[:whole])
            seen = _seen(count[:whole])
            start = _starts(contexts[:whole])
            _store_heads(folder, bucket, start, whole)
            # Of others, the numbers of triples and tokens tell how many triples of each count there are.
            stands, *kinds = (np.add.reduceat(x, start) if whole else x for x in (count[:whole], *_kinds(count[:whole])))
            triples = np.diff(np.append(start, whole))
            mixed = np.flatnonzero((triples > 1) & (triples < stands))
            _store(folder, f"mixed-{bucket}", mixed.astype(np.uint32))
            _store_counts(folder, "kinds", bucket, np.column_stack(kinds)[mixed])
            del contexts, start, stands, kinds, triples, mixed
            lefts = np.ones(len(count), np.int64)
            lefts[whole:] = count[whole:]
            order = _order(u, w)
            u, w, count, lefts = (x[order] for x in (u, w, count, lefts))
            start = _starts(u, w)
            count, lefts = (np.add.reduceat(x, start) for x in (count, lefts))
            yield from _deal_pairs(u[start], w[start], [count, lefts], buckets, seen=seen)

    return run


def _sum_pairs(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            triples = "seen" in rows[0]
            seen_triples = np.sum([r["seen"] for r in rows], axis=0).tolist() if triples else [0, 0, 0, 0]
            (u, w), (times, *lefts) = _columns(rows)
            lefts = lefts[0] if triples else np.zeros(len(times), np.int64)
            pairs = _pair_hash(u, w)
            order = np.argsort(pairs)
            pairs = pairs[order]
            start = _starts(pairs)
            count, lefts = (np.add.reduceat(x[order], start) for x in (times, lefts))
            pairs, u, w = pairs[start], u[order][start], w[order][start]
            del order, times
            stored = np.column_stack([count, lefts]) if triples else count
            # Nothing follows an end: without them, pairs are numbered like the triples' first two tokens.
            for kind, name, part in (("pairs", "times", w != END), ("ends", "end-times", w == END)):
                _store_keys(folder, kind, bucket, pairs[part])
                _store_counts(folder, name, bucket, stored[part])
            ones = np.ones(len(count), np.int64)
            of_token = _summed(w, count, ones)
            of_before = _summed(u, count, *_kinds(count), lefts, *_kinds(lefts))
            words = np.concatenate([of_token[0], of_before[0]])
            fields = np.zeros((len(WORD_FIELDS), len(words)), np.int64)
            fields[:2, : len(of_token[0])] = of_token[1:]
            fields[2:, len(of_token[0]) :] = of_before[1:]
            words, *fields = _summed(words, *fields)
            seen = [*_seen(count), *_seen(lefts), *seen_triples]
            to, row = (x.astype(np.int64) for x in (words % np.uint64(buckets), words // np.uint64(buckets)))
            order = _by_place(to)
            row, fields = row[order].astype(np.uint64), [f[order] for f in fields]
            for to, a, b in _parts(to[order], buckets):
                yield _message(to, [row[a:b]], [f[a:b] for f in fields], seen=seen)
                seen = [0] * 12

    return run


def _sum_words(folder: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            seen = np.sum([r["seen"] for r in rows], axis=0).tolist()
            (row,), fields = _columns(rows)
            row, *fields = _summed(row, *fields)
            # Every number has a row.
            stored = np.zeros((size, len(WORD_FIELDS)), np.int64)
            stored[row.astype(np.int64)] = np.column_stack(fields)
            _store_counts(folder, "fields", bucket, stored)
            occurs, after = fields[0], fields[1]
            totals = [int(occurs.sum()), int((occurs > 0).sum()), int(after.sum())]
            totals += [int((after == k).sum()) for k in (1, 2, 3, 4)] + [int((after > 2).sum())]
            totals += seen
            yield pa.RecordBatch.from_arrays([pa.array([totals], pa.list_(pa.int64()))], ["totals"])

    return run


def discounts(seen: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(n) for n in seen)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    # In small or odd corpora the estimates can leave their range.
    return np.array([0.0, *[min(max(d, 0.1), k - 0.05) for k, d in zip((1, 2, 3), raw)]])


@dataclass
class Model:
    """Where the arrays lie, and the totals."""

    order: int
    folder: str
    buckets: int
    tokens: int
    types: int
    pair_types: int
    pair_discounts: np.ndarray
    middle_discounts: np.ndarray
    triple_discounts: np.ndarray
    token_discounts: np.ndarray
    token_rest: float
    # Bytes of a word's number in a triple.
    width: int = 8

    def places(self, kind: str, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where each of the keys, which are sorted in each bucket, is stored; -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int64)
        for bucket, a, b in _parts(place, self.buckets):
            out[a:b] = np.where(*reversed(_find(self.folder, kind, bucket, keys[a:b])), -1)
        return out

    def stored(self, name: str, width: int, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The ``width`` counts ``name`` at each place in the buckets, which are sorted; zeros for unknown ones."""
        out = np.zeros((len(at), width), np.int64)
        for bucket, a, b in _parts(place, self.buckets):
            known = np.flatnonzero(at[a:b] >= 0)
            if len(known):
                out[a + known] = _stored_counts(self.folder, name, bucket, width, at[a + known])
        return out

    def counts(self, kind: str, name: str, width: int, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The ``width`` counts ``name`` of each of the keys, which are sorted in each bucket; zeros for unknown ones."""
        return self.stored(name, width, self.places(kind, keys, place), place)

    def _fields(self, numbers: np.ndarray) -> np.ndarray:
        """What is known of each of the words."""
        place = (numbers % np.uint64(self.buckets)).astype(np.int64)
        at = np.where(numbers > 0, (numbers // np.uint64(self.buckets)).astype(np.int64), -1)
        # From an empty corpus no word is stored.
        at = at if self.tokens else np.full(len(at), -1)
        order = _by_place(place)
        out = np.empty((len(numbers), len(WORD_FIELDS)), np.int64)
        out[order] = self.stored("fields", len(WORD_FIELDS), at[order], place[order])
        return out

    def _followers(self, at: np.ndarray, place: np.ndarray, stands: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each of the sorted pairs, where its triples begin and end, and how many of count 1, 2 and more there are."""
        start, end, kinds = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.zeros((len(at), 3), np.int64)
        for bucket, a, b in _parts(place, self.buckets):
            known = a + np.flatnonzero(at[a:b] >= 0)
            if not len(known):
                continue
            number, often = at[known], stands[known]
            size = len(Numbers(f"{self.folder}/triples-{bucket}", self.width))
            first, last = np.split(_heads(self.folder, bucket, np.append(number, number + 1), size), 2)
            triples = last - first
            start[known], end[known] = first, last
            kinds[known, np.where(triples == 1, np.minimum(often, 3) - 1, 0)] = triples
            mixed = np.flatnonzero((triples > 1) & (triples < often))
            if len(mixed):
                numbers = _mapped(f"{self.folder}/mixed-{bucket}", np.uint32)
                row = np.searchsorted(numbers, number[mixed].astype(np.uint32))
                kinds[known[mixed]] = _stored_counts(self.folder, "kinds", bucket, 3, row)
        return start, end, kinds

    def _triples(self, tokens, of_pair, begins, at, place, stands, middle) -> np.ndarray:
        """Probabilities of order three, from what is known of the different pairs and the probabilities at the middle level."""
        start, end, kinds = self._followers(at, place, stands)
        rest = np.where(stands > 0, kinds @ self.triple_discounts[1:] / np.maximum(stands, 1), 1.0)
        # The pair of the place before is the one that the triple begins with.
        asked = np.flatnonzero(~begins)
        asked = asked[np.argsort(of_pair[asked - 1])]
        context, tokens = of_pair[asked - 1], tokens[asked]
        count = np.zeros(len(asked), np.int64)
        for bucket, a, b in _parts(place[context], self.buckets):
            stored = Numbers(f"{self.folder}/triples-{bucket}", self.width)
            where, found = _search(stored, tokens[a:b], start[context[a:b]], end[context[a:b]])
            if found.any():
                count[a:b][found] = _stored_counts(self.folder, "triple-times", bucket, 1, where[found])[:, 0]
        out = middle.copy()
        share = (count - self.triple_discounts[np.minimum(count, 3)]) / np.maximum(stands, 1)[context]
        out[asked] = share + rest[context] * middle[asked]
        return out

    def score(self, data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        tokens, before, first = _tokens(data, bounds)
        begins = before == START
        words, of_token = np.unique(tokens, return_inverse=True)
        numbers = np.append(_numbers(self.folder, self.buckets, words), START)
        fields = self._fields(numbers)
        of_before = np.empty_like(of_token)
        of_before[1:] = of_token[:-1]
        of_before[begins] = len(words)
        tokens = numbers[of_token]
        pairs, of_pair = np.unique(_pair_hash(numbers[of_before], tokens), return_inverse=True)
        place = _bucket_of_pair(pairs, self.buckets)
        last = np.zeros(len(pairs), bool)
        last[of_pair[tokens == END]] = True
        at, stored = np.full(len(pairs), -1), np.zeros((len(pairs), self.order - 1), np.int64)
        for kind, name, part in (("ends", "end-times", last), ("pairs", "times", ~last)):
            found = self.places(kind, pairs[part], place[part])
            stored[part] = self.stored(name, self.order - 1, found, place[part])
        at[~last] = found
        times, *lefts = stored[of_pair].T
        occurs, after = fields[:, 0], fields[:, 1]
        by_token = self.token_rest / (self.types + 1)
        if self.pair_types:
            by_token = by_token + (after - self.token_discounts[np.minimum(after, 3)]) / self.pair_types
        by_token = np.broadcast_to(by_token, occurs.shape)[of_token]

        def of_pairs(counts: np.ndarray, discounts: np.ndarray, field: int) -> np.ndarray:
            stands = fields[:, field]
            rest = np.where(stands > 0, fields[:, field + 1 : field + 4] @ discounts[1:] / np.maximum(stands, 1), 1.0)
            share = (counts - discounts[np.minimum(counts, 3)]) / np.maximum(stands, 1)[of_before]
            return share + rest[of_before] * by_token

        logs = np.log10(of_pairs(times, self.pair_discounts, 2))
        base = np.log10((occurs + 1) / (self.tokens + self.types + 1))[of_token]
        add = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else np.zeros(0)
        pair_score = score = add(logs)
        if self.order == 3:
            middle = of_pairs(lefts[0], self.middle_discounts, 6)
            score = add(np.log10(self._triples(tokens, of_pair, begins, at, place, stored[:, 0], middle)))
        return {
            "n_tokens": np.diff(first),
            "n_known": add((occurs > 0)[of_token].astype(np.int64)),
            "base_score": add(base),
            "score": score,
            "bigram_score": pair_score,
        }


def _local(path: str) -> str:
    """The path as the workers' file system knows it."""
    from urllib.parse import urlparse

    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model must lie in a folder that workers can map into memory: {path}")
    return parsed.path


def fit(texts: DataFrame, text: str = "text", folder: str | None = None, order: int = ORDER) -> Model:
    """Counts all texts into a model of order two or three under ``folder``, a new one in the shared folder unless given.

    The texts are read more than once and must be the same each time; a word that has come up since is an error.
    """
    if order not in (2, 3):
        raise ValueError(f"the order must be 2 or 3: {order}")
    spark = texts.sparkSession
    folder = _local(folder or scratch_path(spark, "language-model"))
    os.makedirs(folder, exist_ok=True)
    known = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    buckets = max(1, -(-size // BUCKET_BYTES))
    words = known.mapInArrow(_count_words(buckets), "bucket int, packed binary")
    words = words.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    # One number for each bucket.
    most = max([row.words for row in words.mapInArrow(_rank_words(folder, buckets), "words long").collect()], default=0)
    width = -(-(most * buckets + buckets + _FIRST).bit_length() // 8)
    if order == 2:
        pairs = known.mapInArrow(_count_pairs(folder, buckets), "bucket int, packed binary")
    else:
        triples = known.mapInArrow(_count_triples(folder, buckets), "bucket int, packed binary")
        triples = triples.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        pairs = triples.mapInArrow(_sum_triples(folder, buckets, width), "bucket int, packed binary, seen array<long>")
    pairs = pairs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    words = pairs.mapInArrow(_sum_pairs(folder, buckets), "bucket int, packed binary, seen array<long>")
    words = words.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    totals = words.mapInArrow(_sum_words(folder, most + _FIRST), "totals array<long>")
    # One short row for each bucket.
    sums = np.sum([row.totals for row in totals.collect()] or [[0] * 20], axis=0).tolist()
    tokens, types, pair_types, one, two, three, four, more, *seen = sums
    of_token = discounts([one, two, three, four])
    rest = float(of_token[1:] @ [one, two, more]) / pair_types if pair_types else 1.0
    of_pair, of_middle, of_triple = (discounts(seen[i : i + 4]) for i in (0, 4, 8))
    return Model(order, folder, buckets, tokens, types, pair_types, of_pair, of_middle, of_triple, of_token, rest, width)


def _scorer(model, text: str, carried: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared(model)
        # In a larger model a step takes more text, as it opens most of the buckets' files.
        for batch in batches:
            for part in slices(batch, text, min(max(SLICE_BYTES, m.buckets << 16), 4 << 20)):
                found = m.score(*text_bytes(part[text]))
                struct = pa.StructArray.from_arrays([pa.array(v, from_pandas=True) for v in found.values()], list(found))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in carried], struct], [*carried, out])

    return run


def score(documents: DataFrame, model: Model, text: str = "text", out: str = "lm", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all, unless given) and the struct ``out``.

    ``n_known`` counts the tokens that the model has seen, ``score`` is the base-ten logarithm
    of the text's probability at the order of the model, ``bigram_score`` that at order two
    from the same counts, and ``base_score`` that of single tokens with one added to each
    count. A column named ``out`` is replaced.
    """
    carry = [c for c in (documents.columns if carry is None else carry) if c != out]
    schema = StructType(documents.select(*carry).schema.fields).add(out, DataType.fromDDL(OUT))
    columns = [*[c for c in carry if c != text], text]
    shared_model = share(documents.sparkSession, model)
    return documents.select(*columns).mapInArrow(_scorer(shared_model, text, carry, out), schema)


def perplexity(out: str = "lm") -> F.Column:
    """Per token, from the struct of :func:`score`."""
    return F.pow(F.lit(10.0), -F.col(out)["score"] / F.col(out)["n_tokens"])
