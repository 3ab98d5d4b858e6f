"""Removal of byte strings that an earlier document, or an earlier place, has too.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document with a smaller key, or further to the front of the same one. Sorting all
suffixes would move a multiple of the corpus, so only those that can matter are sorted:

1. Every window of ``LENGTH`` bytes chooses an anchor, the place in it whose ``GRAM``
   bytes have the smallest hash. Equal windows choose the same place, and the windows of
   one anchor are neighbours. Anchors whose ``GRAM`` bytes occur once drop out.
2. For the others each task sorts the suffixes at its anchors, cut to the reach of their
   windows and followed by what lies before the anchor, read backwards. The sorted runs
   are front-coded, each suffix without what it shares with the one before, and dealt out
   by the range of their first bytes.
3. A range's runs are merged by a tree of losers. It keeps for each waiting suffix how
   much it shares with the last one out, and compares bytes only behind that, so shared
   beginnings are never read again. The shared lengths of neighbours in the merged order
   tell which suffixes agree how far, and so which windows are equal. All but the first
   of equal windows are marked.
4. Marked bytes are cut out of the documents.

Equal suffixes of one task are settled there, so a text with very many copies sends one
suffix for each task. Everything is judged on the input. Matches do not cross documents.

Null and empty texts have no bytes. Rows without a key stay whole and count for nothing.
Repeated rows are one document, of which none is earlier; rows with the same key and
different texts are documents of their own, in the order of a hash of their texts. Very long texts are
read in stretches. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import pickle
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presscheck.llm.tables import materialise, slices, text_bytes
from presscheck.llm.words import Spans, mix

LENGTH = 100
GRAM = 32
# Bytes before an anchor that a window can reach, and bytes of a suffix with its hash.
REACH = LENGTH - GRAM
WIDTH = 8 + LENGTH + REACH
# Text per range. A task holds the suffixes of one range, a few times as much.
RANGE_BYTES = 4 << 20
# Anchors that a task settles among themselves before it deals them out.
_FLUSH = 1 << 18
# Suffixes that a task sorts into one run, and of which it makes bytes at once.
RUN_SUFFIXES = 1 << 16
_STEP = 1 << 13
# Bytes of a text that are searched for anchors at once.
STRETCH = 4 << 20
ROWS = "place int, kind int, body binary"


def _row(place: int, kind: int, *content) -> pa.RecordBatch:
    body = zlib.compress(pickle.dumps(content, 5), 1)
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int32()), pa.array([kind], pa.int32()), pa.array([body], pa.binary())],
        ["place", "kind", "body"],
    )


def _dealt(kind: int, places: np.ndarray, count: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each place, with its part of every column."""
    order = np.argsort(places, kind="stable")
    edges = np.searchsorted(places[order], np.arange(count + 1))
    for place in np.flatnonzero(np.diff(edges)).tolist():
        part = order[edges[place] : edges[place + 1]]
        yield _row(place, kind, *[c[part] for c in columns])


def _by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, tuple]]]]:
    """The rows of each place, which come together, as ``(kind, content)``."""
    rows = (row for batch in batches for row in batch.to_pylist())
    waiting = next(rows, None)

    def of(place: int) -> Iterator[tuple[int, tuple]]:
        nonlocal waiting
        while waiting is not None and waiting["place"] == place:
            row, waiting = waiting, None
            yield row["kind"], pickle.loads(zlib.decompress(row["body"]))
            waiting = next(rows, None)

    while waiting is not None:
        place = waiting["place"]
        yield place, of(place)
        while waiting is not None and waiting["place"] == place:
            waiting = next(rows, None)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, place, first and last window start and hash of each anchor, by place in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    hashes = Spans(data).hashes(at, at + GRAM)
    # Of equal hashes the last place wins.
    mask = (1 << 28) - 1
    least = (hashes >> np.uint64(28) << np.uint64(28)) | (mask - at).astype(np.uint64)
    size = 1
    while 2 * size <= REACH + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = REACH + 1 - size
    least = np.minimum(least[: len(least) - rest], least[rest:])
    # Windows within one document.
    crossing = np.zeros(len(data) + 1, np.int32)
    np.add.at(crossing, np.maximum(bounds[1:] - LENGTH + 1, bounds[:-1]), 1)
    np.add.at(crossing, bounds[1:], -1)
    start = np.flatnonzero(np.cumsum(crossing[: len(least)]) == 0)
    anchor = mask - (least[start] & np.uint64(mask)).astype(np.int64)
    turn = np.ones(len(start), bool)
    turn[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(turn)
    end = np.append(begin[1:], len(start)) - 1 if len(begin) else begin
    anchor, low, high = anchor[begin], start[begin], start[end]
    return np.searchsorted(bounds, low, "right") - 1, anchor, low, high, hashes[anchor]


def _firsts(doc: np.ndarray, at: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the entries with equal keys, the first by document and place, and those behind it."""
    order = np.lexsort((at, doc, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    first = order[new][np.cumsum(new) - 1]
    later = (doc[order] != doc[first]) | (at[order] != at[first])
    return order[new], order[later]


def _stretches(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, place, windows before and behind, gram hash and hash of all its windows, of each anchor.

    A long text is read in stretches that share the bytes of a window. An anchor whose windows lie
    in two stretches comes twice, each time with its part of them.
    """
    for begin in range(0, max(1, len(data) - LENGTH + 1), STRETCH):
        own = data[begin : begin + STRETCH + LENGTH - 1]
        row, at, low, high, gram = anchors(own, np.clip(bounds - begin, 0, len(own)))
        before, after = (at - low).astype(np.int8), at - high
        whole = Spans(own, 1).hashes(low, high + LENGTH) if len(low) else gram
        whole = mix(whole, 1) + mix((before.astype(np.int64) * 256 + after).astype(np.uint64), 2)
        yield row, at + begin - bounds[row], before, after, gram, whole


def _find_anchors(places: int):
    def flush(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, at, before, after, gram, whole = (np.concatenate(x) for x in zip(*found))
        # Anchors of this task with equal windows: one is sent, those behind it are settled.
        kept, gone = _firsts(doc, at, whole, gram)
        yield from _dealt(2, doc[gone] % places, places, doc[gone], (at - before)[gone], (at - after + LENGTH)[gone])
        kept = kept[np.argsort(gram[kept])]
        range_ = ((gram[kept] >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)
        yield from _dealt(0, range_, places, gram[kept], doc[kept], at[kept].astype(np.uint32), before[kept], after[kept].astype(np.int8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for part in slices(batch.filter(batch["doc_id"].is_valid()), "text"):
                keys = part["doc_id"].to_numpy()
                for row, *columns in _stretches(*text_bytes(part["text"])):
                    found.append((keys[row], *columns))
                    size += len(row)
                    if size >= _FLUSH:
                        yield from flush(found)
                        found, size = [], 0
        if size:
            yield from flush(found)

    return run


def _keep_repeated(places: int):
    """Anchors whose gram came from more than one; what is settled passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, rows in _by_place(batches):
            parts = []
            for kind, content in rows:
                if kind == 2:
                    yield _row(place, 2, *content)
                else:
                    parts.append(content)
            if parts:
                gram, doc, at, before, after = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(gram, kind="stable")
                same = gram[order[1:]] == gram[order[:-1]]
                repeated = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
                doc = doc[repeated]
                yield from _dealt(0, doc % places, places, doc, at[repeated], before[repeated], after[repeated])

    return run


def _deal_texts(places: int):
    """Texts by the place of their key; those without a key are dealt out by their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                data, bounds = text_bytes(part["text"])
                keyed = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
                doc = pa.compute.fill_null(part["doc_id"], 0).to_numpy()
                home = np.where(keyed, doc % places, np.diff(bounds) % places)
                for place in np.unique(home).tolist():
                    own = np.flatnonzero(home == place)
                    texts = [data[bounds[i] : bounds[i + 1]].tobytes() for i in own]
                    yield _row(place, 1, doc[own], keyed[own], np.diff(bounds)[own], b"".join(texts))

    return run


def _suffixes(data: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A row of bytes for each anchor: gram hash, suffix, and reversed what precedes it."""
    out = np.zeros((len(at), WIDTH), np.uint8)
    if len(at):
        gram = Spans(data).hashes(at, at + GRAM)
        out[:, :8] = gram.astype(">u8").view(np.uint8).reshape(-1, 8)
    forth, back = np.arange(LENGTH), np.arange(REACH)
    # The places of all bytes take eight times their room, so a few rows are made at a time.
    for start in range(0, len(at), _STEP):
        part = slice(start, start + _STEP)
        inside = forth < (LENGTH - after[part])[:, None]
        out[part, 8 : 8 + LENGTH] = np.where(inside, data[np.minimum(at[part, None] + forth, len(data) - 1)], 0)
        inside = back < before[part, None]
        out[part, 8 + LENGTH :] = np.where(inside, data[np.maximum(at[part, None] - 1 - back, 0)], 0)
    return out


def _shared(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row shares with the one above; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _make_runs(places: int):
    def finish(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, at, before, after, rows = (np.concatenate(x) for x in zip(*found))
        # Strings of one length; those that differ in zeros at their end alone are equal.
        order = np.argsort(rows.view(f"S{WIDTH}").ravel(), kind="stable")
        doc, at, before, after, rows = doc[order], at[order], before[order], after[order], rows[order]
        shared = _shared(rows)
        new = (shared < WIDTH) | (np.diff(before, prepend=-1) != 0) | (np.diff(after, prepend=-1) != 0)
        kept, gone = _firsts(doc, at, np.cumsum(new))
        yield from _dealt(2, doc[gone] % places, places, doc[gone], (at - before)[gone], (at - after + LENGTH)[gone])
        kept.sort()
        doc, at, before, after, rows = doc[kept], at[kept], before[kept], after[kept], rows[kept]
        top = rows[:, :4].copy().view(">u4").ravel().astype(np.int64)
        edges = np.searchsorted(top * places >> 32, np.arange(places + 1))
        for place in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[place], edges[place + 1])
            own = rows[part]
            shared = _shared(own)
            # Front coding: what a suffix shares with the one before is left out.
            rest = own[np.arange(WIDTH) >= shared[:, None]].tobytes()
            yield _row(place, 0, doc[part], at[part], before[part], after[part], shared.astype(np.uint8), rest)

    def one(rows: Iterator[tuple[int, tuple]]) -> Iterator[pa.RecordBatch]:
        parts, found, wanted, size = [], [], None, 0
        for kind, content in rows:
            if kind == 0:
                parts.append(content)
                continue
            if not parts:
                continue
            if wanted is None:
                wanted = [np.concatenate(x).astype(np.int64) for x in zip(*parts)]
                order = np.argsort(wanted[0], kind="stable")
                wanted = [x[order] for x in wanted]
            doc, keyed, sizes, text = content
            data, begin = np.frombuffer(text, np.uint8), np.cumsum(sizes) - sizes
            low, high = (np.searchsorted(wanted[0], doc, side) for side in ("left", "right"))
            count = np.where(keyed, high - low, 0)
            pick = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            at = wanted[1][pick] + np.repeat(begin, count)
            for start in range(0, len(pick), RUN_SUFFIXES):
                own = pick[start : start + RUN_SUFFIXES]
                suffixes = _suffixes(data, at[start : start + RUN_SUFFIXES], wanted[2][own], wanted[3][own])
                found.append((wanted[0][own], wanted[1][own], wanted[2][own], wanted[3][own], suffixes))
                size += len(own)
                if size >= RUN_SUFFIXES:
                    yield from finish(found)
                    found, size = [], 0
        if size:
            yield from finish(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_place(batches):
            yield from one(rows)

    return run


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """``(run, index, shared)`` in sorted order; shared with the one before.

    A run is its sorted strings, all of one length, and what each shares with the one
    before. Of two waiting strings, the one that shares more with the last one out is the
    smaller; only if they share the same are they compared, behind that.
    """
    width = len(runs[0][0][0]) if runs else 0
    leaves = 1 << max(len(runs) - 1, 0).bit_length()
    current: list[bytes | None] = [strings[0] for strings, _ in runs] + [None] * (leaves - len(runs))
    known = [0] * leaves
    index = [0] * leaves

    def smaller(a: int, b: int) -> bool:
        """Whether a goes first; the other then knows what it shares with the first."""
        x, y = current[a], current[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        if x == y:
            known[b] = width
            return True
        start = known[a]
        differ = int.from_bytes(x[start:]) ^ int.from_bytes(y[start:])
        common = width - (differ.bit_length() + 7) // 8
        first = x[common] < y[common]
        known[b if first else a] = common
        return first

    losers = [0] * leaves
    winners = [*[0] * leaves, *range(leaves)]
    for node in range(leaves - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if smaller(a, b) else (b, a)
    winner = winners[1]
    while current[winner] is not None:
        yield winner, index[winner], known[winner]
        strings, shared = runs[winner]
        index[winner] = i = index[winner] + 1
        if i < len(strings):
            current[winner], known[winner] = strings[i], shared[i]
        else:
            current[winner] = None
        node = (winner + leaves) >> 1
        while node:
            other = losers[node]
            if not smaller(winner, other):
                losers[node], winner = winner, other
            node >>= 1


def _decoded(shared: np.ndarray, rest: bytes) -> bytes:
    """The strings of front-coded runs, one behind the other; a run's first string shares nothing."""
    count = len(shared)
    out = np.empty((count, WIDTH), np.uint8)
    data = np.frombuffer(rest, np.uint8)
    lengths = WIDTH - shared
    # Byte c of a string is that of the last string that did not share it.
    begin = np.cumsum(lengths) - lengths - shared
    number = np.arange(count)
    for c in range(WIDTH):
        last = np.maximum.accumulate(np.where(shared <= c, number, 0))
        out[:, c] = data[np.minimum(begin[last] + c, len(data) - 1)]
    return out.tobytes()


class _Strings:
    """The strings of one run, cut out when they are asked for."""

    def __init__(self, text: bytes, first: int, count: int):
        self.text, self.first, self.count = text, first, count

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> bytes:
        begin = (self.first + i) * WIDTH
        return self.text[begin : begin + WIDTH]


def _equal_windows(text, order, shared, doc, at, before, after) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, starts and ends of the windows that have an equal one before them.

    The entries are in sorted order, ``order`` says where in ``text``. A window that begins ``d`` bytes before its anchor
    is known by the first ``LENGTH - d`` bytes of the suffix and the last ``d`` before it.
    """
    new = (shared < WIDTH) | (np.diff(before, prepend=-1) != 0) | (np.diff(after, prepend=-1) != 0)
    first, later = _firsts(doc, at, np.cumsum(new))
    yield doc[later], (at - before)[later], (at - after + LENGTH)[later]
    # Different entries with the same gram.
    first.sort()
    lead = np.flatnonzero(new)
    shared = shared[lead].copy()
    apart = shared < 8 + GRAM
    group = np.cumsum(apart)
    several = np.bincount(group)[group] > 1
    first, shared = first[several], shared[several]
    if not len(first):
        return
    doc, at, before, after = doc[first], at[first], before[first], after[first]
    behind = text[order[first], 8 + LENGTH :]
    rank = np.lexsort((at, doc))
    marked = np.zeros((len(first), REACH + 2), bool)
    back = np.zeros(len(first), np.uint64)
    for d in range(REACH + 1):
        if d:
            back = mix(back, 21) + behind[:, d - 1].astype(np.uint64)
        key = mix(back, 22) + np.cumsum(shared < 8 + LENGTH - d).astype(np.uint64)
        own = rank[((after <= d) & (d <= before))[rank]]
        _, head, group = np.unique(key[own], return_index=True, return_inverse=True)
        head = own[head][group]
        marked[own, d] = (doc[head] != doc[own]) | (at[head] != at[own])
    turn = np.diff(marked.astype(np.int8), axis=1, prepend=0)
    entry, low = np.nonzero(turn == 1)
    _, high = np.nonzero(turn == -1)
    yield doc[entry], at[entry] - high + 1, at[entry] - low + LENGTH


def _merge(places: int):
    def one(place: int, rows: Iterator[tuple[int, tuple]]) -> Iterator[pa.RecordBatch]:
        columns, coded = [], []
        for kind, content in rows:
            if kind == 2:
                yield _row(place, 0, *content)
                continue
            *own, shared, rest = content
            columns.append(own)
            coded.append((shared, rest))
        if coded:
            sizes = [len(shared) for shared, _ in coded]
            begin = np.cumsum([0, *sizes]).tolist()
            text = _decoded(np.concatenate([x for x, _ in coded]).astype(np.int64), b"".join([x for _, x in coded]))
            runs = [(_Strings(text, first, n), x.tobytes()) for first, n, (x, _) in zip(begin, sizes, coded)]
            coded.clear()
            order, shared = array("q"), array("q")
            for r, i, n in merge_runs(runs):
                order.append(begin[r] + i)
                shared.append(n)
            runs.clear()
            order, shared = np.array(order), np.array(shared)
            shared[0] = 0
            own = [np.concatenate(x)[order] for x in zip(*columns)]
            matrix = np.frombuffer(text, np.uint8).reshape(-1, WIDTH)
            for doc, low, high in _equal_windows(matrix, order, shared, *own):
                yield from _dealt(0, doc % places, places, doc, low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In a function of its own, so that nothing of a place is held while the next is read.
        for place, rows in _by_place(batches):
            yield from one(place, rows)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_place(batches):
        spans, sorted_ = [], None
        for kind, content in rows:
            if kind == 0:
                spans.append(content)
                continue
            if sorted_ is None:
                joined = [np.concatenate(x).astype(np.int64) for x in zip(*spans)] or [np.zeros(0, np.int64)] * 3
                order = np.argsort(joined[0], kind="stable")
                sorted_ = [x[order] for x in joined]
            doc, keyed, sizes, text = content
            data, begin = np.frombuffer(text, np.uint8), np.cumsum(sizes) - sizes
            low, high = (np.searchsorted(sorted_[0], doc, side) for side in ("left", "right"))
            kept, removed, runs = [], [], []
            for i, n in enumerate(sizes.tolist()):
                own = data[begin[i] : begin[i] + n]
                gone = np.zeros(n + 1, np.int32)
                if keyed[i] and high[i] > low[i]:
                    part = slice(low[i], high[i])
                    np.add.at(gone, np.minimum(sorted_[1][part], n), 1)
                    np.add.at(gone, np.minimum(sorted_[2][part], n), -1)
                    covered = np.cumsum(gone[:-1]) > 0
                    kept.append(own[~covered].tobytes())
                    removed.append(int(covered.sum()))
                    runs.append(int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum()))
                else:
                    kept.append(own.tobytes())
                    removed.append(0)
                    runs.append(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64(), mask=~keyed),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def _prime(least: int) -> int:
    """Keys are dealt out by their remainder, which a prime keeps even for regular keys."""
    while any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def _numbered(texts: DataFrame) -> DataFrame | None:
    """``(number, doc_id, text)`` with a number of its own for each key and text; None if keys differ.

    Numbers follow the key, then a hash of the text. Keys are dealt out by range and numbered
    there, behind the numbers of the ranges before.
    """
    keyed = texts.where("doc_id is not null")
    if keyed.groupBy("doc_id").count().where("count > 1").isEmpty():
        return None
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest")
    ranged = keyed.select("*", digest).repartitionByRange("doc_id").withColumn("range", F.spark_partition_id())
    ranged = materialise(ranged, "keys")
    order = W.partitionBy("range").orderBy("doc_id", "digest")
    # One row for each range.
    sizes = ranged.select("range", "doc_id", "digest").distinct().groupBy("range").count()
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    numbered = ranged.join(F.broadcast(starts), "range")
    number = (F.col("start") + F.dense_rank().over(order)).cast("long").alias("number")
    return materialise(numbered.select(number, "doc_id", "text"), "numbered")


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: sizes, maximal removed runs and the
    bytes that remain, of every document."""
    texts = documents.selectExpr(f"cast(`{key}` as long) as doc_id", f"cast(`{text}` as string) as text")
    numbered = _numbered(texts)
    if numbered is None:
        return _without_repeats(texts)
    # Copies of a row give the same result, so one of them names the key.
    names = numbered.select("number", F.col("doc_id").alias("key")).distinct()
    others = texts.where("doc_id is null")
    found = _without_repeats(numbered.select(F.col("number").alias("doc_id"), "text").unionByName(others))
    named = found.join(names, found["doc_id"] == names["number"], "left")
    return named.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def _without_repeats(texts: DataFrame) -> DataFrame:
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    places = _prime(max(2, -(-size // RANGE_BYTES)))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(places, "place").sortWithinPartitions("place", "kind")

    dealt_texts = texts.mapInArrow(_deal_texts(places), ROWS)
    found = dealt(texts.mapInArrow(_find_anchors(places), ROWS)).mapInArrow(_keep_repeated(places), ROWS)
    found = materialise(found, "anchors")
    runs = dealt(found.where("kind = 0").unionByName(dealt_texts)).mapInArrow(_make_runs(places), ROWS)
    marked = dealt(runs).mapInArrow(_merge(places), ROWS)
    settled = found.where("kind = 2").withColumn("kind", F.lit(0))
    everything = dealt(marked.unionByName(settled).unionByName(dealt_texts))
    return everything.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
