"""Sets of word shingles and their sketches, for many texts at once."""

from __future__ import annotations

import numpy as np

from presscheck.llm.words import Words, lower_table, mix, ngram_hashes, not_space, whole_ngrams


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where each text's begin.

    Words end at white space, with A-Z lower-cased. A text of fewer words than
    ``width``, but not none, has its whole sequence as its only shingle.
    """
    words = Words(lower_table()[data], bounds, not_space())
    hashes, counts = words.hashes(), words.counts
    at = whole_ngrams(words.first, width, len(words))
    values, owner = ngram_hashes(hashes, width)[at], words.doc[at]
    for n in set(counts[(counts > 0) & (counts < width)].tolist()):
        short = np.flatnonzero(counts == n)
        values = np.concatenate([values, ngram_hashes(hashes, n)[words.first[short]]])
        owner = np.concatenate([owner, short])
    if len(at) < len(owner):
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(bounds)))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.concatenate([[0], np.cumsum(fresh)])[first]


def fast_sketches(values: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` coordinates for each set; two sets agree in a coordinate with
    a probability of their similarity.

    In round i every element falls into one bin, with a value below all values of later
    rounds. In the first ``size`` rounds the bin is random; round ``size + j`` puts all
    elements into bin j, so that every bin of a non-empty set is filled in the end. A set
    is done once its bins are full, which for large sets takes few rounds.
    """
    sets = len(first) - 1
    out = np.full(sets * size, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(sets), np.diff(first))
    for i in range(2 * size):
        if not len(values):
            break
        h = mix(values, i + 17)
        if i < size:
            place = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(h), i - size)
        value = (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(10)) | np.uint64(i << 54)
        np.minimum.at(out, owner * size + place, value)
        open_ = (out.reshape(sets, size) == np.iinfo(np.uint64).max).any(axis=1)[owner]
        if not open_.all():
            values, owner = values[open_], owner[open_]
    return out.reshape(sets, size)


def band_hashes(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each band of ``rows`` coordinates, different from band to band."""
    bands = sketches.reshape(len(sketches), -1, rows)
    out = mix(np.arange(bands.shape[1], dtype=np.uint64), 5)[None, :] + bands[:, :, 0]
    for k in range(1, rows):
        out = mix(out, 7) + bands[:, :, k]
    return mix(out, 9)


def set_keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share, as two numbers."""
    sizes = np.diff(first).astype(np.uint64)
    keys = []
    for seed in (101, 202):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values, seed))])
        keys.append(mix(total[first[1:]] - total[first[:-1]] + sizes, seed + 1))
    return keys[0], keys[1]
