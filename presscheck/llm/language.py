"""Languages of whole texts and of the spans in mixed ones.

Words are runs of letters and marks, lower-cased. A word's features are its whole form
and its letter pairs and triples with the word's edges; each has a learned probability in
each language. The script of a word's first letter narrows the languages to those that
use it. Over the words of a text, Viterbi's algorithm finds the languages with the best
sum of scores less a penalty for every switch; runs of words with one language are the
spans. A text's language is that with most letters, and its score is their share.

The model is fitted on at most about ``SAMPLE`` labelled texts, chosen by a hash of the
text. Detection looks at texts only, at all of each, and shuffles nothing.

Null texts and texts without letters are ``und`` with score 0, as are all texts if
nothing was learned. Rows without a label teach nothing. Repeated rows get equal results.
A column that has the name of the result is replaced; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from presscheck.llm.tables import materialise, share, shared, slices
from presscheck.llm.worker import kept
from presscheck.llm.words import Spans

SAMPLE = 20_000
BUCKETS = 1 << 17
SWITCH = 12.0
# A language uses a script if at least this share of its words does.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
OUT = "struct<lang:string,score:double,spans:array<struct<lang:string,start:long,end:long>>>"
# First code points of script ranges; a range ends where the next begins.
# Scripts that share a language's text, as in Japanese, count as one.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "oriya"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "myanmar"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x1380, "other"),
    (0x1780, "khmer"),
    (0x1800, "other"),
    (0x1C80, "cyrillic"),
    (0x1C90, "georgian"),
    (0x1CC0, "other"),
    (0x1D00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "latin"),
    (0x2C00, "other"),
    (0x2C60, "latin"),
    (0x2C80, "other"),
    (0x2E80, "han"),
    (0x3040, "kana"),
    (0x3130, "hangul"),
    (0x3190, "han"),
    (0xA000, "other"),
    (0xA640, "cyrillic"),
    (0xA6A0, "other"),
    (0xA720, "latin"),
    (0xA800, "other"),
    (0xAC00, "hangul"),
    (0xD7FC, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB13, "armenian"),
    (0xFB1D, "hebrew"),
    (0xFB50, "arabic"),
    (0xFE00, "other"),
    (0xFE70, "arabic"),
    (0xFF00, "latin"),
    (0xFF66, "kana"),
    (0xFFA0, "hangul"),
    (0xFFE0, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


def _character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: 2 for a letter, 1 for a mark; its lower case; its script."""
    import unicodedata

    count = 0x110000
    kind, lower, script = np.zeros(count, np.uint8), np.arange(count, dtype=np.uint32), np.zeros(count, np.uint8)
    for c in range(count):
        category = unicodedata.category(chr(c))[0]
        if category == "L":
            kind[c] = 2
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
        elif category == "M":
            kind[c] = 1
    for (start, name), end in zip(SCRIPTS, [s for s, _ in SCRIPTS[1:]] + [count]):
        script[start:end] = SCRIPT_NAMES.index(name)
    return kind, lower, script


class _Text:
    """The words of several texts as code points."""

    def __init__(self, texts: list[str | None]):
        kind, lower, scripts = kept("characters", _character_tables)
        # A blank behind each text keeps words apart.
        joined = "".join([(t or "") + " " for t in texts])
        data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.bounds = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
        kinds = kind[data]
        inside = np.concatenate([[0], (kinds > 0).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(inside)).reshape(-1, 2)
        letters = np.concatenate([[0], np.cumsum(kinds == 2)])
        edges = edges[letters[edges[:, 1]] > letters[edges[:, 0]]]
        self.start, self.end = edges[:, 0], edges[:, 1]
        self.letters = letters[self.end] - letters[self.start]
        self.data = lower[data]
        # The first letter, behind marks that may precede it.
        first = np.searchsorted(letters, letters[self.start] + 1) - 1
        self.script = scripts[data[first]] if len(data) else np.zeros(0, np.uint8)
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each feature, and the word it belongs to."""
        # Words between marks of their edges, one after the other.
        sizes = self.end - self.start
        total = np.cumsum(sizes + 2)
        begin = total - sizes - 2
        out = np.ones(total[-1] if len(total) else 0, np.uint32)
        word = np.repeat(np.arange(len(sizes)), sizes + 2)
        place = np.arange(len(out)) - begin[word]
        inner = (place > 0) & (place <= sizes[word])
        out[inner] = self.data[self.start[word[inner]] + place[inner] - 1]
        spans = Spans(out)
        found, owner = [spans.hashes(begin, total)], [np.arange(len(sizes))]
        for n in (2, 3):
            at = np.flatnonzero(place + n <= sizes[word] + 2)
            found.append(spans.hashes(at, at + n))
            owner.append(word[at])
        return (np.concatenate(found) >> np.uint64(47)).astype(np.int64), np.concatenate(owner)


def _count(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                text = _Text(part["text"].to_pylist())
                own = np.array([languages.index(x) for x in part["lang"].to_pylist()], np.int64)[text.doc]
                bucket, word = text.features()
                counts += np.bincount(own[word] * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
                scripts += np.bincount(own * len(SCRIPT_NAMES) + text.script, minlength=scripts.size).reshape(scripts.shape)
        packed = [[c.tobytes() for c in x] for x in (counts, scripts)]
        arrays = [pa.array(range(len(languages)), pa.int32()), *[pa.array(x, pa.binary()) for x in packed]]
        yield pa.RecordBatch.from_arrays(arrays, ["language", "counts", "scripts"])

    return run


@dataclass
class Model:
    languages: list[str]
    # Log probability of a feature in a language, less the mean of all languages.
    weights: np.ndarray
    # Which languages use a script.
    uses: np.ndarray
    switch: float = SWITCH

    def word_scores(self, text: _Text) -> np.ndarray:
        bucket, word = text.features()
        order = np.argsort(word, kind="stable")
        starts = np.searchsorted(word[order], np.arange(len(text.start)))
        sums = np.add.reduceat(self.weights[bucket[order]], starts) if len(starts) else np.zeros((0, len(self.languages)))
        allowed = self.uses[text.script]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), sums, -1e6)

    def label(self, text: _Text) -> np.ndarray:
        """The language of each word on the best path of its text."""
        scores = self.word_scores(text)
        stay = np.ones(scores.shape, bool)
        other = np.zeros(len(scores), np.int64)
        out = np.zeros(len(scores), np.int64)
        order = np.argsort(-text.counts, kind="stable")
        first, counts = text.first[:-1][order], text.counts[order]
        # Texts that reach step t are the first ones in this order.
        reach = len(counts) - np.searchsorted(counts[::-1], np.arange(counts[0] if len(counts) else 0), "right")
        best = np.zeros((len(counts), len(self.languages)))
        for t, n in enumerate(reach.tolist()):
            at = first[:n] + t
            if t:
                top = best[:n].argmax(axis=1)
                change = best[np.arange(n), top][:, None] - self.switch
                stay[at] = best[:n] >= change
                other[at] = top
                best[:n] = np.maximum(best[:n], change)
            best[:n] += scores[at]
        state = best.argmax(axis=1)
        for t in range(len(reach) - 1, -1, -1):
            n = reach[t]
            at = first[:n] + t
            out[at] = state[:n]
            state[:n] = np.where(stay[at, state[:n]], state[:n], other[at])
        return out


def fit(texts: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE, switch: float = SWITCH) -> Model:
    known = texts.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    known = known.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang"))
    share_ = min(sample / max(known.count(), 1), 1.0)
    chosen = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share_ * (1 << 30)) + 1)
    labelled = materialise(chosen, "labelled")
    languages = sorted(row.lang for row in labelled.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), switch)
    counts = np.zeros((len(languages), BUCKETS))
    scripts = np.zeros((len(languages), len(SCRIPT_NAMES)))
    # A fixed number of counts for each language and task of the bounded sample.
    for row in labelled.mapInArrow(_count(languages), "language int, counts binary, scripts binary").toLocalIterator():
        counts[row.language] += np.frombuffer(row.counts, np.int64)
        scripts[row.language] += np.frombuffer(row.scripts, np.int64)
    logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    weights = (logs - logs.mean(axis=0)).T.astype(np.float32)
    uses = (scripts >= SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True)) & (scripts > 0)
    return Model(languages, np.ascontiguousarray(weights), uses.T, switch)


def _detector(model, column: str, carried: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared(model)
        names = np.array([*m.languages, UNKNOWN], object)
        span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in slices(batch, column):
                text = _Text(part[column].to_pylist())
                n, count = len(m.languages), len(part)
                found, score, rows = np.full(count, n), np.zeros(count), [[] for _ in range(count)]
                if n and len(text.start):
                    labels = m.label(text)
                    letters = np.bincount(text.doc * n + labels, text.letters, count * n).reshape(count, n)
                    some = letters.sum(axis=1) > 0
                    found[some] = letters[some].argmax(axis=1)
                    score[some] = letters[some].max(axis=1) / letters[some].sum(axis=1)
                    turn = np.ones(len(labels), bool)
                    turn[1:] = (labels[1:] != labels[:-1]) | (text.doc[1:] != text.doc[:-1])
                    begin = np.flatnonzero(turn)
                    last = np.append(begin[1:], len(labels)) - 1
                    shift = text.bounds[text.doc[begin]]
                    spans = zip(text.doc[begin], names[labels[begin]], text.start[begin] - shift, text.end[last] - shift)
                    for d, lang, a, b in spans:
                        rows[d].append({"lang": lang, "start": a, "end": b})
                struct = pa.StructArray.from_arrays(
                    [pa.array(names[found], pa.string()), pa.array(score), pa.array(rows, pa.list_(span))],
                    ["lang", "score", "spans"],
                )
                yield pa.RecordBatch.from_arrays([*[part[c] for c in carried], struct], [*carried, out])

    return run


def detect(documents: DataFrame, model: Model, text: str = "text", out: str = "language", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all, unless given) and the struct ``out``: ``lang``, ``score``
    and ``spans``, from code point ``start`` to before ``end``."""
    carry = [c for c in (documents.columns if carry is None else carry) if c != out]
    schema = StructType(documents.select(*carry).schema.fields).add(out, DataType.fromDDL(OUT))
    columns = [*[c for c in carry if c != text], text]
    shared_model = share(documents.sparkSession, model)
    return documents.select(*columns).mapInArrow(_detector(shared_model, text, carry, out), schema)
