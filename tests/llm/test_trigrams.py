"""The model of order three against a plain program."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from presscheck.llm import language_model
from presscheck.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, text string"


def words_of(text):
    return [*[w for w in re.split(r"[ \t-\r]+", (text or "").translate(LOWER)) if w], 1]


def plain_model(train):
    """The probability of a token after two others; 0 is the start."""
    raw = Counter(p for t in train for p in zip([0, *t], t))
    triples = Counter(x for t in train for x in zip([0, *t], t, t[1:]))
    types = len({w for _, w in raw})
    middle = Counter((u, w) for _, u, w in triples)
    middle.update({p: n for p, n in raw.items() if p[0] == 0})
    after = Counter(w for _, w in raw)

    def level(counts):
        stands, kinds = Counter(), defaultdict(Counter)
        for gram, n in counts.items():
            stands[gram[:-1]] += n
            kinds[gram[:-1]][min(n, 3)] += 1
        return counts, stands, kinds, language_model.discounts([sum(n == k for n in counts.values()) for k in (1, 2, 3, 4)])

    levels = [level(middle), level(triples)]
    of_word = language_model.discounts([sum(n == k for n in after.values()) for k in (1, 2, 3, 4)])
    rest = sum(of_word[min(n, 3)] for n in after.values()) / len(raw)

    def p(v, u, w):
        out = (after[w] - of_word[min(after[w], 3)]) / len(raw) + rest / (types + 1)
        for (counts, stands, kinds, off), context in zip(levels, ((u,), (v, u))):
            if stands[context]:
                n = counts[(*context, w)]
                left = sum(off[k] * kinds[context][k] for k in (1, 2, 3)) / stands[context]
                out = (n - off[min(n, 3)]) / stands[context] + left * out
        return out

    return p, [*after], [*triples]


def logs(p, words):
    return sum(math.log10(p(v, u, w)) for v, u, w in zip([None, 0, *words], [0, *words], words))


def test_query_scores_at_order_three(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 60_000)
    monkeypatch.setattr(language_model, "_FLUSH_TRIPLES", 5_000)
    tokens = {r.doc_id: words_of(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    p, known, triples = plain_model([t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2])
    for v, u, _ in [(None, 0, None), *triples[::4000]]:
        assert sum(p(v, u, w) for w in known) + p(v, u, "\0") == pytest.approx(1)
    gain = 0
    for r in QUERIES["op10_language_model"](spark, SMALL).collect():
        assert r.score == pytest.approx(logs(p, tokens[r.doc_id]))
        gain += r.score - r.bigram_score
    assert gain > 0


def test_the_second_word_back_counts(spark):
    rows = [(i, f"{a} of {b}") for i, (a, b) in enumerate([("north", "york"), ("south", "kent")] * 300)]
    train = spark.createDataFrame(rows, COLUMNS)
    asked = spark.createDataFrame([(1, "north of york"), (2, "north of kent")], COLUMNS)
    found = {r.doc_id: r.lm for r in language_model.score(asked, language_model.fit(train)).collect()}
    p, *_ = plain_model([words_of(t) for _, t in rows])
    assert found[1].bigram_score == pytest.approx(found[2].bigram_score) and found[1].score > found[2].score + 1
    assert all(found[i].score == pytest.approx(logs(p, words_of(t))) for i, t in ((1, "north of york"), (2, "north of kent")))
    two = {r.doc_id: r.lm for r in language_model.score(asked, language_model.fit(train, order=2)).collect()}
    assert all(two[i].score == two[i].bigram_score == pytest.approx(found[i].bigram_score) for i in (1, 2))
    with pytest.raises(ValueError):
        language_model.fit(train, order=4)


def test_counts_beyond_32_bits_survive():
    import numpy as np

    counts = np.array([1, 254, 255, 70_000, 5_000_000_000, 3])
    assert language_model._unpack_counts([language_model._pack_counts(counts)], [6]).tolist() == counts.tolist()


def test_columns_of_words_and_counts_come_back_and_are_small():
    rng = np.random.default_rng(6)
    words = [rng.zipf(1.3, n).astype(np.uint64) * np.uint64(0x9E3779B97F4B) % np.uint64(1 << 48) for n in (30_000, 30_000, 50_000)]
    counts = [rng.integers(1, 3, 30_000), np.where(rng.random(50_000) < 0.01, rng.integers(250, 1 << 40, 50_000), 1)]
    packed = language_model._pack(words, counts)
    found = language_model._unpack(packed)
    for columns, want in zip(found, (words, counts), strict=True):
        assert all((a == b).all() for a, b in zip(columns, want, strict=True))
    # Six bytes a word before.
    assert len(packed) < 3 * sum(map(len, words))
    none = language_model._unpack(language_model._pack([np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]))
    assert [len(x) for x in (*none[0], *none[1])] == [0, 0]


def test_stored_counts_take_a_byte_each(tmp_path):
    counts = np.array([[1, 255, 3], [254, 70_000, 0], [256, 1, 1 << 40]])
    language_model._store(str(tmp_path), "contexts-0", np.array([5, 7, 9], np.uint64))
    language_model._store_counts(str(tmp_path), "kinds", 0, counts)
    assert (tmp_path / "kinds-0").stat().st_size == counts.size
    model = language_model.Model(3, str(tmp_path), 1, *[0] * 8)
    keys = np.array([4, 5, 7, 8, 9], np.uint64)
    found = model.counts("contexts", "kinds", 3, keys, np.zeros(5, np.int64))
    assert found.tolist() == [[0] * 3, counts[0].tolist(), counts[1].tolist(), [0] * 3, counts[2].tolist()]


def test_triples_take_few_bytes_on_the_way_and_in_the_model(spark, tmp_path):
    rng = np.random.default_rng(7)
    words = rng.zipf(1.2, 400_000) % 30_000
    texts = [" ".join(f"w{w}" for w in words[i : i + 400]) for i in range(0, len(words), 400)]
    corpus = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    model = language_model.fit(corpus, folder=str(tmp_path))
    tokens = [[*t.split(), 1] for t in texts]
    triples = {x for t in tokens for x in zip([0, *t], t, t[1:])}
    pairs = {x for t in tokens for x in zip([0, *t], t)}
    # Eight bytes of hash and a count or two before.
    assert sum(f.stat().st_size for f in tmp_path.iterdir()) < 0.75 * (9 * len(triples) + 10 * len(pairs))
    batch = pa.RecordBatch.from_pydict({"text": texts})
    for parts, most in ((model.buckets, 3.5), (40, 5)):
        folder = str(tmp_path) if parts == model.buckets else str(tmp_path / "more")
        if parts != model.buckets:
            (tmp_path / "more").mkdir()
            for row in (r for m in language_model._count_words(parts)(iter([batch])) for r in m.to_pylist()):
                [*language_model._rank_words(folder, parts)(iter([pa.RecordBatch.from_pylist([row])]))]
        found = [r for m in language_model._count_triples(folder, parts)(iter([batch])) for r in m.to_pylist()]
        assert sum(len(r["packed"]) for r in found) < most * len(triples)
        # Every token is the last of one.
        assert sum(int(c[1].sum()) for c in (language_model._unpack(r["packed"])[1] for r in found)) == sum(map(len, tokens))


def test_frequent_pairs_with_many_followers(spark):
    texts = [f"of the x{i % 300} of the y{i % 7} end{i}" for i in range(900)] + ["of the", "the", "", None] * 3
    train = spark.createDataFrame([*enumerate(texts)], COLUMNS)
    p, *_ = plain_model([words_of(t) for t in texts])
    asked = spark.createDataFrame([*enumerate([*texts[::50], "of the x299 of the nothing", "y3 of the y3"])], COLUMNS)
    for r in language_model.score(asked, language_model.fit(train)).collect():
        assert r.lm.score == pytest.approx(logs(p, words_of(r.text)))


@pytest.mark.parametrize("size", [0, 1, 16, 17, 5_000])
@pytest.mark.parametrize("bits", [20, 50, 64])
def test_stored_keys_are_found(tmp_path, size, bits):
    rng = np.random.default_rng(size + bits)
    keys = np.unique(rng.integers(0, 1 << bits, size, np.uint64) if bits < 64 else rng.integers(0, (1 << 64) - 1, size, np.uint64))
    language_model._store_keys(str(tmp_path), "pairs", 3, keys)
    asked = np.unique(np.concatenate([keys, keys + np.uint64(1), rng.integers(0, (1 << 64) - 1, 300, np.uint64), np.array([0], np.uint64)]))
    at, known = language_model._find(str(tmp_path), "pairs", 3, asked)
    assert known.tolist() == np.isin(asked, keys).tolist()
    assert (keys[at[known]] == asked[known]).all()


def test_rows_of_numbers_are_sorted_beyond_64_bits_as_well():
    rng = np.random.default_rng(9)
    for top in (8, 1 << 20, 1 << 40):
        rows = rng.integers(0, 8, (3, 2_000)).astype(np.uint64) * np.uint64(top // 8)
        found, counts = language_model._distinct([*rows])
        want = sorted(Counter(zip(*rows.tolist())).items())
        assert [*zip(*(x.tolist() for x in found))] == [k for k, _ in want] and counts.tolist() == [n for _, n in want]
        order = language_model._order(*rows)
        assert [*zip(*rows[:, order].tolist())] == sorted(zip(*rows.tolist()))


def test_where_triples_of_a_pair_begin(tmp_path):
    rng = np.random.default_rng(10)
    for size in (0, 1, 64, 1_000):
        start = np.flatnonzero((rng.random(size) < 0.4) | (np.arange(size) % 500 == 0))
        language_model._store_heads(str(tmp_path), size, start, size)
        found = language_model._heads(str(tmp_path), size, np.arange(len(start) + 1), size)
        assert found.tolist() == [*start.tolist(), size]


def test_texts_that_change_while_they_are_counted_are_an_error(tmp_path):
    batch = pa.RecordBatch.from_pydict({"text": ["a new word"]})
    with pytest.raises(ValueError, match="changed"):
        [*language_model._count_triples(str(tmp_path), 1)(iter([batch]))]
