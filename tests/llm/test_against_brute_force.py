"""Operators against plain programs that try everything."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presscheck.llm import fingerprints, language, language_model, near_duplicates, packing, suffixes, token_files, toxicity
from presscheck.llm.components import components
from presscheck.llm.queries import QUERIES, vocabulary
from presscheck.llm.shingles import fast_sketches, shingle_sets
from presscheck.llm.suffixes import merge_runs
from presscheck.llm.tables import scratch_path
from presscheck.llm.tokens import Encoder
from presscheck.llm.words import Spans, Words, not_space

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


def packed(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


# Words and hashes.


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \n\té", max_size=12), min_size=1, max_size=5))
def test_words(texts):
    words = Words(*packed(texts), not_space())
    want = [(d, w.encode()) for d, t in enumerate(texts) for w in re.findall(r"[^ \t-\r]+", t)]
    assert [(int(d), words.text(i)) for i, d in enumerate(words.doc)] == want
    known = defaultdict(set)
    for (_, w), h in zip(want, words.hashes()):
        known[w].add(int(h))
    assert all(len(h) == 1 for h in known.values()) and len(set.union(set(), *known.values())) == len(known)


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(bytes(random.Random(1).choices(b"abc", k=3000)), np.uint8)
    start = np.arange(2990)
    known = {}
    for s, h in zip(start, Spans(data).hashes(start, start + 10)):
        assert known.setdefault(data[s : s + 10].tobytes(), h) == h
    assert len(set(known.values())) == len(known)


# Fingerprints.


def shingles(text, width=5):
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def test_fingerprint_query(spark, texts, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 100_000)
    rows = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SMALL).collect()}
    order = sorted(texts, reverse=True)
    assert set(rows) == set(order)
    for i, d in enumerate(order):
        text, follows = texts[d], texts[order[(i + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + follows[:third]
        assert rows[d].n_chars == len(text)
        assert rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, rows[d].near_edited), (follows, rows[d].near_next)):
            a, b = shingles(text), shingles(other)
            want = len(a & b) / len(a | b) if a | b else 1.0
            assert near == pytest.approx(want, abs=1e-9 if len(a | b) <= fingerprints.SIZE else 0.2)


def test_fingerprints_merge(spark):
    words = [f"w{i}" for i in range(1200)]
    parts = [(1, " ".join(words[:500])), (1, " ".join(words[496:])), (2, "a b"), (3, "")]
    sketched = spark.createDataFrame(parts, "id int, t string").select("id", fingerprints.fingerprint(fingerprints.F.col("t")).alias("s"))
    merged = {r.id: r.s for r in fingerprints.merge(sketched, "id", "s").collect()}
    whole = spark.createDataFrame([(" ".join(words),)], "t string").select(fingerprints.fingerprint(fingerprints.F.col("t")).alias("s"))
    assert merged[1] == whole.first().s and len(merged[2]) == 1 and 3 not in merged
    count = whole.select(fingerprints.shingle_count(fingerprints.F.col("s"))).first()[0]
    assert count == pytest.approx(1196, rel=0.35)


# Suffixes.


def covered(docs, length=100):
    first, out = set(), {}
    for d, t in sorted(docs):
        data = t.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in first:
                gone[s : s + length] = b"\1" * length
            first.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_query(spark, texts, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 100_000)
    rows = QUERIES["op3_suffix_dedup"](spark, SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == covered(texts.items()) and len(rows) == len(texts)


def test_suffixes_of_periodic_and_patched_texts(spark):
    rng = random.Random(5)
    blocks = ["".join(rng.choices("ab", k=60)) for _ in range(6)] + ["a" * 70, "ab" * 40, "é" * 45]
    docs = [(i, "".join(rng.choices(blocks, k=rng.randint(0, 6)))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = suffixes.remove_repeats(frame).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows}
    assert got == covered(docs)


@pytest.mark.parametrize("stretch", [100, 157, 1000])
def test_suffixes_of_texts_in_many_stretches_and_runs(spark, monkeypatch, stretch):
    for name, value in (("STRETCH", stretch), ("RUN_SUFFIXES", 7), ("_STEP", 3), ("_FLUSH", 50), ("RANGE_BYTES", 2000)):
        monkeypatch.setattr(suffixes, name, value)
    rng = random.Random(stretch)
    passage = "".join(rng.choices("abcdefgh", k=260))
    docs = []
    for i in range(40):
        # One passage in most documents, each time among other bytes, and some of it twice.
        cut = rng.randrange(120)
        parts = ["".join(rng.choices("abcdefgh", k=rng.randint(0, 700))), passage[cut:], passage[: 260 - cut], "\x00" * rng.choice([0, 130])]
        rng.shuffle(parts)
        docs.append((i, "".join(parts)))
    rows = suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows} == covered(docs)


def test_suffixes_of_repeated_keys(spark):
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh", k=300))
    texts = {2: ["x" * 5, passage, passage[50:] + "y", None], 1: [passage[100:]], 9: ["z" + passage]}
    rows = [(k, t) for k, own in texts.items() for t in own] + [(2, passage), (None, passage), (None, None)]
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    # Numbered by key and then by the hash of the text; the copy of a row is the same document.
    ordered = sorted(((k, t or "") for k, own in texts.items() for t in own), key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    want = covered([(i, t) for i, (_, t) in enumerate(ordered)])
    named = [(ordered[i][0], *row) for i, row in want.items()]
    named += [(2, *want[ordered.index((2, passage))])]
    whole = hashlib.sha256(passage.encode()).hexdigest()
    named += [(None, 300, 0, 0, whole), (None, 0, 0, 0, hashlib.sha256(b"").hexdigest())]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert sorted(got, key=repr) == sorted(named, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=4, max_size=4).map(lambda b: bytes(x & 1 for x in b)), max_size=8), min_size=1, max_size=6))
def test_merging_runs(runs):
    runs = [sorted(r) for r in runs if r]
    if not runs:
        return
    common = lambda a, b: next((i for i in range(4) if a[i] != b[i]), 4)
    coded = [(r, [0, *map(common, r, r[1:])]) for r in runs]
    merged = [(runs[r][i], n) for r, i, n in merge_runs(coded)]
    want = sorted(x for r in runs for x in r)
    assert [s for s, _ in merged] == want
    assert [n for _, n in merged[1:]] == [common(a, b) for a, b in zip(want, want[1:])]


# Tokens.

PIECES = ["a", "word", " ", "  ", "\n", "\t", "\r\n", "é", "'s", "'", "12", ".", "!!", "\x1c", "\x85", " ", "<|endoftext|>", "ß", "日本", "̈", "😀", "\x00"]


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_the_tokenizer(name, blanks):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    own, rng = Encoder(vocabulary(name), blanks, pieces=300), random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        want = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_new_words_go_straight_to_the_model(name, blanks):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary(name))
    own, rng = Encoder(vocabulary(name), blanks), random.Random(4)
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(2000)] + ["İ", "aİe", "ª", "ǅ"]

    class Counting:
        sent = 0

        def encode_batch_fast(self, texts, **options):
            self.sent += sum(map(len, texts))
            return plain.encode_batch_fast(texts, **options)

    own.tokenizer = counting = Counting()
    text = " ".join(words)
    want = [*plain.encode(text, add_special_tokens=False).ids, 1]
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want
    counting.sent = 0
    text = " ".join("".join(rng.choices("etaoinäéñÖ", k=9)) + rng.choice(["", ",", "&&&"]) for _ in range(2000))
    want = [*plain.encode(text, add_special_tokens=False).ids, 1]
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want
    assert counting.sent < len(text) / 50


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cuts_beside_odd_letters_and_spaces(name, blanks):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary(name))
    own, rng = Encoder(vocabulary(name), blanks), random.Random(5)
    odd = ["İ", "İ!", "é", "é!", "×?", "÷", "e\u0301.", "don't", "'ll", "<\u0338", " ", " ", "\n", "\u00a0", "\u2003", "\u3000", "\u1680", "“a”", "あ", "ắ", "\x00", "x"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(1500)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        want = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


def test_a_tokenizer_that_changes_words_gets_whole_texts(tmp_path):
    import json

    path = vocabulary("byte_bpe_50k.json")
    changed = json.loads(open(path, encoding="utf-8").read())
    changed["normalizer"] = {"type": "Replace", "pattern": {"String": "ä"}, "content": "ae"}
    (tmp_path / "changed.json").write_text(json.dumps(changed), encoding="utf-8")
    own = Encoder(str(tmp_path / "changed.json"), True)
    text = "the läst häuser were blä, blä"
    assert own.fold is None and own.encode([text]) == Encoder(path, True).encode([text.replace("ä", "ae")])


def whole_ids(texts, name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary(name))
    plain.encode_special_tokens = True
    return {d: np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}


def test_packing_query(spark, texts):
    ids = whole_ids(texts, "byte_bpe_50k.json")
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in QUERIES["op5_packing"](spark, SMALL).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length])
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for parts, full in [(p, None) for p in sequences.values()] + [(p, len(ids[d])) for d, p in pieces.items()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == full if full else end <= 2048 and end & (end - 1) == 0
    assert set(pieces) == set(ids)


def packed_bins(lengths, capacity=2048):
    """The sequences of one worker, with ids that tell document and place."""
    bins = packing.Bins(capacity)
    ids = [np.arange(n, dtype="<u4") + 1_000_000 * (d + 1) for d, n in enumerate(lengths)]
    out = [s for d, n in enumerate(lengths) for s in bins.add((d, 0, n, n, ids[d].tobytes()))]
    out += bins.finish()
    seen = defaultdict(list)
    for sequence in out:
        used = sum(p[2] for p in sequence)
        assert used == capacity or used < capacity and used & (used - 1) == 0
        for d, start, n, total, own in sequence:
            assert total == lengths[d] and own == ids[d][start : start + n].tobytes()
            seen[d].append((start, n))
    for d, n in enumerate(lengths):
        end = 0
        for start, size in sorted(seen[d]):
            assert start == end and size > 0
            end += size
        assert end == n
    return out, seen


@given(st.lists(st.one_of(st.integers(1, 40), st.integers(1, 2100), st.integers(1, 9000)), max_size=120))
def test_packing_of_any_lengths(lengths):
    packed_bins(lengths)


def test_bins_of_a_class_hold_its_number_of_whole_documents():
    lengths = random.Random(3).choices([n for n in range(1, 2049)], k=3000) + [12_000] * 300
    random.Random(4).shuffle(lengths)
    out, seen = packed_bins(lengths)
    whole = [len(seen[d]) == 1 for d, n in enumerate(lengths) if n <= 2048]
    assert sum(whole) / len(whole) > 0.97
    for sequence in out[: len(out) // 2]:
        kept = [n for _, start, n, total, _ in sequence if n == total <= 2048]
        if kept:
            assert len({2048 // n for n in kept}) == 1 and len(kept) == 2048 // kept[0]


def test_documents_are_cut_if_none_is_long():
    lengths = random.Random(5).choices(range(700, 1500), k=3000)
    out, seen = packed_bins(lengths)
    assert sum(len(s) == 1 for s in seen.values()) / len(lengths) > 0.6


def test_most_documents_stay_whole(spark, texts):
    ids = whole_ids(texts, "byte_bpe_50k.json")
    pieces = Counter(r.doc_id for r in QUERIES["op5_packing"](spark, "/root/testdata/sf0.01").where("doc_tokens <= 2048").collect())
    assert sum(n == 1 for n in pieces.values()) / len(pieces) > 0.9 and ids


@pytest.mark.parametrize("delta", [False, True])
def test_token_files(spark, documents, texts, delta):
    import pyarrow.parquet as pq

    ids = whole_ids(texts, "word_bpe_49k.json")
    path = scratch_path(spark, "tokens")
    token_files.write(documents, path, vocabulary("word_bpe_49k.json"), delta=delta)
    stored = token_files.read(spark, path)
    assert {r.doc_id: r.tokens for r in stored.collect()} == {d: x.tolist() for d, x in ids.items()}
    start = 0
    for r in sorted(token_files.digests(stored).collect()):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id]))
        start += r.n_tokens
    file = next(f for f in stored.inputFiles() if f.endswith(".parquet")).removeprefix("file://")
    column = pq.ParquetFile(file).metadata.row_group(0).column(4)
    assert column.has_offset_index and ("DELTA_BINARY_PACKED" if delta else "RLE_DICTIONARY") in column.encodings
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in stored.where("doc_id = 7")._jdf.queryExecution().toString()


# Near duplicates.


def near_groups(texts, width, percent):
    sets = {d: shingles(t.translate(LOWER), width) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in texts}


def test_near_duplicates(spark, texts):
    rng = random.Random(2)
    docs = dict(texts)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    for i in range(300):  # One large group, some members of which are linked only to some others.
        copy = [w if rng.random() > 0.02 * (i % 9) else rng.choice(words) for w in base]
        docs[1000 + i] = " ".join(copy)
    for width, percent in ((2, 80), (5, 80)):
        frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.find(frame, width=width, percent=percent).collect()}
        assert got == near_groups(docs, width, percent)


def test_sketches_estimate_similarity():
    rng = random.Random(4)
    for n in (1, 3, 40, 1000):
        pool = [f"x{i}" for i in range(2 * n)]
        a, b = set(pool[: n + n // 2]), set(pool[n // 2 : 2 * n])
        sets = [" ".join(rng.sample(sorted(s), len(s))) for s in (a, b)]
        sketch = fast_sketches(*shingle_sets(*packed(sets), 1), 240)
        assert (sketch != np.iinfo(np.uint64).max).all()
        want = len(a & b) / len(a | b)
        assert (sketch[0] == sketch[1]).mean() == pytest.approx(want, abs=0.17)


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 90)] + [tuple(rng.sample(range(1000, 1300), 2)) for _ in range(140)]
    links += [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent}


# Models.


def test_kneser_ney(spark, texts, monkeypatch):
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 60_000)
    tokens = {d: [*[w for w in re.split(r"[ \t-\r]+", t.translate(LOWER)) if w], 1] for d, t in texts.items()}
    held_out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    train = [t for d, t in tokens.items() if not held_out[d]]
    count = Counter(w for t in train for w in t)
    total, types = sum(count.values()), len(count)
    pairs = Counter(p for t in train for p in zip([0, *t], t))
    stands, after, kinds = Counter(), Counter(), defaultdict(Counter)
    for (u, w), n in pairs.items():
        stands[u] += n
        after[w] += 1
        kinds[u][min(n, 3)] += 1
    of_pair = language_model.discounts([sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)])
    of_word = language_model.discounts([sum(n == k for n in after.values()) for k in (1, 2, 3, 4)])
    rest = sum(of_word[min(n, 3)] for n in after.values()) / len(pairs)

    def p(u, w):
        alone = (after[w] - of_word[min(after[w], 3)]) / len(pairs) + rest / (types + 1)
        if not stands[u]:
            return alone
        n = pairs[u, w]
        left = sum(of_pair[k] * kinds[u][k] for k in (1, 2, 3)) / stands[u]
        return (n - of_pair[min(n, 3)]) / stands[u] + left * alone

    for u in [0, *sorted(x for x in stands if isinstance(x, str))[::900]]:
        assert sum(p(u, w) for w in count) + p(u, "\0") == pytest.approx(1)
    sums = Counter()
    for r in QUERIES["op10_language_model"](spark, SMALL).collect():
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held_out[r.doc_id], len(own), total)
        assert r.n_known == sum(count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own))
        assert r.bigram_score == pytest.approx(sum(math.log10(p(u, w)) for u, w in zip([0, *own], own)))
        sums[r.held_out] += r.bigram_score - r.base_score
    assert sums[True] > 0 and sums[False] > 0


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_language"](spark, folder).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held_out) >= 0.98 * len(held_out)


def test_spans_of_mixed_texts(spark):
    rows = [("the house is on the hill and we like it", "en"), ("das haus ist auf dem berg und wir moegen es", "de"), ("дом стоит на горе и мы его любим", "ru")]
    model = language.fit(spark.createDataFrame(rows * 20, "text string, lang string"))
    text = "we like the house on the hill. wir moegen das haus auf dem berg. мы его любим"
    found = language.detect(spark.createDataFrame([(text,)], "text string"), model).first().language
    spans = [(s.lang, text[s.start : s.end]) for s in found.spans]
    assert spans == [("en", "we like the house on the hill"), ("de", "wir moegen das haus auf dem berg"), ("ru", "мы его любим")]


def test_toxic_documents_are_found_and_clean_ones_kept(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held_out = labels.where("doc_id % 4 = 0")
    model = toxicity.fit(documents, labels.where("doc_id % 4 <> 0"))
    assert 0 < model.thresholds[0] < model.thresholds[1]
    scored = toxicity.score(documents.join(held_out, "doc_id"), model, carry=["lang", "toxic"]).toPandas()
    wrong = (scored["toxic_probability"] >= 0.5) & (scored["toxic"] == 0)
    assert wrong.mean() < 0.01
    english = scored[(scored["toxic"] == 1) & (scored["lang"] == "en")]
    assert (english["toxic_probability"] >= 0.5).mean() > 0.85
    assert ((scored["severity"] >= 0) & (scored["severity"] <= 2)).all()


# The pipeline.


def test_pipeline(spark, texts):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "benchmark_decontamination", "packing"]
    sequences = corpus_pipeline.run(spark, SMALL).collect()
    kept = defaultdict(list)
    for s in sequences:
        assert len(s.tokens) <= 2048 and len(s.tokens) & (len(s.tokens) - 1) == 0
        for p in s.pieces:
            kept[p.doc_id].append((p.start, s.tokens[p.offset : p.offset + p.length]))
    assert set(kept) < set(texts)
    ids = whole_ids(texts, "byte_bpe_50k.json")
    whole = sum(sum((t for _, t in sorted(parts)), []) == ids[d].tolist() for d, parts in kept.items())
    assert whole > 0.9 * len(kept)
