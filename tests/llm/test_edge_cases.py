"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from presscheck.llm import (
    decontamination,
    fingerprints,
    language,
    language_model,
    line_dedup,
    near_duplicates,
    packing,
    suffixes,
    token_files,
    toxicity,
)
from presscheck.llm.queries import vocabulary
from presscheck.llm.tables import scratch_path

LONG = "one two three four five six seven eight nine ten " * 3000
TEXTS = [None, "", " ", "\n\n", "word", "same text of a few words", "same text of a few words", "é 日本 \x00 😀", LONG]
CLASHES = ("contamination", "severity", "grade", "runs", "_runs", "_key", "_gone", "kept", "language", "lm", "sketch", "range")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)]
    rows += [(5, TEXTS[5], None, None, None)] * 2 + [(None, "same text of a few words", "en", "s", 3), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, COLUMNS)
    return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "three four five six seven eight nine ten one two"), (2, "a few words"), (3, None), (None, "word"), (4, ".")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, 1, 0), (5, 1, None), (None, 0, 1), (8, None, 7)], "doc_id long, quality int, toxic int")


def ids(frame):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in frame.select("doc_id").collect())


def test_fingerprints(odd, none):
    assert fingerprints.with_next(none, "doc_id", "text").count() == 0
    rows = fingerprints.with_next(odd, "doc_id", "text").collect()
    assert len(rows) == odd.count() and all(r.next_text is not None for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
    assert by_text[""] == [] and len(by_text["word"]) == 1


def test_toxicity(odd, none, labels, spark):
    for table in (labels, labels.limit(0)):
        model = toxicity.fit(odd, table)
        scored = toxicity.score(odd, model)
        assert scored.count() == odd.count() and set(odd.columns) <= set(scored.columns)
        assert scored.where("severity < 0 or severity > 2 or severity is null").isEmpty()
        kept = toxicity.remove_toxic(odd, model)
        assert kept.columns == odd.columns and kept.select("severity").distinct().collect() == [(CLASHES.index("severity"),)]
    assert toxicity.score(none, toxicity.fit(none, labels)).isEmpty()


def test_suffixes(odd, none):
    assert suffixes.remove_repeats(none).isEmpty()
    rows = suffixes.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.n_bytes == len(r.kept) + r.n_removed and (r.n_removed > 0) == (r.n_spans > 0)
    long = next(r for r in rows if r.doc_id == 8)
    # The period of the long text is 49 bytes, so all but the first window's bytes come again.
    assert (long.n_removed, long.n_spans) == (len(LONG) - 49, 1)


def test_line_dedup(odd, none):
    assert line_dedup.remove_repeats(none).isEmpty()
    clean = line_dedup.remove_repeats(odd)
    assert clean.columns == odd.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd.collect()))
    assert line_dedup.remove_repeats(odd, runs="runs").where("runs is not null").isEmpty()


def test_packing(odd, none):
    path = vocabulary("byte_bpe_50k.json")
    assert packing.pack(none, path).isEmpty()
    pieces = packing.piece_digests(packing.pack(odd, path)).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in odd.collect()}
    assert sorted(p.doc_tokens for p in pieces if p.doc_id in (0, 1)) == [1, 1]


def test_language(odd, none):
    assert language.detect(none, language.fit(none)).isEmpty()
    unknown = language.detect(odd, language.fit(odd.where("lang = 'none'"))).select("language.*").distinct().collect()
    assert [tuple(r) for r in unknown] == [("und", 0.0, [])]
    found = language.detect(odd, language.fit(odd))
    assert found.columns[-1] == "language" and found.count() == odd.count()
    named = {r.doc_id: r.language.lang for r in found.collect()}
    assert named[0] == named[1] == named[2] == "und" and named[4] == named[8] == "en"


def test_decontamination(odd, none, items):
    assert decontamination.find(none, items).isEmpty()
    assert decontamination.find(odd, items.limit(0)).where("contamination.n_hit > 0").isEmpty()
    found = {r.doc_id: r.contamination for r in decontamination.find(odd, items).collect() if r.doc_id is not None}
    assert found[0].n_words == found[1].n_words == 0 and found[4].n_hit == 0
    assert found[5]["items"] == [2] and [tuple(s) for s in found[5].spans] == [(3, 6)]
    assert found[8].n_words == 30_000 and found[8].n_hit == 29_990 and found[8]["items"] == [1]
    clean = decontamination.remove_documents(odd, items)
    assert clean.columns == odd.columns and ids(clean) == ids(odd.where("doc_id not in (5, 6, 8) or text is null"))
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(odd, items).collect()}
    assert cut[5] == "same text of " and cut[0] is None and cut[7] == TEXTS[7]


def test_decontamination_in_blocks(odd, items, monkeypatch):
    whole = decontamination.find(odd, items, carry=["doc_id"]).collect()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 15)
    parts = decontamination.find(odd, items, carry=["doc_id"]).collect()
    assert sorted(map(str, parts)) == sorted(map(str, whole))


def test_token_files(spark, odd, none):
    for frame in (none, odd):
        path = scratch_path(spark, "tokens")
        token_files.write(frame, path, vocabulary("word_bpe_49k.json"))
        rows = sorted(token_files.digests(token_files.read(spark, path)).collect(), key=lambda r: r.start)
        assert len(rows) == frame.count()
        assert [r.doc_id for r in rows] == sorted((r.doc_id for r in frame.collect()), key=lambda d: -1 if d is None else d)
        total = 0
        for r in rows:
            assert r.start == total
            total += r.n_tokens


def test_near_duplicates(odd, none):
    assert near_duplicates.find(none).isEmpty()
    rows = near_duplicates.find(odd, width=2).collect()
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [found[i].n_shingles for i in (0, 1, 2, 3, 4, 5)] == [0, 0, 0, 0, 1, 5]
    assert found[6].component_id == 5 and not found[6].kept and all(found[i].kept for i in (0, 1, 2, 3, 4, 5, 7, 8))
    nameless = [r for r in rows if r.doc_id is None]
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in nameless if r.n_shingles) == [(5, 5, False)]
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns and 6 not in {r.doc_id for r in kept.collect()}


def test_language_model(odd, none):
    model = language_model.fit(none)
    assert model.tokens == 0 and language_model.score(none, model).isEmpty()
    unseen = language_model.score(odd, model).collect()
    assert all(r.lm.score == 0 and r.lm.n_known == 0 for r in unseen)
    rows = language_model.score(odd, language_model.fit(odd)).collect()
    assert len(rows) == odd.count() and all(r.lm.n_known == r.lm.n_tokens and r.lm.score < 0 for r in rows)
    assert {r.lm.n_tokens for r in rows if not (r.text or "").strip()} == {1}


@pytest.mark.parametrize("which", ["odd", "none"])
def test_pipeline_stages(request, spark, labels, items, tmp_path, which):
    docs = request.getfixturevalue(which)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if number < 4:
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"stage{number}"))
            docs = spark.read.parquet(str(tmp_path / f"stage{number}"))
    assert out.isEmpty() == (which == "none")
