import math
import re
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck import session
from presscheck.functions import display
from presscheck.operators import report, scores, tfidf
from presscheck.operators.contract import decision_ok, prediction_ok, result_ok
from presscheck.operators.decision import final_prediction
from presscheck.operators.distinct_texts import score_distinct
from presscheck.operators.validation import (
    accepted,
    check_articles,
    error_message,
    page_precheck,
    rejected,
    word_count_label,
)

NAN = float("nan")
WORDS = " ".join(f"word{i}" for i in range(60)).split()


def articles(spark, rows):
    return spark.createDataFrame(
        [(i, h, a) for i, (h, a) in enumerate(rows)], "id long, headline string, article string"
    )


# Validation.


def short(words):
    return (
        f"News contains only {words} words. Please enter at least 20 words. "
        "A complete article is recommended."
    )


LONG_HEADLINE = "String should have at most 1000 characters"
LONG_ARTICLE = "String should have at most 100000 characters"
CASES = [
    (None, None, 400, "News text cannot be empty."),
    ("", "<p></p> http://a.b", 400, "News text cannot be empty."),
    (" \n", " ", 400, "News text cannot be empty."),
    (None, " ".join(WORDS[:19]), 400, short(19)),
    (None, " ".join(WORDS[:20]), None, None),
    (" ".join(WORDS[:5]), " ".join(WORDS[5:20]), None, None),
    ("", " ".join(WORDS[:15] + ["http://x.y"] * 10), 400, short(15)),
    ("h" * 1001, "a", 422, LONG_HEADLINE),
    ("h" * 1000, "a", 400, short(2)),
    ("h", "a" * 100001, 422, LONG_ARTICLE),
    ("h", "a" * 100000, 400, short(2)),
    ("中" * 1000, "\U0001f600" * 100000, 400, short(2)),
    ("\U0001f600" * 1001, "b" * 100001, 422, f"{LONG_HEADLINE}, {LONG_ARTICLE}"),
]


def test_checked_articles(spark):
    frame = articles(spark, [c[:2] for c in CASES])
    rows = check_articles(frame).orderBy("id").collect()
    assert [(r.code, r.reason) for r in rows] == [c[2:] for c in CASES]
    assert rows[4].word_count == rows[5].word_count == 20
    assert rows[7].clean_text is None
    kept = {r.id for r in accepted(check_articles(frame)).collect()}
    refused = {r.id for r in rejected(check_articles(frame)).collect()}
    assert kept == {4, 5} and refused == set(range(len(CASES))) - kept


def test_outcome_filter_cleans_once(spark):
    frame = articles(spark, [("a", "b")])
    kept = accepted(check_articles(frame)).select("id", "clean_text")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("<[^>]+>") == 1


def test_page_precheck_counts_raw_words(spark):
    raw = " ".join(WORDS[:15] + ["http://x.y"] * 10)
    frame = articles(spark, [("", raw), ("one", None), (None, None), (" a\ufeffb ", "c\x1cd")])
    rows = frame.orderBy("id").select(
        page_precheck(F.col("headline"), F.col("article")).alias("m"),
        word_count_label(F.col("headline"), F.col("article")).alias("n"),
    ).collect()
    few = "Please enter at least 20 words. Current input contains {} words.".format
    assert [r.m for r in rows] == [None, few(1), "Please enter a news article.", few(3)]
    assert [r.n for r in rows] == ["25 words", "1 word", "0 words", "3 words"]


def test_error_messages(spark):
    frame = spark.createDataFrame(
        [("said", ["a"]), (None, ["a", "", None, "b"]), (None, []), (None, None)],
        "detail string, items array<string>",
    )
    rows = frame.select(error_message(F.col("detail"), F.col("items"), F.lit("failed"))).collect()
    assert [r[0] for r in rows] == ["said", "a, Invalid request, Invalid request, b", "", "failed"]


# Scores and decisions.


def test_logits(spark):
    cases = [
        ([2.0, 0.0], 0, 1 / (1 + math.exp(-2))),
        ([0.0, 2.0], 1, 1 / (1 + math.exp(-2))),
        ([1.0, 1.0], 1, 0.5),
        ([800.0, -800.0], 0, 1.0),
        (None, 0, 0.5),
        ([NAN, 1.0], 0, 0.5),
        ([1.0, None], 0, 0.5),
        ([float("inf"), float("inf")], 0, 0.5),
        ([1.0], 0, 0.5),
    ]
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, z array<double>")
    rows = frame.orderBy("i").select(scores.logits_prediction(F.col("z")).alias("v")).collect()
    for row, (_, label, confidence) in zip(rows, cases):
        v = row.v
        assert (v.model, v.label, v.prediction) == ("BERT", label, ("Fake", "Real")[label])
        assert v.confidence == pytest.approx(confidence, abs=1e-12)
        assert v.confidence == max(v.fake_probability, v.real_probability)
        assert v.fake_probability + v.real_probability == pytest.approx(1.0)


def test_logits_are_computed_once(spark):
    """A raw score may be costly, as a count over a whole text is."""
    texts = spark.range(40).select(F.concat(F.lit("word "), F.col("id").cast("string")).alias("t"))
    from presscheck.plans.queries import CountScorer

    logits = CountScorer("X", lambda t: F.array(F.regexp_count(t, F.lit("o")) / 1.0, F.lit(0.5))).score(texts, "t", "v")
    assert logits._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {r.v.label for r in logits.collect()} == {K.FAKE}


def test_rescale(spark):
    frame = spark.createDataFrame(
        [(0, -0.5, 2.0), (1, 0.2, 0.2), (2, 0.0, -1.0)], "i int, fake double, real double"
    )
    got = frame.orderBy("i").select(
        scores.rescale(F.struct("fake", "real")).alias("p")
    ).collect()
    assert [tuple(r.p) for r in got] == [(0.0, 1.0), (0.5, 0.5), (0.0, 0.0)]


def verdict(spark, model, label, confidence):
    rest = 1 - confidence
    fake, real = (confidence, rest) if label == 0 else (rest, confidence)
    return scores.prediction(model, F.lit(label), F.lit(fake), F.lit(real))


@pytest.mark.parametrize(
    "a, b, want",
    [
        ((0, 0.8), (0, 0.6), (0, 0.7, True, "A + B")),
        ((1, 0.9), (1, 0.7), (1, 0.8, True, "A + B")),
        ((0, 0.6), (1, 0.9), (1, 0.9, False, "B")),
        ((0, 0.9), (1, 0.6), (0, 0.9, False, "A")),
        ((0, 0.75), (1, 0.75), (1, 0.75, False, "B")),
        ((1, 0.7), None, (1, 0.7, False, "A")),
        ((0, 0.7), None, (0, 0.6, True, "A + B")),
        ((1, 0.5), None, (0, 0.5, False, "B")),
    ],
)
def test_decisions(spark, a, b, want):
    second = scores.fallback_prediction("B") if b is None else verdict(spark, "B", *b)
    final = final_prediction(verdict(spark, "A", *a), second)
    row = spark.range(1).select(final.alias("f")).first().f
    assert (row.label, row.agreement, row.selected_model) == (want[0], want[2], want[3])
    assert row.confidence == pytest.approx(want[1])
    assert row.prediction == ("Fake", "Real")[want[0]]
    assert row.decision_method == (K.METHOD_AGREE if want[2] else K.METHOD_DISAGREE)


def test_contract(spark):
    good = verdict(spark, "A", 1, 0.75)
    final = final_prediction(good, good)

    def check(column):
        return spark.range(1).select(column).first()[0]

    assert check(result_ok(F.lit(3), F.array(good, good), final))
    assert not check(result_ok(F.lit(-1), F.array(good), final))
    assert not check(result_ok(F.lit(None).cast("int"), F.array(good), final))
    for field, bad in [
        ("label", F.lit(2)),
        ("prediction", F.lit("real")),
        ("confidence", F.lit(NAN)),
        ("fake_probability", F.lit(-0.1)),
        ("real_probability", F.lit(1.1)),
        ("model", F.lit(None)),
    ]:
        assert not check(prediction_ok(good.withField(field, bad))), field
    for field in ("label", "confidence", "agreement", "selected_model", "decision_method"):
        assert not check(decision_ok(final.withField(field, F.lit(None)))), field
    assert not check(result_ok(F.lit(1), F.array(good, good.withField("label", F.lit(7))), final))


# Display.


def exact(value, digits):
    return str(Decimal(value).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_fixed_rounds_like_the_page(spark):
    values = [1.005, 0.125, 0.375, 2.675, -0.125, 0.5, 1.5, 2.5, 123456.785, 0.0, 8.345, 1e6 + 0.125]
    values += [i / 1000 for i in range(0, 3000, 7)] + [i / 16 for i in range(200)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2):
        rows = frame.select("v", display.fixed(F.col("v"), digits).alias("t")).collect()
        assert [(r.v, r.t) for r in rows if r.t != exact(r.v, digits)] == []


def test_percent_time_and_width(spark):
    frame = spark.createDataFrame(
        [(0, 0.876), (1, 1.5), (2, NAN), (3, None), (4, -0.25)], "i int, v double"
    )
    v = F.col("v")
    rows = frame.orderBy("i").select(
        display.percent_text(v), display.time_text(v), display.bar_width(v)
    ).collect()
    assert [r[0] for r in rows] == ["87.60%", "150.00%", "N/A", "N/A", "-25.00%"]
    assert [r[1] for r in rows] == ["876 ms", "1.50 s", "N/A", "0 ms", "-250 ms"]
    assert [rows[i][2] for i in (0, 1, 4)] == [pytest.approx(87.6), 100.0, 0.0]


def test_report(spark):
    a, b = verdict(spark, "A", 0, 0.75), verdict(spark, "B", 1, 0.5)
    results = spark.range(1).select(
        "id", *report.result_columns(F.lit(None).cast("int"), a, b, final_prediction(a, b))
    )
    shown = results.select(*report.final_columns(F.lit(0.25))).first()
    assert shown.verdict == "FAKE" and shown.card_class == "fake-result"
    assert shown.agreement_text == "No" and shown.word_count == 0
    assert shown.confidence_text == "75.00%" and shown.time_text == "250 ms"
    cards = report.model_cards(report.model_rows(results, "id")).orderBy("position").collect()
    assert [(c.model, c.badge, c.fake_width) for c in cards] == [("A", "fake", 75.0), ("B", "real", 50.0)]
    text = results.select(report.result_json()).first()[0]
    assert text.startswith('{"input":{') and '"models":[{"model":"A","label":0' in text


# TF-IDF.

DOCS = [
    (1, "the cat sat on the mat a"),
    (2, "the dog sat"),
    (3, ""),
    (4, "cat_9 été été the unseen"),
    (5, "x y z"),
]


def weights_in_python(docs, min_df):
    counts = {i: Counter(re.findall(r"\b\w\w+\b", text)) for i, text in docs}
    df = Counter(term for c in counts.values() for term in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items() if n >= min_df}
    want = {}
    for i, c in counts.items():
        raw = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        want.update({(i, t): w / norm for t, w in raw.items()})
    return want, sorted(idf)


@pytest.mark.parametrize("min_df", [1, 2])
@pytest.mark.parametrize("broadcast_terms", [tfidf.BROADCAST_TERMS, 0])
def test_tfidf(spark, monkeypatch, min_df, broadcast_terms):
    monkeypatch.setattr(tfidf, "BROADCAST_TERMS", broadcast_terms)
    docs = spark.createDataFrame(DOCS, "id long, text string")
    vocabulary = tfidf.fit_vocabulary(docs, "text", min_df)
    weights = tfidf.tfidf(docs, ["id"], "text", vocabulary)
    got = {(r.id, r.term): r.weight for r in weights.collect()}
    want, terms = weights_in_python(DOCS, min_df)
    assert got == pytest.approx(want)
    index = tfidf.index_terms(vocabulary)
    assert [(r["index"], r.term) for r in index.orderBy("index").collect()] == list(enumerate(terms))
    vectors = {r.id: dict(zip(r.indices, r.weights)) for r in tfidf.align(weights, ["id"], index).collect()}
    assert {(i, terms[j]): w for i, v in vectors.items() for j, w in v.items()} == pytest.approx(want)
    assert all(list(v) == sorted(v) for v in vectors.values())


def test_feature_mismatches(spark):
    saved = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "index int, term string")
    other = spark.createDataFrame([(0, "a"), (1, "c"), (3, "d")], "index int, term string")
    assert tfidf.feature_mismatches(saved, saved).isEmpty()
    rows = tfidf.feature_mismatches(saved, other).orderBy("index").collect()
    assert [tuple(r) for r in rows] == [(1, "b", "c"), (2, "c", None), (3, None, "d")]


# Distinct texts.


@pytest.mark.parametrize("hot_copies", [3, 100_000])
def test_each_text_is_scored_once_and_no_row_is_lost(spark, hot_copies):
    rows = [(i, "hot") for i in range(400)] + [(i, None) for i in range(400, 450)]
    rows += [(i, f"text {i % 70}") for i in range(450, 700)] + [(1000, "hot"), (1000, "hot")]
    frame = spark.createDataFrame(rows, "id long, t string").repartition(5, "id")
    seen = spark.sparkContext.accumulator(0)

    def score(distinct):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        checked = distinct.mapInArrow(count, "t string")
        return checked.withColumn("n", F.length("t")).withColumn("twice", F.concat("t", "t"))

    got = score_distinct(frame, "t", score, hot_copies).collect()
    assert sorted((r.id, r.t or "") for r in got) == sorted((i, t or "") for i, t in rows)
    assert all((r.n, r.twice) == ((len(r.t), r.t * 2) if r.t else (None, None)) for r in got)
    assert seen.value == 71


@pytest.mark.parametrize("budget", [0, 400, 1 << 20])
def test_tfidf_within_a_byte_budget(spark, monkeypatch, budget):
    """Some, all or none of the terms are broadcast; the weights stay the same."""
    monkeypatch.setattr(tfidf, "BROADCAST_BYTES", budget)
    docs = spark.createDataFrame(DOCS, "id long, text string")
    vocabulary = tfidf.index_terms(tfidf.fit_vocabulary(docs, "text", 1))
    weights = tfidf.tfidf(docs, ["id"], "text", vocabulary)
    want, terms = weights_in_python(DOCS, 1)
    assert {(r.id, r.term): r.weight for r in weights.collect()} == pytest.approx(want)
    for vectors in (tfidf.align(weights, ["id"]), tfidf.align(weights, ["id"], vocabulary.select("index", "term"))):
        got = {(r.id, terms[i]): w for r in vectors.collect() for i, w in zip(r.indices, r.weights)}
        assert got == pytest.approx(want)


def test_heavy_terms_do_not_fill_one_task(spark, monkeypatch):
    """A term in every article is joined where it is; what moves is spread evenly. No frequencies are given."""
    monkeypatch.setattr(tfidf, "BROADCAST_TERMS", 0)
    rows = [(i, "everywhere", 0.5) for i in range(20_000)] + [(i, f"t{i % 4000}", 0.5) for i in range(20_000)]
    weights = spark.createDataFrame(rows, "id long, term string, weight double").repartition(6)
    features = tfidf.index_terms(weights.select("term").where("term <> 't7'").distinct())
    assert [r.term for r in tfidf._heavy_terms(weights).collect()] == ["everywhere"]
    joined = tfidf._attach(weights, features.select("index", "term"), ["index"])
    assert joined.count() == 40_000 - 5
    moved = joined.where("term <> 'everywhere'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    sizes = sorted(r.n for r in moved.collect())
    assert max(sizes) <= 2 * sizes[len(sizes) // 2]
    vectors = tfidf.align(weights, ["id"], features.select("index", "term")).collect()
    assert len(vectors) == 20_000 and {len(v.indices) for v in vectors} == {1, 2}


def test_scores_join_back_without_the_text(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id long, t string")
    got = score_distinct(frame, "t", lambda d: d.withColumn("n", F.length("t")), keep_text=False)
    assert got.columns == ["id", "n"] and sorted((r.id, r.n) for r in got.collect()) == [(1, 1), (2, 1), (3, None), (4, 1)]


@pytest.mark.parametrize("budget", [800, 1 << 20])
def test_texts_move_once_and_counts_stay(spark, tmp_path, monkeypatch, budget):
    """With rare terms too. Parts are many enough for the memory of a task; keys repeat or are null."""
    monkeypatch.setattr(tfidf, "BROADCAST_BYTES", budget)
    monkeypatch.setattr(tfidf, "PART_BYTES", 1000)
    rows = [(i % 90 if i % 97 else None, f"common other {'once ' * (i % 3)} w{i % 30} v{i}") for i in range(200)]
    spark.createDataFrame(rows, "id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    vocabulary = session.materialise(tfidf.index_terms(tfidf.fit_vocabulary(docs, "text", 2)), "vocabulary")
    known = {r.term: (r["index"], r.idf) for r in vocabulary.collect()}
    want = Counter()
    for key, text in rows:
        want.update((key, t) for t in re.findall(r"\w{2,}", text) if t in known)
    norm = Counter()
    for (key, t), n in want.items():
        norm[key] += (n * known[t][1]) ** 2
    weights = tfidf.tfidf(docs, ["id"], "text", vocabulary)
    got = {(r.id, r.term, r["index"]): r.weight for r in weights.collect()}
    assert got == pytest.approx({(k, t, known[t][0]): n * known[t][1] / math.sqrt(norm[k]) for (k, t), n in want.items()})
    parts = sum(len(text) for _, text in rows) // 1000 + 1
    assert weights.rdd.getNumPartitions() == tfidf.term_counts(docs, ["id"], "text").rdd.getNumPartitions() == parts > 4
    plan = weights._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Nothing is dealt by key but the texts, before their terms are counted.
    assert plan.count("hashpartitioning(id") == 1
