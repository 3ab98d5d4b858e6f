import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck import session
from presscheck.functions.text import tokens
from presscheck.operators import scorers as S
from presscheck.operators.scorers import BatchScorer, FallbackScorer, ForestScorer
from presscheck.operators.validation import check_articles
from presscheck.operators.verdict_store import VerdictStore
from presscheck.plans import queries as Q
from presscheck.plans import scoring, training
from presscheck.sources import artefacts
from presscheck.sources import articles as A
from presscheck.sources.results import read_rejected, read_scored
from presscheck.streaming.feed import COUNTS, METRICS_NAME, await_feed, missing_batches, read_metrics, start_feed, start_feed_once, store_batch

from conftest import SMALL

OPTIONS = training.TrainingOptions(trees=8, depth=4, linear_passes=12)


@pytest.fixture(scope="module")
def tables(spark):
    return {
        name: spark.read.parquet(f"{SMALL}/{name}.parquet")
        for name in ("documents", "pages", "conversations", "labels")
    }


@pytest.fixture(scope="module")
def labelled(tables):
    return training.training_table(tables["documents"], tables["labels"])


@pytest.fixture(scope="module")
def fitted(labelled):
    return (
        training.fit_forest(labelled, "clean_text", OPTIONS),
        training.fit_linear(labelled, "clean_text", OPTIONS),
    )


def as_rows(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


# Sources.


def test_read_articles_fills_missing_fields(spark, tmp_path):
    lines = [{"id": 1, "headline": "h"}, {"id": 2}, {"id": 3, "article": "a"}]
    (tmp_path / "in.json").write_text("\n\n".join(map(json.dumps, lines)))
    rows = A.read_articles(spark, str(tmp_path), "json").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "h", "", False, None), (2, "", "", False, None), (3, "", "a", False, None)]
    spark.createDataFrame([(4, None)], "id long, article string").write.parquet(str(tmp_path / "t"))
    assert [tuple(r) for r in A.read_articles(spark, str(tmp_path / "t")).collect()] == [(4, "", "")]


BROKEN_LINES = [
    '{"id":1,"headline":"h"', "no json", '{"headline":7,"article":["x"]}', '{"id":2,"article":null}', '[{"id":3}]',
    '{"id":"four","article":"a"}', '{"id":5.5,"article":"a"}', '"text"', "null",
]


def test_broken_json_lines_are_kept_and_rejected(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*BROKEN_LINES, '{"id":9,"article":"a"}']))
    rows = check_articles(A.read_articles(spark, str(tmp_path / "in"), "json")).collect()
    assert {r.raw: r.code for r in rows if r.malformed} == {line: 422 for line in BROKEN_LINES}
    assert [(r.id, r.article, r.code) for r in rows if not r.malformed] == [(9, "a", 400)]
    assert {r.raw: r.id for r in rows}['{"id":2,"article":null}'] == 2
    feed = A.stream_articles(spark, str(tmp_path / "in"), "json")
    start_feed(feed, ["id", "raw"], str(tmp_path / "out"), str(tmp_path / "c"), Q.FIRST, Q.SECOND).awaitTermination()
    found = {r.raw: r.code for r in read_rejected(spark, str(tmp_path / "out")).collect()}
    assert found == {line: 422 for line in BROKEN_LINES} | {None: 400}


def test_broken_csv_records_are_kept_and_rejected(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["1,h,a", "x,h,a", "2,h,a,more", '3,"h","a, b"', "4"]
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines))
    rows = check_articles(A.read_articles(spark, str(tmp_path / "in"), "csv")).collect()
    assert sorted(r.raw for r in rows if r.malformed) == sorted(["x,h,a", "2,h,a,more", "4"])
    assert {r.id: r.article for r in rows if not r.malformed} == {1: "a", 3: "a, b"}
    assert {r.code for r in rows if r.malformed} == {422} and all(r.article == "" for r in rows if r.malformed)


def test_parse_requests(spark):
    good = [('{"headline":"h","article":"a"}', "h", "a"), ("{}", "", ""), ('{"article":"b\\n","x":1}', "", "b\n")]
    bad = ['{"article":"b"', "[1]", None, "", '"text"', '{"article":null}', '{"headline":5}', '{"article":["a"]}']
    bodies = [g[0] for g in good] + bad
    frame = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    parsed = A.parse_requests(frame, "body")
    rows = parsed.orderBy("id").collect()
    assert [(r.headline, r.article) for r in rows] == [g[1:] for g in good] + [("", "")] * len(bad)
    assert [r.malformed for r in rows] == [False] * len(good) + [True] * len(bad)
    checked = check_articles(parsed).orderBy("id").collect()
    assert [r.code for r in checked] == [400] * len(good) + [422] * len(bad)
    assert checked[-1].reason == K.INVALID_REQUEST


def test_scratch_is_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(root)
    stored = session.materialise(spark.range(5).withColumn("s", F.lit("a")), "t")
    assert stored.count() == 5 and all(f.startswith("file:") and root in f for f in stored.inputFiles())


def test_a_cluster_must_name_the_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            applicationId = "app"
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Session, "x")


def test_spread_leaves_large_tables_alone(spark, tables):
    assert session.spread(tables["documents"], "doc_id").rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 16)
    assert session.spread(many, "id") is many


# Training and artefacts.


def test_training_is_repeatable_and_weights_balance(spark, labelled, fitted):
    totals = [r.w for r in labelled.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert len(totals) == 2 and totals[0] == pytest.approx(totals[1])
    again = training.fit_linear(labelled, "clean_text", OPTIONS)
    first, second = (s.score(labelled, "clean_text", "v").select("doc_id", "v") for s in (fitted[1], again))
    pairs = first.join(second.withColumnRenamed("v", "w"), "doc_id")
    assert pairs.where(F.abs(F.col("v.confidence") - F.col("w.confidence")) > 1e-6).isEmpty()


def test_split_is_complete_and_disjoint(labelled):
    fit, held_out = training.split(labelled, ["doc_id"])
    ids = [r.doc_id for f in (fit, held_out) for r in f.select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in labelled.select("doc_id").collect())


def test_forest_features_are_smoothed_tfidf(spark, labelled, fitted):
    """The pipeline's vectors equal the relational weights over the same vocabulary."""
    from presscheck.operators import tfidf
    from pyspark.ml.functions import vector_to_array

    texts = labelled.select("doc_id", tokens(F.col("clean_text")).alias(S.TERMS))
    model = fitted[0].model
    features = PipelineModel(model.stages[:-1]).transform(texts)
    vocabulary = tfidf.fit_vocabulary(labelled, "clean_text", OPTIONS.min_df)
    index = artefacts.vocabulary(spark, model)
    weights = tfidf.tfidf(labelled, ["doc_id"], "clean_text", vocabulary)
    wide = features.select("doc_id", F.posexplode(vector_to_array(S.FEATURES)).alias("index", "w"))
    wide = wide.where("w <> 0").join(index, "index")
    joined = wide.join(weights, ["doc_id", "term"], "full_outer")
    off = joined.where(F.col("w").isNull() | F.col("weight").isNull() | (F.abs(F.col("w") - F.col("weight")) > 1e-9))
    assert joined.count() > 1000 and off.isEmpty()


def test_forest_round_trip_and_checks(spark, labelled, fitted, tmp_path):
    forest = fitted[0]
    path = str(tmp_path / "forest")
    artefacts.save_forest(spark, forest, path)
    loaded = artefacts.load_forest(spark, path)
    assert as_rows(loaded.score(labelled, "clean_text", "v")) == as_rows(
        forest.score(labelled, "clean_text", "v")
    )
    names = artefacts.vocabulary(spark, forest.model)
    artefacts.check_forest(spark, forest.model, names)
    swapped = names.withColumn(
        "index", F.when(F.col("index") < 2, 1 - F.col("index")).otherwise(F.col("index"))
    )
    with pytest.raises(artefacts.ArtefactError, match="names"):
        artefacts.check_forest(spark, forest.model, swapped)
    stages = list(forest.model.stages)
    with pytest.raises(artefacts.ArtefactError, match="does not contain"):
        artefacts.check_forest(spark, PipelineModel(stages[:-1]))
    small = CountVectorizerModel.from_vocabulary(["one", "two"], inputCol=S.TERMS, outputCol=S.COUNTS)
    with pytest.raises(artefacts.ArtefactError, match="do not match"):
        artefacts.check_forest(spark, PipelineModel([small, *stages[1:]]))
    with pytest.raises(artefacts.ArtefactError, match="not found"):
        artefacts.load_forest(spark, str(tmp_path / "nothing"))


def test_linear_round_trip_and_fallback(spark, labelled, fitted, tmp_path):
    artefacts.save_linear(fitted[1], str(tmp_path / "linear"))
    loaded = artefacts.load_linear(str(tmp_path / "linear"))
    assert as_rows(loaded.score(labelled, "clean_text", "v")) == as_rows(
        fitted[1].score(labelled, "clean_text", "v")
    )
    assert isinstance(artefacts.load_linear(str(tmp_path / "nothing")), FallbackScorer)


def test_linear_scorer_reads_the_first_words_only(spark, fitted):
    head = " ".join(f"w{i}" for i in range(K.MAX_TOKENS))
    frame = spark.createDataFrame([(head,), (head + " more words",)], "t string")
    verdicts = fitted[1].score(frame, "t", "v").select("v").distinct().collect()
    assert len(verdicts) == 1 and verdicts[0].v.model == K.LINEAR_NAME


# Batch models.


def test_batch_scorer(spark):
    def load():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return np.array([[float(len(t)), 3.0] for t in texts])

        return predict

    texts = ["ab", "abcd", "bad one", "", None, "abc"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    rows = BatchScorer(load, batch_size=4).score(frame, "t", "v").orderBy("i").collect()
    assert [r.v.label for r in rows] == [1, 0, 0, 0, 0, 1]
    assert [r.v.confidence for r in rows[2:5]] == [0.5] * 3
    assert rows[0].v.real_probability == pytest.approx(1 / (1 + np.exp(-1)))
    assert rows[5].v.confidence == 0.5 and rows[5].v.prediction == "Real"


def test_model_that_does_not_load_falls_back(spark):
    def load():
        raise OSError("no weights")

    frame = spark.createDataFrame([("some text",)], "t string")
    v = BatchScorer(load).score(frame, "t", "v").first().v
    assert (v.label, v.confidence, v.fake_probability, v.real_probability) == (0, 0.5, 0.5, 0.5)
    v = S.transformer_scorer("/nowhere").score(frame, "t", "v").first().v
    assert (v.model, v.label, v.confidence) == ("BERT", 0, 0.5)


def test_batches_hold_texts_of_one_length():
    seen = []

    def load():
        def predict(texts):
            sizes = [len(t.split()) for t in texts]
            seen.append(sizes)
            return [[n, hash(t) % 5] for n, t in zip(sizes, texts)]

        return predict

    texts = ["w " * (1 + i * 37 % 200) + str(i) for i in range(500)] + ["", None, "w " * 900]
    logits = S.tolerant(load, batch_size=32, padded_tokens=2048)()(np.array(texts, dtype=object))
    want = [[len(t.split()), hash(t) % 5] if t else [np.nan] * 2 for t in texts]
    assert np.array_equal(logits, np.array(want, float), equal_nan=True)
    cut = [[min(n, K.MAX_TOKENS) for n in sizes] for sizes in seen]
    assert all(len(sizes) <= 32 and len(sizes) * max(sizes) <= 2048 for sizes in cut)
    used, padded = sum(map(sum, cut)), sum(len(sizes) * max(sizes) for sizes in cut)
    order = [min(len(t.split()), K.MAX_TOKENS) for t in texts if t]
    arrival = sum(len(order[i : i + 32]) * max(order[i : i + 32]) for i in range(0, len(order), 32))
    assert padded < 1.1 * used < 1.7 * used < arrival
    # A text beyond the bound goes alone.
    seen.clear()
    S.tolerant(load, batch_size=4, padded_tokens=3)()(np.array(["a b c d", "a", "b"], dtype=object))
    assert seen == [[1, 1], [4]]


# Whole runs.


def test_batch_run(spark, tables, fitted, tmp_path):
    path = str(tmp_path / "out")
    turns = A.conversation_articles(tables["conversations"])
    metrics = scoring.run_batch(turns, ["conv_id", "turn"], path, *fitted).first()
    done, refused = read_scored(spark, path), read_rejected(spark, path)
    assert metrics.rows_in == turns.count() == done.count() + refused.count()
    assert (metrics.rows_scored, metrics.rows_rejected) == (done.count(), refused.count())
    assert metrics.contract_violations == 0 and metrics.seconds > 0
    assert refused.where("code is null or reason is null").isEmpty()
    assert done.where("input is null or final is null or size(models) <> 2").isEmpty()
    assert {f.name for f in done.schema} == {"conv_id", "turn", "input", "models", "final"}


def test_results_that_break_the_contract_are_rejected(spark):
    class Broken(FallbackScorer):
        def score(self, df, text, out):
            scored = super().score(df, text, out)
            return scored.withColumn(out, F.col(out).withField("confidence", F.lit(1.5)))

    frame = spark.createDataFrame([(1, "", "word " * 30), (2, "", "word")], "id long, headline string, article string")
    results = scoring.score_articles(frame, ["id"], Broken("A"), FallbackScorer()).orderBy("id").collect()
    assert [(r.outcome, r.code) for r in results] == [("rejected", 500), ("rejected", 400)]
    assert results[0].final is None and results[0].reason == K.SCORER_FAILED


def test_scoring_distinct_texts_changes_nothing(tables, fitted):
    documents = A.document_articles(tables["documents"])
    plain = scoring.score_articles(documents, ["doc_id"], *fitted)
    once = scoring.score_articles_once(documents, ["doc_id"], *fitted, hot_copies=2)
    assert as_rows(plain) == as_rows(once)


def test_one_scan_and_one_decoding_per_run(tables, fitted):
    results = scoring.score_articles(A.document_articles(tables["documents"]), ["doc_id"], *fitted)
    for frame in (results, scoring.scored(results, ["doc_id"]), scoring.rejected(results, ["doc_id"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == plan.count("ArrowEvalPython") == 1
        assert "Exchange" not in plan and "n_chars" not in plan


def test_stream_equals_batch(spark, tables, fitted, tmp_path):
    feed, out, checkpoint = (str(tmp_path / p) for p in ("feed", "out", "checkpoint"))
    documents = tables["documents"].withColumnRenamed("doc_id", "id").select(
        "id", F.lit(None).cast("string").alias("headline"), F.col("text").alias("article")
    )
    half = F.col("id") % 2 == 0

    def drain():
        source = A.stream_articles(spark, feed, maxFilesPerTrigger=1)
        query = start_feed(source, ["id"], out, checkpoint, *fitted)
        query.awaitTermination()
        return query

    documents.where(half).repartition(2).write.mode("append").parquet(feed)
    query = drain()
    seen = [p.observedMetrics.get(METRICS_NAME) for p in query.recentProgress]
    assert sum(m.rows_in for m in seen if m) == documents.where(half).count()
    # A second run takes up the new files only.
    documents.where(~half).write.mode("append").parquet(feed)
    drain()
    batch = scoring.score_articles(A.with_defaults(documents), ["id"], *fitted)
    assert as_rows(spark.read.parquet(out)) == as_rows(batch)


def test_feed_scores_no_text_twice(spark, tables, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    class Counted:
        def score(self, df, text, out):
            def count(batches):
                for batch in batches:
                    seen.add(sum(t is not None for t in batch[text].to_pylist()))
                    yield batch

            return Q.FIRST.score(df.mapInArrow(count, df.schema), text, out)

    feed_path, out, checkpoint, known, metrics = (str(tmp_path / p) for p in ("feed", "out", "checkpoint", "known", "metrics"))
    documents = tables["documents"].select(F.col("doc_id").alias("id"), F.lit("").alias("headline"), F.col("text").alias("article"))
    parts = [documents.where("id % 2 = 0"), documents, documents.withColumn("id", F.col("id") + 1_000_000)]
    stored = set()
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(feed_path)
        source = A.stream_articles(spark, feed_path)
        start_feed_once(source, ["id"], out, checkpoint, Counted(), Q.SECOND, known, metrics=metrics).awaitTermination()
        rows = spark.read.parquet(known).select(F.hex("_digest").alias("d"), "batch").collect()
        assert len({r.d for r in rows}) == len(rows) and stored <= {r.d for r in rows}
        stored = {r.d for r in rows}
        if i == 1:
            half = seen.value
    assert seen.value == half == len(stored)
    assert [r.batch for r in read_metrics(spark, metrics).orderBy("batch").collect()] == [0, 1, 2]
    fed = parts[0].unionAll(parts[1]).unionAll(parts[2])
    batch = scoring.score_articles(A.with_defaults(fed), ["id"], Q.FIRST, Q.SECOND)
    assert as_rows(spark.read.parquet(out).drop("batch")) == as_rows(batch)


@pytest.mark.parametrize("max_broadcast", [0, 100])
def test_store_of_verdicts_in_a_batch_that_runs_again(spark, tmp_path, max_broadcast):
    path = str(tmp_path / "known")

    def batch(number, names):
        rows = spark.createDataFrame([(bytearray(n, "utf8"),) for n in names], "_digest binary")
        store = VerdictStore(spark, path, number, max_broadcast)
        known = store.recall(rows)
        new = rows if known is None else rows.join(known.select("_digest"), "_digest", "left_anti")
        added = store.add(new.withColumn("n", F.lit(number)))
        return sorted((bytes(r._digest).decode(), r.n) for f in (known, added) if f is not None for r in f.collect())

    assert batch(0, "ab") == [("a", 0), ("b", 0)]
    assert batch(1, "bcd") == batch(1, "bcd") == [("b", 0), ("c", 1), ("d", 1)]
    # Run again, the first batch knows nothing of later ones.
    assert batch(0, "ab") == [("a", 0), ("b", 0)]
    assert batch(2, "abcde") == [("a", 0), ("b", 0), ("c", 1), ("d", 1), ("e", 2)]
    assert batch(3, "ab") == [("a", 0), ("b", 0)] and batch(4, "e") == [("e", 2)]


def test_stream_metrics_are_stored_once_for_each_batch(spark, tables, tmp_path):
    feed_path, out, checkpoint, metrics = (str(tmp_path / p) for p in ("feed", "out", "checkpoint", "metrics"))
    documents = tables["documents"].select(F.col("doc_id").alias("id"), F.col("text").alias("article"))

    def drain():
        source = A.stream_articles(spark, feed_path, maxFilesPerTrigger=1)
        await_feed(start_feed(source, ["id"], out, checkpoint, Q.FIRST, Q.SECOND, metrics=metrics))

    documents.where("id % 2 = 0").repartition(2).write.mode("append").parquet(feed_path)
    drain()
    first = {r.batch: r.rows_in for r in read_metrics(spark, metrics).collect()}
    assert len(first) == 2
    documents.where("id % 2 = 1").repartition(2).write.mode("append").parquet(feed_path)
    drain()
    rows = read_metrics(spark, metrics)
    assert missing_batches(rows).isEmpty()
    found = {r.batch: r.rows_in for r in rows.collect()}
    assert sorted(found) == [0, 1, 2, 3] and first.items() <= found.items()
    batch = scoring.run_batch(A.with_defaults(documents.withColumn("headline", F.lit(""))), ["id"], str(tmp_path / "b"), Q.FIRST, Q.SECOND).head()
    assert tuple(rows.agg(*[F.sum(c) for c in COUNTS]).head()) == tuple(batch[c] for c in COUNTS)
    # A batch that runs again takes the place of its row.
    again = rows.where("batch = 3").head()
    store_batch(spark, metrics, 3, again, 1.0)
    rows = read_metrics(spark, metrics)
    assert rows.count() == 4 and rows.agg(F.sum("rows_in")).head()[0] == batch.rows_in
    assert [r.batch for r in missing_batches(rows.where("batch <> 1")).collect()] == [1]


def test_quality(spark):
    counts = spark.createDataFrame(
        [("m", 0, 0, 3), ("m", 0, 1, 1), ("m", 1, 0, 2), ("m", 1, 1, 4), ("none", 1, 1, 5)],
        "model string, label int, predicted int, n long",
    )
    rows = {r.model: r for r in training.quality(counts).collect()}
    assert rows["m"].accuracy == pytest.approx(0.7)
    assert rows["m"].fake_precision == pytest.approx(0.6)
    assert rows["m"].fake_recall == pytest.approx(0.75)
    assert rows["m"].fake_f1 == pytest.approx(6 / 9)
    assert rows["none"].accuracy == 1.0 and rows["none"].fake_f1 is None


def test_every_frequent_term_is_fitted(spark):
    """More terms than any earlier bound, and an error instead of a cut."""
    words = [f"w{i}" for i in range(20_000)]
    halves = [" ".join(words[:12_000]), " ".join(words[12_000:]), "rare"]
    texts = spark.createDataFrame([(t,) for t in halves[:2] * 2 + halves[2:]], "t string")
    model = training.fit_vectorizer(texts, "t", training.TrainingOptions())
    assert model.vocabulary == sorted(words)
    with pytest.raises(ValueError, match="20000 terms"):
        training.fit_vectorizer(texts, "t", training.TrainingOptions(max_terms=19_999))


def test_unlabelled_texts_do_not_move(tables):
    plan = A.labelled_articles(tables["documents"], tables["labels"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_titles_are_found_in_linear_time(spark):
    pages = ["<title>" * 200_000, "x <TITLE>a\nb</title> <title>c</title>", "<title>open", "none", "<title></title>"]
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    rows = A.page_articles(frame).orderBy("page_id").collect()
    assert [r.headline for r in rows] == ["", "a\nb", "", "", ""]


def test_a_run_without_a_forest_is_refused(spark, tmp_path):
    frame = spark.createDataFrame([(1, "", "word " * 30)], "id long, headline string, article string")
    missing = FallbackScorer(K.FOREST_NAME)
    for run in (scoring.score_articles, scoring.score_articles_once):
        with pytest.raises(scoring.ForestMissing) as refused:
            run(frame, ["id"], missing, FallbackScorer())
        assert refused.value.code == 503
    with pytest.raises(scoring.ForestMissing):
        scoring.run_batch(frame, ["id"], str(tmp_path / "out"), missing, FallbackScorer())
    assert not (tmp_path / "out").exists()


def test_a_broken_second_model_is_an_error(spark, tmp_path):
    (tmp_path / "linear" / "versions" / "v" / "model" / "metadata").mkdir(parents=True)
    (tmp_path / "linear" / "versions" / "v" / "model" / "metadata" / "part-0").write_text("{")
    artefacts._publish(spark, str(tmp_path / "linear"), "v", "")
    with pytest.raises(Exception):
        artefacts.load_linear(str(tmp_path / "linear"))
    with pytest.warns(UserWarning, match="fall back"):
        artefacts.load_linear(str(tmp_path / "nothing"))


def test_scratch_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_shared_folder", lambda spark: str(tmp_path))
    assert session.materialise(spark.range(5).withColumn("s", F.lit("a")), "t").count() == 5
    assert any(tmp_path.iterdir())
    session.remove_scratch(spark)
    assert not any(p for p in tmp_path.iterdir() if not p.name.startswith("."))
