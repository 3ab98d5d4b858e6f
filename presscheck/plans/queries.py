"""The registered queries: each reads the tables of one folder and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presscheck import constants as K
from presscheck.functions import text as X
from presscheck.operators import report, tfidf
from presscheck.operators.contract import result_ok
from presscheck.operators.decision import final_prediction
from presscheck.operators.distinct_texts import score_distinct
from presscheck.operators.forest_table import forest_table, walk
from presscheck.operators.once import compute_once
from presscheck.operators.scorers import FEATURES, TERMS, BatchScorer, FallbackScorer
from presscheck.operators.scores import logits_prediction, prediction
from presscheck.operators.vectorizer import vectorizer_of
from presscheck.operators.validation import (
    accepted,
    check_articles,
    error_message,
    page_precheck,
    rejected,
    word_count_label,
)
from presscheck.plans import scoring, training
from presscheck.session import materialise, scratch_path, spread
from presscheck.sources import articles as A
from presscheck.sources.results import read_rejected, read_scored
from presscheck.streaming.feed import COUNTS, await_feed, read_metrics, start_feed, start_feed_once

DOC, PAGE, TURN = ["doc_id"], ["page_id"], ["conv_id", "turn"]
MIN_DF = 2


class CountScorer:
    """Logits from counts of a text, so that SQL can say what a run must give."""

    def __init__(self, name: str, logits: Callable[[Column], Column]):
        self.name, self.logits = name, logits

    def score(self, df: DataFrame, text: str, out: str) -> DataFrame:
        verdict = logits_prediction(self.logits(X.text_or_empty(F.col(text))), self.name)
        return compute_once(df, {out: verdict})


def _counted_words(text: Column) -> Column:
    return F.array(X.word_count(text) % 7 / 2.0, F.size(X.tokens(text)) % 5 / 2.0)


def _counted_start(text: Column) -> Column:
    """From the first words; some texts have no answer."""

    def counted(words: Column) -> Column:
        size = F.length(F.array_join(words, " "))
        return F.when(size % 11 != 0, F.array(F.size(words) % 5 / 1.0, size % 7 / 1.0))

    return X.bind(X.first_words(text, K.MAX_TOKENS), counted)


FIRST = CountScorer(K.FOREST_NAME, _counted_words)
SECOND = CountScorer(K.SEQUENCE_NAME, _counted_start)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, folder):
    return spread(_table(spark, folder, "documents"), *DOC)


def pages(spark, folder):
    return spread(_table(spark, folder, "pages"), *PAGE)


def conversations(spark, folder):
    return spread(_table(spark, folder, "conversations"), *TURN)


# Cleaning.


def _cleaned(articles: DataFrame, keys: list[str]) -> DataFrame:
    text = X.build_news_text(F.col("headline"), F.col("article"))
    return compute_once(articles, {"clean_text": text}).select(*keys, "clean_text")


def clean_documents(spark, folder):
    cleaned = _cleaned(A.document_articles(documents(spark, folder)), DOC)
    return cleaned.withColumn("word_count", X.word_count(F.col("clean_text")))


def clean_pages(spark, folder):
    only_body = A.page_articles(pages(spark, folder)).withColumn("headline", F.lit(""))
    return _cleaned(only_body, PAGE)


def clean_conversations(spark, folder):
    return _cleaned(A.conversation_articles(conversations(spark, folder)), TURN)


def page_articles(spark, folder):
    return _cleaned(A.page_articles(pages(spark, folder)), PAGE)


def wire_documents(spark, folder):
    """Documents dressed as agency copy, with a prefix and a closing credit."""
    wire = F.concat(F.lit("REUTERS - "), F.col("text"), F.lit("\nReporting by A. Writer;\nEditing by B"))
    return _cleaned(A.document_articles(documents(spark, folder).withColumn("text", wire)), DOC)


def escaped_documents(spark, folder):
    """Documents with their markup escaped, as feeds deliver them."""
    body = F.replace(F.col("text"), F.lit("&"), F.lit("&amp;"))
    escaped = F.concat(F.lit("&lt;p class=&quot;x&quot;&gt;"), body, F.lit("&lt;/p&gt; &#101;nd&#x2e;"))
    return _cleaned(A.document_articles(documents(spark, folder).withColumn("text", escaped)), DOC)


# Validation.


def accepted_documents(spark, folder):
    checked = check_articles(A.document_articles(documents(spark, folder)))
    return accepted(checked).select("doc_id", "word_count")


def rejected_documents(spark, folder):
    return rejected(check_articles(A.document_articles(documents(spark, folder))))


def rejected_conversations(spark, folder):
    return rejected(check_articles(A.conversation_articles(conversations(spark, folder))))


def oversized_documents(spark, folder):
    """Texts used as headline and, five times over, as body: one or both may be too long."""
    long = documents(spark, folder).select(
        "doc_id", F.col("text").alias("headline"), F.repeat("text", F.lit(5)).alias("article")
    )
    return check_articles(long).select("doc_id", "code", "reason")


def raw_precheck_conversations(spark, folder):
    turns = conversations(spark, folder)
    return turns.select(
        *TURN,
        page_precheck(F.col("role"), F.col("text")).alias("message"),
        word_count_label(F.col("role"), F.col("text")).alias("label"),
    )


def error_messages(spark, folder):
    """Error details of all three shapes, made from the turns."""
    items = F.array(F.when(F.col("turn") % 2 == 0, "").otherwise(F.col("role")), F.col("role"))
    return conversations(spark, folder).select(
        *TURN,
        error_message(
            F.when(F.col("role") == "system", F.col("role")),
            F.when(F.col("turn") % 3 != 0, items),
            F.lit("Prediction failed."),
        ).alias("message"),
    )


def request_bodies(spark, folder):
    """Documents as JSON request bodies: some cut short, some with a null, some without a field."""
    doc, text = F.col("doc_id"), F.col("text")
    whole = F.to_json(F.struct(F.col("lang").alias("headline"), text.alias("article")))
    body = (
        F.when(doc % 7 == 0, F.left(whole, F.length(whole) - 1))
        .when(doc % 11 == 0, F.concat(F.left(whole, F.length(whole) - 1), F.lit(',"article2":null}')))
        .when(doc % 13 == 0, F.to_json(F.struct(text.alias("article"))))
        .when(doc % 17 == 0, F.concat(F.lit('{"headline":null,"article":'), F.to_json(F.array(text)), F.lit("}")))
        .otherwise(whole)
    )
    requests = documents(spark, folder).select("doc_id", body.alias("body"))
    return check_articles(A.parse_requests(requests, "body")).select(
        "doc_id", "malformed", "headline", F.length("article").alias("article_chars"), "code", "reason"
    )


def _request_lines(spark, folder) -> str:
    """Documents stored as JSON lines, some broken or with values of other types; the folder's name."""
    doc, text = F.col("doc_id"), F.col("text")
    head = F.concat(F.lit('{"id":'), doc.cast("string"), F.lit(","))

    def rest(*fields: Column) -> Column:
        return F.substr(F.to_json(F.struct(*fields)), F.lit(2))

    whole = F.concat(head, rest(F.col("lang").alias("headline"), text.alias("article")))
    line = (
        F.when(doc % 7 == 0, F.left(whole, F.length(whole) - 1))
        .when(doc % 11 == 0, F.concat(head, F.lit('"headline":null,'), rest(text.alias("article"))))
        .when(doc % 13 == 0, F.concat(head, rest(F.col("n_chars").alias("article"))))
        .when(doc % 17 == 0, F.concat(head, rest(F.array(text).alias("article"))))
        .when(doc % 19 == 0, F.concat(F.lit('{"id":"doc '), doc.cast("string"), F.lit('",'), rest(text.alias("article"))))
        .when(doc % 23 == 0, F.concat(F.lit("["), whole, F.lit("]")))
        .when(doc % 29 == 0, F.concat(head, rest(text.alias("article"))))
        .otherwise(whole)
    )
    path = scratch_path(spark, "lines")
    documents(spark, folder).select(line).write.text(path)
    return path


def _raw_id() -> Column:
    """The key that stands in a kept line, though the line could not be read."""
    return F.regexp_extract("raw", r'"id":"?(?:doc )?(\d+)', 1).cast("long").alias("raw_id")


def request_files(spark, folder):
    """Articles from files of JSON lines; broken ones are kept with their line."""
    checked = check_articles(A.read_articles(spark, _request_lines(spark, folder), "json"))
    return checked.select("id", _raw_id(), "malformed", F.length("article").alias("article_chars"), "code", "reason")


def request_stream(spark, folder):
    """The same files as a stream, through the whole path."""
    articles = A.stream_articles(spark, _request_lines(spark, folder), "json")
    path = scratch_path(spark, "feed")
    query = start_feed(articles, ["id", "raw"], path, scratch_path(spark, "feed-checkpoint"), FIRST, SECOND)
    query.awaitTermination()
    return spark.read.parquet(path).select("id", _raw_id(), "outcome", "code", "reason", "input.word_count")


# TF-IDF.


def _vocabulary(texts: DataFrame) -> DataFrame:
    return tfidf.fit_vocabulary(texts, "clean_text", MIN_DF)


def document_vocabulary(spark, folder):
    texts = _cleaned(A.document_articles(documents(spark, folder)), DOC)
    return _vocabulary(texts).select(
        "term", "df", F.round("idf", 6).alias("idf")
    )


def tfidf_documents(spark, folder):
    texts = materialise(_cleaned(A.document_articles(documents(spark, folder)), DOC), "texts")
    weights = tfidf.tfidf(texts, DOC, "clean_text", _vocabulary(texts))
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def indexed_terms(spark, folder):
    texts = _cleaned(A.document_articles(documents(spark, folder)), DOC)
    return tfidf.index_terms(_vocabulary(texts)).select("index", "term")


def aligned_documents(spark, folder):
    texts = materialise(_cleaned(A.document_articles(documents(spark, folder)), DOC), "texts")
    weights = tfidf.tfidf(texts, DOC, "clean_text", tfidf.index_terms(_vocabulary(texts)))
    vectors = tfidf.align(weights, DOC)
    entries = F.explode(F.arrays_zip("indices", "weights")).alias("e")
    return vectors.select("doc_id", entries).select(
        "doc_id", F.col("e.indices").alias("index"), F.round("e.weights", 6).alias("weight")
    )


def feature_mismatches(spark, folder):
    """Feature lists of documents and of pages, compared place by place."""
    of_documents = _vocabulary(_cleaned(A.document_articles(documents(spark, folder)), DOC))
    of_pages = _vocabulary(_cleaned(A.page_articles(pages(spark, folder)), PAGE))
    return tfidf.feature_mismatches(tfidf.index_terms(of_documents), tfidf.index_terms(of_pages))


def forest_features(spark, folder):
    """What the forest reads of every labelled document, with all terms fitted."""
    labelled = training.training_table(documents(spark, folder), _table(spark, folder, "labels"))
    features = training.fit_features(labelled, "clean_text")
    texts = labelled.select("doc_id", X.tokens(F.col("clean_text")).alias(TERMS))
    entry = F.unwrap_udt(FEATURES)
    pairs = F.explode(F.arrays_zip(entry["indices"].alias("i"), entry["values"].alias("w"))).alias("e")
    return features.transform(texts).select("doc_id", pairs).select(
        "doc_id", F.col("e.i").alias("index"), F.round("e.w", 6).alias("weight")
    )


def planted_forest(spark, folder):
    """A forest of one split, fitted on whether a document has a certain term, walked by joins.

    The term is the one that comes nearest to half of the documents; features are the counts
    of all terms that a quarter to three quarters of them have.
    """
    texts = materialise(_cleaned(A.document_articles(documents(spark, folder)), DOC), "texts")
    counted = tfidf.count_terms(texts, X.tokens(F.col("clean_text")))
    total = counted.where(F.col("term") == "").select("df").scalar()
    often = counted.where(F.col("term") != "").where(F.col("df").between(total / 4, total * 3 / 4))
    index = materialise(tfidf.index_terms(often), "index")
    planted = index.orderBy(F.abs(2 * F.col("df") - total), "term").head().term
    terms = X.tokens(F.col("clean_text"))
    vectorizer = vectorizer_of(index, TERMS, FEATURES)
    has_term = F.array_contains(TERMS, planted).cast("int").alias("label")
    vectors = vectorizer.transform(texts.select("doc_id", terms.alias(TERMS))).select("doc_id", has_term, FEATURES)
    stump = RandomForestClassifier(
        featuresCol=FEATURES, numTrees=1, maxDepth=1, featureSubsetStrategy="all", bootstrap=False, seed=1
    ).fit(vectors)
    weights = tfidf.term_counts(texts, DOC, "clean_text").join(F.broadcast(index.select("index", "term")), "term")
    weights = weights.select("doc_id", "index", F.col("tf").cast("double").alias("weight"))
    return walk(texts, DOC, weights, forest_table(spark, PipelineModel([stump])))


# Verdicts on scores derived from the keys, in steps of 1/1000.


def _thousandths(factor: int, start: int, count: int) -> Column:
    return (F.col("doc_id") * factor % count + start) / F.lit(1000.0)


def scorer_b_postprocess(spark, folder):
    """Logits with ties, missing values and NaN."""
    doc = F.col("doc_id")
    fake = (doc * 37 % 2001 - 1000) / F.lit(250.0)
    real = F.when(doc % 10 == 0, fake).otherwise((doc * 91 % 2001 - 1000) / F.lit(250.0))
    fake = F.when(doc % 13 == 0, F.lit(float("nan"))).otherwise(fake)
    logits = F.when(doc % 11 != 0, F.array(fake, real))
    verdict = compute_once(
        documents(spark, folder).select("doc_id"), {"v": logits_prediction(logits, K.SEQUENCE_NAME)}
    )
    return verdict.select("doc_id", *_rounded_verdict("v"))


def batch_model_scores(spark, folder):
    """Accepted documents through a batch model that fails on some of them."""

    def load():
        def predict(texts):
            words = [len(text.split(" ")) for text in texts]
            if any(n % 11 == 0 for n in words):
                raise ValueError("not scorable")
            return [[n % 7, n % 5] for n in words]

        return predict

    texts = accepted(check_articles(A.document_articles(documents(spark, folder))))
    scored = BatchScorer(load).score(texts, "clean_text", "v")
    return scored.select("doc_id", *_rounded_verdict("v"))


def _rounded_verdict(verdict: str) -> list[Column]:
    shares = ("confidence", "fake_probability", "real_probability")
    return [F.col(f"{verdict}.{c}") for c in ("model", "label", "prediction")] + [
        F.round(F.col(f"{verdict}.{c}"), 9).alias(c) for c in shares
    ]


def _derived_results(spark, folder) -> DataFrame:
    """Nested results from two made-up confidences; every fifth pair is tied."""
    doc = F.col("doc_id")
    first = _thousandths(37, 500, 501)
    second = F.when(doc % 5 == 0, first).otherwise(_thousandths(91, 500, 501))

    def verdict(model: str, label: Column, confidence: Column) -> Column:
        rest = F.round(1.0 - confidence, 3)
        fake = F.when(label == K.FAKE, confidence).otherwise(rest)
        real = F.when(label == K.FAKE, rest).otherwise(confidence)
        return prediction(model, label, fake, real)

    scored = compute_once(
        documents(spark, folder).select("doc_id", "n_chars"),
        {
            "first": verdict(K.FOREST_NAME, doc % 2, first),
            "second": verdict(K.SEQUENCE_NAME, F.floor(doc / 2) % 2, second),
        },
    )
    scored = compute_once(scored, {"verdict": final_prediction(F.col("first"), F.col("second"))})
    return scored.select(
        "doc_id",
        *report.result_columns(
            F.col("n_chars").cast("int"), F.col("first"), F.col("second"), F.col("verdict")
        ),
    )


def _results(spark, folder) -> DataFrame:
    """A whole run over the documents: stored and read back."""
    path = scratch_path(spark, "results")
    scoring.run_batch(A.document_articles(documents(spark, folder)), DOC, path, FIRST, SECOND)
    return read_scored(spark, path)


def decide_documents(spark, folder):
    decided = _results(spark, folder).select("doc_id", "final.*")
    return decided.withColumn("confidence", F.round("confidence", 9))


def response_flat(spark, folder):
    rows = report.model_rows(_results(spark, folder), *DOC)
    shares = ("confidence", "fake_probability", "real_probability")
    return rows.withColumns({c: F.round(c, 9) for c in shares})


def verdict_quality(spark, folder):
    """Scorers and decision against the labels."""
    labels = _table(spark, folder, "labels")
    articles = A.labelled_articles(documents(spark, folder), labels)
    done = scoring.scored(scoring.score_articles(articles, ["doc_id", "label"], FIRST, SECOND), ["doc_id", "label"])
    rates = ("accuracy", "fake_precision", "fake_recall", "fake_f1")
    return training.quality(training.confusion(done)).withColumns({c: F.round(c, 9) for c in rates})


def scored_once(spark, folder):
    """Every distinct text scored once; the same as scoring every document."""
    articles = A.document_articles(documents(spark, folder))
    done = scoring.scored(scoring.score_articles_once(articles, DOC, FIRST, SECOND), DOC)
    decided = done.select("doc_id", "final.*")
    return decided.withColumn("confidence", F.round("confidence", 9))


def edge_articles(spark, folder):
    """Turns dressed as rare cases: characters that NFKC maps, texts that clean to nothing, an
    overlong body."""
    kind = F.col("turn") % 5
    filler = F.concat(F.lit("ﬁve ½ Ｆｕｌｌ "), F.repeat(F.lit("w "), F.lit(20)))
    body = (
        F.when(kind == 0, F.concat(filler, F.col("text")))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit("<p></p> https://a.example/b <br/>"))
        .when(kind == 3, F.repeat(F.lit("w "), F.lit(50001)))
        .otherwise(F.lit("one two"))
    )
    articles = conversations(spark, folder).select(*TURN, F.lit("").alias("headline"), body.alias("article"))
    checked = check_articles(articles)
    return checked.select(
        *TURN,
        F.left("clean_text", F.lit(12)).alias("start"),
        "word_count",
        "code",
        "reason",
    )


def edge_prechecks(spark, folder):
    """Blank, one-word and long raw inputs as the page counts them."""
    text = F.when(F.col("turn") % 3 == 0, F.lit(" \t")).when(F.col("turn") % 3 == 1, F.lit(" one ")).otherwise(
        F.repeat(F.lit("word "), F.lit(25))
    )
    return conversations(spark, folder).select(
        *TURN,
        page_precheck(F.lit(""), text).alias("message"),
        word_count_label(F.lit(""), text).alias("label"),
    )


def response_json(spark, folder):
    return _derived_results(spark, folder).select("doc_id", report.result_json().alias("response"))


def report_columns(spark, folder):
    seconds = F.col("doc_id") * 7 % 2500 / F.lit(1000.0)
    return _results(spark, folder).select("doc_id", *report.final_columns(seconds))


def report_cards(spark, folder):
    rows = report.model_rows(_results(spark, folder), *DOC)
    cards = report.model_cards(rows, F.col("doc_id") * 11 % 2500 / F.lit(1000.0))
    widths = ("confidence_width", "fake_width", "real_width")
    return cards.select(
        "doc_id",
        "position",
        "badge",
        "confidence_text",
        "fake_text",
        "real_text",
        "time_text",
        *[F.round(w, 6).alias(w) for w in widths],
    )


def contract_violations(spark, folder):
    """Results, some broken: a label of 2, a probability above 1 or NaN, a null."""
    doc = F.col("doc_id")
    results = _results(spark, folder)
    label = F.when(doc % 17 == 0, 2).otherwise(F.col("final.label"))
    confidence = (
        F.when(doc % 19 == 0, F.lit(1.001))
        .when(doc % 23 == 0, F.lit(float("nan")))
        .otherwise(F.col("final.confidence"))
    )
    words = F.when(doc % 29 == 0, F.lit(-1)).otherwise(F.col("input.word_count"))
    method = F.when(doc % 31 != 0, F.col("final.decision_method"))
    final = F.col("final").withField("label", label).withField("confidence", confidence)
    final = final.withField("decision_method", method)
    checked = compute_once(
        results, {"contract_ok": result_ok(words, F.col("models"), final)}
    )
    return checked.where(~F.col("contract_ok")).select("doc_id", "contract_ok")


# Whole runs.


def distinct_texts(spark, folder):
    """Each distinct cleaned text measured once and joined back to its copies."""
    texts = materialise(_cleaned(A.document_articles(documents(spark, folder)), DOC), "texts")

    def measure(distinct: DataFrame) -> DataFrame:
        return distinct.select(
            "clean_text",
            X.word_count(F.col("clean_text")).alias("word_count"),
            F.size(X.tokens(F.col("clean_text"))).alias("tokens"),
        )

    return score_distinct(texts, "clean_text", measure).select("doc_id", "word_count", "tokens")


def fallback_results(spark, folder):
    """A whole run without the second model: stored by outcome and read back."""
    path = scratch_path(spark, "results")
    articles = A.conversation_articles(conversations(spark, folder))
    scoring.run_batch(articles, TURN, path, FIRST, FallbackScorer())
    done = read_scored(spark, path).select(
        *TURN,
        F.lit(None).cast("int").alias("code"),
        F.lit(None).cast("string").alias("reason"),
        "input.word_count",
        "final.label",
        F.round("final.confidence", 9).alias("confidence"),
        "final.agreement",
        "final.selected_model",
    )
    return done.unionByName(read_rejected(spark, path).select(*TURN, "code", "reason"), True)


def run_metrics(spark, folder):
    articles = A.page_articles(pages(spark, folder))
    metrics = scoring.run_batch(
        articles, PAGE, scratch_path(spark, "results"), FIRST, FallbackScorer()
    )
    return metrics.select("rows_in", "rows_rejected", "rows_scored", "contract_violations", "rows_fallback")


_scorers: dict[tuple[str, str], tuple] = {}


def scorers(spark, folder):
    """Both scorers, fitted on the labelled documents once per application and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _scorers:
        articles = A.labelled_articles(documents(spark, folder), _table(spark, folder, "labels"))
        fitted, _ = training.split(articles, DOC)
        table = training.prepared(fitted)
        _scorers[key] = (
            training.fit_forest(table, "clean_text"),
            training.fit_linear(table, "clean_text"),
        )
    return _scorers[key]


def end_to_end(spark, folder):
    articles = A.document_articles(documents(spark, folder))
    return scoring.score_articles(articles, DOC, *scorers(spark, folder))


def forest_scores(spark, folder):
    texts = accepted(check_articles(A.document_articles(documents(spark, folder))))
    forest, _ = scorers(spark, folder)
    return forest.score(texts, "clean_text", "verdict").select("doc_id", "verdict.*")


def scorer_b_scores(spark, folder):
    texts = accepted(check_articles(A.document_articles(documents(spark, folder))))
    _, linear = scorers(spark, folder)
    return linear.score(texts, "clean_text", "verdict").select("doc_id", "verdict.*")


def end_to_end_checks(spark, folder):
    """What must hold of every result, whatever the models say."""
    done = scoring.scored(end_to_end(spark, folder), DOC)
    first, second, final = F.col("models")[0], F.col("models")[1], F.col("final")
    agree = first["label"] == second["label"]

    def coherent(m: Column) -> Column:
        fake, real = m["fake_probability"], m["real_probability"]
        return (
            (F.abs(fake + real - 1.0) < 1e-9)
            & (m["confidence"] == F.greatest(fake, real))
            & (m["prediction"] == F.when(m["label"] == K.FAKE, K.FAKE_NAME).otherwise(K.REAL_NAME))
        )

    stronger = F.when(second["confidence"] >= first["confidence"], second["label"]).otherwise(
        first["label"]
    )
    return done.select(
        "doc_id",
        "input.word_count",
        F.forall("models", coherent).alias("models_coherent"),
        (first["model"] == K.FOREST_NAME).alias("forest_first"),
        (final["agreement"] == agree).alias("agreement_right"),
        (final["label"] == F.when(agree, first["label"]).otherwise(stronger)).alias("label_right"),
    )


def training_quality(spark, folder):
    """Both scorers and the decision on the held-out labelled documents."""
    labels = _table(spark, folder, "labels")
    _, held_out = training.split(A.labelled_articles(documents(spark, folder), labels), DOC)
    keys = ["doc_id", "label"]
    results = scoring.score_articles(held_out, keys, *scorers(spark, folder))
    return training.quality(training.confusion(scoring.scored(results, keys)))


def stream_scores(spark, folder):
    """The documents as a stream, run to its end."""
    # The glob finds the table whether it is a file or a folder of files.
    source = spark.readStream.schema(A.DOCUMENT_SCHEMA).parquet(f"{folder}/documents.parquet*")
    path = scratch_path(spark, "feed")
    query = start_feed(
        A.document_articles(source),
        DOC,
        path,
        scratch_path(spark, "feed-checkpoint"),
        FIRST,
        SECOND,
    )
    query.awaitTermination()
    return spark.read.parquet(path).select(
        "doc_id",
        "outcome",
        "code",
        "reason",
        "input.word_count",
        "final.label",
        F.round("final.confidence", 9).alias("confidence"),
        "final.selected_model",
    )


def stream_scores_once(spark, folder):
    """The documents in two batches of a feed, and all of them again under keys below zero; no text is scored twice."""
    incoming, out, known, checkpoint = (scratch_path(spark, n) for n in ("incoming", "feed", "known", "feed-checkpoint"))
    articles = A.document_articles(documents(spark, folder)).withColumnRenamed("doc_id", "id")
    half = F.pmod("id", F.lit(2))
    for part in (articles.where(half == 0), articles.where(half == 1), articles.withColumn("id", -1 - F.col("id"))):
        part.write.mode("append").parquet(incoming)
        feed = A.stream_articles(spark, incoming)
        start_feed_once(feed, ["id"], out, checkpoint, FIRST, SECOND, known).awaitTermination()
    return spark.read.parquet(out).select(
        F.col("id").alias("doc_id"),
        "outcome",
        "code",
        "input.word_count",
        "final.label",
        F.round("final.confidence", 9).alias("confidence"),
        "final.selected_model",
    )


def stream_metrics(spark, folder):
    """Metrics of a feed that is stopped after half of its files and started again, added up."""
    incoming, out, checkpoint, metrics = (scratch_path(spark, n) for n in ("incoming", "feed", "feed-checkpoint", "metrics"))
    articles = A.document_articles(documents(spark, folder)).withColumnRenamed("doc_id", "id")
    for half in (0, 1):
        articles.where(F.pmod("id", F.lit(2)) == half).write.mode("append").parquet(incoming)
        feed = A.stream_articles(spark, incoming)
        await_feed(start_feed(feed, ["id"], out, checkpoint, FIRST, FallbackScorer(), metrics=metrics))
    return read_metrics(spark, metrics).agg(*[F.sum(c).alias(c) for c in COUNTS])


QUERIES = {
    query.__name__: query
    for query in (
        clean_documents,
        clean_pages,
        clean_conversations,
        page_articles,
        wire_documents,
        escaped_documents,
        accepted_documents,
        rejected_documents,
        rejected_conversations,
        oversized_documents,
        raw_precheck_conversations,
        error_messages,
        request_bodies,
        request_files,
        request_stream,
        document_vocabulary,
        tfidf_documents,
        indexed_terms,
        aligned_documents,
        feature_mismatches,
        scorer_b_postprocess,
        batch_model_scores,
        forest_features,
        planted_forest,
        decide_documents,
        verdict_quality,
        scored_once,
        edge_articles,
        edge_prechecks,
        response_flat,
        response_json,
        report_columns,
        report_cards,
        contract_violations,
        distinct_texts,
        fallback_results,
        run_metrics,
        forest_scores,
        scorer_b_scores,
        end_to_end,
        end_to_end_checks,
        training_quality,
        stream_scores,
        stream_scores_once,
        stream_metrics,
    )
}
