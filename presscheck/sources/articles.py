"""Article tables: a key, a headline and a body.

Columns whose values come from elsewhere carry two more: ``malformed`` and ``raw``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

from presscheck import constants as K
from presscheck.functions.text import text_or_empty

ARTICLE_SCHEMA = "id long, headline string, article string"
DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# From the first opening tag on; a search from each would take time in the square of the page.
TITLE = r"(?is)\A(?:(?!<title>).)*+<title>(.*?)</title>"
# Most label keys to send to every task, of about 100 bytes each in memory.
BROADCAST_LABELS = 1_000_000


def with_defaults(articles: DataFrame) -> DataFrame:
    """Missing headlines and bodies read as empty."""
    return articles.withColumns(
        {c: text_or_empty(F.col(c)) for c in ("headline", "article")}
    )


# Where CSV keeps the line of a record that breaks the schema.
_BROKEN = "_broken_record"


def read_articles(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str = ARTICLE_SCHEMA, **options
) -> DataFrame:
    """Articles from files with the given schema; a column that a file lacks is empty.

    Records of text formats can be broken or hold values of other types. Of JSON lines and
    CSV such a record is not dropped or read as empty: ``malformed`` marks it, ``raw`` has its
    line, and :func:`presscheck.operators.validation.check_articles` rejects it with 422.
    """
    return _articles(spark.read, path, fmt, schema, options)


def stream_articles(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str = ARTICLE_SCHEMA, **options
) -> DataFrame:
    """Articles from files as they arrive in a folder, by the same rules."""
    return _articles(spark.readStream, path, fmt, schema, options)


def _articles(reader, path: str, fmt: str, schema: str, options: dict) -> DataFrame:
    if fmt == "json":
        return parse_lines(reader.format("text").options(**options).load(path), "value", schema)
    if fmt == "csv":
        # The mode is what keeps broken records; a caller's other options stand.
        kept = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
        rows = reader.schema(f"{schema}, {_BROKEN} string").format(fmt).options(**kept).load(path)
        broken = F.col(_BROKEN).isNotNull()
        fields = [F.when(~broken, F.col(c)).alias(c) for c in ("headline", "article")]
        keys = [c for c in rows.columns if c not in ("headline", "article", _BROKEN)]
        rows = rows.select(*keys, *fields, broken.alias("malformed"), F.col(_BROKEN).alias("raw"))
        return with_defaults(rows)
    return with_defaults(reader.schema(schema).format(fmt).options(**options).load(path))


def _parsed_fields(parsed: Column, keys: StructType) -> tuple[list[Column], list[Column], Column]:
    """Keys and texts of a parsed JSON body, and whether it breaks the rules."""

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.variant_get(parsed, f"$.{name}", "variant"))

    def is_text(name: str) -> Column:
        return F.coalesce(kind(name) == "STRING", F.lit(True))

    def key(field) -> Column:
        return F.try_variant_get(parsed, f"$.{field.name}", field.dataType.simpleString()).alias(field.name)

    an_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    right = an_object & is_text("headline") & is_text("article")
    for field in keys:
        absent = kind(field.name).isNull() | (kind(field.name) == "VOID")
        held = key(field).isNotNull()
        if isinstance(field.dataType, IntegralType):
            held = held & (kind(field.name) == "BIGINT")
        elif isinstance(field.dataType, StringType):
            held = kind(field.name) == "STRING"
        right = right & (absent | held)
    texts = [F.variant_get(parsed, f"$.{name}", "string").alias(name) for name in ("headline", "article")]
    return [key(field) for field in keys], texts, ~right


def parse_requests(requests: DataFrame, body: str, keys: str = "") -> DataFrame:
    """Headline and body from a column of JSON request bodies.

    A field may be missing, but not null or anything else than text. ``malformed``
    marks the bodies that break this rule or are no JSON object;
    :func:`presscheck.operators.validation.check_articles` rejects them. ``keys`` is a
    schema of further fields to take out of the body; one that is missing or null is null,
    and a value of another type makes the body malformed.
    """
    kept = [c for c in requests.columns if c != body]
    found, _, malformed = _parsed_fields(F.col("_parsed"), StructType.fromDDL(keys) if keys else StructType())
    parsed = requests.withColumn("_parsed", F.try_parse_json(body)).withColumn("malformed", malformed)
    whole = F.when(~F.col("malformed"), F.col("_parsed"))
    _, texts, _ = _parsed_fields(whole, StructType())
    fields = [text_or_empty(text).alias(name) for name, text in zip(("headline", "article"), texts)]
    return parsed.select(*kept, *found, *fields, "malformed")


def parse_lines(lines: DataFrame, line: str, schema: str = ARTICLE_SCHEMA) -> DataFrame:
    """Articles from JSON lines, with ``malformed``, and in ``raw`` the line of a malformed one.

    Blank lines are no records.
    """
    keys = StructType([f for f in StructType.fromDDL(schema) if f.name not in ("headline", "article")])
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    records = lines.where(F.trim(line) != "").select(F.col(line).alias("raw"), F.col(line).alias("_line"))
    parsed = parse_requests(records, "_line", names)
    return parsed.withColumn("raw", F.when(F.col("malformed"), F.col("raw"))).select(
        *keys.names, "headline", "article", "malformed", "raw"
    )


def document_articles(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id", F.lit("").alias("headline"), text_or_empty(F.col("text")).alias("article")
    )


def page_articles(pages: DataFrame) -> DataFrame:
    """Pages with their title as headline."""
    html: Column = text_or_empty(F.col("html"))
    return pages.select(
        "page_id",
        F.regexp_extract(html, TITLE, 1).alias("headline"),
        html.alias("article"),
    )


def conversation_articles(conversations: DataFrame) -> DataFrame:
    """Turns as articles, keyed by conversation and turn."""
    return conversations.select(
        "conv_id",
        "turn",
        F.lit("").alias("headline"),
        text_or_empty(F.col("text")).alias("article"),
    )


def labelled_articles(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that carry a quality label, read as 0 = Fake and 1 = Real.

    Up to a bound the labels go to the documents, so unlabelled texts do not move.
    """
    known = labels.where(F.col("quality").isin(K.FAKE, K.REAL)).select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return document_articles(documents).join(known, "doc_id")
