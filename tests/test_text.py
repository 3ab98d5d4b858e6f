import html
import random
import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presscheck.functions import text as X

from conftest import SMALL

# Each step restated with Python's own re, html and unicodedata.
# The patterns of the contract, restated.
STEPS = {
    "tags": (X.remove_tags, lambda t: re.sub(r"<[^>]+>", " ", t)),
    "urls": (
        X.remove_urls,
        lambda t: re.sub(r"https?://\S+|www\.\S+", " ", t, flags=re.I),
    ),
    "emails": (
        X.remove_emails,
        lambda t: re.sub(r"\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b", " ", t),
    ),
    "agency": (
        X.remove_agency,
        lambda t: re.sub(r"^\s*(?:REUTERS|AP|AFP)\s*[-–—:]\s*", " ", t, flags=re.I),
    ),
    "credits": (
        X.cut_credits,
        lambda t: re.sub(
            r"\b(?:reporting by|additional reporting by|editing by)\b.*$",
            " ",
            t,
            flags=re.I | re.S,
        ),
    ),
    "controls": (X.blank_controls, lambda t: re.sub(r"[\x00-\x1f\x7f]", " ", t)),
    "blanks": (
        lambda c: X.collapse_blanks(X.blank_controls(X.decode_entities(c))),
        lambda t: re.sub(r"\s+", " ", STEPS["controls"][1](STEPS["decode"][1](t))),
    ),
    "lower": (F.lower, str.lower),
    "strip": (X.strip, str.strip),
    "decode": (
        X.decode_entities,
        lambda t: unicodedata.normalize("NFKC", html.unescape(t)),
    ),
}
ORDER = "decode tags urls emails agency credits controls lower".split()


def cleaned(text):
    for name in ORDER:
        text = STEPS[name][1](text)
    return re.sub(r"\s+", " ", text).strip()


def joined(headline, article):
    return " ".join(p for p in ((headline or "").strip(), (article or "").strip()) if p)


# Input and cleaned text of the edge cases, as Python literals.
EDGES = [
    ("REUTERS - hello", "hello"),
    ("(Reuters) - no", "(reuters) - no"),
    ("AP: x", "x"),
    ("ap—y", "y"),
    ("  AFP – z", "z"),
    ("api: stays", "api: stays"),
    ("a@b.co x", "x"),
    ("\xe9.a@b.com!", "!"),
    ("x+.y@d.e-f.org, more", ", more"),
    ("(a@b.com) z", "( ) z"),
    ("devanagari क\u093f@x.com", "devanagari क\u093f@x.com"),
    ("http://x\x1cy tail", "y tail"),
    ("&lt;b&gt;bold&lt;/b&gt; t", "bold t"),
    ("&#0; &#133; &nbsp;&notit; &amp;lt;", "� ... \xacit; &lt;"),
    ("\xbd ﬁ Ⅷ \xb2", "1⁄2 fi viii 2"),
    ("a < b and c > d", "a d"),
    ("<>", "<>"),
    ("&#x130;stanbul ΟΔΟΣ", "i\u0307stanbul οδος"),
    ("Story.\nEditing by Joe\nmore lines", "story."),
    ("coediting by x", "coediting by x"),
    ("additional reporting by z", ""),
    ("www.a.b", ""),
    ("WWW.X", ""),
    ("a b\x85c\x7fd", "a b c d"),
    ("", ""),
    ("   ", ""),
    ("<unterminated", "<unterminated"),
    ("\u200bzero\ufeff", "\u200bzero\ufeff"),
    ("a@b.c", "a@b.c"),
    ("_a@b.com_", "_a@b.com_"),
    ("x@y.com2", "x@y.com2"),
    ("ſeditıng by q", "seditıng by q"),
    ("<i>AP</i> - x", "x"),
    ("see http://a.b/c?d=<e>f g", "see f g"),
]

# Pieces that set off every step, put together at random.
PIECES = (
    list("ab Zé.+-@_<>&;:/\n\t\x00\x1c\x1f\x7f\x85\xa0\u2003\u2028\ufeff’½ﬁΣςİıſK2क\u093f中")
    + ["http://", "HTTPS://", "www.", "Www.", ".com", "@x.org", "a@b.co.uk.x", "&amp;", "&lt;"]
    + ["&gt;", "&nbsp", "&#33;", "REUTERS", "AP", "afp", " - ", "— ", "reporting by", "Editing by"]
    + ["additional reporting by ", "EDITİNG BY", "edıting by", " ", "  ", "ng by", "<b>", "</b>"]
)


def random_texts(seed, count, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize("name", STEPS)
def test_each_step_equals_python(spark, name):
    step, python = STEPS[name]
    texts = random_texts(name, 4000) + [raw for raw, _ in EDGES]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select("t", step(F.col("t")).alias("got"))
        .collect()
    )
    wrong = [(r.t, r.got, python(r.t)) for r in rows if r.got != python(r.t)]
    assert not wrong, wrong[:5]


def test_edge_cases(spark):
    rows = (
        spark.createDataFrame(EDGES, "raw string, want string")
        .select("raw", "want", X.clean_news_text(F.col("raw")).alias("got"))
        .collect()
    )
    assert [(r.raw, r.got) for r in rows if r.got != r.want] == []
    assert all(cleaned(raw) == want for raw, want in EDGES)


def test_headline_and_article_equal_python(spark):
    heads, bodies = random_texts(1, 8000, 6), random_texts(2, 8000, 20)
    pairs = list(zip(heads, bodies)) + [(None, None), (None, "x"), ("x", None), (" \n", "b")]
    frame = spark.createDataFrame(pairs, "h string, a string")
    text = X.build_news_text(F.col("h"), F.col("a"))
    rows = frame.select("h", "a", text.alias("got")).collect()
    wrong = [r for r in rows if r.got != cleaned(joined(r.h, r.a))]
    assert not wrong, wrong[:5]
    for row in rows:
        assert row.got == row.got.strip() and "  " not in row.got
        assert not re.search(r"[\x00-\x1f\x7f]", row.got)


def test_counts_equal_python(spark):
    texts = random_texts(3, 3000)
    frame = spark.createDataFrame([(t, cleaned(t)) for t in texts], "raw string, clean string")
    rows = frame.select(
        "raw",
        "clean",
        X.word_count(F.col("clean")).alias("words"),
        X.raw_word_count(F.col("raw")).alias("raw_words"),
        X.tokens(F.col("clean")).alias("tokens"),
        X.first_words(F.col("clean"), 3).alias("head"),
    ).collect()
    script_space = "\t-\r \xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    for r in rows:
        assert r.words == len(r.clean.split())
        assert r.raw_words == len(re.findall(f"[^{script_space}]+", r.raw))
        assert r.tokens == re.findall(r"\b\w\w+\b", r.clean)
        assert r.head == r.clean.split(" ")[:3]


def test_null_reads_as_empty(spark):
    row = spark.range(1).select(
        X.text_or_empty(F.lit(None)).alias("empty"),
        X.build_news_text(F.lit(None), F.lit(None)).alias("joined"),
    )
    assert row.first() == ("", "")


@pytest.mark.parametrize(
    "text, want",
    [
        ("a." * 50000 + "@", "a." * 50000 + "@"),
        ("@" + "x.y" * 30000, "@" + "x.y" * 30000),
        ("<" * 30000 + ">", ""),
        ("<b>x" + "<" * 200000, "x" + "<" * 200000),
        ("a" + " " * 200000 + "b ", "a b"),
        ("\u4e2d" * 100000 + "@b.com", ""),
        ("\n" * 100000 + "x" + "\n" * 100000, "x"),
    ],
    ids=["dotted-run", "dotted-domain", "open-brackets", "unclosed-brackets", "inner-blanks", "unbroken-script", "newlines"],
)
def test_hostile_texts_finish(spark, text, want):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(X.build_news_text(F.col("t"), F.lit(""))).first()[0] == want


# What crosses to Python.


def test_no_code_point_that_changes_stays_in_the_jvm(spark):
    """All code points by themselves, and 100,000 random pairs and triples of telling ones."""
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    generator = random.Random(8)
    telling = [c for c in points if unicodedata.combining(c) or unicodedata.decomposition(c) or ord(c) < 0x250]
    telling += [chr(c) for c in (*range(0x1100, 0x1200), *range(0xAC00, 0xAC40), 0x9BE, 0xB57, 0x3099, 0x1F600)]
    runs = ["".join(generator.choices(telling, k=generator.choice([2, 2, 3]))) for _ in range(100_000)]
    table = pa.table({"t": pa.array(points + runs, pa.string())})
    kept = spark.createDataFrame(table).where(~X.can_change(F.col("t"))).toArrow()["t"].to_pylist()
    assert all(unicodedata.normalize("NFKC", t) == t for t in kept)
    assert len(kept) > 50_000 and {"é", "ß", "日", "—", "😀", "д"} <= set(kept)


def test_few_texts_cross_to_python(spark):
    """Accented letters alone are no reason; measured on the documents."""
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    beyond_ascii = texts.where("octet_length(text) <> length(text)").count()
    crossing = texts.where(X.can_change(F.col("text"))).count()
    assert beyond_ascii > 40 and crossing < 0.2 * beyond_ascii
