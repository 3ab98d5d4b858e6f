"""Text cleaning as column expressions.

Every step maps a string column to a string column and stays in the JVM, except
the entity decoding and NFKC step, which Spark has no expression for. Python's
``re`` and Java's regex differ on what ``\\s``, ``\\w``, ``\\b`` and ignore-case
mean, so the classes below are spelled out.

A regex pass decodes, copies and re-encodes the whole text. Each step therefore
sits behind a test that is cheap (a byte search where possible) and true for
every text the step can change; texts without tags, links and so on skip the
pass.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Class bodies. What Python's \s and \w match.
PY_SPACE = r"\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Java's \w, which is ASCII, is the quick test for most characters of a word.
PY_WORD = r"\w\p{L}\p{N}"

_W = f"[{PY_WORD}]"
_RUN = f"[{PY_WORD}.+-]"
_DOMAIN = f"[{PY_WORD}.-]"
_S = f"[{PY_SPACE}]"

# The patterns of the contract.
TAG = r"<[^>]+>"
URL = f"(?iu)https?://[^{PY_SPACE}]+|www\\.[^{PY_SPACE}]+"
# Group 1 is punctuation in front of the address, which stays. A run of address
# characters is tried once, from its first word character (or from the end of
# the previous match), so the search stays linear in the text.
EMAIL = (
    f"(?:(?<!{_RUN})([.+-]*)(?={_W})|\\G(?<={_W})(?=[.+-]))"
    f"{_RUN}*@{_DOMAIN}+\\.[A-Za-z]{{2,}}(?!{_W})"
)
AGENCY = f"(?iu)^{_S}*(?:REUTERS|AP|AFP){_S}*[-–—:]{_S}*"
CREDIT = f"(?isu)(?<!{_W})(?:reporting by|additional reporting by|editing by)(?!{_W}).*"
CONTROL = r"[\x00-\x1f\x7f]"
# The spaces beyond ASCII that NFKC keeps.
NFKC_SPACES = "\u0085\u1680\u2028\u2029"
# The spaces beyond ASCII that JavaScript's \s matches.
PAGE_SPACES = (
    "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
ENDS = f"^{_S}+|(?<!{_S}){_S}+\\z"
TOKEN = f"{_W}{{2,}}"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _replace_where(test: Column, c: Column, pattern: str, by: str = " ") -> Column:
    return F.when(test, F.regexp_replace(c, pattern, by)).otherwise(c)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


# Ranges of code points in which NFKC is asked what it keeps; others count as changeable.
_PLANES = ((0, 0xD800), (0xE000, 0x10000), (0x1F000, 0x1FC00))
# Where all ranges of kept code points are used, dashes and quotes among them; elsewhere only
# long ones are, so that the class stays short.
_COMMON, _LONG = ((0, 0x600), (0x2000, 0x2100)), 200


@lru_cache(1)
def nfkc_changeable() -> str:
    """A class of all characters by which NFKC may change a text, and a few more.

    A text changes only if it has a character that does by itself, one that is put in order
    or one that joins the character before it. The class is what is left beside the ranges
    without any of these.
    """
    asked = [c for low, high in _PLANES for c in range(low, high)]
    joins = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # the later parts of Hangul syllables
    for c in asked:
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            joins.add(int(parts[1], 16))
    kept: list[list[int]] = []
    for c in asked:
        char = chr(c)
        if c in joins or unicodedata.combining(char) or unicodedata.normalize("NFKC", char) != char:
            continue
        if kept and kept[-1][1] == c - 1:
            kept[-1][1] = c
        else:
            kept.append([c, c])
    used = [(a, b) for a, b in kept if b - a >= _LONG or any(low <= a < high for low, high in _COMMON)]
    # ASCII is told first, so that most characters are not held against all ranges.
    return r"[[^\x00-\x7f]&&[^" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in used) + "]]"


def _decoder():
    # Defined inside a function so that it travels to the workers by value.
    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        import html
        import unicodedata

        return pa.array(
            [
                None if t is None else unicodedata.normalize("NFKC", html.unescape(t))
                for t in texts.to_pylist()
            ],
            pa.string(),
        )

    return decode


def decode_entities(c: Column) -> Column:
    """HTML entities decoded once, then NFKC.

    Only texts that can change cross to Python: one without ``&`` and without a character
    that NFKC may change is sent as null and keeps its JVM value.
    """
    return F.coalesce(_decoder()(bind(c, lambda t: F.when(can_change(t), t))), c)


def can_change(t: Column) -> Column:
    """False for texts that decoding and NFKC leave as they are; nearly all others are true."""
    return t.contains("&") | ((F.octet_length(t) != F.length(t)) & t.rlike(nfkc_changeable()))


def remove_tags(c: Column) -> Column:
    # Behind the last ">" there are no tags, and a "<" there would search in vain.
    rest = F.substring_index(c, ">", -1)
    tagged = F.left(c, F.length(c) - F.length(rest))
    bare = F.concat(F.regexp_replace(tagged, TAG, " "), rest)
    return F.when(c.contains("<") & c.contains(">"), bare).otherwise(c)


def remove_urls(c: Column) -> Column:
    return _replace_where(c.contains("://") | F.lower(c).contains("www."), c, URL)


def remove_emails(c: Column) -> Column:
    return _replace_where(c.contains("@"), c, EMAIL, "$1 ")


def remove_agency(c: Column) -> Column:
    return _replace_where(c.rlike(AGENCY), c, AGENCY)


def cut_credits(c: Column) -> Column:
    return _replace_where(F.lower(c).contains("ng by"), c, CREDIT)


def blank_controls(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, " ")


def collapse_blanks(c: Column) -> Column:
    """Each run of whitespace to one space, in an NFKC text without control characters.

    Such a text holds plain spaces and, rarely, one of ``NFKC_SPACES``.
    """
    return (
        F.when(_contains_any(c, NFKC_SPACES), F.regexp_replace(c, f"{_S}+", " "))
        .when(c.contains("  "), F.regexp_replace(c, "  +", " "))
        .otherwise(c)
    )


def _contains_any(c: Column, characters: str) -> Column:
    """True if a text has one of the non-ASCII characters; byte searches only."""
    found = reduce(lambda seen, ch: seen | c.contains(ch), characters, F.lit(False))
    return (F.octet_length(c) != F.length(c)) & found


def strip(c: Column) -> Column:
    """Python's ``str.strip``."""
    edge = F.substring(c, 1, 1).rlike(_S) | F.right(c, F.lit(1)).rlike(_S)
    return _replace_where(edge, c, ENDS, "")


# The order is part of the result.
CLEANING_STEPS = (
    remove_tags,
    remove_urls,
    remove_emails,
    remove_agency,
    cut_credits,
    blank_controls,
    F.lower,
    collapse_blanks,
)


def clean_news_text(c: Column) -> Column:
    """The cleaned text. Null gives null; see :func:`text_or_empty`."""
    bound = F.array(decode_entities(c))
    for step in CLEANING_STEPS:
        bound = F.transform(bound, step)
    return F.trim(F.get(bound, F.lit(0)))


def join_headline(headline: Column, article: Column) -> Column:
    """Stripped headline and article with one space between, blanks dropped."""
    parts = F.filter(F.transform(F.array(headline, article), strip), lambda part: part != "")
    return F.array_join(parts, " ")


def build_news_text(headline: Column, article: Column) -> Column:
    return clean_news_text(
        join_headline(text_or_empty(headline), text_or_empty(article))
    )


def word_count(cleaned: Column) -> Column:
    """Words of a cleaned text, which holds single inner spaces only."""
    spaces = F.octet_length(cleaned) - F.octet_length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", 0).otherwise(spaces + 1).cast("int")


def raw_word_count(c: Column) -> Column:
    """Words of a raw text as the page counts them (JavaScript whitespace)."""
    plain = bind(
        c, lambda t: _replace_where(_contains_any(t, PAGE_SPACES), t, f"[{PAGE_SPACES}]")
    )
    return F.regexp_count(plain, F.lit(r"[^\t-\r ]+"))


def tokens(cleaned: Column) -> Column:
    """Runs of two or more word characters."""
    return F.regexp_extract_all(cleaned, F.lit(TOKEN), F.lit(0))


def first_words(cleaned: Column, limit: int) -> Column:
    return F.slice(F.split(cleaned, " ", limit + 1), 1, limit)
