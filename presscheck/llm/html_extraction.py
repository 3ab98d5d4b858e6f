"""The main text of web pages, by a linear-chain conditional random field over text blocks.

A page is read into blocks (:mod:`presscheck.llm.html_blocks`). Each block is main text or
not; what speaks for either are the elements around it, the words of their class, id and
role, and the look of its text. Neighbours tend to agree, by weights of their own. Weights
are those of greatest likelihood, with sums over all labellings by the forward-backward
recursion; pages are decoded by Viterbi.

Labelled pages are those that name their parts: blocks in ``article`` or ``main`` that no
inner element marks as something else are main text. A bounded sample of them is read
(:data:`SAMPLE_PAGES` distinct pages of at most :data:`SAMPLE_CHARS` characters). Pages of one
site tell little about the markup of others, so each is also learned in :data:`DRESSES` other
dresses: the same texts in other elements and classes, with menus, notices, forms, adverts and
comments around and within. Without labelled pages, dresses of a few sentences are learned.

Null and empty html give an empty text. Repeated rows are read each. A table without pages gives no
rows. Long pages are read whole, one at a time. Other columns pass through :func:`extract`.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presscheck.llm.html_blocks import Reader
from presscheck.llm.tables import free_name, share, shared, slices
from presscheck.plans.logistic import minimise

SAMPLE_PAGES = 200
SAMPLE_CHARS = 100_000
DRESSES = 4
PENALTY = 0.03
PASSES = 120

# Names that sites give to the parts of a page, as text. The first list is main text.
MAIN = "content post-content entry-content article-body story-body post entry article story main text body-copy"
OTHER = {
    "nav": "nav menu navbar navigation breadcrumbs top-links main-menu topbar tabs pagination toc skip-link",
    "header": "header masthead site-header banner branding logo site-title tagline page-top",
    "footer": "footer site-footer copyright colophon legal imprint bottom page-bottom",
    "aside": "sidebar widget related recommended trending popular most-read more-stories rail secondary teaser promo-box",
    "notice": "notice cookie-banner consent gdpr alert popup modal overlay warning announcement message newsletter paywall subscribe",
    "advert": "ad ads advert advertisement sponsored sponsor promo banner-ad adsense commercial promotion",
    "form": "form search login signup contact-form subscribe-form newsletter-form register poll survey",
    "comments": "comments comment-list comment reply respond discussion disqus user-comments responses feedback reader-comments",
    "share": "share social tags meta byline author-box author post-meta date category share-buttons tools print",
}
# Only the first word of these parts is in the element's own name.
_ELEMENT = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
_PROSE = (
    "The council met on Monday, and after a long debate it agreed to repair the old bridge. "
    "Residents had asked for the work for years, since the road is closed whenever the river rises. "
    "It will cost less than was feared, the mayor said, but it will not be done before winter."
)
_LABELS = {
    "menu": "Home|News|Sport|About us|Contact|Archive|Login|Weather|Culture|Help",
    "notice": "We use cookies to improve this site. By using it you agree.|Accept all|Subscribe to our newsletter|"
    "This site needs JavaScript.|You have read your last free article.|Please note that our office is closed.",
    "advert": "Advertisement|Sponsored|Buy now and save!|Our partners|Sale ends today",
    "form": "Search|Your e-mail address|Send|Name|Password|Sign up|Leave a reply|Post comment",
    "share": "Share|Tweet|Print|Tags: news, local|Filed under: city|Read more|By the editors",
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|Imprint|Contact us",
}
_CLOSED = re.compile(r"[.!?:…»”\"')]\Z")
_NOTES = re.compile(
    r"\b(?:cookies?|copyright|rights reserved|privacy|subscribe|newsletter|log ?in|sign ?(?:up|in)|advertisement|"
    r"sponsored|repl(?:y|ies)|comments?|share|read more|terms)\b|©",
    re.I,
)


def look(text: str, linked: int) -> tuple[str, ...]:
    """Features of a block's text."""
    size = len(text)
    words = text.count(" ") + 1
    found = [
        "block",
        f"size {min(size.bit_length(), 11)}",
        f"words {min(words.bit_length(), 8)}",
        f"linked {-(-4 * linked // size)}",
        "closed" if _CLOSED.search(text[-1:]) else "open",
        f"commas {min(3, text.count(','))}",
    ]
    if size < 200 and _NOTES.search(text):
        found.append("note")
    if size < 80 and text.upper() == text:
        found.append("capitals" if text.lower() != text else "no letters")
    return tuple(found)


# Labelled pages.


def _by_parts(reader: Reader, page: str) -> list[tuple[frozenset, str, int, bool]]:
    """Blocks of a page that names its parts, with what they are."""
    others = {f"in {e}" for e in _ELEMENT.values() if e != "header"}
    others |= {f"named {name}" for part in OTHER.values() for name in part.split() if name.isalpha()}

    def main(place) -> bool:
        if not {"in article", "in main"} & place.features or others & place.features or "hidden" in place.features:
            return False
        return "in header" not in place.features or place.landmarks[1] in ("article", "main")

    return [(place.features, text, linked, main(place)) for place, text, linked in reader.read(page)]


def _dressed(rng: random.Random, title: str, paragraphs: list[str], rest: list[str]) -> str:
    """A page of the same texts in other markup; ``data-main`` tells what is main text."""
    import html

    def opened(kind: str, names: str, main: str | None = None) -> tuple[str, str]:
        element = _ELEMENT.get(kind, "div")
        element = rng.choice([element, element, "div", "section", "ul" if kind == "nav" else "div"])
        name = rng.choice(names.split())
        attribute = rng.choice([f'class="{name}"', f'id="{name}"', f'class="{name} {rng.choice("abcdefgh")}{rng.randrange(9)}"'])
        if element == _ELEMENT.get(kind) and rng.random() < 0.6:
            attribute = ""
        return f'<{element} {attribute} data-main="{main or "no"}">', f"</{element}>"

    def part(kind: str, inside: list[str]) -> str:
        if not inside or rng.random() < 0.35:
            return ""
        before, after = opened(kind, OTHER[kind])
        return before + "".join(inside) + after

    def labels(kind: str, most: int) -> list[str]:
        own = _LABELS[kind].split("|") + rest[:6]
        said = [html.escape(rng.choice(own)) for _ in range(rng.randint(1, most))]
        element = rng.choice(["li", "p", "div", "p"])
        link = rng.random() < (0.9 if kind in ("menu", "share") else 0.3)
        return [f"<{element}>" + (f'<a href="#">{t}</a>' if link else t) + f"</{element}>" for t in said]

    def fields() -> list[str]:
        kinds = ["label", "button", "legend", "option", "p"]
        return [f"<{k}>{html.escape(t)}</{k}>" for k in (rng.choice(kinds) for _ in range(3)) for t in [rng.choice(_LABELS["form"].split("|"))]]

    def remarks() -> list[str]:
        said = [html.escape(rng.choice(paragraphs + [_PROSE, "I agree.", "Thanks for this!"])) for _ in range(rng.randint(1, 5))]
        shape = rng.choice(["<li><p>{}</p></li>", '<div class="comment"><p>{}</p></div>', "<p>{}</p>", "<article><p>{}</p></article>"])
        return [rng.choice(["<h3>Comments</h3>", "<h2>3 replies</h2>", ""]), *map(shape.format, said)]

    def teasers() -> list[str]:
        said = [html.escape(rng.choice(paragraphs + rest + [_PROSE])[:120]) for _ in range(rng.randint(1, 4))]
        shape = rng.choice(['<li><a href="#">{}</a></li>', '<p><a href="#">{}</a></p>', "<p>{}</p>"])
        return [rng.choice(["<h3>Related</h3>", "<h4>Most read</h4>", ""]), *map(shape.format, said)]

    def short(text: str) -> str:
        return " ".join(text.rstrip(".").split()[: rng.randint(1, 6)])

    title = rng.choice([title, short(title), short(title)])
    copy = []
    for text in paragraphs:
        if rng.random() < 0.1:
            copy.append(rng.choice(["<h2>{}</h2>", "<h3>{}</h3>", "<p>{}</p>"]).format(html.escape(short(text))))
        shape = rng.choices(["<p>{}</p>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<div>{}</div>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>"], [30, 2, 2, 2, 3, 1, 1])[0]
        copy.append(shape.format(html.escape(text)))
        if rng.random() < 0.2:
            copy.append(part(*rng.choice([("advert", labels("advert", 2)), ("aside", teasers()), ("share", labels("share", 3)), ("notice", labels("notice", 1))])))
    level = rng.choice(["h1", "h1", "h2"])
    heading = f"<{level}>{html.escape(title)}</{level}>" if title else ""
    if heading and rng.random() < 0.3:
        heading = f"<header>{heading}</header>"
    inner = heading + rng.choice(["", part("share", labels("share", 3))]) + "".join(copy)
    inner += part("share", labels("share", 4)) + (part("comments", remarks()) if rng.random() < 0.3 else "")
    element = rng.choice(["article", "main", "div", "div", "section", "td"])
    bare = rng.random() < (0.5 if element in ("article", "main") else 0.15)
    before = f'<{element} {"" if bare else rng.choice(["class", "id"]) + "=" + rng.choice(MAIN.split())} data-main="yes">'
    if element == "td":
        before, after = "<table><tr>" + before, "</td></tr></table>"
    else:
        after = f"</{element}>"
    side = part("aside", teasers() + labels("menu", 5))
    head = part("header", [f"<h1>{html.escape(rng.choice(rest + ['Daily News']))}</h1>", *labels("menu", 2)])
    body = [head, part("nav", labels("menu", 8)), part("notice", labels("notice", 3)), part("advert", labels("advert", 2))]
    if rng.random() < 0.3:
        body.append(side)
        side = ""
    body += [before + inner + after, part("comments", remarks()), part("form", fields()), side]
    body += [part("advert", labels("advert", 2)), part("footer", labels("footer", 4)), part("notice", labels("notice", 2))]
    return f'<body data-main="no">{"".join(body)}</body>'


def labelled_blocks(pages: list[str]) -> list[list[tuple[frozenset, str, int, bool]]]:
    """The pages as they are and in other dresses, block by block."""
    found = []
    for number, page in enumerate(pages or [f"<h1>Old bridge</h1><article><p>{_PROSE}</p><p>{_PROSE}</p></article>"]):
        reader = Reader()
        blocks = _by_parts(reader, page)
        main = [text for _, text, _, is_main in blocks if is_main]
        rest = [text for _, text, _, is_main in blocks if not is_main and len(text) < 300]
        if not main:
            continue
        found.append(blocks)
        # The same dress for the same page whenever the fit is repeated.
        rng = random.Random(f"{number} {main[0]}")
        for _ in range(DRESSES):
            reader = Reader()
            dressed = reader.read(_dressed(rng, main[0], main[1:80] or main, rest))
            found.append([(place.features, text, linked, bool(place.main)) for place, text, linked in dressed])
    return found


# The conditional random field.


@dataclass(frozen=True)
class Field:
    """``weights`` speak for main text, ``rise`` and ``fall`` for main text to begin and to end after a block."""

    weights: dict[str, float]
    rise: float
    fall: float


def _likelihood(places, rows, labels, lengths, features: int, penalty: float):
    """The negative log likelihood of all labellings and its gradient, by forward and backward sums."""
    pages, longest = len(lengths), int(lengths.max())
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(longest)[None, :] < lengths[:, None]
    at = np.where(inside, starts[:, None] + np.arange(longest)[None, :], 0)
    gold = labels.astype(np.int64)
    after = np.setdiff1d(np.arange(len(gold) - 1), starts[1:] - 1)
    turns = gold[after + 1] - gold[after]
    seen = np.array([(turns > 0).sum(), (turns < 0).sum()], float)

    def evaluate(values: np.ndarray) -> tuple[float, np.ndarray]:
        score = np.bincount(rows, values[places], len(gold))
        step = np.array([[0.0, values[features]], [values[features + 1], 0.0]])
        local = np.zeros((pages, longest, 2))
        local[:, :, 1] = np.where(inside, score[at], 0.0)
        forward = np.empty_like(local)
        forward[:, 0] = local[:, 0]
        for t in range(1, longest):
            reached = np.logaddexp(forward[:, t - 1, 0, None] + step[0], forward[:, t - 1, 1, None] + step[1])
            forward[:, t] = np.where(inside[:, t, None], reached + local[:, t], forward[:, t - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        backward = np.zeros_like(local)
        for t in range(longest - 2, -1, -1):
            ahead = local[:, t + 1] + backward[:, t + 1]
            reached = np.logaddexp(step[:, 0] + ahead[:, 0, None], step[:, 1] + ahead[:, 1, None])
            backward[:, t] = np.where(inside[:, t + 1, None], reached, 0.0)
        main = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])[inside]
        ahead = (local + backward)[:, 1:, None, :]
        both = forward[:, :-1, :, None] + step + ahead - total[:, None, None, None]
        expected = np.exp(both[inside[:, 1:]]).sum(0)[[0, 1], [1, 0]] if longest > 1 else np.zeros(2)
        loss = total.sum() - score[gold == 1].sum() - seen @ values[features:]
        gradient = np.concatenate([np.bincount(places, (main - gold)[rows], features), expected - seen])
        return loss + penalty / 2 * float(values @ values), gradient + penalty * values

    return evaluate


def fit_field(pages: list[list[tuple[frozenset, str, int, bool]]], penalty: float = PENALTY, passes: int = PASSES) -> Field:
    """The weights of greatest penalised likelihood over pages of labelled blocks."""
    number: dict[str, int] = {}
    places, rows, labels, lengths = [], [], [], []
    for blocks in pages:
        if not blocks:
            continue
        lengths.append(len(blocks))
        for around, text, linked, is_main in blocks:
            seen = [number.setdefault(f, len(number)) for f in (*sorted(around), *look(text, linked))]
            places += seen
            rows += [len(labels)] * len(seen)
            labels.append(is_main)
    arrays = np.array(places), np.array(rows), np.array(labels), np.array(lengths)
    evaluate = _likelihood(*arrays, len(number), penalty)
    values = minimise(evaluate, np.zeros(len(number) + 2), passes, 1e-5)
    weights = {name: float(values[i]) for name, i in number.items() if abs(values[i]) > 1e-3}
    return Field(weights, *values[len(number) :].tolist())


def decode(scores: list[float], rise: float, fall: float) -> list[bool]:
    """The likeliest labels of a chain whose blocks score ``scores`` as main text."""
    back = []
    no, yes = 0.0, 0.0
    for i, score in enumerate(scores):
        if i:
            no_from, yes_from = no < yes + fall, no + rise < yes
            back.append((no_from, yes_from))
            no, yes = (yes + fall if no_from else no), (yes if yes_from else no + rise)
        yes += score
    labels = [yes > no] if scores else []
    for came in reversed(back):
        labels.append(came[labels[-1]])
    return labels[::-1]


# The operator.


def fit(pages: DataFrame, html: str = "html") -> Field:
    """Fitted on a sample of distinct pages that name their parts, the same for the same pages."""
    page = F.col(html).cast("string")
    named = pages.where(page.rlike(r"(?i)<(article|main)\b") & (F.length(page) <= SAMPLE_CHARS)).select(
        page.alias("page"), F.xxhash64(page).alias("mark")
    )
    marks = [row.mark for row in named.select("mark").distinct().orderBy("mark").limit(SAMPLE_PAGES).collect()]
    # Copies are put together before the sample comes to the driver.
    chosen = named.where(F.col("mark").isin(marks)).groupBy("mark").agg(F.min("page").alias("page"))
    return fit_field(labelled_blocks([row.page for row in chosen.orderBy("mark").collect()]))


def _extractor(model, html: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field: Field = shared(model)
        weights, reader = field.weights, Reader(field.weights)
        for batch in batches:
            for part in slices(batch, html):
                texts = []
                for page in part[html].to_pylist():
                    blocks = reader.read(page)
                    scores = [
                        place.score + sum([weights.get(f, 0.0) for f in look(text, linked)])
                        for place, text, linked in blocks
                    ]
                    main = decode(scores, field.rise, field.fall)
                    texts.append("\n".join([block[1] for block, is_main in zip(blocks, main) if is_main]))
                names = [c for c in part.schema.names if c != html]
                columns = [part[c] for c in names] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, out])

    return run


def extract(pages: DataFrame, field: Field, html: str = "html", out: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry``, or all columns but the html, and the main text of each page."""
    kept = [c for c in pages.columns if c != html] if carry is None else carry
    inner = free_name("_html", pages)
    out = free_name(out, pages.select(*kept))
    rows = pages.select(*kept, F.col(html).cast("string").alias(inner))
    schema = rows.drop(inner).schema.add(out, "string")
    return rows.mapInArrow(_extractor(share(pages.sparkSession, field), inner, out), schema)
