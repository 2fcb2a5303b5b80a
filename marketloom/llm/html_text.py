"""Main text of web pages from flat text blocks and a decision tree.

A page is cut at block-level tags into flat text blocks. A block is described by its word count
and link density, those of its neighbours, and what encloses it; a decision tree, trained on a
labelled table of blocks of sample pages in this module, says which blocks are main text. Names of
classes are one feature of twelve.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text, those of them that
#: swallow the rest of a page when not closed, that end no block, that are parts of forms, that stand for page
#: furniture, that hold the article, and that end a text block.
HIDDEN = frozenset("script style noscript template head title svg iframe object canvas annotation annotation-xml".split())
RAW = frozenset("script style noscript template title iframe canvas".split())
INSIDE = frozenset("script style noscript template svg iframe object canvas annotation annotation-xml".split())
FORMS = frozenset("button select option textarea label fieldset input".split())
FURNITURE = frozenset("nav footer aside header menu dialog".split())
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var wbr math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup "
    "mtext munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Parts of class and id names that stand for furniture, those of them that stand for
#: reader comments, those that say only where or what a box is, and those that stand for the article.
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination "
    "popup promo promoted related replies reply respond responses share sharing sidebar signup social sponsor "
    "sponsored subscribe tags toolbar widget".split()
)
COMMENT_NAMES = frozenset("comment comments disqus replies reply respond responses".split())
PLACE_NAMES = frozenset(
    "area bar block body bottom box button buttons col column container content count floating form global group "
    "icons inner item items left links list main mobile outer page panel posts primary right row secondary section "
    "site slot small sticky text thread top unit user wrap wrapper".split()
)
ARTICLE_NAMES = frozenset("article body content entry main post story text".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "article", "furniture", "named", "form", "heading", "outside_article",
)


@dataclass
class Block:
    """A text without block-level markup inside it."""

    text: str
    words: int
    links: float  # share of words inside links
    article: int
    furniture: int  # by element or role
    named: int  # by class or id
    form: int
    heading: int
    within_form: int = 0  # number of the form around it


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, white space inside a block as one space."""
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    open_tags: list[Open] = []
    forms = 0
    links = 0
    unclosed: set[str] = set()  # hidden elements that do not end on the rest of the page

    def close_block() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            words = text.count(" ") + 1
            inside = len(html.unescape(" ".join(linked)).split())
            _, article, furniture, named, form, around = open_tags[-1] if open_tags else OUTSIDE
            heading = int(any(tag[0] in HEADINGS for tag in open_tags[-3:]))
            links_in = min(1.0, inside / words)
            found.append(Block(text, words, links_in, article, furniture, named, form, heading, around))
        parts, linked = [], []

    at = 0
    while at < len(page):
        cut = page.find("<", at)
        cut = len(page) if cut < 0 else cut
        if cut > at:
            parts.append(page[at:cut])
            if links:
                linked.append(page[at:cut])
        if cut == len(page):
            break
        tag = _TAG.match(page, cut)
        if tag is None:  # a bare "<" is text
            parts.append("&lt;")
            at = cut + 1
            continue
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if name == "br":
            parts.append(" ")
        elif name == "a":
            links = 0 if tag[1] else 1
        if name in INLINE:
            continue
        if name not in INSIDE:
            close_block()
        if tag[1]:
            _close(open_tags, name)
            continue
        if name in HIDDEN and not tag[3].endswith("/"):
            end = None
            if name not in unclosed:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in RAW:
                at = len(page)
            unclosed.update([name] if end is None else [])
            continue
        if name == "p" or name in ("li", "td", "th", "tr", "dd", "dt", "option"):
            _close_implied(open_tags, name)
        links = 0 if name in ("p", "div", "li") else links
        if name not in VOID and not tag[3].endswith("/"):
            forms += name == "form"
            open_tags.append(_opened(open_tags, name, tag[3], forms))
    close_block()
    return _without_page_forms(found)


def _without_page_forms(blocks: list[Block]) -> list[Block]:
    """A form around half of all words or more is the page's frame, not a form to fill in."""
    inside: dict[int, int] = {}
    for b in blocks:
        if b.within_form:
            inside[b.within_form] = inside.get(b.within_form, 0) + b.words
    total = sum(b.words for b in blocks)
    for b in blocks:
        if b.within_form and 2 * inside[b.within_form] < total:
            b.form = 1
    return blocks


#: What an open element passes on: its name, article, furniture, named, form, number of the form.
Open = tuple[str, int, int, int, int, int]
OUTSIDE: Open = ("", 0, 0, 0, 0, 0)


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def names_furniture(value: str, names: frozenset[str] = FURNITURE_NAMES) -> bool:
    """Whether a class or id stands for furniture: one of its names has a part of ``names``, and
    its other parts say only where or what the box is ("cookie-bar", not "social-history")."""
    for word in value.split():
        parts = {part.lower() for part in _NAME_PARTS.findall(word)}
        if parts & names and parts <= FURNITURE_NAMES | PLACE_NAMES:
            return True
    return False


def _opened(open_tags: list, name: str, attributes: str, forms: int) -> Open:
    _, article, furniture, named, form, around = open_tags[-1] if open_tags else OUTSIDE
    given = _attributes(attributes) if attributes else {}
    role = given.get("role", "").strip().lower()
    label = f"{given.get('class', '')} {given.get('id', '')}"
    around = forms if name == "form" else around
    if "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true":
        furniture = 1
    if name in FORMS:
        form = 1
    # A header inside the article holds its title.
    elif (name in FURNITURE and not (name == "header" and article)) or role in FURNITURE_ROLES:
        furniture = 1
    elif name in ARTICLE or role == "main":
        # The element says more than its class, but comments are often articles of their own.
        if names_furniture(label, COMMENT_NAMES):
            named = 1
        else:
            article = 1
    elif name not in ("html", "body") and names_furniture(label) and not (article and "header" in label.lower().split()):
        named = 1
    elif name in ("div", "section") and {p.lower() for p in _NAME_PARTS.findall(label)} & ARTICLE_NAMES:
        article = 1
    return name, article, furniture, named, form, around


def _close(open_tags: list, name: str) -> None:
    for i in range(len(open_tags) - 1, -1, -1):
        if open_tags[i][0] == name:
            del open_tags[i:]
            return


def _close_implied(open_tags: list, name: str) -> None:
    if open_tags and open_tags[-1][0] == name:
        open_tags.pop()


def features_of(blocks: list[Block]) -> np.ndarray:
    rows = np.zeros((len(blocks), len(FEATURES)))
    for i, b in enumerate(blocks):
        rows[i, :2] = b.words, b.links
        rows[i, 6:11] = b.article, b.furniture, b.named, b.form, b.heading
        rows[i, 11] = not b.article
    # Text beside an article differs from the text of a page that marks none.
    rows[:, 11] *= max((b.article for b in blocks if not (b.furniture or b.named)), default=0)
    rows[1:, 2:4] = rows[:-1, 0:2]
    rows[:-1, 4:6] = rows[1:, 0:2]
    return rows


#: Sample prose of the labelled table, in several languages.
PROSE = (
    "the river ran past old mills and over stones while people walked along its banks in spring",
    "der alte hof lag am rand des waldes und im winter brannte dort jeden abend ein kleines licht",
    "le marché ouvrait avant le jour et les pêcheurs posaient leurs caisses de glace sur la place",
    "la casa tenía un patio con naranjos donde los niños jugaban hasta que caía la tarde de verano",
)
#: Sample words of menus and short notices.
LABELS = "home news sport about kontakt impressum accueil contacto archive help shop more next previous login".split()


class _Sample:
    """Pieces of markup for the labelled table; all choices come from one seed."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.prose = PROSE[seed % len(PROSE)].split()

    def text(self, low: int, high: int) -> str:
        return " ".join(self.random.choices(self.prose, k=self.random.randint(low, high)))

    def link(self, low: int = 1, high: int = 3) -> str:
        label = " ".join(self.random.choices(LABELS, k=self.random.randint(low, high)))
        return f'<a href="/{self.random.randrange(99)}">{label}</a>'

    def links(self) -> str:
        kind = self.random.choice(["<li>{}</li>", "<p>{}</p>", "<div>{}</div>"])
        return "".join(kind.format(self.link()) for _ in range(self.random.randint(3, 7)))

    def article(self, framed: bool) -> list[tuple[str, int]]:
        """Heading, paragraphs long and short, with links, lists and quotes; a paragraph that is
        all link belongs to it only inside a marked article."""
        found = [(f"<h1>{self.text(3, 9)}</h1>", 1)]
        for _ in range(self.random.randint(3, 7)):
            kind = self.random.randrange(11)
            long, short = self.text(25, 90), self.text(1, 6)
            found.append((
                f"<p>{long}</p>" if kind < 4
                else f"<p>{long} {self.link()} {self.text(4, 20)}</p>" if kind == 4
                else f"<p>{short}.</p>" if kind == 5
                else f"<h2>{short}</h2><p>{long}</p>" if kind == 6
                else f"<ul><li>{short}</li><li>{self.text(2, 12)}</li></ul><p>{long}</p>" if kind == 7
                else f"<blockquote>{self.text(12, 40)}</blockquote><p>{long}</p>" if kind == 8
                else f"<p>{self.text(1, 12)} {self.link()} {self.text(1, 4)}</p>" if kind == 9
                else f"<p>{long}</p>", 1,
            ))
            if kind == 10:
                found.append((f'<p><a href="/x">{self.text(12, 60)}</a></p>', int(framed)))
        return found

    def bare(self) -> list[tuple[str, int]]:
        """A page with nothing but its text, be it one word."""
        frame = self.random.choice(["article", "main", "div", ""])
        few = self.random.randint(1, 4)
        body = [(f"<p>{self.text(1, 5) if self.random.random() < 0.5 else self.text(10, 90)}</p>", 1) for _ in range(few)]
        return [(f"<{frame}>", 0), *body, (f"</{frame}>", 0)] if frame else body

    def boxed(self, markup: str, tag: str, name: str) -> str:
        """The markup in an element, or without one, so that not only its name tells what it is."""
        kind = self.random.randrange(3)
        return markup if not kind else f"<{tag}>{markup}</{tag}>" if kind == 1 else f'<div class="{name}">{markup}</div>'

    def page(self) -> list[tuple[str, int]]:
        choice = self.random.random
        if choice() < 0.25:
            return self.bare()
        frame = self.random.choice(["article", "main", 'div id="content"', "", "", 'article class="post has-sidebar"'])
        page = [(self.boxed(self.links(), "nav", "menu"), 0)]
        if choice() < 0.5:
            page.append((f'<div class="cookie-notice"><p>{self.text(8, 30)}</p>{self.link()}</div>', 0))
        if choice() < 0.3:
            page.append((f"<header>{self.link()} {self.text(1, 4)}</header>", 0))
        body = self.article(bool(frame))
        extras = [
            (f'<div class="ad">{self.text(3, 25)}</div>', 0),
            (f"<form><label>{self.text(1, 3)}</label><p>{self.text(3, 15)}</p></form>", 0),
            (f"<ul>{self.links()}</ul>", 0),
        ]
        for extra in extras:
            if choice() < 0.4:
                body.insert(self.random.randint(2, len(body)), extra)
        if choice() < 0.4:
            inside = self.random.choice(['section id="comments"', 'div class="replies"', 'article class="comment"'])
            comments = "".join(f"<p>{self.text(5, 60)}</p>" for _ in range(self.random.randint(1, 3)))
            body.append((f"<{inside}>{comments}</{inside.split()[0]}>", 0))
        if frame:
            # Beside a marked article even plain text is something else.
            beside = [(f"<div>{self.text(1, 60)}</div>", 0) if choice() < 0.4 else ("", 0) for _ in range(2)]
            page += [beside[0], (f"<{frame}>", 0), *body, (f"</{frame.split()[0]}>", 0), beside[1]]
        else:
            page += body
        if choice() < 0.5:
            page.append((f"<aside><p>{self.text(5, 60)}</p>{self.links()}</aside>", 0))
        if choice() < 0.4:
            page.append((self.boxed(self.links(), "nav", "related-links"), 0))
        foot = f"&copy; {self.text(2, 12)} {self.link() if choice() < 0.5 else ''}"
        if choice() < 0.7:
            page.append((self.boxed(f"<p>{foot}</p>", "footer", "site-footer"), 0))
        return [("<form>", 0), *page, ("</form>", 0)] if choice() < 0.1 else page


def labelled_blocks(pages: range = range(300)) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: blocks of sample pages, 1 for main text.

    A page is pieces of markup, each with the label of the text in it.
    """
    rows, labels = [], []
    for seed in pages:
        page = _Sample(seed).page()
        rows.append(features_of(blocks_of("".join(markup for markup, _ in page))))
        for markup, label in page:
            labels += [label] * len(blocks_of(markup))
    return np.vstack(rows), np.array(labels)


@dataclass
class Node:
    """A split ``feature <= cut`` with its branches, or a leaf with a label."""

    label: int
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 9) -> Node:
    """A decision tree by Gini impurity; of equal splits the first feature and lowest cut."""
    node = Node(int(2 * labels.sum() >= len(labels)))
    if depth == 0 or labels.min() == labels.max():
        return node
    best = (labels.mean() * (1 - labels.mean()) * len(labels) - 1e-9, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= cut
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (labels[low], labels[~low]))
            if impurity < best[0] - 1e-9:
                best = (impurity, feature, float(cut))
    if best[1] < 0:
        return node
    low = rows[:, best[1]] <= best[2]
    node.feature, node.cut = best[1], best[2]
    node.low, node.high = grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)
    return node


@lru_cache(maxsize=1)
def tree() -> Node:
    return grow(*labelled_blocks())


def decide(node: Node, row: list[float]) -> int:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.cut else node.high
    return node.label


def main_text(page: str | None) -> str:
    """The blocks of main text, one to a line; empty if there are none."""
    blocks = blocks_of(page or "")
    node = tree()
    rows = features_of(blocks).tolist()
    return "\n".join(b.text for b, row in zip(blocks, rows, strict=True) if decide(node, row))


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            texts = [main_text(page.as_py()) for page in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, from the whole page.

    Null pages are empty and have empty text. Markup that is cut off or not closed is read as
    far as it goes. Repeated rows give repeated rows; empty input gives none; other columns are
    not read.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    return rows.mapInArrow(_text_batches, "page_id long, url string, text string, n_chars long")
