"""Operator 10, HTML extraction: a linear-chain conditional random field over the leaf blocks of a page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, workers_see_library

TRAINING_PAGES = 500  # expected pages to learn from
EPOCHS = 6
VARIANTS = 3  # a third of the training pages is shown as it is, one without article marks, one with its surroundings inside the article

# Fixed values of the HTML standard: elements that hold no content, that begin a block, whose content is not text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noframes noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style template".split())
# Elements and words of class, id and role names that stand for an article, or for what surrounds it.
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_NAMES = frozenset("article articlebody main content post entry story".split())
AROUND_TAGS = frozenset("head title nav header footer aside form button select option textarea label menu dialog noscript".split())
AROUND_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promotion related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Prefixes that say what a page has or lacks beside the element: "with-sidebar" is no sidebar.
MODIFIERS = re.compile(r"(?:has|have|with|no|without|show|hide|is)[-_]")
SENTENCE_ENDS = ".!?…\"”»"
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())


class Block(NamedTuple):
    text: str
    tags: tuple[str, ...]  # open elements, outermost first
    names: frozenset  # words of their class, id and role
    linked: int  # signs inside links
    near: frozenset = frozenset()  # tags (in brackets) and names of ancestors that stand for what surrounds an article
    path: tuple[int, ...] = ()  # numbers of the open elements in the page


class _Reader(HTMLParser):
    """Leaf blocks: runs of text between block elements, with their ancestors. Unclosed elements are closed as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, frozenset, int]] = []
        self.signs: list[frozenset] = []  # of each element, as in Block.near
        self.parts: list[str] = []
        self.linked = 0
        self.links = self.hidden = 0
        self.at: tuple = ()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            tags, names, path = zip(*self.at) if self.at else ((), (), ())
            self.blocks.append(Block(text, tags, frozenset().union(*names), self.linked, frozenset(), path))
        self.parts, self.linked = [], 0

    def _pop(self, depth: int) -> None:
        for tag, _, _ in self.open[depth:]:
            self.links -= tag == "a"
            self.hidden -= tag in HIDDEN
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            depth = len(self.open)
            while depth and self.open[depth - 1][0] not in BLOCK and self.open[depth - 1][0] not in HIDDEN:
                depth -= 1  # inline elements end with their block
            if depth and (self.open[depth - 1][0] == "p" or (self.open[depth - 1][0] == tag and tag in CLOSED_BY_SAME)):
                self._pop(depth - 1)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        names: set[str] = set()
        signs = {f"<{tag}>"} if tag in AROUND_TAGS else set()
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop") and value:
                for token in value.split():
                    words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower()) if w]
                    names.update(words)
                    if not MODIFIERS.match(token.lower()):
                        signs.update(AROUND_NAMES.intersection(words))
        self.open.append((tag, frozenset(names), len(self.signs)))
        self.signs.append(frozenset(signs) if tag not in ("html", "body") else frozenset())
        self.links += tag == "a"
        self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._pop(depth)
                break
            if self.open[depth][0] in BLOCK and tag not in BLOCK:
                break  # an inline end tag does not close a block

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if not self.parts or not any(p.strip() for p in self.parts):
            self.at = tuple(self.open)
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def _wrappers(blocks: list[Block]) -> set[int]:
    """Numbers of the elements around the article itself: their names say what else they hold, not what the article is.

    With marked articles, those that hold the first block of one and most of the marked text; without, those that hold
    more than four fifths of the page's text.
    """
    body = [b for b in blocks if "head" not in b.tags]
    marked = [b for b in body if _inside_article(b)]
    held: dict[int, int] = {}
    for b in marked or body:
        for element in b.path:
            held[element] = held.get(element, 0) + len(b.text)
    total = sum(len(b.text) for b in marked or body)
    if marked:
        return {e for e in marked[0].path if 2 * held[e] > total}
    return {e for e, n in held.items() if 5 * n > 4 * total}


def leaf_blocks(html: str | None) -> list[Block]:
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    wrappers = _wrappers(reader.blocks)
    near = lambda b: frozenset().union(*(reader.signs[e] for e in b.path if e not in wrappers))
    return [b._replace(near=near(b)) for b in reader.blocks]


def _inside_article(block: Block) -> bool:
    return any(t in ARTICLE_TAGS for t in block.tags) or "articlebody" in block.names


def _surrounds(block: Block) -> bool:
    """Whether an ancestor's tag or name says so; a header of an article itself does not."""
    return bool(block.near - {"<header>", "header"} if _inside_article(block) else block.near)


def features(blocks: list[Block], masked: bool = False) -> list[list[str]]:
    """Names of the features that hold for each block; `masked` leaves out what names an article."""
    rows = []
    for i, b in enumerate(blocks):
        n = len(b.text)
        row = ["bias", f"parent={b.tags[-1] if b.tags else ''}", f"size={min(n, 4000).bit_length()}", f"linked={min(4, 4 * b.linked // n)}"]
        row += [f"in={t}" for t in {*b.tags} - {"html", "body", "b", "i", "span"} - (ARTICLE_TAGS if masked else frozenset())]
        row += [f"named={w}" for w in b.names - (ARTICLE_NAMES if masked else frozenset())]
        if _surrounds(b):
            row.append("surrounds")
        if not masked and _inside_article(b) and not _surrounds(b):
            row.append("article")
        if not masked and b.names & ARTICLE_NAMES:
            row.append("named article")
        row.append("sentence" if b.text[-1] in SENTENCE_ENDS else "no sentence")
        if b.text[0] in "©®" or "all rights" in b.text.lower():
            row.append("rights")
        if i == 0:
            row.append("first")
        if i == len(blocks) - 1:
            row.append("last")
        rows.append(row)
    return rows


class Field(NamedTuple):
    """Weights for label 1 (main text) by feature; moves[a][b] for label b after a."""

    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]


#: Where training starts from, and all there is without a labelled page.
PRIOR = Field({"surrounds": -4.0, "article": 3.0, "named article": 1.0, "rights": -2.0, "in=head": -4.0, "sentence": 0.5, "linked=4": -2.0}, ((0.5, -0.5), (-0.5, 0.5)))


def emissions(field: Field, rows: list[list[str]]) -> list[float]:
    get = field.weights.get
    return [sum(get(f, 0.0) for f in row) for row in rows]


def decode(field: Field, rows: list[list[str]]) -> list[int]:
    """The likeliest labels of a page's blocks, by Viterbi; ties go to label 0."""
    if not rows:
        return []
    scores = emissions(field, rows)
    (t00, t01), (t10, t11) = field.moves
    zero, one, back = 0.0, scores[0], []
    for e in scores[1:]:
        from_zero, from_one = (0 if zero + t00 >= one + t10 else 1), (0 if zero + t01 >= one + t11 else 1)
        back.append((from_zero, from_one))
        zero, one = max(zero + t00, one + t10), max(zero + t01, one + t11) + e
    labels = [int(one > zero)]
    for pair in reversed(back):
        labels.append(pair[labels[-1]])
    return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3) -> Field:
    """Conditional log-likelihood by AdaGrad over labelled pages (features, labels), in the order given."""
    weights, moves = dict(PRIOR.weights), np.array(PRIOR.moves)
    squares: dict[str, float] = {}
    move_squares = np.full((2, 2), 1.0)
    for _ in range(epochs):
        for rows, labels in pages:
            n = len(rows)
            e = np.array(emissions(Field(weights, ()), rows))
            local = np.stack([np.zeros(n), e], 1)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = local[0]
            for i in range(1, n):
                ahead[i] = local[i] + np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1])
            for i in range(n - 2, -1, -1):
                onward = local[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(moves[:, 0] + onward[0], moves[:, 1] + onward[1])
            total = np.logaddexp(*ahead[-1])
            chance = np.exp(ahead[:, 1] + behind[:, 1] - total)
            step: dict[str, float] = {}
            for row, y, p in zip(rows, labels, chance):
                if abs(y - p) > 1e-4:
                    for f in row:
                        step[f] = step.get(f, 0.0) + (y - p)
            for f, g in step.items():
                g -= 1e-3 * (weights.get(f, 0.0) - PRIOR.weights.get(f, 0.0))
                squares[f] = squares.get(f, 1.0) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / squares[f] ** 0.5
            if n > 1:
                g = np.zeros((2, 2))
                np.add.at(g, (labels[:-1], labels[1:]), 1)
                pair = ahead[:-1, :, None] + moves[None] + (local[1:] + behind[1:])[:, None, :] - total
                g -= np.exp(pair).sum(0)
                move_squares += g * g
                moves = moves + rate * g / np.sqrt(move_squares)
    return Field(weights, tuple(tuple(float(x) for x in r) for r in moves))


def label_blocks(blocks: list[Block]) -> list[int] | None:
    """Labels of a training page, None for a page that gives none.

    By its own marks (an article element or property), less what surrounds. A page without marks, by its prose: of the
    blocks that read as sentences, are no links and surround nothing, the innermost element that holds four fifths of
    their text is the article.
    """
    labels = [int(_inside_article(b) and not _surrounds(b)) for b in blocks]
    if any(labels):
        return labels
    if any(_inside_article(b) for b in blocks):
        return None
    free = [b for b in blocks if not _surrounds(b) and "head" not in b.tags]
    prose = [b for b in free if len(b.text.split()) >= (5 if b.text[-1] in SENTENCE_ENDS else 20) and 2 * b.linked < len(b.text)]
    held: dict[int, int] = {}
    for b in prose:
        for element in b.path:
            held[element] = held.get(element, 0) + len(b.text)
    enough = [e for e, n in held.items() if 5 * n >= 4 * sum(len(b.text) for b in prose)]
    if not enough:
        return None
    return [int(max(enough) in b.path and not _surrounds(b)) for b in blocks]  # inner elements have larger numbers


def interleave(blocks: list[Block], labels: list[int]) -> tuple[list[Block], list[int]]:
    """The page with what surrounds its article dealt in between the article's blocks, inside the article's elements,
    and once more after the article, there and every other time inside as paragraphs."""
    inner, outer = ([b for b, y in zip(blocks, labels) if y == k] for k in (1, 0))
    if not any(t in ARTICLE_TAGS for t in inner[0].tags):
        return blocks, labels
    path = inner[0].tags[: next((i + 1 for i, t in enumerate(inner[0].tags) if t in ARTICLE_TAGS), 0)]
    around = [b for b in outer if _surrounds(b) and "head" not in b.tags]
    own = lambda b: tuple(t for t in b.tags if t not in ("html", "body"))
    moved = [b._replace(tags=(*path, *own(b), *("p",) * (k % 2))) for k, b in enumerate(around)]
    found: list[tuple[Block, int]] = [(b, 0) for b in outer if "head" in b.tags]
    for i, b in enumerate(inner):
        found.append((b, 1))
        found += [(m, 0) for m in moved[i :: len(inner)]]
    found += [(b._replace(tags=(*b.tags, "p")), 0) for b in around]
    return [b for b, _ in found], [y for _, y in found]


def learn_field(pages: DataFrame, rows: int = TRAINING_PAGES, id_col: str = "page_id", html_col: str = "html") -> Field:
    """A field trained on about `rows` pages, chosen by a hash of the id (see `label_blocks`).

    The sample is bounded, so its features may come to the driver. Without labelled pages the prior stands.
    """
    workers_see_library(pages.sparkSession)
    total = pages.filter(pages[html_col].isNotNull()).count()
    share = min(1.0, rows / max(total, 1))
    chosen = pages.filter(pages[html_col].isNotNull() & (F.pmod(F.xxhash64(pages[id_col], F.lit(10)), F.lit(1 << 20)) < share * (1 << 20)))
    chosen = chosen.select(F.xxhash64(pages[id_col]).alias("key"), pages[html_col].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            keys, rows, labels = [], [], []
            for key, html in zip(part.column("key").to_pylist(), part.column("html").to_pylist()):
                blocks = leaf_blocks(html)
                own = label_blocks(blocks)
                if own is not None:
                    if key % VARIANTS == 1:
                        blocks, own = interleave(blocks, own)
                    keys.append(key)
                    rows.append(features(blocks, masked=key % VARIANTS == 0))
                    labels.append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(rows, pa.list_(pa.list_(pa.string()))), pa.array(labels, pa.list_(pa.int32()))], names=["key", "rows", "labels"]
            )

    found = chosen.mapInArrow(run, "key bigint, rows array<array<string>>, labels array<int>").collect()
    found.sort(key=lambda r: (r["key"], r["labels"]))
    return train([(r["rows"], r["labels"]) for r in found])


def main_text(field: Field, html: str | None) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, keep in zip(blocks, decode(field, features(blocks))) if keep)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page, from its whole html.

    Blocks labelled as main text, each with white space made single and trimmed, joined in page order by a line break.
    Null or empty html, or a page without main text, gives an empty text. Broken markup is read as far as it goes.
    Null ids and urls stay null; repeated rows are extracted each; other columns are ignored. No shuffle.
    """
    spark = pages.sparkSession
    workers_see_library(spark)
    sent = spark.sparkContext.broadcast(field)  # bounded by the training sample
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(sent.value, h.as_py()) for h in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"]
            )

    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return rows.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
