"""Main text of web pages as the best-scoring contiguous run of tokens.

A page is a sequence of tags and runs of text. Words score positive where labelled pages have their
content, tags and the words of menus, notices and the like score negative, and one scan over the running
sum finds the contiguous run of the highest score. The weights are log odds of tokens inside against
outside of the content, counted by Spark over labelled pages: those with exactly one <article> or <main>.
They are fitted on a bounded sample of about TRAIN_PAGES of these, dealt by a hash of the id.

Elements that never belong to the text (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments of readers) are known by element, role or class; their words count against a
region and are left out of it. What remains of the region is cut into blocks at block-level tags; white
space in a block becomes one space and blocks are joined by a line feed.

Nulls: a null or empty page has the text "". Unclosed elements end with the element that holds them.
Pages without any text have "". Repeated rows are treated alike, no rows give no rows, and other columns
pass through; columns named `text` or `n_chars` are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of the sample that the weights are fitted on.
TRAIN_PAGES = 2000

RAW = "script|style|textarea|title|noscript|template|iframe|svg|xmp|noembed|noframes|math|object|audio|video|canvas"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<!/)>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>?"
    r"|<[!?][^>]*+>?",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
LANDMARKS = ("article", "main")
SKIPPED = frozenset(
    "nav header footer aside form head title button select menu dialog script style noscript template iframe svg "
    "label input textarea".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form note".split()
)
MARKED = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert newsletter subscribe signup sidebar aside comment comments disqus reply replies menu "
    "nav navbar navigation breadcrumb breadcrumbs pagination header masthead footer copyright share sharing social "
    "related recommended popup modal overlay".split()
)


@dataclass
class Token:
    """A tag, or a run of text: its element, and where it stands."""

    name: str
    text: str = ""
    words: int = 0
    skipped: bool = False
    linked: bool = False
    inside: bool = False
    block: bool = False


@dataclass
class Page:
    tokens: list[Token] = field(default_factory=list)
    landmarks: int = 0


def _unwanted(name: str, attributes: str) -> bool:
    if name in SKIPPED:
        return True
    if not attributes.strip():
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and name not in ("body", "html", *LANDMARKS):
            if not MARKED.isdisjoint(re.split(r"[\s_-]+", value)):
                return True
        elif key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def tokenize(page: str) -> Page:
    """Tags and runs of text in page order, each with what its ancestors say about it."""
    out = Page()
    stack: list[tuple[str, bool]] = []
    skipped = linked = inside = 0

    def close(depth: int) -> None:
        nonlocal skipped, linked, inside
        while len(stack) > depth:
            name, unwanted = stack.pop()
            skipped -= unwanted
            linked -= name == "a"
            inside -= name in LANDMARKS

    def put(name: str, text: str = "", block: bool = False) -> None:
        words = len(text.split())
        if text and not words and "\x00" not in text:
            words = 0
        out.tokens.append(Token(name, text, words, skipped > 0, linked > 0, inside > 0, block))

    def text_of(part: str) -> None:
        if part:
            put(stack[-1][0] if stack else "", entities.unescape(part) if "&" in part else part)

    at = 0
    for match in TOKEN.finditer(page):
        text_of(page[at : match.start()])
        at = match.end()
        slash, name, attributes = match.group(2), match.group(3), match.group(4)
        if name is None:
            slash, name, attributes = match.group(5), match.group(6), match.group(7)
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCKS
        if slash:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is not None:
                put(name, block=block)
                close(depth)
            elif block:
                put(name, block=True)
            continue
        if block:
            # A paragraph or list item that is still open ends here.
            ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th")}
            ends = (*ends.get(name, ()), "p")
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        if name in VOID or attributes.endswith("/"):
            if name == "br":
                put(name, " ")
            else:
                put(name, block=block)
            continue
        unwanted = _unwanted(name, attributes)
        stack.append((name, unwanted))
        skipped += unwanted
        linked += name == "a"
        if name in LANDMARKS:
            inside += 1
            out.landmarks += inside == 1
        put(name, block=block)
    text_of(page[at:])
    return out


@dataclass(frozen=True)
class Weights:
    """Score of a word by its element, and of a tag by its name; both by `default` if unknown."""

    word: dict[str, float]
    tag: dict[str, float]
    plain_word: float
    plain_tag: float

    def of(self, token: Token, landmark: bool) -> float:
        if token.words:
            if token.skipped or landmark and not token.inside:
                return -abs(self.plain_word) * token.words
            kind = "a" if token.linked else token.name
            return self.word.get(kind, self.plain_word) * token.words
        if token.text:
            return 0.0
        return self.tag.get(token.name, self.plain_tag)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run of the highest sum, the first and shortest of equal ones; an empty
    run if no score is positive."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0.0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    read = tokenize(page)
    landmark = read.landmarks == 1
    first, last = best_run([weights.of(t, landmark) for t in read.tokens])
    blocks: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        if text:
            blocks.append(text)
        held.clear()

    for token in read.tokens[first:last]:
        if token.block:
            close()
        elif not token.skipped and (token.inside or not landmark):
            held.append(token.text)
    close()
    return "\n".join(blocks)


def fit_weights(pages: DataFrame, page_id: str = "page_id", html: str = "html", most: int = TRAIN_PAGES) -> Weights:
    """Count tokens inside and outside of the content of labelled pages; elements outside the fixed lists
    share one weight, so the table of counts is bounded."""
    known = BLOCKS | SKIPPED | VOID | {"a", "b", "i", "em", "strong", "span", "u", "small", "code", "sup", "sub"}
    labelled = pages.filter(F.col(html).contains("<article") | F.col(html).contains("<main"))
    total = max(1, labelled.count())
    sample = labelled.filter(F.pmod(F.xxhash64(page_id, html), F.lit(total)) < most).select(html)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                read = tokenize(page)
                if read.landmarks != 1:
                    continue
                for t in read.tokens:
                    good = t.inside and not t.skipped
                    if t.words:
                        kind = "a" if t.linked else t.name
                        seen["word", kind if kind in known else "", good] += t.words
                    elif not t.text:
                        seen["tag", t.name if t.name in known else "", good] += 1
        rows = [(kind, name, good, n) for (kind, name, good), n in seen.items()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "name", "good", "n"])

    counted = sample.mapInArrow(count, "kind string, name string, good boolean, n long")
    rows = counted.groupBy("kind", "name", "good").agg(F.sum("n").alias("n")).collect()
    seen = {(r["kind"], r["name"], r["good"]): r["n"] for r in rows}

    def odds(kind: str, name: str) -> float:
        good, bad = seen.get((kind, name, True), 0), seen.get((kind, name, False), 0)
        return math.log((good + 1.0) / (bad + 1.0))

    # Words of an element that is content at least as often as not score from 1 to 3; a tag costs from
    # 0.05 to 4, so that a word outweighs the tags of its own block.
    word = {n: min(3.0, max(1.0, o)) if (o := odds("word", n)) >= 0 else max(-3.0, o) for k, n, _ in seen if k == "word"}
    tag = {n: -min(4.0, max(0.05, -odds("tag", n))) for k, n, _ in seen if k == "tag"}
    return Weights(word, tag, word.get("", 1.0) if word.get("", 1.0) > 0 else 1.0, tag.get("", -0.05))


def extract_main_text(pages: DataFrame, page_id: str = "page_id", html: str = "html", weights: Weights | None = None) -> DataFrame:
    """The pages without their markup: every other column, `text`, and `n_chars` in code points."""
    fitted = weights or fit_weights(pages, page_id, html)
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), fitted) for page in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept]
    return pages.select(*kept, html).mapInArrow(extract, ", ".join([*fields, "text string", "n_chars long"]))
