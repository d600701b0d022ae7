"""Main text of web pages as the best-scoring contiguous region of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.texts import small_batches
from tallyline.session import stored

#: Pages that weights are learnt from: those with the least hash of the id.
LABELLED_PAGES = 2000
#: No word counts for more than this, either way.
MOST = 4.0
#: Tags without a word between them cost no more than this within an element that holds the article,
#: less than the word that follows brings: so no block at either end of the article is cut off.
RUN = 0.5

# Elements by their part in a page.
CONTENT = {"article", "main"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button", "select"}
RAW = "script|style|noscript|template|textarea|svg|iframe|object|title"
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li",
    "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# A paragraph, item or cell ends where the next one begins.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "option": {"option"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}}
# Whole classes, ids and roles that name something other than the article. Names that only have such a
# word as a part, as "has-sidebar" or "header-fixed", say how a page is laid out.
_COMMENTS = r"comments?|disqus|replies"
_PARTS = (
    r"ads?|advert(?:s|isements?|ising)?|adsbygoogle|banner|sponsor(?:s|ed)?|promo(?:s|tions?)?|side-?bar|cookies?|consent|notice|newsletter|"
    rf"subscribe|share|social|{_COMMENTS}|related|breadcrumbs?|menu|nav(?:bar|igation)?|footer|header|toolbar|popup|modal"
)
_WHERE = r"area|bar|blocks?|box|buttons|container|form|links|list|section|threads?|widget|wrap(?:per)?"
# Comments have many names that end in the word; those that begin like "no-comments" speak of the layout.
_BY_READERS = rf"(?!(?:no|has|had|with|without|hide|hides|show|shows|is|are|un)[_-])(?:[a-z0-9]+[_-]+)*(?:(?:user|reader|visitor)s?)?(?:{_COMMENTS})(?:[_-]+(?:{_WHERE}))*"
_MARKED = re.compile(rf"(?:site[_-])?(?:{_PARTS})(?:[_-](?:{_PARTS}|{_WHERE}))*|{_BY_READERS}")
_OF_READERS = re.compile(rf"(?:{_COMMENTS})(?:[_-].*)?|{_BY_READERS}")
# What a page says of its own parts in the vocabulary of schema.org.
_TYPED = re.compile(r"comment|(?:https?://)?schema\.org/(?:user)?comments?")
# Elements that a class never takes out.
WHOLE = {"html", "body", "main", "article"}
_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)[\"']?[^>]*>?|<[!?][^>]*>?|([^<]+)|(<)", re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class Token(NamedTuple):
    """A run of words (``words`` > 0), or a tag, or a break between blocks."""

    words: int
    text: str
    around: str  # nearest marked element
    block: str  # nearest block
    link: bool
    inside: bool  # within an element that holds the article
    chrome: bool  # within an element that is never part of it
    tag: str
    marked: str  # class, id or role that names another part, of the nearest element that has one


@dataclass
class _Marked:
    """An element with such a name, and what it holds outside of ``CHROME``."""

    name: str
    around: int  # place of the marked element around it, or -1
    words: int = 0
    articles: int = 0
    mains: int = 0
    heading: bool = False  # the first one of the page


def _names(marked: list[_Marked], own: _Marked) -> list[str]:
    """What each marked element counts as; ``own`` is the page outside of them.

    An element around the article is no other part, whatever its class: one that holds all the ``main``
    of the page, or, if there is none, all its articles, or the first ``h1`` and most of the words.
    Articles in readers' comments are not meant. Such an element counts as what is around it.
    """
    for one in reversed(marked):
        up = marked[one.around] if one.around >= 0 else own
        up.words += one.words
        up.articles += one.articles
        up.mains += one.mains
        up.heading |= one.heading
    names: list[str] = []
    for one in marked:
        whole = one.mains == own.mains if own.mains else 0 < one.articles == own.articles
        whole |= one.heading and 2 * one.words > own.words
        names.append((names[one.around] if one.around >= 0 else "") if whole else one.name)
    return names


def tokens(page: str) -> list[Token]:
    """The words and tags of a page in order, in one pass; comments, scripts and styles are left out."""
    stack: list[tuple[str, str, bool, bool, int]] = []  # name, mark, article, never article, place in marked
    none = ("", "", False, False, -1)
    rows: list[Token] = []
    places: list[tuple[int, int]] = []  # token, marked element
    marked, own, headed = [], _Marked("", -1), False
    block, link = "", 0
    open_: Counter = Counter()  # how often each name is on the stack, so that a stray end costs no search
    for found in _TOKEN.finditer(page):
        _, closing, name, attributes, text, other = found.groups()
        if text or other:
            words = len((text or other).split())
            if words or text:
                top = stack[-1] if stack else none
                if top[4] >= 0:
                    places.append((len(rows), top[4]))
                if not top[3]:
                    (marked[top[4]] if top[4] >= 0 else own).words += words
                rows.append(Token(words, text or other, top[1], block, link > 0, top[2], top[3], "", ""))
            continue
        if not name:
            continue
        name = name.lower()
        if name == "a":
            link = 0 if closing else 1
        if name in BLOCKS:
            link = 0
            if closing:
                while open_[name]:
                    ended = stack.pop()[0]
                    open_[ended] -= 1
                    if ended == name:
                        break
            elif name not in VOID:
                while stack and stack[-1][0] in ENDS.get(name, ()):
                    open_[stack.pop()[0]] -= 1
                if name not in ENDS and stack and stack[-1][0] == "p":
                    open_[stack.pop()[0]] -= 1
                up = stack[-1] if stack else none
                classes, held = [], up[4]
                if "=" in attributes:
                    for key, *values in _ATTRIBUTE.findall(attributes):
                        if key.lower() in ("class", "id", "role"):
                            classes += "".join(values).lower().split()
                        elif key.lower() in ("itemprop", "itemtype") and any(_TYPED.fullmatch(v) for v in "".join(values).lower().split()):
                            classes.append("comment")
                if name not in WHOLE and (part := next((c for c in classes if _MARKED.fullmatch(c)), "")):
                    marked.append(_Marked(part, held))
                    held = len(marked) - 1
                if not up[3] and (name in CONTENT or name == "h1"):
                    at = marked[held] if held >= 0 else own
                    if name == "main":
                        at.mains += 1
                    elif name == "article":
                        at.articles += not _OF_READERS.fullmatch(at.name)
                    elif not headed:
                        at.heading = headed = True
                mark = name if name in CHROME else f"{name}.{classes[0]}" if classes and name not in CONTENT else up[1]
                open_[name] += 1
                stack.append((name, mark, up[2] or name in CONTENT, up[3] or name in CHROME, held))
            block = "" if name in VOID and not stack else (stack[-1][0] if stack else "")
        top = stack[-1] if stack else none
        if top[4] >= 0:
            places.append((len(rows), top[4]))
        rows.append(Token(0, "", top[1], block, False, top[2], top[3], name, ""))
    if marked:
        names = _names(marked, own)
        for at, k in places:
            if names[k]:
                rows[at] = rows[at]._replace(marked=names[k])
    return rows


@dataclass(frozen=True)
class Weights:
    """Scores of a word by its surroundings, and of a tag; what is not listed scores as ``word`` and ``tag``."""

    around: dict[str, float] = field(default_factory=dict)
    block: dict[str, float] = field(default_factory=dict)
    link: float = -1.5
    tags: dict[str, float] = field(default_factory=dict)
    word: float = 1.0
    tag: float = -1.0
    marks: dict[str, float] = field(default_factory=dict)
    mark: float = -MOST

    def of(self, t: Token) -> float:
        if t.inside and (t.chrome or t.marked):  # left out anyway; it does not end the article around it
            return 0.0
        if not t.words:
            return self.tags.get(t.tag, self.tag) if t.tag else 0.0
        if t.inside:  # the page says that this is the article, whatever such words are elsewhere
            return max(self.word, min(MOST, self.base(t))) * t.words
        if t.chrome:
            return -MOST * t.words
        one = self.base(t)
        if t.marked:
            one += self.marks.get(t.marked, self.mark)
        return max(-MOST, min(MOST, one)) * t.words

    def base(self, t: Token) -> float:
        return self.word + self.around.get(t.around, 0.0) + self.block.get(t.block, 0.0) + (self.link if t.link else 0.0)

    def scores(self, found: list[Token]) -> list[float]:
        """Scores of tokens in order; tags in a row within the article's element share the cost ``RUN``."""
        out, left = [], RUN
        for t in found:
            score = self.of(t)
            if t.words and not (t.chrome or t.marked):
                left = RUN
            elif t.inside and score < 0:
                score = max(score, -left / 2)
                left += score
            out.append(score)
        return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last-but-one place of the contiguous part with the greatest sum; the first of equals.

    One scan. Without a positive score the part is empty.
    """
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, at = total, (start, k + 1)
    return at


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the best region, one in a line.

    Marked parts are left out within an article, and where their words score negative. Between two
    elements that hold the article, only they count. If nothing else on the page scores, the marks
    are taken for layout and the page is scored without them.
    """
    found = tokens(page or "")
    scores = weights.scores(found)
    start, end = best_region(scores)
    if start == end and any(t.marked and t.words and not t.chrome for t in found):
        found = [t._replace(marked="") if t.marked else t for t in found]
        scores = weights.scores(found)
        start, end = best_region(scores)
    blocks, held = [], []
    named = [k for k in range(start, end) if found[k].inside and found[k].words and not (found[k].chrome or found[k].marked)]
    first, last = (named[0], named[-1]) if named else (end, end)

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            blocks.append(text)
        held.clear()

    for k in range(start, end):
        t, score = found[k], scores[k]
        if t.tag:
            if t.tag in BLOCKS:
                close()
        elif not t.chrome and not (t.marked and (t.inside or score < 0)) and (t.inside or not t.words or not first < k < last):
            held.append(t.text)
    close()
    return "\n".join(blocks)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words or tags of each kind the labelled pages have within and outside the article."""
    for batch in batches:
        counts: Counter = Counter()
        for page in batch.column(0).to_pylist():
            for t in tokens(page or ""):
                if t.tag:
                    counts["tag", t.tag, t.inside and not t.chrome and not t.marked] += 1
                elif t.words:
                    label = t.inside and not t.chrome and not t.marked
                    counts["around", t.around, label] += t.words
                    counts["block", t.block, label] += t.words
                    counts["link", str(t.link), label] += t.words
                    counts["mark", t.marked, t.inside and not t.chrome and not _OF_READERS.fullmatch(t.marked)] += t.words
        rows = [(*k, n) for k, n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "name", "content", "n"]
        )


def fit_weights(pages: DataFrame, most_pages: int = LABELLED_PAGES, most_names: int = 2000) -> Weights:
    """Weights from pages that name their article by an element of ``CONTENT``.

    At most ``most_pages`` of them are used, those with the least hash of the id. A weight is the
    logarithm of how much likelier words of a kind are within articles than elsewhere; tags never
    score above -0.05, and names of other parts never weigh above -0.1. The ``most_names`` most frequent names of each part are kept. Without labelled
    pages the defaults hold.
    """
    spark = pages.sparkSession
    small_batches(spark)
    marked = pages.where(F.col("html").rlike("(?i)<(" + "|".join(sorted(CONTENT)) + ")[\\s>]"))
    chosen = marked.select("page_id").where("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(most_pages)
    chosen = stored(chosen.coalesce(1), "labelled-pages")
    rows = pages.join(F.broadcast(chosen), "page_id", "left_semi").select("html")  # at most most_pages ids
    counts = rows.mapInArrow(_counts, "part string, name string, content boolean, n long")
    counts = counts.groupBy("part", "name").agg(
        F.sum(F.when(F.col("content"), F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("content"), 0).otherwise(F.col("n"))).alias("no"),
    )
    counts = stored(counts, "weights")
    kept = []
    for part in ("around", "block", "link", "tag", "mark"):
        kept += counts.where(F.col("part") == part).orderBy(F.desc(F.col("yes") + F.col("no")), "name").limit(most_names).collect()
    if not kept:
        return Weights()

    def odds(part: str) -> dict[str, float]:
        own = [r for r in kept if r["part"] == part]
        yes, no = sum(r["yes"] for r in own) + 1.0, sum(r["no"] for r in own) + 1.0
        return {
            r["name"]: max(-MOST, min(MOST, math.log((r["yes"] + 0.5) / yes) - math.log((r["no"] + 0.5) / no))) for r in own
        }

    return Weights(
        around=odds("around"), block=odds("block"), link=min(-0.1, odds("link").get("True", -1.5)),
        tags={k: min(-0.05, v) for k, v in odds("tag").items()},
        marks={k: min(-0.1, v) for k, v in odds("mark").items() if k},
    )


def _extracted(weights: Weights) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_main(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` (main text, empty if there is none) and ``n_chars``.

    Whole pages are read; a null page counts as empty. Words score by the elements around them, tags
    score negative, and the contiguous region with the greatest sum is the article; what stands in
    menus, headers, footers, sidebars, notices, adverts, forms or comments within it is left out.
    Character references are decoded, white space within a block becomes one space, blocks are
    joined by a line break. Rows with null or repeated ids are treated one by one.
    """
    weights = weights or fit_weights(pages)
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_extracted(weights), "page_id long, url string, text string, n_chars long")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    return extract_main(spark.read.parquet(f"{sf_dir}/pages.parquet"))
