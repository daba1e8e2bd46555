"""Main text of HTML pages by two passes over blocks.

A linear tokenizer cuts the page into blocks at block-level tags; each block knows its text, its linked
characters and the regions it lies in. Page furniture (menus, headers, footers, sidebars) is a bad region. So are forms and
elements of which a class, id or role says notice, advert, comments, ... at its begin or end (`cookie-notice`, `ad-slot`, not
`has-sidebar`, `content-sidebar-wrap` or `ad-free`), unless these turn out to hold the page's text: what has `main` in it, or,
comments apart, most of the text of the page while no article stands outside of it, is a wrapper and no furniture.

Pass one decides each other block by its stop-word density, length and link density: linked text is bad, longer text
with stop words is good, longer text with few of them and a link is bad, and the rest is near (undecided). `article` and
`main` only soften the bounds: linked text in them is bad from `INSIDE_LINKS` on, and longer text is never bad by its words.
Where no block of a page is good by stop words (other languages, few words), its undecided longer blocks are taken as
good, or, without any, its undecided short ones.

Pass two gives the undecided blocks the label of their nearest decided neighbours, those inside of an article and
those outside by themselves; where the two neighbours differ, headings go with the block behind and others with the
nearer one (the one before on a tie), and a block inside an article goes only where both are bad. What lies outside of
articles is left out if any block inside of one is good now, but where it is a longer text of over twice their length.

Defined results: null or empty html gives an empty text; unclosed tags end with their parent, at any depth, and `head`
with the first element that cannot lie in it; a page without any good block gives an empty text; character references
are decoded once; repeated rows are treated alike; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm import common

#: Element names of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "iframe", "title", "noembed", "noframes", "xmp"}
SKIPPED = {"noscript", "template", "svg", "math", "canvas", "object", "select"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"}
IN_HEAD = {"base", "link", "meta", "head"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Open elements of the value end, innermost first, where a new one of the key begins.
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
#: Words in class, id or role of elements that are no main text.
HINTS = (
    "ad ads adv advert advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices outbrain pagination popup promo promoted "
    "recommended related respond share sharing sidebar social sponsor sponsored subscribe taboola teaser toolbar widget complementary "
    "contentinfo search alert"
).split()
#: Frequent function words of English, German, French and Spanish.
STOP = set(
    "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the their them there they this "
    "to was we were which will with you der die das den dem des ein eine einer und ist im in zu von mit auf für nicht sich auch als an er sie "
    "es wird dass bei le la les un une des du de et est en que qui dans pour pas sur par plus au aux avec ce se il elle el los las una unos y "
    "o es del al por con para su sus no lo como más pero".split()
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HINT_WORD = re.compile(r"[A-Za-z]+")
#: The tags of elements whose content is no text; only ASCII letters have two cases here.
ENDING = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I | re.A) for name in RAW | SKIPPED}
TAGS = {name: re.compile(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*>?", re.I | re.A) for name in SKIPPED}
SHORT, LONG = 70, 200
MAX_LINKS, INSIDE_LINKS, STOP_LOW, STOP_HIGH = 0.33, 0.6, 0.08, 0.15


class Hint:
    """An element that its names or its kind make furniture, unless it holds the page's text."""

    __slots__ = ("bad", "comments", "main", "outer", "text", "within")

    def __init__(self, outer: Hint | None, comments: bool) -> None:
        self.outer, self.comments, self.main, self.bad = outer, comments, False, True
        self.text = self.within = 0  # unlinked characters of its longer blocks, and of those inside of articles


class Block:
    __slots__ = ("bits", "heading", "hint", "label", "linked", "region", "text")

    def __init__(self, region: str, heading: bool, hint: Hint | None = None) -> None:
        self.bits: list[str] = []
        self.linked, self.region, self.heading, self.label, self.text, self.hint = 0, region, heading, "", "", hint


def behind(page: str, name: str, at: int, lasts: dict[str, int]) -> int:
    """Where the content of an element that is no text ends. A raw one goes on to the page's end if it is not closed; of
    a skipped one only the tag goes then. lasts: the last end tag of each name, found once."""
    if name in RAW:
        end = ENDING[name].search(page, at)
        return len(page) if end is None else end.end()
    if name not in lasts:
        lasts[name] = max((m.end() for m in ENDING[name].finditer(page, at)), default=-1)
    depth = 1
    for m in TAGS[name].finditer(page, at, max(at, lasts[name])):
        depth += -1 if m[1] else 1
        if not depth:
            return m.end()
    return max(at, lasts[name])


def blocks_of(page: str) -> list[Block]:
    """The blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str, Hint | None]] = []  # open element, region of its content: '', 'good' or 'bad', innermost hint
    hints: list[Hint] = []
    hint: Hint | None = None
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are
    region, heading, links = "", 0, 0
    now = Block("", False)
    at, lasts = 0, {}

    def close() -> None:
        nonlocal now
        if now.bits:
            now.text = " ".join(entities.unescape("".join(now.bits)).split())
            if now.text:
                out.append(now)
        now = Block(region, heading > 0, hint)

    def add(text: str) -> None:
        if text:
            now.bits.append(text)
            if links:
                now.linked += len(text.strip())

    while (m := TOKEN.search(page, at)) is not None:
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if not closing and name in ENDING:
            if name in RAW or not m[3].endswith("/"):
                at = behind(page, name, at, lasts)
            if name not in ("script", "style"):
                now.bits.append(" ")
            continue
        if closing:
            at_name = places.get(name)
            gone = stack[at_name[-1] :] if at_name else []
            del stack[len(stack) - len(gone) :]
        else:
            gone = []
            if places.get("head") and name not in IN_HEAD:
                gone = stack[places["head"][-1] :]
                del stack[len(stack) - len(gone) :]
            if name in BLOCK and name != "br":
                # inline elements left open (<b>, <i>, ...), a paragraph and open siblings end at the next block
                ends = ENDS.get(name, ())
                while stack and (stack[-1][0] == "p" or stack[-1][0] not in BLOCK or stack[-1][0] in ends):
                    gone.append(stack.pop())
        for open_name, _, _ in gone:
            places[open_name].pop()
            heading -= open_name in HEADINGS
            links -= open_name == "a"
        region, hint = stack[-1][1:] if stack else ("", None)
        block = name in BLOCK or any(x[0] in BLOCK for x in gone)
        if block:
            close()
        if not closing and name not in VOID:
            inner, said = region_of(name, m[3], region, bool(places.get("article")))
            if not m[3].rstrip().endswith("/"):
                if said:
                    hint = Hint(hint, said == "comments")
                    hints.append(hint)
                if name == "main" and hint:
                    hint.main = True
                places.setdefault(name, []).append(len(stack))
                stack.append((name, inner, hint))
                region = inner
                heading += name in HEADINGS
                links += name == "a"
        if block:
            now.region, now.heading, now.hint = region, heading > 0, hint
        elif region != now.region or hint is not now.hint:
            close()
    rest = page[at:]
    add(rest if "<" not in rest else re.sub(r"<[A-Za-z/!][^>]*\Z", "", rest))
    close()
    weigh(out, hints)
    return out


def weigh(found: list[Block], hints: list[Hint]) -> None:
    """Blocks of hints that stand are bad. hints: outer ones before inner ones."""
    text = within = 0
    for x in found:
        n = len(x.text) - x.linked
        if x.region == "bad" or len(x.text) < SHORT or x.linked > INSIDE_LINKS * len(x.text):
            continue
        text, within = text + n, within + (n if x.region == "good" else 0)
        if x.hint:
            x.hint.text, x.hint.within = x.hint.text + n, x.hint.within + (n if x.region == "good" else 0)
    for h in reversed(hints):
        if h.outer:
            h.outer.text, h.outer.within, h.outer.main = h.outer.text + h.text, h.outer.within + h.within, h.outer.main or h.main
    for h in hints:
        wraps = h.main or not h.comments and 2 * h.text > text and h.within == within
        h.bad = not wraps or h.outer is not None and h.outer.bad
    for x in found:
        if x.hint and x.hint.bad:
            x.region = "bad"


def region_of(name: str, attributes: str, outer: str, in_article: bool) -> tuple[str, str]:
    """The region of an element's content, and what its kind or its names say; an article's own header is none of the page's."""
    if outer == "bad" or name in FURNITURE and name != "form" and not (name == "header" and in_article):
        return "bad", ""
    said = ""
    if attributes and name not in ("html", "body", "article", "main"):
        said = hinted(name, attributes, in_article)
        if said == "hidden":
            return "bad", ""
    return "good" if name in ("article", "main") else outer, said or ("form" if name == "form" else "")


def hint_of(token: str) -> str:
    """The word of a class, id or role that says that the element is no main text: its last or its first one."""
    words = [w.lower() for w in HINT_WORD.findall(token)]
    if not words or words[0] in _DENIES:
        return ""
    if words[-1] in _HINTS:
        return words[-1]
    return words[0] if words[0] in _HINTS and words[-1] not in _WRAPS else ""


def hinted(name: str, attributes: str, in_article: bool) -> str:
    """Whether class, id or role say that the element is no main text: `hidden`, `comments`, `furniture` or nothing. The word `header`
    says it as the element does: not in an article, and not beside a word for the text itself (`post-header`); a heading needs all
    words to say it."""
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if key not in ("class", "id", "role"):
            continue
        words = [w.lower() for w in HINT_WORD.findall(value)]
        said = [w for w in map(hint_of, value.split()) if w and not (w == "header" and (in_article or _OWN.intersection(words)))]
        if said and (name not in HEADINGS or all(w in _HINTS for w in words)):
            return "comments" if _COMMENTS.intersection(said) else "furniture"
    return ""


_HINTS = set(HINTS)
_OWN = {"post", "entry", "article", "story", "content", "title"}
#: Words that turn a hint behind them around, or that make a hint before them the name of a wrapper; readers' comments.
_DENIES = {"has", "no", "non", "not", "with", "without"}
_WRAPS = {"free", "layout", "page", "results", "site", "wrap", "wrapper"}
_COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond"}


def first_pass(x: Block) -> str:
    """good, bad or near (undecided)."""
    inside, share = x.region == "good", x.linked / max(1, len(x.text))
    if x.region == "bad" or share > (INSIDE_LINKS if inside else MAX_LINKS):
        return "bad"
    if len(x.text) < SHORT:
        return "near" if not x.linked or inside else "bad"
    stop = stop_density(x.text)
    if stop >= STOP_HIGH or len(x.text) > LONG and stop >= STOP_LOW:
        return "good"
    return "near" if inside or stop >= STOP_LOW or not x.linked else "bad"


def stop_density(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP for w in words) / max(1, len(words))


def without_stop_words(found: list[Block]) -> None:
    """A page without a good block (of few words, or in a language whose stop words are not known): its undecided
    longer blocks are good, or, if it has none, its undecided short ones."""
    if any(x.label == "good" for x in found):
        return
    near = [x for x in found if x.label == "near"]
    for x in [x for x in near if len(x.text) >= SHORT] or near:
        x.label = "good"


def second_pass(found: list[Block]) -> None:
    """The undecided inherit from the nearest decided blocks before and behind."""
    far = 2 * len(found) + 1
    before: list[tuple[int, str]] = []
    last = {True: (-far, ""), False: (-far, "")}  # inside and outside of the article
    for k, x in enumerate(found):
        if x.label != "near":
            last[x.region == "good"] = (k, x.label)
        before.append(last[x.region == "good"])
    last = {True: (far, ""), False: (far, "")}
    for k in range(len(found) - 1, -1, -1):
        x = found[k]
        inside = x.region == "good"
        if x.label != "near":
            last[inside] = (k, x.label)
            continue
        (i, a), (j, b) = before[k], last[inside]
        if inside:
            keep = "good" in (a, b) or "" in (a, b)
        elif a == b or not a or not b:
            keep = (a or b) == "good"
        else:
            keep = (b if x.heading or j - k < k - i else a) == "good"
        x.label = "good" if keep else "out"


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks_of(page)
    for x in found:
        x.label = first_pass(x)
    without_stop_words(found)
    second_pass(found)
    good = [x for x in found if x.label == "good"]
    inside = [x for x in good if x.region == "good"]
    held, rest = (sum(len(x.text) for x in good if (x.region == "good") == own) for own in (True, False))
    if inside and not (rest >= LONG and rest > 2 * held):
        good = inside
    return "\n\n".join(x.text for x in good)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield common.batch_of(
                page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(texts, pa.string()), n_chars=pa.array([len(x) for x in texts], pa.int64())
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(common.released(run), "page_id bigint, url string, text string, n_chars bigint")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages)
