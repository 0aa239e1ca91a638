"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element. Text that cannot be the article (menus, forms, adverts,
scripts and the like, by element or by the words of its class, id or role; link lists by their share of link
text) counts as length 0. The lengths are summed over sliding windows of lines that have text or stand for something left
out; the sums surge where running text begins and dive where it ends, or where a marked article does. The stretches
between that rise high enough are the text, by the same thresholds within a marked article and outside. The more of a
page's text its articles hold, the less a line outside of them weighs.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from riskloom.llm.common import per_text

WINDOW = 3
#: A stretch is kept if one of its windows reaches this many characters, or this share of the page's highest.
ENOUGH, SHARE = 80, 0.5
LINK_SHARE = 0.6

#: Fixed element lists.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BOILERPLATE = frozenset(
    "nav header footer aside form button select option menu dialog noscript template svg canvas object audio video figcaption".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
#: Boilerplate elements that a page may be wrapped in as a whole.
WRAPPERS = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies copyright "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget "
    "complementary contentinfo alert".split()
)
#: Marks of a block in which an <article> is one of the comments.
REPLIES = frozenset("comment comments disqus replies reply respond".split())
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_BOUND = re.compile(r"[>\"']")
_HEADING = re.compile(r"<h1[\s>]|</header", re.I)
_SPACES = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


class Tags:
    """The tags and comments of a page from left to right, in time in proportion to its length.

    A ``>`` within a quoted value does not end a tag. From a tag on whose quotes reach the end of the page, quotes are plain.
    """

    def __init__(self, html: str):
        self.html, self.quotes = html, True

    def after(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name ('' for comments and the like), whether it closes, and attributes of the next one."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            follows = html[start + 1 : start + 2]
            if follows and follows in "!?":
                mark = "-->" if html.startswith("<!--", start) else ">"
                end = html.find(mark, start + 2)
                return start, end + len(mark) if end >= 0 else len(html), "", False, ""
            name = _NAME.match(html, start + 1)
            if name:
                end = self._end(name.end())
                if end < 0:
                    return None  # no tag ends any more
                return start, end, name[2].lower(), bool(name[1]), html[name.end() : end - 1]
            at = start + 1
        return None

    def _end(self, begin: int) -> int:
        html, at = self.html, begin
        while self.quotes:
            bound = _BOUND.search(html, at)
            if bound and bound[0] == ">":
                return bound.end()
            if not bound:
                self.quotes = False
                break
            before = bound.start() - 1
            while before >= begin and html[before].isspace():
                before -= 1
            at = bound.end()
            if before >= begin and html[before] == "=":
                closing = html.find(bound[0], at)
                if closing < 0:
                    self.quotes = False
                at = closing + 1
        return html.find(">", begin) + 1 or -1


def marked(attributes: str, marks: frozenset[str] = MARKS, first: bool = False, whole: bool = False) -> bool:
    """Whether class, id or role name something other than the article; camelCase counts as words. With `first` only the
    first word of a name counts, with `whole` only names that are such a word."""
    for groups in _ATTRIBUTE.findall(attributes):
        value = "".join(groups)
        if whole:
            if not marks.isdisjoint(value.lower().split()):
                return True
            continue
        value = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value)
        for one in value.lower().split():
            words = _WORDS.findall(one)
            if words and words[0] not in ("has", "with", "no", "without") and not marks.isdisjoint(words[:1] if first else words):
                return True
    return False


def lines_of(html: str, by_class: bool = True, left_out: frozenset[str] = BOILERPLATE) -> list[tuple[str, int, bool]]:
    """(text, length to count, within a marked article) of each block with text in page order; no text: left out."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    links: list[str] = []
    article = link = listed = n_links = 0
    headings = True  # whether an <h1> or the end of a header may still come
    tags = Tags(html)
    skip, depth, wrapper = "", 0, False  # the element that is being left out, its nesting, whether an article may be in it
    at = 0

    def flush() -> None:
        nonlocal n_links
        line = _SPACES.sub(" ", unescape("".join(text))).strip()
        linked = len(_SPACES.sub(" ", unescape("".join(links))).strip())
        if line:
            # within an article one link may be a paragraph; a list of links is a menu there, too
            menu = linked > LINK_SHARE * len(line) and (not article or listed > 0 or n_links > 1)
            out.append((line, 0 if menu else len(line), article > 0))
        text.clear()
        links.clear()
        n_links = link

    def take(piece: str) -> None:
        if piece and not skip:
            text.append(piece)
            if link:
                links.append(piece)

    while token := tags.after(at):
        start, end, name, closing, attributes = token
        take(html[at:start])
        at = end
        if not name:
            continue
        if not closing and name in RAW:
            closed = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = closed.end() if closed else len(html)
            take(" ")
            continue
        if skip:
            if wrapper and not closing and name in ("article", "main"):
                skip = ""  # a wrapper, not a part
            elif name == skip:
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
                    out.append(("", 0, article > 0))
                continue
            else:
                continue
        if name in BLOCKS:
            flush()
        elif name in VOID:
            take(" ")
        if name in ("ul", "ol", "dl"):
            listed = max(0, listed + (-1 if closing else 1))
        if name == "article" and not closing and by_class and marked(attributes, first=True):
            skip, depth, wrapper = name, 1, False
        elif name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        elif name == "a":
            link = max(0, link + (-1 if closing else 1))
            n_links += not closing
        if not closing and name not in VOID and name not in ("html", "body", "article", "main"):
            by_tag = name in left_out
            if by_tag and name == "header" and article and headings:
                heading = _HEADING.search(html, at)
                headings = heading is not None
                by_tag = not heading or heading[0].startswith("</")  # the article's own title stays
            if by_tag or (by_class and marked(attributes, whole=article > 0)):
                if name in BLOCKS or text:
                    flush()
                skip, depth, wrapper = name, 1, not by_tag and not marked(attributes, REPLIES)
    tail = html[at:]
    cut = tail.rfind("<")
    take(tail if cut < 0 or not re.match(r"<[/a-zA-Z!?]", tail[cut:]) else tail[:cut])  # a tag that the page's end cuts
    flush()
    return out


def extract(html: str | None) -> str:
    """The main text: its blocks in page order, joined by line ends; empty for null, empty and textless pages."""
    if not html:
        return ""
    lines = lines_of(html)
    if not any(n for _, n, _ in lines):  # a class that the whole page bears tells nothing
        lines = lines_of(html, by_class=False)
    if not any(n for _, n, _ in lines):  # nor does an element around it
        lines = lines_of(html, by_class=False, left_out=BOILERPLATE - WRAPPERS)
    within = sum(n for _, n, inside in lines if inside)
    weight = 1 - within / max(1, sum(n for _, n, _ in lines))
    size = [n if inside else n * weight for _, n, inside in lines]
    stretches: list[list] = []
    for i, n in enumerate(size):
        if not n:
            continue
        if not stretches or i - stretches[-1][1] >= WINDOW or lines[i][2] != lines[stretches[-1][0]][2]:
            stretches.append([i, i, 0])  # surge
        stretches[-1][1] = i  # moves on to the dive
    for s in stretches:
        s[2] = max(sum(size[i : min(i + WINDOW, s[1] + 1)]) for i in range(s[0], s[1] + 1))
    highest = max((s[2] for s in stretches), default=0)
    kept = [s[2] >= min(ENOUGH, SHARE * highest) for s in stretches]
    long = [k for k, ok in enumerate(kept) if ok]
    for k in range(long[0], long[-1]) if long else ():  # short blocks of an article, between its long ones
        kept[k] = kept[k] or lines[stretches[k][0]][2]
    return "\n".join(
        lines[i][0] for (first, last, _), ok in zip(stretches, kept, strict=True) if ok for i in range(first, last + 1) if size[i]
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, from its whole html.

    Equal rows give equal rows; a null url stays null; other columns are not read.
    """

    def work(page_ids: list, urls: list, htmls: list) -> dict:
        texts = [extract(h) for h in htmls]
        return {"page_id": page_ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}

    return per_text(pages, ["page_id", "url", "html"], "page_id long, url string, text string, n_chars long", work)
