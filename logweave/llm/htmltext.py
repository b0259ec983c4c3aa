"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass one decides blocks by link
density, length and stop-word density, and by the container they stand in
(navigation, footer, form and so on against article or main).  Short or middling
blocks stay ambiguous; in pass two they inherit the label of the nearest decided
neighbour, looked for in their own container first.  Inside an article a block of links
is ambiguous too: a list of references has the label of the text around it.

Stop words speak only where they can: if most of a page's long unlinked text has few of
them, the page is in a language that is not listed, and length and links decide.

A hint is a class, role or id that names an advert, a menu, a widget and the like as
a whole word.  It speaks against the blocks of its element up to an article in it,
unless pass one finds long main text among them: then the two passes judge them all.
Hidden elements and readers' comments are left out without that.

Defined cases: null html gives an empty text; a page cut off in the middle of a
tag, comment or script loses that piece only; repeated rows each give a row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import small_batches

MAX_LINK_DENSITY = 0.2
ARTICLE_LINK_DENSITY = 0.5
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.20, 0.30

#: Frequent function words of English, German, French, Spanish.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had
an they which one you were all her she there would their we him been has when who will no if out so
der die das und in zu den ist von mit dem des im für auf ein eine nicht sich auch es an als am nach
wie bei oder aus war wird sind noch er sie aber wenn nur so zum zur über
le la les de des du et en un une que qui dans est pour pas au sur par avec il ne ce se plus son sa
ont aux ses mais ou comme elle nous vous été sont cette
el los las y que del se por con para como más pero sus al lo su no es una sobre este ya entre cuando
todo esta ser son dos también fue había era muy
""".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog
dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li
main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead
tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BAD = frozenset("nav footer aside form menu dialog button select fieldset head template".split())
_HINT = frozenset("""ad ads adv advert advertisement advertising banner sponsor sponsored promo
promoted cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup nav
navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments disqus reply
replies respond share sharing social related recommended recommendations pagination pager login
notice alert toolbar widget complementary contentinfo ad-slot ad-container ad-banner ad-wrapper
cookie-banner cookie-notice cookie-consent main-nav site-nav main-menu nav-menu site-navigation
main-navigation site-footer page-footer site-sidebar sidebar-left sidebar-right left-sidebar
right-sidebar related-posts related-articles share-buttons social-links social-share
newsletter-signup comment-list comments-area comments-section""".split())
_COMMENTS = frozenset("""comment comments disqus reply replies respond comment-list comments-area
comments-section""".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Raw text runs to its end tag or the end of the page.  Other elements without text
#: of the page are left out with their content only if they end.
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
        for name in ("script", "style", "textarea", "title")}
_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STEP = re.compile(r"[>\"']")
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
        for name in ("noscript", "iframe", "xmp", "svg", "template", "object")}
#: Tags that end an svg element which was left open, if it holds no foreign object.
_NOT_SVG = re.compile(r"<(?:p|div|h[1-6]|ul|ol|table|body|nav|article|main|section)(?=[\s/>])", re.I)
_FOREIGN = re.compile(r"<foreignobject(?=[\s/>])", re.I)
_ATTR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s]+))?")
_NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[\u2e80-\U0010ffff]")


def _marks(name: str, attrs: str, in_main: bool) -> tuple[bool, bool]:
    """(hidden or readers' comments, hinted at) of an element by its attributes."""
    if not attrs or attrs.isspace() or name in ("html", "body"):
        return False, False
    out = hint = False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value.strip() == "true" \
                or key == "style" and _NO_DISPLAY.search(value):
            out = True
        elif key in ("class", "role", "itemprop"):
            found = _HINT.intersection(value.replace("_", "-").split())
            hint = hint or bool(found)
            out = out or not _COMMENTS.isdisjoint(found)
        elif key in ("id", "aria-label"):
            # Ids of headings and sections are link targets named after their topic.
            if in_main and (name == "section" or name in _HEADING):
                continue
            value = value.strip().replace("_", "-")
            hint = hint or value in _HINT
            out = out or value in _COMMENTS
    return out, hint


class _Scanner:
    """Tags of a page in order, in time linear in its length: what is not found from one
    place on is not looked for again further on."""

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self._seen: dict = {}

    def _following(self, pattern, at: int) -> tuple[int, int]:
        """The next match at or after ``at``; beyond the page if there is none."""
        span = self._seen.get(pattern, (-1, -1))
        if span[0] < at:
            m = pattern.search(self.page, at)
            span = self._seen[pattern] = m.span() if m else (len(self.page) + 1, at)
        return span

    def _tag_end(self, at: int) -> int:
        """Behind the ``>`` that ends the tag whose name ends at ``at``.  Quoted values may
        hold it; a quote that is never closed counts for nothing."""
        while m := _STEP.search(self.page, at):
            if m[0] == ">":
                return m.end()
            at = m.end()
            if self._seen.get(m[0]) is None:
                close = self.page.find(m[0], at)
                if close < 0:
                    self._seen[m[0]] = True
                else:
                    at = close + 1
        return len(self.page)

    def next(self) -> tuple[str, str, bool, str] | None:
        """(text before it, name, is an end tag, attributes) of the next tag; the name is empty
        for what stands for nothing.  None at the end, with ``at`` behind the last tag."""
        m = _START.search(self.page, self.at)
        if not m:
            return None
        before, name = self.page[self.at:m.start()], (m[2] or "").lower()
        if not name:
            close = "-->" if m[0] == "<!--" else ">"
            end = self.page.find(close, m.end())
            self.at = len(self.page) if end < 0 else end + len(close)
            return before, "", False, ""
        self.at = self._tag_end(m.end())
        attrs = self.page[m.end():self.at].removesuffix(">")
        if m[1]:
            return before, name, True, attrs
        if name in _RAW:
            end = _RAW[name].search(self.page, self.at)
            self.at = end.end() if end else len(self.page)
            return before, "", False, ""
        if name in _END:
            self.at = self._past(name, attrs)
            return before, "", False, ""
        return before, name, False, attrs

    def _past(self, name: str, attrs: str) -> int:
        """Where the element whose tag ends here is over."""
        at = self.at
        if attrs.rstrip().endswith("/"):
            return at
        start, end = self._following(_END[name], at)
        if start > len(self.page) or name == "svg" and self._following(_NOT_SVG, at)[0] < start \
                and self._following(_FOREIGN, at)[0] > start:
            return at
        return end


def blocks(page: str) -> list[tuple[str, int, bool, bool, int, int]]:
    """(text, characters in links, in boilerplate, in article, container, number of
    the hinted element around it or 0)."""
    out: list = []
    stack: list[tuple[str, bool, bool, int, int]] = [("", False, False, 0, 0)]
    text: list[str] = []
    linked: list[str] = []
    depth_a, p_bad, p_hint, serial = 0, False, 0, 0

    def close():
        nonlocal p_bad, p_hint
        t = " ".join(_html.unescape("".join(text)).split())
        if t:
            _, bad, main, box, hint = stack[-1]
            a = " ".join(_html.unescape("".join(linked)).split())
            out.append((t, len(a), bad or p_bad, main, box, p_hint or hint))
        text.clear()
        linked.clear()
        p_bad, p_hint = False, 0

    scan, opened = _Scanner(page), Counter()
    while tag := scan.next():
        piece, name, ends, attrs = tag
        if piece:
            text.append(piece)
            if depth_a:
                linked.append(piece)
        if name == "br":
            text.append(" ")
        if name == "a":
            # A link may hold blocks; it ends with its tag or with the element around it.
            depth_a = 0 if ends else len(stack)
        if name not in _BLOCK:
            continue
        close()
        if ends:
            if opened[name]:
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
                if len(stack) < depth_a:
                    depth_a = 0
            continue
        _, up_bad, up_main, _, up_hint = stack[-1]
        bad, hint = _marks(name, attrs, up_main)
        serial += 1
        if name in ("p", "li", "hr", "dt", "dd", "option") or name[0] == "h" and name[1:].isdigit():
            p_bad, p_hint = bad or name == "option", serial if hint else 0
            continue
        main = up_main or name in ("article", "main")
        bad = up_bad or bad or name in _BAD or name == "header" and not up_main
        if name in ("article", "main"):
            bad, hint, up_hint = up_bad, False, 0
        if not attrs.rstrip().endswith("/"):
            opened[name] += 1
            stack.append((name, bad, main, serial, serial if hint else up_hint))
    rest = page[scan.at:]
    if rest:
        text.append(rest.split("<", 1)[0] if re.match(r"[^<]*<[a-zA-Z/!]?[^>]*\Z", rest) else rest)
    close()
    return out


def _width(text: str) -> int:
    """Characters, those of scripts that pack more into one (from U+2E80 on) twice."""
    return len(text) if text.isascii() else len(text) + len(_WIDE.findall(text))


def _stops(text: str) -> float:
    ws = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in ws) / max(1, len(ws))


def stop_shares(found: list) -> list[float | None]:
    """Share of stop words of the blocks that it can decide, None for the others; None
    for all if stop words cannot judge the page, that is if most of its long text without
    links has few of them."""
    out: list[float | None] = []
    few = many = 0
    for text, n_link, bad, main, _, _ in found:
        n = _width(text)
        out.append(None if bad or n < SHORT or n_link > ARTICLE_LINK_DENSITY * len(text) else _stops(text))
        if out[-1] is not None and n >= LONG and n_link <= MAX_LINK_DENSITY * len(text):
            if out[-1] < STOP_LOW:
                few += n
            else:
                many += n
    return out if many >= few else [None] * len(found)


def first_pass(block, stop: float | None) -> bool | None:
    """True main text, False boilerplate, None ambiguous; hints left aside.  ``stop`` is the
    block's share of stop words, None if they cannot judge it."""
    text, n_link, bad, main, _, _ = block
    n = _width(text)
    if bad or text.lstrip()[:1] == "©" and n < SHORT:
        return False
    density = n_link / len(text)
    if density > (ARTICLE_LINK_DENSITY if main else MAX_LINK_DENSITY):
        return None if main else False
    if n < SHORT:
        return None
    if main and n >= LONG:
        return True
    if stop is None:
        return True if main or n >= LONG else None
    return True if stop >= (STOP_LOW if main or n >= LONG else STOP_HIGH) else None


def hinted_pass(found: list, labels: list[bool | None]) -> list[bool | None]:
    """The labels with the blocks of a hinted element as boilerplate, unless a long
    one among them is main text."""
    told = {b[5] for b, x in zip(found, labels) if x and len(b[0]) >= LONG}
    return [False if b[5] and b[5] not in told else x for b, x in zip(found, labels)]


def nearest_label(groups: list[int], labels: list[bool | None]) -> list[bool | None]:
    """Per block the label of the nearest decided block of its group (None without
    one); a tie goes to the following block."""
    n = len(labels)
    near: list[int | None] = [None] * n
    last: dict[int, int] = {}
    for i in range(n - 1, -1, -1):
        if labels[i] is not None:
            last[groups[i]] = i
        near[i] = last.get(groups[i])
    last.clear()
    for i in range(n):
        if labels[i] is not None:
            last[groups[i]] = i
        before = last.get(groups[i])
        if before is not None and (near[i] is None or i - before < near[i] - i):
            near[i] = before
    return [None if j is None else labels[j] for j in near]


def second_pass(found: list, labels: list[bool | None]) -> list[bool]:
    """Ambiguous blocks inherit from the nearest decided neighbour, of their own
    container if it has one.  A container without decided blocks takes its kind
    (article or not), otherwise the page."""
    own = nearest_label([b[4] for b in found], labels)
    page = nearest_label([0] * len(found), labels)

    def inherited(i: int) -> bool:
        if own[i] is not None:
            return own[i]
        return found[i][3] or page[i] is not False

    return [inherited(i) if x is None else x for i, x in enumerate(labels)]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    labels = [first_pass(b, stop) for b, stop in zip(found, stop_shares(found))]
    kept = second_pass(found, hinted_pass(found, labels))
    return "\n".join(b[0] for b, k in zip(found, kept) if k)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """page_id, url, text; one row per input row."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [main_text(h) for h in pdf["html"]]
            yield pdf[["page_id", "url", "text"]]

    t = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.col(html_col).alias("html"))
    kinds = t.schema
    return t.mapInPandas(run, f"page_id {kinds['page_id'].dataType.simpleString()}, "
                              f"url {kinds['url'].dataType.simpleString()}, text string")
