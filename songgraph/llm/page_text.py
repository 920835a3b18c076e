"""Main text of web pages by line-block distribution.

Markup is stripped so that every block-level element gives one line. Lines of page
furniture (menus, footers, forms, adverts, notices, reader comments; told by element or
class name) and lines outside the article element, where the page has one, keep their
place but count no text. The text lengths of sliding windows of lines then show the
main text: a window that reaches the threshold, a paragraph's worth of text that is not link
text, is a surge, an empty window after it a dive, and all lines between the two are kept.
An article element is a stretch without a dive, whatever furniture lies in it, so a surge in
it keeps all its lines; without a surge it stays unless most of its text is links (a list of
teasers). If no article element stays and the rest of the page has a surge, that is the main
text. Outside article elements adverts, notices and the like do not part the text, and
short lines of text after a surge belong to it up to the page's footer.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from songgraph.llm.common import map_rows

WINDOW = 3          # lines of a block window
SURGE = 60          # characters in a window that begin main text

# Elements and class words of page furniture.
RAW = "script style noscript template iframe svg textarea title select object canvas video audio"
FURNITURE = "head nav footer aside form menu dialog button fieldset"
INLINE = ("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
          "ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr img "
          "math mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder semantics")
VOID = "area base br col embed hr img input link meta param source track wbr"
CLASS_WORDS = (
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion "
    "banner sidebar comment comments commentlist disqus reply replies cookie cookies consent gdpr "
    "notice notices newsletter subscribe subscription signup share sharing social related recommended "
    "breadcrumb breadcrumbs menu nav navbar navigation toc footer header masthead popup modal overlay "
    "pagination pager login search widget complementary contentinfo alert paywall tags")

# Words that furniture names are made up with, beside the ones above.
PART_WORDS = (
    "area bar block bottom box btn button buttons btns card cards col container count feed form global grid group icon "
    "icons inner inline item items js label left link links list media meta mobile module outer panel posts rail right "
    "row section slot stories sticky sub thread tool toolbar tools top unit wrap wrapper zone")
HEADINGS = "h1 h2 h3 h4 h5 h6 hgroup"
# Elements whose end tag may be left out, and what ends them then besides their own next start.
UNCLOSED = {
    "p": "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
         "menu nav ol pre section table ul",
    "li": "", "dt": "dd", "dd": "dt", "tr": "tbody tfoot thead", "td": "th tr tbody tfoot", "th": "td tr tbody tfoot",
    "option": "optgroup"}

_RAW, _FURNITURE, _INLINE = (frozenset(x.split()) for x in (RAW, FURNITURE, INLINE))
# Furniture that bounds the main text, and what of it ends the page.
_BOUNDS = frozenset("head nav header footer menu masthead navbar navigation contentinfo".split())
_ENDS = frozenset(("footer", "contentinfo"))
_VOID, _CLASS = frozenset(VOID.split()), frozenset(CLASS_WORDS.split())
_PART, _HEADINGS = frozenset(PART_WORDS.split()), frozenset(HEADINGS.split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true""", re.I)


def _is_furniture(tag: str, attrs: str, inside: bool) -> bool:
    if tag in _FURNITURE or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attrs):
        return True
    if inside and (tag in _INLINE or tag in _HEADINGS):     # a word of a sentence, a heading
        return False
    for m in _NAMES.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = {w for w in re.split(r"[^a-z]+", name) if w}
            hit = words & _CLASS
            if re.search(r"[a-z][-_](page|site|app|root)$", name):      # round a whole page
                continue
            # inside the article a name counts only if it is furniture as a whole: an ad slot
            # or a share bar, not a section on search algorithms or related work
            if hit and not inside or hit and words <= _CLASS | _PART and not hit <= {"header"}:
                return True
    return False


def _mark(tag: str, attrs: str) -> int:
    """-3 for a footer, -2 for other furniture that bounds the main text, -1 for the rest."""
    names = {tag}.union(*(re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower())
                          for m in _NAMES.finditer(attrs)))
    return -3 if names & _ENDS else -2 if names & _BOUNDS else -1


def lines(page: str) -> list[tuple[str, int, int]]:
    """(text, characters, characters in links) of each line; furniture is one line with
    an empty text and a negative count (``_mark``) in the second place. There lines outside the
    article elements have 0, others the number of their element (from 1; one in another counts
    as part of it)."""
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    state = {"article": 0, "number": 0, "link": 0, "links": 0}

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, state["number"] if state["article"] else 0, min(state["links"], len(text))))
            parts.clear()
        state["links"] = 0

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt > at:
            data = page[at:] if lt < 0 else page[at:lt]
            parts.append(data)
            if state["link"]:
                state["links"] += len(data)
        if lt < 0:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            after = page[lt + 1:lt + 2]
            if after and (after in "!?" or after == "/"):
                end = page.find(">", lt)
                at = size if end < 0 else end + 1
            elif after.isalpha() and after.isascii():       # a tag cut off by the page's end
                at = size
            else:
                parts.append("<")
                at = lt + 1
            continue
        close, tag, attrs, at = m[1], m[2].lower(), m[3], m.end()
        if tag in _INLINE:
            if tag == "a":
                state["link"] = 0 if close else 1
            if close or not _is_furniture(tag, attrs, state["article"] > 0):
                continue
            skip = tag not in _VOID
        elif close:
            flush()
            if tag in ("article", "main") and state["article"]:
                state["article"] -= 1
            state["link"] = 0
            continue
        else:
            flush()
            if tag in _RAW:
                end = re.compile(r"</" + tag + r"\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else (size if not attrs.endswith("/") else at)
                continue
            skip = tag not in _VOID and not attrs.rstrip().endswith("/") \
                and _is_furniture(tag, attrs, state["article"] > 0)
            if not skip and tag in ("article", "main"):
                state["number"] += not state["article"]
                state["article"] += 1
        if skip:
            at = _past(page, at, tag)
            if tag not in _INLINE:
                out.append(("", _mark(tag, attrs), 0))
    flush()
    return out


def _past(page: str, at: int, tag: str) -> int:
    """The end of the element that has just been opened (the page's end if it never
    closes; comments and raw text inside it are passed over as they are). An element whose
    end tag may be left out ends where HTML ends it: before the next of its kind at its own
    depth, before what cannot be in it, or with the element round it."""
    if tag in UNCLOSED:
        return _past_unclosed(page, at, tag)
    depth = 1
    for m in re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)" + tag
                        + r"(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.S).finditer(page, at):
        if m[2] is None or m[1]:
            continue
        depth += -1 if m[2] else 1
        if not depth:
            return m.end()
    return len(page)


_ANY = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)", re.I | re.S)


def _past_unclosed(page: str, at: int, tag: str) -> int:
    enders, inner = {tag, *UNCLOSED[tag].split()}, []
    for m in _ANY.finditer(page, at):
        if m[3] is None:
            continue
        name = m[3].lower()
        if name in _INLINE or name in _VOID and name != "hr":
            continue
        if m[2]:
            if name == tag and not inner:
                return m.end()
            if name in inner:
                while inner.pop() != name:
                    pass
            elif name not in UNCLOSED:          # the element round it closes
                return m.start()
        elif not inner and name in enders:
            return m.start()
        elif name not in UNCLOSED and name != "hr":
            inner.append(name)
    return len(page)


def _blocks(length: list[int]) -> list[int]:
    return [sum(length[i:i + WINDOW]) for i in range(len(length))]


def main_text(page: str | None) -> str:
    """The main text; empty for a null page or one without text."""
    rows = lines(page or "")
    inside: dict[int, list[tuple[int, int]]] = {}
    rest: list[int] = []
    for text, mark, links in rows:
        if mark > 0:
            inside.setdefault(mark, []).append((len(text), links))
        if mark != -1:                              # adverts and notices do not part the text
            rest += [0] * WINDOW if mark else [len(text) - links]
    if not inside:
        return _loose_text(rows)
    kept = {mark for mark, part in inside.items()
            if max(_blocks([size - links for size, links in part])) >= SURGE
            or 2 * sum(links for _, links in part) <= sum(size for size, _ in part)}
    if not kept and max(_blocks(rest), default=0) >= SURGE:
        return _loose_text([("", -2, 0) if r[1] > 0 else r for r in rows])
    return " ".join(text for text, mark, _ in rows if mark > 0 and (mark in kept or not kept))


def _loose_text(rows: list[tuple[str, int, int]]) -> str:
    """The main text of a page without an article element."""
    rows = [r for r in rows if r[1] != -1]          # adverts and notices do not part the text
    length: list[int] = []
    text: list[str] = []
    ends: list[int] = []
    for t, inside, links in rows:
        if inside < 0:
            if inside == -3:
                ends.append(len(length))
            length += [0] * WINDOW
            text += [""] * WINDOW
        else:
            length.append(len(t) - links)
            text.append(t)
    surges = [i for i, b in enumerate(_blocks(length)) if b >= SURGE]
    if not surges:                                          # the longest run
        run, best, start = 0, (0, 0, 0), 0
        for j, n in enumerate([*length, 0]):
            run, start = (run + n, start) if n else (0, j + 1)
            best = max(best, (run, -start, j + 1))
        return " ".join(t for t in text[-best[1]:best[2]] if t) if any(length) else ""
    start = surges[0]
    while length[start] <= 0:                               # the window began before the text
        start += 1
    while start and length[start - 1] > 0:                  # back over the surge's slope
        start -= 1
    last = max(i for i in range(surges[-1], min(surges[-1] + WINDOW, len(length))) if length[i] > 0)
    stop = min((e for e in ends if e > last), default=len(length))
    kept, i = [], start
    while i < stop:
        if length[i] > 0:
            kept.append(text[i])
            i += 1
            continue
        end = i
        while end < stop and length[end] <= 0:
            end += 1
        if end - i < WINDOW:                                # more lines of links only are a list of links
            kept += [t for t in text[i:end] if t]
        i = end
    return " ".join(kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per input row: key, url, text, n_chars (code points).

    A null or empty page gives an empty text; null keys and urls stay null; repeated
    rows are extracted each on its own; other columns are ignored."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(cols):
        texts = [main_text(h) for h in cols[page]]
        return {key: cols[key], url: cols[url], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_rows(pages.select(key, url, page), run,
                    f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long")
