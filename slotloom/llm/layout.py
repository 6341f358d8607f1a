"""Leaf blocks of a web page, and invented pages to learn from.

A *leaf* is the text between two starts or ends of block elements, with the chain of elements above it. Tags may
be unclosed, misplaced, in any case and cut off at the end of the page. What is no text is left out: scripts, styles, templates, comments,
declarations, and the page's title in its head. Character references are decoded; white space within a leaf becomes one space.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from functools import lru_cache

import numpy as np

# Fixed values of HTML: elements that part blocks, that have no end, whose content is no text or raw text, and that a start ends.
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("iframe noembed noframes script style svg math template title object audio video canvas".split())
ENDS = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": ("option", ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_STAYS = ("button", "label", "caption", "noscript")  # these may stand inside a paragraph
_SCOPE = frozenset("td th table button html body article section div aside main".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"<]*\"|'[^'<]*')|[^>=]|=)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none", re.I)
_NAME = re.compile(r"[a-z]+")

PATHS = 1024
# A path names so many outermost and innermost elements; only where more are open are those between them left out of it.
OUTER, INNER = 8, 24


@lru_cache(maxsize=8192)
def element(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    found = [tag]
    if attributes:
        for _, value in _ATTRIBUTE.findall(attributes):
            found += ["." + w for w in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())]
        if _HIDDEN.search(attributes):
            found.append(".hidden")
    return tuple(dict.fromkeys(found))


@lru_cache(maxsize=8192)
def codes(names: tuple[str, ...]) -> np.ndarray:
    return np.array(sorted({zlib.crc32(n.encode()) % PATHS for n in names}), np.int64)


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)


def leaves(page: str):
    """(path, text, share of linked characters) of each leaf that holds text; a path is a tuple of ``element`` tuples."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_: dict[str, int] = {}
    texts: list[str] = []
    linked = at = 0

    def flush():
        nonlocal linked, texts
        raw = texts[0] if len(texts) == 1 else "".join(texts)
        text = " ".join(raw.split())
        above = stack if len(stack) <= OUTER + INNER else stack[:OUTER] + stack[-INNER:]
        found = (tuple([e for _, e in above if e[0] in BLOCK or len(e) > 1]), text, min(1.0, linked / len(raw))) if text else None
        texts, linked = [], 0
        return found

    def pop(until):
        while stack:
            name = stack.pop()[0]
            open_[name] -= 1
            if name == until:
                break

    def end_within(names, scope):
        """Ends the innermost of some elements, unless an element of the scope is nearer."""
        names = (names,) if isinstance(names, str) else names
        if any(open_.get(n) for n in names):
            for name, _ in reversed(stack):
                if name in names:
                    pop(name)
                    return
                if name in scope:
                    return

    search = _TAG.search
    while at <= len(page):
        match = search(page, at)
        text = page[at:match.start() if match else len(page)]
        if text:
            text = html.unescape(text) if "&" in text else text
            texts.append(text)
            if open_.get("a"):
                linked += len(text)
        if match is None:
            break
        at = match.end()
        closing, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SILENT and not closing:
            end = _end_of(tag).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style", "title", "iframe", "template"):
                at = len(page)
            texts.append(" " if tag in ("iframe", "svg", "video", "audio", "object", "canvas") else "")
            continue
        if tag == "br":
            texts.append(" ")
            continue
        if tag in BLOCK:
            found = texts and flush()
            if found:
                yield found
        if closing:
            if tag in HEADINGS:
                end_within(HEADINGS, ())  # whichever is open
            elif open_.get(tag):
                pop(tag)
            continue
        if open_.get("p") and tag in BLOCK and tag not in _STAYS:
            end_within("p", _SCOPE)
        if tag in ENDS:
            end_within(*ENDS[tag])
            if tag == "tr":
                end_within("tr", ("table",))
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((tag, element(tag, attributes.strip())))
            open_[tag] = open_.get(tag, 0) + 1
    found = flush()
    if found:
        yield found


# --- invented pages -------------------------------------------------------------------------------------------------

MARK = "\ue000"  # stands before each block of the article in an invented page
_SYLLABLES = "an ba ce di en fo ga he in jo ka le ma ne on pa que re si ta un ve wa xi yo za tion er est th ou eau ció ñas über sch ß".split()
_SHORT = ("Home About Contact Login Search Next Menu Share Print More Subscribe Privacy Terms Cookies Accept Reply Startseite Suche Kontakt "
          "Impressum Accueil Recherche Inicio Buscar Contacto Copyright Tags Archive Related Sponsored Advertisement Comments").split()
_NAMES = {
    "nav": "nav menu navigation navbar topnav breadcrumb breadcrumbs pagination toc tabs".split(),
    "header": "header masthead banner top logo branding site-header".split(),
    "footer": "footer bottom site-footer copyright colophon legal".split(),
    "aside": "sidebar aside widget related rail secondary trending recommended newsletter".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad sponsor adsbox".split(),
    "notice": "notice cookie cookie-banner consent alert message popup modal overlay gdpr".split(),
    "comments": "comments comment-list responses discussion replies respond disqus".split(),
    "share": "share social sharing toolbar meta byline tags author-box".split(),
    "form": "form search subscribe login signup contact-form".split(),
    "main": "content article post entry story main-content article-body post-content text body-text page-content".split(),
}


def invented(rng: random.Random) -> str:
    """A page of some layout; blocks of its article start with ``MARK``."""
    pick, draw = rng.choice, rng.randrange
    chance = lambda p: rng.random() < p

    def word() -> str:
        text = "".join(pick(_SYLLABLES) for _ in range(draw(1, 5)))
        return text + pick(["###", "%%%", "&amp;", "***"]) if junk else text

    def prose(low: int, high: int) -> str:
        n = draw(low, high + 1)
        text = " ".join(pick(_SHORT) if chance(0.06) else word() for _ in range(n))
        return text[:1].upper() + text[1:] + pick([".", ".", ".", "!", ""])

    def few() -> str:
        return " ".join(pick(_SHORT) if chance(0.4) else word() for _ in range(draw(1, 4)))

    def named(kind: str, tag: str = "div") -> tuple[str, str]:
        """Start and end of a container of a kind: by its own tag, or by a class or id."""
        own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        name = f' {pick(["class", "class", "id"])}="{pick(_NAMES[kind])}"'
        if own and chance(0.65):
            return f"<{own}{name if chance(0.3) else ''}>", f"</{own}>"
        tag = pick([tag, tag, "section", "ul" if kind == "nav" else "div"])
        return f"<{tag}{name}>", f"</{tag}>"

    def wrap(kind: str, inner: str) -> str:
        begin, end = named(kind)
        return begin + inner + end

    def links() -> str:
        n = draw(2, 9)
        each = [f'<a href="/{word()}">{few()}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{e}</li>" for e in each) + "</ul>" if chance(0.7) else pick([" | ", " ", "<br>"]).join(each)

    def fields() -> str:
        return f'<label>{few()}</label><input name="q"><select><option>{few()}<option>{few()}</select><button>{few()}</button>' + (f"<p>{prose(3, 20)}</p>" if chance(0.4) else "")

    def boiler(kind: str) -> str:
        if kind == "nav":
            return wrap(kind, links())
        if kind == "header":
            return wrap(kind, pick([f"<h1>{few()}</h1>", f"<div>{few()}</div>", f"<a href='/'>{few()}</a>"]) + (f"<p>{prose(2, 12)}</p>" if chance(0.5) else "") + (
                boiler("nav") if chance(0.3) else ""))
        if kind == "footer":
            return wrap(kind, pick([f"&copy; {few()} &middot; {prose(2, 25)}", f"<p>&copy; {prose(2, 25)}</p>", links()]) + (links() if chance(0.3) else ""))
        if kind == "form":
            return wrap(kind, fields())
        if kind == "comments":
            each = "".join(f'<{t} class="comment"><b>{few()}</b><p>{prose(2, 60)}</p></{t}>' if chance(0.6) else f"<p>{prose(2, 60)}</p>"
                           for t in ["div", pick(["div", "li", "article"])] * draw(1, 3))
            return wrap(kind, (f"<h3>{few()}</h3>" if chance(0.7) else "") + each + (boiler("form") if chance(0.3) else ""))
        if kind in ("aside", "share"):
            return wrap(kind, (f"<h{pick('234')}>{few()}</h3>" if chance(0.5) else "") + pick([links(), f"<p>{prose(3, 40)}</p>", f"{few()}"]))
        return wrap(kind, pick([prose(2, 40), f"<p>{prose(2, 60)}</p>", f"<p>{prose(2, 12)}</p><button>{few()}</button>", f'<a href="/{word()}">{prose(2, 10)}</a>']))

    def paragraph() -> str:
        text = prose(1, pick([2, 6, 25, 120, 250]))
        kind = rng.random()
        if kind < 0.14:
            return f"<p><b>{MARK}{text}<br>"  # unclosed
        if kind < 0.20:
            return f"<h{pick('234')}>{MARK}{prose(1, 9)}</h{pick('234')}>"
        if kind < 0.26:
            return "<ul>" + "".join(f"<li>{MARK}{prose(1, 20)}</li>" for _ in range(draw(1, 6))) + "</ul>"
        if kind < 0.30:
            return f"<blockquote><p>{MARK}{text}</p></blockquote>"
        if kind < 0.33:
            return "<table>" + "".join(f"<tr><td>{MARK}{word()}<td>{MARK}{prose(1, 5)}</tr>" for _ in range(draw(1, 4))) + "</table>"
        if kind < 0.36:
            return f"<figure><img src='x'><figcaption>{MARK}{prose(1, 14)}</figcaption></figure>"
        if kind < 0.46:
            half = len(text) // 2
            return f'<p>{MARK}{text[:half]} <a href="/{word()}">{few()}</a> <em>{text[half:]}</em></p>'
        if kind < 0.49:
            return f"<div>{MARK}{text}</div>"
        return f"<p>{MARK}{text}</p>"

    junk = chance(0.15)
    title = prose(2, 12)
    inner = [f"<h1>{MARK}{title}</h1>"] if chance(0.85) else []
    for _ in range(draw(1, pick([3, 8, 16]))):
        inner.append(paragraph())
        if chance(0.06):
            inner.append(boiler(pick(["ad", "share", "aside", "form", "nav", "notice"])))
    main = "".join(inner)
    if chance(0.65):
        main = f"<article{pick(['', '', ' class=post', ' id=story'])}>{main}</article>"
    elif chance(0.4):
        main = f"<main>{main}</main>"
    else:
        main = f'<div {pick(["class", "id"])}="{pick(_NAMES["main"])}">{main}</div>'
    if chance(0.25):
        main = pick(["<main>", "<div id=main>", "<div class=container>", "<section>"]) + main
    before = [boiler(k) for k in ("header", "nav", "notice", "ad", "form", "aside") if chance({"nav": 0.8, "header": 0.4, "ad": 0.4}.get(k, 0.2))]
    after = [boiler(k) for k in ("share", "comments", "aside", "ad", "nav", "form", "notice", "footer") if chance({"footer": 0.85, "comments": 0.35}.get(k, 0.2))]
    if chance(0.3):
        rng.shuffle(before)
    page = (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head><body>"
            + "".join(before) + "<!-- x -->" + main + "".join(after))
    return page + ("</body></html>" if chance(0.8) else "")
