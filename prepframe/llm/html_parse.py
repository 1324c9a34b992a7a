"""Pages as blocks of text with the path of elements that each stands in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold main text.
ASIDE = frozenset(
    "head title nav header footer aside script style noscript template iframe button select textarea option menu dialog search "
    "object svg canvas audio video map xmp noembed noframes".split()
)
#: Parts of class, id and role values that mark what isn't main text.
MARKS = frozenset(
    "nav navigation navbar menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside complementary contentinfo ad ads advert "
    "adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice alert newsletter subscribe "
    "signup social share sharing related recommended comment comments respond replies disqus popup modal overlay widget search login form".split()
)
#: Marks that are never part of a layout's name.
FIRM = frozenset("comment comments respond replies disqus related recommended sponsor sponsored advert adverts advertisement".split())
#: Elements that are main text by what they are, and those that show that a marked element is more than what its mark says.
MAINS = frozenset(("article", "main"))
TELLING = frozenset("article main h1 h2 p".split())
#: Part of a page's text that a marked wrapper must hold to be no menu, sidebar or form but the page's layout.
WRAPPED = 0.6
#: Elements that a new paragraph or block closes, and those that hold it.
HOLDERS = frozenset("html body article aside main section div nav header footer form td th li dd blockquote table ul ol dl figure".split())

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>?|[^<]++|<", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Element:
    """An element of the page: its name with class and id, its path's key, and what its ancestors say."""

    name: str
    key: str
    aside: bool
    main: bool
    above: Element | None
    #: What its own name and marks say: 0 nothing, 1 that it is none of the main text or names a layout, 2 the former.
    says: int
    held: int = 0
    telling: bool = False


@dataclass
class Block:
    path: tuple[Element, ...]
    text: str


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _element(name: str, more: str, above: Element | None) -> Element:
    said = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(more)} if more else {}
    label = name + "".join(f"{sign}{said[k]}" for k, sign in (("class", "."), ("id", "#"), ("role", "@")) if said.get(k))
    main = (above.main if above else False) or name in ("article", "main") or said.get("role") == "main"
    marks = {w for v in said.values() for w in _WORD.findall(v)}
    if main:  # its own head belongs to an article
        marks.discard("header")
    says = 0
    if name in ASIDE and not (main and name == "header"):
        says = 2
    elif name not in ("html", "body", "article", "main") and not marks.isdisjoint(MARKS):
        whole = {token for v in said.values() for token in v.split()}
        says = 2 if not whole.isdisjoint(MARKS) or not marks.isdisjoint(FIRM) else 1
    elif name == "form":
        says = 1
    aside = (above.aside if above else False) or says > 0
    return Element(name, f"{above.key}/{label}" if above else label, aside, main, above, says)


def _free_wrappers(page: Page, made: list[Element]) -> None:
    """Let marks go that stand on the layout rather than on a part of it.

    A mark that is part of a longer name (`has-sidebar`), or a form, says nothing of an element that holds headings or
    paragraphs and most of the page's text, firm asides not counted. An article whose wrappers alone are marked is main
    text where the page has none beside it.
    """
    firm: dict[int, bool] = {}
    for e in made:  # those above come first
        firm[id(e)] = e.says == 2 or (e.above is not None and firm[id(e.above)])
        e.telling = e.telling or e.name in TELLING
    for e in reversed(made):
        if e.telling and e.above is not None and not firm[id(e)]:
            e.above.telling = True
    total = 0
    for b in page.blocks:
        if b.path and not firm[id(b.path[-1])]:
            total += len(b.text)
            for e in b.path:
                e.held += len(b.text)
    for e in made:
        own = e.says == 2 or e.says == 1 and not (e.telling and e.held >= WRAPPED * total)
        e.aside = own or (e.above is not None and e.above.aside)
    if any(b.path and b.path[-1].main and not b.path[-1].aside for b in page.blocks):
        return
    if (best := max((e for e in made if e.name in MAINS and not firm[id(e)]), key=lambda e: e.held, default=None)) is None or not best.held:
        return
    inside = {id(best)}
    for e in made:
        if e is best:
            e.aside = False
        elif e.above is not None and id(e.above) in inside:
            inside.add(id(e))
            e.aside = e.says > 0 or e.above.aside


def parse(page: str | None) -> Page:
    """Blocks in page order. Character references are decoded, white space runs are one space, empty blocks left out."""
    out = Page()
    stack: list[Element] = []
    made: list[Element] = []
    text: list[str] = []

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                out.blocks.append(Block(tuple(stack), " ".join(words)))

    def close(to: int) -> None:
        del stack[to:]

    page = page or ""
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0][0] != "<" or m[0] == "<":
                text.append(m[0])
            continue
        name = name.lower()
        block = name in BLOCKS or name in RAW
        if m["end"]:
            if block:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    close(i)
                    break
                if not block and stack[i].name in BLOCKS:  # an inline end doesn't reach beyond its block
                    break
            continue
        if block:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == "p" or stack[i].name == name and name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                    close(i)
                    break
                if stack[i].name in HOLDERS and stack[i].name != name:
                    break
                if stack[i].name == name and name in HOLDERS:
                    break
        if name == "br":
            text.append(" ")
        if name in VOID:
            continue
        element = _element(name, m["more"], stack[-1] if stack else None)
        made.append(element)
        if block:
            out.elements.append(element)
        if m["more"].endswith("/") and name in ("svg", "path"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*+>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append(element)
    flush()
    if any(e.says == 1 for e in made):
        _free_wrappers(out, made)
    return out
