"""HTML pages as trees of blocks, and a generator of labelled pages.

A page becomes a list of nodes in page order: block elements and the text runs inside
them (leaves).  Inline markup joins its block; ``<br>`` is white space.  End tags that
match nothing are ignored, and a new block ends an open paragraph.  The inside of script,
style and form control elements is no text.  Script and the like run to their own end tag
whatever stands in between; a control without an end tag of its own, or whose parent ends
before it, hides nothing behind that.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())  # their inside is not markup
SKIPPED = frozenset("template select button".split())           # their inside is markup, but no text
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: an opening tag of the key ends an open element of these names
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = frozenset("ul ol dl table body html article section main div td aside nav footer header".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*+)>|[^<]+|<""", re.S)
_TAG_START, _SIGN = re.compile(r"</?[a-zA-Z][^\s/>]*"), re.compile(r"(<)()()")
_QUOTED = re.compile(r"""\s*(?:"[^"]*"|'[^']*')""")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)[^>]*>?", re.I | re.A) for n in RAW}
_SKIPPED_TAG = re.compile(rf"<(/?)({'|'.join(SKIPPED)})(?=[\s/>])", re.I | re.A)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    """Parallel lists, one entry per node; the root is node 0."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)      # "#" for a text run
    names: list[tuple[str, ...]] = field(default_factory=list)  # parts of class, id and role
    text: list[str] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)    # of the subtree
    linked: list[int] = field(default_factory=list)   # of these, inside links
    label: list[int] = field(default_factory=list)    # data-y of labelled pages, -1 if none

    def add(self, parent: int, tag: str, names=(), text="", linked=0, label=-1) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.names.append(tuple(names))
        self.text.append(text)
        self.chars.append(len(text))
        self.linked.append(min(linked, len(text)))
        self.label.append(label)
        return len(self.tag) - 1


def _attributes(raw: str, labelled: bool) -> tuple[tuple[str, ...], int]:
    names, label = [], -1
    for m in _ATTR.finditer(raw):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            names += [x.lower() for x in _NAME_PARTS.findall(value)]
        elif labelled and key == "data-y":
            label = int(value)
    return tuple(dict.fromkeys(names)), label


def _skipped_ends(html: str) -> dict[int, int]:
    """Place of a skipped element's tag -> place of its end tag, if it has one."""
    opened, ends = {n: [] for n in SKIPPED}, {}
    for m in _SKIPPED_TAG.finditer(html):
        held = opened[m[2].lower()]
        if not m[1]:
            if m[2].lower() != "template":  # only templates can be nested
                held.clear()
            held.append(m.start())
        elif held:
            ends[held.pop()] = m.start()
    return ends


class _TagEnds:
    """Ends of tags in a page where some ``<`` opens no tag.  A scan that found no end has
    seen signs outside of quotes from which none follows; any later scan that comes to one
    of them stops there, so all scans together are linear in the page."""

    def __init__(self, html: str):
        self.html, self.dead = html, set()
        self.signs = [m.start() for m in re.finditer("[>=]", html)]

    def __call__(self, at: int) -> bool:
        """Whether a tag whose name begins at ``at`` has an end."""
        seen = []
        while (k := bisect_left(self.signs, at)) < len(self.signs) and (sign := self.signs[k]) not in self.dead:
            if self.html[sign] == ">":
                return True
            seen.append(sign)
            quoted = _QUOTED.match(self.html, sign + 1)
            at = quoted.end() if quoted else sign + 1
        self.dead.update(seen)
        return False


def parse(html: str | None, labelled: bool = False) -> Tree:
    """Tree of a page; null and empty pages are a lone root.  ``labelled`` reads the
    ``data-y`` labels of training pages."""
    t = Tree()
    t.add(-1, "root")
    stack = [(0, "root")]          # open blocks
    run: list[str] = []            # text of the open run
    linked, in_link, label = 0, False, -1
    html, pos = html or "", 0
    ends, skip_to, inner = None, 0, []  # blocks open inside the skipped element
    endless = set()
    has_end = None                 # from the first tag without an end on
    opened: Counter = Counter()    # names on the stack

    def flush():
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            t.add(stack[-1][0], "#", (), text, linked, label)
        linked = 0

    def pop_to(n: int):
        nonlocal in_link
        flush()
        if len(stack) > n:
            in_link = False
        opened.subtract(x for _, x in stack[n:])
        del stack[n:]

    while pos < len(html):
        m = (_TOKEN if has_end is None or not (tag := _TAG_START.match(html, pos)) or has_end(tag.end()) else _SIGN).match(html, pos)
        start, pos = pos, m.end()
        if m[0] == "<" and has_end is None and _TAG_START.match(html, start):
            has_end = _TagEnds(html)
        token, name = m[0], (m[2] or "").lower()
        if name in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = None if name in endless else _RAW_END[name].search(html, pos)
                if end:
                    pos = end.end()
                elif name in ("script", "style"):
                    break
                endless |= set() if end else {name}
            continue
        if start < skip_to:
            if name in BLOCKS:
                if not m[1]:
                    inner += [] if name in VOID or m[3].endswith("/") else [name]
                elif name in inner:
                    while inner.pop() != name:
                        pass
                elif opened[name]:
                    skip_to = 0  # its parent ends
            if skip_to:
                continue
        if token[0] != "<" or len(token) == 1:
            text = unescape(token)
            run.append(text)
            if in_link:
                linked += len(text.strip())
        elif not name:
            continue
        elif name in SKIPPED:
            if not m[1] and not m[3].endswith("/"):
                ends = _skipped_ends(html) if ends is None else ends
                skip_to, inner = ends.get(start, 0), []
        elif name == "br":
            run.append(" ")
        elif name == "a":
            in_link = not m[1]
        elif name in BLOCKS:
            if m[1]:
                for n in range(len(stack) - 1, 0, -1) if opened[name] else ():
                    if stack[n][1] == name:
                        pop_to(n)
                        break
                    if name == "p" and stack[n][1] in SCOPES:
                        break
                label = t.label[stack[-1][0]]
                continue
            for n in range(len(stack) - 1, 0, -1) if opened["p"] or any(opened[x] for x in ENDS.get(name, ())) else ():
                if stack[n][1] == "p" or stack[n][1] in ENDS.get(name, ()):
                    pop_to(n)
                    break
                if stack[n][1] in SCOPES:
                    break
            flush()
            names, own = _attributes(m[3], labelled) if m[3] else ((), -1)
            node = t.add(stack[-1][0], name, names, label=own if own >= 0 else t.label[stack[-1][0]])
            if name not in VOID and not m[3].endswith("/"):
                stack.append((node, name))
                opened[name] += 1
            label = t.label[stack[-1][0]]
    flush()
    for n in range(len(t.tag) - 1, 0, -1):  # children come after their parent
        t.chars[t.parent[n]] += t.chars[n]
        t.linked[t.parent[n]] += t.linked[n]
    return t


# --- labelled pages -------------------------------------------------------------------

# Names that page authors give to parts of a page.
PARTS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs pagination pager skip toc tabs".split(),
    "header": "header masthead topbar banner branding logo tagline hero top".split(),
    "footer": "footer copyright legal siteinfo colophon bottom credits".split(),
    "side": "sidebar aside widget related recommended trending popular rail secondary more read".split(),
    "notice": "cookie consent gdpr notice alert popup modal newsletter subscribe paywall overlay disclaimer".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense commercial".split(),
    "form": "form search login signup register contact field input".split(),
    "comments": "comment comments reply replies discussion disqus responses thread respond user".split(),
    "social": "share social follow tags meta tools buttons".split(),
    "content": "article content main post entry story body text page markdown prose column blog single primary".split(),
    "plain": "container wrapper row inner outer box block section layout grid wrap site root app col".split(),
}


def labelled_page(rng: random.Random) -> str:
    """A page whose blocks carry ``data-y`` (1: main text, 0: anything else)."""
    letters = "etaoinshrdlu"

    def words(n):
        out = []
        while len(out) < n:
            out.append("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) + rng.choice(["", "", "", "", "", ",", "."]))
        return " ".join(out).capitalize() + rng.choice([".", ".", ".", ""])

    def link(n=2):
        return f'<a href="/{rng.randint(1, 999)}">{words(rng.randint(1, n))}</a>'

    def attr(kind, p=0.85):
        if rng.random() > p:
            kind = "plain"
        name = rng.choice(PARTS[kind]) + rng.choice(["", "", "-" + rng.choice(PARTS["plain"]), str(rng.randint(1, 9))])
        return rng.choice([f' class="{name}"', f' id="{name}"', f" class='{rng.choice(PARTS['plain'])} {name}'"])

    def part(tags, kind, body, y):
        tag = rng.choice(tags)
        known = tag in ("nav", "header", "footer", "aside", "form", "article", "main")
        a = "" if known and rng.random() < 0.6 else attr(kind)
        return f'<{tag}{a} data-y="{y}">{body}</{tag}>'

    def sentence_block(y):
        return f"<p>{words(rng.choice([2, 5, 12, 30]))}</p>"

    def menu():
        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
        return part(["nav", "nav", "div", "section"], "menu", f"<ul>{items}</ul>" if rng.random() < 0.8 else " | ".join(link() for _ in range(6)), 0)

    def ad():
        return part(["div", "div", "aside", "section"], "ad", rng.choice([words(rng.randint(2, 25)), link(6), f"<p>{words(12)}</p>"]), 0)

    def notice():
        return part(["div", "section", "aside"], "notice", rng.choice([words(rng.randint(5, 30)), f"<p>{words(rng.randint(5, 30))}</p>{link()}"]), 0)

    def form():
        return part(["form"], "form", f"<label>{words(2)}</label><input name=q><p>{words(rng.randint(2, 10))}</p><button>{words(1)}</button>", 0)

    def social():
        return part(["div", "ul"], "social", " ".join(link() for _ in range(rng.randint(2, 5))), 0)

    def side():
        body = "".join(f"<h3>{words(2)}</h3>" + rng.choice([f"<ul>{''.join('<li>' + link(5) + '</li>' for _ in range(4))}</ul>", sentence_block(0)]) for _ in range(rng.randint(1, 3)))
        return part(["aside", "aside", "div"], "side", body, 0)

    def comments():
        one = lambda: f"<{'li' if rng.random() < .5 else 'div'} class=\"comment\"><p>{words(rng.randint(3, 60))}</p></div>"
        return part(["section", "div", "div", "ol"], "comments", f"<h3>{words(2)}</h3>" + "".join(one() for _ in range(rng.randint(1, 6))), 0)

    def article():
        out = [f"<h{rng.choice('112')}>{words(rng.randint(2, 10))}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 14)):
            u = rng.random()
            if u < 0.7:
                inner = words(rng.choice([1, 2, 5, 15, 40, 80]))
                if rng.random() < 0.15:
                    inner += " " + link(4) + " " + words(rng.randint(1, 12))
                out.append(rng.choice([f"<p>{inner}</p>", f"<p>{inner}", f"<p><b>{inner}<br><p>{words(9)}</p>", f"<div>{inner}</div>"]) if rng.random() < 0.5 else f"<p>{inner}</p>")
            elif u < 0.78:
                out.append(f"<h{rng.choice('234')}>{words(3)}</h2>")
            elif u < 0.86:
                out.append("<ul>" + "".join(f"<li>{words(rng.randint(1, 15))}</li>" for _ in range(rng.randint(1, 6))) + "</ul>")
            elif u < 0.9:
                out.append(f"<blockquote>{sentence_block(1)}</blockquote>")
            elif u < 0.93:
                out.append(f"<table><tr><td>{words(2)}</td><td>{words(3)}</td></tr></table>")
            elif u < 0.96:
                out.append(ad())
            elif u < 0.98:
                out.append(social())
            else:
                out.append(f"<pre>{words(10)}</pre>")
        kind = rng.random()
        body = "".join(out)
        if kind < 0.5:
            return part(["article"], "content", body, 1)
        if kind < 0.9:
            return part(["div", "section", "main", "td"], "content", body, 1)
        return f'<div data-y="1">{body}</div>'

    if rng.random() < 0.15:  # the bare page: menu, advert, article, footer
        mid = menu() + ad() + article()
    else:
        head = part(["header", "header", "div"], "header", f"<p>{words(rng.randint(1, 5))}</p>" + (menu() if rng.random() < 0.5 else ""), 0) if rng.random() < 0.7 else ""
        column = [article()]
        before = [f for f in (menu, ad, notice, social, form) if rng.random() < 0.25]
        after = [f for f in (ad, social, comments, comments, side, form, menu) if rng.random() < 0.3]
        main = "".join(f() for f in before) + column[0] + "".join(f() for f in after)
        for _ in range(rng.randint(0, 2)):
            main = f"<{rng.choice(['div', 'div', 'main', 'section'])}{attr('plain')}>{main}</div>"
        mid = (notice() if rng.random() < 0.3 else "") + head + (menu() if rng.random() < 0.6 else "")
        mid += (side() if rng.random() < 0.2 else "") + main + (side() if rng.random() < 0.4 else "")
    foot = part(["footer", "footer", "div"], "footer", rng.choice(["&copy; ", ""]) + rng.choice([words(rng.randint(2, 15)), f"<p>{words(rng.randint(2, 15))}</p>", " ".join(link() for _ in range(5))]), 0)
    return (f"<!DOCTYPE html><html><head><title>{words(4)}</title></head><body>{mid}"
            f"{foot if rng.random() < 0.9 else ''}</body></html>")
