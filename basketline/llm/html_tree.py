"""A small reader of HTML into a tree of blocks and text runs, and labelled pages to learn from."""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td template tfoot th "
    "thead tr ul ins noscript select svg button object".split()
)
# Start tags that end an open element of these kinds, up to the nearest one of those that hold them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, {"html"}),
}
_P = ({"p"}, {"table", "td", "th", "button", "object"})
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile("[\"'>]")
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+|[0-9]+")


class Tree:
    """Nodes in page order, parents before children: elements, and runs of text below them."""

    __slots__ = ("parent", "tag", "attrs", "text", "linked")

    def __init__(self) -> None:
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#root"]
        self.attrs: list[str] = [""]
        self.text: list[str] = [""]  # of runs, with single spaces
        self.linked: list[int] = [0]  # characters of a run inside links


class _Tags:
    """Where tags end: at the first > outside of quotes, or at the first > at all where quotes never close.

    Marks are found once for the whole page, and a quote from which no end was reached is remembered, so
    the work grows with the page however broken it is.
    """

    def __init__(self, page: str):
        self.marks = [m.start() for m in _MARK.finditer(page)]
        self.of = {c: [i for i in self.marks if page[i] == c] for c in "\"'>"}
        self.page = page
        self.dead: set[int] = set()

    def _next(self, places: list[int], at: int) -> int:
        i = bisect_left(places, at)
        return places[i] if i < len(places) else -1

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose name ends at ``at``; -1 without any."""
        seen: list[int] = []
        place = at
        while True:
            mark = self._next(self.marks, place)
            if mark >= 0 and self.page[mark] == ">":
                return mark
            close = -1 if mark < 0 or mark in self.dead else self._next(self.of[self.page[mark]], mark + 1)
            if close < 0:
                self.dead.update(seen)
                if mark >= 0:
                    self.dead.add(mark)
                return self._next(self.of[">"], at)
            seen.append(mark)
            place = close + 1


def parse(page: str) -> Tree:
    """Read a page however broken: unknown ends are skipped, open elements end where they must. Linear in the page."""
    tree = Tree()
    parent, tag, attrs, text, linked = tree.parent, tree.tag, tree.attrs, tree.text, tree.linked
    stack = [0]
    depths: dict[str, list[int]] = {}  # where elements of each tag stand in the stack
    run: list[str] = []
    in_link = links = 0
    tags = _Tags(page)

    def flush() -> None:
        nonlocal links
        if run:
            words = " ".join("".join(run).split())
            run.clear()
            if words:
                parent.append(stack[-1])
                tag.append("#text")
                attrs.append("")
                text.append(words)
                linked.append(min(links, len(words)))
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            run.append(piece)
            if in_link:
                links += len(piece.strip())

    def nearest(kinds) -> int:
        return max((depths[k][-1] for k in kinds if depths.get(k)), default=0)

    def cut(depth: int) -> None:
        flush()
        while len(stack) > depth:
            depths[tag[stack.pop()]].pop()

    def close(kinds: set, until: set) -> None:
        depth = nearest(kinds)
        if depth > nearest(until):
            cut(depth)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        follows = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            add(page[at:start])
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            continue
        if follows in ("!", "?"):
            add(page[at:start])
            end = tags._next(tags.of[">"], start)
            at = end + 1 if end >= 0 else size
            continue
        found = _NAME.match(page, start + 1)
        end = tags.end(found.end()) if found else -1
        if end < 0:
            add(page[at : start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = end + 1
        name = found.group(2).lower()
        if found.group(1):
            if name == "a":
                in_link = 0
            if name in BLOCK:
                if depths.get(name):
                    cut(depths[name][-1])
                in_link = 0
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name == "br":
            run.append(" ")
            continue
        if name == "a":
            in_link = 1
            continue
        if name not in BLOCK:
            continue
        flush()
        in_link = 0
        if name in ENDS:
            close(*ENDS[name])
        if name not in ("li", "td", "th", "tr", "dd", "dt", "tbody", "thead", "tfoot"):
            close(*_P)
        if name == "hr":
            continue
        parent.append(stack[-1])
        tag.append(name)
        attrs.append(page[found.end() : end].strip())
        text.append("")
        linked.append(0)
        depths.setdefault(name, []).append(len(stack))
        stack.append(len(tag) - 1)
    flush()
    return tree


def names(attrs: str) -> tuple[str, ...]:
    """Lower-cased words of class, id and role."""
    if not attrs:
        return ()
    found = (a or b or c for a, b, c in _NAMES.findall(attrs))
    return tuple(dict.fromkeys(w for f in found for w in _WORDS.findall(f.lower())))


# Names and tags of the parts of pages that the labelled pages are made of.
PARTS = {
    "menu": ("nav div ul", "nav navbar menu navigation topnav breadcrumb breadcrumbs pagination toc links main-menu"),
    "header": ("header div", "header masthead banner site-header topbar logo branding top"),
    "footer": ("footer div", "footer colophon copyright site-footer legal bottom credits"),
    "side": ("aside div section", "sidebar side widget related recommended promo popular trending more rail"),
    "advert": ("div ins section aside", "ad ads advert advertisement sponsor sponsored banner promo adsense"),
    "notice": ("div section dialog", "cookie cookies consent notice alert gdpr popup modal newsletter privacy overlay message"),
    "form": ("form div form", "form search login signup subscribe contact register"),
    "comments": ("section div ol", "comments comment replies disqus discussion respond reader-comments thread reply"),
    "share": ("div ul", "share social sharing tags tools buttons follow meta"),
}
CONTENT = "article content post entry story main body text page post-content entry-content article-body"


def labelled_page(rng: random.Random) -> str:
    """A made-up page whose elements carry their label as data-y."""

    def word() -> str:
        return "".join(rng.choice(_SOUNDS) for _ in range(rng.randint(1, 4)))

    def prose(n: int) -> str:
        out = " ".join(word() for _ in range(n)).capitalize() + rng.choice([".", ".", "!", ""])
        return f"<b>{out}" if rng.random() < 0.15 else out

    def attributes(pool: str, chance: float) -> str:
        if rng.random() > chance:
            return ""
        kind = rng.choice(["class", "class", "id"])
        return f' {kind}="{" ".join(rng.sample(pool.split(), rng.choice([1, 1, 2])))}"'

    def links(n: int) -> str:
        item = [f'<a href="/{word()}">{word()}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in item) + "</ul>" if rng.random() < 0.7 else " ".join(item)

    def part(kind: str) -> str:
        tags, pool = PARTS[kind]
        tag = rng.choice(tags.split())
        sure = tag in ("div", "section", "ul", "ol")
        body = {
            "menu": lambda: links(rng.randint(3, 9)),
            "header": lambda: f"<div>{word()}</div>" + (links(4) if rng.random() < 0.5 else ""),
            "footer": lambda: rng.choice([lambda: "&copy; " + prose(rng.randint(3, 14)), lambda: f"<p>{prose(8)}</p>" + links(4)])(),
            "side": lambda: f"<h3>{prose(2)}</h3>" + rng.choice([lambda: links(5), lambda: f"<p>{prose(20)}</p>"])(),
            "advert": lambda: rng.choice([lambda: prose(rng.randint(2, 14)), lambda: f"<p>{prose(12)}</p>", lambda: links(2)])(),
            "notice": lambda: f"<p>{prose(rng.randint(8, 30))}</p><button>{word()}</button>",
            "form": lambda: f"<label>{prose(2)}</label><input><p>{prose(6)}</p><button>{word()}</button>",
            "comments": lambda: f"<h3>{prose(2)}</h3>"
            + "".join(f'<div class="comment"><p>{prose(rng.randint(4, 40))}</p></div>' for _ in range(rng.randint(1, 4))),
            "share": lambda: links(4),
        }[kind]()
        if tag in ("ul", "ol"):
            body = f"<li>{body}</li>"
        return f'<{tag}{attributes(pool, 1.0 if sure else 0.4)} data-y="0">{body}</{tag}>'

    def paragraphs() -> str:
        out = []
        for _ in range(rng.randint(1, 9)):
            n = rng.choice([1, 3, 8, 20, 50, 90])
            out.append(
                rng.choice(
                    [lambda: f"<p>{prose(n)}</p>"] * 8
                    + [
                        lambda: f"<p>{prose(n)}<br>",
                        lambda: f"<h2>{prose(3)}</h2>",
                        lambda: "<ul>" + "".join(f"<li>{prose(6)}</li>" for _ in range(3)) + "</ul>",
                        lambda: f"<blockquote><p>{prose(n)}</p></blockquote>",
                        lambda: f"<table><tr><td>{word()}</td><td>{prose(3)}</td></tr></table>",
                        lambda: f'<p>{prose(n)} <a href="/{word()}">{prose(3)}</a> {prose(4)}</p>',
                        lambda: f"<figure><img src=x><figcaption>{prose(6)}</figcaption></figure>",
                        lambda: f"<pre>{prose(n)}</pre>",
                        lambda: f"<section><h3>{prose(2)}</h3><p>{prose(n)}</p></section>",
                        lambda: f"<div><p>{prose(n)}</p></div>",
                    ]
                )()
            )
            if rng.random() < 0.06:
                out.append(part(rng.choice(["advert", "share", "side", "notice"])))
        return "".join(out)

    title = f"<h1>{prose(6)}</h1>"
    if rng.random() < 0.2:
        title = f'<header data-y="1">{title}</header>'
    inner = title + paragraphs() + (part("share") if rng.random() < 0.2 else "") + (part("comments") if rng.random() < 0.15 else "")
    tag = rng.choice(["article"] * 4 + ["main", "div", "div", "section"])
    main = f'<{tag}{attributes(CONTENT, 1.0 if tag in ("div", "section") else 0.4)} data-y="1">{inner}</{tag}>'
    if rng.random() < 0.3:
        outer = rng.choice(["main", "div"])
        main = f"<{outer}{attributes('wrapper container main page content layout row', 0.7)}>{main}{part('side') if rng.random() < 0.4 else ''}</{outer}>"
    before = [part(k) for k in ("notice", "header", "menu", "advert", "form") if rng.random() < 0.5]
    after = [part(k) for k in ("comments", "side", "form", "advert", "share", "footer") if rng.random() < 0.4]
    rng.shuffle(before)
    return "<html><head><title>x</title></head><body data-y=\"0\">" + "".join(before) + main + "".join(after) + "</body></html>"


_SOUNDS = "ba de fi go lu ma ne pi ro su ta ve xi zo kra ste".split()
