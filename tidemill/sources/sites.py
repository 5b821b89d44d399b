"""Comments out of saved pages of five sites, by ranked selectors.

A selector is a small part of CSS: steps under one another, each a tag with #id and [attribute op "value"],
op one of = (equal), ^= (begins with), *= (contains).  The first selector that finds a text wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html import VOID

_STEP = re.compile(r'([\w-]*)((?:#[\w-]+|\[[\w-]+(?:[\^*]?="[^"]*")?\])*)$')
_TEST = re.compile(r'#([\w-]+)|\[([\w-]+)(?:([\^*]?=)"([^"]*)")?\]')


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None = None
    children: list = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        """Elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, without: tuple[str, ...] = ()) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag == "br":
                out.append("\n")
            elif c.tag == "img" and "img" not in without:
                out.append(c.attrs.get("alt", ""))
            elif c.tag not in without:
                stack += list(reversed(c.children))
        return "".join(out).strip()

    def above(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_endtag(self, tag):
        if self.now.tag == tag or any(n.tag == tag for n in self.now.above()):
            while self.now.tag != tag:
                self.now = self.now.parent
            self.now = self.now.parent

    def handle_data(self, data):
        self.now.children.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    return parser.root


def _fits(node: Node, step: str) -> bool:
    tag, tests = _STEP.match(step).groups()
    if tag and node.tag != tag:
        return False
    for name_id, name, op, value in _TEST.findall(tests):
        have = node.attrs.get("id" if name_id else name)
        want = name_id or value
        if have is None or (name_id or op == "=") and have != want or op == "^=" and not have.startswith(want) or op == "*=" and want not in have:
            return False
    return True


def select(node: Node, selector: str) -> list[Node]:
    """Elements below a node that a selector finds, in document order."""
    *outer, last = re.split(r" (?![^\[]*\])", selector)
    found = []
    for n in node.walk():
        if _fits(n, last):
            steps = list(outer)
            for up in n.above():
                if up is node or not steps:
                    break
                if _fits(up, steps[-1]):
                    steps.pop()
            if not steps:
                found.append(n)
    return found


@dataclass(frozen=True)
class Site:
    """Ranked selectors of a site's blocks and of the fields inside them."""

    block: tuple[str, ...]
    post: tuple[str, ...]
    author: tuple[str, ...]
    body: tuple[str, ...]
    time: tuple[str, ...]
    replies: str = ""
    author_attribute: str = ""
    #: Elements whose text is no part of the body, and ancestors under which no body lies.
    without: tuple[str, ...] = ()
    outside: str = ""
    #: The body's element carries the block's id: attribute of the block, and what follows it in the id.
    own_id: tuple[str, str] = ("", "")
    least: int = 0


# Where the sites keep what is read.
SITES = {
    "facebook": Site(
        block=('div[role="article"]', 'div[aria-label^="Comment by"]'), post=('div[data-ad-preview="message"]', 'div[dir="auto"]'),
        author=('a[role="link"] span[dir="auto"]', 'a[role="link"] span span', 'a[role="link"]', 'span[dir="auto"]'),
        body=('div[dir="auto"]', 'span[dir="auto"]'), time=('a[role="link"]',), without=("a", "img"), outside='a[role="link"]',
    ),
    "tiktok": Site(block=('div[class*="DivCommentContentContainer"]',), post=("h1", 'div[class*="DivDescription"]'), author=("div a",), body=("div p",), time=("div p span",)),
    "youtube": Site(
        block=("#comment",), post=('h1[class*="ytd-watch-metadata"] yt-formatted-string', 'h1[class*="title"] yt-formatted-string', "h1"),
        author=("#author-text a", "#author-text span", "#author-text"), body=('#content-text span[class*="yt-core-attributed-string"]', "#content-text"),
        time=("#published-time-text a", 'a[href*="lc="]', "#published-time-text"), replies="ytd-comment-replies-renderer ytd-comment-view-model", without=("a",),
    ),
    "reddit": Site(block=("shreddit-comment",), post=("h1",), author=(), body=("p",), time=("faceplate-timeago time",), author_attribute="author", own_id=("thingid", "-post-rtjson-content")),
    "threads": Site(block=('div[data-pressable-container="true"]', 'div[role="article"]', "article"), post=('div[data-pressable-container="true"]', "article"), author=('a[href*="/@"]', "a"), body=('span[dir="auto"]', "span"), time=("time",), least=10),
}


def _first(node: Node, selectors: tuple[str, ...], without: tuple[str, ...] = (), outside: str = "", last: bool = False) -> str:
    for s in selectors:
        found = [n for n in select(node, s) if not outside or not any(_fits(u, outside) for u in n.above())]
        for n in reversed(found) if last else found:
            if said := n.text(without):
                return said
    return ""


def extract(html: str, site: Site) -> Iterator[tuple[int, bool, str, str, str, str]]:
    """(place, reply, post, author, time, body) of a page's comments in order, replies after their thread's
    first comment.  Blocks without a body are left out; a blank author is Anonymous or, where the block
    says [deleted], deleted."""
    root = tree(html)
    post = _first(root, site.post) or "N/A"
    blocks = next((b for b in (select(root, s) for s in site.block) if b), [])
    replies = {id(n) for n in select(root, site.replies)} if site.replies else set()
    rows = [(n, False) for n in blocks if id(n) not in replies and not any(id(u) in replies for u in n.above())]
    inner = {id(n) for n, _ in rows} | replies
    rows = [(n, id(n) in replies) for n in root.walk() if id(n) in inner]
    for place, (n, reply) in enumerate(rows):
        if site.own_id[0]:
            own = select(n, f'div[id="{n.attrs.get(site.own_id[0], "")}{site.own_id[1]}"]') if n.attrs.get(site.own_id[0]) else []
            body = " ".join(x for x in (p.text() for o in own[:1] for s in site.body for p in select(o, s)) if x)
        else:
            body = _first(n, site.body, site.without, site.outside)
        if not body or len(n.text()) <= site.least:
            continue
        author = n.attrs.get(site.author_attribute, "").strip() if site.author_attribute else _first(n, site.author)
        author = author or ("deleted" if "[deleted]" in n.text() else "Anonymous" if site.author_attribute else "Unknown")
        yield place, reply, post, author, _first(n, site.time, last=site is SITES["facebook"]) or "N/A", body


def comments(pages: DataFrame, site: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, place, reply, post_raw, author, created_raw, comment_raw of saved pages of a site.  Null and
    broken pages give what can be read of them."""
    spec = SITES[site]
    kind = pages.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, *r) for k, h in zip(frame[key], frame[html], strict=True) for r in extract(h, spec)]
            yield pd.DataFrame(rows, columns=[key, "place", "reply", "post_raw", "author", "created_raw", "comment_raw"])

    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, place long, reply boolean, post_raw string, author string, created_raw string, comment_raw string")


def numbered(rows: DataFrame, key: str = "page_id") -> DataFrame:
    """comment_id of extracted rows: the page's key and the comment's place, from 1."""
    return rows.withColumn("comment_id", F.concat_ws("_", F.col(key).cast("string"), (F.col("place") + 1).cast("string")))
