"""Main text of web pages by consensus host paths.

Method. A first pass over the pages scores each page's containers (div, section,
article, main, td and the body) by the prose below them, and the page votes
for the generalised path of its best one: the tags from the body down with
their class and id words, without digits. Votes are summed by host in Spark;
the paths with a tenth of a host's votes or more are its consensus, the most
voted first. A second pass re-extracts every page from the containers that lie
at the first of these paths which holds at least half as much prose on it as
the page's own best container, else from that one.

A page is read tag by tag: malformed markup, unclosed elements and cut pages
are taken as a browser would, roughly. What is no article is left out with all
below it: menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments, by element, role, or the words of class and id.
Everything else of the chosen containers is returned: each block's character
references are decoded, its white space becomes single spaces, and blocks are
joined in page order by an empty line.

What moves: votes, summed before they are shuffled. The consensus of the hosts is
broadcast while it is small (``BROADCAST_BYTES``, measured); beyond that pages
are joined with it by host, where AQE splits a hot host. Work and memory are
linear in a page's length.

Cases: a null or empty page has an empty text, as has one without an article. A
url without a host has no consensus: its pages use their own best container.
Equal votes: the path with more prose, then the smaller one. Repeated rows
are rows of their own (and vote each). A table without rows gives none. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.ship import ship
from ledgerlens.session import materialize

SHARE = 10  # a path of the consensus has at least a 10th of a host's votes
BROADCAST_BYTES = 16 << 20
BATCH_CHARS = 1 << 22  # of extracted text that leaves a task at once

# The roles of HTML elements, and words of class and id that
# name what is no article.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset(
    "nav footer aside form menu dialog template noscript svg math select button object canvas audio video datalist"
    .split()
)
CONTAINERS = frozenset("div section article main td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote body caption dd details dialog dir dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li menu nav ol optgroup option p pre summary table tbody tfoot th thead tr ul"
    .split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit adsbygoogle sponsor "
    "sponsored sponsors promo promos promotion promotions banner nav navbar navigation navigations menu menus submenu "
    "breadcrumb breadcrumbs sidebar sidebars sidenav rail widget widgets footer masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices notification notifications alert alerts popup popups modal overlay newsletter subscribe "
    "subscription signup paywall login comment comments commentlist disqus respond replies discussion share sharing "
    "social related recommended recommendations pagination pager search form forms".split()
)
ADS = frozenset(w for w in NOISE if w.startswith(("ad", "sponsor", "promo")))  # also inside a line of text
KEPT_WITH = frozenset("has no with without layout".split())  # "has-sidebar" is no sidebar
HEADER_OF = frozenset("article post entry content story".split())  # "post-header" is no page header
GOOD = frozenset("article post entry content story main body text".split())

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment, to the end where it is not closed
    r"|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"  # a quote that is not closed
    r"|[!?][^>]*+(?:>|\Z))",
    re.S,
)
HEADED = re.compile(r"<(?:article|main|h1)[\s>]", re.I)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W\d_A-Za-z]+")


@dataclass
class Block:
    container: int
    tag: str
    text: str
    linked: int  # characters inside links


@dataclass
class Page:
    """Containers in the order they open (0 is the body) and kept blocks."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["body"])
    words: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    last: list[int] = field(default_factory=lambda: [0])  # last container inside
    blocks: list[Block] = field(default_factory=list)

    def path(self, c: int) -> str:
        """Generalised path; a container directly in one of the same label
        adds nothing."""
        steps: list[str] = []
        while c > 0:
            step = ".".join((self.tag[c], *self.words[c]))
            if not steps or steps[-1] != step:
                steps.append(step)
            c = self.parent[c]
        return ">".join(["body", *reversed(steps)])


def _names(attributes: str) -> tuple[list[str], str]:
    """Lower-case words of class and id, and the role."""
    words: list[str] = []
    role = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = unescape("".join(values))
        if name.lower() == "role":
            role = value.strip().lower()
        else:
            words += (w.lower() for w in WORD.findall(value))
    return words, role


def _is_noise(tag: str, words: Sequence[str], role: str, in_article: bool, by_name: bool) -> bool:
    if tag in DROPPED and (by_name or tag != "form") or by_name and role in ROLES:
        return True
    if tag == "header":
        return not in_article
    if not by_name:
        return False
    if tag not in BLOCKS:
        return bool(ADS.intersection(words))
    if tag in ("html", "body", "main") or KEPT_WITH.intersection(words):
        return False
    if "header" in words and not in_article and not HEADER_OF.intersection(words):
        return tag not in ("h1", "h2", "h3", "h4", "h5", "h6")
    return bool(NOISE.intersection(words))


def parse(html: str) -> Page:
    """The page's containers and kept blocks. Where names of elements that hold
    the whole page ("page sidebar-right", a form around everything) leave
    nothing of a page that has an article or a heading, names do not count."""
    page = _parse(html, True)
    if not page.blocks and HEADED.search(html):
        page = _parse(html, False)
    return page


def _parse(html: str, by_name: bool) -> Page:
    """One pass over the tags; only containers and elements that are left out
    are kept on the stack."""
    page = Page()
    stack: list[tuple[str, bool, bool]] = []  # tag, makes a container, is left out
    open_tags: Counter[str] = Counter()
    here = out = articles = linked = 0
    in_link = False
    pieces: list[str] = []
    block_tag, at = "", 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                page.blocks.append(Block(here, block_tag, text, linked))
            pieces.clear()
        linked = 0

    def pop() -> str:
        nonlocal here, out, articles
        tag, contains, left_out = stack.pop()
        open_tags[tag] -= 1
        out -= left_out
        if contains:
            page.last[here] = len(page.parent) - 1
            articles -= tag in ("article", "main")
            here = page.parent[here]
        return tag

    size = len(html)
    while at < size:
        m = TAG.search(html, at)
        if not out:
            piece = html[at : m.start() if m else size]
            if piece:
                piece = unescape(piece) if "&" in piece else piece
                pieces.append(piece)
                if in_link:
                    linked += len(piece.strip())
        if m is None:
            break
        at = m.end()
        closes, name, attributes, name2, attributes2 = m.groups()
        if closes:
            tag = closes.lower()
            if tag in BLOCKS:
                flush()
                block_tag = ""
            elif tag == "a":
                in_link = False
            if open_tags[tag]:
                while pop() != tag:
                    pass
            continue
        tag = (name or name2 or "").lower()
        if not tag:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else size
            continue
        if tag in BLOCKS:
            flush()
            block_tag = tag
            while stack and stack[-1][2] and (stack[-1][0] == "p" or stack[-1][0] == tag == "li"):
                pop()  # an element that ends where the next one begins
            if tag in ("article", "main") and out:
                while stack and stack[-1][0] in ("nav", "header"):
                    pop()  # never closed
        elif tag == "br":
            pieces.append(" ")
        elif tag == "a":
            in_link = True
        if tag in VOID:
            continue
        words, role = _names(attributes or attributes2 or "") if attributes or attributes2 else ([], "")
        left_out = not out and _is_noise(tag, words, role, articles > 0, by_name)
        if left_out and tag not in BLOCKS:
            pieces.append(" ")  # the line goes on after it
        contains = tag in CONTAINERS
        if contains or left_out or out and tag in BLOCKS:
            stack.append((tag, contains, left_out))
            open_tags[tag] += 1
            out += left_out
            if contains:
                page.parent.append(here)
                page.tag.append(tag)
                page.words.append(tuple(sorted(set(words))[:4]))
                here = len(page.parent) - 1
                page.last.append(here)
                articles += tag in ("article", "main")
    flush()
    while stack:
        pop()
    page.last[0] = len(page.parent) - 1
    return page


# ------------------------------------------------------------------ scoring --
def _prose(b: Block) -> float:
    """Characters of running text; text made of links counts against."""
    size = len(b.text)
    if 2 * b.linked > size:
        return -size
    if b.tag in ("p", "pre", "blockquote", "h1") or b.text.count(" ") >= 10:
        return size
    return 0.3 * size


def scores(page: Page) -> list[float]:
    """Prose below each container."""
    total = [0.0] * len(page.parent)
    for b in page.blocks:
        total[b.container] += _prose(b)
    for c in range(len(total) - 1, 0, -1):
        total[page.parent[c]] += total[c]
    return total


def best_container(page: Page, total: Sequence[float]) -> int:
    """The container with the most prose, articles and telling names first; then
    down, while one container holds nearly all and nothing like it is beside."""
    best, value = 0, total[0]
    for c in range(1, len(total)):
        good = page.tag[c] in ("article", "main") or bool(GOOD.intersection(page.words[c]))
        if (mine := total[c] * (1.5 if good else 1.0)) >= value:
            best, value = c, mine
    direct: Counter[int] = Counter()
    for b in page.blocks:
        if b.tag != "h1" and _prose(b) > 0.3 * len(b.text):
            direct[b.container] += 1
    children: dict[int, list[int]] = {}
    for c in range(best + 1, page.last[best] + 1):
        if total[c] > 0:
            children.setdefault(page.parent[c], []).append(c)
    while page.tag[best] not in ("article", "main") and not direct[best] and best in children:
        inner = max(children[best], key=total.__getitem__)
        alike = sum(page.tag[c] == page.tag[inner] and page.words[c] == page.words[inner] for c in children[best])
        heads = any(b.tag == "h1" and b.container == best for b in page.blocks)
        if alike > 1 or heads or total[inner] < 0.8 * total[best]:
            break
        best = inner
    return best


def vote(html: str) -> tuple[str, int] | None:
    """(path, characters of prose) of a page's best container."""
    page = parse(html)
    if not page.blocks:
        return None
    total = scores(page)
    best = best_container(page, total)
    return page.path(best), max(0, int(total[best]))


def main_text(html: str, consensus: Sequence[str] = ()) -> str:
    """The page's article by the paths of its host, else by itself."""
    page = parse(html)
    if not page.blocks:
        return ""
    total = scores(page)
    best = best_container(page, total)
    chosen = [best]
    if consensus:
        own = page.path(best)
        at: dict[str, list[int]] = {p: [] for p in consensus}
        tags = {p.rpartition(">")[2].partition(".")[0] for p in consensus}
        for c in range(len(total)):
            if page.tag[c] in tags and (p := own if c == best else page.path(c)) in at:
                at[p].append(c)
        for p in consensus:
            if at[p] and 2 * sum(total[c] for c in at[p]) >= total[best]:
                chosen = at[p]
                break
    kept, upto, ranges = [], -1, iter(chosen)
    lo = next(ranges, None)
    wanted = set()
    while lo is not None:
        if lo > upto:
            upto = page.last[lo]
            wanted.update(range(lo, upto + 1))
        lo = next(ranges, None)
    kept = [b.text for b in page.blocks if b.container in wanted]
    return "\n\n".join(kept)


# -------------------------------------------------------------------- Spark --
def host_of(url: Column) -> Column:
    """Lower-case host of a url, empty where it has none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^/?#]*?://([^/?#]*)", 1), F.lit("")))


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        votes: Counter[tuple[str, str]] = Counter()
        prose: Counter[tuple[str, str]] = Counter()
        for host, html in zip(b.column(0), b.column(1)):
            if (v := vote(html.as_py() or "")) is not None:
                votes[host.as_py(), v[0]] += 1
                prose[host.as_py(), v[0]] += v[1]
        keys = list(votes)
        cols = [[h for h, _ in keys], [p for _, p in keys], [votes[k] for k in keys], [prose[k] for k in keys]]
        types = (pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "path", "n", "prose"])


def consensus(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): the paths with a tenth of a host's votes, ten at most,
    the most voted first."""
    ship(pages.sparkSession)
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    votes = rows.where("host <> '' AND html <> ''").mapInArrow(_voter, "host string, path string, n long, prose long")
    votes = materialize(votes.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("prose").alias("prose")), "votes")
    total = votes.groupBy("host").agg(F.sum("n").alias("total"))
    strong = votes.join(total, "host").where(F.col("n") * SHARE >= F.col("total"))
    ranked = F.sort_array(F.collect_list(F.struct(-F.col("n"), -F.col("prose"), "path")))
    return strong.groupBy("host").agg(ranked.alias("r")).select("host", F.col("r.path").alias("paths"))


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lo, texts, size = 0, [], 0
        for i in range(b.num_rows):
            texts.append(main_text(b.column("html")[i].as_py() or "", b.column("paths")[i].as_py() or ()))
            size += len(texts[-1])
            if size >= BATCH_CHARS or i + 1 == b.num_rows:
                part = b.slice(lo, i + 1 - lo)
                cols = [part.column("k"), part.column("u"), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["k", "u", "text"])
                lo, texts, size = i + 1, [], 0


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars (code points)."""
    hosts = materialize(consensus(pages, url_col, html_col), "hosts")
    size = hosts.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", " ")) + 64), F.lit(0)))
    if size.head()[0] <= BROADCAST_BYTES:
        hosts = F.broadcast(hosts)
    rows = pages.select(
        F.col(id_col).alias("k"), F.col(url_col).alias("u"), F.col(html_col).cast("string").alias("html"),
        F.nullif(host_of(F.col(url_col)), F.lit("")).alias("host"),
    )
    joined = rows.join(hosts, "host", "left").select("k", "u", "html", "paths")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    out = joined.mapInArrow(_extractor, f"k {kinds['k']}, u {kinds['u']}, text string")
    return out.select(
        F.col("k").alias(id_col), F.col("u").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")
    )
