"""Main text of web pages by consensus host paths.

1. Each page's containers are scored (text outside links, boilerplate left out)
   and the page votes for the generalised tag-class path of its best one.
2. Votes are counted by host and path in Spark; a host's winning paths are those
   with at least ``min_share`` of its pages' votes (so at most 1 / min_share).
3. Every page is extracted again: all containers on the first winning path that
   holds enough of the page's text, else the page's own best container.

Pages of a host with more than ``HOT_SHARE`` of all votes get its paths from a
broadcast of those hosts (fewer than 1 / HOT_SHARE rows) and are not shuffled; the
others are joined by host.

Pages of one host share a template, so a page whose own scores mislead (a long
sidebar, a short article) is set right by its siblings.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import fresh, staged
from cartwheel.llm.url_filter import url_host

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>|<[!?][^>]*>""", re.S)
_ATTR = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_CUT_OFF = re.compile(r"</?[A-Za-z][^<>]*\Z")  # a tag that the page's end cuts off
_DIGITS, _PARTS = re.compile(r"[0-9]+"), re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody
td tfoot th thead tr ul""".split())
CONTAINER = frozenset("body main article section div td center blockquote".split())
DROPPED = frozenset("head nav footer aside form button select menu dialog label".split())
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body div article section main td th table ul ol dl blockquote".split())
# Words of class, id or role that mark what is not the article.
BOILERPLATE = frozenset("""ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices
pager pagination popup promo related reply replies respond share sharing sidebar signup social sponsor sponsored
subscribe toolbar widget widgets""".split())
HEADING = frozenset("header masthead topbar".split())
CONTENT = frozenset("article body content entry main post story text".split())


class Node:
    __slots__ = ("tag", "path", "start", "end", "score", "holder", "dropped", "inside")

    def __init__(self, tag, path, start, holder, dropped, inside):
        self.tag, self.path, self.start, self.end, self.score = tag, path, start, -1, 0.0
        self.holder, self.dropped, self.inside = holder, dropped, inside


HOT_SHARE = 0.001


def _name(tag: str, attrs: dict[str, str]) -> str:
    """Tag and classes, digits generalised."""
    classes = sorted({_DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes])


def _is_dropped(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if not attrs or tag in ("html", "body", "main", "article"):
        return False
    words = {w.lower() for k in ("class", "id", "role") for w in _PARTS.split(attrs.get(k, "")) if w}
    if words & {"comment", "comments", "disqus", "respond"}:
        return True
    return bool(words & BOILERPLATE or not inside and words & HEADING) and not words & CONTENT


def parse(page: str) -> tuple[list[str], list[Node]]:
    """Pieces of kept text in page order, and the containers with their stretch of pieces and score."""
    pieces: list[str] = []
    containers: list[Node] = []
    stack: list[Node] = [Node("", "", 0, None, False, False)]
    links, at, size = 0, 0, len(page)

    def add(text: str) -> None:
        top = stack[-1]
        if top.dropped or not text or text.isspace():
            if text and not top.dropped:
                pieces.append(" ")
            return
        text = html.unescape(text)
        pieces.append(text)
        share, node = float(len(text)), top if top.tag in CONTAINER else top.holder
        if links:
            share *= 0.1
        for weight in (1.0, 0.5, 0.25):
            if node is None:
                break
            node.score += weight * share * (3.0 if node.tag in ("article", "main") else 1.0)
            node = node.holder

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            node = stack.pop()
            node.end = len(pieces)
            links -= node.tag == "a"

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            add(_CUT_OFF.sub("", page[at:]))
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCK and not stack[-1].dropped:
            pieces.append(" ")
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        attrs = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTR.finditer(m[3] or m[6] or "")}
        ends = IMPLIED_END.get(tag) or ({"p"} if tag in BLOCK and tag != "br" else None)
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        if tag in VOID or (m[3] or m[6] or "").endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        top = stack[-1]
        holder = top if top.tag in CONTAINER else top.holder
        inside = top.inside or tag in ("article", "main")
        node = Node(tag, f"{holder.path if holder else ''}/{_name(tag, attrs)}" if tag in CONTAINER else "",
                    len(pieces), holder, top.dropped or _is_dropped(tag, attrs, top.inside), inside)
        links += tag == "a"
        stack.append(node)
        if tag in CONTAINER and not node.dropped:
            containers.append(node)
    close(0)
    return pieces, containers


def _best(containers: list[Node]) -> Node | None:
    best = max(containers, key=lambda n: n.score, default=None)
    return best if best is not None and best.score > 0 else None


def best_path(page: str) -> str | None:
    """Generalised path of the page's best container."""
    best = _best(parse(page)[1])
    return best.path if best else None


def main_text(page: str, winners: list[str], enough: float = 0.5) -> str:
    """Text of the first winning path that scores ``enough`` of the best container, else of that one."""
    pieces, containers = parse(page)
    best = _best(containers)
    if best is None:
        return " ".join("".join(pieces).split())
    chosen = [best]
    for path in winners:
        on_path = [n for n in containers if n.path == path]
        if on_path and sum(n.score for n in on_path) >= enough * best.score:
            chosen = on_path
            break
    out, done = [], 0
    for node in sorted(chosen, key=lambda n: n.start):
        out += [" ", *pieces[max(node.start, done):node.end]]
        done = max(done, node.end)
    return " ".join("".join(out).split())


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"host": batch["host"], "path": [best_path(h) for h in batch["html"]]}).dropna()


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_share: float = 0.1) -> DataFrame:
    """(host, votes, winners array<string>): paths by falling votes, then by text.  Pages without host are no host."""
    told = pages.select(url_host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")) \
                .filter("host <> ''").mapInPandas(_votes, "host string, path string")
    counted = told.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    # one row for each host and path from here on
    totals = counted.groupBy(F.col("host").alias("of")).agg(F.sum("votes").alias("all_votes"))
    kept = counted.join(totals, F.col("host") == F.col("of")).filter(F.col("votes") >= min_share * F.col("all_votes"))
    ranked = kept.groupBy("host").agg(F.max("all_votes").alias("votes"), F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
                                      .alias("ranked"))
    return ranked.select("host", "votes", F.col("ranked.path").alias("winners"))


def _text(page: str | Column, winners: str | Column, enough: float) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, [] if w is None else list(w), enough) for p, w in zip(pages, paths)],
                         dtype=object)

    return run(page, winners)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_share: float = 0.1,
            enough: float = 0.5, out: str = "text") -> DataFrame:
    """Rows of ``pages`` with the main text in ``out`` (replacing a column of that name).

    Character references are decoded and white space runs become one space.  A
    null or empty page, or one without text, gives the empty string.  A null
    url, or one without host, is extracted by the page's own best container.
    Repeated pages vote each and are extracted alike; votes that tie are ordered
    by path.  Empty in, empty out.
    """
    host, of, winners = fresh(pages.columns, "host", "of", "winners")
    paths = staged(host_paths(pages, url_col, html_col, min_share))
    limit = HOT_SHARE * (paths.agg(F.sum("votes")).first()[0] or 0)
    hot = F.broadcast(paths.filter(F.col("votes") > limit).select(
        F.col("host").alias(of), F.col("winners").alias(winners)))
    others = paths.filter(F.col("votes") <= limit).select(F.col("host").alias(of), F.col("winners").alias(winners))
    named = pages.withColumn(host, url_host(F.col(url_col)))
    same = F.col(host) == F.col(of)
    joined = named.join(hot, same).unionByName(
        named.join(hot.select(of), same, "left_anti").join(others, same, "left"))
    text = _text(F.coalesce(F.col(html_col), F.lit("")), F.col(winners), enough)
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns if c != out], text.alias(out))
