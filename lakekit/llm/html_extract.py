"""HTML extraction by consensus host paths.

Every page scores its containers by the text of their blocks that is not link text, and votes for the best one by its
generalised path (tags with their classes, digits generalised).  Votes are added up per host in Spark, and each page is
extracted again from the containers on its host's winning path; pages that have less than half of their scored text
there use their own best one.  What stands beside the winning containers belongs to the text only where the host's pages,
all taken together, call that place content: over half of its characters are neither link text nor repeated word for word
on three or more pages with different text.  Of several containers on the winning path, those of repeated text alone leave.

A block is the text between two block borders; character references are decoded, white space in a block becomes one
space, blocks are joined by a line feed in page order.  Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out by tag, or by a class, id or role that consists of such words (and of
words that say only where it is).  A left-out element counts as part of the page all the same

* if it holds ``main``; or, by name or a form, if it holds an ``article`` and the page has none elsewhere;
* on pages without either, by name or a form, if it holds more than half of the page's text that is not link text;
* of reader comments, if nothing else is left.

Defined results: null and empty html give the empty text; pages without a tag are one block; a null url belongs to the
empty host; unclosed elements end where HTML lets them end, unclosed comments and scripts at the end of the page;
nesting of any depth takes time by the page's size;
repeated rows are extracted each, and count once as a place where a text stands; an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import byte_slices
from lakekit.session import cut_lineage

SKIPPED_TAGS = frozenset("head nav header footer aside form menu dialog select button iframe object audio video canvas".split())
#: of these, what has no page text in it at all
OPAQUE_TAGS = frozenset("head select button iframe object audio video canvas".split())
OPAQUE = "script|style|noscript|template|textarea|svg|annotation-xml|annotation|title"
CONTAINERS = frozenset("body main article section div table tbody tr td center".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote address figure figcaption th caption thead tfoot hr details summary".split())
TALK = re.compile(r"comments?|replies|disqus|respond")
NOISE = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|footer|header|masthead|breadcrumbs?|copyright|colophon|"
                   r"sidebar|side|widgets?|related|recommended|share|sharing|social|cookies?|consent|gdpr|notices?|banner|"
                   r"alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|pagination|pager|skip|hidden|" + TALK.pattern)
#: words beside which a noise word keeps its meaning
PLACES = frozenset("site page main top bottom left right primary secondary global local box bar block list area container wrapper wrap "
                   "inner outer section group item items link links button buttons icons form body law info policy message posts "
                   "articles stories news topics products".split())
OF_POST = frozenset("post entry article".split())
PART = re.compile(r"[a-z]+")
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({OPAQUE})\b[^>]*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+>|"
                   r"<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
DIGITS = re.compile(r"\d+")
#: pages with different text that a block must stand on, word for word, to be the host's and not the page's
REPEATS = 3


@lru_cache(1 << 14)
def _noise(name: str) -> str:
    """Of a class, id or role: "" if it marks no noise, "talk" for reader comments, else "name"."""
    parts = PART.findall(name.lower())
    marks = [p for p in parts if NOISE.fullmatch(p)]
    places = PLACES | OF_POST if any(m != "header" for m in marks) else PLACES  # a post's header is its heading
    if not marks or any(p not in places and p not in marks for p in parts):
        return ""
    return "talk" if any(TALK.fullmatch(m) for m in marks) else "name"


def _attributes(raw: str) -> tuple[str, str]:
    """Generalised classes, and what kind of noise a class, id or role marks."""
    classes, kinds = "", set()
    for k, v in ATTRIBUTE.findall(raw):
        k, v = k.lower(), v.strip("\"'")
        if k == "class":
            classes = ".".join(sorted({DIGITS.sub("#", c.lower().replace(">", "")) for c in v.split()}))
        if k in ("class", "id", "role"):
            kinds.update(map(_noise, v.split()))
        elif k == "hidden" or v.lower() == "true":
            kinds.add("name")
    return classes, "talk" if "talk" in kinds else "name" if "name" in kinds else ""


@dataclass
class Page:
    """Blocks of a page and the containers around them.  Equal paths are one node of a tree (0: the page itself), so the work
    on a page grows with its size alone, however deep it is nested."""
    labels: list[str]  # of each path node: tag and classes
    above: list[int]  # the node one container out
    ids: dict[tuple[int, str], int]  # (node above, label): node
    node: list[int]  # path node of each container element (0: the page)
    parent: list[int]  # the container element around it
    blocks: list[tuple[int, str, int]]  # container element, text, characters of link text; in page order

    def path(self, n: int) -> str:
        out = []
        while n > 0:
            out.append(self.labels[n])
            n = self.above[n]
        return ">".join(reversed(out))

    def find(self, path: str) -> int | None:
        n: int | None = 0
        for label in path.split(">") if path else ():
            n = self.ids.get((n, label))
            if n is None:
                return None
        return n

    def instances(self, n: int) -> list[int]:
        """Of each container element, the element on path node ``n`` that holds it, or -1."""
        own: list[int] = []
        for e, at in enumerate(self.node):
            own.append(e if at == n else own[self.parent[e]] if e else -1)
        return own


def _left_in(kinds: list[str], outer: list[int], landmarks: list[tuple[bool, int]], found: list[tuple]) -> list[bool]:
    """Whether each left-out element, and all around it, count as part of the page; ``kinds``: why it is left out, ``outer``:
    the next one around it (-1: none), ``landmarks``: whether it is main, and the innermost left-out element, of each main and
    article, ``found``: blocks whose last field is that element."""
    kept: set[int] = set()

    def keep(e: int) -> None:
        while e >= 0 and e not in kept:
            kept.add(e)
            e = outer[e]

    def whole(good) -> list[bool]:
        out: list[bool] = []
        for e, o in enumerate(outer):
            out.append(bool(good(e)) and (o < 0 or out[o]))
        return out

    for main, e in landmarks:
        if main:
            keep(e)
    own = any(e < 0 or e in kept for _, e in landmarks)
    if not own:
        fits = whole(lambda e: kinds[e] in ("name", "form") or e in kept)
        for _, e in landmarks:
            if fits[e]:
                keep(e)
                own = True
    if not own:
        weak = whole(lambda e: kinds[e] in ("name", "form"))
        total, inside = 0, [0] * len(kinds)
        for _, text, link_chars, e in found:
            if e < 0 or weak[e]:
                plain = max(0, len(text) - link_chars)
                total += plain
                if e >= 0:
                    inside[e] += plain
        for e in range(len(kinds) - 1, -1, -1):
            if outer[e] >= 0:
                inside[outer[e]] += inside[e]
        kept.update(e for e, n in enumerate(inside) if 2 * n > total)
        good = whole(kept.__contains__)
        if not any(e < 0 or good[e] for *_, e in found):
            kept.update(e for e, kind in enumerate(kinds) if kind in ("name", "form", "talk"))
    return whole(kept.__contains__)


def blocks(html: str) -> Page:
    """The page's blocks that are not left out."""
    found: list[tuple[int, str, int, int]] = []
    page = Page([""], [-1], {}, [0], [-1], [])
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, opaque, left out, container
    places: dict[str, list[int]] = defaultdict(list)  # tag: its places on the stack
    text: list[str] = []
    kinds: list[str] = []
    outer: list[int] = []
    landmarks: list[tuple[bool, int]] = []
    element, around, links, skipped, link_chars, at = 0, -1, 0, 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        if text:
            own = " ".join(unescape("".join(text)).split())
            if own:
                found.append((element, own, link_chars, around))
            text.clear()
        link_chars = 0

    def close(depth: int) -> None:
        nonlocal skipped, element, around
        while len(stack) > depth:
            tag, opaque, left_out, container = stack.pop()
            places[tag].pop()
            skipped -= opaque
            if left_out:
                around = outer[around]
            if container:
                element = page.parent[element]

    def last(*tags: str) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def add(piece: str) -> None:
        nonlocal link_chars
        if piece and not skipped:
            text.append(piece)
            if links:
                link_chars += len(piece.strip())

    for m in TOKEN.finditer(html):
        add(html[at:m.start()])
        at = m.end()
        end, tag, raw = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not tag:
            if m[1]:
                add(" ")
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if end else 1
        elif tag == "br":
            add(" ")
        elif tag in CONTAINERS or tag in BLOCKS or tag in SKIPPED_TAGS:
            flush()
            depth = last(tag)
            if end:
                if depth >= 0:
                    close(depth)
                    links = 0
                continue
            para = last("p")
            if para >= 0:
                close(para)  # a block ends an open paragraph
            elif tag in ("li", "dt", "dd", "td", "th", "tr") and depth >= 0 and last("ul", "ol", "dl", "table") < depth:
                close(depth)
            classes, noise = _attributes(raw) if raw.strip() else ("", "")
            if tag in ("article", "main") and not skipped and (tag == "main" or not noise):
                landmarks.append((tag == "main", around))
            if tag in ("body", "html", "article", "main"):
                noise = ""
            if tag == "hr":
                continue
            opaque = tag in OPAQUE_TAGS
            kind = "" if opaque else noise or "form" if tag == "form" else "tag" if tag in SKIPPED_TAGS else noise
            container = tag in CONTAINERS
            places[tag].append(len(stack))
            stack.append((tag, opaque, bool(kind), container))
            skipped += opaque
            if kind:
                outer.append(around)
                around = len(kinds)
                kinds.append(kind)
            if container:
                key = page.node[element], f"{tag}.{classes}" if classes else tag
                if key not in page.ids:
                    page.ids[key] = len(page.labels)
                    page.labels.append(key[1])
                    page.above.append(key[0])
                page.node.append(page.ids[key])
                page.parent.append(element)
                element = len(page.node) - 1
    add(html[at:])
    flush()
    kept = _left_in(kinds, outer, landmarks, found) if kinds else []
    page.blocks = [(e, own, n) for e, own, n, inside in found if inside < 0 or kept[inside]]
    return page


def best_path(page: Page) -> tuple[str, float] | None:
    """The best container path and its score: a block counts wholly for its own container, half for the next one out, and so
    on; of equal scores the first path in page order.  None without blocks."""
    scores, held = [0.0] * len(page.labels), [False] * len(page.labels)
    for e, text, link_chars in page.blocks:
        scores[page.node[e]] += len(text) - 3 * link_chars
        held[page.node[e]] = True
    for n in range(len(scores) - 1, 0, -1):
        scores[page.above[n]] += scores[n] / 2
        held[page.above[n]] |= held[n]
    if not held[0]:
        return None
    best = max(s for s, h in zip(scores, held) if h)
    return page.path(next(n for n, s in enumerate(scores) if held[n] and s == best)), best


def _path_of(page: Page, host_path: str | None) -> str | None:
    """The host's path if the containers on it have half or more of the page's scored text, else the page's own best one."""
    n = page.find(host_path) if host_path is not None else None
    if n is not None:
        own = page.instances(n)
        worth = [(max(0, len(text) - 3 * link_chars), own[e] >= 0) for e, text, link_chars in page.blocks]
        if any(i for _, i in worth) and 2 * sum(w for w, i in worth if i) >= sum(w for w, _ in worth):
            return host_path
    best = best_path(page)
    return best[0] if best else None


def _asked(page: Page, path: str) -> list[tuple[int, int, int, int, int, int, int]]:
    """Blocks that the host's pages decide on: those beside the containers on ``path``, and those inside where there are several.
    (place, container on the path or -1, digest of the own path, digest of the text, digest of the page's longest other text,
    characters, characters of link text)."""
    own = page.instances(page.find(path))
    several = len({own[e] for e, *_ in page.blocks} - {-1}) > 1
    asked = [(k, own[e]) for k, (e, *_) in enumerate(page.blocks) if own[e] < 0 or several]
    if not asked:
        return []
    of_path = [_digest("")]
    for n in range(1, len(page.labels)):
        of_path.append(_digest(f"{of_path[page.above[n]]}>{page.labels[n]}"))
    texts = {text for _, text, _ in page.blocks}
    longest = sorted(texts, key=lambda t: (len(t), t))[-2:]
    out = []
    for k, inside in asked:
        e, text, link_chars = page.blocks[k]
        other = next((t for t in reversed(longest) if t != text), "")
        out.append((k, inside, of_path[page.node[e]], _digest(text), _digest(other), len(text), min(len(text), link_chars)))
    return out


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: most votes, then the higher score, then the path's order.  ``pages``: host, html."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "html"):
                rows = [(h, *best) for h, x in zip(part.column("host").to_pylist(), part.column("html").to_pylist())
                        if (best := best_path(blocks(x)))]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.float64()))],
                                          ["host", "path", "score"])

    votes = pages.mapInArrow(vote, "host string, path string, score double")
    sums = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct("n", F.round("score", 3), "path")).alias("path"))


ASKED = "host string, page string, place int, inside int, own_path long, text long, other long, chars long, link_chars long"


def asked_blocks(pages: DataFrame) -> DataFrame:
    """The blocks that the host's pages decide on, see ``_asked``.  ``pages``: host, page (digest of the html), html, path."""
    types = (pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 5)
    names = [x.split()[0] for x in ASKED.split(", ")]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "html"):
                rows = []
                for host, digest, html, path in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html", "path"))):
                    page = blocks(html)
                    path = _path_of(page, path)
                    if path is not None:
                        rows += [(host, digest, *x) for x in _asked(page, path)]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return pages.select("host", "page", "html", "path").mapInArrow(ask, ASKED)


def left_out(asked: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """host, page, places: the blocks of ``asked`` that leave, by what all pages of the host say.

    A text is repeated if the host has it beside ``repeats`` different longest other texts, so copies of a page do not repeat
    it.  A path is content if over half of the characters that the host's pages have there, beside the winning container, are
    neither repeated nor link text.  A block beside leaves if it is repeated, at least half link text, or its path is not content;
    a container on the winning path leaves if all its blocks are repeated and another one of the page is not so."""
    pairs = asked.select("host", "text", "other").distinct()
    repeated = pairs.groupBy("host", "text").count().filter(F.col("count") >= repeats).select("host", "text", F.lit(True).alias("repeated"))
    told = asked.join(repeated, ["host", "text"], "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    poor = F.col("repeated") | (2 * F.col("link_chars") > F.col("chars"))
    beside = told.filter("inside < 0")
    content = (beside.groupBy("host", "own_path")
               .agg((2 * F.sum(F.when(poor, 0).otherwise(F.col("chars") - F.col("link_chars"))) > F.sum("chars")).alias("content")))
    out = beside.join(content, ["host", "own_path"]).filter(poor | ~F.col("content")).select("host", "page", F.array("place").alias("places"))
    held = (told.filter("inside >= 0").groupBy("host", "page", "inside")
            .agg(F.bool_and("repeated").alias("stale"), F.collect_set("place").alias("places")))
    spare = (held.groupBy("host", "page")
             .agg(F.bool_and("stale").alias("none"), F.flatten(F.collect_list(F.when(F.col("stale"), F.col("places")))).alias("places"))
             .filter(~F.col("none") & (F.size("places") > 0)).select("host", "page", "places"))
    return out.unionByName(spare).groupBy("host", "page").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", repeats: int = REPEATS) -> DataFrame:
    """``id_col``, ``url_col``, text, path (the container path that the text was taken from)."""
    slim = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"), _host(pages[url_col]).alias("host"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    winners = cut_lineage(winning_paths(slim.select("host", "html")), "paths")  # its size decides how it is joined
    aimed = slim.join(winners, "host", "left").withColumn("page", F.md5(F.encode("html", "UTF-8")))
    asked = cut_lineage(asked_blocks(aimed), "asked")
    leaving = cut_lineage(left_out(asked, repeats), "leaving")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "html"):
                texts, paths = [], []
                for html, path, places in zip(*(part.column(c).to_pylist() for c in ("html", "path", "places"))):
                    page = blocks(html)
                    path = _path_of(page, path)
                    gone = set(places or ())
                    texts.append("\n".join(text for k, (_, text, _) in enumerate(page.blocks) if k not in gone))
                    paths.append(path)
                yield pa.record_batch([part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                                       pa.array(paths, pa.string())], ["id", "url", "text", "path"])

    schema = f"id {slim.schema['id'].dataType.simpleString()}, url string, text string, path string"
    return (aimed.join(leaving, ["host", "page"], "left").select("id", "url", "html", "path", "places").mapInArrow(take, schema)
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
