"""Main text of web pages by consensus host paths.

First pass: every page's containers are scored (paragraph length and
punctuation, less links), and the page votes with the generalised tag-class
path of its best one, widened to the article around it. Spark adds the votes up by host. Second pass: the page is
extracted again from the containers on its host's path of most votes whose text holds at least ``SHARE`` of the worth
of the page's own article; a page without such a path keeps its own. Only a page whose own path most pages of the host
have and do not choose follows the host whatever the share. Pages without a host keep their own.

A page's own article is all of its containers on the widened path if that is an article or main element; else the
widened container and what stands beside it further up, less containers and blocks made mostly of links (and, at the
top of the page, containers without a paragraph). Paths are told apart by chained 64-bit hashes, so a deeply
nested page costs one number a container. A host's table holds the paths with at least ``MIN_VOTES`` of its votes
and those that most of its pages have and do not choose: its size does not grow with the pages.
"""

from __future__ import annotations

import html as entities
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*+)|[^>=])*+)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_DIGITS = re.compile(r"\d+")

#: Elements whose content is no text, up to their own end tag.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are never part of an article.
AWAY = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "header", "audio", "video",
        "canvas", "fieldset", "label", "option", "datalist"}
#: The same, told by a part of a class or id or by a role.
AWAY_PARTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
              "promotion", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
              "header", "masthead", "footer", "comment", "comments", "commentlist", "respond", "reply", "replies",
              "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup",
              "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
              "social", "related", "recommended", "widget", "widgets", "toolbar", "pagination", "pager", "search",
              "form", "disclaimer", "paywall", "skip"}
AWAY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "form"}
#: Parts that name what can be longer than the article; never the name of a wrapper around it while other text is left.
ASIDE_PARTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
               "promotion", "comment", "comments", "commentlist", "respond", "reply", "replies", "disqus", "cookie", "cookies",
               "consent", "gdpr", "related", "recommended", "disclaimer"}
#: Parts that say where or how large, not what: inside an article a name is judged whole, of the parts above and these.
PLAIN_PARTS = {"area", "article", "articles", "bar", "block", "blog", "bottom", "box", "button", "buttons", "col", "column",
               "container", "entry", "global", "google", "group", "header", "inner", "item", "items", "js", "latest", "left", "link",
               "links", "list", "main", "news", "outer", "page", "panel", "popular", "post", "posts", "reader", "recent", "right", "section",
               "site", "slot", "stories", "story", "top", "unit", "user", "v", "wp", "wrap", "wrapper"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_MODIFIERS = {"has", "with", "no", "without"}
GOOD_PARTS = {"article", "content", "post", "entry", "story", "main", "text", "body"}
CONTAINERS = {"body", "div", "section", "article", "main", "td", "center", "blockquote", "details"}
BLOCKS = CONTAINERS | AWAY | {
    "html", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot",
    "tr", "th", "caption", "pre", "figure", "figcaption", "address", "hr", "hgroup", "summary", "legend"} - {"label", "button"}
#: Start tags that end an open element of these kinds.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
#: Share of the worth of the page's own article that the text on a host's path must hold.
SHARE = 0.5
#: Share of its host's votes that a path needs to speak for other pages.
MIN_VOTES = 0.05
#: Characters of a block that make a container at the top of the page, beside the article, a part of it.
PARAGRAPH = 50
_SCOPES = {"ul", "ol", "dl", "table", "body", "article", "div", "section", "select"}


@dataclass
class Page:
    """Containers (path hash, parent, step of the path, tag, good parts) and text blocks (container, text, characters in links)."""

    paths: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    steps: list[str] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    bonus: list[float] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, container: int) -> str:
        steps = []
        while container > 0:
            steps.append(self.steps[container])
            container = self.parents[container]
        return "".join(f">{s}" for s in reversed(steps))


def _next(path: int, step: str) -> int:
    """Hash of a path with one more step."""
    return struct.unpack("<q", xxhash.xxh64_digest(struct.pack("<q", path) + step.encode("utf-8", "replace")))[0]


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _parts(names: str) -> list[str]:
    return [p.lower() for p in _PART.findall(names)]


def _is_away(tag: str, attributes: dict[str, str], parts: list[str], in_article: bool) -> str | None:
    """"" if the element is never part of an article; the form tag or the part of its names that tells so by name
    only, which may also stand on a wrapper around the article; else None."""
    if tag in ("html", "body", "article", "main"):
        return None
    if tag in AWAY and tag != "form" and not (tag == "header" and in_article):
        return ""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get(
            "style", "").replace(" ", "").lower() or attributes.get("role", "").lower() in AWAY_ROLES:
        return ""
    if tag == "form":
        return "form"
    if tag in HEADINGS or (in_article and tag not in BLOCKS):
        return None
    return _away_name(attributes) if in_article or tag not in BLOCKS else _away_part(parts, in_article)


def _away_part(parts: list[str], in_article: bool) -> str | None:
    before = ""
    for part in parts:
        if part in AWAY_PARTS and before not in _MODIFIERS and not (part == "header" and in_article):
            return part
        before = part
    return None


def _away_name(attributes: dict[str, str]) -> str | None:
    """The part that tells, if a whole class or id says nothing else."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [p for p in _parts(name) if not p.isdigit()]
        told = next((p for p in parts if p in AWAY_PARTS and p not in PLAIN_PARTS), None)
        if told and all(p in AWAY_PARTS or p in PLAIN_PARTS for p in parts):
            return told
    return None


def _wrappers(marks: list[tuple[int, str]], blocks: list[tuple[int, str, int, int]]) -> set[int]:
    """The marks (parent mark, kind) that stand on wrappers around the article: going down from the outermost, all of a
    kind that together hold most of the page's paragraph text (any text, if no other is left)."""
    sums, direct = [0] * len(marks), [False] * len(marks)
    visible = any(mark < 0 for _, _, _, mark in blocks)
    total = 0
    for least in ((25,) if visible else (25, 1)):
        for _, text, linked, mark in blocks:
            if len(text) >= least and 2 * linked <= len(text):
                total += len(text)
                if mark >= 0:
                    sums[mark] += len(text)
        if total:
            break
    for _, _, _, mark in blocks:
        if mark >= 0:
            direct[mark] = True
    children: dict[int, list[int]] = {}
    for k in range(len(marks) - 1, -1, -1):  # a mark comes after its parent
        parent = marks[k][0]
        children.setdefault(parent, []).append(k)
        if parent >= 0:
            sums[parent] += sums[k]
    neutral: set[int] = set()
    kinds: dict[str, list[int]] = {}
    fresh = children.get(-1, [])
    while total:
        for k in fresh:
            kinds.setdefault(marks[k][1], []).append(k)
        # only a kind with new marks can have come to hold most of the text
        most = [kind for kind in {marks[k][1] for k in fresh} if 2 * sum(sums[k] for k in kinds[kind]) > total
                and not (visible and kind in ASIDE_PARTS)]
        if not most:
            break
        found = kinds.pop(most[0])
        neutral.update(found)
        visible = visible or any(direct[k] for k in found)
        fresh = [c for k in found for c in children.get(k, ())]
    return neutral


def parse(source: str) -> Page:
    """One pass over the markup. Text that is never part of an article is left out; what only a form or a name
    tells so is marked, and left out unless the mark stands on a wrapper around the article."""
    page = Page([0], [-1], [""], [""], [0.0])  # container 0: the whole page
    # open elements: tag, container, whether its text is left out, whether in an article, whether a link, its mark
    stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, -1)]
    marks: list[tuple[int, str]] = []
    blocks: list[tuple[int, str, int, int]] = []
    buffers: dict[int, list[str]] = {}  # by mark
    linked: dict[int, int] = {}
    at = 0

    def flush() -> None:
        for mark, buffer in buffers.items():
            text = " ".join("".join(buffer).split())
            if text:
                blocks.append((stack[-1][1], text, linked.get(mark, 0), mark))
        buffers.clear()
        linked.clear()

    def take(text: str) -> None:
        if text and not stack[-1][2]:
            if "&" in text:
                text = entities.unescape(text)
            mark = stack[-1][5]
            buffers.setdefault(mark, []).append(text)
            if stack[-1][4]:
                linked[mark] = linked.get(mark, 0) + len(text.strip())

    find, end, last = _TOKEN.search, len(source), source.rfind(">")
    while at < end:
        m = find(source, at) if at <= last or source.find("<!--", at) >= 0 else None
        if m is None:
            take(source[at:])
            break
        take(source[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # an end tag
            if tag == "p" or tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if any(stack[j][0] in BLOCKS for j in range(k, len(stack))):
                        flush()
                    del stack[k:]
                    break
                if stack[k][0] in _SCOPES and tag in ("li", "p", "b", "i", "a", "em", "strong", "span", "dt", "dd"):
                    break
            continue
        if tag in RAW:
            if tag in ("svg", "math") and m[3].endswith("/"):  # foreign elements may be empty
                continue
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            take(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            flush()
            if stack[-1][0] == "p" or tag in _ENDS:
                ends = _ENDS.get(tag, set()) | {"p"}
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ends:
                        del stack[k:]
                        break
                    if stack[k][0] in _SCOPES:
                        break
            elif any(s[0] == "p" for s in stack[-4:]):  # inline elements inside an open paragraph
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
        _, container, away, in_article, link, mark = stack[-1]
        raw = m[3]
        attributes = _attributes(raw) if raw and not raw.isspace() else {}
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}" if attributes else ""
        parts = _parts(names) if names else []
        if not away:
            told = _is_away(tag, attributes, parts, in_article)
            if told:
                marks.append((mark, told))
                mark = len(marks) - 1
            elif told is not None:
                away = True
            elif mark >= 0 and tag in ("article", "main") and not in_article and _away_part(parts, False) is None:
                mark = -1  # the mark stood on a wrapper around an article
        if tag in CONTAINERS and not away:
            classes = ".".join(sorted(_DIGITS.sub("#", names).lower().split()))
            page.steps.append(f"{tag}.{classes}" if classes else tag)
            page.paths.append(_next(page.paths[container], page.steps[-1]))
            page.parents.append(container)
            page.tags.append(tag)
            page.bonus.append((25.0 if tag in ("article", "main") else 0.0)
                              + (15.0 if GOOD_PARTS.intersection(parts) else 0.0))
            container = len(page.paths) - 1
        if not raw.endswith("/") or tag in BLOCKS:
            stack.append((tag, container, away, in_article or tag in ("article", "main"), link or tag == "a",
                          mark))
    flush()
    neutral = _wrappers(marks, blocks) if marks else set()
    page.blocks = [block[:3] for block in blocks if block[3] < 0 or block[3] in neutral]
    return page


def worths(page: Page) -> list[tuple[int, float]]:
    """(container, worth) of the blocks: length and punctuation, less links."""
    long = [b for b in page.blocks if len(b[1]) >= 25] or page.blocks
    return [(container, (1 + text.count(",") + min(len(text) / 100, 3)) * max(0.0, 1 - linked / len(text)))
            for container, text, linked in long]


def best_container(page: Page) -> tuple[int, float]:
    """The container of highest score, and the score; -1 if there is no text."""
    scores: dict[int, float] = {}
    for container, worth in worths(page):
        for share in (1.0, 0.5, 0.25):
            if container < 0:
                break
            scores[container] = scores.get(container, 0.0) + worth * share
            container = page.parents[container]
    if not scores:
        return -1, 0.0
    best = max(scores, key=lambda c: (scores[c] + (page.bonus[c] if scores[c] > 0 else 0), -c))
    return best, scores[best] + page.bonus[best]


def _spans(page: Page) -> tuple[dict[int, list[int]], list[int], list[int], list[int]]:
    """By container: its own blocks; characters, characters in links and longest block without most of it in links,
    each with everything below."""
    own: dict[int, list[int]] = {}
    n = len(page.paths)
    size, linked, longest = [0] * n, [0] * n, [0] * n
    for k, (c, text, links) in enumerate(page.blocks):
        own.setdefault(c, []).append(k)
        size[c] += len(text)
        linked[c] += links
        if 2 * links <= len(text):
            longest[c] = max(longest[c], len(text))
    for c in range(n - 1, 0, -1):  # a container comes after its parent
        up = page.parents[c]
        size[up] += size[c]
        linked[up] += linked[c]
        longest[up] = max(longest[up], longest[c])
    return own, size, linked, longest


def whole(page: Page, best: int) -> tuple[int, set[int]]:
    """(container, blocks) of the whole article around ``best``: the nearest article or main, with all others on its
    path; without one, everything on the way up that is not made mostly of links. At the top of the page
    another container needs a paragraph of its own. The container is the highest one that lost nothing."""
    at = best
    while at >= 0:
        if page.tags[at] in ("article", "main"):
            same = {c for c, path in enumerate(page.paths) if path == page.paths[at]}
            return at, _blocks_under(page, same)
        at = page.parents[at]
    own, size, linked, longest = _spans(page)
    children: dict[int, list[int]] = {}
    for c, parent in enumerate(page.parents):
        children.setdefault(parent, []).append(c)
    core, at, intact = best, best, True
    chosen, extra = {best}, set()
    while page.parents[at] >= 0:
        below, at = at, page.parents[at]
        top = page.tags[at] in ("", "body")
        beside = [c for c in children.get(at, ()) if c != below and size[c]]
        taken = [c for c in beside if 2 * linked[c] <= size[c] and (not top or longest[c] >= PARAGRAPH)]
        direct = own.get(at, [])
        plain = [k for k in direct if 2 * page.blocks[k][2] <= len(page.blocks[k][1])]
        chosen.update(taken)
        extra.update(plain)
        if not beside and not direct:
            continue
        intact = intact and len(taken) == len(beside) and len(plain) == len(direct) and not (top and beside)
        if intact:
            core = at
    return core, _blocks_under(page, chosen) | extra


def _blocks_under(page: Page, chosen: set[int]) -> set[int]:
    inside = under(page, chosen)
    return {k for k, (c, _, _) in enumerate(page.blocks) if inside[c]}


def under(page: Page, chosen: set[int]) -> list[bool]:
    """Whether each container is one of the chosen or below."""
    inside = [False] * len(page.paths)
    for c, parent in enumerate(page.parents):
        inside[c] = c in chosen or (parent >= 0 and inside[parent])
    return inside


def text_of(page: Page, blocks: set[int]) -> str:
    """The blocks in page order."""
    return " ".join(page.blocks[k][1] for k in sorted(blocks))


def own_article(page: Page) -> tuple[int, float, set[int]]:
    """The best container, widened to the whole article, its score and the article's blocks; -1 if there is no text."""
    best, score = best_container(page)
    if best < 0:
        return -1, 0.0, set()
    at, blocks = whole(page, best)
    return at, score, blocks


def vote(source: str | None) -> tuple[str | None, float]:
    """Path of the page's own article and its score."""
    page = parse(source or "")
    own, score, _ = own_article(page)
    return (page.path(own), score) if own >= 0 else (None, 0.0)


def ballot(source: str | None) -> list[tuple[int, str | None, float]]:
    """(path hash, the path if the page votes for it, score) of each path that holds blocks at most
    three containers above them, and of the path voted for."""
    page = parse(source or "")
    at, score, _ = own_article(page)
    if at < 0:
        return []
    own = page.paths[at]
    seen = {own}
    for container in {b[0] for b in page.blocks}:
        for _ in range(3):
            if container < 0:
                break
            seen.add(page.paths[container])
            container = page.parents[container]
    return [(path, page.path(at) if path == own else None, score if path == own else 0.0) for path in seen]


def extract(source: str | None, paths: str | list[int] | None, disowned: list[int] = ()) -> str:
    """Main text. ``paths``: the host's path hashes, most votes first, or one path, or none;
    ``disowned``: those that most of the host's pages have and do not choose."""
    page = parse(source or "")
    at, _, blocks = own_article(page)
    if at < 0:
        return ""
    own = page.paths[at]
    if isinstance(paths, str):
        h = 0
        for step in paths.split(">")[1:]:
            h = _next(h, step)
        paths = [h]
    wanted = set(paths or ())
    on: dict[int, set[int]] = {}
    for c, path in enumerate(page.paths):
        if path in wanted:
            on.setdefault(path, set()).add(c)
    overruled = own in disowned
    worth = worths(page)

    def held(chosen: set[int]) -> float:
        inside = under(page, chosen)
        return sum(w for c, w in worth if inside[c])

    need = SHARE * held({at})
    for path in paths or ():
        if path == own and not overruled:
            break
        if path in on and path != own and (overruled or held(on[path]) >= need):
            text = text_of(page, _blocks_under(page, on[path]))
            if text:
                return text
    return text_of(page, blocks)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            found = [(host, *x) for host, h in zip(part.column(0).to_pylist(), part.column(1)) for x in ballot(h.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()),
                 pa.array([x[2] for x in found], pa.string()), pa.array([x[3] for x in found], pa.float64())],
                names=["host", "path", "name", "score"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h.as_py(), paths.as_py(), disowned.as_py() or ())
                 for h, paths, disowned in zip(batch.column(2), batch.column(3), batch.column(4))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_of(url):
    """Lower-case host of a url; '' for a url without one (or null)."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, paths, disowned): each host's path of most votes by name; the hashes of its paths with at least
    ``MIN_VOTES`` of its votes that more than one page has (or the first), most votes first, ties to the higher score,
    then to the smaller hash; those that at least half of its pages have and fewer than half of these choose. Pages without a host do
    not vote. Votes are added up inside tasks before they move; a host's lists are cut from its rows by
    shares of its votes, so no list grows with its pages."""
    votes = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    votes = votes.where("host <> ''").mapInArrow(_votes, "host string, path long, name string, score double")
    sums = (votes.groupBy("host", "path").agg(F.count("name").alias("n"), F.count("*").alias("seen"), F.max("name").alias("name"),
                                              F.sum(F.round("score").cast("long")).alias("score")).where("n > 0"))
    sums = stored(sums, "host-votes")
    totals = sums.groupBy("host").agg(F.sum("n").alias("votes"), F.min(F.struct(
        (-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path")).alias("first"))
    rows = sums.join(totals, "host")
    order = F.struct((-F.col("n")).alias("by_n"), (-F.col("score")).alias("by_score"), "path")
    first = F.col("path") == F.col("first.path")
    speaks = first | ((F.col("seen") > 1) & (F.col("n") >= MIN_VOTES * F.col("votes")))
    away = (2 * F.col("n") < F.col("seen")) & (2 * F.col("seen") >= F.col("votes"))
    return rows.where(speaks | away).groupBy("host").agg(
        F.max(F.when(first, F.col("name"))).alias("path"),
        F.transform(F.sort_array(F.collect_list(F.when(speaks, order))), lambda x: x["path"]).alias("paths"),
        F.collect_list(F.when(away, F.col("path"))).alias("disowned"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: the main text of the whole html.

    A null or empty html gives an empty text; pages without a host keep their own article; repeated rows are extracted each (and
    vote each); null ids pass through; other columns are ignored; an empty table
    gives no rows. The hosts' paths are written once, when called.
    """
    paths = stored(host_paths(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col)).alias("host"))
    return rows.join(paths.drop("path"), "host", "left").select("page_id", "url", "html", "paths", "disowned").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long")
