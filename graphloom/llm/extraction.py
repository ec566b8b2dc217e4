"""Main text of web pages by consensus host paths (operator 6).

Each page's containers are scored and its best one votes for its generalised
tag-class path; a host's pages are then extracted by the path that won there.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import chunks

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template xmp noembed noframes".split())
CONTAINERS = frozenset("html body main article section div td center".split())
BLOCKS = frozenset(
    "html body main article section div center p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th"
    " blockquote pre figure figcaption hr address details summary fieldset header footer nav aside form".split()
)
CLOSES_P = BLOCKS - frozenset("html body td th tr thead tbody tfoot caption".split())
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
APART_TAGS = frozenset("nav header footer aside form script style noscript template iframe textarea title head button select option svg menu dialog object".split())
APART_NAMES = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navbar navigation menu sidebar header footer masthead breadcrumb breadcrumbs"
    " cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup share sharing social related recommended comment comments reply replies"
    " respond disqus widget toolbar pagination pager copyright login search skip".split()
)
READERS = frozenset("comment comments reply replies respond disqus".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu".split())
STRAY = 2  # characters that may stand outside the main container: separators and the like

_ATTRIBUTE = r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+))?+"  # quotes inside an unquoted value are part of it
_BARE = _ATTRIBUTE.replace("(", "(?:").replace("(?:?:", "(?:")
_MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|{_BARE})*+)>|<[!?][^>]*(?:>|\Z)|</[^A-Za-z>][^>]*(?:>|\Z)|<(?=/?[A-Za-z]).*\Z", re.S)
_ATTR = re.compile(_ATTRIBUTE)
_PARTS = re.compile(r"[\W\d_]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """Elements (parent, path, whether set apart) and pieces of text (element, block, text, whether in a link)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])  # of the nearest container; 0: none
    names: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])  # of each path: the path above and its own tag with classes
    known: dict[tuple[int, str], int] = field(default_factory=dict)
    apart: list[bool] = field(default_factory=lambda: [False])
    pieces: list[tuple[int, int, str, bool]] = field(default_factory=list)

    def path_below(self, path: int, name: str) -> int:
        """A path's number: deep pages hold each step once."""
        at = self.known.get((path, name))
        if at is None:
            at = self.known[(path, name)] = len(self.names)
            self.names.append((path, name))
        return at

    def written(self, path: int) -> str:
        steps = []
        while path:
            path, name = self.names[path]
            steps.append(name)
        return "".join(f">{x}" for x in reversed(steps))

    def number(self, written: str) -> int | None:
        """The number of a written path, None if the page has no such."""
        path = 0
        for name in written.split(">")[1:]:
            path = self.known.get((path, name))
            if path is None:
                return None
        return path


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for k, v in _ATTR.findall(raw):
        out.setdefault(k.lower(), v[1:-1] if v[:1] in ("'", '"') else v)
    return out


def _named_apart(names: str) -> int:
    """1 if a whole class or id (or each of its parts) is a name of parts set apart, 2 if one of readers' parts, else 0."""
    found = 0
    for name in names.lower().split():
        parts = [x for x in _PARTS.split(name) if x]
        if parts and all(x in APART_NAMES for x in parts):
            found = max(found, 1 + (not READERS.isdisjoint(parts)))
    return found


def _set_apart(page: Page, named: dict[int, int]) -> None:
    """Sets elements apart by their names, unless they hold most of the unlinked text (all of it for readers' parts)."""
    own = [0] * len(page.tag)
    for node, _, piece, link in page.pieces:
        if not page.apart[node] and not link:
            own[node] += len("".join(piece.split()))
    total = sum(own)
    for i in range(len(own) - 1, 0, -1):
        own[page.parent[i]] += own[i]
    for i in range(1, len(own)):
        how = named.get(i, 0)
        page.apart[i] |= page.apart[page.parent[i]] or (how == 1 and 2 * own[i] <= total) or (how == 2 and own[i] < total - STRAY)


def parse(text: str) -> Page:
    """Lenient one-pass parse: unclosed, stray and cut-off tags are no errors."""
    page, stack, at, block = Page(), [0], 0, 0
    open_at: dict[str, list[int]] = {}  # places on the stack of the open elements of each tag
    named: dict[int, int] = {}
    n = len(text)
    links = 0

    def put(piece: str) -> None:
        if piece:
            page.pieces.append((stack[-1], block, entities.unescape(piece) if "&" in piece else piece, links > 0))

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag = page.tag[stack.pop()]
            open_at[tag].pop()
            links -= tag == "a"

    def nearest(tags: frozenset[str] | set[str]) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    while at < n:
        m = _MARKUP.search(text, at)
        if not m:
            put(text[at:])
            break
        put(text[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            block += 1
        if m[1]:
            if open_at.get(tag):
                close(open_at[tag][-1])
            continue
        if tag == "br" or tag in ("td", "th"):
            put(" ")
        if tag in CLOSES_P or tag in PEERS:
            ends, scope = ({"p"}, CONTAINERS | {"table"}) if tag not in PEERS else (PEERS[tag] | {"p"}, SCOPES[tag])
            while (i := nearest(ends)) and i > nearest(scope):
                t = page.tag[stack[i]]
                close(i)
                if t != "p":
                    break
        attrs = _attributes(m[3]) if "=" in m[3] else {}
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        above = stack[-1]
        apart = page.apart[above] or tag in APART_TAGS or "hidden" in attrs or attrs.get("role", "").lower() in APART_ROLES
        if tag in VOID:
            continue
        if not apart and names != " " and tag not in ("html", "body", "main", "article"):
            how = _named_apart(names)
            if how:
                named[len(page.tag)] = how
        path = page.path[above]
        if tag in CONTAINERS:
            kinds = sorted({_DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").replace(">", "_").split()})
            path = page.path_below(path, ".".join([tag, *kinds]))
        page.parent.append(above)
        page.tag.append(tag)
        page.path.append(path)
        page.apart.append(apart)
        if m[3].endswith("/") and tag in ("svg", "path", "iframe"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(text, at)
            at = end.end() if end else n
            continue
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(len(page.tag) - 1)
        links += tag == "a"
    if named:
        _set_apart(page, named)
    return page


def best_path(page: Page) -> str:
    """Path of the deepest container outside which all text is set apart, but for STRAY characters ('' if there is none)."""
    own = [0] * len(page.tag)
    for node, _, piece, _ in page.pieces:
        if not page.apart[node]:
            own[node] += len("".join(piece.split()))
    total = sum(own)
    for i in range(len(own) - 1, 0, -1):
        own[page.parent[i]] += own[i]
    best = 0
    for i in range(1, len(own)):
        if page.tag[i] in CONTAINERS and not page.apart[i] and own[i] >= total - STRAY and 2 * own[i] > total:
            best = i  # a later one that qualifies lies inside: two shares above one half can't stand side by side
    return page.written(page.path[best])


def text_at(page: Page, path: str) -> str | None:
    """Text of the containers at a path, blocks joined by an empty line; None if the page has no such container."""
    inside = [False] * len(page.tag)
    at = page.number(path)
    if at is None:
        return None
    found = at == 0
    inside[0] = found
    for i in range(1, len(inside)):
        hit = page.tag[i] in CONTAINERS and page.path[i] == at and not page.apart[i]
        found |= hit
        inside[i] = hit or inside[page.parent[i]]
    if not found:
        return None
    blocks: dict[int, list[str]] = {}
    for node, block, piece, _ in page.pieces:
        if inside[node] and not page.apart[node]:
            blocks.setdefault(block, []).append(piece)
    texts = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(t for t in texts if t)


def extract(text: str, path: str | None = None) -> str:
    """Text at the host's path, or at the page's own best one where it lacks that."""
    page = parse(text)
    out = text_at(page, path) if path else None
    return out if out is not None else text_at(page, best_path(page)) or ""


def host_of(url: str) -> Column:
    """Host of a URL in lower case; '' for null and for what has none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): per host the path most of its pages vote for, of equals the first by name."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "html"):
                paths = [best_path(parse(x)) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(paths, pa.string())], names=["host", "path"])

    votes = pages.select(host_of("url").alias("host"), "html").where("html <> ''").mapInArrow(run, "host string, path string")
    counts = votes.where("path <> ''").groupBy("host", "path").agg(F.count("*").alias("n"))
    return counts.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "path")).alias("x")).select("host", "x.path")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    The text is that of the winning container: no parts set apart by tag, role, class or
    id (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader
    comments; by class or id only if the whole name says so and the part doesn't hold most of the text), character references decoded, white space inside a block one space,
    blocks in page order joined by an empty line.

    Pages of any length and depth are read whole, in linear time.  Null and empty pages have an empty text and no vote; pages without a host vote
    together.  Repeated rows each get a row; other columns are ignored; an empty table gives no rows.
    """
    # Hosts are looked up for small rows; pages themselves are dealt by page, not by host, which may hold a third of them.
    key = [F.xxhash64("page_id", "url").alias("_key"), host_of("url").alias("_host")]
    paths = pages.select(*key).distinct().join(host_paths(pages), F.col("_host") == F.col("host")).select("_key", "_host", F.col("path").alias("_path"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *key)
    rows = rows.join(paths, ["_key", "_host"], "left").select("page_id", "url", "html", "_path")

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "html"):
                texts = [extract(x, p) if x else "" for x, p in zip(part.column("html").to_pylist(), part.column("_path").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_extract_text(spark, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
