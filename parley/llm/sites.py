"""Main text of web pages, by a style tree of each site and the importance of its branches."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import materialize

#: A branch whose importance is below this is removed.
LEAST_IMPORTANCE = 0.3
#: The same for branches of elements that name themselves as main text, and of those whose class only hints at noise.
LEAST_MAIN = 0.1
LEAST_HINTED = 0.6
#: Share of the presentation in a branch's importance; the rest is its content's.
PRESENTATION = 0.25
#: A site shows no template before it has so many different pages.
LEAST_PAGES = 4
#: Removed branches of all sites that are broadcast; beyond that they are joined.
BROADCAST_BRANCHES = 10_000

# HTML elements by how they take part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose inside is not read as markup, or never shown as text.
RAW = frozenset("script style title textarea noscript template iframe svg math object select button option".split())
NO_TEXT = frozenset("nav footer aside form menu dialog".split())
HEADERS = frozenset(["header"])
MAIN = frozenset("article main".split())
# An open element (first) is closed by the start of one of these, unless it stands outside the last group.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset(["tr", "table"])),
    "th": (frozenset("td th".split()), frozenset(["tr", "table"])),
}
# Words in class, id or role that name what is no main text.
NOISE = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu sidebar breadcrumb "
    "breadcrumbs footer cookie cookies consent notice gdpr popup modal newsletter subscribe signup login share sharing "
    "social related recommended comment comments disqus replies pagination pager search".split()
)

# Words that only say which part of a page such a name is about.
FRAME = frozenset(
    "site page main top bottom left right primary secondary global box list wrapper container slot block unit section "
    "widget area links link posts post items item bar panel inner content form".split()
)
#: How far names speak against a block: not at all, as a hint, by a class, by its element.
CLEAR, HINTED, NAMED, ELEMENT = range(4)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")
_HAS_MAIN = re.compile(r"<(?:article|main)\b", re.IGNORECASE | re.ASCII)
_ENDS = {tag: re.compile(f"</{tag}", re.IGNORECASE | re.ASCII) for tag in RAW}


@dataclass
class Block:
    """Text between two block borders, with the branch it hangs on and what names say about it."""

    path: str
    text: str
    rank: int
    main: bool


def _label(tag: str, attributes: str) -> tuple[str, int, bool, bool]:
    """An element's name in the style tree, with its classes but without numbers, and what these names say.

    A class speaks for noise if it is made of words for noise and of ``FRAME`` only; any other class with such a
    word (as in ``has-sidebar``) is a hint. The last two: whether a class is that of a header, or of main text.
    """
    if "=" not in attributes:
        return tag, CLEAR, False, False
    rank, header, main = CLEAR, False, False
    names = []
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        names.append(" ".join(sorted(_NAME.findall(value))))
        for one in value.split():
            words = _NAME.findall(one)
            noise = [w for w in words if w in NOISE]
            if noise:
                rank = max(rank, NAMED if all(w in NOISE or w in FRAME for w in words) else HINTED)
            header = header or ("header" in words and all(w in FRAME for w in words if w != "header"))
            main = main or words == ["main"]
    return (f"{tag}[{';'.join(names)}]" if names else tag), rank, header, main


def blocks(page: str) -> Iterator[Block]:
    """The blocks of a page in their order, with references decoded and white space made one blank.

    Unclosed paragraphs and items end where the next one begins; an end tag without
    a start is a border only; elements that mark words inside a block are no borders.
    """
    # Open elements: tag, path, what names say against it, whether in main text.
    stack: list[tuple[str, str, int, bool]] = [("", "", CLEAR, False)]
    pieces: list[str] = []

    def ready() -> Iterator[Block]:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            _, path, rank, main = stack[-1]
            yield Block(path, text, rank, main)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else size]
        if text:
            pieces.append(html.unescape(text) if "&" in text else text)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in RAW and not m[1]:
            if m[3].endswith("/"):
                continue
            end = _ENDS[tag].search(page, at)
            # What is never closed goes on to the end only where it hides text; else it is skipped.
            if end:
                close = page.find(">", end.end())
                at = close + 1 if close >= 0 else size
            elif tag in ("script", "style"):
                at = size
            continue
        if tag in ("br", "td", "th"):
            pieces.append(" ")
        if tag not in BLOCKS:
            continue
        yield from ready()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if tag in IMPLIED:
            closed, scope = IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in closed:
                    del stack[i:]
        if tag in VOID:
            continue
        label, named, header, says_main = _label(tag, m[3])
        _, path, rank, main = stack[-1]
        main = main or tag in MAIN or says_main
        if tag in ("html", "body", *MAIN):
            named = CLEAR
        if tag in NO_TEXT or (not main and (tag in HEADERS or header)):
            named = ELEMENT
        stack.append((tag, f"{path}/{label}", max(rank, named), main))
    yield from ready()


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def _kind(block: Block) -> str:
    """Blocks of a path are in the tree as main text, as hinted at, or as neither."""
    return "hinted" if block.rank == HINTED else "main" if block.main else "plain"


def branch_of(block: Block) -> int:
    """The number by which a branch is known in the list of what is removed."""
    return _hash(f"{_kind(block)} {block.path}")


def _branches(page: str) -> tuple[int, list[tuple[str, str, int, list[int], int]]]:
    """A hash of a page's text (its main text, if it names one), and its branches.

    For each branch: its path, kind and number, its contents, and how the blocks beside it are presented.
    """
    found = [b for b in blocks(page) if b.rank < NAMED]
    contents: dict[tuple[str, str, int], dict[int, None]] = defaultdict(dict)
    shapes: dict[str, list[str]] = defaultdict(list)
    whole = xxhash.xxh64()
    named = any(b.main for b in found)
    for b in found:
        if b.main or not named:
            whole.update(b.text.encode())
        contents[b.path, _kind(b), branch_of(b)][_hash(b.text)] = None
        shapes[b.path.rpartition("/")[0]].append(b.path)
    beside = {parent: _hash(" ".join(paths)) for parent, paths in shapes.items()}
    value = whole.intdigest()
    out = [(*at, list(c), beside[at[0].rpartition("/")[0]]) for at, c in contents.items()]
    return value - (1 << 64) if value >> 63 else value, out


def site_of(url: str):
    """The host of a URL in lower case, without user and port; empty where there is none."""
    host = F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(host)


_BRANCH = ["host", "path", "kind", "branch"]


def _nodes(pages: DataFrame, url: str, page: str) -> DataFrame:
    """One row for each branch of each different page of a site: its contents and the shape beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (host, whole, *branch)
                for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for whole, found in [_branches(text or "")]
                for branch in found
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = ["host", "whole", "path", "kind", "branch", "contents", "shape"]
    parsed = pages.select(site_of(url).alias("host"), F.col(f"`{page}`").alias("html")).mapInArrow(
        run, "host string, whole long, path string, kind string, branch long, contents array<long>, shape long"
    )
    nodes = parsed.groupBy(*_BRANCH, "whole").agg(F.min(F.struct("contents", "shape")).alias("n"))
    return materialize(nodes.select(*_BRANCH, "n.contents", "n.shape"), "branches")


def _contents(nodes: DataFrame) -> DataFrame:
    """On how many different pages a branch has each of its texts (column ``n``)."""
    return nodes.select(*_BRANCH, F.explode("contents").alias("text")).groupBy(*_BRANCH, "text").agg(F.count("*").alias("n"))


def _tree(nodes: DataFrame) -> DataFrame:
    shapes = nodes.groupBy(*_BRANCH, "shape").agg(F.count("*").alias("n"))
    shapes = shapes.groupBy(*_BRANCH).agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("spread")
    )
    texts = _contents(nodes).groupBy(*_BRANCH).agg(F.avg(F.log(F.col("n").cast("double"))).alias("shared"))
    base = F.log(F.col("pages").cast("double"))
    presentation = (base - F.col("spread") / F.col("pages")) / base
    content = 1 - F.col("shared") / base
    one = F.col("pages") < 2
    return (
        shapes.join(texts, _BRANCH)
        .withColumn("presentation", F.when(one, F.lit(1.0)).otherwise(presentation))
        .withColumn("content", F.when(one, F.lit(1.0)).otherwise(content))
        .withColumn("importance", PRESENTATION * F.col("presentation") + (1 - PRESENTATION) * F.col("content"))
        .drop("spread", "shared")
    )


def style_tree(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Columns ``host``, ``path``, ``kind``, ``branch``, ``pages``, ``presentation``, ``content`` and ``importance``.

    Pages of a site are laid over one another: a branch is a path of elements with
    their classes, apart for main text, for text that a class hints at as noise, and for all other. With m different
    pages that have it, the importance of its
    presentation is the entropy, to base m, of the sequences of blocks beside it; that of its content is 1
    less the mean, over its texts, of the entropy to base m of the pages
    that have the text: a text on all pages says nothing. Pages with equal main text count once, so a
    group of copies is no template; of what else they have, the least counts. Branches of elements
    that name themselves as no main text are decided by that and are not in the tree.
    """
    return _tree(_nodes(pages, url, page))


def _removed(nodes: DataFrame) -> DataFrame:
    """Numbers of the branches of low importance of each host, and of the single texts that are low in others.

    A text's importance is 1 less the entropy, to base m, of the pages that have it. Single texts of main text stay.
    """
    tree = _tree(nodes).where(F.col("pages") >= LEAST_PAGES)
    least = F.when(F.col("kind") == "main", LEAST_MAIN).when(F.col("kind") == "hinted", LEAST_HINTED).otherwise(LEAST_IMPORTANCE)
    branches = tree.where(F.col("importance") < least).select("host", F.col("branch").alias("number"))
    # Most texts are on one page; only those on several can be low.
    texts = _contents(nodes.where("kind <> 'main'")).where(F.col("n") >= 2)
    low = texts.join(tree.select("host", "branch", "pages"), ["host", "branch"])
    low = low.where(1 - F.log(F.col("n").cast("double")) / F.log(F.col("pages").cast("double")) < LEAST_IMPORTANCE)
    return branches.union(low.select("host", F.col("branch").bitwiseXOR(F.col("text"))))


def main_text(page: str, removed: set[int]) -> str:
    """The blocks that are left, in their order with a blank between them.

    Branches and texts that the site's tree finds of low importance are taken out of every page. Elements and
    classes that name themselves as something else go too, but for a page without main elements that would
    be left without text. Main elements are the page's text if they hold half of what is left or more;
    else they are no more than other parts.
    """
    found = [b for b in blocks(page) if b.rank < ELEMENT]
    kept = [b for b in found if b.rank < NAMED]
    if not kept and not any(b.main for b in found) and not _HAS_MAIN.search(page):
        kept = found
    if removed:
        numbered = [(b, branch_of(b)) for b in kept]
        kept = [b for b, n in numbered if n not in removed and n ^ _hash(b.text) not in removed]
    main = [b for b in kept if b.main]
    if 2 * sum(len(b.text) for b in main) >= sum(len(b.text) for b in kept):
        kept = main
    return " ".join(b.text for b in kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Columns key, url, ``text`` (empty if there is none) and ``n_chars`` of every row's whole page.

    Null pages are empty, a null URL is a site of its own; repeated rows each give a row.
    Pages move only if the removed branches and texts of all sites are more than ``BROADCAST_BRANCHES``.
    """
    low = _removed(_nodes(pages, url, page)).groupBy("host").agg(F.collect_set("number").alias("removed"))
    low = materialize(low, "removed")
    total = low.agg(F.sum(F.size("removed"))).first()[0] or 0
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").alias("html"), site_of(url).alias("host")
    )
    joined = rows.join(F.broadcast(low) if total <= BROADCAST_BRANCHES else low, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = [main_text(text or "", set(removed or ())) for text, removed in pairs]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.record_batch(columns, ["key", "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    chosen = joined.select("key", "url", "html", "removed")
    out = chosen.mapInArrow(run, f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
