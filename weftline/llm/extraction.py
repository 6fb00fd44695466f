"""Main text of web pages by tag-path ratios.

All texts of a page are grouped by their path of tags from the root. Each path has sums of text length and of
punctuation over its nodes, without the text of links; their ratios to the number of nodes are smoothed over the paths that
stand next to each other in the page, fused into one score, and compared with a threshold of the page itself. Texts on the
paths above it are kept. How much of the page's text the article or main element of a path holds is one term of the score.
Marks of furniture (elements as nav and footer, words in class names) are another one: below each mark a character counts
for a hundredth. Only what is never shown as text (scripts, styles, hidden elements, form controls) goes by rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.common import record_batch, share

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style noscript template iframe noembed noframes xmp textarea title svg math object".split())
NEVER = set(
    "head script style noscript template iframe noembed noframes textarea title svg math object button select input datalist "
    "dialog canvas audio video map".split()
)
FURNITURE = set("nav menu footer aside".split())
PARAGRAPH_ENDS = BLOCK - set("li dd dt tr td th tbody thead tfoot option optgroup caption legend summary".split())
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
HOLDS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
    "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"},
}
MAIN = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that mark what isn't the article.
NOISE_WORDS = set(
    "ad ads advert advertisement advertising adverts adsense banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social "
    "comment comments reply replies disqus discussion respond cookie cookies consent notice notices alert gdpr popup modal "
    "newsletter subscribe subscription signup login search pagination pager toolbar toc tags skip".split()
)
# Words of class names that say that something stands, or doesn't stand, beside an article.
STATES = set("has have with no without hide show open closed enabled disabled allow tag category".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")
# Marks that end or divide sentences.
_MARKS = re.compile(r"[.,;:!?…、。，！？]")


@dataclass(frozen=True)
class PathRatios:
    """Parameters: weight of the neighbouring paths, the threshold as a share of the page's mean, the weight of article elements,
    that of text length against punctuation, what a mark of furniture takes from a character, and what a link takes from it."""

    neighbour: float = 0.1
    threshold: float = 0.5
    article: float = 0.5
    length: float = 0.5
    furniture: float = 0.99
    link: float = 1.0


_CLEAR, _BY_NAME, _BY_ELEMENT = 0, 1, 2  # marks of furniture; a class name is a weaker hint than an element


@dataclass(slots=True)
class _Part:
    raw: str
    path: int
    main: int  # the nearest article or main element, 0 for none
    link: bool


@dataclass(slots=True)
class _Block:
    heading: int  # 1 to 6, 0 for other text
    parts: list[_Part] = field(default_factory=list)


@dataclass
class Page:
    """Blocks of text in page order, the tree of paths (parent, mark and label of each), and the parents of article elements.

    Path 0 is the root and element 0 the page around all articles. Parents have lower numbers than what is below them.
    """

    blocks: list[_Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    marks: list[int] = field(default_factory=lambda: [_CLEAR])
    labels: list[str] = field(default_factory=lambda: [""])
    mains: list[int] = field(default_factory=lambda: [0])


@dataclass(slots=True)
class _Open:
    """An open element: its path, the path that its text belongs to, and what holds for text inside."""

    name: str
    path: int
    owner: int
    never: bool
    main: int
    link: bool
    blocks: int  # block elements down to this one
    heading: int


def _attributes(rest: str) -> dict[str, str]:
    """The attributes of a tag by their names in small letters; of equal names the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _is_never(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element shows no text, by its kind or because it is hidden."""
    if name in NEVER or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "").lower()))


def _mark(name: str, attributes: dict[str, str], main: bool) -> int:
    """The mark of furniture that an element bears."""
    if name in FURNITURE or (name == "header" and not main):
        return _BY_ELEMENT
    if name == "form":
        return _BY_NAME
    if name in ("html", "body", "main") or (main and name in HEADINGS):
        return _CLEAR
    names = [_WORD.findall(n) for kind in ("class", "id", "role") for n in attributes.get(kind, "").lower().split()]
    if name == "article":  # here a class may tell the state of the page around, as in has-sidebar
        names = [words for words in names if not STATES.intersection(words)]
    return _BY_NAME if any(w in NOISE_WORDS for words in names for w in words) else _CLEAR


def _label(name: str, attributes: dict[str, str], mark: int) -> str:
    """Tag, first class and mark, which tell paths apart."""
    kind = attributes["class"].partition(" ")[0] if "class" in attributes else ""
    return f"{name}.{kind}{'!' * mark}"


def read_page(html: str) -> Page:
    """The texts of a page, in time and memory linear in its length, however deep its elements are nested."""
    page = Page()
    numbers: dict[tuple[int, str], int] = {}
    root = _Open("", 0, 0, False, 0, False, 0, 0)
    stack = [root]
    places: dict[str, list[int]] = {}  # where elements of a name stand in the stack
    current: _Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if top.never:
            return
        if current is None:
            current = _Block(top.heading)
            page.blocks.append(current)
        current.parts.append(_Part(raw, top.owner, top.main, top.link))

    def last(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def block_inside(at: int) -> bool:
        return stack[-1].blocks > stack[at].blocks

    def pop(to: int) -> None:
        nonlocal current
        if stack[-1].blocks > stack[to - 1].blocks:
            current = None
        for element in stack[to:]:
            places[element.name].pop()
        del stack[to:]

    at = 0
    while token := _TOKEN.search(html, at):
        if token.start() > at:
            text(html[at : token.start()])
        at = token.end()
        name = token.group("name")
        if name is None:
            continue
        name = name.lower()
        if token.group("close"):
            depth = last({name})
            if depth and (name in BLOCK or name in NEVER or not block_inside(depth)):
                pop(depth)
            continue
        if name in VOID:
            if name == "hr":
                current = None
            elif name == "br":
                text(" ")
            continue
        if name in PARAGRAPH_ENDS or name == "a":  # both end an open one
            depth = last({"a" if name == "a" else "p"})
            if depth and not block_inside(depth):
                pop(depth)
        if name in SIBLINGS:
            while (depth := last(SIBLINGS[name])) > last(HOLDS[name]):
                pop(depth)
        above = stack[-1]
        attributes = _attributes(token.group("rest"))
        main = above.main
        if name in MAIN:
            page.mains.append(main)
            main = len(page.mains) - 1
        never = above.never or _is_never(name, attributes)
        mark = _CLEAR if never else _mark(name, attributes, bool(main))
        block = name in BLOCK
        if block:
            current = None
        if block or not token.group("rest").rstrip().endswith("/"):
            label = _label(name, attributes, mark)
            path = numbers.setdefault((above.path, label), len(page.parents))
            if path == len(page.parents):
                page.parents.append(above.path)
                page.marks.append(mark)
                page.labels.append(label)
            heading = (int(name[1]) if name in HEADINGS else 0) if block else above.heading
            owner = path if block or mark else above.owner
            places.setdefault(name, []).append(len(stack))
            link = above.link or (name == "a" and "href" in attributes)
            stack.append(_Open(name, path, owner, never, main, link, above.blocks + block, heading))
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else len(html)
                if not never:
                    text(html[at:stop])
                at = stop
    if at < len(html):
        text(html[at:])
    return page


def _below(sums: list[float], parents: list[int]) -> list[float]:
    """Sums of all that lies at and below each number of a tree."""
    out = list(sums)
    for k in range(len(out) - 1, 0, -1):
        out[parents[k]] += out[k]
    return out


def _weights(page: Page, sizes: list[int], method: PathRatios) -> list[float]:
    """What a character of each path counts.

    If every text of the page is marked, class names (and forms) that hold over two thirds of it mark a wrapper and no
    furniture; if every text still is, the page has no article, and all weights are 0.
    """

    def depths(void: set[int]) -> list[int]:
        out = [0] * len(page.parents)
        for k in range(1, len(out)):
            out[k] = out[page.parents[k]] + (page.marks[k] != _CLEAR and k not in void)
        return out

    depth = depths(set())
    if method.furniture and not any(n and not d for n, d in zip(sizes, depth, strict=True)):
        held = _below(sizes, page.parents)
        depth = depths({k for k, mark in enumerate(page.marks) if mark == _BY_NAME and 3 * held[k] > 2 * held[0]})
        if not any(n and not d for n, d in zip(sizes, depth, strict=True)):
            return [0.0] * len(depth)
    return [(1 - method.furniture) ** d for d in depth]


def _likeness(page: Page, one: int, other: int, depth: list[int]) -> float:
    """The share of the longer of two paths that both begin with."""
    longest, shorter = max(depth[one], depth[other]), min(depth[one], depth[other])
    while one != other:  # the higher number is never above the lower one
        if one > other:
            one = page.parents[one]
        else:
            other = page.parents[other]
    return min(depth[one], shorter) / longest if longest else 1.0


def _smooth(values: list[float], weights: list[float]) -> list[float]:
    """Each value with its neighbours; weights[k] is that of values k - 1 and k for each other."""
    out = list(values)
    for k in range(1, len(values)):
        out[k] += weights[k] * (values[k - 1] - values[k])
        out[k - 1] += weights[k] * (values[k] - values[k - 1])
    return out


def chosen_paths(page: Page, contents: list[list[str]], method: PathRatios) -> tuple[set[int], set[int]]:
    """The paths whose score reaches the threshold, and those without a mark; `contents` are the texts of the parts of each block."""
    paths: dict[int, int] = {}  # in the order in which they first occur
    sizes = [0] * len(page.parents)
    for block, texts in zip(page.blocks, contents, strict=True):
        for part, content in zip(block.parts, texts, strict=True):
            if content:
                paths.setdefault(part.path, len(paths))
                sizes[part.path] += len(content)
    weights = _weights(page, sizes, method)
    if not paths or not max(weights):
        return set(), set()
    lengths, marks, nodes = [0.0] * len(paths), [0.0] * len(paths), [0] * len(paths)
    own = [0.0] * len(page.mains)
    for block, texts in zip(page.blocks, contents, strict=True):
        for path in {part.path for part, content in zip(block.parts, texts, strict=True) if content}:
            nodes[paths[path]] += 1
        for part, content in zip(block.parts, texts, strict=True):
            if content:
                k, weight = paths[part.path], weights[part.path]
                counted = weight * (1 - method.link if part.link else 1)
                lengths[k] += counted * len(content)
                marks[k] += counted * len(_MARKS.findall(content))
                own[part.main] += weight * len(content)
    held = _below(own, page.mains)
    held[0] = own[0]  # outside of all articles
    most = max(held)
    inside = [0.0] * len(paths)
    for block, texts in zip(page.blocks, contents, strict=True):
        for part, content in zip(block.parts, texts, strict=True):
            if content and part.main:
                inside[paths[part.path]] += len(content) * held[part.main] / most
    depth, order = [0] * len(page.parents), list(paths)
    for k in range(1, len(depth)):
        depth[k] = depth[page.parents[k]] + 1
    near = [0.0] + [method.neighbour * _likeness(page, a, b, depth) for a, b in zip(order, order[1:])]
    columns = [_smooth([v / n for v, n in zip(sums, nodes, strict=True)], near) for sums in (lengths, marks)]
    tops = [max(c) or 1.0 for c in columns]
    score, mean, whole = {}, 0.0, 0.0
    for path, k in paths.items():
        ratio = method.length * columns[0][k] / tops[0] + (1 - method.length) * columns[1][k] / tops[1]
        score[path] = weights[path] * ((1 - method.article) * ratio + method.article * inside[k] / sizes[path])
        mean += score[path] * weights[path] * sizes[path]
        whole += weights[path] * sizes[path]
    # Weighted by length, the mean is near the score of the paths that hold the article.
    least = method.threshold * mean / whole
    return {path for path, value in score.items() if value >= least}, {path for path in paths if weights[path] == 1}


def main_text(html: str, method: PathRatios = PathRatios()) -> str:
    """The main text of one page; empty if it has none."""
    page = read_page(html)
    decoded = [[unescape(part.raw) for part in block.parts] for block in page.blocks]
    contents = [[" ".join(text.split()) for text in texts] for texts in decoded]
    chosen, clear = chosen_paths(page, contents, method)
    clear |= chosen
    # A heading belongs to chosen text that follows it before the next heading of its rank, however short it is.
    out: list[str] = []
    followed = [False] * 7
    for block, texts, filled in zip(reversed(page.blocks), reversed(decoded), reversed(contents), strict=True):
        allowed = clear if block.heading and followed[block.heading] else chosen
        kept = [t for part, t in zip(block.parts, texts, strict=True) if part.path in allowed or not t.strip()]
        content = " ".join("".join(kept).split())
        if content:
            out.append(content)
        if block.heading:
            if any(filled):
                followed[block.heading :] = [False] * (7 - block.heading)
        elif content:
            followed = [True] * 7
    return "\n".join(reversed(out))


def extract(pages: DataFrame, method: PathRatios = PathRatios()) -> DataFrame:
    """page_id, url, text, n_chars of every page; one narrow pass, each page by itself.

    `pages` has page_id, url and html; other columns are not read. A null or empty html, and a page without an article,
    gives the empty text; null keys stay null; repeated rows repeat; no rows give no rows. Nothing is cut from a long page.
    """
    given = share(pages.sparkSession, method)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, given.value) if h else "" for h in batch.column(2).to_pylist()]
            yield record_batch(schema, batch.column(0), batch.column(1), texts, [len(t) for t in texts])

    return pages.select("page_id", "url", "html").mapInArrow(task, "page_id long, url string, text string, n_chars long")
